"""Primary source, reason and flags of every valid order line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.promo import low_price_candidate_flag
from merchlens.rules import (
    ADS, LOW_PRICE, OFFSITE, ONSITE, ORGANIC,
    REASON_ADS_BY_LEVEL, REASON_ADS_DAY_SKU, REASON_ADS_STORE_MONTH,
    REASON_OFFSITE, REASON_ONSITE, REASON_ONSITE_OVERLAY,
    RuleSet,
)

MATCH = ["store_name", "order_month", "order_date", "sku_key", "amazon_order_id"]
RESULT_COLUMNS = [
    "source_id", "store_name", "order_date", "order_month", "amazon_order_id", "order_item_id",
    "sku", "sku_key", "asin", "quantity", "gross_item_sales", "net_item_sales", "net_unit_price",
    "promotion_ids", "offsite_flag", "estimated_ad_flag", "ad_allocation_level",
    "ad_allocation_confidence", "onsite_promotion_flag", "low_price_flag", "main_order_type",
    "classification_reason", "candidate_rank", "ad_orders_raw", "rule_version",
]


def _is_low(rules: RuleSet) -> Column:
    return low_price_candidate_flag(rules.low_price)


def main_order_type(rules: RuleSet) -> Column:
    kind = F.when(F.col("offsite_flag"), F.lit(OFFSITE)).when(F.col("estimated_ad_flag"), F.lit(ADS))
    if rules.promo_mode == "exclusive":
        kind = kind.when(F.col("onsite_promotion_flag"), F.lit(ONSITE))
    return kind.when(_is_low(rules), F.lit(LOW_PRICE)).otherwise(F.lit(ORGANIC))


def ads_reason(rules: RuleSet) -> Column:
    if rules.allocator == "day_sku":
        return F.lit(REASON_ADS_DAY_SKU)
    if rules.allocator == "store_month":
        return F.lit(REASON_ADS_STORE_MONTH)
    reason = F.lit(None).cast("string")
    for level, text in REASON_ADS_BY_LEVEL.items():
        reason = F.when(F.col("ad_allocation_level") == level, F.lit(text)).otherwise(reason)
    return reason


def classification_reason(rules: RuleSet) -> Column:
    reason = F.when(F.col("offsite_flag"), F.lit(REASON_OFFSITE)).when(
        F.col("estimated_ad_flag"), ads_reason(rules)
    )
    if rules.promo_mode == "exclusive":
        reason = reason.when(F.col("onsite_promotion_flag"), F.lit(REASON_ONSITE))
    reason = reason.when(_is_low(rules), F.lit(rules.reason_low_price))
    if rules.promo_mode == "overlay":
        reason = reason.when(F.col("onsite_promotion_flag"), F.lit(REASON_ONSITE_OVERLAY))
    return reason.otherwise(F.lit(rules.reason_organic))


def _label(lines: DataFrame, rules: RuleSet) -> DataFrame:
    return lines.withColumns({
        "low_price_flag": _is_low(rules) & ~F.col("estimated_ad_flag"),
        "main_order_type": main_order_type(rules),
        "classification_reason": classification_reason(rules),
        "rule_version": F.lit(rules.version),
    })


def classify(base: DataFrame, allocation: DataFrame, rules: RuleSet) -> DataFrame:
    """Every base line once, with its exclusive source under ``rules``."""
    chosen = allocation.select(
        *MATCH, "estimated_ad_flag", "candidate_rank", "ad_orders_raw",
        F.col("allocation_level").alias("ad_allocation_level"),
        F.col("allocation_confidence").alias("ad_allocation_confidence"),
    )
    lines = base.join(chosen, MATCH, "left").withColumns({
        "estimated_ad_flag": F.coalesce("estimated_ad_flag", F.lit(False)),
        "ad_orders_raw": F.coalesce("ad_orders_raw", F.lit(0)),
    })
    return _label(lines, rules).select(*RESULT_COLUMNS)


def reclassify(result: DataFrame, rules: RuleSet) -> DataFrame:
    """Apply other thresholds or the overlay to a result; the allocation stays. No shuffle."""
    return _label(result, rules).select(*RESULT_COLUMNS)


def reflag_base(base: DataFrame, rules: RuleSet) -> DataFrame:
    """Low-price candidate flag of the base under another threshold."""
    return base.withColumns({
        "low_price_candidate_flag": _is_low(rules),
        "rule_version": F.lit(rules.version),
    })
