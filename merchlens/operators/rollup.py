"""Monthly rollup by source and the small reports read straight from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.rules import (
    DISPLAY_ORDER, OFFSITE_FIRST_ORDER, ONSITE, ROLE_DISPLAY, ROLE_DISPLAY_LONG, ROLE_PRIMARY, RuleSet,
)
from merchlens.scope import Scope

MEASURES = (
    "classified_item_rows", "order_sku_count", "amazon_order_count", "units",
    "gross_item_sales", "net_item_sales",
)


def source_order(column: str = "main_order_type", order: tuple[str, ...] = DISPLAY_ORDER) -> Column:
    """Place of a source in the business order, 1-based; unknown sources come first (0)."""
    return F.coalesce(F.array_position(F.array(*[F.lit(s) for s in order]), F.col(column)), F.lit(0))


def metric_role(column: str = "main_order_type", long: bool = False) -> Column:
    display = ROLE_DISPLAY_LONG if long else ROLE_DISPLAY
    return F.when(F.col(column) == ONSITE, F.lit(display)).otherwise(F.lit(ROLE_PRIMARY))


def source_monthly(result: DataFrame, rules: RuleSet) -> DataFrame:
    """Measures per month, store and source, with the on-site display row under overlay.

    A line counts under its primary source and, when tagged, under the display
    row too. Both come from one pass: the line is repeated per source it counts
    under, instead of reading the result twice for a union. Lines are dealt to
    tasks by order, so that of the three steps below only the last, of sums,
    shuffles again.
    """
    lines = result.select(
        "order_month", "store_name", "main_order_type", "onsite_promotion_flag",
        "amazon_order_id", "sku_key", "quantity", "gross_item_sales", "net_item_sales",
    ).repartition("order_month", "store_name", "amazon_order_id")
    if rules.promo_mode == "overlay":
        kinds = F.array_compact(
            F.array("main_order_type", F.when(F.col("onsite_promotion_flag"), F.lit(ONSITE)))
        )
        lines = lines.withColumn("main_order_type", F.explode(kinds))
    # Order-SKUs, then orders, then the source: both distinct counts are plain sums of the step before.
    # Nulls do not count, as in a distinct count.
    source = ["order_month", "store_name", "main_order_type"]
    totals = ["classified_item_rows", "units", "gross_item_sales", "net_item_sales"]
    by_order_sku = lines.groupBy(*source, "amazon_order_id", "sku_key").agg(
        F.count(F.lit(1)).alias("classified_item_rows"), F.sum("quantity").alias("units"),
        F.sum("gross_item_sales").alias("gross_item_sales"), F.sum("net_item_sales").alias("net_item_sales"),
    )
    by_order = by_order_sku.groupBy(*source, "amazon_order_id").agg(
        F.count("sku_key").alias("order_skus"), *[F.sum(c).alias(c) for c in totals]
    )
    named = F.col("amazon_order_id").isNotNull()
    return by_order.groupBy(*source).agg(
        F.sum("classified_item_rows").alias("classified_item_rows"),
        F.coalesce(F.sum(F.when(named, F.col("order_skus"))), F.lit(0)).alias("order_sku_count"),
        F.count("amazon_order_id").alias("amazon_order_count"),
        F.sum("units").alias("units"),
        F.sum("gross_item_sales").cast("decimal(20,4)").alias("gross_item_sales"),
        F.sum("net_item_sales").cast("decimal(20,4)").alias("net_item_sales"),
    )


def month_share(monthly: DataFrame, ads_first: bool = True) -> DataFrame:
    """Order-SKU share of each source within its store and month, in percent.

    ``ads_first`` picks the listing order: production lists ads first, the older
    generations off-site first.
    """
    order = DISPLAY_ORDER if ads_first else OFFSITE_FIRST_ORDER
    total = F.sum("order_sku_count").over(Window.partitionBy("order_month", "store_name"))
    return monthly.select(
        "order_month", "store_name", "main_order_type", "order_sku_count",
        F.round((F.col("order_sku_count") * 100).cast("decimal(28,8)") / total, 2)
        .cast("decimal(10,2)").alias("order_sku_pct"),
        "units",
        F.round("net_item_sales", 2).alias("net_item_sales"),
    ).orderBy("order_month", "store_name", source_order(order=order))


def source_summary(monthly: DataFrame, scope: Scope | None = None, with_role: bool = True) -> DataFrame:
    """Totals per source over the scope in business order."""
    rows = monthly if scope is None else scope.apply(monthly)
    out = rows.groupBy("main_order_type").agg(
        F.sum("order_sku_count").alias("order_sku_count"),
        F.round(F.sum("net_item_sales"), 2).alias("net_item_sales"),
    )
    if with_role:
        out = out.withColumn("metric_role", metric_role(long=True))
    return out.orderBy(source_order())


def rule_version_check(result: DataFrame) -> DataFrame:
    return result.groupBy("rule_version").agg(
        F.count(F.lit(1)).alias("item_rows"),
        F.min("order_month").alias("min_month"),
        F.max("order_month").alias("max_month"),
    )
