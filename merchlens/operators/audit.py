"""Allocation audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.dates import month_label
from merchlens.rules import DAY_SKU, MONTH_SKU, STORE_MONTH

KEY = ["order_month", "store_name"]


def _percent(part: str, whole: str) -> Column:
    """Percentage to four digits; 0 where there is no target."""
    ratio = F.try_divide((F.col(part) * 100).cast("decimal(28,8)"), F.col(whole).cast("decimal(20,0)"))
    return F.coalesce(F.round(ratio, 4), F.lit(0)).cast("decimal(10,4)")


def allocation_audit(demand_monthly: DataFrame, base: DataFrame, allocation: DataFrame) -> DataFrame:
    """Target against capacity and allocation per store and month."""
    order_skus = base.groupBy(*KEY, "amazon_order_id", "sku_key").agg(F.max("offsite_flag").alias("offsite"))
    capacity = order_skus.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("base_order_sku_count"),
        F.count_if("offsite").alias("offsite_order_sku_count"),
        F.count_if(~F.col("offsite")).alias("non_offsite_capacity"),
    )
    allocated = allocation.groupBy(*KEY).agg(F.count_if("estimated_ad_flag").alias("allocated_ad_orders"))
    counts = ["base_order_sku_count", "offsite_order_sku_count", "non_offsite_capacity", "allocated_ad_orders"]
    return (
        demand_monthly.join(capacity, KEY, "left")
        .join(allocated, KEY, "left")
        .na.fill(0, counts)
        .select(
            *KEY, "product_order_items",
            F.col("ad_order_quantity").alias("product_ad_order_target"),
            F.col("promotion_order_items").alias("product_promotion_orders"),
            "msku_count", *counts,
        )
        .withColumns({
            "unallocated_ad_orders": F.greatest(
                F.col("product_ad_order_target") - F.col("allocated_ad_orders"), F.lit(0)
            ),
            "allocation_pct": _percent("allocated_ad_orders", "product_ad_order_target"),
            "source_gap_order_sku": F.col("product_order_items") - F.col("base_order_sku_count"),
        })
    )


def hybrid_audit(demand_daily: DataFrame, allocation: DataFrame) -> DataFrame:
    """Raw and conservative targets against the three levels per store and month."""
    levels = allocation.groupBy(*KEY).agg(
        F.count_if(F.col("allocation_level") == DAY_SKU).alias("day_sku_allocated"),
        F.count_if(F.col("allocation_level") == MONTH_SKU).alias("month_sku_allocated"),
        F.count_if(F.col("allocation_level") == STORE_MONTH).alias("store_month_allocated"),
        F.count(F.lit(1)).alias("total_allocated"),
    )
    demand = demand_daily.groupBy(*KEY).agg(
        F.sum("ad_orders_raw").alias("raw_ad_orders"),
        F.sum(F.greatest("sp_orders", "sd_orders")).alias("conservative_target_orders"),
    )
    counts = ["day_sku_allocated", "month_sku_allocated", "store_month_allocated", "total_allocated"]
    return (
        demand.join(levels, KEY, "left")
        .na.fill(0, counts)
        .select(*KEY, "raw_ad_orders", "conservative_target_orders", *counts)
        .withColumns({
            "unallocated_orders": F.greatest(
                F.col("conservative_target_orders") - F.col("total_allocated"), F.lit(0)
            ),
            "allocation_pct": _percent("total_allocated", "conservative_target_orders"),
        })
    )


STATUS_PASS, STATUS_CHECK = "通过", "需检查"


def audit_report(audit: DataFrame) -> DataFrame:
    """Report rows of the audit: rates as fractions and a pass/check status."""
    fraction = F.coalesce(F.col("allocation_pct"), F.lit(0)).cast("double") / F.lit(100.0)
    passed = (F.col("unallocated_ad_orders") == 0) & (fraction >= 0.999999)
    gap = F.col("source_gap_order_sku").cast("double")
    orders = F.col("product_order_items").cast("double")
    return audit.select(
        month_label("order_month").alias("month"), "store_name", "product_order_items",
        "product_ad_order_target", "product_promotion_orders", "msku_count",
        "base_order_sku_count", "offsite_order_sku_count", "non_offsite_capacity",
        "allocated_ad_orders", "unallocated_ad_orders",
        fraction.alias("allocation_rate"),
        "source_gap_order_sku",
        F.coalesce(F.try_divide(gap, orders), F.lit(0.0)).alias("source_gap_rate"),
        F.when(passed, F.lit(STATUS_PASS)).otherwise(F.lit(STATUS_CHECK)).alias("status"),
    )


AUDIT_VIEW_COLUMNS = [
    "order_month", "store_name", "product_order_items", "product_ad_order_target",
    "product_promotion_orders", "msku_count", "base_order_sku_count", "offsite_order_sku_count",
    "non_offsite_capacity", "allocated_ad_orders", "unallocated_ad_orders", "allocation_pct",
    "source_gap_order_sku", "created_at",
]


def create_audit_view(audit: DataFrame, name: str = "dws_amz_product_ad_allocation_monthly_audit") -> DataFrame:
    """The stored audit table under its older name with its fixed column list; an existing view is replaced."""
    columns = [
        F.col(c) if c in audit.columns else F.lit(None).cast("timestamp").alias(c) for c in AUDIT_VIEW_COLUMNS
    ]
    audit.select(*columns).createOrReplaceTempView(name)
    return audit.sparkSession.table(name)
