"""Ad demand per store, day and SKU, and per store and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.dates import month_of
from merchlens.functions.text import LOOSE, sku_key
from merchlens.scope import Scope

STORE_LEVEL_SKU = "__STORE__"


def of_ad_type(*names: str) -> Column:
    return F.collate("ad_type", LOOSE).isin(list(names))


def ad_demand_daily(ad_spend: DataFrame, scope: Scope | None = None) -> DataFrame:
    """SP and SD ad orders per store, date and SKU key."""
    key = sku_key("sku")
    is_sp, is_sd = of_ad_type("SP"), of_ad_type("SD")
    rows = ad_spend.filter(
        (F.col("orders") > 0) & (is_sp | is_sd) & F.col("sku").isNotNull()
        & (key != "") & (key != STORE_LEVEL_SKU)
    )
    if scope is not None:
        rows = scope.fold_store(rows.filter(scope.month_filter("report_date")))
    zero = F.lit(0)
    return (
        rows.groupBy("store_name", "report_date", key.alias("sku_key"))
        .agg(
            F.max(F.nullif(F.col("asin"), F.lit(""))).alias("asin"),
            F.sum(F.when(is_sp, F.col("orders")).otherwise(zero)).alias("sp_orders"),
            F.sum(F.when(is_sd, F.col("orders")).otherwise(zero)).alias("sd_orders"),
            F.sum("orders").alias("ad_orders_raw"),
            F.sum(F.coalesce("sales", zero)).alias("ad_sales"),
            F.sum(F.coalesce("cost", zero)).alias("ad_cost"),
            F.sum(F.coalesce("clicks", zero)).alias("clicks"),
            F.sum(F.coalesce("impressions", zero)).alias("impressions"),
            # Only two types pass the filter, so the distinct count needs no second shuffle.
            (F.max(is_sp.cast("int")) + F.max(is_sd.cast("int"))).alias("positive_ad_type_count"),
        )
        .withColumn("order_month", month_of("report_date"))
        .withColumn("multi_ad_type_flag", F.col("positive_ad_type_count") > 1)
    )


def ad_demand_monthly(performance: DataFrame, scope: Scope | None = None) -> DataFrame:
    """Monthly ad target and order totals per store from product performance."""
    rows = performance
    if scope is not None:
        rows = scope.fold_store(rows.filter(scope.month_filter("report_month")))

    def total(name: str) -> object:
        return F.sum(F.coalesce(name, F.lit(0)))

    return rows.groupBy(F.col("report_month").alias("order_month"), "store_name").agg(
        F.count("*").alias("msku_count"),
        total("order_items").alias("product_order_items"),
        total("ad_order_quantity").alias("ad_order_quantity"),
        total("promotion_order_items").alias("promotion_order_items"),
        total("volume").alias("product_units"),
        total("amount").cast("decimal(20,4)").alias("product_sales"),
    )
