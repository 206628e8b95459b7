"""Units-weighted deal price per style and month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions import text
from merchlens.functions.dates import month_label, pacific_date
from merchlens.operators.base import valid_orders
from merchlens.scope import Scope

UNIT = "decimal(22,8)"
STYLE = ["store_name", "principal", "style_no", "season", "category"]


def msku_month(orders: DataFrame, scope: Scope) -> DataFrame:
    """Order-SKUs, units, money and unit price range per month, store and MSKU."""
    net = F.coalesce("item_price", F.lit(0)) - F.coalesce("item_promotion_discount", F.lit(0))
    unit = (net / F.col("quantity")).cast(UNIT)
    return (
        valid_orders(orders, scope)
        .groupBy(
            month_label(pacific_date("purchase_date_utc")).alias("order_month"),
            "store_name",
            text.sku_key("sku").alias("msku"),
        )
        .agg(
            # The MSKU is a key here, so order-SKUs are just distinct orders.
            F.count_distinct("amazon_order_id").alias("order_sku_count"),
            F.sum("quantity").alias("units"),
            F.sum(F.coalesce("item_price", F.lit(0))).alias("gross_item_sales"),
            F.sum(F.coalesce("item_promotion_discount", F.lit(0))).alias("item_promotion_discount"),
            F.sum(net).alias("net_item_sales"),
            F.min(unit).alias("min_deal_price"),
            F.max(unit).alias("max_deal_price"),
        )
    )


def best_listing(listing: DataFrame, stores: tuple[str, ...] | None = None) -> DataFrame:
    """One listing per store and MSKU: on sale first, then with principal, then with local SKU.

    Ties are settled by the columns' own order. The pick is a ``min`` over a
    struct, so it combines before the shuffle and no group is sorted in a task.
    """
    rows = listing.select(
        text.norm("店铺").alias("store_key"),
        text.norm("MSKU").alias("msku_key"),
        text.strip("店铺").alias("store"),
        text.strip("店铺id").alias("sid"),
        text.strip("MSKU").alias("msku"),
        text.strip("SKU").alias("local_sku"),
        text.strip("负责人").alias("principal"),
        F.coalesce(F.col("状态").cast("int"), F.lit(0)).alias("status"),
    ).filter((F.col("store_key") != "") & (F.col("msku_key") != ""))
    if stores is not None:
        rows = rows.filter(F.col("store_key").isin([s.strip().upper() for s in stores]))
    preference = F.struct(
        (F.col("status") != 1).alias("off_sale"),
        (F.col("principal") == "").alias("no_principal"),
        (F.col("local_sku") == "").alias("no_local_sku"),
        "local_sku", "principal", "sid", "store", "msku", "status",
    )
    best = rows.groupBy("store_key", "msku_key").agg(F.min(preference).alias("best"))
    kept = ("store", "sid", "msku", "local_sku", "principal", "status")
    return best.select("store_key", "msku_key", *[F.col(f"best.{c}").alias(c) for c in kept])


def product_dims(product: DataFrame) -> DataFrame:
    """Style, season and category per local SKU; the last by column order wins a tie."""
    fields = "custom_fields_json"
    category = F.coalesce(
        F.nullif(text.custom_field_value(fields, "品类"), F.lit("")),
        text.category_fallback("category_name", "category_path"),
    )
    rows = product.select(
        text.norm("sku").alias("sku_key"),
        text.strip("sku").alias("local_sku"),
        text.strip("product_name").alias("product_name"),
        text.strip("spu").alias("style_no"),
        text.custom_field_value(fields, "季节").alias("season"),
        category.alias("category"),
    ).filter(F.col("sku_key") != "")
    kept = ("local_sku", "style_no", "season", "category", "product_name")
    best = rows.groupBy("sku_key").agg(F.max(F.struct(*kept)).alias("best"))
    return best.select("sku_key", *[F.col(f"best.{c}").alias(c) for c in kept])


def map_styles(msku: DataFrame, listing_best: DataFrame, products: DataFrame) -> DataFrame:
    """MSKU months with principal, style, season, category and the mapping result.

    Both joins come after the order lines are aggregated to MSKU months. Listings grow with the
    catalogue and every store, so they are never sent whole to the driver, however small an
    estimate made before their aggregation says they are.
    """
    listing = listing_best.select(
        F.col("store_key"), F.col("msku_key"), "local_sku", "principal", F.lit(True).alias("has_listing")
    )
    dims = products.select(
        F.col("sku_key").alias("local_key"), "style_no", "season", "category", F.lit(True).alias("has_product")
    )
    found = msku.withColumns({
        "store_key": text.norm("store_name"), "msku_key": text.norm("msku"),
    }).join(listing.hint("merge"), ["store_key", "msku_key"], "left")
    found = found.withColumn("local_key", F.nullif(text.norm("local_sku"), F.lit("")))
    found = found.join(dims, "local_key", "left")
    reason = text.mapping_reason(
        F.coalesce("has_listing", F.lit(False)), F.coalesce("has_product", F.lit(False))
    )
    return found.withColumn("mapping_result", reason).select(
        *msku.columns,
        F.coalesce("local_sku", F.lit("")).alias("local_sku"),
        text.placeholder("style_no", text.UNMATCHED_STYLE).alias("style_no"),
        text.placeholder("season", text.NOT_MAINTAINED).alias("season"),
        text.placeholder("category", text.NOT_MAINTAINED).alias("category"),
        text.placeholder("principal", text.NOT_MAINTAINED).alias("principal"),
        "mapping_result",
    )


def weighted_price(net: Column, units: Column) -> Column:
    """Net sales per unit as a double; null where no unit was sold."""
    return F.when(units > 0, net.cast("double") / units.cast("double"))


def _totals() -> list[Column]:
    return [
        F.sum(c).alias(c)
        for c in ("order_sku_count", "units", "gross_item_sales", "item_promotion_discount", "net_item_sales")
    ]


def _local_sku() -> Column:
    return F.nullif(F.col("local_sku"), F.lit(""))


def deal_price_long(mapped: DataFrame) -> DataFrame:
    """One row per month, store, style, season, category and principal."""
    return mapped.groupBy("order_month", *STYLE).agg(
        *_totals(),
        weighted_price(F.sum("net_item_sales"), F.sum("units")).alias("weighted_deal_price"),
        F.min("min_deal_price").alias("min_deal_price"),
        F.max("max_deal_price").alias("max_deal_price"),
        F.count_distinct("msku").alias("msku_count"),
        F.count_distinct(_local_sku()).alias("local_sku_count"),
    ).orderBy("order_month", "store_name", "style_no", "season", "category", "principal")


def deal_price_wide(mapped: DataFrame, months: list[dt.date]) -> DataFrame:
    """One row per style with a price column per month and whole-period totals.

    Month prices are aggregated first and laid out from a map with at most one
    entry per month; that stays flat where a conditional sum per month would put
    hundreds of aggregates into one operator. Both sides of the join are grouped
    by the style, so the join moves no rows.
    """
    by_month = mapped.groupBy(*STYLE, "order_month").agg(
        weighted_price(F.sum("net_item_sales"), F.sum("units")).alias("price")
    )
    prices = by_month.groupBy(*STYLE).agg(
        F.map_from_entries(F.collect_list(F.struct("order_month", "price"))).alias("prices")
    )
    totals = mapped.groupBy(*STYLE).agg(
        F.sum("units").alias("total_units"),
        weighted_price(F.sum("net_item_sales"), F.sum("units")).alias("total_weighted_price"),
        F.count_distinct("msku").alias("msku_count"),
        F.count_distinct(_local_sku()).alias("local_sku_count"),
    )
    labels = [m.strftime("%Y-%m") for m in months]
    return totals.join(prices, STYLE).select(
        *STYLE, "total_units",
        *[F.try_element_at("prices", F.lit(label)).alias(label) for label in labels],
        "total_weighted_price", "msku_count", "local_sku_count",
    ).orderBy("store_name", "style_no", "principal", "season", "category")


def deal_price_by_store(mapped: DataFrame, months: list[dt.date], store: str) -> DataFrame:
    """The wide table of one store, without its store column."""
    rows = mapped.filter(text.norm("store_name") == store.strip().upper())
    return deal_price_wide(rows, months).drop("store_name").orderBy(
        "style_no", "principal", "season", "category"
    )


def mapping_audit(mapped: DataFrame) -> DataFrame:
    """Order volume per store, MSKU and mapping result; complete matches sort last."""
    return mapped.groupBy("store_name", "msku", "mapping_result").agg(
        F.sum("order_sku_count").alias("order_sku_count"),
        F.sum("units").alias("units"),
        F.sum("net_item_sales").alias("net_item_sales"),
        F.coalesce(
            weighted_price(F.sum("net_item_sales"), F.sum("units")), F.lit(0.0)
        ).alias("weighted_deal_price"),
    ).orderBy(F.col("mapping_result") == text.FULL_MATCH, "store_name", "msku")


MISSING_MONTH, MONTH_PRESENT, RUNNING_MONTH = "缺少订单数据", "已有数据", "未完结月份，截至"


def month_coverage(msku: DataFrame, scope: Scope, today: dt.date) -> DataFrame:
    """Every month of the scope: whether it has orders, and how much."""
    spine = msku.sparkSession.createDataFrame(
        [(m.strftime("%Y-%m"),) for m in scope.months], "order_month string"
    )
    found = msku.groupBy("order_month").agg(
        F.sum("order_sku_count").alias("order_sku_count"),
        F.sum("units").alias("units"),
        F.sum("net_item_sales").alias("net_item_sales"),
    )
    has_data = F.coalesce(F.col("units") > 0, F.lit(False))
    running = F.lit(f"{RUNNING_MONTH}{today.isoformat()}")
    return spine.join(found, "order_month", "left").select(
        "order_month",
        F.when(has_data, F.lit("是")).otherwise(F.lit("否")).alias("has_data"),
        F.coalesce("order_sku_count", F.lit(0)).alias("order_sku_count"),
        F.coalesce("units", F.lit(0)).alias("units"),
        F.coalesce("net_item_sales", F.lit(0)).alias("net_item_sales"),
        F.when(~has_data, F.lit(MISSING_MONTH))
        .when(F.col("order_month") == today.strftime("%Y-%m"), running)
        .otherwise(F.lit(MONTH_PRESENT)).alias("status"),
    ).orderBy("order_month")
