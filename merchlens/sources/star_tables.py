"""Order-report shaped views of the star-schema tables used for checks and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.functions import promo
from merchlens.functions.dates import month_of, pacific_date
from merchlens.functions.text import sku_key
from merchlens.operators.base import order_base, valid_orders

# Prices of these tables run from 18 to 103,000, so low price needs another limit.
LOW_PRICE = "1000"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw order lines: one per line item, with the marks the rules look for."""
    geo = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "r_name")
    # Nations and regions are lists of fixed length (25 and 5).
    customers = table(spark, folder, "customer").join(
        F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "r_name")
    orders = table(spark, folder, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "r_name")
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus",
    )
    # Two tables that grow together: sort-merge, whatever an estimate says of either.
    lines = items.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    money = "decimal(18,4)"
    discount = (
        F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(4,2)")
    ).cast(money)
    mark = F.col("l_partkey") % 12
    return lines.select(
        F.concat("r_name", F.lit("-US")).alias("store_name"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int")))
        .alias("purchase_date_utc"),
        F.col("l_orderkey").cast("string").alias("amazon_order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.concat(F.lit(" sku-"), F.col("l_partkey").cast("string"), F.lit(" ")).alias("sku"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Non-Amazon").otherwise("Amazon.com").alias("sales_channel"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("l_suppkey") % 2 == 0), "Cancelled")
        .otherwise("Shipped").alias("order_status"),
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "Unshipped")
        .otherwise("Shipped").alias("item_status"),
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(0)).otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.when(F.col("l_suppkey") % 49 == 0, "CAD").otherwise("USD").alias("currency"),
        F.col("l_extendedprice").cast(money).alias("item_price"),
        F.when(F.col("l_returnflag") == "R", discount).alias("item_promotion_discount"),
        F.when(mark == 0, F.concat(F.lit("US-mpc-"), F.col("l_partkey").cast("string")))
        .when(mark == 1, "PLM-7788")
        .when(mark == 2, "US Core Free Shipping")
        .when(mark == 3, "Percentage Off 10").alias("promotion_ids"),
        "l_suppkey", "l_linenumber", "l_partkey",
    )


def base(lines: DataFrame, low_price: str = LOW_PRICE) -> DataFrame:
    return order_base(lines, low_price=low_price)


def _flagged(lines: DataFrame) -> DataFrame:
    """Valid lines with flags and the keys the views below derive from."""
    return valid_orders(lines).withColumns({
        "order_date": pacific_date("purchase_date_utc"),
        "sku_key": sku_key("sku"),
        "onsite": promo.onsite_promotion_flag(),
    })


def performance_monthly(lines: DataFrame) -> DataFrame:
    """Product performance per month, store and MSKU; every fourth supplier's line is an ad order."""
    return _flagged(lines).groupBy(
        month_of("order_date").alias("report_month"), "store_name", F.col("sku_key").alias("msku")
    ).agg(
        F.count_distinct("amazon_order_id").alias("order_items"),
        F.count_if(F.col("l_suppkey") % 4 == 0).alias("ad_order_quantity"),
        F.count_if("onsite").alias("promotion_order_items"),
        F.sum("quantity").alias("volume"),
        F.sum("item_price").alias("amount"),
    )


def ad_spend_daily(lines: DataFrame) -> DataFrame:
    """One ad row per line and ad type; some fall a day late, so levels two and three get work."""
    kinds = F.array_compact(F.array(
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("SP")),
        F.when(F.col("l_suppkey") % 3 == 0, F.lit("SD")),
    ))
    return _flagged(lines).select(
        "store_name",
        F.date_add("order_date", (F.col("l_suppkey") % 2).cast("int")).alias("report_date"),
        "sku",
        F.when(F.col("l_partkey") % 3 == 0, F.lit("")).otherwise(
            F.concat(F.lit("B"), F.col("l_partkey").cast("string"))
        ).alias("asin"),
        F.explode(kinds).alias("ad_type"),
        F.lit(1).cast("bigint").alias("orders"),
        F.col("item_price").alias("sales"),
        F.coalesce("item_promotion_discount", F.lit(0)).cast("decimal(18,4)").alias("cost"),
        (F.col("l_suppkey") % 7).alias("clicks"),
        F.col("l_suppkey").alias("impressions"),
    )


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """A listing per store and part, some twice, some with holes, some missing."""
    k = F.col("p_partkey")
    # A short file of parts makes many listings: spread over tasks before they are made.
    parts = table(spark, folder, "part").filter(k % 23 != 0).select("p_partkey").repartition("p_partkey")
    stores = F.array(*[F.lit(n) for n in ("AFRICA-US", "AMERICA-US", "ASIA-US", "EUROPE-US", "MIDDLE EAST-US")])
    copies = F.when(k % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = parts.withColumn("店铺", F.explode(stores)).withColumn("copy", F.explode(copies))
    first = F.col("copy") == 0
    local = F.concat(F.lit("L"), (k % 500).cast("string"))
    return rows.select(
        "店铺",
        F.concat(F.lit("S"), (k % 4).cast("string")).alias("店铺id"),
        F.concat(F.lit("sku-"), k.cast("string"), F.lit(" ")).alias("MSKU"),
        F.when(first & (k % 17 == 0), F.lit("")).otherwise(local).alias("SKU"),
        F.when(first & (k % 7 == 0), F.lit(""))
        .otherwise(F.concat(F.lit("P"), (k % 11).cast("string"))).alias("负责人"),
        F.when(first, k % 2).otherwise((k + 1) % 2).cast("int").alias("状态"),
    )


def product_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A product row per local SKU taken from the parts, with custom fields as JSON text."""
    k = F.col("k")
    text = k.cast("string")
    parts = table(spark, folder, "part").select((F.col("p_partkey") % 500).alias("k")).distinct()
    season = F.concat(
        F.lit('[{"name":"季节","val_text":"'),
        F.when(k % 2 == 0, F.lit("夏")).otherwise(F.lit("冬")),
        F.lit('"},{"name":"季节","val":"'),
        F.when(k % 4 == 0, F.lit("夏")).otherwise(F.lit("春")),
        F.lit('"}]'),
    )
    category = F.concat(F.lit('[{"name":"品类","field_value":"C'), (k % 9).cast("string"), F.lit('"}]'))
    return parts.select(
        F.concat(F.lit("l"), text, F.lit(" ")).alias("sku"),
        F.concat(F.lit("product "), text).alias("product_name"),
        F.when(k % 29 == 0, F.lit("")).otherwise(F.concat(F.lit("ST"), (k % 60).cast("string"))).alias("spu"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("N"), (k % 5).cast("string"))).alias("category_name"),
        F.when(k % 8 == 0, F.lit("A/ B /")).when(k % 10 == 0, F.lit("plain"))
        .otherwise(F.concat(F.lit("A>T"), (k % 6).cast("string"))).alias("category_path"),
        F.when(k % 3 == 0, category).when(k % 31 == 0, F.lit("{broken"))
        .otherwise(season).alias("custom_fields_json"),
    )
