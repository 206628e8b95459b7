"""Import-shaped inputs that Spark derives from the star-schema tables."""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlens.session import lean, scratch_root
from merchlens.schemas import ORDER_HEADERS
from merchlens.sources import star_tables as star
from merchlens.sources.warehouse import OPEN_FILES_CONF

STORES = ["AFRICA-US", "AMERICA-US", "ASIA-US", "EUROPE-US", "MIDDLE EAST-US"]


def report_text(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as report text, in the mix of forms reports come in."""
    qty = F.col("l_quantity").cast("int").cast("string")
    form = F.col("l_linenumber") % 6
    at = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    clock = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.col("o_orderkey") % 4
    return star.table(spark, folder, "lineitem").join(
        star.table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(form == 0, "Yes").when(form == 1, F.concat(qty, F.lit(".7")))
        .when(form == 2, F.concat(F.lit("1,"), F.lpad(qty, 3, "0"))).when(form == 3, "")
        .when(form == 4, "0").otherwise(F.concat(F.lit(" "), qty, F.lit(" "))).alias("quantity_text"),
        F.when(form == 0, "x1").when(form == 1, "")
        .otherwise(F.concat(F.lit(" "), F.col("l_extendedprice").cast("decimal(18,2)").cast("string")))
        .alias("price_text"),
        F.when(form == 0, " TRUE ").when(form == 1, "n").when(form == 2, "0").when(form == 3, "y")
        .when(form == 4, "maybe").otherwise("").alias("business_text"),
        F.when(zone == 0, F.concat(clock, F.lit("Z")))
        .when(zone == 1, F.concat(clock, F.lit("-07:00")))
        .when(zone == 2, F.concat(clock, F.lit("+05:30")))
        .otherwise(F.replace(clock, F.lit("T"), F.lit(" "))).alias("purchase_text"),
        F.when(F.col("l_partkey") % 13 == 0, " ")
        .otherwise(F.concat(F.lit("sku-"), F.col("l_partkey").cast("string"))).alias("sku_text"),
        F.when(F.col("l_orderkey") % 17 == 0, "")
        .otherwise(F.col("l_orderkey").cast("string")).alias("order_text"),
    )


def source_paths(spark: SparkSession, folder: str) -> DataFrame:
    """One file path per store code and month of the orders, in three naming styles."""
    code = F.element_at(
        F.array(*[F.lit(c) for c in ("JQ", "MT", "RKZ", "SY")]), (F.col("o_custkey") % 4 + 1).cast("int")
    )
    month = F.add_months(F.trunc("o_orderdate", "month"), 324)
    style = F.month("month") % 3
    name = (
        F.when(style == 0, F.concat("code", F.lit("-"), F.date_format("month", "yyyy-MM")))
        .when(style == 1, F.concat("code", F.date_format("month", "yyMM"), F.lit("-note")))
        .otherwise(F.concat(F.lit("orders "), F.date_format("month", "yyyyMM")))
    )
    named = star.table(spark, folder, "orders").select(code.alias("code"), month.alias("month")).distinct()
    return named.withColumn("path", F.concat(F.lit("/landing/"), "code", F.lit("/"), name, F.lit(".txt")))


def performance_pages(spark: SparkSession, folder: str) -> DataFrame:
    """API pages of at most 50 products each; some products come again on a later page."""
    perf = star.performance_monthly(star.order_lines(spark, folder))
    part = F.regexp_extract("msku", r"(\d+)$", 1).cast("bigint")
    sid = (F.array_position(F.array(*[F.lit(s) for s in STORES]), F.col("store_name")) + 100).cast("bigint")
    rows = perf.withColumns({"part": part, "sid": sid})
    again = F.when(F.col("part") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.withColumn("again", F.explode(again)).withColumn(
        "page", (F.floor(F.col("part") / 50) + F.col("again") * 100000).cast("int")
    )
    key = F.col("msku")
    own = F.struct(
        F.col("sid").alias("sid"), F.concat(F.lit(" "), key).alias("seller_sku"),
        F.concat(F.lit("L"), F.col("part").cast("string")).alias("local_sku"), F.lit("US").alias("country"),
    )
    other = F.struct(
        F.lit(999).cast("bigint").alias("sid"), F.lit("OTHER").alias("seller_sku"),
        F.lit("X").alias("local_sku"), F.lit("CA").alias("country"),
    )
    nothing = F.struct(
        F.col("sid").alias("sid"), F.lit("").alias("seller_sku"), F.lit("").alias("local_sku"),
        F.lit("US").alias("country"),
    )
    kind = F.col("part") % 3
    item = F.struct(
        F.when(kind == 0, F.array(other, own)).when(kind == 1, F.array(own)).otherwise(F.array(nothing))
        .alias("price_list"),
        F.struct(F.concat(F.lit("B"), F.col("part").cast("string")).alias("asin")).alias("asins"),
        F.when(F.col("part") % 11 != 0, key).alias("msku"),
        F.concat(F.lit("S"), F.col("part").cast("string")).alias("sku"),
        F.concat(F.lit("P"), (F.col("part") % 10).cast("string")).alias("parent_asin"),
        F.concat((F.col("volume") + F.col("again")).cast("string"), F.lit(".9")).alias("volume"),
        F.col("order_items").cast("string").alias("order_items"),
        F.col("amount").cast("string").alias("amount"),
        F.when(F.col("part") % 5 == 0, "n/a").otherwise(F.col("promotion_order_items").cast("string"))
        .alias("promotion_order_items"),
        F.col("ad_order_quantity").alias("ad_order_quantity"),
        F.lit("USD").alias("currency_code"),
        F.col("part").alias("_order"),
    )
    # At most 50 part numbers fall on a page.
    pages = rows.groupBy("report_month", "sid", "store_name", "page").agg(
        F.sort_array(F.collect_list(F.struct("part", item.alias("item")))).alias("items")
    )
    items = F.transform("items", lambda x: x["item"].dropFields("_order"))
    listed = F.to_json(F.struct(
        F.lit("0").alias("code"),
        F.struct(F.size("items").alias("total"), items.alias("list")).alias("data"),
    ))
    # Pages count from 1. The first page fails in two months of the year, the second is lost in another.
    number = F.row_number().over(Window.partitionBy("report_month", "sid").orderBy("page"))
    pages = pages.withColumn("page", number)
    failed = F.lit('{"code":"500","data":{"list":[{"msku":"BAD"}]}}')
    month = F.month("report_month")
    body = F.when((month % 5 == 0) & (F.col("page") == 1), failed).otherwise(listed)
    landed = pages.filter(~((month % 7 == 0) & (F.col("page") == 2)))
    return landed.select("report_month", "sid", "store_name", "page", body.alias("body"))


def _write_text(report: DataFrame, root: str) -> None:
    """Tab-separated text below a folder per store; values with a line break are quoted."""
    # A file per store is open at a time, so that the rows of a task need no sort by store.
    with lean(report.sparkSession, {OPEN_FILES_CONF: len(STORES)}):
        (
            report.write.partitionBy("store").option("sep", "\t").option("header", True)
            .option("quote", '"').option("escape", '"').option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("extension", "txt").csv(root)
        )


def _strict_report(lines: DataFrame, order_id: Column) -> DataFrame:
    values = {
        "amazon-order-id": order_id,
        "purchase-date": F.concat(F.date_format("purchase_date_utc", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")),
        "order-status": F.col("order_status"), "sales-channel": F.col("sales_channel"), "sku": F.col("sku"),
        "item-status": F.col("item_status"), "quantity": F.col("quantity").cast("string"),
        "currency": F.col("currency"), "item-price": F.col("item_price").cast("string"),
        "item-promotion-discount": F.col("item_promotion_discount").cast("string"),
        "promotion-ids": F.col("promotion_ids"),
        "order-item-id": F.concat_ws("-", "order_item_id", "l_partkey", "l_suppkey", "item_price", "quantity"),
    }
    more = {"product-name": F.col("name")} if "name" in lines.columns else {}
    return lines.select(
        F.replace("store_name", F.lit(" "), F.lit("_")).alias("store"),
        *[{**values, **more}.get(h, F.lit("")).alias(h) for h in ORDER_HEADERS],
    )


def write_reports(spark: SparkSession, folder: str) -> str:
    """Strict order reports of the order lines, one folder per store; returns the root folder."""
    root = f"{scratch_root(spark)}/reports-{uuid.uuid4().hex}"
    _write_text(_strict_report(star.order_lines(spark, folder), F.col("amazon_order_id")), root)
    return root


def _by_store(report: DataFrame, stores: list[str], store: Column | None = None) -> DataFrame:
    """The lines of each store in a task of their own, so that no two stores share one by the hash of their names."""
    place = F.array_position(F.array(*[F.lit(s.replace(" ", "_")) for s in stores]), F.col("store") if store is None else store) - 1
    # Other stores, or none, go with the last.
    return report.repartitionById(len(stores), F.coalesce(F.when(place >= 0, place), F.lit(len(stores) - 1)).cast("int"))


def write_bad_reports(spark: SparkSession, folder: str) -> str:
    """The same with one file per store; lines of one store lack their order id now and then."""
    lines = star.order_lines(spark, folder)
    bad = (F.col("store_name") == "ASIA-US") & (F.col("l_partkey") % 97 == 0)
    root = f"{scratch_root(spark)}/bad-reports-{uuid.uuid4().hex}"
    # Order lines are moved to their store's task; the report, which is wider, is made there.
    lines = _by_store(lines.withColumn("_bad", bad), STORES, F.replace("store_name", F.lit(" "), F.lit("_")))
    _write_text(_strict_report(lines, F.when(F.col("_bad"), "").otherwise(F.col("amazon_order_id"))), root)
    return root


def write_monthly(spark: SparkSession, folder: str, first_lines_only: bool = False) -> dict[str, str]:
    """A cumulative file per store, all lines moved into one month; file path by store name.

    Lines stand in a fixed order and have no item id; some promotion texts hold a line break.
    ``first_lines_only`` is the earlier delivery of the same month.
    """
    lines = star.order_lines(spark, folder)
    if first_lines_only:
        lines = lines.filter("l_linenumber = 1")
    report, order = _monthly_report(lines)
    report = _by_store(report, STORES).sortWithinPartitions("store", *order)
    root = f"{scratch_root(spark)}/monthly-{uuid.uuid4().hex}"
    _write_text(report, root)
    return _paths_by_store(spark, root)


def _monthly_report(lines: DataFrame, quoted: bool = False, year: int = 1996) -> tuple[DataFrame, list[Column]]:
    """The columns of a monthly file, and the order its lines stand in."""
    key = F.col("amazon_order_id").cast("bigint")
    at = F.make_timestamp_ntz(
        F.lit(year), F.lit(5), (key % 28 + 2).cast("int"), (key % 24).cast("int"), F.lit(0), F.lit(0)
    )
    promotion = quoted_form(key, F.col("promotion_ids")) if quoted else F.replace("promotion_ids", F.lit(" "), F.lit("\n"))
    report = lines.select(
        F.replace("store_name", F.lit(" "), F.lit("_")).alias("store"),
        F.col("amazon_order_id").alias("Amazon Order-ID"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("purchase_date_utc"),
        F.trim("sku").alias("Seller SKU"), F.col("quantity").cast("string").alias("quantity"),
        F.col("item_price").cast("decimal(18,2)").cast("string").alias("item-price"),
        promotion.alias("promotion ids"), "order_status", "currency",
    )
    order = [F.col("Amazon Order-ID").cast("bigint"), *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in report.columns[2:]]]
    return report, order


def _paths_by_store(spark: SparkSession, root: str) -> dict[str, str]:
    # One file per store of the list above.
    names = {f"store={s.replace(' ', '_')}": s for s in STORES}
    return {names[unquote(f).split("/")[-2]]: unquote(f) for f in spark.read.text(root).inputFiles()}


#: Codes of monthly file names; every store of the tables is one of these.
CODES = {"AFRICA-US": "JQ", "AMERICA-US": "MT", "ASIA-US": "RKZ", "EUROPE-US": "SY", "MIDDLE EAST-US": "SY"}


def land_deliveries(spark: SparkSession, folder: str, land: str, first_lines_only: bool, day: int, codes: list[str]) -> None:
    """Monthly files of 2026-05 under the names they are delivered by, modified on ``day`` of the month after."""
    lines = star.order_lines(spark, folder)
    if first_lines_only:
        lines = lines.filter("l_linenumber = 1")
    code = F.element_at(F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair]), F.col("store_name"))
    report, order = _monthly_report(lines.withColumn("store_name", code).filter(F.col("store_name").isin(codes)), year=2026)
    root = f"{scratch_root(spark)}/delivery-{uuid.uuid4().hex}"
    _write_text(_by_store(report, codes).sortWithinPartitions("store", *order), root)
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    at = int(dt.datetime(2026, 6, day, tzinfo=dt.timezone.utc).timestamp() * 1000)
    # One file per code of the list above.
    for name in spark.read.text(root).inputFiles():
        given = jvm.org.apache.hadoop.fs.Path(unquote(name))
        landed = jvm.org.apache.hadoop.fs.Path(f"{land}/{given.getParent().getName().split('=')[1]}2605-{day:02d}.txt")
        system = landed.getFileSystem(settings)
        jvm.org.apache.hadoop.fs.FileUtil.copy(given.getFileSystem(settings), given, system, landed, True, settings)
        system.setTimes(landed, at, -1)


def quoted_form(key: Column, plain: Column) -> Column:
    """Report text in every form a quote comes in: inch mark, quoted break, doubled quotes, text after the end, none."""
    at = key % 6
    return (
        F.when(at == 0, F.concat(F.lit('Screen 5" '), key.cast("string")))
        .when(at == 1, F.concat(F.lit('"two\nlines\t'), key.cast("string"), F.lit('"')))
        .when(at == 2, '"a ""b""\n\nc"').when(at == 3, '"end" of 7"').when(at == 4, "").otherwise(F.coalesce(plain, F.lit("")))
    )


def _write_lines(report: DataFrame, order: list[Column], root: str) -> None:
    """Raw tab-separated text, one file for each value of ``store``: a header line, then the rows in order."""
    header = "\t".join(report.columns[1:])
    line = F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in report.columns[1:]])
    rows = report.select("store", F.struct(F.lit(1).alias("at"), *[o.alias(f"k{i}") for i, o in enumerate(order)]).alias("place"), line.alias("line"))
    # A null place comes first.
    none = F.lit(None).cast(rows.schema["place"].dataType)
    rows = rows.unionByName(rows.select("store").distinct().select("store", none.alias("place"), F.lit(header).alias("line")))
    rows = rows.repartition("store").sortWithinPartitions("store", F.col("place").asc_nulls_first())
    with lean(report.sparkSession):
        rows.select("store", "line").write.partitionBy("store").text(root)


def write_quoted_reports(spark: SparkSession, folder: str) -> str:
    """Strict reports whose product names hold quotes and line breaks, eight files a store."""
    lines = star.order_lines(spark, folder)
    key = F.col("l_partkey")
    report = _strict_report(lines.withColumn("name", quoted_form(key, F.lit("plain"))), F.col("amazon_order_id"))
    report = report.withColumns({"store": F.concat("store", F.lit("-"), (F.col("order-item-id").substr(1, 1)))})
    root = f"{scratch_root(spark)}/quoted-{uuid.uuid4().hex}"
    _write_lines(report.select("store", *ORDER_HEADERS), [F.col("amazon-order-id"), F.col("order-item-id")], root)
    return root


def write_quoted_monthly(spark: SparkSession, folder: str) -> dict[str, str]:
    """The monthly files with quotes in every form in their promotion texts; file path by store name."""
    report, order = _monthly_report(star.order_lines(spark, folder), quoted=True)
    root = f"{scratch_root(spark)}/monthly-{uuid.uuid4().hex}"
    _write_lines(report, order, root)
    return _paths_by_store(spark, root)
