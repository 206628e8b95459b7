"""Every registered query. Each takes (spark, folder) and runs over the whole tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import derived
from merchlens.functions import convert
from merchlens.operators import (
    allocate, audit, base, classify, deal_price, demand, rollup, source_report,
)
from merchlens.plans import attribution, order_import, performance_import, reports
from merchlens.rules import RULES
from merchlens.scope import Scope, scope_summary
from merchlens.session import lean, materialize, scratch_root
from merchlens.sources import files, order_files, performance_pages
from merchlens.sources import star_tables as star
from merchlens.sources.warehouse import Warehouse
from merchlens.streaming.ingest import DELIVERY_TABLE, stream_monthly_orders, stream_strict_orders

Query = Callable[[SparkSession, str], DataFrame]

SCOPE = Scope.of("1994-12-01", "2002-01-01")
TODAY = dt.date(2001, 8, 3)
REPORT_MONTH = dt.date(1996, 5, 1)
R = {name: rules.with_low_price(star.LOW_PRICE) for name, rules in RULES.items()}
# The 7 USD generation against the 10 USD one, on the prices of these tables.
R["v4"] = RULES["v4"].with_low_price("700")

QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand over the same type."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, folder: comparable(build(spark, folder))
    return build


# --- shared inputs -----------------------------------------------------------

def _stored_lines(spark, folder):
    """The valid lines of the raw order table, written once where a query reads no others and reads them more than once."""
    return materialize(base.valid_orders(star.order_lines(spark, folder)), "order-lines")


def _stored_demand(lines):
    """Daily demand, written once with the columns that allocation and its audit read."""
    return materialize(_demand_daily(lines).select(
        "store_name", "order_month", "report_date", "sku_key", "sp_orders", "sd_orders", "ad_orders_raw"
    ), "demand")


def _stored_targets(lines):
    """Monthly targets, a row per store and month: once they are stored, a join with them leaves the other side where it is."""
    return materialize(_demand_monthly(lines).select("store_name", "order_month", "ad_order_quantity"), "demand")


def _base(spark, folder):
    return star.base(star.order_lines(spark, folder))


def _demand_monthly(lines):
    return demand.ad_demand_monthly(star.performance_monthly(lines))


def _demand_daily(lines):
    return demand.ad_demand_daily(star.ad_spend_daily(lines))


def _result(spark, folder, name):
    lines = _stored_lines(spark, folder)
    valid, rules = star.base(lines), R[name]
    if rules.allocator == "store_month":
        chosen = allocate.allocate_store_month(valid, _stored_targets(lines), rules.version)
    elif rules.allocator == "hybrid":
        chosen = allocate.allocate_hybrid(valid, _stored_demand(lines), rules.version)
    else:
        chosen = allocate.allocate_day_sku(valid, _demand_daily(lines), rules.version)
    return classify.classify(valid, chosen, rules)


def _monthly(spark, folder, name):
    return rollup.source_monthly(_result(spark, folder, name), R[name])


def _stored_monthly(spark, folder, name="v5"):
    """Reports read a stored rollup, not the attribution behind it."""
    return materialize(_monthly(spark, folder, name), "monthly")


def _mapped(spark, folder):
    msku = deal_price.msku_month(star.order_lines(spark, folder), SCOPE)
    listing = deal_price.best_listing(star.listing(spark, folder))
    dims = deal_price.product_dims(star.product_snapshot(spark, folder))
    return materialize(deal_price.map_styles(msku, listing, dims), "mapped-msku")


# --- valid lines and base ------------------------------------------------------

@query
def valid_orders(spark, folder):
    return base.valid_orders(star.order_lines(spark, folder), SCOPE)


@query
def order_base(spark, folder):
    return base.order_base(star.order_lines(spark, folder), SCOPE, star.LOW_PRICE).drop("source_id", "asin")


@query
def promo_flags(spark, folder):
    flags = ("offsite_flag", "shipping_promotion_flag", "onsite_promotion_flag", "low_price_candidate_flag")
    return _base(spark, folder).groupBy(*flags).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"),
        F.sum("net_item_sales").alias("net_item_sales"),
    )


@query
def scope_inference(spark, folder):
    return scope_summary(_base(spark, folder))


# --- demand and allocation ----------------------------------------------------

@query
def ad_demand_daily(spark, folder):
    return _demand_daily(star.order_lines(spark, folder))


@query
def ad_demand_monthly(spark, folder):
    return _demand_monthly(star.order_lines(spark, folder))


@query
def order_sku_candidates(spark, folder):
    return allocate.order_sku_candidates(_base(spark, folder))


def _day_inputs(spark, folder):
    lines = _stored_lines(spark, folder)
    return star.base(lines), _stored_demand(lines)


def _month_inputs(spark, folder):
    lines = _stored_lines(spark, folder)
    return star.base(lines), _demand_monthly(lines)


@query
def day_sku_rank(spark, folder):
    return allocate.day_sku_rank(*_day_inputs(spark, folder))


@query
def ad_alloc_day_sku(spark, folder):
    return allocate.allocate_day_sku(*_day_inputs(spark, folder))


@query
def ad_alloc_store_month(spark, folder):
    return allocate.allocate_store_month(*_month_inputs(spark, folder))


@query
def ad_alloc_store_month_sorted(spark, folder):
    return allocate.allocate_store_month(*_month_inputs(spark, folder), method="sorted")


@query
def ad_alloc_hybrid(spark, folder):
    return allocate.allocate_hybrid(*_day_inputs(spark, folder))


@query
def ad_alloc_hybrid_sorted(spark, folder):
    return allocate.allocate_hybrid(*_day_inputs(spark, folder), store_method="sorted")


# --- classification and rollup -----------------------------------------------

def _shown(result):
    return result.drop("source_id", "asin")


@query
def classify_day_sku(spark, folder):
    return _shown(_result(spark, folder, "v1"))


@query
def classify_hybrid(spark, folder):
    return _shown(_result(spark, folder, "v2"))


@query
def classify_exclusive_10(spark, folder):
    return _shown(_result(spark, folder, "v3"))


@query
def classify_exclusive_7(spark, folder):
    return _shown(classify.reclassify(_result(spark, folder, "v3"), R["v4"]))


@query
def classify_v5(spark, folder):
    return _shown(_result(spark, folder, "v5"))


@query
def reclassify_v5(spark, folder):
    return _shown(classify.reclassify(_result(spark, folder, "v3"), R["v5"]))


@query
def source_monthly_v1(spark, folder):
    return _monthly(spark, folder, "v1")


@query
def source_monthly_v2(spark, folder):
    return _monthly(spark, folder, "v2")


@query
def source_monthly_v3(spark, folder):
    return _monthly(spark, folder, "v3")


@query
def source_monthly_v5(spark, folder):
    return _monthly(spark, folder, "v5")


@query
def month_share(spark, folder):
    return rollup.month_share(_stored_monthly(spark, folder, "v3"))


@query
def source_summary(spark, folder):
    return rollup.source_summary(_stored_monthly(spark, folder), SCOPE)


@query
def rule_version_check(spark, folder):
    return rollup.rule_version_check(_result(spark, folder, "v5"))


# --- audits -----------------------------------------------------------------------

def _audit(spark, folder):
    valid, target = _month_inputs(spark, folder)
    target = materialize(target, "demand")
    return audit.allocation_audit(target, valid, allocate.allocate_store_month(valid, target))


@query
def alloc_audit(spark, folder):
    return _audit(spark, folder)


@query
def audit_status(spark, folder):
    return audit.audit_report(_audit(spark, folder))


@query
def hybrid_audit(spark, folder):
    valid, target = _day_inputs(spark, folder)
    return audit.hybrid_audit(target, allocate.allocate_hybrid(valid, target))


# --- source reports ----------------------------------------------------------------

@query
def report_overall(spark, folder):
    return source_report.report_overall(_stored_monthly(spark, folder), SCOPE)


@query
def report_month(spark, folder):
    return source_report.report_month(_stored_monthly(spark, folder), SCOPE)


@query
def report_quarter(spark, folder):
    return source_report.report_quarter(_stored_monthly(spark, folder), SCOPE)


@query
def report_quarter_partial(spark, folder):
    return source_report.report_quarter(_stored_monthly(spark, folder), SCOPE, include_partial=True)


@query
def report_half(spark, folder):
    return source_report.report_half(_stored_monthly(spark, folder), SCOPE, include_partial=True)


@query
def report_store_month(spark, folder):
    return source_report.report_store_month(_stored_monthly(spark, folder), SCOPE)


# --- deal price ---------------------------------------------------------------------

@query
def msku_month(spark, folder):
    return deal_price.msku_month(star.order_lines(spark, folder), SCOPE)


@query
def listing_best(spark, folder):
    return deal_price.best_listing(star.listing(spark, folder))


@query
def product_dims(spark, folder):
    return deal_price.product_dims(star.product_snapshot(spark, folder))


@query
def deal_price_long(spark, folder):
    return deal_price.deal_price_long(_mapped(spark, folder))


@query
def deal_price_wide(spark, folder):
    return deal_price.deal_price_wide(_mapped(spark, folder), SCOPE.months)


@query
def deal_price_by_store(spark, folder):
    return deal_price.deal_price_by_store(_mapped(spark, folder), SCOPE.months, "america-us ")


@query
def mapping_audit(spark, folder):
    return deal_price.mapping_audit(_mapped(spark, folder))


@query
def month_coverage(spark, folder):
    msku = deal_price.msku_month(star.order_lines(spark, folder), SCOPE)
    return deal_price.month_coverage(msku, SCOPE, TODAY)


# --- order import -------------------------------------------------------------------

@query
def typed_values(spark, folder):
    return derived.report_text(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        convert.to_int("quantity_text").alias("strict_quantity"),
        convert.to_int_lenient("quantity_text").alias("lenient_quantity"),
        convert.to_decimal("price_text").alias("price"),
        convert.to_decimal_lenient("quantity_text").alias("quantity_decimal"),
        convert.to_bool("business_text").alias("is_business"),
        convert.to_utc("purchase_text").alias("purchase_date_utc"),
    )


@query
def row_acceptance(spark, folder):
    # Read into columns first: both lists of reasons look at them.
    rows = derived.report_text(spark, folder).withColumns({
        "date": convert.to_utc("purchase_text"), "quantity": convert.to_int_lenient("quantity_text"),
    })

    def reasons(keep_zero):
        return order_files.row_rejects(
            F.col("quantity_text"), F.col("quantity"), F.col("date"), F.trim("order_text"), F.trim("sku_text"), keep_zero
        )

    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.array_join(reasons(True), "; ").alias("rejects"),
        (F.size(reasons(False)) == 0).alias("accepted_without_zero"),
    )


def _text_values():
    return {
        "amazon_order_id": F.trim("order_text"), "sku": F.trim("sku_text"), "asin": F.lit(None).cast("string"),
        "purchase_date": F.trim("purchase_text"), "quantity": F.trim("quantity_text"),
        "item_price": F.trim("price_text"),
    }


@query
def synthetic_item_ids(spark, folder):
    row_no = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return derived.report_text(spark, folder).select(
        order_files.synthetic_item_id(
            F.lit("SY-US"), F.lit(REPORT_MONTH), row_no, _text_values()
        ).alias("order_item_id")
    )


@query
def source_hash(spark, folder):
    return derived.report_text(spark, folder).select(
        order_files.source_hash(F.lit("SY-US"), _text_values()).alias("source_hash")
    )


@query
def month_purity(spark, folder):
    return order_files.month_purity(star.order_lines(spark, folder), REPORT_MONTH)


@query
def duplicate_items(spark, folder):
    return order_files.duplicate_items(star.order_lines(spark, folder))


@query
def load_audit(spark, folder):
    return order_files.load_audit(star.order_lines(spark, folder))


@query
def upsert_orders(spark, folder):
    rows = star.order_lines(spark, folder).select(
        "store_name", "amazon_order_id", "order_item_id", "quantity", "item_price",
        F.concat(F.lit("b"), (F.col("l_partkey") % 3).cast("string")).alias("import_batch_no"),
        F.concat(F.lit("f"), (F.col("l_suppkey") % 2).cast("string")).alias("source_file"),
        ((F.col("item_price") * 100).cast("bigint") * 100000 + F.col("quantity")).alias("source_row_no"),
    )
    return order_import.last_per_item(rows)


@query
def file_names(spark, folder):
    path = F.col("path")
    prefixes = {"JQ": "JQ-US", "MT": "MT-US", "RKZ": "RKZ-US", "S": "S-US", "SY": "SY-US"}
    named = files.monthly_name(path)
    return derived.source_paths(spark, folder).select(
        "path", files.store_from_name(path, prefixes).alias("store_name"),
        files.month_from_name(path).alias("report_month"),
        named["store_name"].alias("monthly_store"), named["report_month"].alias("monthly_month"),
        files.batch_number(
            F.col("code"), F.col("month"), F.sha2("path", 256), "20250101000000"
        ).alias("import_batch_no"),
    )


@query
def skip_imported(spark, folder):
    paths = derived.source_paths(spark, folder)
    hashed = paths.select(
        "path", F.col("code").alias("store_name"), F.sha2("path", 256).alias("source_file_sha256"), "month"
    )
    log = hashed.select(
        F.lit(order_import.ORDERS_TABLE).alias("target_table"), "store_name", "source_file_sha256",
        F.when(F.month("month") <= 4, "success").when(F.month("month") <= 6, "failed").alias("status"),
    )
    return order_import.not_yet_imported(hashed, log).select("path", "store_name")


IMPORTED = [
    "store_name", "amazon_order_id", "order_item_id", "purchase_date_utc", "sales_channel", "order_status",
    "item_status", "sku", "quantity", "currency", "item_price", "item_promotion_discount", "promotion_ids",
]
STORE_FOLDERS = {f"STORE={s.replace(' ', '_')}": s for s in derived.STORES}


@query
def ingest_orders(spark, folder):
    """Reports written as files, imported strictly, and read back from the order table."""
    root = derived.write_reports(spark, folder)
    warehouse = Warehouse(spark, f"{root}-warehouse")
    order_import.import_strict(warehouse, root, STORE_FOLDERS)
    return warehouse.read(order_import.ORDERS_TABLE).select(*IMPORTED)


@query
def ingest_orders_stream(spark, folder):
    """The same through the incremental ingest."""
    root = derived.write_reports(spark, folder)
    warehouse = Warehouse(spark, f"{root}-warehouse")
    stream = stream_strict_orders(warehouse, root, f"{root}-progress", STORE_FOLDERS, max_files=20)
    stream.awaitTermination()
    return warehouse.read(order_import.ORDERS_TABLE).select(*IMPORTED)


# --- product performance ---------------------------------------------------------------

def _parsed(spark, folder):
    landed = materialize(derived.performance_pages(spark, folder), "pages")
    # Read more than once below; a filter on the problem would parse each page again.
    return materialize(performance_pages.parse_pages(landed), "parsed-pages")


def _flat(spark, folder):
    parsed = _parsed(spark, folder)
    flat = materialize(performance_pages.flatten_rows(performance_pages.explode_rows(parsed), TODAY), "flat-rows")
    return performance_pages.whole_months(flat, performance_pages.month_states(parsed, flat))


@query
def performance_rows(spark, folder):
    return performance_pages.last_per_msku(_flat(spark, folder)).select(
        "report_month", "period_start", "period_end", "sid", "store_name", "country", "msku", "sku", "asin",
        "parent_asin", "volume", "order_items", "amount", "promotion_order_items", "ad_order_quantity",
        "clicks", "currency_code",
    )


@query
def performance_load_stats(spark, folder):
    parsed = _parsed(spark, folder)
    flat = materialize(performance_pages.flatten_rows(performance_pages.explode_rows(parsed), TODAY), "flat-rows")
    states = performance_pages.month_states(parsed, flat)
    written = performance_pages.last_per_msku(performance_pages.whole_months(flat, states))
    return performance_pages.load_stats(states, written)


@query
def pending_tasks(spark, folder):
    performance = materialize(star.performance_monthly(star.order_lines(spark, folder)), "performance")
    stores = performance.select("store_name").distinct().withColumn("sid", F.length("store_name").cast("bigint"))
    log = performance.select(
        "report_month", F.length("store_name").cast("bigint").alias("sid"),
        F.when(F.month("report_month") % 2 == 0, "SUCCESS").otherwise("FAILED").alias("status"),
    )
    return performance_pages.pending_tasks(stores, SCOPE.months, log)


@query
def unknown_stores(spark, folder):
    wanted = star.table(spark, folder, "customer").select(
        F.concat(F.lower("c_mktsegment"), F.lit("-us")).alias("store_name")
    ).distinct().unionByName(
        star.table(spark, folder, "region").select(F.concat(F.lower("r_name"), F.lit("-us")).alias("store_name"))
    )
    known = star.order_lines(spark, folder).select("store_name").distinct()
    return performance_pages.unknown_stores(wanted, known)


# --- jobs over a warehouse ---------------------------------------------------------------

def _warehouse(spark):
    return Warehouse(spark, f"{scratch_root(spark)}/warehouse-{uuid.uuid4().hex}")


def _mixed_case(lines):
    """Store names in two spellings."""
    name = F.when(F.col("l_partkey") % 2 == 0, F.lower("store_name")).otherwise(F.col("store_name"))
    return lines.withColumn("store_name", name)


@query
def scoped_source_monthly(spark, folder):
    """Two stores of a list typed in another case than most order lines have."""
    scope = Scope.of("1994-12-01", "2002-01-01", "ASIA-US, europe-us")
    lines = materialize(_mixed_case(star.order_lines(spark, folder)), "order-lines")
    valid = base.order_base(lines, scope, star.LOW_PRICE)
    wanted = demand.ad_demand_monthly(star.performance_monthly(star.order_lines(spark, folder)), scope)
    chosen = allocate.allocate_store_month(valid, wanted, R["v5"].version)
    return rollup.source_monthly(classify.classify(valid, chosen, R["v5"]), R["v5"])


@query
def default_scope_ads(spark, folder):
    """Months and stores of the ad rows, whose types and stores come in both cases."""
    warehouse = _warehouse(spark)
    ads = star.ad_spend_daily(star.order_lines(spark, folder)).withColumns({
        "ad_type": F.when(F.col("clicks") % 2 == 0, F.lower("ad_type")).otherwise(F.col("ad_type")),
        "store_name": F.when(F.col("clicks") % 3 == 0, F.lower("store_name")).otherwise(F.col("store_name")),
    })
    warehouse.append(attribution.AD_SPEND, ads)
    scope = attribution.default_scope(warehouse, R["v2"])
    row = (scope.start, scope.end, ",".join(s.upper() for s in scope.stores))
    return spark.createDataFrame([row], "start_month date, end_month_exclusive date, stores string")


@query
def sheets_written(spark, folder):
    """A report sheet written with its titles and read back."""
    root = f"{scratch_root(spark)}/sheets-{uuid.uuid4().hex}"
    reports.write_sheets({"月度汇总": source_report.report_month(_stored_monthly(spark, folder), SCOPE)}, root, "parquet")
    names = {"月份": "month", "来源类型": "main_order_type", "订单-SKU数": "order_sku_count", "销量": "units"}
    return spark.read.parquet(f"{root}/月度汇总").select(*[F.col(f"`{k}`").alias(v) for k, v in names.items()])


def _imported_bad(spark, folder):
    root = derived.write_bad_reports(spark, folder)
    warehouse = Warehouse(spark, f"{root}-warehouse")
    order_import.import_strict(
        warehouse, root, {k.lower(): v for k, v in STORE_FOLDERS.items()}, raise_bad=False
    )
    return warehouse


@query
def import_log(spark, folder):
    """One file has bad rows: it is logged as failed, the others are loaded."""
    warehouse = _imported_bad(spark, folder)
    stored = warehouse.read(order_import.ORDERS_TABLE).groupBy("store_name").agg(F.count(F.lit(1)).alias("stored_rows"))
    return warehouse.read(order_import.LOG_TABLE).join(stored, "store_name", "left").select(
        "store_name", "status", "total_rows", F.coalesce("stored_rows", F.lit(0)).alias("stored_rows")
    )


@query
def import_rejects(spark, folder):
    """Every refused row, by file folder and reason."""
    root = derived.write_bad_reports(spark, folder)
    return order_import.strict_rejects(spark, f"{root}/*").groupBy(
        files.parent_name(F.col("path")).alias("folder"), F.array_join("reject_reasons", "; ").alias("reasons")
    ).agg(F.count(F.lit(1)).alias("rejected"), F.count_distinct("source_row_no").alias("places"))


def _monthly_runs(spark, folder, apply):
    """Cumulative files of every store, five at most; one store's month was delivered before."""
    warehouse = _warehouse(spark)
    early = derived.write_monthly(spark, folder, first_lines_only=True)

    def deliver(path, store, apply=True):
        return order_import.import_monthly(
            warehouse, path, apply=apply, replace_month=True, store=store, month="1996-05"
        )

    deliver(early["ASIA-US"], "ASIA-US")
    return warehouse, [deliver(p, s, apply) for s, p in derived.write_monthly(spark, folder).items()]


@query
def ingest_monthly(spark, folder):
    """Quoted line breaks, other header names, no item ids, and a month delivered twice."""
    warehouse, _ = _monthly_runs(spark, folder, apply=True)
    return warehouse.read(order_import.ORDERS_TABLE).select(
        "store_name", "report_month", "source_row_no", "amazon_order_id", "order_item_id", "purchase_date_utc",
        "sku", "quantity", "item_price", "promotion_ids", "order_status", "currency",
    )


@query
def monthly_deliveries(spark, folder):
    """Streamed months: two stores deliver again, in the other two the older delivery lands last and is set aside."""
    warehouse = _warehouse(spark)
    land = f"{warehouse.root}-land"
    for first, day, codes in ((False, 9, ["JQ", "SY"]), (True, 5, ["JQ", "MT", "RKZ", "SY"]), (False, 9, ["MT", "RKZ"])):
        derived.land_deliveries(spark, folder, land, first, day, codes)
        stream_monthly_orders(warehouse, land, f"{warehouse.root}-progress").awaitTermination()
    loaded = warehouse.read(DELIVERY_TABLE).groupBy("store_name").agg(
        F.count(F.lit(1)).alias("deliveries"), F.dayofmonth(F.max("delivered_at")).alias("day")
    )
    return warehouse.read(order_import.ORDERS_TABLE).join(loaded, "store_name").select(
        "store_name", "deliveries", "day", "report_month", "source_row_no", "amazon_order_id", "purchase_date_utc", "sku",
        "quantity", "item_price", "promotion_ids",
    )


@query
def strict_quotes(spark, folder):
    """Strict reports whose product names hold inch marks, doubled quotes, tabs and line breaks."""
    root = derived.write_quoted_reports(spark, folder)
    warehouse = Warehouse(spark, f"{root}-warehouse")
    order_import.import_strict(warehouse, root, STORE_FOLDERS)
    return warehouse.read(order_import.ORDERS_TABLE).select(*IMPORTED, "product_name")


@query
def monthly_quotes(spark, folder):
    """Monthly files with quotes in every form: the rows, their numbers and their texts."""
    warehouse = _warehouse(spark)
    for store, path in derived.write_quoted_monthly(spark, folder).items():
        order_import.import_monthly(warehouse, path, apply=True, replace_month=True, store=store, month="1996-05")
    return warehouse.read(order_import.ORDERS_TABLE).select(
        "store_name", "source_row_no", "amazon_order_id", "order_item_id", "purchase_date_utc", "sku", "quantity",
        "item_price", "promotion_ids", "order_status", "currency",
    )


@query
def monthly_precheck(spark, folder):
    """Counts stated without a write: rows of the file, rows it would replace, rows of no quantity."""
    _, outcomes = _monthly_runs(spark, folder, apply=False)
    rows = [(o.store_name, o.input_rows, o.old_rows, o.zero_quantity_rows, o.applied) for o in outcomes]
    return spark.createDataFrame(
        rows, "store_name string, input_rows bigint, old_rows bigint, zero_rows bigint, applied boolean"
    )


def _performance_job(spark, folder):
    warehouse = _warehouse(spark)
    with lean(spark):
        landed = materialize(derived.performance_pages(spark, folder), "pages", "zstd")
    # The second run takes up the failed months only, and leaves the others as they are.
    for _ in range(2):
        performance_import.import_performance(warehouse, landed, TODAY)
    return warehouse


@query
def performance_import_rows(spark, folder):
    return _performance_job(spark, folder).read(performance_import.TABLE).select(
        "report_month", "period_start", "period_end", "sid", "store_name", "country", "msku", "sku", "asin",
        "parent_asin", "volume", "order_items", "amount", "promotion_order_items", "ad_order_quantity",
        "clicks", "currency_code",
    )


@query
def performance_import_log(spark, folder):
    return _performance_job(spark, folder).read(performance_import.LOG_TABLE).select(
        "report_month", "sid", "store_name", "interface_total", "fetched_rows", "written_rows", "status",
        "error_message",
    )
