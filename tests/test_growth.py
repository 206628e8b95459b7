"""Plans and costs that must not change with the size of a table."""

import datetime as dt
from inspect import signature

from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import orders_frame, report_line, rows_of, warehouse, write_report
from checks.queries import QUERIES
from merchlens.functions import convert
from merchlens.functions.text import same_text
from merchlens.operators import allocate, base, classify, ranking, rollup
from merchlens.operators import deal_price as dp
from merchlens.plans import order_import
from merchlens.rules import ONSITE, RULES
from merchlens.scope import Scope
from merchlens.sources import files
from merchlens.sources import performance_pages as pages
from merchlens.sources import star_tables as star

LISTING = "`店铺` string, `店铺id` string, `MSKU` string, `SKU` string, `负责人` string, `状态` int"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_listings_are_not_sent_whole_to_the_driver(spark):
    orders = orders_frame(spark, [dict(), dict(amazon_order_id="2", sku="gone")])
    listing = spark.createDataFrame([("SY-US", "S1", "sku-a", "L1", "P1", 1)], LISTING)
    products = spark.createDataFrame([("L1", "ST1", "s", "c")], "sku_key string, style_no string, season string, category string")
    msku = dp.msku_month(orders, Scope.of("2025-01-01", "2025-02-01"))
    mapped = dp.map_styles(msku, dp.best_listing(listing), products)
    joins = [line for line in plan_of(mapped).split("\n") if "Join" in line and "msku_key" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
    assert {(r.msku, r.local_sku) for r in mapped.collect()} == {("SKU-A", "L1"), ("GONE", "")}


def test_listings_of_one_file_of_parts_are_made_in_many_tasks(spark, tmp_path):
    spark.range(1, 2001).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    made = star.listing(spark, str(tmp_path))
    plan = plan_of(made)
    assert "Exchange" in plan and plan.index("Generate") < plan.index("Exchange")
    assert made.count() == sum(5 * (2 if k % 5 == 0 else 1) for k in range(1, 2001) if k % 23)


def test_numbering_lines_moves_only_counts(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.txt").write_text("one\ntwo\nthree\n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = files.text_lines(spark, str(tmp_path), "UTF-8", True)
        assert "SortMergeJoin" not in plan_of(numbered)
        assert sorted((r.source_row_no, r.line) for r in numbered.collect()) == [
            (1, "one"), (1, "one"), (2, "two"), (2, "two"), (3, "three"), (3, "three")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lines_of_records_are_read_once(spark, tmp_path):
    (tmp_path / "a.txt").write_text('h\tk\n1\t"two\nlines"\n\n2\t5" wide\n3\t"a ""b"" c" d\n')
    records = files.text_records(spark, str(tmp_path / "a.txt"), "UTF-8", "\t", False, 2)
    assert "Scan text" not in plan_of(records)
    got = records.withColumn("fields", files.fields_of(F.col("line"), "\t")).orderBy("source_row_no")
    assert [(r.source_row_no, r.fields) for r in got.collect()] == [
        (1, ["h", "k"]), (2, ["1", "two\nlines"]), (3, ["2", '5" wide']), (4, ["3", 'a "b" c d'])]


def test_fields_are_not_gathered_one_by_one(spark):
    plan = plan_of(spark.createDataFrame([('"a"\tb',)], "line string").select(
        files.fields_of(F.col("line"), "\t"), files.end_state(F.col("line"), "\t", True)))
    assert "aggregate(" not in plan


def test_refused_rows_are_checked_once(spark, tmp_path):
    path = write_report(tmp_path / "a.txt", [report_line(), report_line(amazon_order_id="")])
    rejects = order_import.strict_rejects(spark, path)
    assert "Scan text" not in plan_of(rejects)
    assert [(r.source_row_no, r.reject_reasons) for r in rejects.collect()] == [(3, ["amazon-order-id is empty"])]


def test_new_items_leave_stored_files_alone(spark, tmp_path):
    wh = warehouse(spark, tmp_path)

    def stored():
        return set(wh.read(order_import.ORDERS_TABLE).inputFiles())

    def put(*rows):
        order_import.upsert_orders(wh, orders_frame(spark, list(rows)))

    put(dict(), dict(amazon_order_id="2"))
    first = stored()
    put(dict(amazon_order_id="3"))
    assert first < stored()
    put(dict(amazon_order_id="3", quantity=7), dict(amazon_order_id="4"))
    assert rows_of(wh.read(order_import.ORDERS_TABLE), "amazon_order_id", "quantity") == [("1", 1), ("2", 1), ("3", 7), ("4", 1)]


def test_an_object_is_told_without_its_schema(spark):
    texts = ["{}", '{"a":1}', "[]", "[1]", "1", '"x"', "null", "true", '{"_":null}']
    given = spark.createDataFrame([(t,) for t in texts], "t string")
    told = given.select("t", pages._is_object(F.try_parse_json("t")).alias("is"))
    assert "schema" not in plan_of(told).lower()
    assert {r.t for r in told.collect() if r["is"]} == {"{}", '{"a":1}', '{"_":null}'}


def test_an_offset_is_read_once_and_never_cast_in_vain(spark):
    texts = {
        "2026-01-02T03:04:05-07:00": "2026-01-02 10:04:05", "2026-01-02 03:04:05+0530": "2026-01-01 21:34:05",
        "2026-01-02T03:04:05Z": "2026-01-02 03:04:05", "2026-01-02": "2026-01-02 00:00:00", "": None, "x T+05:30": None,
    }
    read = spark.createDataFrame([(t,) for t in texts], "t string").select("t", convert.to_utc("t").alias("at"))
    plan = read._jdf.queryExecution().analyzed().toString()
    assert plan.count(" - make_dt_interval") == 1 and "CASE" not in plan
    assert {r.t: r["at"] and str(r["at"]) for r in read.collect()} == texts


def test_row_checks_read_date_and_quantity_once(spark, folder):
    plan = QUERIES["row_acceptance"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("timestamp_ntz") == 1


def test_ranks_of_small_and_large_groups_agree(spark, monkeypatch):
    rows = [(g, 1 if i % 3 else None, str(i)) for g, n in (("a", 1), ("b", 9), ("c", 4), (None, 3)) for i in range(n)]
    given = spark.createDataFrame(rows, "g string, at int, id string").repartition(3)
    known = given.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g")))
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 4)
    want = ranking.rank_in_group(given, ["g"], ["at", "id"], method="sorted")
    for got in (ranking.rank_in_group(given, ["g"], ["at", "id"], method="sized"),
                ranking.rank_in_group(known, ["g"], ["at", "id"], method="sized", known="n").drop("n")):
        assert len(got.collect()) == 14 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_small_groups_are_not_sorted_over_all_tasks(spark, monkeypatch):
    given = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "g string, at int")
    sorted_rows = []
    by_sort = ranking.number_by_sort
    monkeypatch.setattr(ranking, "number_by_sort", lambda df, *rest: sorted_rows.append(df.count()) or by_sort(df, *rest))
    assert ranking.rank_in_group(given, ["g"], ["at"], method=signature(allocate.allocate_hybrid).parameters["day_method"].default).count() == 3
    assert sorted_rows == [0]


def test_only_items_that_come_again_are_shuffled_whole(spark, tmp_path, monkeypatch):
    land = tmp_path / "land"
    land.mkdir()
    write_report(land / "SY-2025-01.txt", [report_line(amazon_order_id=str(i)) for i in range(5)])
    write_report(land / "SY-2025-02.txt", [report_line(amazon_order_id="3", quantity="9"), report_line(amazon_order_id="8")])
    want = [(str(i), 9 if i == 3 else 2, 2 if i == 3 or i == 8 else 1) for i in (0, 1, 2, 3, 4, 8)]
    whole, by_item = [], order_import.last_per_item
    monkeypatch.setattr(order_import, "last_per_item", lambda rows: whole.append(rows.count()) or by_item(rows))
    for limit in (order_import.REPEATED_ITEMS, 0):
        monkeypatch.setattr(order_import, "REPEATED_ITEMS", limit)
        wh = warehouse(spark, tmp_path, f"wh{limit}")
        order_import.import_strict(wh, str(land), {"SY": "SY-US"})
        stored = wh.read(order_import.ORDERS_TABLE)
        assert rows_of(stored.withColumn("m", F.month("report_month")), "amazon_order_id", "quantity", "m") == want
    # Of seven rows the two of one item; then, with too many such items, all.
    assert whole == [2, 7]


def test_rollup_shuffles_lines_once(spark):
    rows = [dict(amazon_order_id=str(i // 2), order_item_id=str(i), sku=f"sku-{i % 3}", quantity=i + 1,
                 promotion_ids="PLM-1" if i % 4 == 0 else None) for i in range(12)]
    valid = base.order_base(orders_frame(spark, [*rows, dict(amazon_order_id=None, sku="x"), dict(order_status="Pending")]))
    wanted = spark.createDataFrame([("SY-US", dt.date(2025, 1, 1), 3)], "store_name string, order_month date, ad_order_quantity long")
    result = classify.classify(valid, allocate.allocate_store_month(valid, wanted), RULES["v5"])
    monthly = rollup.source_monthly(result, RULES["v5"])
    plan = plan_of(monthly)
    # After the join with the allocation: the lines by order, then the sums of a source, month and store.
    assert plan[:plan.index("LeftOuter")].count("Exchange hashpartitioning") == 2
    got = {r.main_order_type: (r.classified_item_rows, r.order_sku_count, r.amazon_order_count, r.units) for r in monthly.collect()}
    assert got[ONSITE] == (3, 3, 3, 15)
    counted = [v for k, v in got.items() if k != ONSITE]
    # The line without an order counts as a line and in its units, not as an order.
    assert [sum(x) for x in zip(*counted)][:2] == [13, 12] and sum(v[3] for v in counted) == 79


def test_equal_text_needs_no_collation(spark):
    texts = {"Shipped": True, "shipped": True, "SHIPPED  ": True, " Shipped": False, "Pending": False, None: None}
    read = spark.createDataFrame([(t,) for t in texts], "t string").select("t", same_text("t", "Shipped").alias("same"))
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("= Shipped") < plan.index("collate")
    assert {r.t: r.same for r in read.collect()} == texts
