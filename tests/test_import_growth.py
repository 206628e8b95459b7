"""Work, memory and disk of the imports that must not grow faster than their files."""

import csv
import datetime as dt
import io
import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from checks import derived
from helpers import report_line, rows_of, warehouse, write_report
from merchlens.plans import order_import as oi
from merchlens.plans import performance_import
from merchlens.schemas import ORDER_HEADERS
from merchlens.session import LEAN, lean, materialize, passing, scratch_root
from merchlens.sources import files, order_files

MAP = {"SY": "SY-US"}
MONTH = dt.date(2026, 7, 1)
HEADER = ["amazon order id", "purchase date utc", "seller sku", "quantity", "item price", "item tax", "order status"]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def left_over(spark):
    root = scratch_root(spark)
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def write_monthly(path, rows):
    path.write_text("\n".join("\t".join(r) for r in [HEADER, *rows]) + "\n", encoding="utf-8")
    return str(path)


def monthly_rows(n, sku='"a\nb"'):
    return [[f"id{i}", f"2026-07-{i % 20 + 5:02d}T10:00:00Z", sku, str(i), "1,234.5", " 2 ", "Shipped"] for i in range(n)]


def test_texts_are_stripped_once_however_often_they_are_used(spark, tmp_path):
    columns = [order_files.files.normalize_header(h) for h in HEADER]
    rows = spark.createDataFrame([("p", 2, *[" 1 "] * len(columns))], ["_path", "source_row_no", *columns])
    typed = order_files.convert_monthly(rows, columns, "SY-US", MONTH)
    # One for each column of the file, one in the check of a quantity of zero.
    assert optimized(typed).count("trim(") <= len(columns) + 1
    path = write_report(tmp_path / "SY2607.txt", [report_line()])
    strict = order_files.convert_strict(materialize(order_files.read_strict(spark, path), "raw"))
    assert optimized(strict).count("trim(") <= len(ORDER_HEADERS) + 4


def test_a_monthly_import_leaves_no_intermediates(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    before = left_over(spark)
    path = write_monthly(tmp_path / "SY2607.txt", monthly_rows(30))
    for _ in range(2):
        done = oi.import_monthly(wh, path, apply=True, replace_month=True)
        assert done.applied and done.audit["row_count"] == 30
    assert left_over(spark) == before
    got = rows_of(wh.read(oi.ORDERS_TABLE), "amazon_order_id", "sku", "quantity", "item_price", "source_row_no")
    assert len(got) == 30 and {r[1] for r in got} == {"a\nb"} and {str(r[3]) for r in got} == {"1234.5000"}


def test_a_month_is_replaced_beside_the_other_months_of_its_store(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    for name, month in (("SY2606", "06"), ("SY2607", "07"), ("SY2607", "07")):
        rows = [[f"{month}-{i}", f"2026-{month}-10T10:00:00Z", "s", "1", "2", "", ""] for i in range(5)]
        assert oi.import_monthly(wh, write_monthly(tmp_path / f"{name}.txt", rows), apply=True, replace_month=True).applied
    stored = wh.read(oi.ORDERS_TABLE)
    assert rows_of(stored.groupBy("report_month").count(), "report_month", "count") == [(dt.date(2026, 6, 1), 5), (MONTH, 5)]


def test_repeated_and_foreign_items_are_still_refused(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    head = "amazon order id\tpurchase date utc\tsku\tquantity\torder item id\n"
    path = tmp_path / "SY2607.txt"
    path.write_text(head + "a\t2026-07-10T10:00:00Z\ts\t1\tx\n" * 2)
    with pytest.raises(oi.ImportRefused, match="repeated order items"):
        oi.import_monthly(wh, str(path), apply=True, replace_month=True)
    path.write_text(head + "a\t2026-07-10T10:00:00Z\ts\t1\tx\n")
    oi.import_monthly(wh, str(path), apply=True, replace_month=True)
    other = tmp_path / "SY2608.txt"
    other.write_text(head + "a\t2026-08-10T10:00:00Z\ts\t1\tx\n")
    with pytest.raises(oi.ImportRefused, match="already stored in another month"):
        oi.import_monthly(wh, str(other), apply=True, replace_month=True)


def test_scopes_delete_what_was_made_within(spark):
    before = left_over(spark)
    with passing(spark):
        with passing(spark, but="kept"):
            gone = materialize(spark.range(3), "gone")
            kept = materialize(gone, "kept")
        assert kept.count() == 3 and {x.split("-")[0] for x in left_over(spark) - before} == {"kept"}
    assert left_over(spark) == before


def test_records_over_lines_are_read_without_a_shuffle_and_kept_no_longer_than_needed(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    write_report(src / "SY2501.txt", [report_line(order_item_id=str(i), product_name='"two\nlines"') for i in range(30)])
    before = left_over(spark)
    with passing(spark):
        raw = order_files.read_strict(spark, str(src))
        assert "Exchange" not in raw._jdf.queryExecution().executedPlan().toString()
        assert {x.rsplit("-", 1)[0] for x in left_over(spark) - before} == {"text-records"}
        assert rows_of(raw, "`product-name`") == [("two\nlines",)] * 30
    assert left_over(spark) == before
    wh = warehouse(spark, tmp_path)
    log = oi.import_strict(wh, str(src), MAP)
    assert rows_of(log, "total_rows", "status") == [(30, "success")]
    assert {x.split("-")[0] for x in left_over(spark) - before} == {"import"}


def test_records_may_lie_over_many_batches_and_blocks(spark, tmp_path):
    text = "id\tsku\n" + "".join(f'{i}\t"a{i}\n\nb\t""c"" {"x" * (i % 50)}\n"\n\n{i}x\tplain 5" {i}\n' for i in range(300))
    path = tmp_path / "SY2607.txt"
    path.write_text("﻿" + text)
    want = [(r[0], r[1].strip()) for r in list(csv.reader(io.StringIO(text, newline=""), delimiter="\t"))[1:] if r]
    settings = {"spark.sql.files.maxPartitionBytes": "900", "spark.sql.files.openCostInBytes": "10", "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    for some in ({}, {k: settings[k] for k in list(settings)[:2]}, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}, settings):
        before = {k: spark.conf.get(k) for k in some}
        for k, v in some.items():
            spark.conf.set(k, v)
        try:
            got = order_files.read_monthly(spark, str(path))[0].collect()
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
        assert sorted((r.source_row_no, r.id, r.sku) for r in got) == [(i, *w) for i, w in enumerate(want, 2)]


def test_settings_are_those_of_before_after_an_import(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in LEAN}
    with lean(spark):
        assert {k: spark.conf.get(k) for k in LEAN} == LEAN != before
    with pytest.raises(oi.ImportRefused):
        oi.import_monthly(warehouse(spark, tmp_path), write_monthly(tmp_path / "x.txt", []))
    assert {k: spark.conf.get(k) for k in LEAN} == before


def pages_frame(spark, rows):
    body = '{{"code": "0", "data": {{"total": 1, "list": [{{"msku": "{0}", "volume": "{1}"}}]}}}}'
    return spark.createDataFrame(
        [(MONTH, sid, "SY-US", 1, body.format(msku, volume)) for sid, msku, volume in rows],
        "report_month date, sid bigint, store_name string, page int, body string",
    )


def test_a_performance_import_leaves_its_log_only_and_touches_its_months_only(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    before = left_over(spark)
    for force, rows in ((False, [(1, "a", 1), (2, "b", 2)]), (True, [(2, "c", 3), (None, "d", 4)]), (False, [(2, "e", 5)])):
        performance_import.import_performance(wh, pages_frame(spark, rows), MONTH, force=force)
    assert {x.rsplit("-", 1)[0] for x in left_over(spark) - before} == {"performance-log"}
    assert rows_of(wh.read(performance_import.TABLE), "sid", "msku", "volume") == [(1, "a", 1), (2, "c", 3)]
    assert rows_of(wh.read(performance_import.LOG_TABLE), "sid", "written_rows") == [(1, 1), (2, 1), (None, 0)]


def test_reports_are_written_by_store_without_a_sort(spark, tmp_path, monkeypatch):
    lines = spark.createDataFrame([(s, i) for i in range(20) for s in ("A", "B", None)], "store string, n int")
    monkeypatch.setattr(derived, "STORES", ["A", "B", "C"])
    derived._write_text(derived._by_store(lines, ["A", "B"]), str(tmp_path / "out"))
    parts = {p.parent.name: p for p in (tmp_path / "out").rglob("*.txt")}
    assert {k: len(p.read_text().splitlines()) - 1 for k, p in parts.items()} == {"store=A": 20, "store=B": 20, "store=__HIVE_DEFAULT_PARTITION__": 20}
    placed = derived._by_store(lines, ["A", "B"]).select(F.spark_partition_id().alias("p"), "store").distinct().collect()
    assert {r.store: r.p for r in placed} == {"A": 0, "B": 1, None: 1}


def test_workers_need_not_find_the_package(tmp_path):
    for made in (files._block_maps(True), files._block_records({}, True, 5)):
        (tmp_path / "f").write_bytes(cloudpickle.dumps(made))
        code = "import pickle, sys; print(list(pickle.load(open(sys.argv[1], 'rb'))(iter([]))), [m for m in sys.modules if 'merchlens' in m])"
        done = subprocess.run([sys.executable, "-c", code, str(tmp_path / "f")], cwd="/", env={}, capture_output=True, text=True)
        assert done.stdout.strip() == "[] []", done.stderr
