"""Records and fields of report files against Python's csv reader, in files cut into many blocks."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from helpers import report_line, rows_of, warehouse, write_report
from merchlens.plans import order_import as oi
from merchlens.schemas import ORDER_HEADERS
from merchlens.sources import files, order_files

PARTS = ['"', '""', '"""', "a", 'Screen 5" blue', "\n", "\n\n", "x y", "", "上海", "|", ","]


def field(rng):
    inner = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 4)))
    form = rng.random()
    if form < 0.35:
        return '"' + inner.replace('"', '""') + '"' + rng.choice(["", "", " after", 'x"y'])
    return inner.replace("\n", "") if form < 0.9 else inner


def read_by_csv(text, delimiter, keep_blank=False):
    rows = [r for r in csv.reader(io.StringIO(text.removeprefix("﻿"), newline=""), delimiter=delimiter) if r or keep_blank]
    return rows


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.mark.parametrize(("seed", "delimiter", "mark"), [(1, "\t", ""), (2, ",", "﻿"), (3, "|", ""), (4, ";", "﻿")])
def test_records_are_those_of_csv(spark, tmp_path, small_blocks, seed, delimiter, mark):
    rng = random.Random(seed)
    header = delimiter.join(["first", '"second', 'name"', "third"]) if seed == 2 else delimiter.join(["first", "second", "third"])
    lines = [delimiter.join(field(rng) for _ in range(rng.randint(2, 4))) for _ in range(400)]
    text = mark + "\n".join([header, *lines]) + ("\n" if seed % 2 else "")
    path = tmp_path / "file.txt"
    path.write_text(text, encoding="utf-8", newline="")
    names, *expected = read_by_csv(text, delimiter)
    found, delimited = files.header_record(spark, str(path), "UTF-8")
    assert (found, delimited) == (names, delimiter)
    assert files.holds_open_lines(spark, str(path), "UTF-8", delimiter)
    records = files.text_records(spark, str(path), "UTF-8", delimiter, False, 4)
    got = records.filter("source_row_no > 1").select("source_row_no", files.fields_of(F.col("line"), delimiter).alias("f")).collect()
    got = sorted((r.source_row_no, r.f) for r in got)
    assert got == [(i, r) for i, r in enumerate(expected, 2)]


def test_inch_marks_are_no_quotes(spark, tmp_path):
    path = tmp_path / "RKZ2607.txt"
    rows = [["1", 'Screen 5" blue'], ["2", "plain"], ["3", 'a "b" c'], ["4", 'Box 7" red'], ["5", '"in"ner"']]
    path.write_text("\n".join("\t".join(r) for r in [["amazon order id", "sku"], *rows]) + "\n")
    assert not files.holds_open_lines(spark, str(path), "UTF-8", "\t")
    got, _ = order_files.read_monthly(spark, str(path))
    assert rows_of(got, "source_row_no", "amazon_order_id", "sku") == [
        (2, "1", 'Screen 5" blue'), (3, "2", "plain"), (4, "3", 'a "b" c'), (5, "4", 'Box 7" red'), (6, "5", 'inner"')]


def test_an_unpaired_quote_takes_the_rest_of_the_file_up_to_the_limit(spark, tmp_path):
    path = tmp_path / "SY2607.txt"
    path.write_text('id\tsku\n1\t"open\n2\tb\n3\tc\n')
    got, _ = order_files.read_monthly(spark, str(path))
    assert rows_of(got, "source_row_no", "id", "sku") == [(2, "1", "open\n2\tb\n3\tc")]
    path.write_text('id\tsku\n1\t"open\n' + "2\tbbbbbbbb\n" * 14_000)
    with pytest.raises(Exception, match="longer than allowed"):
        order_files.read_monthly(spark, str(path))[0].collect()
    path.write_text('id\tsku\n1\t"open\n' + "2\tbbbbbbbb\n" * 60_000)
    with pytest.raises(Exception, match="longer than allowed"):
        order_files.read_monthly(spark, str(path))[0].collect()


def test_strict_reports_with_quoted_breaks(spark, tmp_path, small_blocks):
    src = tmp_path / "in"
    src.mkdir()
    lines = [report_line(order_item_id=str(i), product_name=['"two\nlines"', '5" wide', '"a ""b"" c"', "plain", '"open\n\nend" x'][i % 5]) for i in range(60)]
    write_report(src / "SY2501.txt", lines)
    write_report(src / "SY2502.txt", [report_line(order_item_id="100"), "", report_line(order_item_id="101")])
    raw = order_files.read_strict(spark, [str(src / "SY2501.txt")])
    text = (src / "SY2501.txt").read_text(encoding="utf-8")
    place = ORDER_HEADERS.index("product-name")
    assert rows_of(raw, "source_row_no", "`product-name`") == sorted(
        ((i, r[place]) for i, r in enumerate(read_by_csv(text, "\t", True), 1) if i > 1), key=lambda r: str(r[0]))
    wh = warehouse(spark, tmp_path)
    log = oi.import_strict(wh, str(src), MAP, raise_bad=False)
    assert rows_of(log, "source_file", "status", "total_rows") == [("SY2501.txt", "success", 60), ("SY2502.txt", "failed", 0)]
    bad = oi.strict_rejects(spark, str(src / "SY2502.txt")).collect()
    assert [(r.source_row_no, r.reject_reasons[0]) for r in bad] == [(3, "wrong number of columns")]


MAP = {"SY": "SY-US"}
