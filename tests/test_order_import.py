import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import frame, orders_frame, report_line, rows_of, warehouse, write_report
from merchlens.plans import order_import as oi
from merchlens.schemas import ORDER_HEADERS
from merchlens.sources import files, order_files

MAP = {"SY": "SY-US", "S": "S-US", "rkz": "RKZ-US"}
NOW = dt.datetime(2025, 2, 1, 3, 4, 5)


def test_strict_import_types_and_row_numbers(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    write_report(src / "SY-2025-01.txt", [
        report_line(),
        report_line(amazon_order_id=" 111-2 ", purchase_date="2025-01-15T00:00:00-07:00", is_business_order="Yes",
                    item_price="12.345678"),
        report_line(amazon_order_id="111-3", purchase_date="2025-01-15T10:00:00", sku='"a ""q"" b"'),
    ])
    wh = warehouse(spark, tmp_path)
    log = oi.import_strict(wh, str(src), MAP, now=NOW)
    assert rows_of(log, "store_name", "status", "total_rows", "report_month") == [
        ("SY-US", "success", 3, dt.date(2025, 1, 1))
    ]
    rows = rows_of(wh.read(oi.ORDERS_TABLE), "amazon_order_id", "source_row_no", "purchase_date_utc",
                   "item_price", "is_business_order", "sku", "purchase_date_raw")
    assert rows == [
        ("111-1", 2, dt.datetime(2025, 1, 15, 12), Decimal("40.0000"), False, "SKU-A", "2025-01-15T12:00:00+00:00"),
        ("111-2", 3, dt.datetime(2025, 1, 15, 7), Decimal("12.3457"), True, "SKU-A", "2025-01-15T00:00:00-07:00"),
        ("111-3", 4, dt.datetime(2025, 1, 15, 10), Decimal("40.0000"), False, 'a "q" b', "2025-01-15T10:00:00"),
    ]
    # The same bytes are skipped the second time, and loaded again when forced.
    assert oi.import_strict(wh, str(src), MAP, now=NOW).count() == 0
    assert oi.import_strict(wh, str(src), MAP, now=NOW, force=True).count() == 1
    assert wh.read(oi.ORDERS_TABLE).count() == 3


def test_strict_header_and_width_are_checked(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    bad = tmp_path / "bad"
    bad.mkdir()
    write_report(bad / "SY-2025-01.txt", [report_line().split("\t", 1)[1]], header=ORDER_HEADERS[1:])
    with pytest.raises(oi.ImportRefused, match=r"row 1: header lacks \[amazon-order-id\], has extra \[\], columns: 38"):
        oi.validate_strict(wh, str(bad), MAP)
    short = tmp_path / "short"
    short.mkdir()
    write_report(short / "SY-2025-01.txt", [report_line(), report_line().rsplit("\t", 1)[0]])
    with pytest.raises(oi.ImportRefused, match="row 3: wrong number of columns"):
        oi.validate_strict(wh, str(short), MAP)
    with pytest.raises(oi.ImportRefused):
        oi.import_strict(wh, str(short), MAP)
    assert not wh.exists(oi.ORDERS_TABLE)
    assert rows_of(wh.read(oi.LOG_TABLE), "status") == [("failed",)]


def test_empty_and_unknown_files_are_refused(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    for name, problem in (("SY2501.txt", "empty files"), ("q.txt", "no store known")):
        src = tmp_path / name[:2]
        src.mkdir()
        (src / name).write_text("" if problem == "empty files" else "x")
        with pytest.raises(oi.ImportRefused, match=problem):
            oi.validate_strict(wh, str(src), MAP)
    with pytest.raises(ValueError, match="not a TXT"):
        oi.validate_strict(wh, str(tmp_path / "x.csv"), MAP)


@pytest.mark.parametrize("change,reason", [
    ({"quantity": "1.5"}, "quantity: 1.5"),
    ({"item_price": "x"}, "item-price: x"),
    ({"is_business_order": "maybe"}, "is-business-order: maybe"),
    ({"purchase_date": "soon"}, "purchase-date: soon"),
    ({"amazon_order_id": "  "}, "amazon-order-id is empty"),
])
def test_strict_rejects_unreadable_values(spark, tmp_path, change, reason):
    src = tmp_path / "in"
    src.mkdir()
    write_report(src / "SY2501.txt", [report_line(**change)])
    with pytest.raises(oi.ImportRefused, match=reason):
        oi.validate_strict(warehouse(spark, tmp_path), str(src), MAP)


def test_validate_counts_rows_of_every_file(spark, tmp_path):
    deep = tmp_path / "in" / "RKZ files"
    deep.mkdir(parents=True)
    write_report(tmp_path / "in" / "SY2501.txt", [report_line()] * 3)
    write_report(deep / "orders 202502.txt", [report_line()] * 2, newline="\r\n")
    got = oi.validate_strict(warehouse(spark, tmp_path), str(tmp_path / "in"), MAP)
    assert rows_of(got, "source_file", "store_name", "report_month", "valid_rows") == [
        ("SY2501.txt", "SY-US", dt.date(2025, 1, 1), 3),
        ("orders 202502.txt", "RKZ-US", dt.date(2025, 2, 1), 2),
    ]


def test_blank_line_and_quoted_break(spark, tmp_path):
    blank = tmp_path / "blank"
    blank.mkdir()
    write_report(blank / "SY2501.txt", [report_line(), "", report_line()])
    wh = warehouse(spark, tmp_path)
    with pytest.raises(oi.ImportRefused, match="row 3: wrong number of columns"):
        oi.validate_strict(wh, str(blank), MAP)
    broken = tmp_path / "broken"
    broken.mkdir()
    write_report(broken / "SY2501.txt", [report_line(product_name='"two\nlines"'), report_line()])
    assert rows_of(oi.validate_strict(wh, str(broken), MAP), "valid_rows") == [(2,)]
    raw = order_files.read_strict(spark, str(broken))
    assert rows_of(raw, "`product-name`", "source_row_no") == [("two\nlines", 2), (None, 3)]


def test_upsert_keeps_last_row_and_first_created(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    first = dt.datetime(2025, 1, 1)
    oi.upsert_orders(wh, orders_frame(spark, [
        dict(quantity=1, created_at=first), dict(amazon_order_id="2", created_at=first),
        dict(store_name="RKZ-US", created_at=first),
    ]))
    later = dt.datetime(2025, 3, 1)
    oi.upsert_orders(wh, orders_frame(spark, [
        dict(quantity=5, source_row_no=2, created_at=later),
        dict(quantity=7, source_row_no=9, created_at=later, report_month=dt.date(2025, 2, 1)),
        dict(amazon_order_id="3", created_at=later, report_month=dt.date(2025, 2, 1)),
    ]))
    got = rows_of(wh.read(oi.ORDERS_TABLE), "store_name", "amazon_order_id", "quantity", "report_month", "created_at")
    assert got == [
        ("RKZ-US", "1", 1, dt.date(2025, 1, 1), first),
        ("SY-US", "1", 7, dt.date(2025, 2, 1), first),
        ("SY-US", "2", 1, dt.date(2025, 1, 1), first),
        ("SY-US", "3", 1, dt.date(2025, 2, 1), later),
    ]


def test_upsert_empties_a_partition_that_lost_its_rows(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    oi.upsert_orders(wh, orders_frame(spark, [dict()]))
    oi.upsert_orders(wh, orders_frame(spark, [dict(report_month=None)]))
    assert rows_of(wh.read(oi.ORDERS_TABLE), "amazon_order_id", "report_month") == [("1", None)]


def test_row_numbers_across_blocks(spark, tmp_path):
    src = tmp_path / "SY2501.txt"
    write_report(src, [report_line(amazon_order_id=f"o{i:05d}") for i in range(5000)])
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = order_files.read_strict(spark, str(src))
        assert raw.select("_path").count() == 5000
        wrong = raw.filter(
            F.col("source_row_no") != F.substring("`amazon-order-id`", 2, 9).cast("long") + 2
        )
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


MONTHLY = ["Purchase-Date", "amazon order id", "seller-sku", "quantity", "currency", "item/price", "asin",
           "sales-channel", "order-status", "item-status", "item-promotion-discount"]


def monthly_line(**changes):
    row = {
        "Purchase-Date": "2026-07-10T12:00:00+00:00", "amazon order id": "1", "seller-sku": " S1 ", "quantity": "1",
        "currency": "USD", "item/price": "1,020.50", "asin": "B1", "sales-channel": "Amazon.com",
        "order-status": "Shipped", "item-status": "Shipped",
    }
    row.update(changes)
    return [row.get(h, "") for h in MONTHLY]


def write_monthly(path, lines, encoding="utf-8-sig", sep="\t"):
    text = "\n".join(sep.join(line) for line in [MONTHLY, *lines]) + "\n"
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize("encoding,sep", [("utf-8-sig", "\t"), ("utf-8", ";"), ("utf-16", "\t"), ("gb18030", "|")])
def test_monthly_import(spark, tmp_path, encoding, sep):
    path = write_monthly(tmp_path / "RKZ2607-月.txt", [
        monthly_line(asin="商品"), [""] * len(MONTHLY), monthly_line(quantity="0"), monthly_line(quantity="1,000"),
    ], encoding, sep)
    wh = warehouse(spark, tmp_path)
    dry = oi.import_monthly(wh, path, now=NOW)
    assert (dry.store_name, dry.report_month, dry.input_rows, dry.zero_quantity_rows, dry.applied) == (
        "RKZ-US", dt.date(2026, 7, 1), 3, 1, False)
    assert not wh.exists(oi.ORDERS_TABLE)
    with pytest.raises(oi.ImportRefused, match="replace_month"):
        oi.import_monthly(wh, path, apply=True)
    done = oi.import_monthly(wh, path, apply=True, replace_month=True, now=NOW)
    assert done.applied and done.audit["row_count"] == 3 and done.audit["units"] == 1001
    rows = rows_of(wh.read(oi.ORDERS_TABLE), "source_row_no", "quantity", "sku", "item_price", "asin")
    assert rows == [
        (2, 1, "S1", Decimal("1020.5000"), "商品"), (4, 0, "S1", Decimal("1020.5000"), "B1"),
        (5, 1000, "S1", Decimal("1020.5000"), "B1"),
    ]
    batch = wh.read(oi.ORDERS_TABLE).first()
    assert batch.import_batch_no.startswith("txt_RKZUS_202607_20250201030405_")
    assert batch.order_item_id.startswith("txt-")


def test_monthly_replace_leaves_other_months(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    oi.upsert_orders(wh, orders_frame(spark, [
        # Stored under another report month, but in the Pacific month to replace.
        dict(store_name="RKZ-US", purchase_date_utc=dt.datetime(2026, 8, 1, 3), report_month=dt.date(2026, 8, 1)),
        dict(store_name="RKZ-US", amazon_order_id="9", purchase_date_utc=dt.datetime(2026, 7, 1, 3),
             report_month=dt.date(2026, 7, 1)),
        dict(store_name="SY-US", purchase_date_utc=dt.datetime(2026, 7, 5), report_month=dt.date(2026, 7, 1)),
    ]))
    path = write_monthly(tmp_path / "RKZ2607.txt", [monthly_line(**{"amazon order id": "7"})])
    done = oi.import_monthly(wh, path, apply=True, replace_month=True)
    assert done.old_rows == 1
    assert rows_of(wh.read(oi.ORDERS_TABLE), "store_name", "amazon_order_id") == [
        ("RKZ-US", "7"), ("RKZ-US", "9"), ("SY-US", "1")]


@pytest.mark.parametrize("inside,ok", [(19, True), (18, False)])
def test_month_purity_boundary(spark, tmp_path, inside, ok):
    lines = [monthly_line(**{"amazon order id": str(i)}) for i in range(inside)]
    lines += [monthly_line(**{"amazon order id": f"x{i}", "Purchase-Date": "2026-06-03"}) for i in range(20 - inside)]
    path = write_monthly(tmp_path / "SY2607.txt", lines)
    wh = warehouse(spark, tmp_path)
    if ok:
        assert oi.import_monthly(wh, path).input_rows == 20
        with pytest.raises(oi.ImportRefused, match="outside the Pacific month"):
            oi.import_monthly(wh, path, apply=True, replace_month=True)
    else:
        with pytest.raises(oi.ImportRefused, match="18 of 20"):
            oi.import_monthly(wh, path)


@pytest.mark.parametrize("change,reason", [
    ({"quantity": "-1"}, "quantity must be"), ({"quantity": ""}, "quantity must be"),
    ({"quantity": "0.5"}, "quantity must be"), ({"amazon order id": ""}, "order id is empty"),
    ({"seller-sku": " "}, "sku is empty"), ({"Purchase-Date": ""}, "purchase date is empty"),
    ({"item/price": "abc"}, "item_price: abc"),
])
def test_monthly_rejects(spark, tmp_path, change, reason):
    path = write_monthly(tmp_path / "SY2607.txt", [monthly_line(), monthly_line(**change)])
    with pytest.raises(oi.ImportRefused, match=f"row 3: .*{reason}"):
        oi.import_monthly(warehouse(spark, tmp_path), path)


def test_monthly_repeated_items_are_refused(spark, tmp_path):
    path = tmp_path / "SY2607.txt"
    text = "\n".join("\t".join(r) for r in [
        [*MONTHLY, "order-item-id"], [*monthly_line(), "i1"], [*monthly_line(), "i1"]])
    path.write_text(text, encoding="utf-8")
    with pytest.raises(oi.ImportRefused, match="repeated order items"):
        oi.import_monthly(warehouse(spark, tmp_path), str(path))


def test_names(spark):
    path = F.col("p")
    names = spark.createDataFrame([
        ("/x/SY-2025-01.txt",), ("/x/SY2501.txt",), ("/x/RKZ2607-20260727.txt",), ("/SY/other 1.txt",), ("/x/q.txt",),
        ("/x/rkz2613.txt",),
    ], "p string")
    got = names.select(
        "p", files.store_from_name(path, MAP).alias("s"), files.month_from_name(path).alias("m"),
        files.monthly_name(path).alias("n"),
    ).collect()
    assert [(r.s, r.m and r.m.isoformat()[:7], r.n and (r.n.store_name, r.n.report_month.isoformat()[:7])) for r in got] == [
        ("SY-US", "2025-01", None), ("SY-US", "2025-01", ("SY-US", "2025-01")),
        ("RKZ-US", "2026-07", ("RKZ-US", "2026-07")), ("SY-US", None, None), (None, None, None), ("RKZ-US", None, None),
    ]


def test_charset_is_that_of_the_whole_file(spark, tmp_path):
    plain = "amazon-order-id\tsku\n" + "A\tB\n" * 30_000
    for charset, mark in (("utf-8", "UTF-8"), ("gb18030", "GB18030"), ("utf-16", "UTF-16")):
        path = tmp_path / f"{charset}.txt"
        path.write_bytes((plain + "A\t上海市\n").encode(charset))
        assert files.inspect_text(spark, str(path)) == mark
        rows, header = order_files.read_monthly(spark, str(path))
        last = rows.filter("source_row_no > 30000").orderBy("source_row_no").collect()
        assert header == ["amazon_order_id", "sku"] and last[-1].sku == "上海市" and last[-1].source_row_no == 30_002
    assert spark.conf.get(files.JAVA_CHARSETS, "false") == "false"
    mixed = tmp_path / "mixed.txt"
    mixed.write_bytes(plain.encode() + "A\t上海市\n".encode() + b"A\t\xff\xff\n")
    with pytest.raises(ValueError, match="unknown text encoding"):
        order_files.read_monthly(spark, str(mixed))


def test_long_header_and_quoted_breaks(spark, tmp_path):
    names = [f"column-{i}-{'x' * 2000}" for i in range(40)]
    wide = tmp_path / "wide.txt"
    wide.write_text("\t".join(names) + "\n" + "\t".join(map(str, range(40))) + "\n")
    rows, header = order_files.read_monthly(spark, str(wide))
    assert len(header) == 40 and rows.first()[header[-1]] == "39"
    for charset in ("utf-8", "gb18030"):
        path = tmp_path / f"{charset}.txt"
        path.write_bytes('sku,"note\nof line",asin\n"A","two\n\nlines, 上海",1\n\nB,"say ""x""",2\n"C","open\nend",3\n'.encode(charset))
        rows, header = order_files.read_monthly(spark, str(path))
        assert header == ["sku", "note_of_line", "asin"]
        assert rows_of(rows, "source_row_no", *header) == [
            (2, "A", "two\n\nlines, 上海", "1"), (3, "B", 'say "x"', "2"), (4, "C", "open\nend", "3")]


def test_good_files_load_beside_a_bad_one(spark, tmp_path):
    src = tmp_path / "in.v2"
    src.mkdir()
    write_report(src / "SY2501.txt", [report_line()])
    write_report(src / "SY2502.txt", [report_line(), report_line(quantity="bad")])
    wh = warehouse(spark, tmp_path)
    with pytest.raises(oi.ImportRefused, match="row 3"):
        oi.import_strict(wh, str(src), MAP)
    assert wh.read(oi.ORDERS_TABLE).count() == 1
    assert rows_of(wh.read(oi.LOG_TABLE), "source_file", "status", "total_rows") == [
        ("SY2501.txt", "success", 1), ("SY2502.txt", "failed", 0)]
    told = wh.read(oi.LOG_TABLE).filter("status = 'failed'").first().error_message
    assert told.startswith("row 3: ") and told.endswith("(1 bad rows)")
    rejects = oi.strict_rejects(spark, str(src)).collect()
    assert [(r.path.rsplit("/", 1)[-1], r.source_row_no) for r in rejects] == [("SY2502.txt", 3)]
    assert files.discover_files(spark, str(src / "SY2501.txt")).count() == 1


def test_the_later_path_wins(spark, tmp_path):
    for folder, name, price in (("a", "SY-2025-03.txt", "1.00"), ("b", "SY-2025-01.txt", "2.00")):
        (tmp_path / "in" / folder).mkdir(parents=True)
        write_report(tmp_path / "in" / folder / name, [report_line(**{"item-price": price})])
    wh = warehouse(spark, tmp_path)
    oi.import_strict(wh, str(tmp_path / "in"), MAP)
    assert rows_of(wh.read(oi.ORDERS_TABLE), "item_price") == [(Decimal("2.0000"),)]


def test_file_hash_is_sha256(spark, tmp_path):
    import hashlib

    path = tmp_path / "a b+%20.txt"
    path.write_bytes(b"x" * 3_000_000)
    row = files.file_hashes(spark, [f"file:{path}"]).first()
    assert (row.length, row.source_file_sha256) == (3_000_000, hashlib.sha256(b"x" * 3_000_000).hexdigest())


def test_sniffing():
    assert files.sniff_delimiter('"a,b";c;d') == ";" and files.sniff_delimiter('a\t"b;c;d"') == "\t"
    assert files.normalize_header("﻿Amazon-Order ID（新）/x") == "amazon_order_id_新_x"
    with pytest.raises(ValueError):
        files.sniff_delimiter("abc")


def test_insert_columns_needs_a_source_for_required_ones():
    provided = ("store_name", "source_file", "source_file_sha256", "source_row_no", "import_batch_no", "order_item_id")
    chosen = order_files.insert_columns(["amazon_order_id", "msku", "purchase_date"], "ods_amz_all_orders_report", provided)
    assert "sku" in chosen and "purchase_date_utc" in chosen and "item_price" not in chosen
    with pytest.raises(ValueError, match="amazon_order_id"):
        order_files.insert_columns(["sku"], "ods_amz_all_orders_report", provided)


def test_failed_import_can_be_repeated(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    write_report(src / "SY2501.txt", [report_line(quantity="bad")])
    wh = warehouse(spark, tmp_path)
    with pytest.raises(oi.ImportRefused):
        oi.import_strict(wh, str(src), MAP)
    write_report(src / "SY2501.txt", [report_line()])
    assert oi.import_strict(wh, str(src), MAP).count() == 1
    assert rows_of(wh.read(oi.LOG_TABLE), "status") == [("failed",), ("success",)]
    assert frame(spark, oi.LOG_TABLE, []).count() == 0


def test_the_log_is_only_appended_to(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    key = dict(target_table="t", store_name="s")

    def entry(sha, status, start, end=None):
        return dict(key, source_file_sha256=sha, status=status, started_at=start, finished_at=end)

    early, late = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    written = [entry("a", "running", early), entry("a", "success", early, early), entry("b", "success", early, early),
               entry("b", "running", late), entry("c", "failed", early, late), entry("c", "success", late, late)]
    for row in written:
        wh.append(oi.LOG_TABLE, frame(spark, oi.LOG_TABLE, [row]))
    before = {f.name for f in (tmp_path / "wh" / oi.LOG_TABLE).iterdir()}
    assert rows_of(wh.read(oi.LOG_TABLE), "source_file_sha256", "status") == [("a", "success"), ("b", "running"), ("c", "success")]
    wh.append(oi.LOG_TABLE, frame(spark, oi.LOG_TABLE, [entry("b", "success", late, late)]))
    assert {f.name for f in (tmp_path / "wh" / oi.LOG_TABLE).iterdir() if f.suffix == ".parquet"} > {f for f in before if f.endswith(".parquet")}
    assert rows_of(wh.read(oi.LOG_TABLE), "source_file_sha256", "status") == [("a", "success"), ("b", "success"), ("c", "success")]
