import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import frame, orders_frame, rows_of, warehouse
from merchlens.functions import text
from merchlens.operators import deal_price as dp
from merchlens.operators import source_report as sr
from merchlens.plans import reports
from merchlens.plans.performance_import import import_performance
from merchlens.rules import ADS, ALL_STORES, LOW_PRICE, ONSITE, ORGANIC
from merchlens.schemas import conform, require_columns
from merchlens.scope import Scope, infer_scope
from merchlens.sources import performance_pages as pages
from merchlens.sources.warehouse import Warehouse


def monthly(spark, rows):
    given = dict(classified_item_rows=1, amazon_order_count=1, units=1, gross_item_sales=Decimal(2))
    return frame(spark, "dws_amz_order_source_monthly", [
        {**given, "order_month": dt.date(2025, m, 1), "store_name": s, "main_order_type": k, "order_sku_count": n,
         "net_item_sales": Decimal(v)} for m, s, k, n, v in rows])


ROWS = [(2, "A", ADS, 1, 10), (2, "A", ORGANIC, 3, 30), (2, "A", ONSITE, 9, 90), (3, "A", LOW_PRICE, 4, 0),
        (4, "B", ADS, 2, 5), (5, "B", ADS, 2, 5), (6, "B", ADS, 2, 5)]


def test_overall_and_month_shares(spark):
    scope = Scope.of("2025-02-01", "2025-07-01")
    got = [tuple(r) for r in sr.report_overall(monthly(spark, ROWS), scope).select(
        "main_order_type", "order_sku_count", "order_sku_share", "net_sales_share").collect()]
    assert got == [("广告", 7, 0.5, 25 / 55), ("站外推广", 0, 0.0, 0.0), ("站内促销", 9, None, None),
                   ("低价", 4, 4 / 14, 0.0), ("自然", 3, 3 / 14, 30 / 55), ("主来源合计", 14, 1.0, 1.0)]
    empty = sr.report_overall(monthly(spark, ROWS), Scope.of("2024-01-01", "2024-02-01"))
    assert [r.order_sku_share for r in empty.collect()] == [0.0, 0.0, None, 0.0, 0.0, 1.0]
    by_month = sr.report_month(monthly(spark, ROWS), scope)
    assert by_month.count() == 25
    low = by_month.filter("month = '2025-03' and main_order_type = '低价'").first()
    assert (low.order_sku_share, low.net_sales_share) == (1.0, 0.0)
    cells = sr.report_store_month(monthly(spark, ROWS), scope)
    assert cells.count() == 50
    assert sr.report_store_month(monthly(spark, ROWS), Scope.of("2025-02-01", "2025-07-01", "A,C")).count() == 20


def test_quarters_need_calendar_and_months(spark):
    scope = Scope.of("2025-02-01", "2025-08-01")
    full = sr.report_quarter(monthly(spark, ROWS), scope)
    assert rows_of(full.filter("main_order_type = '广告'"), "period", "store_name", "period_status", "covered_months",
                   "order_sku_count") == [
        ("2025-Q2", "A", "未完结周期", 0, 0), ("2025-Q2", "B", "完整周期", 3, 6),
        ("2025-Q2", ALL_STORES, "完整周期", 3, 6)]
    some = sr.report_quarter(monthly(spark, ROWS), scope, include_partial=True)
    assert rows_of(some.filter(f"main_order_type = '广告' and store_name = '{ALL_STORES}'"), "period", "period_status",
                   "covered_months") == [
        ("2025-Q1", "未完结周期", 2), ("2025-Q2", "完整周期", 3), ("2025-Q3", "未完结周期", 0)]
    half = sr.report_half(monthly(spark, ROWS), scope, include_partial=True)
    assert rows_of(half.filter(f"main_order_type = '自然' and store_name = '{ALL_STORES}'"), "period",
                   "period_status", "order_sku_count") == [
        ("2025上半年", "未完结周期", 3), ("2025下半年", "未完结周期", 0)]
    assert sr.report_half(monthly(spark, ROWS), Scope.of("2025-02-01", "2025-03-01")).count() == 0


@pytest.mark.parametrize("given,expected", [
    ([{"name": "季节", "val_text": "夏"}, {"name": " 季节 ", "val": "夏"}, {"name": "季节", "field_value": " 冬 "}], "夏|冬"),
    ([{"name": "季节", "val_text": "", "val": None, "value": "春"}, 5, "x"], "春"),
    ([{"name": "季节", "val_text": "  ", "val": "ignored"}], ""), ([{"name": "季节", "value": 7}], "7"),
    ({"name": "季节", "val": "夏"}, ""), ([], ""), ("{broken", ""), (None, ""), ("  ", ""),
])
def test_custom_fields(spark, given, expected):
    raw = given if given is None or isinstance(given, str) else json.dumps(given, ensure_ascii=False)
    df = spark.createDataFrame([(raw,)], "j string")
    assert df.select(text.custom_field_value("j", "季节")).first()[0] == expected


@pytest.mark.parametrize("name,path,expected", [
    (" N ", "A>B", "N"), ("", "A> B ", "B"), (None, "A/B/", "B"), (None, "A／B", "B"), (None, "A\\B", "B"),
    (None, " plain ", "plain"), ("", "", ""), (None, ">>", ">>"), (None, "> >A/B", "A/B"), (None, ">/X", "/X"),
])
def test_category_fallback(spark, name, path, expected):
    df = spark.createDataFrame([(name, path)], "n string, p string")
    assert df.select(text.category_fallback("n", "p")).first()[0] == expected


LISTING = [("SY-US", "1", "sku-a ", "L1", "", 0), ("sy-us", "1", "SKU-A", "L2", "P", 0), ("SY-US", "1", "Sku-A", "", "", 1),
           ("SY-US", "1", "SKU-B", "L1", "P", 1), ("SY-US", "1", " ", "L1", "P", 1), ("OTHER", "1", "SKU-C", "L1", "P", 1)]
PRODUCTS = [("l1", "one", "ST1", "Cat", None, '[{"name":"季节","val":"夏"}]'), ("L1 ", "two", "ST0", "Cat", None, None)]


def listing(spark):
    return spark.createDataFrame(LISTING, "`店铺` string, `店铺id` string, MSKU string, SKU string, `负责人` string, `状态` int")


def products(spark):
    return spark.createDataFrame(
        PRODUCTS, "sku string, product_name string, spu string, category_name string, category_path string, custom_fields_json string")


def deal_orders(spark):
    return orders_frame(spark, [
        dict(quantity=3, item_price=Decimal(30), item_promotion_discount=Decimal(3), sku="sku-b"),
        dict(amazon_order_id="2", quantity=1, item_price=Decimal(30), sku=" SKU-B"),
        dict(amazon_order_id="2", order_item_id="2", quantity=1, item_price=Decimal(10), sku="SKU-B",
             purchase_date_utc=dt.datetime(2025, 3, 5)),
        dict(amazon_order_id="3", sku="SKU-A"), dict(amazon_order_id="4", sku="gone"),
    ])


def test_best_listing_prefers_on_sale(spark):
    got = rows_of(dp.best_listing(listing(spark), ("SY-US",)), "store_key", "msku_key", "local_sku", "status")
    assert got == [("SY-US", "SKU-A", "", 1), ("SY-US", "SKU-B", "L1", 1)]


def test_deal_price_sheets(spark, tmp_path):
    scope = Scope.of("2025-01-01", "2025-04-01", "SY-US")
    sheets = reports.deal_price_report(deal_orders(spark), listing(spark), products(spark), scope, dt.date(2025, 3, 9))
    long = sheets["款号月成交价_长表"].filter("style_no = 'ST1'")
    assert rows_of(long, "order_month", "order_sku_count", "units", "weighted_deal_price", "min_deal_price",
                   "max_deal_price", "msku_count", "local_sku_count") == [
        ("2025-01", 2, 4, 57 / 4, Decimal("9.00000000"), Decimal("30.00000000"), 1, 1),
        ("2025-03", 1, 1, 10.0, Decimal("10.00000000"), Decimal("10.00000000"), 1, 1)]
    wide = sheets["款号月成交价_宽表"].filter("style_no = 'ST1'").first()
    assert (wide["2025-01"], wide["2025-02"], wide["2025-03"]) == (14.25, None, 10.0)
    assert (wide.total_units, wide.total_weighted_price) == (5, 67 / 5)
    assert [tuple(r)[:3] for r in sheets["映射审计"].collect()] == [
        ("SY-US", "GONE", text.NO_LISTING),
        ("SY-US", "SKU-A", "Listing本地SKU为空；负责人为空；未匹配产品管理"), ("SY-US", "SKU-B", text.FULL_MATCH)]
    assert rows_of(sheets["月份覆盖"], "order_month", "has_data", "status") == [
        ("2025-01", "是", "已有数据"), ("2025-02", "否", "缺少订单数据"), ("2025-03", "是", "未完结月份，截至2025-03-09")]
    by_store = reports.deal_price_report(
        deal_orders(spark), listing(spark), products(spark), scope, dt.date(2025, 3, 9), by_store=True)
    assert list(by_store) == ["SY-US"] and "store_name" not in by_store["SY-US"].columns
    totals = sheets["款号月成交价_长表"].agg(F.sum("units"), F.sum("order_sku_count")).first()
    assert sheets["款号月成交价_宽表"].agg(F.sum("total_units")).first()[0] == totals[0]
    reports.write_sheets(sheets, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out" / "映射审计"), header=True)
    assert back.columns == ["店铺", "MSKU", "映射结果", "订单-SKU数", "销量", "净商品销售额", "销量加权成交价"]
    reports.write_by_store(sheets["款号月成交价_宽表"], str(tmp_path / "stores"))
    assert (tmp_path / "stores" / "款号月成交价" / "店铺=SY-US").is_dir()
    with pytest.raises(ValueError, match="item_price"):
        reports.deal_price_report(deal_orders(spark).drop("item_price"), listing(spark), products(spark), scope, dt.date(2025, 1, 1))


def test_source_report_sheets(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    wh.append("dws_amz_order_source_monthly", monthly(spark, ROWS))
    sheets = reports.source_report(wh)
    assert list(sheets) == ["总览", "月度汇总", "季度汇总", "半年度汇总", "店铺月度明细", "广告审计"]
    assert sheets["月度汇总"].count() == 25 and sheets["广告审计"].count() == 0
    assert infer_scope(wh.read("dws_amz_order_source_monthly")) == Scope.of("2025-02-01", "2025-07-01")
    reports.write_sheets(sheets, str(tmp_path / "out"), "parquet")
    with pytest.raises(ValueError):
        reports.source_report(wh, Scope.of("2020-01-01", "2020-02-01"))
    with pytest.raises(ValueError):
        Scope.of("2025-02-01", "2025-02-01")
    with pytest.raises(ValueError):
        Scope.of("2025-02-01", "2025-03-01", " , ")


def page(rows, code="0", **data):
    return json.dumps({"code": code, "data": {"list": rows, **data}}, ensure_ascii=False)


PAGES = [
    (1, page([
        {"price_list": [{"sid": 9, "seller_sku": "no"}, {"sid": 7, "seller_sku": " M1 ", "local_sku": "L1", "country": "US"}],
         "asins": {"sid": 1, "asin": "B1"}, "parent_asins": [], "parent_asin": "P1", "volume": "12.9",
         "order_items": -3.7, "amount": "1.5", "spend": "n/a", "clicks": "", "item_name": "名"},
        {"price_list": {"seller_sku": ""}, "msku": "M2", "sku": "S2", "asin": "B2", "volume": 1},
        {"price_list": [], "msku": "  "}, "junk", {"asins": [{"asin": "B9"}]}], total=5)),
    (2, page([{"msku": "M1", "volume": 99}])), (3, json.dumps({"data": [{"msku": "m1", "volume": 4}]})),
    (4, json.dumps({"code": 0, "data": {"rows": [{"msku": "M5"}], "list": []}})),
]


def landed(spark, month=dt.date(2025, 1, 1), rows=PAGES):
    return spark.createDataFrame([(month, 7, "SY-US", n, b) for n, b in rows],
                                 "report_month date, sid bigint, store_name string, page int, body string")


def test_performance_import(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    log = import_performance(wh, landed(spark), dt.date(2025, 1, 20))
    assert rows_of(log, "status", "interface_total", "fetched_rows", "written_rows") == [("SUCCESS", 5, 4, 4)]
    table = wh.read("ods_product_performance_monthly_msku")
    assert rows_of(table, "msku", "sku", "asin", "volume", "period_end") == [
        ("M1", None, None, 99, dt.date(2025, 1, 20)), ("M2", "S2", "B2", 1, dt.date(2025, 1, 20)),
        ("M5", None, None, None, dt.date(2025, 1, 20)), ("m1", None, None, 4, dt.date(2025, 1, 20))]
    flat = pages.flatten_rows(pages.explode_rows(pages.parse_pages(landed(spark))), dt.date(2025, 3, 1))
    first = flat.filter("page = 1 and position = 0").first()
    assert (first.msku, first.sku, first.country, first.asin, first.parent_asin, first.volume, first.order_items,
            first.amount, first.spend, first.clicks, first.item_name) == (
        "M1", "L1", "US", "B1", "P1", 12, -3, Decimal("1.500000"), None, None, "名")
    assert json.loads(first.raw_json)["item_name"] == "名" and first.period_end == dt.date(2025, 1, 31)
    # Done months are skipped, forced ones replaced, also by nothing.
    assert import_performance(wh, landed(spark, rows=[(1, page([{"msku": "Z"}]))]), dt.date(2025, 2, 2)).count() == 0
    import_performance(wh, landed(spark, dt.date(2025, 2, 1), [(1, page([{"msku": "Z"}]))]), dt.date(2025, 2, 2))
    import_performance(wh, landed(spark, rows=[(1, page([]))]), dt.date(2025, 2, 2), force=True)
    assert rows_of(wh.read("ods_product_performance_monthly_msku"), "report_month", "msku") == [(dt.date(2025, 2, 1), "Z")]
    assert wh.read("etl_product_performance_monthly_log").count() == 2


@pytest.mark.parametrize("rows, reason", [
    ([(1, page([{"msku": "A"}], total=2)), (2, page([{"msku": "BAD"}], code="103"))], "page 2: code 103"),
    ([(1, page([{"msku": "A"}])), (2, "not json")], "page 2: no JSON"),
    ([(1, page([{"msku": "A"}])), (3, page([{"msku": "B"}]))], "1 pages are missing"),
    ([(2, page([{"msku": "A"}]))], "pages start at 2"),
    ([(1, page([{"msku": "A"}], total=2))], "1 of 2 rows"),
])
def test_incomplete_month_keeps_the_old_rows(spark, tmp_path, rows, reason):
    wh, month = warehouse(spark, tmp_path), dt.date(2025, 3, 1)
    import_performance(wh, landed(spark, month, [(1, page([{"msku": "OLD"}]))]), dt.date(2025, 4, 2))
    log = import_performance(wh, landed(spark, month, rows), dt.date(2025, 4, 3), force=True)
    assert rows_of(log, "status", "error_message", "written_rows") == [("FAILED", reason, 0)]
    assert rows_of(wh.read("ods_product_performance_monthly_msku"), "msku") == [("OLD",)]
    # A failed month is taken up again without being forced.
    whole = landed(spark, month, [(1, page([{"msku": "A"}, {"msku": "B"}], total=2))])
    assert rows_of(import_performance(wh, whole, dt.date(2025, 4, 4)), "status", "written_rows") == [("SUCCESS", 2)]
    assert rows_of(wh.read("ods_product_performance_monthly_msku"), "msku") == [("A",), ("B",)]


def test_pages_are_read_from_folders(spark, tmp_path):
    folder = tmp_path / "land" / "report_month=2025-01-01" / "sid=7" / "store_name=SY-US"
    folder.mkdir(parents=True)
    (folder / "page-12.json").write_text(json.dumps({"code": 0, "data": [{"msku": "A"}]}, indent=1), encoding="utf-8")
    got = pages.read_pages(spark, str(tmp_path / "land"))
    assert rows_of(got, "report_month", "sid", "store_name", "page") == [(dt.date(2025, 1, 1), 7, "SY-US", 12)]
    assert pages.explode_rows(pages.parse_pages(got)).count() == 1


def test_tasks_and_stores(spark):
    stores = spark.createDataFrame([("A", 1), ("B", 2)], "store_name string, sid bigint")
    log = spark.createDataFrame([(dt.date(2025, 1, 1), 1, "SUCCESS"), (dt.date(2025, 1, 1), 2, "FAILED")],
                                "report_month date, sid bigint, status string")
    months = Scope.of("2025-01-01", "2025-03-01").months
    assert rows_of(pages.pending_tasks(stores, months, log), "store_name", "report_month") == [
        ("A", dt.date(2025, 2, 1)), ("B", dt.date(2025, 1, 1)), ("B", dt.date(2025, 2, 1))]
    assert pages.pending_tasks(stores, months, log, force=True).count() == 4
    asked = spark.createDataFrame([("a",), ("C",)], "store_name string")
    assert rows_of(pages.unknown_stores(asked, stores), "store_name") == [("C",)]


def test_older_files_read_with_later_columns(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    old = conform(spark.createDataFrame([("SY-US", dt.date(2025, 1, 1))], "store_name string, order_month date"),
                  "dwd_amz_ad_order_allocation").drop("allocation_level", "allocation_confidence")
    old.write.partitionBy("order_month", "store_name").parquet(wh.path("dwd_amz_ad_order_allocation"))
    assert rows_of(wh.read("dwd_amz_ad_order_allocation"), "store_name", "allocation_level") == [("SY-US", None)]
    with pytest.raises(ValueError, match="lacks"):
        require_columns(old, ["allocation_level"])
