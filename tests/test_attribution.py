import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import frame, orders_frame, rows_of, warehouse
from merchlens.operators import allocate, audit, base, classify, demand, rollup
from merchlens.operators.ranking import first_in_group, rank_in_group
from merchlens.plans.attribution import run_attribution, run_reclassification
from merchlens.rules import ADS, DAY_SKU, LOW_PRICE, MONTH_SKU, OFFSITE, ONSITE, ORGANIC, RULES, STORE_MONTH
from merchlens.scope import Scope

JAN = Scope.of("2025-01-01", "2025-02-01")


def ts(text):
    return dt.datetime.fromisoformat(text)


def base_of(spark, rows, scope=None, low="10"):
    return base.order_base(orders_frame(spark, rows), scope, low)


def test_pacific_months_and_scope(spark):
    rows = [dict(amazon_order_id=str(i), purchase_date_utc=ts(t)) for i, t in enumerate([
        "2025-03-01T07:59:59", "2025-03-01T08:00:00", "2025-11-01T06:59:59", "2025-11-01T07:00:00"])]
    got = rows_of(base_of(spark, rows), "amazon_order_id", "order_date", "order_month")
    assert [r[1].isoformat() for r in got] == ["2025-02-28", "2025-03-01", "2025-10-31", "2025-11-01"]
    march = Scope.of("2025-03-01", "2025-04-01", " sy-us , x")
    assert rows_of(base_of(spark, rows, march), "amazon_order_id") == [("1",)]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        again = rows_of(base_of(spark, rows), "amazon_order_id", "order_date", "order_month")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert again == got


def test_valid_lines_and_keys(spark):
    keep = [dict(amazon_order_id="a", order_status="shipped"), dict(amazon_order_id="b", item_status="Shipped "),
            dict(amazon_order_id="c", sku=" sku-a ", currency="usd")]
    drop = [dict(order_status="Cancelled"), dict(quantity=0), dict(quantity=-1), dict(quantity=None),
            dict(item_price=None), dict(item_price=Decimal(0)), dict(sku="  "), dict(sku=None),
            dict(purchase_date_utc=None), dict(currency="CAD"), dict(sales_channel="Non-Amazon")]
    got = rows_of(base_of(spark, keep + drop), "amazon_order_id", "sku_key")
    assert got == [("a", "SKU-A"), ("b", "SKU-A"), ("c", "SKU-A")]


@pytest.mark.parametrize("promo,discount,flags", [
    ("us-mpc-1", "1", (True, False, False)), ("PLM-1", None, (False, False, True)),
    ("x percentage off y", None, (False, False, True)), ("US Core Free Shipping", None, (False, True, False)),
    ("a3ju1fcinf5sd0", "0", (False, True, False)), (None, "0.01", (False, False, True)), (None, None, (False,) * 3),
])
def test_promo_flags(spark, promo, discount, flags):
    row = dict(promotion_ids=promo, item_promotion_discount=discount and Decimal(discount))
    got = rows_of(base_of(spark, [row]), "offsite_flag", "shipping_promotion_flag", "onsite_promotion_flag")
    assert got == [flags]


def test_low_price_compares_the_rounded_unit_price(spark):
    rows = [dict(amazon_order_id=str(i), item_price=Decimal(p), quantity=q)
            for i, (p, q) in enumerate([("10", 1), ("10.01", 1), ("9.99", 1), ("3000.0001", 300), ("7", 1), ("7.01", 1)])]
    flags = rows_of(base_of(spark, rows), "amazon_order_id", "low_price_candidate_flag")
    assert [f for _, f in flags] == [True, False, True, True, True, True]
    flags = rows_of(base_of(spark, rows, low="7"), "amazon_order_id", "low_price_candidate_flag")
    assert [f for _, f in flags] == [False, False, False, False, True, False]


def spend(spark, rows):
    given = dict(store_name="SY-US", report_date=dt.date(2025, 1, 15), sku="sku-a", ad_type="SP", orders=1)
    return frame(spark, "ods_ad_spend_daily", [{**given, **r} for r in rows])


def test_daily_demand(spark):
    got = demand.ad_demand_daily(spend(spark, [
        dict(orders=3, asin=""), dict(orders=2, ad_type="SD", asin="B2"), dict(orders=0, ad_type="SP"),
        dict(sku="__store__"), dict(sku=" "), dict(ad_type="SB"), dict(report_date=dt.date(2025, 1, 16), sku=" Sku-A "),
    ]))
    assert rows_of(got, "report_date", "sku_key", "sp_orders", "sd_orders", "ad_orders_raw", "asin",
                   "positive_ad_type_count", "multi_ad_type_flag") == [
        (dt.date(2025, 1, 15), "SKU-A", 3, 2, 5, "B2", 2, True),
        (dt.date(2025, 1, 16), "SKU-A", 1, 0, 1, None, 1, False),
    ]


def many(count, **changes):
    return [dict(amazon_order_id=f"o{i:02d}", purchase_date_utc=ts("2025-01-15T12:00:00") + dt.timedelta(minutes=i),
                 **changes) for i in range(count)]


@pytest.mark.parametrize("method", ["window", "sorted"])
def test_day_allocation_flags_every_candidate(spark, method):
    lines = base_of(spark, many(4) + [dict(amazon_order_id="z", sku="other")])
    want = demand.ad_demand_daily(spend(spark, [dict(orders=1), dict(orders=2, ad_type="SD")]))
    got = allocate.allocate_day_sku(lines, want, method=method)
    assert rows_of(got, "amazon_order_id", "candidate_rank", "candidate_orders", "estimated_ad_flag",
                   "allocated_ad_orders", "unallocated_ad_orders") == [
        (f"o{i:02d}", i + 1, 4, i < 3, 3, 0) for i in range(4)]


@pytest.mark.parametrize("method", ["window", "sorted"])
def test_hybrid_levels(spark, method):
    # Day target max(1,2)=2; a day without supply asks for 2 more; a SKU nobody bought asks for 1.
    lines = base_of(spark, many(6, sku="A") + [dict(amazon_order_id=f"x{i}", sku="B") for i in range(3)])
    want = demand.ad_demand_daily(spend(spark, [
        dict(sku="a", orders=1), dict(sku="a", orders=2, ad_type="SD"),
        dict(sku="a", orders=2, report_date=dt.date(2025, 1, 20)), dict(sku="c", orders=1)]))
    got = allocate.allocate_hybrid(lines, want, day_method=method, store_method=method)
    assert rows_of(got, "amazon_order_id", "allocation_level", "allocation_confidence", "candidate_rank",
                   "candidate_orders", "ad_orders_raw") == [
        ("o00", DAY_SKU, "HIGH", 1, 6, 3), ("o01", DAY_SKU, "HIGH", 2, 6, 3),
        ("o02", MONTH_SKU, "MEDIUM", 1, 4, 5), ("o03", MONTH_SKU, "MEDIUM", 2, 4, 5),
        ("x0", STORE_MONTH, "LOW", 1, 5, 6),
    ]
    seen = audit.hybrid_audit(want, got)
    assert rows_of(seen, "raw_ad_orders", "conservative_target_orders", "day_sku_allocated", "month_sku_allocated",
                   "store_month_allocated", "unallocated_orders", "allocation_pct") == [
        (6, 5, 2, 2, 1, 0, Decimal("100.0000"))]


def _hybrid_by_hand(candidates, days):
    """The three levels one after the other over plain lists."""
    taken = {}
    for (store, date, sku), (sp, sd) in days.items():
        pool = sorted((c for c in candidates if (c[0], c[1], c[2]) == (store, date, sku)), key=lambda c: (c[4], c[3]))
        for rank, c in enumerate(pool[:max(sp, sd)], 1):
            taken[c] = (DAY_SKU, rank, len(pool))
    for level, key, order in (
        (MONTH_SKU, lambda s, d, k: (s, d.replace(day=1), k), lambda c: (c[4], c[3], c[1])),
        (STORE_MONTH, lambda s, d, k: (s, d.replace(day=1)), lambda c: (c[4], c[3], c[2])),
    ):
        target, used = {}, {}
        for (store, date, sku), (sp, sd) in days.items():
            group = key(store, date, sku)
            target[group] = target.get(group, 0) + max(sp, sd)
        for c in taken:
            group = key(c[0], c[1], c[2])
            used[group] = used.get(group, 0) + 1
        for group, wanted in target.items():
            pool = sorted((c for c in candidates if c not in taken and key(c[0], c[1], c[2]) == group), key=order)
            for rank, c in enumerate(pool[:max(wanted - used.get(group, 0), 0)], 1):
                taken[c] = (level, rank, len(pool))
    return taken


@pytest.mark.parametrize("seed", [1, 2])
def test_hybrid_against_plain_lists(spark, seed):
    rng = random.Random(seed)
    rows, days = [], {}
    for i in range(260):
        # One SKU of one store gets a third of the rows.
        hot = rng.random() < 0.34
        day = 3 if hot else rng.randint(1, 40)
        rows.append(dict(
            store_name="S1" if hot else rng.choice(["S1", "S2"]), sku="A" if hot else rng.choice("ABCD"),
            amazon_order_id=f"o{rng.randint(0, 150)}", order_item_id=str(i),
            promotion_ids="mpc-1" if rng.random() < 0.1 else None,
            purchase_date_utc=ts("2025-01-01T20:00:00") + dt.timedelta(days=day - 1, minutes=rng.randint(0, 30)),
        ))
    ads = []
    for _ in range(60):
        key = (rng.choice(["S1", "S2"]), dt.date(2025, 1, 1) + dt.timedelta(days=rng.randint(0, 39)), rng.choice("ABCDE"))
        kind, n = rng.choice(["SP", "SD"]), rng.randint(1, 5)
        ads.append(dict(store_name=key[0], report_date=key[1], sku=key[2], ad_type=kind, orders=n))
        sp, sd = days.get(key, (0, 0))
        days[key] = (sp + n, sd) if kind == "SP" else (sp, sd + n)
    lines = base_of(spark, rows).persist()
    found = allocate.order_sku_candidates(lines).select(
        "store_name", "order_date", "sku_key", "amazon_order_id", "first_purchase_date_utc").collect()
    expected = {
        tuple(c)[:4]: v for c, v in _hybrid_by_hand([tuple(r) for r in found], days).items()
    }
    want = demand.ad_demand_daily(spend(spark, ads))
    for method in ("window", "sorted"):
        got = {
            (r.store_name, r.order_date, r.sku_key, r.amazon_order_id):
                (r.allocation_level, r.candidate_rank, r.candidate_orders)
            for r in allocate.allocate_hybrid(lines, want, day_method=method, store_method=method).collect()
        }
        assert got == expected
    lines.unpersist()


def test_ranking_methods_agree_on_a_hot_group(spark):
    # A third of the rows share one key, and many share one timestamp.
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("g"),
        (F.col("id") % 5).alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("o"),
    )
    plain = rank_in_group(rows, ["g"], ["t", "o"], method="window")
    split = rank_in_group(rows, ["g"], ["t", "o"], method="sorted")
    assert rows_of(split, "g", "t", "o", "candidate_rank", "candidate_orders") == rows_of(
        plain, "g", "t", "o", "candidate_rank", "candidate_orders")
    with pytest.raises(ValueError):
        rank_in_group(rows, ["g"], ["o"], method="other")


@pytest.mark.parametrize("instants", [1, 7, 900])
def test_first_rows_of_a_group_are_those_of_the_whole_ranking(spark, instants):
    # A third of the rows share one group; rows without an instant come first; some groups want none or more than they have.
    g = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40)
    at = F.make_timestamp_ntz(F.lit(2025), F.lit(3), (F.col("id") % instants % 28 + 1).cast("int"),
                              (F.col("id") % instants % 24).cast("int"), F.lit(0), F.lit(0))
    rows = spark.range(900).select(
        g.alias("g"), F.when(F.col("id") % 11 != 0, at).alias("t"),
        F.sha2(F.col("id").cast("string"), 256).alias("o"),
    ).withColumn("k", F.when(F.col("g") == 0, 120).when(F.col("g") < 10, F.col("g") - 2).when(F.col("g") < 30, 4))
    columns = ["g", "t", "o", "k", "candidate_rank", "candidate_orders"]
    whole = rank_in_group(rows, ["g"], ["t", "o"], method="window").filter("candidate_rank <= k")
    first = first_in_group(rows, ["g"], ["t", "o"], "k")
    assert first.columns == columns
    assert rows_of(first, *columns) == rows_of(whole, *columns)
    assert first_in_group(rows.limit(0), ["g"], ["t", "o"], "k").count() == 0


def test_only_rows_up_to_the_last_one_wanted_are_sorted(spark, monkeypatch):
    from merchlens.operators import ranking

    seen = {}
    kept = ranking.materialize

    def counted(df, label):
        out = kept(df, label)
        seen[label] = out.count()
        return out

    monkeypatch.setattr(ranking, "materialize", counted)
    start = F.lit("2025-03-01").cast("timestamp_ntz")
    rows = spark.range(2400).select(
        F.lit("s").alias("g"), (start + F.make_dt_interval(hours=(F.col("id") / 10).cast("int"))).alias("t"),
        F.col("id").alias("o"), F.lit(25).alias("k"),
    )
    got = first_in_group(rows, ["g"], ["t", "o"], "k")
    assert rows_of(got, "o", "candidate_rank", "candidate_orders") == sorted(
        ((i, i + 1, 2400) for i in range(25)), key=lambda r: str(r[0]))
    assert seen == {"rank-candidates": 2400, "rank-sorted": 30}


def performance(spark, rows):
    given = dict(report_month=dt.date(2025, 1, 1), store_name="SY-US", sid=1, order_items=10, ad_order_quantity=1,
                 promotion_order_items=0, volume=1, amount=Decimal(1))
    rows = [{**given, "msku": f"m{i}", **r} for i, r in enumerate(rows)]
    return frame(spark, "ods_product_performance_monthly_msku", rows)


def test_store_month_allocation_and_audit(spark):
    mixed = [dict(amazon_order_id="m", sku="M", order_item_id="1", promotion_ids="mpc-9"),
             dict(amazon_order_id="m", sku="M", order_item_id="2")]
    two_days = [dict(amazon_order_id="d", sku="D", order_item_id=str(i), purchase_date_utc=ts(f"2025-01-1{i}T12:00:00"))
                for i in (1, 2)]
    lines = base_of(spark, mixed + two_days + [dict(store_name="RKZ-US")])
    target = demand.ad_demand_monthly(performance(spark, [
        dict(ad_order_quantity=9), dict(store_name="RKZ-US", ad_order_quantity=0),
        dict(store_name="NONE-US", ad_order_quantity=None, order_items=None)]))
    chosen = allocate.allocate_store_month(lines, target)
    assert rows_of(chosen, "amazon_order_id", "order_date", "candidate_rank") == [
        ("d", dt.date(2025, 1, 11), 1), ("d", dt.date(2025, 1, 12), 2), ("m", dt.date(2025, 1, 15), 3)]
    seen = audit.allocation_audit(target, lines, chosen)
    assert rows_of(seen, "store_name", "base_order_sku_count", "offsite_order_sku_count", "non_offsite_capacity",
                   "allocated_ad_orders", "unallocated_ad_orders", "allocation_pct", "source_gap_order_sku") == [
        ("NONE-US", 0, 0, 0, 0, 0, Decimal("0.0000"), 0),
        ("RKZ-US", 1, 0, 1, 0, 0, Decimal("0.0000"), 9),
        # Capacity counts the mixed order-SKU as off-site and the two-day one once.
        ("SY-US", 2, 1, 1, 3, 6, Decimal("33.3333"), 8),
    ]
    status = {r.store_name: r.status for r in audit.audit_report(seen).collect()}
    assert status == {"NONE-US": "需检查", "RKZ-US": "需检查", "SY-US": "需检查"}
    result = classify.classify(lines, chosen, RULES["v5"])
    off = result.filter("offsite_flag").first()
    assert (off.main_order_type, off.estimated_ad_flag) == (OFFSITE, True)
    spark.catalog.dropTempView("older_audit")
    view = audit.create_audit_view(seen, "older_audit")
    assert view.columns == audit.AUDIT_VIEW_COLUMNS and view.count() == 3
    assert audit.create_audit_view(seen.limit(0), "older_audit").count() == 0


LINES = [
    dict(amazon_order_id="ad", item_promotion_discount=Decimal(1), purchase_date_utc=ts("2025-01-02T12:00:00")),
    dict(amazon_order_id="off", promotion_ids="MPC-1"), dict(amazon_order_id="promo", item_price=Decimal(5), promotion_ids="PLM-1"),
    dict(amazon_order_id="low", item_price=Decimal(8)), dict(amazon_order_id="plain"),
]


def test_classes_under_each_rule_set(spark):
    lines = base_of(spark, LINES)
    target = demand.ad_demand_monthly(performance(spark, [{}]))
    chosen = allocate.allocate_store_month(lines, target)
    kinds = {}
    for name in ("v3", "v5"):
        result = classify.classify(lines, chosen, RULES[name])
        kinds[name] = dict(rows_of(result, "amazon_order_id", "main_order_type"))
    assert kinds["v3"] == {"ad": ADS, "off": OFFSITE, "promo": ONSITE, "low": LOW_PRICE, "plain": ORGANIC}
    assert kinds["v5"] == {"ad": ADS, "off": OFFSITE, "promo": ORGANIC, "low": LOW_PRICE, "plain": ORGANIC}
    five = classify.classify(lines, chosen, RULES["v5"])
    monthly = dict(rows_of(rollup.source_monthly(five, RULES["v5"]), "main_order_type", "classified_item_rows"))
    assert monthly == {ADS: 1, OFFSITE: 1, LOW_PRICE: 1, ORGANIC: 2, ONSITE: 2}
    seven = classify.reclassify(five, RULES["v4"])
    assert dict(rows_of(seven, "amazon_order_id", "main_order_type"))["low"] == ORGANIC
    assert dict(rows_of(seven, "amazon_order_id", "main_order_type"))["promo"] == ONSITE
    again = classify.reclassify(seven, RULES["v5"])
    assert rows_of(again, *five.columns) == rows_of(five, *five.columns)


def _stored(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    feb = [dict(r, purchase_date_utc=r.get("purchase_date_utc", ts("2025-01-15T12:00:00")) + dt.timedelta(days=31))
           for r in LINES]
    wh.append("ods_amz_all_orders_report", orders_frame(
        spark, LINES + feb + [dict(r, store_name="RKZ-US") for r in LINES]))
    wh.append("ods_product_performance_monthly_msku", performance(spark, [
        {}, dict(store_name="RKZ-US", sid=2), dict(report_month=dt.date(2025, 2, 1))]))
    wh.append("ods_ad_spend_daily", spend(spark, [dict(orders=2)]))
    return wh


def test_job_rebuilds_only_its_scope(spark, tmp_path):
    wh = _stored(spark, tmp_path)
    all_rows = rows_of(run_attribution(wh, RULES["v5"]), "order_month", "store_name", "main_order_type", "units")
    assert len(all_rows) == 15
    versions = rollup.rule_version_check(wh.read("dwd_amz_order_attribution_result")).collect()
    assert [(r.rule_version, r.item_rows) for r in versions] == [(RULES["v5"].version, 15)]
    # One store of two again: the other one keeps its demand, allocation and result.
    run_attribution(wh, RULES["v5"], Scope.of("2025-01-01", "2025-02-01", "SY-US"))
    monthly = wh.read("dws_amz_order_source_monthly")
    assert rows_of(monthly, "order_month", "store_name", "main_order_type", "units") == all_rows
    assert wh.read("dwd_amz_ad_order_allocation").count() == 3
    # A month that lost its rows is emptied, its neighbours stay.
    orders = wh.read("ods_amz_all_orders_report")
    jan = orders.filter((F.col("store_name") == "SY-US") & (F.col("purchase_date_utc") < "2025-02-01"))
    rest = orders.filter(~((F.col("store_name") == "SY-US") & (F.col("purchase_date_utc") < "2025-02-01")))
    wh.merge("ods_amz_all_orders_report", rest, jan, orders.limit(0))
    run_attribution(wh, RULES["v5"], Scope.of("2025-01-01", "2025-02-01"))
    left = rows_of(wh.read("dws_amz_order_source_monthly"), "order_month", "store_name", "main_order_type", "units")
    assert left == [r for r in all_rows if not (r[0] == dt.date(2025, 1, 1) and r[1] == "SY-US")]
    assert wh.read("dws_amz_product_performance_ad_monthly_audit").filter("store_name = 'SY-US'").count() == 2


def test_job_reclassifies_without_allocating(spark, tmp_path):
    wh = _stored(spark, tmp_path)
    run_attribution(wh, RULES["v3"])
    before = rows_of(wh.read("dwd_amz_ad_order_allocation"), "store_name", "order_date", "amazon_order_id")
    monthly = run_reclassification(wh, RULES["v5"])
    direct = warehouse(spark, tmp_path, "direct")
    for table in ("ods_amz_all_orders_report", "ods_product_performance_monthly_msku"):
        direct.append(table, wh.read(table))
    expected = run_attribution(direct, RULES["v5"])
    assert rows_of(monthly, *monthly.columns) == rows_of(expected, *expected.columns)
    assert rows_of(wh.read("dwd_amz_ad_order_allocation"), "store_name", "order_date", "amazon_order_id") == before
    run_attribution(wh, RULES["v2"])
    assert rows_of(wh.read("dws_amz_ad_allocation_monthly_audit"), "total_allocated") == [(2,)]


def test_stores_and_ad_types_compare_without_case(spark, tmp_path):
    from merchlens.plans.attribution import default_scope

    wh = warehouse(spark, tmp_path)
    wh.append("ods_ad_spend_daily", spend(spark, [dict(orders=2, ad_type="sp")]))
    assert default_scope(wh, RULES["v1"]).stores is not None
    names = [r.store_name for r in wh.read("ods_ad_spend_daily").collect()]
    scope = Scope.of("2000-01-01", "2100-01-01", names[0].upper())
    mixed = spark.createDataFrame([(names[0].lower(),), (names[0].upper(),), ("other",)], "store_name string")
    assert [r[0] for r in scope.fold_store(mixed).collect()] == [names[0].upper()] * 2


def test_rollup_needs_no_expand(spark):
    from merchlens.operators.rollup import source_monthly

    rows = spark.createDataFrame(
        [], "order_month date, store_name string, main_order_type string, onsite_promotion_flag boolean, "
        "amazon_order_id string, sku_key string, quantity bigint, gross_item_sales decimal(18,4), net_item_sales decimal(18,4)")
    assert "Expand" not in source_monthly(rows, RULES["v5"])._jdf.queryExecution().executedPlan().toString()


def test_invariants_on_the_tables(spark, folder):
    from merchlens.session import materialize
    from merchlens.sources import star_tables as star

    stored = materialize(star.order_lines(spark, folder))
    lines = materialize(star.base(stored))
    target = materialize(demand.ad_demand_monthly(star.performance_monthly(stored)))
    rules = RULES["v5"].with_low_price(star.LOW_PRICE)
    chosen = materialize(allocate.allocate_store_month(lines, target))
    result = classify.classify(lines, chosen, rules)
    monthly = rollup.source_monthly(result, rules)
    assert result.count() == lines.count()
    primary = monthly.filter(F.col("main_order_type") != ONSITE).agg(F.sum("classified_item_rows")).first()[0]
    assert primary == lines.count()
    supply = allocate.order_sku_candidates(lines).groupBy("order_month", "store_name").count()
    taken = chosen.groupBy("order_month", "store_name").agg(F.count(F.lit(1)).alias("taken"))
    joined = target.join(supply, ["order_month", "store_name"], "left").join(taken, ["order_month", "store_name"], "left")
    wrong = joined.filter(F.coalesce("taken", F.lit(0)) != F.least("ad_order_quantity", F.coalesce("count", F.lit(0))))
    assert wrong.count() == 0
