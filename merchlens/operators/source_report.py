"""Source reports over the monthly rollup: overall, month, quarter, half-year, store-month."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.functions.dates import half_name, half_start, month_label, quarter_name, quarter_start
from merchlens.operators.rollup import metric_role, source_order
from merchlens.rules import ALL_STORES, DISPLAY_ORDER, ONSITE, PRIMARY_TOTAL
from merchlens.scope import Scope, add_months

COUNTS = ("classified_item_rows", "order_sku_count", "amazon_order_count", "units")
MONEY = ("gross_item_sales", "net_item_sales")
COMPLETE, INCOMPLETE = "完整周期", "未完结周期"


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in (*COUNTS, *MONEY)]


def _zero_filled(df: DataFrame) -> DataFrame:
    zero_money = F.lit(0).cast("decimal(30,4)")
    return df.withColumns({
        **{c: F.coalesce(c, F.lit(0)) for c in COUNTS},
        **{c: F.coalesce(F.col(c).cast("decimal(30,4)"), zero_money) for c in MONEY},
    })


def _with_shares(df: DataFrame, keys: list[str], money_share: bool = True) -> DataFrame:
    """Shares of the primary total of each key group; the display row has none.

    A group is the five sources of one report cell, so the window is small.
    """
    cell = Window.partitionBy(*keys)
    primary = F.col("main_order_type") != ONSITE

    def share(column: str) -> Column:
        value = F.col(column).cast("double")
        total = F.sum(F.when(primary, F.col(column))).over(cell).cast("double")
        part = F.when(total == 0, F.lit(0.0)).otherwise(F.try_divide(value, total))
        return F.when(primary, F.coalesce(part, F.lit(0.0)))

    out = df.withColumn("order_sku_share", share("order_sku_count"))
    return out.withColumn("net_sales_share", share("net_item_sales")) if money_share else out


def _every_source(df: DataFrame) -> DataFrame:
    return df.withColumn("main_order_type", F.explode(F.array(*[F.lit(s) for s in DISPLAY_ORDER])))


def _stores(detail: DataFrame, scope: Scope) -> DataFrame:
    """Requested stores, or those with data in the scope."""
    if scope.stores is None:
        return detail.select("store_name").distinct()
    return detail.sparkSession.createDataFrame([(s,) for s in dict.fromkeys(scope.stores)], "store_name string")


def report_overall(monthly: DataFrame, scope: Scope) -> DataFrame:
    """One row per source and a total row over the four primary sources."""
    detail = scope.apply(monthly).filter(F.col("main_order_type").isin(*DISPLAY_ORDER))
    sums = detail.groupBy("main_order_type").agg(*_sums())
    spine = _every_source(detail.sparkSession.range(1).select())
    rows = _zero_filled(spine.join(sums, "main_order_type", "left"))
    shared = _with_shares(rows.withColumn("_all", F.lit(1)), ["_all"])
    total = rows.filter(F.col("main_order_type") != ONSITE).agg(*_sums()).withColumns({
        "main_order_type": F.lit(PRIMARY_TOTAL),
        "order_sku_share": F.lit(1.0),
        "net_sales_share": F.lit(1.0),
    })
    columns = ["main_order_type", "order_sku_count", "order_sku_share", "units", "net_item_sales", "net_sales_share"]
    place = F.when(F.col("main_order_type") == PRIMARY_TOTAL, F.lit(99)).otherwise(source_order())
    return shared.select(*columns).unionByName(total.select(*columns)).orderBy(place)


def report_month(monthly: DataFrame, scope: Scope) -> DataFrame:
    """Month and source over all stores, for the months that have data."""
    detail = scope.apply(monthly)
    sums = detail.groupBy("order_month", "main_order_type").agg(*_sums())
    spine = _every_source(detail.select("order_month").distinct())
    rows = _zero_filled(spine.join(sums, ["order_month", "main_order_type"], "left"))
    return _with_shares(rows, ["order_month"]).select(
        month_label("order_month").alias("month"), "main_order_type",
        metric_role().alias("metric_role"), "order_sku_count", "order_sku_share", "units",
        *MONEY, "net_sales_share",
    ).orderBy("month", source_order())


def report_store_month(monthly: DataFrame, scope: Scope) -> DataFrame:
    """Month, store and source with zero rows for every store and month that has data."""
    detail = scope.apply(monthly)
    spine = (
        _stores(detail, scope)
        .withColumn("order_month", F.explode(F.array(*[F.lit(m) for m in scope.months])))
        .join(detail.select("order_month").distinct(), "order_month", "left_semi")
    )
    keys = ["order_month", "store_name"]
    sums = detail.groupBy(*keys, "main_order_type").agg(*_sums())
    rows = _zero_filled(_every_source(spine).join(sums, [*keys, "main_order_type"], "left"))
    return _with_shares(rows, keys, money_share=False).select(
        month_label("order_month").alias("month"), "store_name", "main_order_type",
        metric_role().alias("metric_role"), *COUNTS, *MONEY, "order_sku_share",
    ).orderBy("month", "store_name", source_order())


@dataclass(frozen=True)
class Period:
    start: dt.date
    label: str
    expected_months: int
    complete: bool


def periods(scope: Scope, kind: str, include_partial: bool = False) -> list[Period]:
    """Calendar quarters or half-years that overlap the scope."""
    step, name = (3, quarter_name) if kind == "quarter" else (6, half_name)
    first = dt.date(scope.start.year, (scope.start.month - 1) // step * step + 1, 1)
    found = []
    while first < scope.end:
        last = add_months(first, step)
        complete = scope.start <= first and last <= scope.end
        if complete or include_partial:
            found.append(Period(first, name(first), step, complete))
        first = last
    return found


def report_period(monthly: DataFrame, scope: Scope, kind: str, include_partial: bool = False) -> DataFrame:
    """Quarter or half-year by (all stores, each store) and source.

    A period is complete when the scope covers its calendar span and every
    expected month has data for that store row.
    """
    if kind not in ("quarter", "half"):
        raise ValueError(f"unknown period kind {kind!r}")
    spark = monthly.sparkSession
    plan = periods(scope, kind, include_partial)
    frame = spark.createDataFrame(
        [(p.start, p.label, p.expected_months, p.complete) for p in plan],
        "period_start date, period string, expected_months int, calendar_complete boolean",
    )
    start_of = quarter_start if kind == "quarter" else half_start
    stores = _stores(scope.apply(monthly), scope)
    # Each fact counts for its own store and for the all-stores row.
    facts = (
        scope.apply(monthly)
        .withColumn("period_start", start_of("order_month"))
        .withColumn("store_name", F.explode(F.array(F.lit(ALL_STORES), F.col("store_name"))))
    )
    cell = ["period_start", "store_name"]
    sums = facts.groupBy(*cell, "main_order_type").agg(*_sums())
    covered = facts.groupBy(*cell).agg(F.count_distinct("order_month").alias("covered_months"))
    labels = stores.unionByName(spark.createDataFrame([(ALL_STORES,)], "store_name string"))
    starts = F.array(*[F.lit(p.start) for p in plan]) if plan else F.array().cast("array<date>")
    spine = labels.withColumn("period_start", F.explode(starts)).join(F.broadcast(frame), "period_start")
    rows = _zero_filled(
        _every_source(spine).join(sums, [*cell, "main_order_type"], "left").join(covered, cell, "left")
    ).withColumn("covered_months", F.coalesce("covered_months", F.lit(0)))
    complete = F.col("calendar_complete") & (F.col("covered_months") == F.col("expected_months"))
    all_first = F.when(F.col("store_name") == ALL_STORES, F.lit(0)).otherwise(F.lit(1))
    return (
        _with_shares(rows, cell)
        .orderBy("period_start", all_first, "store_name", source_order())
        .select(
            "period", F.when(complete, F.lit(COMPLETE)).otherwise(F.lit(INCOMPLETE)).alias("period_status"),
            "store_name", "main_order_type", metric_role().alias("metric_role"), "covered_months",
            "order_sku_count", "order_sku_share", "units", "net_item_sales", "net_sales_share",
        )
    )


def report_quarter(monthly: DataFrame, scope: Scope, include_partial: bool = False) -> DataFrame:
    return report_period(monthly, scope, "quarter", include_partial)


def report_half(monthly: DataFrame, scope: Scope, include_partial: bool = False) -> DataFrame:
    return report_period(monthly, scope, "half", include_partial)
