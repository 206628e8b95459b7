"""Allocation of ad orders, which carry no order id, to ranked order-SKUs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.operators.ranking import first_in_group, rank_in_group
from merchlens.session import materialize
from merchlens.rules import CONFIDENCE, DAY_SKU, MONTH_SKU, STORE_MONTH

CANDIDATE = ["store_name", "order_month", "order_date", "sku_key", "amazon_order_id"]
ALLOCATION_COLUMNS = [
    "store_name", "order_date", "order_month", "sku_key", "amazon_order_id",
    "first_purchase_date_utc", "candidate_rank", "candidate_orders",
    "sp_orders", "sd_orders", "ad_orders_raw", "allocated_ad_orders",
    "unallocated_ad_orders", "estimated_ad_flag",
    "allocation_level", "allocation_confidence", "allocation_version",
]


def order_sku_candidates(base: DataFrame) -> DataFrame:
    """Order-SKUs with at least one line outside off-site promotion, by first purchase."""
    return (
        base.filter(~F.col("offsite_flag"))
        .groupBy(*CANDIDATE)
        .agg(F.min("purchase_date_utc").alias("first_purchase_date_utc"))
    )


def _ranked_by_day(base: DataFrame, demand_daily: DataFrame, method: str) -> DataFrame:
    # Demand is joined before the ranking: it drops what has none, and stays on the row.
    demand = demand_daily.filter("ad_orders_raw > 0").select(
        "store_name", F.col("report_date").alias("order_date"), "sku_key",
        "sp_orders", "sd_orders", "ad_orders_raw",
    )
    wanted = order_sku_candidates(base).join(demand, ["store_name", "order_date", "sku_key"])
    return rank_in_group(
        wanted, ["store_name", "order_date", "sku_key"], ["first_purchase_date_utc", "amazon_order_id"],
        method=method,
    )


def day_sku_rank(base: DataFrame, demand_daily: DataFrame, method: str = "sized") -> DataFrame:
    """Candidates on days with demand for their SKU, ranked within store, day and SKU."""
    return _ranked_by_day(base, demand_daily, method).drop("sp_orders", "sd_orders", "ad_orders_raw")


def allocate_day_sku(
    base: DataFrame, demand_daily: DataFrame, version: str = "v1_20260727", method: str = "sized"
) -> DataFrame:
    """Every candidate of a demanded day-SKU with a flag for those within the demand."""
    return _ranked_by_day(base, demand_daily, method).withColumns({
        "allocated_ad_orders": F.least("ad_orders_raw", "candidate_orders"),
        "unallocated_ad_orders": F.greatest(F.col("ad_orders_raw") - F.col("candidate_orders"), F.lit(0)),
        "estimated_ad_flag": F.col("candidate_rank") <= F.col("ad_orders_raw"),
        "allocation_level": F.lit(None).cast("string"),
        "allocation_confidence": F.lit(None).cast("string"),
        "allocation_version": F.lit(version),
    }).select(*ALLOCATION_COLUMNS)


def _first_of_month(candidates: DataFrame, wanted: str, method: str) -> DataFrame:
    """The first ``wanted`` candidates of each store and month, ranked among all of them."""
    group = ["store_name", "order_month"]
    order = ["first_purchase_date_utc", "amazon_order_id", "sku_key", "order_date"]
    if method == "first":
        return first_in_group(candidates, group, order, wanted)
    return rank_in_group(candidates, group, order, method=method).filter(F.col("candidate_rank") <= F.col(wanted))


def allocate_store_month(
    base: DataFrame,
    demand_monthly: DataFrame,
    version: str = "v3_product_month_20260727",
    method: str = "first",
) -> DataFrame:
    """The first ``ad_order_quantity`` candidates of each store and month.

    ``method`` is ``first`` (rank only rows up to the last one wanted) or a method of ``rank_in_group``.
    """
    demand = demand_monthly.filter("ad_order_quantity > 0").select(
        "store_name", "order_month", "ad_order_quantity"
    )
    # Candidates of store-months without a target leave before the ranking.
    wanted = order_sku_candidates(base).join(demand, ["store_name", "order_month"])
    return _first_of_month(wanted, "ad_order_quantity", method).withColumns({
        "sp_orders": F.lit(0).cast("long"),
        "sd_orders": F.lit(0).cast("long"),
        "ad_orders_raw": F.lit(1).cast("long"),
        **_chosen(STORE_MONTH, version),
    }).select(*ALLOCATION_COLUMNS)


def _chosen(level: str, version: str) -> dict:
    return {
        "allocated_ad_orders": F.lit(1).cast("long"),
        "unallocated_ad_orders": F.lit(0).cast("long"),
        "estimated_ad_flag": F.lit(True),
        "allocation_level": F.lit(level),
        "allocation_confidence": F.lit(CONFIDENCE[level]),
        "allocation_version": F.lit(version),
    }


def day_sku_ledger(candidates: DataFrame, demand_daily: DataFrame) -> DataFrame:
    """Per store, day and SKU: target, candidates, and what levels one and two take.

    A day takes its own target from its first candidates. What the month still
    lacks goes to the rest of the SKU's candidates, days in order. Because the
    taken ones lead each day, a candidate's place among the rest follows from its
    place in the day and these counts, without a second ranking. A SKU has at
    most 31 days in a month, so the windows here are small.
    """
    day = ["store_name", "order_month", "order_date", "sku_key"]
    supply = candidates.groupBy(*day).agg(F.count(F.lit(1)).alias("day_candidates"))
    target = demand_daily.select(
        "store_name", "order_month", F.col("report_date").alias("order_date"), "sku_key",
        "sp_orders", "sd_orders", "ad_orders_raw",
        F.greatest("sp_orders", "sd_orders").alias("day_target"),
    )
    both = supply.join(target, day, "full").na.fill(
        0, ["day_candidates", "sp_orders", "sd_orders", "ad_orders_raw", "day_target"]
    )
    sku_month = Window.partitionBy("store_name", "order_month", "sku_key")
    earlier = sku_month.orderBy("order_date").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.least("day_target", "day_candidates")
    rest = F.col("day_candidates") - F.col("day_taken")
    return (
        both.withColumn("day_taken", taken)
        .withColumns({
            "rest_before": F.coalesce(F.sum(rest).over(earlier), F.lit(0)),
            "month_rest": F.sum(rest).over(sku_month),
            "month_sp": F.sum("sp_orders").over(sku_month),
            "month_sd": F.sum("sd_orders").over(sku_month),
            "month_raw": F.sum("ad_orders_raw").over(sku_month),
            "month_residual": F.greatest(
                F.sum(F.col("day_target") - F.col("day_taken")).over(sku_month), F.lit(0)
            ),
        })
        # Of the month's residual, the part that falls on this day's rest.
        .withColumn(
            "day_taken_for_month",
            F.greatest(
                F.least(F.col("month_residual") - F.col("rest_before"), rest), F.lit(0)
            ),
        )
    )


def allocate_hybrid(
    base: DataFrame,
    demand_daily: DataFrame,
    version: str = "v2_hybrid_20260727",
    day_method: str = "sized",
    store_method: str = "first",
) -> DataFrame:
    """Three levels: same day and SKU, then same month and SKU, then store and month."""
    # Read for the ledger and for the placing.
    candidates = materialize(order_sku_candidates(base), "hybrid-candidates")
    # Read for the placing and for what the store still lacks.
    ledger = materialize(day_sku_ledger(candidates, demand_daily), "hybrid-ledger")
    day = ["store_name", "order_month", "order_date", "sku_key"]
    placed = rank_in_group(
        candidates.join(ledger, day), day, ["first_purchase_date_utc", "amazon_order_id"],
        rank="day_rank", size="day_size", method=day_method, known="day_candidates",
    )
    place_in_rest = F.col("day_rank") - F.col("day_taken") + F.col("rest_before")
    placed = placed.withColumn("month_rank", place_in_rest).withColumn(
        "level",
        F.when(F.col("day_rank") <= F.col("day_target"), F.lit(DAY_SKU)).when(
            F.col("month_rank") <= F.col("month_residual"), F.lit(MONTH_SKU)
        ),
    )

    # Two levels read these rows; they are ranked once.
    placed = materialize(placed, "hybrid-placed")

    def pick(day, month):
        return F.when(F.col("level") == DAY_SKU, day).otherwise(month)

    by_sku = placed.filter(F.col("level").isNotNull()).select(
        *CANDIDATE, "first_purchase_date_utc",
        pick(F.col("day_rank"), F.col("month_rank")).alias("candidate_rank"),
        pick(F.col("day_size"), F.col("month_rest")).alias("candidate_orders"),
        pick(F.col("sp_orders"), F.col("month_sp")).alias("sp_orders"),
        pick(F.col("sd_orders"), F.col("month_sd")).alias("sd_orders"),
        pick(F.col("ad_orders_raw"), F.col("month_raw")).alias("ad_orders_raw"),
        "level",
    )
    store_month = ledger.groupBy("store_name", "order_month").agg(
        F.sum("sp_orders").alias("sp_orders"),
        F.sum("sd_orders").alias("sd_orders"),
        F.sum("ad_orders_raw").alias("ad_orders_raw"),
        F.greatest(
            F.sum(F.col("day_target") - F.col("day_taken") - F.col("day_taken_for_month")), F.lit(0)
        ).alias("store_residual"),
    ).filter("store_residual > 0")
    rest = (
        placed.filter(F.col("level").isNull())
        .select(*CANDIDATE, "first_purchase_date_utc")
        .join(store_month, ["store_name", "order_month"])
    )
    by_store = (
        _first_of_month(rest, "store_residual", store_method)
        .withColumn("level", F.lit(STORE_MONTH))
        .select(*by_sku.columns)
    )
    confidence = F.lit(None).cast("string")
    for level, value in CONFIDENCE.items():
        confidence = F.when(F.col("level") == level, F.lit(value)).otherwise(confidence)
    return by_sku.unionByName(by_store).withColumns({
        **_chosen(STORE_MONTH, version),
        "allocation_level": F.col("level"),
        "allocation_confidence": confidence,
    }).select(*ALLOCATION_COLUMNS)
