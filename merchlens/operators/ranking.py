"""Row numbers within groups, for groups bounded by nature and for groups of any size.

``number_by_window`` puts each group in one task: right where a group is bounded, as
the orders of one store, day and SKU are. ``number_by_sort`` numbers groups of any
size, as the orders of a store and month are: one global sort, whose range
partitioning cuts a large group over many tasks; each row takes its place within its
own partition, and the small table of (group, partition) counts gives the offset to
add. Both give the same numbers, because the order columns identify a row within its
group; which one is used does not depend on the data.

``number_by_size`` is for many groups that are small as a rule and of any size at times:
rows of a group beyond ``WINDOW_ROWS`` go through ``number_by_sort``, all others through
``number_by_window``. Both ways are always planned; the numbers are the same either way.

``first_in_group`` numbers only the first rows of each group. Counts per group and hour,
which combine before their shuffle, tell the hour that holds the last row wanted and the
size of the group; only rows up to that hour are sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.session import materialize

#: Hours since 1970 stand for an instant; rows without one come first, as they are sorted.
NO_HOUR = -(2**31)
# monotonically_increasing_id keeps the partition above this bit, the place below.
PARTITION_SHIFT = 33
#: Rows of a group that one task sorts; more of them are sorted over many tasks.
WINDOW_ROWS = 100_000


def rank_in_group(
    df: DataFrame,
    group: list[str],
    order: list[str],
    rank: str = "candidate_rank",
    size: str = "candidate_orders",
    method: str = "sorted",
    known: str | None = None,
) -> DataFrame:
    """Add ``rank`` (1-based, by ``order``) and ``size`` (rows of the group).

    ``order`` must be unique within ``group``. ``method`` is ``window``, ``sorted`` or ``sized``; ``known``
    names a column that holds the rows of the group already, which ``sized`` then need not count.
    """
    if method == "window":
        return number_by_window(df, group, order, rank, size)
    if method == "sorted":
        return number_by_sort(df, group, order, rank, size)
    if method == "sized":
        return number_by_size(df, group, order, rank, size, known)
    raise ValueError(f"unknown ranking method {method!r}")


def number_by_window(df: DataFrame, group: list[str], order: list[str], rank: str, size: str) -> DataFrame:
    whole = Window.partitionBy(*group)
    return df.withColumns({
        rank: F.row_number().over(whole.orderBy(*order)).cast("long"),
        size: F.count(F.lit(1)).over(whole),
    })


def number_by_sort(df: DataFrame, group: list[str], order: list[str], rank: str, size: str) -> DataFrame:
    placed = materialize(
        df.orderBy(*group, *order).withColumn("_place", F.monotonically_increasing_id()), "rank-sorted"
    ).withColumn("_part", F.shiftright("_place", PARTITION_SHIFT))
    runs = placed.groupBy(*group, "_part").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # At most one row per partition and group here, so this window is small.
    of_group = Window.partitionBy(*group)
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        *group, "_part", "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(of_group).alias(size),
    )
    return (
        placed.join(offsets, [*group, "_part"])
        .withColumn(rank, F.col("_place") - F.col("_first") + 1 + F.col("_before"))
        .select(*df.columns, rank, size)
    )


def number_by_size(
    df: DataFrame, group: list[str], order: list[str], rank: str, size: str, known: str | None = None
) -> DataFrame:
    """As ``number_by_sort`` (rows with a null in ``group`` are left out); only large groups are sorted over many tasks."""
    whole = df.na.drop(subset=group)
    if known is not None:
        few, many = whole.filter(F.col(known) <= WINDOW_ROWS), whole.filter(F.col(known) > WINDOW_ROWS)
    else:
        stored = materialize(whole, "rank-rows")
        large = stored.groupBy(*group).count().filter(F.col("count") > WINDOW_ROWS).select(*group)
        # One row per WINDOW_ROWS rows at most; stored, as both sides read it.
        large = F.broadcast(materialize(large, "rank-large"))
        few, many = stored.join(large, group, "left_anti"), stored.join(large, group, "left_semi")
    numbered = number_by_window(few, group, order, rank, size)
    return numbered.unionByName(number_by_sort(many, group, order, rank, size))


def first_in_group(
    df: DataFrame,
    group: list[str],
    order: list[str],
    wanted: str,
    rank: str = "candidate_rank",
    size: str = "candidate_orders",
) -> DataFrame:
    """The first rows of each group, as many as its column ``wanted`` says, numbered as ``rank_in_group`` does.

    ``order`` must be unique within ``group`` and begin with a timestamp; ``wanted`` is one value
    per group (below one or null: no rows). ``size`` counts all rows of the group. Group columns hold
    no nulls. However many rows share an hour, or one instant, they are sorted over many tasks.
    """
    at = F.col(order[0])
    hour = F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date")) * 24 + F.hour(at)
    stored = materialize(df.withColumn("_hour", F.coalesce(hour, F.lit(NO_HOUR))), "rank-candidates")
    counts = stored.groupBy(*group, "_hour").agg(
        F.count(F.lit(1)).alias("_rows"), F.max(wanted).alias("_wanted")
    )
    # One row per group and hour, so these windows are as small as a month has hours.
    of_group = Window.partitionBy(*group)
    before = of_group.orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    reached = (
        counts.withColumns({
            "_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
            size: F.sum("_rows").over(of_group),
            "_wanted": F.max("_wanted").over(of_group),
        })
        .filter("_before < _wanted")
        .select(*group, "_hour", size)
    )
    # Hours reached lead their group, so a row's place among them is its place in the group.
    near = stored.join(reached, [*group, "_hour"]).select(*df.columns, size)
    placed = number_by_sort(near, group, order, rank, "_near")
    return placed.filter(F.col(rank) <= F.col(wanted)).select(*df.columns, rank, size)
