"""Mixing sources to target weights by entropy balancing.

Sizes are words. Every source gets a target of words (``targets``). Among all document rates
between 0 and ``MOST`` whose words meet the targets, entropy balancing takes the one of largest
entropy: the rates are exponentially tilted, rate = MOST / (1 + exp(-tilt * size / mean size of
the source)). The tilts solve the convex dual, one Newton step for all sources at a time: each
step is one aggregation over the distinct (source, size) pairs and no row of a document. Sums are
decimals, so a rerun gives the same bits. Rates become whole copies by systematic rounding in
order of size, which keeps the words of a source within one document of its target; of ``PHASES``
starting points each source takes that which comes nearest. Rows of equal size are told apart by a
hash of the id.

Defined cases: a null text has size 0; a null source is a source of its own, after all others;
repeated rows and null ids count each on their own; a source without words has target 0 and takes
nothing; an empty table gives an empty result; extra columns are dropped by ``mix`` and kept by
``apply_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.common import store, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
STEPS = 40
#: Rows of one (source, size) that one task numbers.
PIECE = 50_000
PHASES = 64
#: Rates are whole numbers of this many parts of a copy, so that sums in any order agree.
UNIT = 1_000_000
_SUM = "decimal(38,10)"


def word_count(text: Column) -> Column:
    r"""Runs of anything but ASCII white space; null: 0. Single spaces are counted, not split at."""
    blank = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "), " {2,}", " "))
    return F.when(blank == "", F.lit(0)).otherwise(
        F.length(blank) - F.length(F.translate(blank, " ", "")) + 1
    ).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, size, n) counts: weighted shares that stop at MOST times the source.

    Sharing out again and again what is above a stop ends at one level for all: source i gets
    min(stop_i, level * weight_i). Sources sorted by stop/weight show where the level lies.
    """
    source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    source = source.withColumn("weight", weight.cast("double")).withColumn("stop", MOST * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = SHARE * F.sum("source_size").over(Window.partitionBy())
    rest = total - F.coalesce(F.sum("stop").over(before), F.lit(0.0))
    source = source.withColumn("level", rest / F.sum("weight").over(after))
    # The first source in this order that its share does not fill is open, and so are all after it.
    open_ = F.col("level") * F.col("weight") <= F.col("stop")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.first(F.when(open_, F.col("level")), ignorenulls=True).over(everything)
    return source.select(
        "source", "source_size",
        F.least(F.col("stop"), F.coalesce(level * F.col("weight"), F.col("stop"))).alias("target"),
    )


def rates(sizes: DataFrame, wanted: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(source, size, n, rate): the tilted rates of every distinct size, ``wanted`` being what ``targets`` gives.

    Safeguarded Newton: a step that leaves the bracket in which the root lies is replaced by its middle.
    """
    means = sizes.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = store(
        wanted.alias("w").join(means.alias("m"), F.col("w.source").eqNullSafe(F.col("m.source")))
        .select("w.source", "target", "mean", F.lit(0.0).alias("tilt"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"),
                ((F.col("target") > 0) & (F.col("target") < MOST * F.col("source_size") * (1 - 1e-12))).alias("open")),
        "mix-state",
    )
    columns = state.columns
    x = F.col("size") / F.col("mean")
    half = MOST / (1 + F.exp(-F.col("tilt") * x))
    for _ in range(STEPS):
        if state.filter("open").isEmpty():
            break
        sums = (
            sizes.alias("s").join(state.filter("open").alias("o"), F.col("s.source").eqNullSafe(F.col("o.source")))
            .groupBy("o.source").agg(
                F.sum((F.col("n") * half * x).cast(_SUM)).cast("double").alias("words"),
                F.sum((F.col("n") * half * (1 - half / MOST) * x * x).cast(_SUM)).cast("double").alias("slope"),
            )
        )
        gap = F.col("target") / F.col("mean") - F.col("words")
        low = F.when(gap > 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.least("high", "tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + gap / F.greatest(F.col("slope"), F.lit(1e-300))
        # Outside the bracket: its middle, or ten times as far where one end is still unknown.
        middle = F.when((low > -1e6) & (high < 1e6), (low + high) / 2).otherwise(10 * F.col("tilt") + F.signum(gap))
        step = F.when((newton > low) & (newton < high) & (F.abs(newton - F.col("tilt")) < 50), newton).otherwise(middle)
        done = F.abs(gap) <= tolerance * F.col("target") / F.col("mean")
        moved = (
            state.alias("o").join(sums.alias("g"), F.col("o.source").eqNullSafe(F.col("g.source")), "left")
            .select("o.source", "target", "mean",
                    F.when(F.col("words").isNull() | done, F.col("tilt")).otherwise(step).alias("tilt"),
                    F.coalesce(low, F.col("low")).alias("low"), F.coalesce(high, F.col("high")).alias("high"),
                    (F.col("open") & F.col("words").isNotNull() & ~done).alias("open"))
        )
        state = store(moved.select(*columns), "mix-state")
    final = state.alias("o").join(wanted.alias("w"), F.col("o.source").eqNullSafe(F.col("w.source"))).select(
        "o.source", "o.mean", "o.tilt", "w.target", "w.source_size"
    )
    rate = (
        F.when(F.col("target") <= 0, 0.0)
        .when(F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12), float(MOST))
        .otherwise(half)
    )
    return sizes.alias("s").join(final.alias("f"), F.col("s.source").eqNullSafe(F.col("f.source"))).select(
        "s.source", "size", "n", "source_size", "target", rate.alias("rate")
    )


def _whole(units: Column) -> Column:
    """Whole copies in ``units``, by whole-number division."""
    return F.call_function("div", units, F.lit(UNIT))


def _phased(rated: DataFrame) -> DataFrame:
    """``rated`` with the starting point (``phase``) that brings each source's words nearest to its target."""
    tried = rated.withColumn("phase", F.explode(F.array(*[F.lit(UNIT * k // PHASES).cast("long") for k in range(PHASES)])))
    start = F.col("before") + F.col("phase")
    words = F.col("size") * (_whole(start + F.col("units") * F.col("n")) - _whole(start))
    tried = tried.groupBy("source", "phase").agg(F.abs(F.sum(words) - F.first("target")).alias("miss"))
    best = tried.groupBy(F.col("source").alias("_of")).agg(F.min(F.struct("miss", "phase")).phase.alias("phase"))
    return rated.join(best, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")


def mix(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``keep`` (default: doc_id), size, source_size, target, copies, taken."""
    row = F.struct(*(["doc_id"] if keep is None else keep)).alias("_row")
    sized = store(
        docs.select(row, F.col("doc_id").alias("_id"), F.col("source").alias("_source"), word_count(F.col("text")).alias("size"),
                    F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash")),
        "mix-sizes",
    )
    sizes = store(sized.groupBy(F.col("_source").alias("source"), "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    rated = rates(sizes, store(targets(sizes), "mix-targets"))
    of_source = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rated = store(
        rated.withColumn("units", F.round(F.col("rate") * UNIT).cast("long"))
        .withColumn("before", F.coalesce(F.sum(F.col("units") * F.col("n")).over(of_source), F.lit(0)))
        .withColumn("pieces", F.ceil(F.col("n") / PIECE).cast("long")),
        "mix-rates",
    )
    rated = _phased(rated)
    # Rows of one id come in the order of their texts, so the mix does not depend on how the input lies.
    keyed = sized.withColumn("_key", F.xxhash64("_id", "_hash"))
    joined = keyed.join(
        rated, F.col("_source").eqNullSafe(F.col("source")) & (keyed["size"] == rated["size"])
    ).select("_row", "_id", "source", keyed["size"].alias("size"), "source_size", "target", "units", "before", "phase",
             "_key", F.pmod("_key", "pieces").alias("_piece"))
    joined = store(joined, "mix-joined")
    counts = joined.groupBy("source", "size", "_piece").agg(F.count(F.lit(1)).alias("rows"))
    ahead = Window.partitionBy("source", "size").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("ahead", F.coalesce(F.sum("rows").over(ahead), F.lit(0)))
    place = Window.partitionBy("source", "size", "_piece").orderBy("_key", "_id")
    numbered = joined.withColumn("_place", F.row_number().over(place) - 1).alias("j").join(
        counts.alias("c"),
        F.col("j.source").eqNullSafe(F.col("c.source")) & (F.col("j.size") == F.col("c.size")) & (F.col("j._piece") == F.col("c._piece")),
    )
    upto = F.col("before") + F.col("units") * (F.col("ahead") + F.col("_place")) + F.col("phase")
    copies = _whole(upto + F.col("units")) - _whole(upto)
    return numbered.select(
        "_row.*", F.col("j.size").alias("size"), "source_size", "target",
        F.least(copies, F.lit(MOST)).cast("long").alias("copies"),
        (F.least(copies, F.lit(MOST)).cast("long") * F.col("j.size")).alias("taken"),
    )


def apply_mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as ``mix`` takes it, all columns kept.

    Rows alike in id, source and text have one size and source, so their copies differ by one at most:
    as many of them as ``mix`` gave the larger number get it.
    """
    columns = docs.columns
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    rows = mix(docs.select("doc_id", "text", "source", text_hash.alias("_hash")), ["doc_id", "source", "_hash"])
    least, count = F.min("copies"), F.count(F.lit(1))
    # One row per document: the same join at every size, hashed on this side so that texts need no sort.
    alike = store(
        rows.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "_hash")
        .agg(least.alias("_least"), (F.sum("copies") - least * count).alias("_more"), count.alias("_rows"))
        .filter("_least > 0 OR _more > 0"), "mix-copies",
    )

    def joined(groups):
        groups = groups.hint("shuffle_hash")
        return docs.join(groups, docs["doc_id"].eqNullSafe(groups["_id"]) & docs["source"].eqNullSafe(groups["_source"])
                         & (text_hash == groups["_hash"]))

    def repeated(rows, kept, copies):
        return rows.select(*kept, F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy"))

    even = alike.filter("_more = 0")
    out = repeated(joined(even), [docs[c] for c in columns], even["_least"]).select(*columns)
    uneven = alike.filter("_more > 0")
    if uneven.isEmpty():
        return out
    # Number the rows of such a group in pieces, with the counts of the pieces before.
    numbered = store(
        joined(uneven).select(F.struct(*[docs[c] for c in columns]).alias("_doc"), *[uneven[c] for c in uneven.columns])
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_piece", F.pmod("_row", F.ceil(F.col("_rows") / PIECE).cast("long"))), "mix-uneven",
    )
    group = ["_id", "_source", "_hash"]
    ahead = Window.partitionBy(*group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy(*group, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    place = Window.partitionBy(*group, "_piece").orderBy("_row")
    placed = numbered.withColumn("_place", F.row_number().over(place)).alias("r").join(
        counts.alias("c"),
        F.col("r._id").eqNullSafe(F.col("c._id")) & F.col("r._source").eqNullSafe(F.col("c._source"))
        & (F.col("r._hash") == F.col("c._hash")) & (F.col("r._piece") == F.col("c._piece")),
    )
    copies = F.col("_least") + (F.col("_ahead") + F.col("_place") <= F.col("_more")).cast("long")
    placed = placed.select("r.*", copies.alias("_copies")).filter("_copies > 0")
    return out.unionByName(repeated(placed, ["_doc"], F.col("_copies")).select("_doc.*"))


def op2_mixture(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")
