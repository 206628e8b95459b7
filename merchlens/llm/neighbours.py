"""Approximate nearest neighbours by learned partitions.

On a bounded sample of vectors (``SAMPLE``, those with the least hashes) the exact graph of
nearest neighbours is cut into balanced partitions, so that near vectors share one: parts are
grown by halving along the graph and refined by moves that cut fewer edges within the balance.
A small classifier (softmax over the vector and its radial features about the partition
centres) learns which partition a vector lies in. Every row is indexed in its most probable
partition; a query goes to its most probable partitions until they hold a given share of all
rows, and whatever lies there is ranked by exact distance. The share is the least with which the
sample's own neighbours are found to ``TARGET``; denser tables find more.

Rows and queries meet per partition in pieces of bounded size: rows are dealt by a hash into
pieces of about ``ROWS``, queries into pieces of about ``QUERIES``; each pair of pieces is one
group and gives at most k rows per query, which are merged by query.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components, or are not
as long as most of the sample take no part, as rows or as queries; a query does not find rows of its
own id; ties go to the smaller id; repeated rows are found each; fewer candidates than k give
fewer rows only if the table has no more; null ids take no part; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.common import store, table

SAMPLE = 8192
PER_PARTITION = 128
GRAPH = 10
#: Recall on the sample that sets how large a share of all rows a query's partitions hold together.
TARGET = 0.96
LEAST_ROWS = 200
ROWS, QUERIES = 20_000, 2_000
K = 10


def valid(vectors: DataFrame, id_name: str, vector: str) -> DataFrame:
    """(id, v): rows that take part, with double components."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_name).cast("long").alias("id"), v.alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
        .filter(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    )


def nearest(points: np.ndarray, k: int) -> np.ndarray:
    """Exact k nearest others of every point."""
    k = min(k, len(points) - 1)
    norms = (points**2).sum(axis=1)
    out = np.empty((len(points), k), np.int64)
    for start in range(0, len(points), 1024):
        d = norms - 2 * points[start : start + 1024] @ points.T
        d[np.arange(len(d)), np.arange(start, start + len(d))] = np.inf
        out[start : start + 1024] = np.argpartition(d, k - 1, axis=1)[:, :k] if k else np.empty((len(d), 0))
    return out


def balanced_partitions(graph: np.ndarray, parts: int, slack: float = 1.1, rounds: int = 12, seed: int = 1) -> np.ndarray:
    """A part for every node of a neighbour graph: grown breadth first to equal sizes, then refined.

    In a round every node may move to the part most of its neighbours are in, best gains first, while
    that part has room.
    """
    n = len(graph)
    both = [[] for _ in range(n)]
    for a, row in enumerate(graph.tolist()):
        for b in row:
            both[a].append(b)
            both[b].append(a)
    random = np.random.default_rng(seed)
    part = np.full(n, -1)
    room = -(-n // parts)
    current, size, queue = 0, 0, []
    for seed_node in random.permutation(n).tolist():
        queue = [seed_node]
        for node in queue:  # grows while it is read
            if part[node] >= 0:
                continue
            if size >= room:
                current, size = min(current + 1, parts - 1), 0
                if current == parts - 1:
                    room = n
            part[node] = current
            size += 1
            queue.extend(x for x in both[node] if part[x] < 0)
    most = int(np.ceil(slack * n / parts))
    sizes = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        moves = []
        for node in range(n):
            near = np.bincount(part[both[node]], minlength=parts) if both[node] else np.zeros(parts, int)
            best = int(near.argmax())
            if best != part[node] and near[best] > near[part[node]]:
                moves.append((near[part[node]] - near[best], node, best))
        done = 0
        for _, node, best in sorted(moves):
            if sizes[best] < most:
                sizes[part[node]] -= 1
                sizes[best] += 1
                part[node] = best
                done += 1
        if not done:
            break
    return part


@dataclass
class Router:
    """The classifier: bounded numbers only."""

    centres: np.ndarray
    scale: float
    weights: np.ndarray
    probed: float = 1.0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        d = (x**2).sum(axis=1)[:, None] - 2 * x @ self.centres.T + (self.centres**2).sum(axis=1)
        return np.hstack([x / self.scale, d / self.scale**2, np.ones((len(x), 1))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.inputs(x) @ self.weights


def train_router(points: np.ndarray, part: np.ndarray, parts: int, steps: int = 300, rate: float = 0.05, seed: int = 2) -> Router:
    """Softmax regression by Adam; it starts at the nearest centre."""
    centres = np.array([points[part == p].mean(axis=0) if (part == p).any() else points.mean(axis=0) for p in range(parts)])
    scale = float(np.sqrt((points**2).sum(axis=1).mean())) or 1.0
    router = Router(centres, scale, np.zeros((points.shape[1] + parts + 1, parts)))
    router.weights[points.shape[1] : -1] = -8 * np.eye(parts)
    x, random = router.inputs(points), np.random.default_rng(seed)
    m, v = np.zeros_like(router.weights), np.zeros_like(router.weights)
    for step in range(1, steps + 1):
        some = random.integers(0, len(points), 512)
        z = x[some] @ router.weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(some)), part[some]] -= 1
        g = x[some].T @ p / len(some) + 1e-4 * router.weights
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2
        router.weights -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return router


def share_for(router: Router, points: np.ndarray, graph: np.ndarray, target: float) -> float:
    """Least share of the rows to probe so that ``target`` of all sample neighbours are found."""
    logits = router.logits(points)
    part = logits.argmax(axis=1)
    held = np.bincount(part, minlength=logits.shape[1])
    order = np.argsort(-logits, axis=1, kind="stable")
    before = np.cumsum(held[order], axis=1) - held[order]
    place = np.argsort(order, axis=1)
    # A neighbour is found once more rows are asked for than lie in the partitions before its own.
    asked = np.take_along_axis(before, np.take_along_axis(place, part[graph], axis=1), axis=1).ravel()
    return min(1.0, (np.sort(asked)[min(len(asked) - 1, int(np.ceil(target * len(asked))))] + 1) / len(points))


def fit(rows: DataFrame, sample: int = SAMPLE, target: float = TARGET) -> Router | None:
    """A router for ``rows`` (id, v), or None without rows."""
    some = rows.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    if not some:
        return None
    lengths = [len(r.v) for r in some]
    size = max(set(lengths), key=lambda x: (lengths.count(x), -x))
    points = np.unique(np.array([r.v for r in some if len(r.v) == size]), axis=0)
    parts = max(1, len(points) // PER_PARTITION)
    graph = nearest(points, GRAPH)
    part = balanced_partitions(graph, parts) if parts > 1 else np.zeros(len(points), int)
    router = train_router(points, part, parts)
    router.probed = share_for(router, points, graph, target) if parts > 1 else 1.0
    return router


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def search(vectors: DataFrame, queries: DataFrame, id_name: str = "vec_id", vector: str = "embedding", k: int = K,
           router: Router | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each of ``queries``."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = store(valid(vectors, id_name, vector), "vectors")
    router = router or fit(rows)
    if router is None:
        return spark.createDataFrame([], schema)
    size, parts = router.centres.shape[1], len(router.centres)
    fits = F.size("v") == size

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                best = router.logits(_vectors(batch.column(1))).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.astype(np.int32))], ["id", "v", "part"])

    indexed = store(rows.filter(fits).mapInArrow(assign, "id long, v array<double>, part int"), "vector-index")
    held = np.zeros(parts, np.int64)
    for r in indexed.groupBy("part").count().collect():
        held[r["part"]] = r["count"]
    # A repeated query row asks once; of different vectors under one id the least one asks.
    wanted = store(valid(queries, id_name, vector).filter(fits).groupBy("id").agg(F.min("v").alias("v")), "vector-queries")
    pieces = np.maximum(1, -(-held // ROWS))
    query_pieces = max(1, -(-wanted.count() // QUERIES))
    least = max(LEAST_ROWS, int(np.ceil(router.probed * held.sum())))

    def probe(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-router.logits(_vectors(batch.column(1))), axis=1, kind="stable")
            reached = np.cumsum(held[order], axis=1)
            # Partitions up to that which reaches the rows asked for.
            take = reached - held[order] < least
            who, place = np.nonzero(take & (held[order] > 0))
            part = order[who, place]
            own = np.repeat(np.arange(len(who)), pieces[part])
            piece = np.arange(len(own)) - np.repeat(np.cumsum(pieces[part]) - pieces[part], pieces[part])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(who[own])), batch.column(1).take(pa.array(who[own])),
                 pa.array(part[own].astype(np.int32)), pa.array(piece.astype(np.int32))], ["id", "v", "part", "piece"],
            )

    asked = wanted.mapInArrow(probe, "id long, v array<double>, part int, piece int").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.lit(query_pieces)).cast("int")
    )
    piece_of = F.element_at(F.array(*[F.lit(int(p)) for p in pieces]), F.col("part") + 1)
    base = indexed.withColumn("piece", F.pmod(F.xxhash64("id"), piece_of).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(query_pieces - 1)))
    )

    def rank(key, left, right):
        ids, points = left.column("id").combine_chunks(), None
        out: list[list[np.ndarray]] = [[], [], []]
        if left.num_rows and right.num_rows:
            ids = ids.to_numpy()
            points = _vectors(left.column("v").combine_chunks())
            asked_ids = right.column("id").combine_chunks().to_numpy()
            for q, x in zip(asked_ids, _vectors(right.column("v").combine_chunks()), strict=True):
                distance = np.sqrt(((points - x) ** 2).sum(axis=1))
                distance[ids == q] = np.inf
                near = np.argpartition(distance, k - 1)[:k] if len(ids) > k else np.arange(len(ids))
                edge = distance[near].max()
                near = np.flatnonzero(distance <= edge)  # ties at the edge too
                near = near[np.isfinite(distance[near])]
                near = near[np.lexsort((ids[near], distance[near]))][:k]
                for column, values in zip(out, (np.full(len(near), q), ids[near], distance[near]), strict=True):
                    column.append(values)
        empty = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table([pa.array(np.concatenate([e, *c])) for e, c in zip(empty, out, strict=True)], ["query_id", "vec_id", "score"])

    keys = ["part", "piece", "block"]
    near = base.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))
