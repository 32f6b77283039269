"""Nearest neighbours by inner product with a forest of random-projection trees.

Vectors that are equal are indexed once. They get one more component, so that the largest inner
product becomes the least angle. The trees are fitted on a bounded sample: each node splits its
part of the sample at the median of a projection on the difference of two random members. Every
vector is then put into a leaf of each tree.

A query walks all trees from one priority queue. The priority of a node is the sum of the margins by
which the query lies on the wrong side of the splits above it, so it never improves on the way down
and the queue hands out the leaves of the whole forest in order of priority; they are taken until
they hold the wanted share of the rows. Members of these leaves, and no others, are reranked by exact
inner products: the rows are grouped by leaf, and a leaf meets the queries that visit it. Queries are taken in blocks of bounded size; a block meets each vector once, and a task
keeps the best candidates of each query only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .common import hash_sample, map_batches

SAMPLE, TREES, DEPTH, QUERY_BLOCK, ROWS = 16_384, 8, 8, 4_096, 4_096
_LEAST_LEAF = 8


def usable(vector: str | Column) -> Column:
    """No null, no null or non-finite component, not empty and not all zero."""
    col = F.col(vector) if isinstance(vector, str) else vector
    big = F.lit(float("inf"))
    bad = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == big))
    return F.coalesce(
        (F.size(col) > 0) & ~bad & F.exists(col, lambda x: x != 0), F.lit(False)
    )


@dataclass
class Forest:
    """Directions and thresholds of all inner nodes: arrays of trees x nodes (x dimensions)."""

    directions: np.ndarray
    thresholds: np.ndarray
    depth: int
    norm: float

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Rows get the component that makes all norms equal, queries a zero, both unit length."""
        square = np.einsum("ij,ij->i", x, x)
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.norm**2 - square))
        scale = np.sqrt(square) if query else np.full(len(x), self.norm)
        return np.hstack([x, extra[:, None]]) / np.maximum(scale, 1e-300)[:, None]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        at = np.zeros((len(x), len(self.directions)), np.int64)
        for t, (d, h) in enumerate(zip(self.directions, self.thresholds)):
            margins = x @ d.T - h
            for level in range(self.depth):
                node = (1 << level) - 1 + at[:, t]
                at[:, t] = 2 * at[:, t] + (margins[np.arange(len(x)), node] > 0)
        return at

    def priorities(self, x: np.ndarray) -> np.ndarray:
        """For each query, tree and leaf: minus the sum of wrong-side margins on the way down."""
        found = []
        for d, h in zip(self.directions, self.thresholds):
            margins = x @ d.T - h
            p = np.zeros((len(x), 1))
            for level in range(self.depth):
                m = margins[:, (1 << level) - 1 : (1 << (level + 1)) - 1]
                p = np.stack([p + np.minimum(0, -m), p + np.minimum(0, m)], 2).reshape(len(x), -1)
            found.append(p)
        return np.stack(found, 1)


def fit(sample: np.ndarray, norm: float, trees: int = TREES, depth: int = DEPTH, seed: int = 11) -> Forest:
    """Grow the trees on ``sample``; smaller samples give fewer levels."""
    depth = int(max(0, min(depth, np.floor(np.log2(max(1, len(sample)) / _LEAST_LEAF)))))
    width = sample.shape[1] + 1
    forest = Forest(
        np.zeros((trees, (1 << depth) - 1, width)), np.zeros((trees, (1 << depth) - 1)), depth, norm
    )
    x, rng = forest.lifted(sample, False), np.random.default_rng(seed)
    for t in range(trees):
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            for k in range(1 << level):
                node, own = (1 << level) - 1 + k, np.flatnonzero(at == k)
                direction = rng.normal(size=width)
                if len(own) > 1:
                    a, b = rng.choice(own, 2, replace=False)
                    if (x[a] != x[b]).any():
                        direction = x[a] - x[b]
                direction /= np.linalg.norm(direction)
                forest.directions[t, node] = direction
                if len(own):
                    forest.thresholds[t, node] = np.median(x[own] @ direction)
            node = (1 << level) - 1 + at
            side = np.einsum("ij,ij->i", x, forest.directions[t, node]) > forest.thresholds[t, node]
            at = 2 * at + side
    return forest


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def _indexed(vectors: DataFrame, shared, width: int) -> DataFrame:
    """(key, first, vector, ids, leaves): the leaf of every distinct vector in every tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            x = forest.lifted(_matrix(batch.column("vector"), width), False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(forest.leaves(x)), pa.list_(pa.int64()))],
                names=[*batch.schema.names, "leaves"],
            )

    return map_batches(vectors, run, "key bigint, first bigint, vector array<double>, ids array<bigint>, leaves array<bigint>")


def _visited(priorities: np.ndarray, sizes: np.ndarray, wanted: float) -> np.ndarray:
    """Leaves in order of priority over the whole forest until they hold ``wanted`` rows."""
    flat = priorities.reshape(len(priorities), -1)
    order = np.argsort(-flat, axis=1, kind="stable")
    held = np.cumsum(sizes.ravel()[order], axis=1) - sizes.ravel()[order]
    taken = np.zeros(flat.shape, bool)
    np.put_along_axis(taken, order, held < wanted, axis=1)
    return taken.reshape(priorities.shape)


def _searched(index: DataFrame, shared, width: int, most: int) -> DataFrame:
    """For each query of the block and task: the ``most`` best keys among visited leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, keys, visited = shared.value
        best_score = np.full((len(queries), 0), -np.inf)
        best_key, best_ids = np.zeros((len(queries), 0), np.int64), {}
        best_first = np.zeros((len(queries), 0), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                leaves = _matrix(part.column("leaves"), visited.shape[1]).astype(np.int64)
                score = _reranked(queries, _matrix(part.column("vector"), width), leaves, visited)
                key, first = (
                    np.broadcast_to(np.array(part.column(c).to_pylist()), score.shape) for c in ("key", "first")
                )
                score, key = np.hstack([best_score, score]), np.hstack([best_key, key])
                first = np.hstack([best_first, first])
                # Ties go to the smaller least id of a vector, then to the key.
                few = score.shape[1] <= 4 * most
                keep = np.lexsort((key, first, -score), axis=1)[:, :most] if few else _best(score, first, key, most)
                best_score = np.take_along_axis(score, keep, 1)
                best_key = np.take_along_axis(key, keep, 1)
                best_first = np.take_along_axis(first, keep, 1)
                held = set(best_key[best_score > -np.inf].tolist())
                ids = zip(part.column("key").to_pylist(), part.column("ids").to_pylist())
                best_ids.update((k, v) for k, v in ids if k in held)
                if len(best_ids) > 4 * len(held) + 1000:
                    best_ids = {k: v for k, v in best_ids.items() if k in held}
        for q, (scores, found) in enumerate(zip(best_score, best_key)):
            real = scores > -np.inf
            if real.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(int(real.sum()), keys[q]), pa.int64()),
                     pa.array(found[real], pa.int64()), pa.array(scores[real], pa.float64()),
                     pa.array([best_ids[k] for k in found[real].tolist()], pa.list_(pa.int64()))],
                    names=["query", "key", "score", "ids"],
                )

    return map_batches(index, run, "query bigint, key bigint, score double, ids array<bigint>")


def _reranked(queries: np.ndarray, rows: np.ndarray, leaves: np.ndarray, visited: np.ndarray) -> np.ndarray:
    """Inner products of the queries with the rows in leaves that they visit; minus infinity elsewhere."""
    score = np.full((len(queries), len(rows)), -np.inf)
    for t in range(visited.shape[1]):
        order = np.argsort(leaves[:, t], kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(leaves[order, t])) + 1):
            asking = np.flatnonzero(visited[:, t, leaves[own[0], t]]) if len(own) else own
            if len(asking):
                score[np.ix_(asking, own)] = queries[asking] @ rows[own].T
    return score


def _best(score: np.ndarray, first: np.ndarray, key: np.ndarray, most: int) -> np.ndarray:
    """Columns of the ``most`` largest scores of each row, ties to smaller first ids, then keys."""
    cut = -np.partition(-score, most - 1, axis=1)[:, most - 1]
    found = np.zeros((len(score), most), np.int64)
    for i, (s, f, k, c) in enumerate(zip(score, first, key, cut)):
        near = np.flatnonzero(s >= c)
        found[i] = near[np.lexsort((k[near], f[near], -s[near]))[:most]]
    return found


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, share: float = 1.4, vector: str = "embedding",
    identity: str = "vec_id", sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row that meets ``queries``.

    ``share`` is the search effort: the leaves taken for a query hold that share of the distinct
    vectors, counted over all trees (a vector in several of them counts several times). At most
    about ``sample`` distinct vectors fit the forest. The score is the inner product of the original
    vectors in double precision; ties go to the smaller id. Of equal vectors only the ``k + 1`` with
    the smallest ids are carried, as no other can be among the nearest of any row.

    Rows without id, and vectors that are null, zero, or hold null or non-finite components, take no
    part, nor do vectors of another length than most have. A row repeated with the same id and vector
    counts once. Of several vectors with one id each is a candidate, also for the others, and a query of
    its own, so that such an id has several rows of each rank. With fewer than ``k``
    candidates all found are returned; an empty table gives an empty result; other columns are
    ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(identity).isNotNull() & usable(vector)).select(
        F.col(identity).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    )
    widths = rows.groupBy(F.size("vector").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).take(1)
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not widths:
        return empty
    width = widths[0]["w"]
    rows = rows.where(F.size("vector") == width)
    keys = rows.groupBy("vector").agg(F.min("id").alias("first"), F.max("asks").alias("asked"))
    keys = staged(keys.select(F.xxhash64("vector").alias("key"), "*"), "vectors")
    # The smallest ids of each vector: partial lists are cut inside the tasks before they meet.
    order = "row_number() OVER (PARTITION BY vector ORDER BY id) AS place"
    first_ids = (
        rows.select("vector", "id").selectExpr("xxhash64(vector) AS key", "id", "vector")
        .selectExpr("key", "id", order).where(F.col("place") <= k + 1)
        .groupBy("key").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    )
    distinct = staged(keys.join(first_ids, "key").select("key", "first", "vector", "ids", "asked"), "distinct")
    total, norm = distinct.agg(
        F.count("*"), F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))
    ).first()
    chosen = hash_sample(distinct, sample, total, "first").select("first", "key", "vector").orderBy("first", "key").limit(2 * sample)
    data = np.array([r["vector"] for r in chosen.collect()], np.float64).reshape(-1, width)
    shared = spark.sparkContext.broadcast(fit(data, norm, trees, depth))
    forest = shared.value
    index = staged(_indexed(distinct.select("key", "first", "vector", "ids"), shared, width), "forest")
    sizes = np.zeros((trees, 1 << forest.depth))
    for r in (
        index.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect()
    ):
        sizes[r["tree"], r["leaf"]] = r["count"]
    asked = distinct.where("asked").select("key", "vector")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("key", F.lit("block")), F.lit(blocks)))
    found = []
    for b in range(blocks):
        block = dealt.where(F.col("block") == b).collect()
        if not block:
            continue
        x = np.array([r["vector"] for r in block], np.float64)
        visited = _visited(forest.priorities(forest.lifted(x, True)), sizes, share * total)
        sent = spark.sparkContext.broadcast((x, np.array([r["key"] for r in block]), visited))
        found.append(staged(_searched(index, sent, width, k + 1), "candidates"))
    if not found:
        return empty
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.union(more)
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "ids", "key")))
    best = candidates.groupBy("query").agg(ranked.alias("near"))
    # All ids of equal score are put in order of the id, whatever vector they belong to.
    listed = F.flatten(
        F.transform(
            "near",
            lambda v: F.transform(
                v["ids"], lambda i: F.struct(v["far"].alias("far"), i.alias("id"), v["key"].alias("key"))
            ),
        )
    )
    best = best.select("query", F.slice(F.array_sort(listed), 1, k + 1).alias("near"))
    askers = rows.where("asks").select("id", F.xxhash64("vector").alias("query")).distinct()
    own_row = lambda v: (v["id"] == F.col("id")) & (v["key"] == F.col("query"))
    own = askers.join(best, "query").select(
        F.col("id").alias("query_id"),
        F.posexplode(F.slice(F.filter("near", lambda v: ~own_row(v)), 1, k)).alias("rank", "v"),
    )
    return own.select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("v.id").alias("vec_id"),
        (-F.col("v.far")).alias("score"),
    )
