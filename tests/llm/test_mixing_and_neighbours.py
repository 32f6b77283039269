import hashlib
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalmark.llm import mixing, neighbours

LEVELS = {"domain": "split(source, '-')[0]", "lang": "lang", "source": "source"}


def filled(children, budget):
    """Alloc of (name, weight, cap): the fullest by cap and weight first, the rest by weight."""
    got, left = {}, budget
    order = sorted((c for c in children if c[2] > 0), key=lambda c: (c[2] / c[1], c[0]))
    while order:
        name, weight, cap = order[0]
        whole = sum(c[1] for c in order)
        if cap * whole > left * weight:
            return got | {n: int(Fraction(left * w, whole)) for n, w, _ in order}
        got[name], left, order = cap, left - cap, order[1:]
    return got


def mixed(rows, weights, share, epochs, seed=1):
    tokens, leaf = defaultdict(int), []
    for _, text, lang, source in rows:
        leaf.append(((source or "").split("-")[0], lang or "", source or ""))
        tokens[leaf[-1]] += len((text or "").split())
    weight = lambda path: max(0, weights.get(path, 1))
    alive = lambda p: all(weight(p[: i + 1]) for i in range(3))
    cap = defaultdict(int)
    for p, n in tokens.items():
        for i in range(4):
            cap[p[:i]] += n * epochs if alive(p) else 0
    alloc = {(): min(int(share * sum(tokens.values())), cap[()])}
    for depth in range(3):
        for parent in [p for p in alloc if len(p) == depth]:
            names = {p[: depth + 1] for p in tokens if p[:depth] == parent}
            alloc.update(filled([(n, weight(n), cap[n]) for n in sorted(names)], alloc[parent]))
    found = []
    for p in sorted(tokens):
        whole, rest = divmod(alloc.get(p, 0), tokens[p]) if tokens[p] else (0, 0)
        own = []
        for (doc, text, *_), own_leaf in zip(rows, leaf):
            if own_leaf == p:
                n, name = len((text or "").split()), "" if doc is None else str(doc)
                own.append((hashlib.md5(f"{seed}:{whole}:{name}".encode()).hexdigest(), -1 if doc is None else doc, n))
        for place in own:
            upto = sum(o[2] for o in own if o <= place)
            found.append((None if place[1] == -1 else place[1], place[2], whole + (rest > 0 and upto <= rest)))
    return sorted(found, key=str)


@pytest.mark.parametrize("share, epochs, digits", [(0.5, 1, 4), (1.0, 2, 1), (3.0, 2, 2)])
def test_mix_equals_brute_force(documents, share, epochs, digits):
    rng = random.Random(epochs)
    rows = [
        (i, "w " * rng.choice([0, 1, 3, 20]), rng.choice(["en", "de", None]),
         rng.choice(["a-1", "a-1", "a-1", "a-2", "b-1", "c-1", None]))
        for i in range(150)
    ] + [(None, "x y", "en", "a-1"), (7, "again and again", "en", "a-1"), (7, "again and again", "en", "a-1"),
         (200, None, "en", "a-1"), (201, "", "fr", "z-9")]
    weights = {("a",): 5, ("b",): 3, ("c",): 0, ("a", "en"): 4, ("a", "en", "a-2"): 3}
    made = mixing.mix(documents(rows), LEVELS, weights, share, epochs, bucket_digits=digits)
    got = made.select("row.doc_id", "n_tokens", "copies").collect()
    assert sorted((tuple(r) for r in got), key=str) == mixed(rows, weights, share, epochs)


def test_mix_of_nothing(documents):
    assert mixing.mix(documents([]), LEVELS, {}).count() == 0


def exact(rows, asks, k):
    width = 4
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and len(v) == width and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(v)]
    found = set()
    for q, x in good:
        if asks(q):
            near = sorted({(-float(x @ y), i) for i, y in good if i != q})[:k]
            found |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(near)}
    return found


@pytest.mark.parametrize("block", [neighbours.QUERY_BLOCK, 3])
def test_whole_search_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", block)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4)]) for i in range(200)]
    rows += [(300 + i, [1.0, 2.0, 0.0, 1.0]) for i in range(40)]
    rows += [(400, None), (401, []), (402, [0.0] * 4), (403, [1.0, None, 0.0, 0.0]), (404, [float("nan"), 1.0, 1.0, 1.0]),
             (405, [float("inf"), 1.0, 1.0, 1.0]), (406, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (10, rows[10][1])]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, key int, vector string")
    got = neighbours.nearest(table, F.col("vec_id") % 10 == 0, k=5, share=1e9).collect()
    want = exact(rows, lambda q: q % 10 == 0, 5)
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want and len(got) == len(want)


def test_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    none = spark.createDataFrame([], schema)
    assert neighbours.nearest(none, F.col("vec_id") % 10 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], schema)
    got = neighbours.nearest(few, F.col("vec_id") % 10 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(got)] == [(0, 1, 1), (0, 2, 2)]
    assert neighbours.nearest(few, F.col("vec_id") > 5).count() == 0


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0).toPandas()
    frame = table.toPandas()
    x, ids = np.array(frame["embedding"].tolist(), float), frame["vec_id"].to_numpy()
    right = []
    for q, near in got.groupby("query_id"):
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        right.append(len(set(ids[np.lexsort((ids, -s))[:20]]) & set(near["vec_id"])) / 20)
    assert len(right) == (ids % 20 == 0).sum() and np.mean(right) >= 0.9


def test_forest_priorities_never_rise_on_the_way_down():
    rng = np.random.default_rng(2)
    forest = neighbours.fit(rng.normal(size=(600, 5)), 3.0, trees=3)
    x = forest.lifted(rng.normal(size=(7, 5)), True)
    assert (forest.priorities(x) <= 0).all() and (forest.priorities(x).max(2) == 0).all()
    visited = neighbours._visited(forest.priorities(x), np.full((3, 1 << forest.depth), 10.0), 95)
    assert (visited.sum((1, 2)) == 10).all()


def test_only_members_of_visited_leaves_are_scored():
    made = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            made.append(self.shape[0] * other.shape[1])
            return np.asarray(self) @ np.asarray(other)

    rng = np.random.default_rng(4)
    queries, rows = rng.normal(size=(50, 6)), rng.normal(size=(300, 6))
    leaves, visited = rng.integers(0, 16, (300, 3)), rng.random((50, 3, 16)) < 0.1
    score = neighbours._reranked(queries.view(Counted), rows, leaves, visited)
    met = np.array([[[visited[q, t, leaves[r, t]] for t in range(3)] for r in range(300)] for q in range(50)])
    assert np.allclose(score, np.where(met.any(2), queries @ rows.T, -np.inf))
    assert sum(made) == met.sum() < 50 * 300 / 2
    assert (neighbours._reranked(queries, rows[:0], leaves[:0], visited)).shape == (50, 0)


def test_rows_of_one_id_are_neighbours(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (21, [0.9, 0.1]), (40, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    made = neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, k=20).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in made)
    assert got == sorted([
        (20, 1, 21, 0.9), (20, 2, 20, 0.5), (20, 3, 40, 0.0),
        (20, 1, 20, 0.5), (20, 2, 21, 0.5), (20, 3, 40, 0.5),
        (40, 1, 20, 0.5), (40, 2, 21, 0.1), (40, 3, 20, 0.0),
    ])
