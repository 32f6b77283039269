"""Mixing of sources to target weights by budgets that run down a tree.

The tree has levels such as domain, language and source. A node hands its budget to its children in
proportion to their weights; a child that cannot use its share, because its documents are used up
after the allowed epochs, leaves the rest to its siblings first. What a whole subtree cannot use is
known above before anything is handed down, so it goes to the siblings of the subtree. A leaf then
takes whole epochs and, of one more, the longest prefix that fits, in a seeded order of that epoch.

All sums are whole numbers, all steps are aggregates and windows over nodes, never over documents of
a leaf: the cut in the last epoch is searched in buckets of the order first, then in one bucket.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import staged

_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Words between blanks and control characters; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def _children(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Adds ``alloc`` to rows (parent…, name, weight, cap, budget) by filling up to the caps.

    In order of cap by weight, a child is full if its cap is within its share of what the earlier
    ones leave; the others share the rest by weight, rounded down.
    """
    rank = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), name)
    before = rank.rowsBetween(Window.unboundedPreceding, -1)
    after = rank.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    full = F.col("cap") * F.sum("weight").over(after) <= left * F.col("weight")
    marked = nodes.withColumn("full", full)
    rest = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole)
    marked = marked.withColumns({"rest": rest, "open_weight": open_weight})
    return marked.withColumn(
        "alloc", F.expr("CASE WHEN full THEN cap ELSE (rest * weight) DIV open_weight END")
    ).drop("full", "rest", "open_weight")


def allocate(
    leaves: DataFrame, levels: list[str], weights: Mapping[tuple[str, ...], int], budget: int,
    max_epochs: int,
) -> DataFrame:
    """(levels…, tokens, alloc) from the token counts of the leaves.

    ``weights`` gives whole numbers for paths from the top; other nodes weigh 1. A node of weight 0
    or less gets nothing, and nothing below it does.
    """
    spark = leaves.sparkSession
    nodes = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    given = [(*[p[i] if i < len(p) else None for i in range(len(levels))], len(p), int(w))
             for p, w in weights.items()]
    schema = ", ".join(f"`{c}` string" for c in levels) + ", depth int, weight bigint"
    table = spark.createDataFrame(given, schema)
    for depth, name in enumerate(levels, 1):
        path = levels[:depth]
        own = table.where(F.col("depth") == depth).select(*path, F.col("weight").alias(f"w{depth}"))
        nodes = nodes.join(own, path, "left").withColumn(
            f"w{depth}", F.greatest(F.coalesce(f"w{depth}", F.lit(1)), F.lit(0))
        )
    dead = F.lit(False)
    for depth in range(1, len(levels) + 1):
        dead = dead | (F.col(f"w{depth}") == 0)
    nodes = staged(nodes.withColumn("cap", F.when(dead, 0).otherwise(F.col("cap"))), "nodes")
    given_down = None
    for depth, name in enumerate(levels, 1):
        path, parent = levels[:depth], levels[: depth - 1]
        caps = nodes.groupBy(*path, f"w{depth}").agg(F.sum("cap").alias("cap"))
        caps = caps.where(F.col("cap") > 0).withColumnRenamed(f"w{depth}", "weight")
        if given_down is None:
            total = F.least(F.lit(budget), F.sum("cap").over(Window.partitionBy()))
            caps = caps.withColumn("budget", total)
        else:
            caps = caps.join(given_down.withColumnRenamed("alloc", "budget"), parent)
        given_down = _children(caps, parent, name).select(*path, "alloc")
    return nodes.join(given_down, levels, "left").select(
        *levels, "tokens", F.coalesce("alloc", F.lit(0)).alias("alloc")
    )


def mix(
    documents: DataFrame, levels: Mapping[str, str], weights: Mapping[tuple[str, ...], int],
    budget_share: float = 1.0, max_epochs: int = 2, seed: int = 1, bucket_digits: int = 4,
) -> DataFrame:
    """(row, levels…, n_tokens, copies) of every row of ``documents``; ``row`` holds its columns.

    ``levels`` names the levels of the tree, top first, with their SQL expressions over ``documents``; a
    null becomes the empty name. The budget is ``budget_share`` times all tokens (words). ``copies``
    counts how often a document is taken: once for each whole epoch, and once more if it lies in the
    prefix. The order of an epoch is that of ``md5(seed:epoch:doc_id)``, then doc_id and tokens;
    rows equal in all of these are taken together or not at all.

    Null and empty texts have no tokens; they are taken with the prefix they lie in. A null id counts
    as the empty one in the order. An empty table gives an empty result; extra columns stay in
    ``row``.
    """
    names = list(levels)
    leaf = [F.coalesce(F.expr(c).cast("string"), F.lit("")).alias(n) for n, c in levels.items()]
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    slim = staged(documents.select("doc_id", *leaf, word_count().alias("n_tokens")), "tokens")
    leaves = staged(slim.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    plan = allocate(leaves, names, weights, int(budget_share * total), max_epochs)
    plan = staged(
        plan.withColumn("epochs", F.expr("CASE WHEN tokens > 0 THEN alloc DIV tokens ELSE 0 END"))
        .withColumn("rest", F.col("alloc") - F.col("epochs") * F.col("tokens")),
        "plan",
    )

    def order(text: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), text))

    keyed = staged(
        slim.join(plan.where("rest > 0").select(*names, "epochs", "rest"), names)
        .select(*names, "rest", "doc_id", "n_tokens", order(identity).alias("place"))
        .withColumn("bucket", F.substring("place", 1, bucket_digits)),
        "order",
    )
    in_leaf = Window.partitionBy(*names).orderBy("bucket")
    buckets = keyed.groupBy(*names, "rest", "bucket").agg(F.sum("n_tokens").alias("held"))
    buckets = buckets.withColumn("upto", F.sum("held").over(in_leaf))
    # The bucket in which the rest runs out; the buckets before it are taken whole.
    edge = staged(
        buckets.where(F.col("upto") > F.col("rest")).groupBy(*names)
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("held")).alias("before"))).alias("e"))
        .select(*names, F.col("e.bucket").alias("edge"), F.col("e.before").alias("before")),
        "edges",
    )
    inside = keyed.join(edge, names).where(F.col("bucket") == F.col("edge"))
    peers = Window.partitionBy(*names).orderBy("place", "doc_id", "n_tokens")
    last = F.struct("place", F.coalesce("doc_id", F.lit(-1)).alias("id"), "n_tokens")
    inside = (
        inside.withColumn("sum", F.col("before") + F.sum("n_tokens").over(peers))
        .where(F.col("sum") <= F.col("rest")).groupBy(*names).agg(F.max(last).alias("last"))
    )
    cuts = staged(plan.join(edge, names, "left").join(inside, names, "left"), "cuts")
    rows = documents.select(F.struct("*").alias("row"), *leaf, word_count().alias("n_tokens"), "doc_id")
    met = rows.join(cuts.select(*names, "epochs", "rest", "edge", "last"), names)
    place = order(identity)
    taken = (F.col("rest") > 0) & F.coalesce(
        (F.substring(place, 1, bucket_digits) < F.col("edge"))
        | F.coalesce(
            F.struct(place.alias("place"), F.coalesce("doc_id", F.lit(-1)).alias("id"), F.col("n_tokens"))
            <= F.col("last"),
            F.lit(False),
        ),
        F.lit(True),
    )
    return met.select(
        "row", *names, "n_tokens", (F.col("epochs") + taken.cast("long")).alias("copies")
    )
