"""Exact percentiles per group without gathering a group in one place.

A quantile sketch first narrows each percentile down to a small value range; its error bound makes
sure that the true value lies inside. Then only the distinct values in that range are put in
order, everything below it being reduced to one count.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

ACCURACY = 10000


def approx_percentiles(
    df: DataFrame, groups: list[str], value: Column, points: dict[str, float]
) -> DataFrame:
    """Sketch percentiles, one column per entry of ``points``."""
    return df.groupBy(*groups).agg(
        *[F.percentile_approx(value, p, ACCURACY).alias(name) for name, p in points.items()]
    )


def _brackets(df: DataFrame, groups: list[str], points: list[float], accuracy: int) -> DataFrame:
    """Per group and percentile: row count and a range that holds the percentile.

    The sketch is off by at most ``1 / accuracy`` of the rows, so stepping two such widths to
    either side leaves the true rank inside.
    """
    margin = 2.0 / accuracy
    lower = [max(0.0, p - margin) for p in points]
    upper = [min(1.0, p + margin) for p in points]
    sketched = df.groupBy(*groups).agg(
        F.count("*").alias("_n"),
        F.percentile_approx("_v", lower + upper, accuracy).alias("_q"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
    )
    ranges = [
        F.struct(
            F.lit(i).alias("_point"),
            (F.col("_min") if lower[i] == 0.0 else F.col("_q")[i]).alias("_low"),
            (F.col("_max") if upper[i] == 1.0 else F.col("_q")[len(points) + i]).alias("_high"),
        )
        for i in range(len(points))
    ]
    return sketched.select(*groups, "_n", F.inline(F.array(*ranges)))


def exact_percentiles(
    df: DataFrame,
    groups: list[str],
    value: Column,
    points: dict[str, float],
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Discrete percentiles: the smallest value whose cumulative share reaches the percentile.

    NULL values are left out, as are groups that have nothing else.
    """
    if not groups:
        whole = exact_percentiles(
            df.withColumn("_whole", F.lit(0)), ["_whole"], value, points, accuracy
        )
        return whole.drop("_whole")
    names, shares = list(points), [float(p) for p in points.values()]
    values = df.select(*groups, value.alias("_v")).where(F.col("_v").isNotNull())
    ranges = _brackets(values, groups, shares, accuracy)
    distinct = values.groupBy(*groups, "_v").agg(F.count("*").alias("_m"))
    same = [F.col(f"d.{g}").eqNullSafe(F.col(f"r.{g}")) for g in groups]
    inside = (
        distinct.alias("d")
        .join(ranges.alias("r"), [F.col("_v") <= F.col("_high"), *same])
        .select(
            *[F.col(f"d.{g}").alias(g) for g in groups],
            "_n",
            "_point",
            F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_v"),
            "_m",
        )
    )
    steps = inside.groupBy(*groups, "_n", "_point", "_v").agg(F.sum("_m").alias("_m"))
    order = Window.partitionBy(*groups, "_point").orderBy(F.asc_nulls_first("_v"))
    reached = F.sum("_m").over(order)
    share = F.lit(None).cast("decimal(12,10)")
    for i, p in enumerate(shares):
        share = F.when(F.col("_point") == i, F.lit(Decimal(str(p)))).otherwise(share)
    rank = F.greatest(F.ceil(share * F.col("_n")).cast("bigint"), F.lit(1))
    found = steps.select(
        *groups,
        "_point",
        "_v",
        ((reached >= rank) & (reached - F.col("_m") < rank)).alias("_hit"),
    ).where("_hit")
    return found.groupBy(*groups).agg(
        *[F.max(F.when(F.col("_point") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)]
    )
