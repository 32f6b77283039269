"""Time-series operators over samples ``(series…, time, value)``.

A series may be long and hold a large share of all samples, so no window runs over a whole series
of raw samples. Time is cut into chunks and windows run per series and chunk; what a chunk needs
from before its start is added to it: the samples of the trailing window and one earlier sample.
A chunk with very many samples is cut further, between slots of time as long as the trailing window,
so that each part has at most a given number of samples, or a single slot.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.window import WindowSpec

from ..functions.text import percent
from ..session import staged
from .partitions import overwrite_partitions, partition_folder, partition_values

# Trailing window, sampling step, hold times, threshold in percent, retention.
WINDOW_SECONDS = 300
STEP_SECONDS = 15
HOLD_SECONDS = 300
SHORT_HOLD_SECONDS = 60
RATIO_THRESHOLD = 80
RETENTION_DAYS = 7
# Lower bounds of the status colours.
STATUS_STEPS = ((5, "green"), (3, "yellow"))
LOWEST_STATUS = "red"

SECOND = 1_000_000
CHUNK_SECONDS = 6 * 3600
CHUNK_ROWS = 1_000_000


def micros(df: DataFrame, time: str) -> Column:
    """Time as microseconds since 1970, for both kinds of timestamps."""
    if dict(df.dtypes)[time] == "timestamp_ntz":
        epoch = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, F.col(time))
    return F.unix_micros(F.col(time))


def chunk_cuts(slots: DataFrame, series: list[str], per_chunk: int, budget: int) -> DataFrame:
    """Slots at which chunks with more than ``budget`` samples are cut: ``series…, _coarse, _starts``.

    ``slots`` has the number of samples ``_n`` per series and ``_slot``. A chunk has ``per_chunk`` slots,
    so there are fewer cuts than that in each.
    """
    along = Window.partitionBy(*series, "_coarse").orderBy("_slot")
    filled = F.floor((F.sum("_n").over(along) - 1) / budget)
    parts = slots.withColumn("_coarse", F.floor(F.col("_slot") / per_chunk).cast("bigint"))
    cut = parts.withColumn("_part", filled).select(
        *series, "_coarse", "_slot", (F.col("_part") > F.lag("_part").over(along)).alias("_new")
    )
    starts = F.sort_array(F.collect_list("_slot")).alias("_starts")
    return cut.where("_new").groupBy(*series, "_coarse").agg(starts)


def with_chunk(rows: DataFrame, series: list[str], cuts: DataFrame | None, per_chunk: int) -> DataFrame:
    """Add ``_own``, the chunk of a row's ``_slot``, and ``_next``, that of the slot after it."""
    coarse = F.floor(F.col("_slot") / per_chunk).cast("bigint")
    if cuts is None:
        found = rows.withColumn("_starts", F.array().cast("array<bigint>"))
    else:
        keys = [F.col(c).alias(f"_key{i}") for i, c in enumerate(series)]
        places = cuts.select(*keys, F.col("_coarse").alias("_key"), "_starts")
        same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(series)]
        found = rows.join(places, [*same, coarse == F.col("_key")], "left")

    def chunk(slot: Column) -> Column:
        before = F.size(F.filter(F.coalesce("_starts", F.array().cast("array<bigint>")), lambda s: s <= slot))
        return coarse * per_chunk + before

    after = F.col("_slot") + 1
    following = F.when(F.pmod(after, F.lit(per_chunk)) == 0, (coarse + 1) * per_chunk).otherwise(chunk(after))
    return found.select(
        *rows.columns, chunk(F.col("_slot")).alias("_own"), following.cast("bigint").alias("_next")
    )


def _cuts(slots: DataFrame, series: list[str], per_chunk: int, budget: int) -> DataFrame | None:
    """``chunk_cuts``, or None where no chunk has to be cut. There is one row for each that has."""
    cuts = staged(chunk_cuts(slots, series, per_chunk, budget), "cuts")
    return None if cuts.isEmpty() else cuts


def counter_increase(
    samples: DataFrame,
    series: list[str],
    time: str,
    value: str,
    window: int = WINDOW_SECONDS,
    chunk: int = CHUNK_SECONDS,
    budget: int = CHUNK_ROWS,
) -> DataFrame:
    """Each sample with ``increase``: growth of the counter over the trailing window ``(t-w, t]``.

    A drop means that the counter started again from zero, so the new value is the growth. The
    first sample of a series has no growth. Needs one sample per series and time. The counts per slot
    are taken first, by a job of its own; chunks with more than ``budget`` samples are cut by them.
    """
    per_chunk = chunk // window
    if chunk % window:
        raise ValueError("chunk must be a multiple of window")
    kept = [c for c in samples.columns if c not in (*series, value)]
    t = samples.withColumn("_t", micros(samples, time)).withColumn(
        "_slot", F.floor(F.col("_t") / (window * SECOND)).cast("bigint")
    )
    # One row per series and slot is enough to know the sample just before each chunk.
    counted = t.groupBy(*series, "_slot").agg(
        F.max("_t").alias("_t"), F.max_by(value, "_t").alias(value), F.count("*").alias("_n")
    )
    slots = staged(counted, "slots")
    cuts = _cuts(slots, series, per_chunk, budget)
    # The last slot of a chunk is also the trailing window of the next one.
    places = F.array_distinct(F.array("_own", "_next"))
    rows = with_chunk(t, series, cuts, per_chunk).withColumn("_chunk", F.explode(places)).drop("_next")
    by_slot = Window.partitionBy(*series).orderBy("_slot")
    earlier = slots.select(
        *series,
        "_slot",
        F.lag("_t").over(by_slot).alias("_t"),
        F.lag(value).over(by_slot).alias(value),
    )
    before = with_chunk(earlier, series, cuts, per_chunk).withColumn("_chunk", F.explode(places))
    seeds = (
        before.groupBy(*series, "_chunk")
        .agg(F.min_by("_t", "_slot").alias("_t"), F.min_by(value, "_slot").alias(value))
        .where(F.col("_t").isNotNull())
    )
    everything = rows.drop("_slot").unionByName(seeds, allowMissingColumns=True)
    order = Window.partitionBy(*series, "_chunk").orderBy("_t")
    last = F.lag(value).over(order)
    growth = F.when(F.col(value) >= last, F.col(value) - last).when(
        last.isNotNull(), F.col(value)
    )
    grown = everything.withColumn("_growth", growth)
    return (
        grown.withColumn("increase", _trailing_sum(grown, order, window))
        .where(F.col("_own") == F.col("_chunk"))
        .select(*series, *kept, value, "increase")
    )


def _trailing_sum(grown: DataFrame, order: WindowSpec, window: int) -> Column:
    """The sum of ``_growth`` over ``(_t - window, _t]``, zero without any.

    For whole numbers and decimals it is the difference of two running sums, so that the work does not grow
    with the number of samples in a window. Floating-point sums, and decimals too wide for a running sum, are
    not exact that way; a sliding frame adds up each of their windows.
    """
    sliding = F.coalesce(F.sum("_growth").over(order.rangeBetween(1 - window * SECOND, 0)), F.lit(0))
    kind = grown.schema["_growth"].dataType
    if isinstance(kind, T.IntegralType):
        wide, result = F.col("_growth").cast("decimal(20,0)"), "bigint"
    elif isinstance(kind, T.DecimalType) and kind.precision <= 27:
        wide, result = F.col("_growth"), f"decimal({kind.precision + 10},{kind.scale})"
    else:
        return sliding

    def upto(end: int) -> Column:
        return F.coalesce(F.sum(wide).over(order.rangeBetween(Window.unboundedPreceding, end)), F.lit(0))

    return (upto(Window.currentRow) - upto(-window * SECOND)).cast(result)


def counter_rate(
    samples: DataFrame, series: list[str], time: str, value: str, window: int = WINDOW_SECONDS, **kw
) -> DataFrame:
    """``counter_increase`` per second."""
    grown = counter_increase(samples, series, time, value, window, **kw)
    return grown.withColumn("rate", F.col("increase").cast("double") / window).drop("increase")


def sum_by_label(samples: DataFrame, bucket: Column, label: str, value: Column) -> DataFrame:
    """Sum per time bucket and label."""
    return samples.groupBy(bucket.alias("bucket"), label).agg(F.sum(value).alias("total"))


def total_or_zero(samples: DataFrame, value: Column) -> DataFrame:
    """One row with the sum of all samples, zero when there is none."""
    return samples.agg(F.coalesce(F.sum(value), F.lit(0)).alias("total"))


def latest(samples: DataFrame, series: list[str], time: str, value: str) -> DataFrame:
    """Latest sample per series."""
    return samples.groupBy(*series).agg(
        F.max(time).alias(time), F.max_by(value, time).alias(value)
    )


def count_in_state(
    samples: DataFrame, series: list[str], time: str, value: str, state: float = 1
) -> DataFrame:
    """How many series are in ``state`` at their latest sample."""
    return latest(samples, series, time, value).agg(
        F.count_if(F.col(value) == state).alias("series_in_state"), F.count("*").alias("series")
    )


def threshold_status(value: Column) -> Column:
    """Colour of a value: the highest step it reaches."""
    ladder = F
    for bound, colour in STATUS_STEPS:
        ladder = ladder.when(value >= bound, colour)
    return ladder.otherwise(LOWEST_STATUS)


def gauge_ratio(
    part: DataFrame,
    whole: DataFrame,
    series: list[str],
    time: str,
    threshold: float = RATIO_THRESHOLD,
) -> DataFrame:
    """Two gauges (column ``value``) at the same series and time: ``percent`` and ``above``."""
    joined = part.withColumnRenamed("value", "_part").join(
        whole.withColumnRenamed("value", "_whole"), [*series, time]
    )
    share = percent(F.col("_part"), F.col("_whole"))
    return joined.select(*series, time, share.alias("percent")).withColumn(
        "above", F.coalesce(F.col("percent") > threshold, F.lit(False))
    )


def held_alerts(
    samples: DataFrame,
    series: list[str],
    time: str,
    active: Column,
    hold: int = HOLD_SECONDS,
    max_gap: int = WINDOW_SECONDS,
    chunk: int = CHUNK_SECONDS,
    budget: int = CHUNK_ROWS,
) -> DataFrame:
    """Intervals in which a condition has held for at least ``hold`` seconds.

    One row per unbroken run of active samples that lasts long enough: ``active_from``,
    ``firing_from`` (hold time later) and ``firing_to`` (last active sample). A run is broken by an
    inactive sample and by a gap of more than ``max_gap`` seconds. Several samples of a series at one
    time count as one, active if all of them are.

    Runs are formed per chunk. Those that touch neither end of their chunk are complete; of the
    rest each chunk has two at most, and only these are joined along the series. Chunks with more than
    ``budget`` samples are cut between slots of ``max_gap`` seconds, which a job counts before.
    """
    if chunk < max_gap:
        raise ValueError("chunk must not be shorter than max_gap")
    per_chunk = chunk // max_gap
    gap = max_gap * SECOND
    t = samples.select(
        *series,
        micros(samples, time).alias("_t"),
        F.coalesce(active, F.lit(False)).alias("_on"),
    ).withColumn("_slot", F.floor(F.col("_t") / gap).cast("bigint"))
    slots = t.groupBy(*series, "_slot").agg(F.count("*").alias("_n"))
    t = with_chunk(t, series, _cuts(slots, series, per_chunk, budget), per_chunk)
    t = t.withColumnRenamed("_own", "_chunk").drop("_slot", "_next")
    # Dealt out as the windows need it, so that making times unique takes no exchange of its own.
    dealt = t.repartition(*series, "_chunk")
    t = dealt.groupBy(*series, "_chunk", "_t").agg(F.bool_and("_on").alias("_on"))
    order = Window.partitionBy(*series, "_chunk").orderBy("_t")
    begins = F.col("_on") & (
        F.lag("_t").over(order).isNull()
        | ~F.lag("_on").over(order)
        | (F.col("_t") - F.lag("_t").over(order) > gap)
    )
    marked = t.select(
        "*",
        F.when(begins, 1).otherwise(0).alias("_begin"),
        F.lag("_t").over(order).isNull().alias("_head"),
        F.lead("_t").over(order).isNull().alias("_tail"),
    ).withColumn("_run", F.sum("_begin").over(order))
    runs = (
        marked.where("_on")
        .groupBy(*series, "_chunk", "_run")
        .agg(
            F.min("_t").alias("_from"),
            F.max("_t").alias("_to"),
            F.bool_or("_head").alias("_head"),
            F.bool_or("_tail").alias("_tail"),
        )
    )
    along = Window.partitionBy(*series).orderBy("_from")
    continues = (
        F.col("_head")
        & F.lag("_tail", 1, False).over(along)
        & (F.col("_from") - F.lag("_to").over(along) <= gap)
    )
    joined = (
        runs.where("_head OR _tail")
        .withColumn("_new", F.when(continues, 0).otherwise(1))
        .withColumn("_island", F.sum("_new").over(along))
        .groupBy(*series, "_island")
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
        .drop("_island")
    )
    inner = runs.where("NOT _head AND NOT _tail").select(*series, "_from", "_to")
    return (
        joined.unionByName(inner)
        .where(F.col("_to") - F.col("_from") >= hold * SECOND)
        .select(
            *series,
            F.timestamp_micros("_from").alias("active_from"),
            F.timestamp_micros(F.col("_from") + hold * SECOND).alias("firing_from"),
            F.timestamp_micros("_to").alias("firing_to"),
        )
    )


def retain(
    spark: SparkSession, path: str, time: str, day: str, now: dt.datetime, days: int = RETENTION_DAYS
) -> None:
    """Drop samples older than ``days`` from a table partitioned by ``day``.

    Whole old days are removed as folders; only the day that contains the limit is rewritten.
    """
    limit = now - dt.timedelta(days=days)
    table = spark.read.parquet(path)
    touched = partition_values(table.where(F.col(day) <= F.lit(limit.date())), day)
    if not touched:
        return
    kept = table.where(F.lit(False))
    if limit.date() in touched:
        folder = partition_folder(spark, path, day, limit.date())
        boundary = spark.read.option("mergeSchema", True).option("basePath", path).parquet(folder)
        kept = boundary.where(F.col(time) >= F.lit(limit))
    overwrite_partitions(kept, path, day, touched)
