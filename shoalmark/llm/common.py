"""Helpers shared by the operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_SAMPLE_STEPS = 1 << 30
_PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Let the Python workers of this application import the library, wherever they run.

    The sources are packed once and handed to Spark, which sends them to every executor.
    """
    context = spark.sparkContext
    if getattr(context, "_shipped_" + _PACKAGE.name, False):
        return
    packed = Path(tempfile.mkdtemp(prefix="package-")) / f"{_PACKAGE.name}_sources.zip"
    with zipfile.ZipFile(packed, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(packed))
    setattr(context, "_shipped_" + _PACKAGE.name, True)


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function of this library."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo ``modulus``; null for a null id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % modulus


def held_out(modulus: int, rest: int, doc_id: str = "doc_id") -> Column:
    """Whether a row is kept away from training. A row without id is always kept away."""
    return F.coalesce(remainder(doc_id, modulus) == rest, F.lit(True))


def training_labels(labels: DataFrame, label: str, modulus: int, rest: int, rows: int) -> DataFrame:
    """At most ``rows`` pairs (doc_id, y) to learn from.

    Rows of the held-out remainder, null ids and null labels are left out before anything else is
    looked at. An id labelled several times takes its largest label. The sample is drawn by a hash
    of the id, so it is the same in every run and does not depend on the order of the rows.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(~held_out(modulus, rest))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
    )
    drawn = hash_sample(known, rows, known.count(), "doc_id")
    return drawn.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(rows)


def hash_sample(df: DataFrame, rows: int, of: int, *keys: str) -> DataFrame:
    """About ``rows`` of the ``of`` rows of ``df``, chosen by a hash of ``keys``."""
    if of <= rows:
        return df
    cut = int(rows / of * _SAMPLE_STEPS)
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(_SAMPLE_STEPS)) < cut)


def with_text(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, y, text) of the chosen training rows.

    ``chosen`` comes from ``training_labels``, whose row count is bounded by a parameter, so it is
    sent to the readers of the texts and the texts are not shuffled.
    """
    texts = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[str]], list]],
    fields: list[tuple[str, pa.DataType, str]],
    slice_bytes: int = 4 << 20,
) -> DataFrame:
    """Add columns computed from ``text`` by Python, in slices of about ``slice_bytes``.

    ``df`` must have a column ``text``; it is dropped from the result, the other columns stay. A
    null text is handed over as the empty text. ``make`` runs once per task and returns the function
    from texts to one list per field. ``fields`` names the new columns with Arrow and Spark types.
    """
    kept = [c for c in df.columns if c != "text"]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema.fields]
        + [f"`{name}` {kind}" for name, _, kind in fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in byte_slices(batch, slice_bytes):
                texts = [t if t is not None else "" for t in part.column("text").to_pylist()]
                found = work(texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array(v, kind) for v, (_, kind, _) in zip(found, fields)],
                    names=kept + [name for name, _, _ in fields],
                )

    return map_batches(df, run, schema)


def text_function(
    spark: SparkSession, make: Callable[[], Callable[[list[str]], list]], kind: pa.DataType,
    returns: str, slice_bytes: int = 2 << 20,
) -> Callable[[Column], Column]:
    """A function of a text column, computed by Python in slices of about ``slice_bytes``.

    Only the texts are sent to Python; the other columns of a row stay where they are. A null text is
    handed over as the empty text. ``make`` runs once per task and returns the function from texts to
    values, which have the Arrow type ``kind`` and the Spark type ``returns``.
    """
    ship(spark)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for texts in batches:
            found = [pa.array([], kind)]
            for part in byte_slices(pa.RecordBatch.from_arrays([texts], names=["text"]), slice_bytes):
                found.append(pa.array(work([t or "" for t in part.column("text").to_pylist()]), kind))
            yield pa.concat_arrays(found)

    return F.arrow_udf(run, returns)


def byte_slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice of several rows holds more than ``most`` bytes of text."""
    sizes = np.asarray([0 if v is None else v for v in _lengths(batch)], dtype=np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def _lengths(batch: pa.RecordBatch) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(batch.column("text")).to_pylist()


def fit_logistic(
    x: np.ndarray, y: np.ndarray, l2: float = 1.0, intercept: bool = True, rounds: int = 50
) -> np.ndarray:
    """Weights of a logistic model by damped Newton steps; the last weight is the intercept."""
    if intercept:
        x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    if intercept:
        ridge[-1] = 1e-6

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.logaddexp(0, np.where(y > 0.5, -z, z)).sum() + 0.5 * (ridge * v * v).sum())

    at = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > at:
            size /= 2
        if size <= 1e-4:
            break
        w = w - size * step
        before, at = at, loss(w)
        if before - at < 1e-7 * (1 + abs(before)):
            break
    return w


def squash(z: np.ndarray) -> np.ndarray:
    """The logistic function, without overflow."""
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
