"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit, a binary classifier over hashed character n-grams (1 to
3, with word ends) tells the languages with a one from those with a zero. A text is given the
language whose codeword has the least loss over all bits, each bit weighted by how well its
classifier does on training rows it was not fitted on. If the runner-up is close, the text is
flagged as ambiguous.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fit_logistic, held_out, map_batches, map_texts

_WORD = re.compile(r"[^\W\d_]+")
_SPACE, BUCKETS = 32, 1 << 15
_KNOWN_WORDS = 400_000


def codewords(k: int, seed: int = 3) -> np.ndarray:
    """A matrix of +1 and -1, a row for each of ``k`` languages, rows far apart, no equal or opposite columns.

    Up to six languages get every split into two groups; more get the best of some random codes.
    """
    if k < 2:
        return np.zeros((k, 0), dtype=np.int8)
    if k <= 6:
        splits = range(1 << (k - 1), (1 << k) - 1)
        return np.array([[1 if s >> i & 1 else -1 for s in splits] for i in range(k)], np.int8)
    rng, bits, best = np.random.default_rng(seed), max(16, int(10 * np.ceil(np.log2(k)))), None
    for _ in range(60):
        columns: dict[bytes, np.ndarray] = {}
        while len(columns) < bits:
            column = rng.choice(np.array([-1, 1], np.int8), k)
            column *= column[0]  # a split and its opposite are one
            if abs(int(column.sum())) < k:
                columns[column.tobytes()] = column
        code = np.stack(list(columns.values()), axis=1)
        apart = min((code[i] != code[j]).sum() for i, j in combinations(range(k), 2))
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1]


def ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, and for each the position of its word."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = " " + " ".join(words) + " "
    c = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    space = c == _SPACE
    owner = np.cumsum(space) - 1
    a, b, d = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    one = c * a
    two = one[:-1] * b + c[1:] + np.uint64(1)
    three = two[:-1] * d + c[2:] + np.uint64(2)
    keep1, keep2, keep3 = ~space, np.ones(len(two), bool), ~space[1:-1]
    keep2[-1] = keep2[-1] and not space[-2]
    hashed = np.concatenate([one[keep1], two[keep2], three[keep3]])
    hashed = (hashed ^ (hashed >> np.uint64(29))) * b
    owners = np.concatenate([owner[keep1], owner[:-1][keep2], owner[:-2][keep3]])
    return (hashed >> np.uint64(49)).astype(np.int64), owners


def split_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits: log odds of each n-gram
    slope: np.ndarray  # bits: margin of a text to log odds of the bit
    shift: np.ndarray
    trust: np.ndarray  # bits: weight of each bit's loss

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its share of confidence, and the loss of the runner-up over the best."""
        z = margins * self.slope + self.shift
        loss = np.logaddexp(0, -z[:, None, :] * self.code[None]) @ self.trust
        best = loss.argmin(1)
        p = np.exp(loss.min(1)[:, None] - loss)
        ordered = np.sort(loss, 1)
        gap = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(len(z), np.inf)
        return best, 1 / p.sum(1), gap


def _margins(weights: np.ndarray):
    """A function from texts to margins: the mean log odds of the n-grams of a text, for each bit."""
    bits = weights.shape[1]
    known: dict[str, int] = {}
    table = np.zeros((1024, bits + 1), np.float32)

    def run(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        nonlocal table
        if len(known) > _KNOWN_WORDS:
            known.clear()
        split = [split_words(t) for t in texts]
        new = list(set().union(*split).difference(known))
        start = len(known)
        if start + len(new) > len(table):
            table = np.vstack([table[:start], np.zeros((start + 2 * len(new), bits + 1), np.float32)])
        at, owners = ngrams(new)
        # Runs of fractions, superscripts and the like hold no letter and tell nothing.
        lettered = np.fromiter((any(map(str.isalpha, w)) for w in new), bool, len(new))
        at, owners = at[lettered[owners]], owners[lettered[owners]]
        for b in range(bits):
            table[start : start + len(new), b] = np.bincount(owners, weights[at, b], len(new))
        table[start : start + len(new), bits] = np.bincount(owners, minlength=len(new))
        known.update(zip(new, range(start, start + len(new))))
        sizes = np.array([len(s) for s in split])
        ids = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, sizes.sum())
        total = np.zeros((len(texts), bits + 1))
        worded = sizes > 0
        if worded.any():
            starts = (np.cumsum(sizes) - sizes)[worded]
            total[worded] = np.add.reduceat(table[ids].astype(np.float64), starts, axis=0)
        return total[:, :bits] / np.maximum(1, total[:, bits:]), total[:, bits] > 0

    return run


def train(
    documents: DataFrame, modulus: int = 4, rest: int = 2, rows_per_language: int = 4_000
) -> Model:
    """Fit on about ``rows_per_language`` documents of each language outside the held-out remainder.

    Rows without text, language or id teach nothing. Half of the sample gives the n-gram counts, the
    other half the slopes and trust of the bits.
    """
    known = documents.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).where(~held_out(modulus, rest))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    code = codewords(len(languages))
    bits = code.shape[1]
    empty = Model(languages, code, np.zeros((BUCKETS, bits), np.float32), np.ones(bits),
                  np.zeros(bits), np.ones(bits))
    if bits == 0:
        return empty
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30))
    limits = F.create_map(
        *[F.lit(v) for k in languages
          for v in (k, int(min(1.0, rows_per_language / sizes[k]) * (1 << 30)))]
    )
    sample = known.where(draw < limits[F.col("lang")]).select(
        "lang", (F.xxhash64("doc_id") % 2 == 0).alias("first"), "text"
    )
    counts = np.ones((len(languages), BUCKETS)) * 0.2
    index = {k: i for i, k in enumerate(languages)}
    for r in _count_ngrams(sample.where("first").select("lang", "text"), index).collect():
        counts[r["k"], r["bucket"]] += r["n"]
    shares = counts / counts.sum(1, keepdims=True)
    weights = np.stack(
        [np.log(shares[code[:, b] > 0].mean(0) / shares[code[:, b] < 0].mean(0)) for b in range(bits)],
        axis=1,
    ).astype(np.float32)
    checked = map_texts(
        sample.where("NOT first").select("lang", "text"),
        lambda: (lambda run: lambda texts: [run(texts)[0].tolist()])(_margins(weights)),
        [("m", pa.list_(pa.float64()), "array<double>")],
    ).toPandas()
    if not len(checked):
        return Model(languages, code, weights, np.ones(bits), np.zeros(bits), np.ones(bits))
    margins = np.array(checked["m"].tolist())
    truth = code[checked["lang"].map(index).to_numpy()]
    slope, shift, trust = np.ones(bits), np.zeros(bits), np.ones(bits)
    for b in range(bits):
        slope[b], shift[b] = fit_logistic(margins[:, [b]], (truth[:, b] > 0).astype(float), l2=1e-3)
        right = ((margins[:, b] * slope[b] + shift[b] > 0) == (truth[:, b] > 0)).mean()
        trust[b] = max(0.05, 2 * right - 1)
    return Model(languages, code, weights, slope, shift, trust / trust.mean())


def _count_ngrams(sample: DataFrame, index: dict[str, int]) -> DataFrame:
    """(k, bucket, n): n-grams of each language, added up inside each task first."""

    def run(batches):
        total = np.zeros((len(index), BUCKETS), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                total[index[lang]] += np.bincount(ngrams(split_words(text))[0], minlength=BUCKETS)
        k, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[k, bucket])],
            names=["k", "bucket", "n"],
        )

    parts = map_batches(sample, run, "k int, bucket int, n bigint")
    return parts.groupBy("k", "bucket").agg(F.sum("n").alias("n"))


def identify(
    documents: DataFrame, model: Model, modulus: int = 4, rest: int = 2, close: float = 0.5
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous) of every row.

    A null text, or one without any letter, is ``und`` with score 0 and not ambiguous; so is every
    text if no language was learned. ``ambiguous`` marks a runner-up within ``close`` of the least
    loss. Ties go to the first language in order. Texts are read whole; repeated rows give repeated
    results; a null id counts as held out; further columns are ignored.
    """
    languages = model.languages

    def make():
        margins = _margins(model.weights)

        def work(texts: list[str]) -> list[list]:
            m, has = margins(texts)
            if not languages:
                return [["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)]
            best, share, gap = model.decode(m)
            return [
                [languages[i] if h else "und" for i, h in zip(best, has)],
                np.where(has, share, 0.0),
                (gap < close) & has,
            ]

        return work

    rows = documents.select("doc_id", held_out(modulus, rest).alias("held_out"), "text")
    return map_texts(
        rows, make,
        [("lang_pred", pa.string(), "string"), ("score", pa.float64(), "double"),
         ("ambiguous", pa.bool_(), "boolean")],
    )


__all__ = ["Model", "codewords", "identify", "ngrams", "split_words", "train"]
