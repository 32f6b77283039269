"""Collocations: the best-scoring phrases of each language, grown best first under admissible bounds.

A phrase of 2 to 5 words with count a, cut into parts with counts l and r, scores a * n / (l * r) at its
lowest cut (n: words of the language). As a is at most r, no phrase that begins with a word of count f
can score above n / f. So first words are expanded from the highest bound on, in tiers: their phrases grow
word by word while they are frequent, and their counts give closer bounds. The parts that no expanded word
begins are counted only for phrases whose bound still reaches the score to beat. A language is settled
when the bound of every word not yet expanded lies below its last score in the list.

Documents are read by three kinds of scans, which count words, grow phrases and look up parts. What a
scan has to look for reaches the tasks as a bitmap of hashes of a fixed size; what it finds too much by
clashes of hashes is dropped by exact joins.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import staged
from .common import byte_slices, map_batches
from .words import _VALUES, _power_tables, byte_class, mix

#: Bits of a bitmap (a multiple of 2**15), counts held in a task before they are handed on, and bytes of
#: text looked at together.
BITS, _COUNTED, _SLICE = 1 << 26, 200_000, 1 << 20
_BUCKET = 1 << 15
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_ENDS = b".,;:!?\n\x0b\x0c\r"
#: Lower case, and a full stop for everything that ends a piece.
_PIECES = bytes.maketrans(_UPPER + _ENDS, _LOWER + b"." * len(_ENDS))
#: Lower case, and blanks between all words.
_WORDS = bytes.maketrans(_UPPER + _ENDS, _LOWER + b" " * len(_ENDS))
_IN_WORD = ~byte_class((0x20, 0x20), (0x09, 0x09), (0x2E, 0x2E))
_GAP = re.compile(rb"[ \t.]")
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of a slice of texts, which are joined by full stops and translated by ``_PIECES``.

    Word i lies at ``data[starts[i]:ends[i]]``; ``joined`` says that it follows word i - 1 in one piece.
    Hashes only serve to look for words; whatever is found is taken from ``data``.
    """

    def __init__(self, data: bytes, lang: str) -> None:
        self.data = data
        codes = np.frombuffer(data, np.uint8)
        inside = np.concatenate([[False], _IN_WORD[codes], [False]])
        edges = np.flatnonzero(np.diff(inside.view(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        forward, back = _power_tables(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[codes] * forward[: len(data)], out=sums[1:])
        hashes = mix((sums[self.ends] - sums[self.starts]) * back[self.starts])
        self.hashes = hashes ^ np.uint64(zlib.crc32(lang.encode()))
        stops = np.cumsum(codes == 0x2E, dtype=np.int32)[self.starts]
        self.joined = np.diff(stops, prepend=-1) == 0

    def longer(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hashes of phrases that go on with the words ``at``."""
        return mix(hashes * _STEP + self.hashes[at])

    def phrase(self, first: int, last: int) -> bytes:
        return b" ".join(self.data[self.starts[first] : self.ends[last]].split())


def slices(texts: list[bytes], ahead: int) -> Iterator[tuple[bytes, int, int]]:
    """Texts in slices of about a megabyte: (data, begin, end), the part from begin to end being its own.

    A piece that has to be cut comes with one word before and ``ahead`` words after its part.
    """
    data = b".".join(texts).translate(_PIECES)
    following = re.compile(rb"(?:[ \t]*[^ \t.]+){0,%d}" % ahead)
    start = 0
    while start < len(data):
        end, first, last = len(data), start, len(data)
        if end - start > _SLICE:
            stop = data.rfind(b".", start + _SLICE // 2, start + _SLICE)
            gap = _GAP.search(data, start + _SLICE)
            end = stop if stop >= 0 else gap.start() if gap else end
            last = following.match(data, end).end()
        if start and data[start : start + 1] != b".":
            first = len(data[:start].rstrip(b" \t"))
            first = max(data.rfind(c, 0, first) for c in (b" ", b"\t", b".")) + 1
        yield data[first:last], start - first, end - first
        start = end


class Bitmap:
    """Which hashes of (lang, phrase) are wanted; sent once to every executor, of a fixed size."""

    def __init__(self, wanted: DataFrame, phrase: str | Column) -> None:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase"))):
                    by_lang.setdefault(lang, []).append(text)
                for lang, phrases in by_lang.items():
                    words = Words(b".".join(phrases), lang)
                    first = np.flatnonzero(~words.joined)
                    sizes = np.diff(np.append(first, len(words.starts)))
                    hashes = words.hashes[first]
                    for k in range(1, sizes.max()):
                        on = sizes > k
                        hashes[on] = words.longer(hashes[on], first[on] + k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((hashes % np.uint64(BITS)).astype(np.int64))], names=["place"]
                    )

        text = F.col(phrase) if isinstance(phrase, str) else phrase
        asked = wanted.select("lang", text.cast("binary").alias("phrase"))
        rows = (
            map_batches(asked, run, "place bigint")
            .groupBy(F.expr(f"place div {_BUCKET}").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.col("place") % _BUCKET).alias("bits"))
        )
        # At most BITS / 2**15 rows of 4 KB, whatever the input, fetched by one job.
        bits = np.zeros(BITS // 8, np.uint8)
        for bucket, part in rows.collect():
            at = bucket * _BUCKET // 8
            bits[at : at + len(part)] = np.frombuffer(part, np.uint8)
        self.sent = wanted.sparkSession.sparkContext.broadcast(bits.tobytes())

    def test(self, hashes: np.ndarray) -> np.ndarray:
        bits = np.frombuffer(self.sent.value, np.uint8)
        place = hashes % np.uint64(BITS)
        return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def drop(self) -> None:
        """Free the memory of the driver and of the executors; only once all scans with it are done."""
        self.sent.destroy()


def counted(documents: DataFrame, find: Callable[[str, list[bytes], Counter], None]) -> DataFrame:
    """(lang, found, n): what ``find`` adds to a counter for texts of one language; partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter[bytes]] = {}

        def ready() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(found), pa.string()),
                        pa.array(list(found), pa.binary()).cast(pa.string()),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    names=["lang", "found", "n"],
                )
            counts.clear()

        for batch in batches:
            for part in byte_slices(batch, 4 << 20):
                texts: dict[str, list[bytes]] = {}
                for lang, text in zip(*(part.column(c).to_pylist() for c in ("lang", "text"))):
                    texts.setdefault(lang, []).append(text)
                for lang, those in texts.items():
                    find(lang, those, counts.setdefault(lang, Counter()))
                if sum(map(len, counts.values())) > _COUNTED:
                    yield from ready()
        yield from ready()

    rows = documents.select(
        F.coalesce("lang", F.lit("und")).alias("lang"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return map_batches(rows, run, "lang string, found string, n bigint")


def word_counts(documents: DataFrame) -> DataFrame:
    """(lang, phrase, f): occurrences of every word."""

    def find(lang: str, texts: list[bytes], counts: Counter) -> None:
        for text in texts:
            counts.update(text.translate(_WORDS).split())

    found = counted(documents, find).groupBy("lang", F.col("found").alias("phrase"))
    return found.agg(F.sum("n").alias("f"))


def growths(documents: DataFrame, frequent: DataFrame, first: DataFrame, longest: int) -> DataFrame:
    """(lang, before, phrase, words, n): what follows the words ``first``, up to ``longest`` words.

    A phrase ends with its piece or before a word that is not in ``frequent``. ``before`` is the word in
    front of it, empty at the begin of a piece. Words whose hash clashes with one of ``first`` are expanded,
    too; ``grow`` drops them.
    """
    known, starts = Bitmap(frequent, "phrase"), Bitmap(first, "phrase")

    def find(lang: str, texts: list[bytes], counts: Counter) -> None:
        for data, begin, end in slices(texts, longest):
            words = Words(data, lang)
            goes_on = np.append(words.joined & known.test(words.hashes), [False] * longest)
            own = (words.starts >= begin) & (words.starts < end)
            at = np.flatnonzero(own & goes_on[1 : len(own) + 1])
            at = at[starts.test(words.hashes[at])]
            last, on = at.copy(), np.ones(len(at), bool)
            for k in range(1, longest):
                on &= goes_on[at + k]
                last += on
            for i, j, follows in zip(at.tolist(), last.tolist(), words.joined[at].tolist()):
                before = words.phrase(i - 1, i - 1) if follows else b""
                counts[before + b"\n" + words.phrase(i, j)] += 1

    phrase = F.substring_index("found", "\n", -1)
    rows = (
        counted(documents, find)
        .groupBy("lang", "found")
        .agg(F.sum("n").alias("n"))
        .select(
            "lang",
            F.substring_index("found", "\n", 1).alias("before"),
            phrase.alias("phrase"),
            F.size(F.split(phrase, " ")).alias("words"),
            "n",
        )
    )
    return _scanned(rows, "growths", known, starts)


def lookups(documents: DataFrame, parts: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, f): occurrences of the given phrases (lang, phrase) of two or more words."""
    prefixes = [Bitmap(parts, F.substring_index("phrase", " ", k)) for k in (1, 2)]
    wholes = Bitmap(parts, "phrase")

    def find(lang: str, texts: list[bytes], counts: Counter) -> None:
        for data, begin, end in slices(texts, longest):
            words = Words(data, lang)
            joined = np.append(words.joined, [False] * longest)
            at = np.flatnonzero((words.starts >= begin) & (words.starts < end))
            hashes = words.hashes[at]
            for k in range(1, longest):
                on = joined[at + k]
                if k <= len(prefixes):
                    on &= prefixes[k - 1].test(hashes)
                at = at[on]
                hashes = words.longer(hashes[on], at + k)
                for i in at[wholes.test(hashes)].tolist():
                    counts[words.phrase(i, i + k)] += 1

    found = counted(documents, find).groupBy("lang", F.col("found").alias("phrase"))
    rows = found.agg(F.sum("n").alias("f")).join(parts, ["lang", "phrase"], "left_semi")
    return _scanned(rows, "looked-up", *prefixes, wholes)


def _scanned(rows: DataFrame, label: str, *bitmaps: Bitmap) -> DataFrame:
    """``staged``; the bitmaps of the scan go afterwards."""
    made = staged(rows, label)
    for bitmap in bitmaps:
        bitmap.drop()
    return made


def grow(rows: DataFrame, first: DataFrame, fewest: int, longest: int) -> DataFrame:
    """(lang, phrase, words, f, kept): phrases of ``rows`` that come ``fewest`` times, level by level.

    They begin with one of the words ``first``: a word that is expanded in another tier, and only came
    along by its hash, would bring its phrases into the lists twice. Only rows whose shorter phrase is frequent go on to the next level. A phrase that the same word
    always precedes or always follows lies inside a longer one of the same count and is not kept.
    """
    levels, there = [], rows
    for words in range(2, longest + 1):
        prefix = F.substring_index("phrase", " ", words)
        following = F.substring_index(F.substring_index("phrase", " ", words + 1), " ", -1)
        after = F.when(F.col("words") > words, following).otherwise("")
        summed = (
            there.select("lang", prefix.alias("phrase"), "n", "before", after.alias("after"))
            .groupBy("lang", "phrase")
            .agg(
                F.sum("n").alias("f"),
                *[f(c).alias(f"{f.__name__}_{c}") for c in ("before", "after") for f in (F.min, F.max)],
            )
            .where(F.col("f") >= fewest)
        )
        if words == 2:
            head = F.substring_index("phrase", " ", 1)
            begins = first.select("lang", F.col("phrase").alias("head"))
            summed = summed.withColumn("head", head).join(begins, ["lang", "head"], "left_semi")
        inside = F.lit(False)
        if words < longest:
            for c in ("before", "after"):
                inside |= (F.col(f"min_{c}") == F.col(f"max_{c}")) & (F.col(f"min_{c}") != "")
        level = staged(
            summed.select("lang", "phrase", F.lit(words).alias("words"), "f", (~inside).alias("kept")),
            "grown",
        )
        levels.append(level)
        going_on = level.select("lang", F.col("phrase").alias("prefix"))
        longer = rows.where(F.col("words") > words).withColumn("prefix", prefix)
        there = longer.join(going_on, ["lang", "prefix"], "left_semi")
    return reduce(DataFrame.unionAll, levels)


def _ratio(above: str, below: str) -> Column:
    """Whole part of a quotient of products, exact beyond 64 bits."""

    def product(names: str) -> str:
        return " * ".join(f"CAST({x} AS DECIMAL(18, 0))" for x in names.split())

    return F.expr(f"CAST(({product(above)}) DIV ({product(below)}) AS BIGINT)")


def cuts(phrases: DataFrame, known: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, n, k, part, l, r, score) of every cut of the given (lang, phrase, words, f).

    ``part`` is what follows the cut. Where its count is not in ``known``, r is null and the score is
    the bound that holds for every possible count.
    """
    ends = F.explode(F.expr("sequence(1, words - 1)"))
    parts = (
        phrases.select("lang", "phrase", F.col("f").alias("a"), ends.alias("k"))
        .withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("part", F.expr("substring(phrase, char_length(first) + 2)"))
    )
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("part"), F.col("f").alias("r"))
    score = F.when(F.col("r").isNull(), _ratio("1000 n", "l")).otherwise(_ratio("1000 a n", "l r"))
    return (
        parts.join(left, ["lang", "first"])
        .join(right, ["lang", "part"], "left")
        .join(totals, "lang")
        .select("lang", "phrase", "a", "n", "k", "part", "l", "r", score.alias("score"))
    )


SCORED = ["lang", "phrase", "a", "n", "best.k", "best.l", "best.r", "best.score"]


def lowest(cut: DataFrame) -> DataFrame:
    """(lang, phrase, a, n, k, l, r, score, exact): the lowest cut of each phrase, the first among equals.

    If a count is not known, the score is only a bound, and ``exact`` is false.
    """
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    found = cut.groupBy("lang", "phrase", "a", "n").agg(best, F.every(F.col("r").isNotNull()).alias("exact"))
    return found.select(*SCORED, "exact")


def ranked(phrases: DataFrame, most: int) -> DataFrame:
    """The first ``most`` phrases of each language with their rank.

    Spark keeps the first ``most`` rows of a language in every task before it brings them together.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def to_beat(best: DataFrame, most: int) -> DataFrame:
    """(lang, least): the score of the last place in the lists that are full."""
    return best.where(F.col("rank") == most).select("lang", F.col("score").alias("least"))


def collocations(
    documents: DataFrame, most: int = 2000, fewest: int = 100, longest: int = 5
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``most`` phrases of each language.

    Phrases have 2 to ``longest`` words of one piece of text and come ``fewest`` times. Those inside a
    longer one of the same count are left out. The order is score, then a, both from the largest on, then
    the phrase in byte order; ties are cut by that order at ``most``.

    A null language is ``und``. Null and empty texts have no words; texts of any length are read whole;
    repeated rows count as often as they come; an empty table gives an empty result; further columns are
    ignored.
    """
    spark = documents.sparkSession
    every = staged(word_counts(documents), "word-counts")
    totals = staged(every.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = every.where(F.col("f") >= fewest)
    bounds = frequent.join(totals, "lang").withColumn("bound", _ratio("1000 n", "f"))
    waiting = staged(bounds.select("lang", "phrase", "f", "bound"), "words")
    known, best = [frequent], _nothing(spark)
    tier = 8 * fewest
    while True:
        # Full lists say which words can still matter; for the others the next tier is taken.
        scored = waiting.join(to_beat(best, most), "lang", "left")
        matter = F.coalesce(F.col("bound") >= F.col("least"), F.lit(True))
        scored = staged(scored.where(matter), "waiting")
        if scored.isEmpty():
            break
        now = F.col("least").isNotNull() | (F.col("f") < tier)
        first = scored.where(now).select("lang", "phrase")
        waiting = scored.where(~now).drop("least")
        if not first.isEmpty():
            rows = growths(documents, frequent, first, longest)
            grown = grow(rows, first, fewest, longest)
            known.append(grown.select("lang", "phrase", "f"))
            kept = grown.where("kept").drop("kept")
            best = _settled(documents, kept, known, totals, best, most, longest)
        # The nearer the lists are to their end, the shorter the next step.
        longest_list = best.agg(F.coalesce(F.max("rank"), F.lit(0))).first()[0]
        tier *= 4 if 4 * longest_list >= most else 16
    return best.select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "lang string, phrase string, a bigint, n bigint, k int, l bigint, r bigint, score bigint, rank int"
    )


def _settled(
    documents: DataFrame,
    phrases: DataFrame,
    known: list[DataFrame],
    totals: DataFrame,
    best: DataFrame,
    most: int,
    longest: int,
) -> DataFrame:
    """The lists after ``phrases`` have been scored. Counts looked up on the way are added to ``known``."""
    cut = staged(cuts(phrases, reduce(DataFrame.unionAll, known), totals), "cuts")
    bounded = staged(lowest(cut), "bounds")
    so_far = best.drop("rank")
    exact = so_far.unionAll(bounded.where("exact").drop("exact"))
    least = to_beat(ranked(exact, most), most)
    open_ones = (
        bounded.where("not exact")
        .join(least, "lang", "left")
        .where(F.coalesce(F.col("score") >= F.col("least"), F.lit(True)))
        .select("lang", "phrase")
    )
    open_ones = staged(open_ones, "open")
    missing = cut.where("r is null").join(open_ones, ["lang", "phrase"], "left_semi")
    parts = staged(missing.select("lang", F.col("part").alias("phrase")).distinct(), "parts")
    if not parts.isEmpty():
        known.append(lookups(documents, parts, longest - 1))
        scored = phrases.join(open_ones, ["lang", "phrase"], "left_semi")
        exact = exact.unionAll(
            lowest(cuts(scored, reduce(DataFrame.unionAll, known), totals)).where("exact").drop("exact")
        )
    return staged(ranked(exact, most), "best")
