"""Benchmark decontamination with suffix arrays of the training texts.

Each shard of documents, a few megabytes inside a task, gets a suffix array over its words. Every
distinct window of the test texts is looked up in it by binary search; the range of training suffixes
that begin with it gives all verbatim occurrences and their places. Suffixes that begin with a word
pair that no test text has cannot be found by any search and are left out of the array.

The words that are hit, and the test texts they come from, are put into one further suffix array, by
doubling of prefixes. Next to a training suffix stands the test suffix with which it shares most
words, so the longest matches cost no more than sorting, however long or repetitive they are.

Test texts are sent to the tasks in blocks of bounded size, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import text_function
from .words import ALPHANUMERIC, word_hashes

#: Words in a block of test texts: 8 bytes each, and ten times as much for the searched windows.
BLOCK_WORDS = 400_000
_SHARD_BYTES = 2 << 20
_FOUND = "struct<n_words:bigint,items:array<string>,spans:array<struct<start:int,longest:int,item:string,item_start:int>>>"
_FOUND_TYPE = pa.struct([
    ("n_words", pa.int64()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("longest", pa.int32()),
                                  ("item", pa.string()), ("item_start", pa.int32())]))),
])


@dataclass
class Windows:
    """The distinct windows of one length: a place of each, and the numbers of the texts that hold it."""

    places: np.ndarray
    offsets: np.ndarray
    holders: np.ndarray


@dataclass
class TestBlock:
    """The words of the distinct test texts one after the other, and their windows by length."""

    words: np.ndarray
    ends: np.ndarray  # for each word, the end of its text
    text_of: np.ndarray  # for each word, the number of its text
    starts: np.ndarray  # for each text, its first word
    items: list[list[str]]  # for each text, the items that have it
    windows: dict[int, Windows]

    @classmethod
    def of(cls, rows: list[tuple[str, str]], window: int) -> TestBlock:
        by_text: dict[str, list[str]] = {}
        for item, text in rows:
            by_text.setdefault(text, []).append(item)
        words, counts = word_hashes(list(by_text), ALPHANUMERIC)
        stops = np.cumsum(counts)
        ends, text_of = np.repeat(stops, counts), np.repeat(np.arange(len(counts)), counts)
        windows = {}
        for length in np.unique(np.minimum(window, counts[counts > 0])).tolist():
            long = counts >= window if length == window else counts == length
            inside = long[text_of] if len(words) else np.zeros(0, bool)
            at = np.flatnonzero(inside & (np.arange(len(words)) + length <= ends))
            keys = _columns(words, ends, at, length)
            order = np.lexsort(keys[::-1])
            new = np.ones(len(at), bool)
            new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
            pairs = np.unique((np.cumsum(new) - 1) * len(counts) + text_of[at[order]])
            which, holders = np.divmod(pairs, len(counts))
            offsets = np.searchsorted(which, np.arange(int(new.sum()) + 1))
            windows[length] = Windows(at[order][new], offsets, holders)
        return cls(words, ends, text_of, stops - counts, list(by_text.values()), windows)


def _columns(words: np.ndarray, ends: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """The ``width`` words from each place on; 0 beyond the end of the text."""
    found = []
    for j in range(width):
        place = at + j
        inside = place < ends[at]
        found.append(np.where(inside, words[np.minimum(place, len(words) - 1)], np.uint64(0)))
    return found


class SuffixArray:
    """Sorted places of a shard's suffixes that begin like some test suffix."""

    def __init__(self, words: np.ndarray, ends: np.ndarray, width: int, first: np.ndarray, pair: np.ndarray):
        self.words, self.ends, self.width = words, ends, width
        follow = np.zeros(len(words), np.uint64)
        inside = np.arange(1, len(words) + 1) < ends
        follow[:-1][inside[:-1]] = words[1:][inside[:-1]]
        places = np.flatnonzero(np.isin(words, first) | np.isin(_pair(words, follow), pair))
        keys = _columns(words, ends, places, width)
        self.places = places[np.lexsort(keys[::-1])] if len(places) else places
        self.keys = _columns(words, ends, self.places, width)

    def search(self, wanted: list[np.ndarray], right: bool) -> np.ndarray:
        """Binary search of many windows at once: where each could be put in, left or right."""
        low = np.zeros(len(wanted[0]), np.int64)
        high = np.full(len(wanted[0]), len(self.places), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            probe = np.minimum(middle, len(self.places) - 1)
            less, same = np.zeros(len(low), bool), np.ones(len(low), bool)
            for key, want in zip(self.keys, wanted):
                k = key[probe]
                less |= same & (k < want)
                same &= k == want
            up = open_ & (less | same if right else less)
            low, high = np.where(up, middle + 1, low), np.where(open_ & ~up, middle, high)
        return low


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a * np.uint64(0x9E3779B97F4A7C15) + b


@dataclass
class Matches:
    """What a shard has in common with a block of test texts."""

    counts: np.ndarray  # words of each document
    documents: np.ndarray  # distinct pairs of a document and a test text with a window in it
    texts: np.ndarray
    starts: np.ndarray  # matches that lie in no earlier one: word of the shard, words, place in the block
    longest: np.ndarray
    test_places: np.ndarray


def matches(texts: list[str], block: TestBlock, window: int) -> Matches:
    """All matches of the texts; the work is that of sorting their words and those of the test texts."""
    words, counts = word_hashes(texts, ALPHANUMERIC)
    ends, owner = np.repeat(np.cumsum(counts), counts), np.repeat(np.arange(len(counts)), counts)
    longest, source = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    long = np.concatenate([w.places for k, w in block.windows.items() if k > 1] or [np.zeros(0, np.int64)])
    single = block.windows[1].places if 1 in block.windows else long[:0]
    pairs = np.unique(_pair(block.words[long], block.words[long + 1])) if len(long) else np.zeros(0, np.uint64)
    array = SuffixArray(words, ends, window, block.words[single], pairs)
    held = [np.zeros(0, np.int64)]
    for length in sorted(block.windows) if len(array.places) else ():
        found = block.windows[length]
        wanted = _columns(block.words, block.ends, found.places, length)
        low, high = array.search(wanted, False), array.search(wanted, True)
        many = high - low
        which = np.repeat(np.arange(len(many)), many)
        place = array.places[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(len(which))]
        longest[place], source[place] = length, found.places[which]
        seen = np.unique(owner[place] * len(many) + which)
        documents, which = np.divmod(seen, len(many))
        many = found.offsets[which + 1] - found.offsets[which]
        holders = found.holders[np.repeat(found.offsets[which] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
        held.append(np.unique(np.repeat(documents, many) * len(block.items) + holders))
        if length == window and len(place):
            place = np.sort(place)
            involved = np.unique(holders)
            longest[place], source[place] = _longest(words, ends, place, block, involved, window)
    documents, which = np.divmod(np.unique(np.concatenate(held)), max(1, len(block.items)))
    starts = np.flatnonzero(longest)
    upto = starts + longest[starts]
    farthest = np.concatenate([[0], np.maximum.accumulate(upto)[:-1]]) if len(upto) else upto
    starts = starts[upto > farthest]
    return Matches(counts, documents, which, starts, longest[starts], source[starts])


def _longest(
    words: np.ndarray, ends: np.ndarray, places: np.ndarray, block: TestBlock, texts: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each place, at which a window of ``texts`` begins: the words of the longest match, and its test place."""
    depth = np.zeros(len(words) + 1, np.int64)
    depth[places] += 1
    np.subtract.at(depth, places + window, 1)
    hit = np.flatnonzero(np.cumsum(depth)[:-1])
    breaks = np.ones(len(hit), bool)
    breaks[1:] = (hit[1:] != hit[:-1] + 1) | (ends[hit[1:]] != ends[hit[:-1]])
    tested = np.flatnonzero(np.isin(block.text_of, texts))
    test_breaks = np.ones(len(tested), bool)
    test_breaks[1:] = block.text_of[tested[1:]] != block.text_of[tested[:-1]]
    # All runs in a row, each behind a mark that equals nothing else, and one more mark at the end.
    new = np.concatenate([breaks, test_breaks])
    at = np.arange(len(new)) + np.cumsum(new)
    size = int(at[-1]) + 2
    values, codes = np.unique(np.concatenate([words[hit], block.words[tested]]), return_inverse=True)
    ranks = np.zeros(size, np.int64)
    marks = np.ones(size, bool)
    marks[at] = False
    ranks[marks], ranks[at] = len(values) + np.arange(int(marks.sum())), codes
    levels, width = [ranks], 1
    while levels[-1].max() + 1 < size:
        follow = np.zeros(size, np.int64)
        follow[:-width] = levels[-1][width:] + 1
        levels.append(np.unique(levels[-1] * (size + 1) + follow, return_inverse=True)[1])
        width *= 2
    sorted_places = np.argsort(levels[-1])
    origin = np.full(size, -1, np.int64)
    origin[at[len(hit) :]] = tested
    ranked = np.arange(size)
    is_test = origin[sorted_places] >= 0
    above = np.maximum.accumulate(np.where(is_test, ranked, -1))
    below = np.minimum.accumulate(np.where(is_test, ranked, size)[::-1])[::-1]
    own = at[np.searchsorted(hit, places)]
    best, source = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    for near in (above[levels[-1][own]], below[levels[-1][own]]):
        there = np.flatnonzero((near >= 0) & (near < size))
        a, b = own[there], sorted_places[near[there]]
        other, length = origin[b], np.zeros(len(there), np.int64)
        for k in reversed(range(len(levels))):
            same = levels[k][a] == levels[k][b]
            step = np.where(same, 1 << k, 0)
            a, b, length = a + step, b + step, length + step
        more = length > best[there]
        best[there[more]], source[there[more]] = length[more], other[more]
    return best, source


def _blocks(benchmark: DataFrame, window: int) -> Iterator[TestBlock]:
    """The distinct test texts in blocks of at most about ``BLOCK_WORDS`` words, one at a time."""
    rows = benchmark.where("text IS NOT NULL").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    ).distinct()
    held, size = [], 0
    for row in rows.toLocalIterator():
        held.append((row["item"], row["text"]))
        size += len(row["text"]) // 2 + 1
        if size > BLOCK_WORDS:
            yield TestBlock.of(held, window)
            held, size = [], 0
    yield TestBlock.of(held, window)


def find_matches(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """All columns of ``documents`` as ``row``, with n_words, items and spans.

    ``items`` lists the items of which a window occurs. ``spans`` has, in order, the longest verbatim
    matches that do not lie inside an earlier one: the first word in the document, the number of words,
    one item and the place there. They cover all words that are hit. An item that is larger than a block
    of test texts has a block of its own.
    """
    spark = documents.sparkSession
    parts = []
    for block in _blocks(benchmark, window):
        shared = spark.sparkContext.broadcast(block)
        search = text_function(spark, _searcher(shared, window), _FOUND_TYPE, _FOUND, _SHARD_BYTES)
        parts.append(search(F.col("text")))
    names = [f"found{i}" for i in range(len(parts))]
    found = documents.select(F.struct("*").alias("row"), *[p.alias(n) for p, n in zip(parts, names)])
    joined = lambda field: F.flatten(F.array(*[F.col(f"{n}.{field}") for n in names]))
    spans = joined("spans") if len(parts) == 1 else F.array_sort(joined("spans"))
    return found.select(
        "row", F.col("found0.n_words").alias("n_words"),
        F.array_sort(F.array_distinct(joined("items"))).alias("items"), spans.alias("spans"),
    )


def _searcher(shared, window: int):
    def work(texts: list[str]) -> list[dict]:
        block = shared.value
        found = matches(texts, block, window)
        rows = [{"n_words": n, "items": [], "spans": []} for n in found.counts.tolist()]
        for d, t in zip(found.documents.tolist(), found.texts.tolist()):
            rows[d]["items"] += block.items[t]
        ends = np.cumsum(found.counts)
        owner = np.searchsorted(ends, found.starts, side="right")
        inside = found.starts - (ends - found.counts)[owner]
        text = block.text_of[found.test_places]
        first = found.test_places - block.starts[text]
        named = {t: min(block.items[t]) for t in set(text.tolist())}
        for d, start, longest, t, place in zip(*(x.tolist() for x in (owner, inside, found.longest, text, first))):
            span = {"start": start, "longest": longest, "item": named[t], "item_start": place}
            rows[d]["spans"].append(span)
        return rows

    return lambda: work


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(row, n_words, n_hit, n_items, items_sha256, contaminated, longest_match) of every document.

    Words are runs of digits, letters and characters beyond ASCII, with A-Z in lower case. A window
    is ``window`` consecutive words of an item, or all words of a shorter one. A document word is
    hit if it lies in an occurrence of any window.

    Null texts have no words; items without words have no windows. Items that share an id count as
    one, a null id counts as the empty one. Repeated documents get equal results. Without items no
    document is hit; no documents give no rows; further columns stay in ``row``.
    """
    found = find_matches(documents, benchmark, window)
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("a"), (s["start"] + s["longest"]).alias("b"))))
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("hit"))
    covered = F.aggregate(
        ordered,
        start,
        lambda s, x: F.struct(
            F.greatest(s["upto"], x["b"]).alias("upto"),
            (s["hit"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["upto"], x["a"]))).alias("hit"),
        ),
        lambda s: s["hit"],
    )
    made = found.select("row", "n_words", "spans", covered.cast("bigint").alias("n_hit"), "items")
    return made.select(
        "row", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["longest"])), F.lit(0)).alias("longest_match"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = 10, least: int = 1) -> DataFrame:
    """The columns of ``documents`` without those in which at least ``least`` words are hit."""
    return contamination(documents, benchmark, window).where(F.col("n_hit") < least).select("row.*")
