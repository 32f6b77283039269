"""Spelling variants: words one edit apart, found in a trie over letter-group counts.

Letters are dealt into 26 groups. A word is the sequence of its length and its counts in them, with one
level of a trie for each. One inserted letter is a surplus of one in one group, a deleted one a deficit
of one, a replaced one both or neither; so a depth-first search with a budget of one surplus and one
deficit reaches every word within one edit, and the words of the leaves it comes to are verified letter
by letter.

The trie is cut into subtrees of a bounded number of words, each searched by one task. A word visits the
subtrees at its own depth or below whose prefix its budget can reach, so every pair meets in exactly one
of them. A leaf that is still too large is dealt into blocks by a hash of the word.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .common import byte_slices, map_batches, ship

#: Groups in the order of the trie's levels: a letter's code point modulo 26 names its group; the common
#: vowels and consonants come first, as they differ most between words.
GROUPS = [ord(c) % 26 for c in "eantirsolducmhgpbfvkwyzxjq"]
#: Words of a subtree at most, and words counted in a task before they are handed on.
SUBTREE, _COUNTED = 32_768, 200_000
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LETTERS = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100))]
#: Each letter's group as a character, and the characters of the groups in the order of the levels.
_TO_GROUP = {ord(c): chr(97 + ord(c) % 26) for c in _LETTERS}
_MARKS = [chr(97 + g) for g in GROUPS]


def noisy(doc_id: object, run: str, one_in: int) -> str:
    """The run without one letter where a hash of document and run says so."""
    mark = zlib.crc32(f"{doc_id}:{run}".encode())
    if mark % one_in:
        return run
    at = mark % len(run)
    return run[:at] + run[at + 1 :]


def count_words(documents: DataFrame, shortest: int = 7, one_in: int = 31) -> DataFrame:
    """(word, n): letter runs of ``documents`` in lower case (A-Z only), typos put in, with counts.

    Words of fewer than ``shortest`` letters are left out. Words are counted inside the tasks first.
    A null id reads as ``None`` in the hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def ready() -> pa.RecordBatch:
            made = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(made, names=["word", "n"])

        for batch in batches:
            for part in byte_slices(batch, 4 << 20):
                for doc_id, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text"))):
                    runs = Counter(_RUN.findall((text or "").encode().lower().decode()))
                    for word, n in runs.items():
                        if len(word) >= shortest:
                            counts[noisy(doc_id, word, one_in)] += n
                    if len(counts) > _COUNTED:
                        yield ready()
        yield ready()

    found = map_batches(documents.select("doc_id", "text"), run, "word string, n bigint")
    return found.where(F.char_length("word") >= shortest).groupBy("word").agg(F.sum("n").alias("n"))


def group_counts(word: str = "word") -> Column:
    """The length of ``word`` and how many letters of each group it has, in the order of the levels."""
    letters = ["".join(c for c in _LETTERS if ord(c) % 26 == g) for g in GROUPS]
    size = F.char_length(word)
    return F.array(size, *[size - F.char_length(F.translate(word, s, "")) for s in letters])


def vector(word: str) -> tuple[int, ...]:
    """The same counts in Python, without the length."""
    return tuple(map(word.translate(_TO_GROUP).count, _MARKS))


def near(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def subtrees(vectors: DataFrame, most: int) -> DataFrame:
    """(subtree, prefix, blocks): the shallowest prefixes that no more than ``most`` words share.

    ``vectors`` has (vec, words). A whole vector that more words share is kept, in several ``blocks``.
    """
    levels = len(GROUPS) + 1
    depths = F.explode(F.sequence(F.lit(1), F.lit(levels))).alias("depth")
    sizes = staged(
        vectors.select("words", "vec", depths)
        .groupBy(F.expr("slice(vec, 1, depth)").alias("prefix"), "depth")
        .agg(F.sum("words").alias("words")),
        "prefixes",
    )
    large = F.col("words") > most
    split = sizes.where(large).select(F.col("prefix").alias("parent"), F.col("depth") + 1)
    ends = sizes.where(~large | (F.col("depth") == levels))
    below = ends.where("depth > 1").withColumn("parent", F.expr("slice(prefix, 1, depth - 1)"))
    cut = ends.where("depth = 1").unionAll(below.join(split, "parent", "left_semi").select(ends.columns))
    return cut.select(
        F.monotonically_increasing_id().alias("subtree"),
        "prefix",
        F.ceil(F.col("words") / most).cast("int").alias("blocks"),
    )


def reachable(vec: str, depth: int) -> Column:
    """All prefixes of ``depth`` levels that words within one surplus and one deficit of ``vec`` have.

    ``up`` and ``down`` name the group that gains or loses a letter; 0 is none of those in the prefix.
    """
    groups, own = f"sequence(0, {depth - 1})", f"slice({vec}, 1, {depth})"
    gain, loss = "int(up > 0 and i = up)", "int(down > 0 and i = down)"
    return F.expr(
        f"""flatten(array(
          flatten(transform({groups}, up ->
            transform(filter({groups}, down -> up = 0 or down = 0 or up <> down), down ->
              transform({own}, (c, i) -> c + {gain} - {loss})))),
          transform({groups}, up -> transform({own}, (c, i) -> c + int(i = 0) + {gain})),
          transform({groups}, down -> transform({own}, (c, i) -> c - int(i = 0) - {loss}))))"""
    )


class _Node:
    """Words below a prefix: children by their next count, or a list of (vector, words)."""

    __slots__ = ("children", "leaves")

    def __init__(self, leaves: list[tuple[tuple, list]], level: int) -> None:
        self.children, self.leaves = None, leaves
        if len(leaves) > 4 and level < len(GROUPS):
            by_count: dict[int, list] = {}
            for leaf in leaves:
                by_count.setdefault(leaf[0][level], []).append(leaf)
            self.children = {c: _Node(part, level + 1) for c, part in by_count.items()}
            self.leaves = None


def search(root: _Node, vec: tuple) -> Iterator[tuple[tuple, list]]:
    """Leaves (vector, words) within a surplus of one and a deficit of one, depth first."""
    open_nodes = [(root, 0, 1, 1)]
    while open_nodes:
        node, level, surplus, deficit = open_nodes.pop()
        if node.children is None:
            for leaf in node.leaves:
                if _within(leaf[0], vec, level, surplus, deficit):
                    yield leaf
            continue
        children, count = node.children, vec[level]
        if count in children:
            open_nodes.append((children[count], level + 1, surplus, deficit))
        if surplus and count + 1 in children:
            open_nodes.append((children[count + 1], level + 1, 0, deficit))
        if deficit and count - 1 in children:
            open_nodes.append((children[count - 1], level + 1, surplus, 0))


def _within(a: tuple, b: tuple, level: int, surplus: int, deficit: int) -> bool:
    if a[level:] == b[level:]:
        return True
    for x, y in zip(a[level:], b[level:]):
        if x > y:
            surplus -= x - y
            if surplus < 0:
                return False
        elif y > x:
            deficit -= y - x
            if deficit < 0:
                return False
    return True


def _by_vector(rows: pa.Table) -> dict[tuple, list]:
    found: dict[tuple, list] = {}
    for word, n in zip(rows.column("word").to_pylist(), rows.column("n").to_pylist()):
        found.setdefault(vector(word), []).append((word, n))
    return found


def _search_subtree(rows: pa.Table) -> pa.Table:
    """Per word of a subtree or visiting it: near words found here, and the most frequent of them."""
    homes, visits = (_by_vector(rows.filter(pc.equal(rows.column("home"), at))) for at in (True, False))
    root = _Node(list(homes.items()), 0)
    count: Counter[str] = Counter()
    best: dict[str, tuple[int, str]] = {}

    def meet(a: str, n: int, b: str, m: int) -> None:
        count[a] += 1
        if a not in best or (-m, b) < best[a]:
            best[a] = (-m, b)

    for at_home, queries in ((True, homes), (False, visits)):
        for vec, asking in queries.items():
            for other, members in search(root, vec):
                if at_home and other < vec:
                    continue
                same = at_home and other == vec
                # Words one edit apart share the first or the last half of the shorter one.
                half = min(sum(vec), sum(other)) // 2
                for a, n in asking:
                    first, last = a[:half], a[len(a) - half :]
                    for b, m in members:
                        if (b.startswith(first) or b.endswith(last)) and near(a, b):
                            if not (same and b < a):
                                meet(a, n, b, m)
                                meet(b, m, a, n)
    words = list(count)
    return pa.table(
        {
            "word": pa.array(words, pa.string()),
            "n_near": pa.array([count[w] for w in words], pa.int64()),
            "minus_n": pa.array([best[w][0] for w in words], pa.int64()),
            "nearest": pa.array([best[w][1] for w in words], pa.string()),
        }
    )


def near_words(words: DataFrame, subtree: int = SUBTREE) -> DataFrame:
    """(word, n_near, minus_n, nearest) of the words within one edit of another.

    ``words`` has distinct (word, n). ``nearest`` is the near word of largest n, the first in code point
    order among equals, and ``minus_n`` is its n, negative.
    """
    ship(words.sparkSession)
    made = staged(words.select("word", "n", group_counts().alias("vec")), "vectors")
    vectors = staged(made.groupBy("vec").agg(F.count("*").alias("words")), "distinct-vectors")
    cut = staged(subtrees(vectors, subtree), "subtrees")
    depths = sorted(r[0] for r in cut.select(F.size("prefix")).distinct().collect()) or [1]
    homes = staged(
        vectors.select("vec", F.explode(F.array(*[F.slice("vec", 1, d) for d in depths])).alias("prefix"))
        .join(cut, "prefix")
        .select("vec", F.col("prefix").alias("own"), "subtree", "blocks"),
        "homes",
    )
    parts = [
        homes.where(F.size("own") <= d).select("vec", "own", F.explode(reachable("vec", d)).alias("prefix"))
        for d in depths
    ]
    # Of two subtrees at one depth, the words of the smaller prefix visit the other.
    visits = (
        reduce(DataFrame.unionAll, parts)
        .where("size(prefix) > size(own) or prefix > own")
        .join(cut, "prefix")
        .select("vec", "subtree", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    )
    block = F.expr("pmod(xxhash64(word), blocks)").cast("int")
    at_home = made.join(homes, "vec").withColumn("block", block)
    among_blocks = at_home.where("blocks > 1").withColumn(
        "block", F.explode(F.expr("filter(sequence(0, blocks - 1), b -> b > block)"))
    )
    columns = ["subtree", "block", "word", "n"]
    rows = (
        at_home.select(*columns, F.lit(True).alias("home"))
        .unionAll(among_blocks.select(*columns, F.lit(False)))
        .unionAll(made.join(visits, "vec").select(*columns, F.lit(False)))
    )
    found = rows.groupBy("subtree", "block").applyInArrow(
        _search_subtree, "word string, n_near bigint, minus_n bigint, nearest string"
    )
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min(F.struct("minus_n", "nearest")).alias("best"))
        .select("word", "n_near", "best.*")
    )


def variants(words: DataFrame, times: int = 10, subtree: int = SUBTREE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words``, which has distinct (word, n).

    ``form`` is the near word of largest n (the first in code point order among equals) if that is at
    least ``times`` the word's own n, else null. ``root`` is where the chain of forms ends.
    """
    joined = words.join(near_words(words, subtree), "word", "left")
    has_form = -F.col("minus_n") >= times * F.col("n")
    judged = staged(
        joined.select(
            "word",
            F.when(has_form, F.col("nearest")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(has_form, -F.col("minus_n")).alias("form_n"),
        ),
        "forms",
    )
    # Each step to a form multiplies n, a 64-bit number, so a chain has fewer than 64 steps (times >= 2),
    # and six rounds of following the form of the form come to its end.
    ends = judged.where("form is not null").select("word", F.col("form").alias("end"))
    for _ in range(6):
        further = ends.select(F.col("word").alias("end"), F.col("end").alias("further"))
        ends = staged(
            ends.join(further, "end", "left").select("word", F.coalesce("further", "end").alias("end")),
            "roots",
        )
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    documents: DataFrame, shortest: int = 7, fewest: int = 2, one_in: int = 31, times: int = 10
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all texts, with typos put in by a hash.

    Words have at least ``shortest`` letters and come at least ``fewest`` times. Null and empty texts
    have no words; a null id reads as ``None`` in the hash; texts of any length are read whole; repeated
    rows count as often as they come; ties between near words go to the first in code point order; an
    empty table gives an empty result; further columns are ignored.
    """
    counted = count_words(documents, shortest, one_in).where(F.col("n") >= fewest)
    return variants(staged(counted, "words"), times)
