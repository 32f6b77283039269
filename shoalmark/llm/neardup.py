"""Near-duplicates by bottom-k sketches from one hash function.

1. Every text becomes the set of its hashed shingles of ``width`` words; texts with equal sets form a class and
   only classes go on.
2. The ``SKETCH`` smallest hashes of a set are its sketch. Inverted lists of the retained values show
   which classes overlap. Two linked classes share many retained values (``least_shared``), so a
   class is listed only under its rarest values, as many as are needed to meet every partner
   (prefix filter); frequent passages hardly get lists. Values that no class of a fitting size
   retains do not count.
3. A list is cut into bands of set size. In each, three leaders meet all others. Pairs whose union
   sketch speaks against a similarity of 0.8 go; the rest is confirmed on full sets, and components
   are formed.
4. Only lists that the leaders do not settle and that still hold several components are searched
   pair by pair, in blocks, inside the tasks, by the bits of their values first. The largest component of a list is not compared with itself. Sets of up to ``WIDE``
   shingles are compared whole, and only the links that connect components leave the task; larger
   ones by a wide sketch, and what it leaves is confirmed on full sets.

Up to ``LOSSLESS`` (80) shingles no link can be lost. Beyond, the method is not exact: a link at
exactly 0.8 is lost by the lists with a probability of up to 2.6e-8 and, from 128 shingles on, by
the sketches of 64 with up to 1.9e-8, together about 5e-8 (binomial limits); a closer one with less.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import held, staged
from .common import byte_slices, map_batches
from .words import NOT_SPACE, mix, word_hashes

SKETCH, FEWEST, BLOCK = 64, 32, 1024
#: Words of a shingle, unless a caller asks for more.
WIDTH = 2
#: Retained values that may get lists, and how many of them a link shares at least.
LISTED, LISTED_FEWEST = 32, 12
#: Shingles of the larger set up to which two linked ones share that many in any case.
LOSSLESS = 4 * min(SKETCH - FEWEST, LISTED - LISTED_FEWEST)
#: Shingles that are compared at once inside a block, and how many of them a link shares at least.
WIDE, WIDE_FEWEST, _COLUMNS = 256, 158, 4096
#: Bits that show which shared retained values a class has.
_BITS = [f"bits{i}" for i in range(4)]
#: Shingles of a set in a block of full sets, on average; larger ones make more blocks.
_SET = 1024
#: Ids, of some 40 bytes, that are sent to all readers of texts; more are joined by a shuffle.
_SENT_IDS = 500_000


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``staged`` for the steps inside; their tables are removed when the steps are done."""
    with ExitStack() as tables:
        yield lambda df, label: tables.enter_context(held(df, label))


def shingle_sets(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (63 bits) of all texts, sorted within each text, and their numbers.

    A text of fewer words than ``width`` has all its words as its only shingle.
    """
    words, counts = word_hashes(texts, NOT_SPACE)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    found, owners, run = [], [], words
    for length in range(1, width + 1):
        # ``run`` holds the hash of ``length`` words from each word on.
        if length > 1:
            run = mix(run[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[length - 1 :] + np.uint64(1))
        if length < width:
            short = np.flatnonzero(counts == length)
            found.append(mix(run[ends[short] - length] + np.uint64(2)))
            owners.append(short)
        else:
            inside = owner[: len(run)] == owner[length - 1 :]
            found.append(run[inside])
            owners.append(owner[: len(run)][inside])
    hashes, whose = np.concatenate(found) >> np.uint64(1), np.concatenate(owners)
    order = np.lexsort((hashes, whose))
    hashes, whose = hashes[order], whose[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (whose[1:] != whose[:-1])
    return hashes[new].astype(np.int64), np.bincount(whose[new], minlength=len(texts))


def _lists(values: np.ndarray, sizes: np.ndarray, most: int | None = None) -> pa.ListArray:
    if most is not None:
        starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
        values = values[np.arange(len(values)) - starts < most]
        sizes = np.minimum(sizes, most)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _set_keys(values: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    """128 bits for each set, equal for equal sets; none for the empty set."""
    keys = np.zeros((len(sizes), 2), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        for j, add in enumerate((np.uint64(11), np.uint64(0xABCDEF))):
            keys[full, j] = np.add.reduceat(mix(values.astype(np.uint64) + add), starts)
    packed = keys.astype(">u8").tobytes()
    return [packed[16 * i : 16 * i + 16] if n else None for i, n in enumerate(sizes)]


def _with_sets(df: DataFrame, full: bool, width: int) -> DataFrame:
    """Columns of ``df`` but ``text``, with n, cls (key of the set) and the sketch or the full set."""
    kept = [c for c in df.columns if c != "text"]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    last = "shingles" if full else "sketch"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 2 << 20):
                values, sizes = shingle_sets([t or "" for t in part.column("text").to_pylist()], width)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept]
                    + [pa.array(sizes, pa.int64()), pa.array(_set_keys(values, sizes), pa.binary()),
                       _lists(values, sizes, None if full else SKETCH)],
                    names=[*kept, "n", "cls", last],
                )

    schema = ", ".join([f"`{c}` {types[c]}" for c in kept])
    return map_batches(df, run, f"{schema}, n bigint, cls binary, {last} array<bigint>")


def least_shared(n: Column, kept: int = SKETCH, fewest: int = FEWEST) -> Column:
    """Of its ``kept`` smallest hashes, those that a class of ``n`` shares at least with a linked one.

    If the union is not larger than ``kept``, four fifths of it are shared; else at most n / 4 of the
    smallest hashes of the union are not.
    """
    return (
        F.when(n <= int(0.8 * kept), F.ceil(n * F.lit(0.8)))
        .when(n < kept, F.ceil(F.lit(0.64 * kept)))
        .otherwise(F.greatest(F.lit(fewest), F.ceil(F.lit(kept) - n / 4)))
        .cast("int")
    )


def _band(n: str) -> Column:
    """Linked classes are in the same band of size or in neighbouring ones."""
    return F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(1.25))).cast("int")


def _one(place: Column) -> Column:
    """A number with one of its 64 bits set."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))


def prefixes(classes: DataFrame) -> DataFrame:
    """(cls, n, prefix, roles, bits, spare): the values under which a class is listed, its rarest retained ones.

    A value counts for a class only if another one of a fitting band of size retains it. Its role says
    where that one can be met: 1 in the own band, 2 in the next, 3 in both. ``bits0`` to ``bits3`` have
    a bit for each of the values that count, and ``spare`` is the number of these values beyond that of
    the bits. So two classes of fitting bands share at most as many retained values as they share
    bits, plus the lesser ``spare``.
    """
    retained = classes.select("cls", "n", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    shared = (
        retained.groupBy("value").agg(F.count("*").alias("seen"), F.bit_or(_one(_band("n"))).alias("bands")).where("seen > 1")
    )
    # Bands that are 64 apart share a bit, which can only make a value count that need not.
    in_band = lambda step: F.col("bands").bitwiseAND(_one(_band("n") + step)) != 0
    in_own = (F.col("seen") > F.bit_count("bands")) | in_band(-1)
    ranked = (
        retained.join(shared, "value")
        .withColumn("role", in_own.cast("int") + 2 * in_band(1).cast("int"))
        .where("role > 0")
        .groupBy("cls", "n")
        .agg(F.sort_array(F.collect_list(F.struct("seen", "value", "role"))).alias("values"))
    )
    least_held = F.least(F.col("n"), F.lit(LISTED)).cast("int")
    # Values that do not count come first in the order of rarity and take up places.
    least = least_shared(F.col("n"), LISTED, LISTED_FEWEST)
    places = least_held - least + 1 - (least_held - F.size("values"))
    chosen = lambda part: F.transform(F.slice("values", 1, places), lambda v: v[part])

    def bits(part: int) -> Column:
        # Retained values are the smallest hashes, so only their low bits are evenly spread.
        own = lambda v: F.pmod(F.shiftright(v["value"], 6), F.lit(len(_BITS))) == part
        return F.aggregate(F.filter("values", own), F.lit(0).cast("bigint"), lambda x, v: x.bitwiseOR(_one(v["value"])))

    made = ranked.where(places > 0).select(
        "cls", "n", chosen("value").alias("prefix"), chosen("role").alias("roles"), F.size("values").alias("size"),
        *[bits(i).alias(c) for i, c in enumerate(_BITS)],
    )
    used = reduce(Column.__add__, [F.bit_count(c) for c in _BITS])
    return made.withColumn("spare", (F.col("size") - used).cast("int")).drop("size")


def inverted_lists(listed: DataFrame) -> DataFrame:
    """(value, band, cls, n, native, bits, spare): classes under each value of their prefix, in bands of size.

    A class stands in its own band and, as a visitor, in the next, so that linked classes meet in
    the band of the larger one. Where its role tells that nobody is met, it is left out.
    """
    signature = [*_BITS, "spare"]
    listed = listed.select("cls", "n", *signature, _band("n").alias("own"), F.explode(F.arrays_zip("prefix", "roles")).alias("at"))
    native = F.struct(F.col("own").alias("band"), F.lit(True).alias("native"))
    visitor = F.struct((F.col("own") + 1).alias("band"), F.lit(False).alias("native"))
    places = F.when(F.col("at.roles") == 1, F.array(native)).when(F.col("at.roles") == 2, F.array(visitor))
    return listed.select(
        F.col("at.prefix").alias("value"), "cls", "n", *signature,
        F.explode(places.otherwise(F.array(native, visitor))).alias("place"),
    ).select("value", "place.band", "cls", "n", "place.native", *signature)


def _leaders(lists: DataFrame) -> DataFrame:
    """(value, band, size, natives, leaders): natives with the least and greatest key and the least hash of it."""
    whole = F.struct("cls", "n", *_BITS, "spare")
    own = F.when(F.col("native"), whole)
    by_hash = F.when(F.col("native"), F.struct(F.xxhash64("cls").alias("h"), whole.alias("who")))
    grouped = lists.groupBy("value", "band").agg(
        F.count("*").alias("size"), F.count_if("native").alias("natives"), F.min(own).alias("a"), F.max(own).alias("b"),
        F.min(by_hash).alias("c"),
    )
    return grouped.where("size > 1 AND a IS NOT NULL").select(
        "value", "band", "size", "natives", F.array_distinct(F.array("a", "b", "c.who")).alias("leaders")
    )


def _leader_pairs(lists: DataFrame, leaders: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of a leader and another of its list.

    Both have fitting sizes, and their bits allow as many common retained values as a link has.
    """
    signature = [*_BITS, "spare"]
    met = lists.join(leaders.select("value", "band", "leaders"), ["value", "band"]).select(
        "cls", "n", *signature, F.explode("leaders").alias("leader")
    )
    fitting = 100 * F.least("n", "leader.n") >= 80 * F.greatest("n", "leader.n")
    common = reduce(Column.__add__, [F.bit_count(F.col(c).bitwiseAND(F.col(f"leader.{c}"))) for c in _BITS])
    least = F.greatest(*[least_shared(F.col(n), LISTED, LISTED_FEWEST) for n in ("n", "leader.n")])
    likely = common + F.least("spare", "leader.spare") >= least
    return (
        met.where((F.col("cls") != F.col("leader.cls")) & fitting & likely)
        .select(F.least("cls", "leader.cls").alias("a"), F.greatest("cls", "leader.cls").alias("b"))
        .distinct()
    )


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose union sketch holds enough common values for a similarity of 0.8."""
    s = classes.select("cls", "n", "sketch")
    both = pairs.join(s.toDF("a", "na", "sa"), "a").join(s.toDF("b", "nb", "sb"), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    least = F.greatest(least_shared(F.col("na")), least_shared(F.col("nb")))
    return both.where(common >= least).select("a", "b")


def _full_sets(
    wanted: DataFrame, classes: DataFrame, documents: DataFrame, width: int, keep: Callable = staged
) -> DataFrame:
    """(cls, shingles): the full sets of the distinct classes in ``wanted``.

    A class is read from the rows that have both the id and the text of its first one. It comes more
    than once only if that row does, at most once for each task.
    """
    ids = keep(
        classes.select(F.col("cls").alias("wanted"), "first_id", "first_key").join(
            wanted.select(F.col("cls").alias("wanted")).distinct(), "wanted"
        ),
        "ids",
    )
    if ids.count() <= _SENT_IDS:
        ids = F.broadcast(ids)
    rows = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    met = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key")))
    made = _with_sets(met.select("wanted", "text"), True, width).where("cls = wanted")
    return keep(map_batches(made.select("cls", "shingles"), _first_of_each, "cls binary, shingles array<bigint>"), "sets")


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[bytes] = set()
    for batch in batches:
        new = []
        for cls in batch.column("cls").to_pylist():
            new.append(cls not in seen)
            seen.add(cls)
        yield batch.filter(pa.array(new, pa.bool_()))


def components(edges: DataFrame) -> DataFrame:
    """(cls, comp) of all ends of ``edges``: the least key that can be reached.

    In each round every key hooks to its least neighbour. Two keys that hook to each other are the
    only circle that this can make, and the lesser of them is the least key of its tree; all keys of
    a tree become that one, and links inside a tree go. A tree has at least two keys, so with every
    round at most half of the keys go on, in whatever order they are.
    """
    with scratch() as keep:
        links = keep(edges.select("a", "b"), "edges")
        labels = links.toDF("cls", "comp").limit(0)
        while not links.isEmpty():
            roots = _rooted(links, keep)
            above = roots.toDF("comp", "root")
            moved = labels.join(above, "comp", "left").select("cls", F.coalesce("root", "comp").alias("comp"))
            new = roots.join(labels, "cls", "left_anti")
            labels = keep(moved.union(new), "labels")
            ends = links.join(roots.toDF("a", "x"), "a").join(roots.toDF("b", "y"), "b").where("x != y")
            links = keep(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        return staged(labels, "components")


def _rooted(links: DataFrame, keep: Callable) -> DataFrame:
    """(cls, comp) of all ends of ``links``: the root of the tree that a key hooks into."""
    both = links.union(links.select("b", "a")).toDF("cls", "up")
    hooked = keep(both.groupBy("cls").agg(F.min("up").alias("up")), "hooked")
    above = hooked.toDF("up", "top")
    root = (F.col("top") == F.col("cls")) & (F.col("cls") <= F.col("up"))
    tree = keep(hooked.join(above, "up").select("cls", F.when(root, F.col("cls")).otherwise(F.col("up")).alias("comp")), "tree")
    while True:
        # The way to the root is halved each time.
        above = tree.toDF("comp", "top")
        moved = keep(
            tree.join(above, "comp").select("cls", F.col("top").alias("comp"), (F.col("top") != F.col("comp")).alias("changed")),
            "tree",
        )
        tree = moved.select("cls", "comp")
        if moved.where("changed").isEmpty():
            return tree


def _with_component(df: DataFrame, labels: DataFrame) -> DataFrame:
    return df.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))


def _open_members(lists: DataFrame, leaders: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of lists that the leaders have not settled, with the pairs of blocks they go to.

    The leaders have met everyone. So a list is settled if all its natives lead it, since visitors meet
    natives only, or if one member alone does not. A list that fits into a block is one. In a longer
    one, the members of the largest component have blocks of their own, which meet those of the
    others only; the others meet everyone.
    """
    led = F.size("leaders")
    larger = leaders.where((F.col("size") > led + 1) & (F.col("natives") > led)).select("value", "band")
    placed = _with_component(lists.join(larger, ["value", "band"]), labels)
    sizes = placed.groupBy("value", "band", "comp").agg(F.count("*").alias("n"))
    most = F.max(F.struct("n", "comp"))
    open_lists = (
        sizes.groupBy("value", "band")
        .agg(F.sum("n").alias("all"), most.alias("most"))
        .where(F.col("all") > F.col("most.n"))
        .select(
            "value", "band", F.col("most.comp").alias("big"),
            F.when(F.col("all") <= BLOCK, 0).otherwise(F.ceil(F.col("most.n") / BLOCK)).cast("int").alias("big_blocks"),
            F.when(F.col("all") <= BLOCK, 1).otherwise(F.ceil((F.col("all") - F.col("most.n")) / BLOCK)).cast("int").alias("blocks"),
        )
    )
    met = placed.join(open_lists, ["value", "band"])
    first = F.col("big_blocks")
    in_big = (first > 0) & (F.col("comp") == F.col("big"))
    draw = F.xxhash64("cls", F.lit(5))
    mine = F.when(in_big, F.pmod(draw, F.greatest(first, F.lit(1)))).otherwise(first + F.pmod(draw, F.col("blocks")))
    others = F.sequence(first, first + F.col("blocks") - 1)
    everyone = F.sequence(F.lit(0), first + F.col("blocks") - 1)
    meetings = F.transform(
        F.when(in_big, others).otherwise(everyone),
        lambda k: F.struct(F.least(k, F.col("mine")).alias("i"), F.greatest(k, F.col("mine")).alias("j")),
    )
    return (
        met.withColumn("mine", mine.cast("int"))
        .select("value", "band", "cls", "n", "comp", "native", "mine", *_BITS, "spare", F.explode(meetings).alias("at"))
        .select("value", "band", "at.i", "at.j", "cls", "n", "comp", "native", "mine", *_BITS, "spare")
    )


def _dealt(spread: DataFrame, *keys: str) -> DataFrame:
    return spread.repartition(*keys).sortWithinPartitions(*keys)


def _with_common_bits(members: DataFrame) -> DataFrame:
    """Members that meet, in their pair of blocks, one that may share as many retained values as a link.

    This is told by the bits, which stand in the lists, so that sketches are joined to few members.
    """
    kept = members.drop(*_BITS, "spare")
    names = kept.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, i, j), rows in _runs(batches, _KEYS):
            likely = _with_bits_of_links(rows, i == j)
            if likely is not None and (met := likely.any(0) | likely.any(1)).any():
                yield from rows.filter(pa.array(met)).select(names).combine_chunks().to_batches()

    return map_batches(_dealt(members, *_KEYS), run, schema)


def _with_bits_of_links(rows: pa.Table, same_block: bool) -> np.ndarray | None:
    ok, *_ = _comparable(rows, same_block)
    if ok is None:
        return None
    words = np.stack([rows.column(c).to_numpy() for c in _BITS], 1).astype("<i8")
    bits = np.unpackbits(words.view(np.uint8), axis=1).astype(np.float32)
    n, spare = rows.column("n").to_numpy(), rows.column("spare").to_numpy()
    # As in least_shared.
    least = np.maximum(LISTED_FEWEST, np.ceil(LISTED - n / 4))
    least[n < LISTED] = np.ceil(0.64 * LISTED)
    few = n <= int(0.8 * LISTED)
    least[few] = np.ceil(n[few] * 0.8)
    common = bits @ bits.T + np.minimum(spare[:, None], spare[None])
    return np.triu(ok & (common >= np.maximum(least[:, None], least[None])), 1)


def _with_earlier(members: DataFrame, listed: DataFrame) -> DataFrame:
    """Members with those values of their prefix, as ``prefix``, whose lists come before the own one."""
    before = F.filter("prefix", lambda v: v < F.col("value"))
    return members.join(listed.select("cls", "prefix"), "cls").withColumn("prefix", before)


def _with_partner(members: DataFrame, classes: DataFrame, listed: DataFrame) -> DataFrame:
    """Members that meet, in their pair of blocks, one they may be linked with by the sketches."""
    # Half of each value is enough here: values taken for equal only let more members go on.
    low = F.transform("sketch", lambda v: v.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
    sketches = classes.select("cls", low.alias("shingles"))
    spread = _with_earlier(members.join(sketches, "cls"), listed)
    kept = members.schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.fields)
    names = kept.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (value, _, i, j), rows in _runs(batches, _KEYS):
            likely = _candidates(rows, value, i == j, SKETCH, FEWEST)[0]
            if likely is not None and (met := likely.any(0) | likely.any(1)).any():
                yield from rows.filter(pa.array(met)).select(names).combine_chunks().to_batches()

    return map_batches(_dealt(spread, *_KEYS), run, schema)


_KEYS = ("value", "band", "i", "j")


def _searched(members: DataFrame, sets: DataFrame, listed: DataFrame) -> DataFrame:
    """(a, b, sure): links between components found in blocks, and pairs left to be confirmed."""
    wide = sets.select("cls", F.slice("shingles", 1, WIDE).alias("shingles"))
    spread = _with_earlier(members.join(wide, "cls"), listed)
    return map_batches(_dealt(spread, *_KEYS), _search_blocks, "a binary, b binary, sure boolean")


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.Table]]:
    """Tables of the rows with equal keys, from batches in the order of the keys."""
    key, parts = None, []
    for batch in batches:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in keys]
        changes = np.zeros(max(0, batch.num_rows - 1), bool)
        for c in columns:
            changes |= c[1:] != c[:-1]
        starts = [0, *(np.flatnonzero(changes) + 1).tolist()] if batch.num_rows else []
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            here = tuple(c[start] for c in columns)
            if here != key and parts:
                yield key, pa.Table.from_batches(parts).combine_chunks()
                parts = []
            key = here
            parts.append(batch.slice(start, end - start))
    if parts:
        yield key, pa.Table.from_batches(parts).combine_chunks()


def _search_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (value, _, i, j), rows in _runs(batches, _KEYS):
        if found := _block_pairs(rows, value, i == j):
            kinds = (pa.binary(), pa.binary(), pa.bool_())
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "sure"])


def _comparable(rows: pa.Table, same_block: bool) -> tuple:
    """Pairs of rows of different components and fitting size, with a native; the components and sizes."""
    comps = rows.column("comp").to_pylist()
    if len(rows) < 2 or len(set(comps)) < 2:
        return None, None, None
    n, comp = rows.column("n").to_numpy(), np.unique(comps, return_inverse=True)[1]
    native, mine = np.array(rows.column("native").to_pylist()), rows.column("mine").to_numpy()
    larger = np.maximum(n[:, None], n[None])
    ok = 100 * np.minimum(n[:, None], n[None]) >= 80 * larger
    ok &= (comp[:, None] != comp[None]) & (native[:, None] | native[None])
    if not same_block:
        ok &= mine[:, None] != mine[None]
    return ok, comp, larger


def _candidates(rows: pa.Table, value: int, same_block: bool, kept: int, fewest: int) -> tuple:
    """Pairs of rows that may be linked, the numbers of common values, and the components.

    A pair is of different components, holds a native, is of fitting size, has not met in the list of
    a smaller common value of the prefixes, and shares enough of the ``kept`` smallest hashes.
    """
    ok, comp, larger = _comparable(rows, same_block)
    if ok is None:
        return None, None, None
    shared = _shared(*_flat(rows.column("shingles")))
    prefix, lengths = _flat(rows.column("prefix"))
    earlier = prefix < value
    owner = np.repeat(np.arange(len(rows)), lengths)[earlier]
    ok &= _shared(prefix[earlier], np.bincount(owner, minlength=len(rows))) == 0
    # Of a linked pair, at most n / 4 of the smallest hashes of the union are not shared.
    least = np.minimum(np.maximum(fewest, kept - larger / 4), 0.8 * larger)
    return np.triu(ok & (shared >= least), 1), shared, comp


def _block_pairs(rows: pa.Table, value: int, same_block: bool) -> list[tuple[bytes, bytes, bool]]:
    """Links of different components, and pairs that the wide sketches cannot decide.

    Of links between whole sets only as many are returned as it takes to connect the components.
    """
    likely, shared, comp = _candidates(rows, value, same_block, WIDE, WIDE_FEWEST)
    if likely is None:
        return []
    cls, n = rows.column("cls").to_pylist(), rows.column("n").to_numpy()
    whole = (n[:, None] <= WIDE) & (n[None] <= WIDE)
    linked = likely & whole & (100 * shared >= 80 * (n[:, None] + n[None] - shared))
    find, found = _Forest(), []
    for x, y in zip(*np.nonzero(linked)):
        if find.join(comp[x], comp[y]):
            found.append((*sorted((cls[x], cls[y])), True))
    found += [(*sorted((cls[x], cls[y])), False) for x, y in zip(*np.nonzero(likely & ~whole))]
    return found


class _Forest:
    """Sets of things that have been joined."""

    def __init__(self):
        self.parent: dict = {}

    def top(self, c):
        path = [c]
        while (up := self.parent.get(path[-1], path[-1])) != path[-1]:
            path.append(up)
        self.parent.update(dict.fromkeys(path, path[-1]))
        return path[-1]

    def join(self, a, b) -> bool:
        """Whether the two were apart until now."""
        a, b = self.top(a), self.top(b)
        self.parent[a] = b
        return a != b


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and the length of each list."""
    lists = lists.combine_chunks()
    return lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())


def _shared(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many values each two of the sets have in common.

    A value that a set has more than once is counted for all it may stand for.
    """
    _, at, seen = np.unique(values, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    often = seen[at] > 1
    columns = np.cumsum(seen > 1) - 1
    at, owner = columns[at[often]], owner[often]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    shared = np.zeros((len(sizes), len(sizes)), np.float32)
    repeated = np.bincount(owner, minlength=len(sizes)).astype(np.float32)
    width = int(at[-1]) + 1 if len(at) else 0
    for start in range(0, width, _COLUMNS):
        low, high = np.searchsorted(at, [start, start + _COLUMNS])
        holds = np.zeros((len(sizes), min(_COLUMNS, width - start)), np.float32)
        holds[owner[low:high], at[low:high] - start] = 1
        shared += holds @ holds.T
        repeated -= holds.sum(1)
    return shared + repeated[:, None] + repeated[None]


def _settled(pairs: DataFrame, sets: DataFrame, keep: Callable) -> DataFrame:
    """As many of the pairs that are linked on full sets as it takes to connect what they connect.

    The pairs of a group that hangs together are tested in one place, or in pairs of blocks if it has
    many or large sets, so that a full set is sent to each of these once and not with every pair.
    """
    labels = components(pairs)
    sizes = sets.select("cls", F.size("shingles").alias("n"))
    larger = F.greatest(F.count("*") / BLOCK, F.sum("n") / (BLOCK * _SET))
    blocks = labels.join(sizes, "cls").groupBy("comp").agg(F.ceil(larger).cast("int").alias("blocks"))
    block = lambda c: F.pmod(F.xxhash64(c, F.lit(6)), F.col("blocks")).cast("int")
    placed = keep(
        pairs.join(labels.toDF("a", "comp"), "a").join(blocks, "comp")
        .withColumns({"x": block("a"), "y": block("b")})
        .select("comp", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "a", "b"),
        "placed",
    )
    keys = ["comp", "i", "j"]
    ends = placed.select(*keys, F.explode(F.array("a", "b")).alias("cls")).distinct()
    with_sets = ends.join(sets, "cls").select(
        *keys, F.lit(0).alias("kind"), F.col("cls").alias("a"), F.lit(None).cast("binary").alias("b"), "shingles"
    )
    asked = placed.select(*keys, F.lit(1).alias("kind"), "a", "b", F.lit(None).cast("array<bigint>").alias("shingles"))
    dealt = with_sets.unionByName(asked).repartition(*keys).sortWithinPartitions(*keys, "kind")
    return map_batches(dealt, _test_pairs, "a binary, b binary")


def _test_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _runs(batches, ("comp", "i", "j")):
        kind = rows.column("kind").to_numpy()
        own = rows.slice(0, int((kind == 0).sum()))
        values, sizes = _flat(own.column("shingles"))
        sets = dict(zip(own.column("a").to_pylist(), np.split(values, np.cumsum(sizes)[:-1])))
        asked = rows.slice(len(own))
        find, found = _Forest(), []
        for a, b in zip(asked.column("a").to_pylist(), asked.column("b").to_pylist()):
            if find.top(a) == find.top(b):
                continue
            x, y = sets[a], sets[b]
            common = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * common >= 80 * (len(x) + len(y) - common):
                find.join(a, b)
                found.append((a, b))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["a", "b"]
        )


def near_duplicates(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of every row of ``documents``.

    Words are what stands between blanks and control characters, with A-Z in lower case. A text of
    fewer words than ``width`` has all of them as its only shingle. Texts with 100 * intersection >= 80 * union of
    their sets are linked, and so are their links. ``component_id`` is the least doc_id of the
    component, ``kept`` marks the row that has it.

    Null texts, and texts without words, have no shingles and are linked with nothing: they are
    components of their own. ``text_key`` is a 64-bit hash of the text, to tell rows of one id apart. Null ids come after all others; a row without id in a component without
    any has a null component and is kept. Repeated rows are linked with each other and share what
    they get. An empty table gives an empty result; further columns are ignored.
    """
    return _labelled(documents, width).drop("chosen")


def _labelled(documents: DataFrame, width: int) -> DataFrame:
    """``near_duplicates`` with ``chosen``: whether a row has id and text of the one that stays."""
    with scratch() as keep:
        classes, sets = _classes(documents, width, keep)
        labels = _linked(classes, documents, width)
        of_class = staged(
            _with_component(classes.select("cls", "first_id", "first_key"), labels)
            .select("cls", "first_id", "first_key", "comp"),
            "members",
        )
    first_row = F.min(F.struct(F.col("first_id").isNull(), "first_id", "first_key"))
    least = of_class.groupBy("comp").agg(first_row.alias("first")).select(
        "comp", F.col("first.first_id").alias("component"), F.col("first.first_key").alias("component_key")
    )
    named = of_class.join(least, "comp").select("cls", "component", "component_key")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return sets.join(named, "cls", "left").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        (F.col("doc_id").eqNullSafe(component) & F.coalesce(F.col("text_key") == F.col("component_key"), F.lit(True)))
        .alias("chosen"),
    )


def _classes(documents: DataFrame, width: int, keep: Callable) -> tuple[DataFrame, DataFrame]:
    """(cls, first_id, first_key, n, sketch) of each distinct set, and (doc_id, text_key, n, cls) of each row."""
    with scratch() as once:
        rows = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
        sets = once(_with_sets(rows, False, width), "sketches")
        classes = keep(
            sets.where("n > 0").groupBy("cls").agg(
                F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first"),
                F.first("n").alias("n"), F.first("sketch").alias("sketch"),
            ).select("cls", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"), "n", "sketch"),
            "classes",
        )
        return classes, staged(sets.select("doc_id", "text_key", "n", "cls"), "rows")


def _linked(classes: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """(cls, comp) of the classes that are linked with others."""
    with scratch() as keep:
        listed = keep(prefixes(classes), "prefixes")
        with scratch() as once:
            lists = once(inverted_lists(listed), "lists")
            leaders = once(_leaders(lists), "leaders")
            met = once(_leader_pairs(lists, leaders), "met")
            first = once(_plausible(met, classes), "pairs")
            ends = first.select(F.explode(F.array("a", "b")).alias("cls"))
            edges = keep(_settled(first, _full_sets(ends, classes, documents, width, once), once), "links")
            labels = components(edges)
            members = once(_open_members(lists, leaders, labels), "members")
            members = keep(_with_common_bits(members), "likely")
        if not members.isEmpty():
            members = keep(_with_partner(members, classes, listed), "partners")
        if members.isEmpty():
            return labels
        full = _full_sets(members.select("cls"), classes, documents, width, keep)
        found = keep(_searched(members, full, listed), "found")
        more = [found.where("sure").select("a", "b")]
        unsure = keep(found.where("NOT sure").select("a", "b").distinct(), "unsure")
        if not unsure.isEmpty():
            more.append(_settled(unsure, full, keep))
        return components(reduce(DataFrame.union, [edges, *more]))


def deduplicated(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """The columns of ``documents``, one row of each component: the one with the least doc_id.

    Null ids come last; of different texts with the least id, the one with the least text key stays.
    Of rows repeated with one id and text one stays; rows without words all stay, but for repeated
    ones. Only the ids and text keys of rows that go, or are repeated, meet the documents.
    """
    rows = documents.select(F.struct("*").alias("row"), F.xxhash64("text").alias("key"))
    marked = staged(
        _labelled(documents, width).groupBy("doc_id", "text_key")
        .agg(F.count("*").alias("rows"), F.max("chosen").alias("chosen")).where("rows > 1 OR NOT chosen"),
        "marked",
    )
    same = F.col("row.doc_id").eqNullSafe(marked["doc_id"]) & (F.col("key") == marked["text_key"])
    once = rows.join(marked, same, "left_anti").select("row.*")
    repeated = rows.join(marked.where("chosen"), same).dropDuplicates(["doc_id", "text_key"]).select("row.*")
    return once.union(repeated)
