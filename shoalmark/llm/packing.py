"""Packing of token ids into windows by minimum bin slack.

A document longer than a window gives whole windows and a remainder. Remainders wait on a shelf, by
their length. A window begins with the longest remainder; a bitset subset-sum over the multiset of the
other lengths finds the fullest completion, and going back through the bitsets gives how many pieces
of each length it takes. The same completion is repeated as often as the shelf allows. What is then
still missing is cut off one further piece, so that every window of a task is full; the last tokens
of a task go to sequences whose lengths are powers of two, which need no padding.

Each task packs what it reads, with a shelf of bounded size: nothing is shuffled or collected.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack as pack_numbers

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import byte_slices, map_batches
from .tokens import _SAFE, pieces

#: Ids on the shelf when packing begins, and when it stops to let the shelf fill up again.
FULL_SHELF, LOW_SHELF = 1 << 22, 1 << 20
#: Characters of a text encoded at once, pieces remembered by a worker, rows of an output batch.
_BLOCK, _PIECES, _ROWS = 1 << 18, 1_000_000, 4096
#: Sequences of a task are numbered from its number times this.
_SEQUENCES = 1 << 33
_ID = np.dtype("<u4")
_WHITE = re.compile(r"\s")


@lru_cache(maxsize=2)
def id_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids as little-endian 32-bit numbers, one for each worker.

    Several texts are encoded together, one alone in blocks. New words go through the library as the
    lines of one text, where each begins a pre-token after the line break; should the ids not show the
    line breaks one by one, the words are encoded singly.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(path)
    encoder.no_truncation()
    encoder.no_padding()
    known: dict[str, bytes] = {}

    def ids(parts: list[str]) -> list[bytes]:
        made = encoder.encode_batch_fast(parts, add_special_tokens=False)
        return [pack_numbers(f"<{len(e)}I", *e.ids) for e in made]

    line_break = ids(["\n"])[0]

    def word_ids(words: list[str]) -> list[bytes]:
        raw = ids([" " + "\n ".join(words)])[0]
        numbers = np.frombuffer(raw, _ID)
        breaks = np.flatnonzero(numbers == np.frombuffer(line_break, _ID)[0]) * _ID.itemsize
        if len(line_break) != _ID.itemsize or len(breaks) != len(words) - 1:
            return ids([" " + w for w in words])
        ends = breaks.tolist()
        starts = [0, *(e + _ID.itemsize for e in ends)]
        return [raw[start:end] for start, end in zip(starts, [*ends, len(raw)])]

    def together(texts: list[str]) -> list[bytes]:
        firsts, rests = zip(*map(pieces, texts))
        used = set().union(*rests)
        new = used.difference(known)
        if len(known) + len(new) > _PIECES:
            known.clear()
            new = used
        words = [p for p in new if p and not _WHITE.search(p)]
        others = list(new.difference(words))
        if words:
            known.update(zip(words, word_ids(words)))
        known.update(zip(others, ids([p if p[:1] == "\n" else " " + p for p in others])))
        begun = ids(list(firsts))
        return [b + b"".join(map(known.__getitem__, rest)) for b, rest in zip(begun, rests)]

    def encode(texts: list[str]) -> list[bytes]:
        if len(texts) != 1:
            return together(texts) if texts else []
        return [b"".join(together([block])[0] for block in blocks(texts[0]))]

    return encode


def blocks(text: str, size: int = _BLOCK) -> Iterator[str]:
    """Consecutive parts of about ``size`` characters, cut where a new pre-token begins in any case."""
    start = 0
    while len(text) - start > size:
        safe = _SAFE.search(text, start + size)
        if not safe:
            break
        yield text[start : safe.start()]
        start = safe.start()
    yield text[start:]


def fullest(counts: dict[int, int], capacity: int) -> Counter:
    """How many pieces of each length fill a window best, the longest piece being one of them.

    ``counts`` has the number of pieces of each length. Bit s of ``reach`` says that lengths taken so
    far can add up to s. Lengths are tried from the longest on; a full window ends the search.
    """
    longest = max(counts)
    target = capacity - longest
    within, reach = (1 << (target + 1)) - 1, 1
    steps: list[tuple[int, int]] = []
    for length in sorted((n for n in counts if n <= target), reverse=True):
        there = counts[length] - (length == longest)
        for _ in range(min(there, target // length)):
            steps.append((length, reach))
            reach |= (reach << length) & within
        if reach >> target:
            break
    total = reach.bit_length() - 1
    taken = Counter({longest: 1})
    for length, before in reversed(steps):
        if not before >> total & 1:
            taken[length] += 1
            total -= length
    return taken


class Shelf:
    """Remainders that wait for a window; hands full windows to ``put``."""

    def __init__(self, capacity: int, put: Callable[[list[tuple]], None]) -> None:
        self.capacity, self.put = capacity, put
        self.waiting: dict[int, list[tuple]] = {}
        self.ids = 0

    def add(self, piece: tuple) -> None:
        """``piece`` is (document, place of its first id in it, its ids)."""
        size = len(piece[2]) // _ID.itemsize
        self.waiting.setdefault(size, []).append(piece)
        self.ids += size

    def take(self, size: int) -> tuple:
        stack = self.waiting[size]
        piece = stack.pop()
        if not stack:
            del self.waiting[size]
        self.ids -= size
        return piece

    def fill(self, left: int) -> None:
        """Put full windows until fewer than ``left`` ids, or too few for a window, wait."""
        while self.ids >= max(left, self.capacity):
            counts = {n: len(p) for n, p in self.waiting.items()}
            taken = fullest(counts, self.capacity)
            slack = self.capacity - sum(n * k for n, k in taken.items())
            times = 1 if slack else min(counts[n] // k for n, k in taken.items())
            for _ in range(times):
                window = [self.take(n) for n, k in taken.items() for _ in range(k)]
                if slack:
                    # All others are longer than the slack, or the subset-sum would have taken them.
                    document, start, ids = self.take(max(self.waiting))
                    cut = slack * _ID.itemsize
                    window.append((document, start, ids[:cut]))
                    self.add((document, start + slack, ids[cut:]))
                self.put(window)

    def empty(self) -> None:
        """Put the last ids into sequences whose lengths are the powers of two of their number."""
        self.fill(0)
        rest = [p for n in sorted(self.waiting, reverse=True) for p in self.waiting[n]]
        for bit in reversed(range(self.ids.bit_length())):
            room, sequence = (self.ids >> bit & 1) << bit, []
            while room:
                document, start, ids = rest.pop(0)
                size = min(room, len(ids) // _ID.itemsize)
                sequence.append((document, start, ids[: size * _ID.itemsize]))
                if size * _ID.itemsize < len(ids):
                    rest.insert(0, (document, start + size, ids[size * _ID.itemsize :]))
                room -= size
            if sequence:
                self.put(sequence)
        self.waiting, self.ids = {}, 0


def pack(documents: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) of every piece of every document.

    A document's ids are those of the tokenizers file at ``tokenizer`` (a byte-level BPE, on every
    executor) without added special tokens, and then ``end_id``. ``start`` counts the ids of the
    document before the piece, ``ids`` holds little-endian unsigned 32-bit numbers, ``doc_tokens`` is
    the length of the document. Each id lies in exactly one piece. The pieces of a sequence follow each
    other from ``offset`` 0 without gaps and hold ``capacity`` ids, or a power of two at the end of a
    task. Which documents share a sequence depends on how the table is dealt out to tasks.

    Null and empty texts are documents of ``end_id`` alone; a null id stays null. A text of any length
    is packed whole, its ids are held by the task that reads it. Repeated rows are packed as often as
    they come; equal lengths are taken last come first; an empty table gives an empty result; further
    columns are ignored.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], _ID).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = id_encoder(tokenizer)
        out: list[tuple] = []
        sequence = TaskContext.get().partitionId() * _SEQUENCES
        key_type = pa.int64()

        def put(window: list[tuple]) -> None:
            nonlocal sequence
            offset = 0
            for (doc_id, doc_tokens), start, ids in window:
                size = len(ids) // _ID.itemsize
                out.append((doc_id, start, size, ids, doc_tokens, sequence, offset))
                offset += size
            sequence += 1

        def ready(least: int) -> Iterator[pa.RecordBatch]:
            while len(out) >= least and out:
                columns = list(zip(*out[:_ROWS]))
                del out[:_ROWS]
                kinds = [key_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=NAMES
                )

        shelf = Shelf(capacity, put)
        whole = capacity * _ID.itemsize
        for batch in batches:
            key_type = batch.schema.field("doc_id").type
            for part in byte_slices(batch, 1 << 20):
                doc_ids, texts = (part.column(c).to_pylist() for c in ("doc_id", "text"))
                for doc_id, ids in zip(doc_ids, encode(texts)):
                    ids += end
                    document = (doc_id, len(ids) // _ID.itemsize)
                    upto = len(ids) // whole * whole
                    for at in range(0, upto, whole):
                        put([(document, at // _ID.itemsize, ids[at : at + whole])])
                        yield from ready(_ROWS)
                    if upto < len(ids):
                        shelf.add((document, upto // _ID.itemsize, ids[upto:]))
                if shelf.ids >= FULL_SHELF:
                    shelf.fill(LOW_SHELF)
                yield from ready(_ROWS)
        shelf.empty()
        yield from ready(0)

    return map_batches(
        rows,
        run,
        f"doc_id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )


NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
