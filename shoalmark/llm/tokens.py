"""Token counts: texts encoded in batches inside Arrow functions that return lengths only.

Texts are cut before single spaces and line breaks between two visible characters. A pre-token of a
byte-level BPE takes at most one leading space and otherwise never mixes white space with visible
characters, so such a place always begins a new pre-token, and the counts of the pieces add up to
the count of the text. A piece that comes again is not encoded again. A text without such a place is
encoded whole.
"""

from __future__ import annotations

import os
import re
from collections import ChainMap
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_texts

#: Before a space with a visible character on each side. Only characters that no library counts as
#: white space are named, so other spaces are never cut at.
_SAFE = re.compile(r"(?<=[!-~\w])(?= [!-~\w])")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_NEXT_TO_SPACE = ("  ", " \n", "\n ", "\n\n")
#: Bounds of the memory for pieces seen before, and of the length of pieces held there.
_PIECES, _LONGEST = 1_000_000, 64


def pieces(text: str) -> tuple[str, list[str]]:
    """The first piece and the others; one that does not begin with a line break lacks its space."""
    plain = not (
        any(s in text for s in _NEXT_TO_SPACE)
        or text[:1] in (" ", "\n")
        or text[-1:] in (" ", "\n")
        or _OTHER_SPACE.search(text)
    )
    if plain:
        first, *rest = text.replace("\n", " \n").split(" ")
        return first, rest
    first, *rest = _SAFE.split(text)
    return first, [r[1:] for r in rest]


@lru_cache(maxsize=2)
def counter(path: str):
    """A function from texts to token counts that remembers short pieces, one for each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(path)
    encoder.no_truncation()
    encoder.no_padding()
    known: dict[str, int] = {}

    def lengths(parts: list[str]) -> list[int]:
        return list(map(len, encoder.encode_batch_fast(parts, add_special_tokens=False)))

    def count(texts: list[str]) -> list[list[int]]:
        if len(known) > _PIECES:
            known.clear()
        firsts, rests = zip(*map(pieces, texts))
        new = list(set().union(*rests).difference(known))
        sizes = dict(zip(new, lengths([p if p[:1] == "\n" else " " + p for p in new])))
        known.update((p, n) for p, n in sizes.items() if len(p) <= _LONGEST)
        size = ChainMap(known, sizes) if any(len(p) > _LONGEST for p in new) else known
        return [
            [n + sum(map(size.__getitem__, rest)) for n, rest in zip(lengths(list(firsts)), rests)]
        ]

    return count


def count_tokens(
    documents: DataFrame, tokenizer: str, limit: int = 512, slice_bytes: int = 1 << 20
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``documents``.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library on every executor.
    Begin, end and other added tokens are not counted; strings of special tokens inside a text are
    taken as the library takes them by default. Nothing is truncated.

    Null and empty texts have 0 bytes and 0 tokens. Texts of any length are counted whole; repeated
    rows give repeated results; an empty table gives an empty result; further columns are ignored.
    """
    rows = documents.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "text",
    )
    counted = map_texts(
        rows, lambda: counter(tokenizer), [("n_tokens", pa.int64(), "bigint")], slice_bytes
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
