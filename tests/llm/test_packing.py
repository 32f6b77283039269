"""Packing: every id in one piece, full windows, subset sums against all combinations."""

import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from shoalmark.llm.packing import blocks, fullest, id_encoder, pack
from shoalmark.llm.queries import op11_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)


def check(packed, texts, capacity):
    """All documents come back whole, sequences have no gaps and no padding."""
    whole = {d: WHOLE.encode(t or "", add_special_tokens=False).ids + [0] for d, t in texts.items()}
    found = {d: [] for d in texts}
    for r in sorted(packed, key=lambda r: r["start"]):
        assert r["doc_tokens"] == len(whole[r["doc_id"]])
        assert r["start"] == len(found[r["doc_id"]])
        assert r["length"] == len(r["ids"]) // 4 > 0
        found[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert found == whole
    sequences = {}
    for r in sorted(packed, key=lambda r: r["offset"]):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(n == capacity or n & (n - 1) == 0 and n < capacity for n in sequences.values())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), min_size=1, max_size=6))
def test_fullest_equals_the_best_of_all_combinations(counts):
    taken, longest = fullest(counts, 40), max(counts)
    assert taken[longest] >= 1
    assert all(0 < k <= counts[n] for n, k in taken.items())
    sums = (
        sum(n * k for n, k in zip(counts, ks))
        for ks in product(*(range(c + 1) for c in counts.values()))
        if ks[list(counts).index(longest)]
    )
    assert sum(n * k for n, k in taken.items()) == max(s for s in sums if s <= 40)


@settings(max_examples=60, deadline=None)
@given(st.text("ab .\n\t'9é|<>", max_size=80), st.integers(1, 12))
def test_blocks_are_encoded_as_the_whole_text(text, size):
    assert "".join(blocks(text, size)) == text
    parts = b"".join(id_encoder(PATH)(list(blocks(text, size))))
    assert np.frombuffer(parts, "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_nulls_empty_long_and_repeated(documents):
    texts = {1: None, 2: "", 3: "a " * 40_000, 4: "x" * 9_000, 5: "same text", 6: "same text",
             7: "over <|endoftext|> the end"}
    made = pack(documents([(d, t, "en", "s") for d, t in texts.items()]), PATH, 64)
    check(made.collect(), texts, 64)


def test_rows_without_id_and_repeated_rows(documents):
    rows = [(None, "no id", "en", "s"), (8, "twice", None, None), (8, "twice", None, None)]
    made = pack(documents(rows), PATH).collect()
    assert Counter(r["doc_id"] for r in made if r["start"] == 0) == {None: 1, 8: 2}


def test_one_length_for_all(documents):
    texts = {d: "word word word word word" for d in range(300)}
    check(pack(documents([(d, t, "en", "s") for d, t in texts.items()]), PATH, 16).collect(), texts, 16)


def test_empty_table(documents):
    assert pack(documents([]), PATH).collect() == []


def test_query_packs_all_documents_without_padding(spark):
    folder = "/root/testdata/sf0.001"
    texts = {
        r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()
    }
    made = pack(spark.read.parquet(f"{folder}/documents.parquet"), PATH).collect()
    check(made, texts, 1024)
    digests = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in op11_packing(spark, folder).collect()}
    assert digests == {(r["doc_id"], r["start"]): zlib.crc32(r["ids"]) for r in made}
    cut = sum(r["length"] < min(r["doc_tokens"], 1024) for r in made)
    assert cut < len(texts) * 1.2


@pytest.mark.parametrize("capacity", [1, 7, 1024])
def test_capacities(documents, capacity):
    texts = {d: "some words " * (d % 13) for d in range(80)}
    packed = pack(documents([(d, t, "en", "s") for d, t in texts.items()]), PATH, capacity).collect()
    check(packed, texts, capacity)
