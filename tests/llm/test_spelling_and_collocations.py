"""Spelling variants and collocations against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from shoalmark.llm import collocations as C, spelling as S

WORD = st.text("abnoé", min_size=1, max_size=6)


def is_near(a, b):
    inserted = {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in set(b)}
    deleted = {a[:i] + a[i + 1 :] for i in range(len(a))}
    replaced = {a[:i] + c + a[i + 1 :] for i in range(len(a)) for c in set(b)}
    return a != b and b in inserted | deleted | replaced


@settings(max_examples=300, deadline=None)
@given(WORD, WORD)
def test_near_and_the_trie(a, b):
    assert S.near(a, b) == is_near(a, b)
    root = S._Node([(S.vector(a), [(a, 1)])], 0)
    if is_near(a, b):
        assert list(S.search(root, S.vector(b)))


def brute_variants(counts):
    found = {}
    for word, n in counts.items():
        others = [o for o in counts if is_near(word, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form = best if best and counts[best] >= 10 * n else None
        found[word] = (form, n, len(others), counts[form] if form else None)
    rows = {}
    for word, (form, n, n_near, form_n) in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        rows[word] = (form, root, n, n_near, form_n)
    return rows


def as_rows(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.mark.parametrize("subtree", [1, 3, 1000])
def test_variants_in_subtrees_of_all_sizes(spark, subtree):
    """One word a subtree deals words of equal counts into blocks."""
    words = ["banana", "banane", "bananas", "banan", "nabana", "anbana", "canana", "banaana", "bnana",
             "é" * 6, "é" * 7, "z" * 300, "z" * 301, "abanan", "aabnan"]
    counts = {w: 10 ** (i % 4) + i for i, w in enumerate(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert as_rows(S.variants(table, subtree=subtree)) == brute_variants(counts)


def test_chains_reach_their_end(spark):
    counts = {"a" * k: 10**k for k in range(1, 17)}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    rows = as_rows(S.variants(table, subtree=4))
    assert {r[1] for r in rows.values()} == {"a" * 16}


def test_spelling_of_odd_documents(documents, spark):
    text = "Elephant elephant, ELEPHANT elephants 'tis elephant-Éléphant éléphant x"
    rows = [(d, text, "en", "s") for d in range(90)]
    rows += [(7, text, None, None), (None, "nothing nothing", None, None), (900, None, "en", "s"),
             (901, "", "en", "s"), (902, "elephant " * 50_000, "en", "s")]
    counts = Counter()
    for doc_id, t, _, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            mark = zlib.crc32(f"{doc_id}:{run}".encode())
            at = mark % len(run)
            counts[run if mark % 31 else run[:at] + run[at + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert as_rows(S.spelling_variants(documents(rows))) == brute_variants(counts)
    assert S.spelling_variants(documents([])).collect() == []


def test_counts_agree_between_spark_and_python(spark):
    words = ["elephant", "éàÿ÷", "zzz"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    made = {r["word"]: r["v"] for r in table.select("word", S.group_counts().alias("v")).collect()}
    assert made == {w: [len(w), *S.vector(w)] for w in words}


def brute_collocations(rows, most, fewest, longest):
    f = defaultdict(Counter)
    for _, text, lang, _ in rows:
        data = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", data):
            words = re.findall("[^ \t]+", piece)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang or "und"][tuple(words[i : i + m])] += 1
    found = []
    for lang, counts in f.items():
        n = sum(k for p, k in counts.items() if len(p) == 1)
        common = {p: k for p, k in counts.items() if len(p) > 1 and k >= fewest}
        inside = {
            p[i:j] for p, k in common.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and counts[p[i:j]] <= k
        }
        scored = []
        for p, a in common.items():
            if p not in inside:
                cuts = [(counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
                score, _, l, r = min(
                    (1000 * a * n // (l * r), k, l, r) for k, (l, r) in enumerate(cuts)
                )
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(found)


def as_list(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("most", [1, 5, 10_000])
def test_collocations_equal_brute_force(documents, most):
    words = ["new", "york", "The", "of", "city", "é", "rare", "old"]
    rows = [
        (d, " ".join(words[(d * d * j + j * j + d // 3) % 8] + ".,\n\t |"[(d + j) % 11 :][:1]
                     for j in range(40)), ("en", "fr", None)[d % 3], "s")
        for d in range(60)
    ]
    rows += [(1, None, "en", "s"), (1, "", None, None), (1, "new york city " * 400, "en", "s")]
    rows += [(70 + d, "deep in the old forest lies a house", "fr", "s") for d in range(12)]
    made = C.collocations(documents(rows), most, 10)
    assert as_list(made) == brute_collocations(rows, most, 10, 5)


def test_words_of_clashing_hashes_are_expanded_once(documents):
    """Two words of one place in the bitmaps, which belong to different tiers."""
    rare, common = "w19615", "w32016"
    places = C.Words(f"{rare} {common}".encode(), "en").hashes % np.uint64(C.BITS)
    assert places[0] == places[1]
    rows = [(d, f"{common} of them. {common} here. {common} of all", "en", "s") for d in range(20)]
    rows += [(100 + d, f"{rare} thing", "en", "s") for d in range(6)]
    made = C.collocations(documents(rows), 10_000, 5)
    assert as_list(made) == brute_collocations(rows, 10_000, 5, 5)


def test_collocations_of_an_empty_table(documents):
    assert C.collocations(documents([])).collect() == []


def test_exact_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**13 + 1, 10**15 + 3, 10**13 + 7, 10**13 + 9)], "a long, n long, l long, r long")
    score = row.select(C._ratio("1000 a n", "l r")).first()[0]
    assert score == 1000 * (10**13 + 1) * (10**15 + 3) // ((10**13 + 7) * (10**13 + 9))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab .\t,", max_size=30), min_size=1, max_size=4), st.integers(4, 20))
def test_slices_hold_every_word_once(texts, size):
    """Each word belongs to one slice, with the word before it and the words after it in view."""
    texts = [t.encode() for t in texts]
    whole = [p.split() for p in b".".join(texts).translate(C._PIECES).split(b".")]
    expected = [(p[i - 1] if i else b"", p[i : i + 3]) for p in whole for i in range(len(p))]
    found, before = [], C._SLICE
    C._SLICE = size
    try:
        for data, begin, end in C.slices(texts, 3):
            words = C.Words(data, "en")
            for i, start in enumerate(words.starts):
                if begin <= start < end:
                    j = i
                    while j + 1 < len(words.starts) and words.joined[j + 1] and j + 1 < i + 3:
                        j += 1
                    last = words.phrase(i - 1, i - 1) if words.joined[i] else b""
                    found.append((last, words.phrase(i, j).split()))
    finally:
        C._SLICE = before
    assert found == expected
