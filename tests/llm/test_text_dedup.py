"""Near-duplicates, line dedup and decontamination against brute force."""

import hashlib
import itertools
import math
import random
import re
import time

import pytest

import corpus_pipeline
from shoalmark.llm import decontaminate, linededup, neardup
from shoalmark.llm.words import ALPHANUMERIC, NOT_SPACE, word_hashes

LOWER = {i: i + 32 for i in range(65, 91)}
SPACED, PLAIN = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDGES = [
    (900, None, None, None), (901, "", "en", None), (902, " \n\t", "en", "s1"), (903, "One", "en", "s1"),
    (904, "one", "en", "s2"), (905, "one one", "en", "s2"), (None, "no id at all", "en", "s1"),
    (None, "no id at all", "en", "s1"), (906, "same row twice", "en", "s1"), (906, "same row twice", "en", "s1"),
]


def split(pattern, text):
    return pattern.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("table, pattern", [(NOT_SPACE, SPACED), (ALPHANUMERIC, PLAIN)])
def test_word_hashes_equal_words(table, pattern):
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab Zz9.\n\té中\x1c-", k=rng.randint(0, 30))) for _ in range(300)]
    texts += ["x" * 2_500_000, "the quick brown fox " * 90_000, ""]
    words = [split(pattern, t) for t in texts]
    hashes, counts = word_hashes(texts, table)
    assert counts.tolist() == [len(w) for w in words]
    seen = {}
    for w, h in zip((w for ws in words for w in ws), hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def thue_morse(letters, turned):
    """The word of that many letters a and b, or the one with all letters turned."""
    return "".join("ab"[bin(i).count("1") % 2 ^ turned] for i in range(letters))


@pytest.mark.parametrize("letters", [1024, 2048, 4096])
def test_words_that_clash_under_polynomials_are_told_apart(spark, documents, letters):
    """Polynomials modulo 2**64 take these two words for one, whatever their base."""
    a, b = (thue_morse(letters, turned) for turned in (0, 1))
    hashes, _ = word_hashes([a, b], NOT_SPACE)
    assert hashes[0] != hashes[1]
    docs = documents([(1, a, "en", "s"), (2, b, "en", "s"), (3, a, "en", "s")])
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    bench = spark.createDataFrame([(7, b)], "item_id bigint, text string")
    hit = decontaminate.contamination(docs, bench).where("contaminated").select("row.doc_id").collect()
    assert [r[0] for r in hit] == [2]


def near_groups(rows):
    sets, parent = [], list(range(len(rows)))
    for _, text, *_ in rows:
        w = split(SPACED, text)
        sets.append(frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), doc) if x is not None]
        least[find(i)] = min(ids, default=None)
    return sorted(
        ((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, *_) in enumerate(rows)), key=str
    )


def edited(rng, words, share):
    return " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 999)) if rng.random() < share else w for w in words)


@pytest.mark.parametrize("block", [neardup.BLOCK, 4])
def test_near_duplicates_equal_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng, rows = random.Random(block), []
    for group in range(14):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([5, 12, 40, 90, 150, 400]))]
        for _ in range(rng.choice([1, 2, 9])):
            rows.append((len(rows), edited(rng, words, rng.choice([0, 0.02, 0.05, 0.08])), "en", "s"))
    shared = " ".join(f"p{i}" for i in range(60))
    rows += [(len(rows) + i, shared + " " + " ".join(f"q{i}x{j}" for j in range(i)), "en", "s") for i in range(40)]
    rows += EDGES
    docs = documents(rows)
    got = neardup.near_duplicates(docs).drop("text_key").collect()
    assert sorted((tuple(r) for r in got), key=str) == near_groups(rows)
    kept = neardup.deduplicated(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted({d for d, _, _, keep in near_groups(rows) if keep}, key=str)


@pytest.mark.parametrize("doc", [None, 5])
def test_full_sets_meet_only_the_rows_of_their_text(documents, monkeypatch, doc):
    base = [[f"w{g}x{i}" for i in range(30)] for g in range(12)]
    rows = [(doc, " ".join([*words, f"end{k}"]), "en", "s") for words in base for k in range(2)]
    read, with_sets = [], neardup._with_sets

    def counted(df, full, *more):
        if full:
            read.append(df.count())
        return with_sets(df, full, *more)

    monkeypatch.setattr(neardup, "_with_sets", counted)
    got = neardup.near_duplicates(documents(rows)).drop("text_key").collect()
    assert sorted((tuple(r) for r in got), key=str) == near_groups(rows)
    assert read and max(read) <= len(rows)


def test_values_count_only_among_fitting_sizes(spark):
    """A class of 10 shingles that shares all of them with one of 100 cannot be linked with it."""
    of = lambda key, n, values: (bytes([key]), n, [64 * v for v in values])
    schema = "cls binary, n bigint, sketch array<bigint>"
    apart = [of(1, 10, range(10)), of(2, 100, range(64))]
    assert neardup.prefixes(spark.createDataFrame(apart, schema)).count() == 0
    near = [of(3, 10, range(200, 210)), of(4, 11, [*range(200, 210), 301])]
    listed = neardup.prefixes(spark.createDataFrame(apart + near, schema))
    assert sorted(bytes(r["cls"])[0] for r in listed.collect()) == [3, 4]
    met = {(r["value"], r["band"]) for r in neardup.inverted_lists(listed).collect()}
    bands = {r[0] for r in spark.createDataFrame(near, schema).select(neardup._band("n")).collect()}
    assert met and {band for _, band in met} <= bands


def test_lists_that_the_leaders_settle_are_not_opened(spark):
    row = lambda value, key, native: (value, 9, bytes([key]), 10, native, 1, 0, 0, 0, 0)
    rows = [row(1, k, k < 2) for k in range(4)] + [row(2, k, k > 7) for k in range(7, 9)] + [row(3, k, True) for k in range(10, 16)]
    columns = "value bigint, band int, cls binary, n bigint, native boolean, bits0 bigint, bits1 bigint, bits2 bigint, bits3 bigint, spare int"
    lists = spark.createDataFrame(rows, columns)
    labels = spark.createDataFrame([], "cls binary, comp binary")
    members = neardup._open_members(lists, neardup._leaders(lists), labels).collect()
    assert sorted((r["value"], bytes(r["cls"])[0], r["i"], r["j"]) for r in members) == [(3, k, 0, 0) for k in range(10, 16)]


def test_members_without_common_bits_meet_no_sketches(spark):
    row = lambda key, bits: (3, 9, 0, 0, bytes([key]), 10, bytes([key]), True, 0, bits, 0, 0, 0, 0)
    names = ["value bigint, band int, i int, j int, cls binary, n bigint, comp binary, native boolean, mine int"]
    schema = ", ".join(names + [f"bits{i} bigint" for i in range(4)] + ["spare int"])
    rows = [row(1, 0b1111111100), row(2, 0b1111111111), row(3, 0b0000000111), row(4, -(1 << 63) | 1)]
    members = neardup._with_common_bits(spark.createDataFrame(rows, schema))
    assert sorted(bytes(r["cls"])[0] for r in members.collect()) == [1, 2] and "spare" not in members.columns


def five_word_groups(rows):
    sets = []
    for _, text, *_ in rows:
        w = split(SPACED, text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and 100 * len(x & y) >= 80 * len(x | y) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    ids = {g: [d for (d, *_), h in zip(rows, group) if h == g and d is not None] for g in group}
    least = [min(ids[g], default=None) for g in group]
    return sorted(((d, len(x), m, d == m) for (d, *_), x, m in zip(rows, sets, least)), key=str)


def test_five_word_shingles_equal_brute_force(documents):
    rng, rows = random.Random(55), []
    for length in (3, 4, 5, 6, 30, 120):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(length)]
        rows += [(len(rows) + k, edited(rng, words, (0, 0.01, 0.03)[k % 3]), "en", "s") for k in range(8)]
    swapped = [f"v{i}" for i in range(60)]
    rows += [(100, " ".join(swapped), "en", "s"), (101, " ".join([*swapped[:30], "new", "words", *swapped[32:]]), "en", "s")]
    rows += [(102, "a b c d", "en", "s"), (103, "A b c  d", "en", "s"), (104, "d c b a", "en", "s"), *EDGES]
    got = neardup.near_duplicates(documents(rows), 5).drop("text_key").collect()
    assert sorted((tuple(r) for r in got), key=str) == five_word_groups(rows) != near_groups(rows)


def test_the_stage_takes_five_words(spark, documents):
    words = [f"v{i}" for i in range(40)]
    rows = [(1, " ".join(words), "en", "s"), (2, " ".join([*words[:20], "new", *words[21:]]), "en", "s")]
    assert len({comp for _, _, comp, _ in near_groups(rows)}) == 1
    assert len({comp for _, _, comp, _ in five_word_groups(rows)}) == 2
    assert corpus_pipeline.drop_copies(spark, documents(rows), "").count() == 2


def test_one_row_of_each_component_stays(documents):
    text = lambda name, k: " ".join([*(f"{name}{i}" for i in range(30)), f"end{k}"])
    rows = [(None, text("null", k), "en", "s") for k in range(3)]
    rows += [(8, text("same", k), "en", "s") for k in range(3)] + [(8, text("same", 1), "en", "s")]
    rows += [(k, text("mixed", k or 0), "en", "s") for k in (None, 4, 3)]
    rows += [(None, "", "en", "s"), (None, " ", "en", "s"), (9, None, "en", "s"), (9, "", "en", "s"), (9, "", "en", "s")]
    got = [(r["doc_id"], r["text"]) for r in neardup.deduplicated(documents(rows)).collect()]
    groups = sorted((str(d), t.split()[0]) for d, t in got if (t or "").strip())
    assert groups == [("3", "mixed0"), ("8", "same0"), ("None", "null0")]
    assert {(d, t) for d, t, *_ in rows} >= set(got)
    bare = [(d, t) for d, t in got if not (t or "").strip()]
    assert sorted(bare, key=str) == sorted([(None, ""), (None, " "), (9, None), (9, "")], key=str)


def test_stated_loss_is_that_of_the_parameters():
    missed = lambda kept, least: sum(math.comb(kept, i) * 0.8**i * 0.2 ** (kept - i) for i in range(least))
    assert neardup.LOSSLESS == 80 and "(80) shingles" in neardup.__doc__
    for kept, least, stated in [
        (neardup.LISTED, neardup.LISTED_FEWEST, "2.6e-8"), (neardup.SKETCH, neardup.FEWEST, "1.9e-8"),
    ]:
        assert f"{missed(kept, least):.1e}".replace("e-0", "e-") == stated and stated in neardup.__doc__
    assert missed(neardup.WIDE, neardup.WIDE_FEWEST) < 1e-11


def test_no_documents(documents):
    docs, one = documents([]), documents(EDGES[:1])
    assert neardup.near_duplicates(docs).count() == 0
    assert neardup.deduplicated(one).count() == 1
    assert linededup.remove_boilerplate(docs).count() == 0
    assert linededup.cleaned_documents(one).count() == 1


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame(
        [(bytes([i // 100, i % 100]), bytes([(i + 1) // 100, (i + 1) % 100])) for i in range(300)], "a binary, b binary"
    )
    labels = neardup.components(edges).collect()
    assert len(labels) == 301 and {bytes(r["comp"]) for r in labels} == {bytes([0, 0])}


@pytest.mark.parametrize("order", ["hashed", "rising"])
def test_chain_of_thousands_is_one_component(spark, order):
    keys = [hashlib.md5(str(i).encode()).digest() if order == "hashed" else i.to_bytes(4) for i in range(4000)]
    parts = [keys[:3000], keys[3000:]]
    edges = [(min(p), max(p)) for part in parts for p in zip(part, part[1:])]
    labels = neardup.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    want = {key: min(part) for part in parts for key in part}
    assert len(labels) == 4000 and {bytes(r["cls"]): bytes(r["comp"]) for r in labels} == want


def test_components_of_random_links(spark):
    rng = random.Random(3)
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(600)]
    edges = [tuple(sorted(rng.sample(keys, 2))) for _ in range(320)]
    least = {k: k for pair in edges for k in pair}
    while any(least[a] != least[b] for a, b in edges):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    labels = neardup.components(spark.createDataFrame(edges + edges[:5], "a binary, b binary")).collect()
    assert sorted((bytes(r["cls"]), bytes(r["comp"])) for r in labels) == sorted(least.items())


def cleaned(rows, least, keep_first):
    sites, places = {}, {}
    for doc, text, _, site in rows:
        for i, line in enumerate((text or "").split("\n")):
            t = line.strip(" \t\r")
            if t and text is not None:
                sites.setdefault(t, set()).update({site} - {None})
                places.setdefault(t, []).append((doc is not None, doc or 0, i))
    found = []
    for doc, text, _, site in rows:
        if text is None:
            found.append((doc, None, 0, 0))
            continue
        lines, kept = text.split("\n"), []
        for i, line in enumerate(lines):
            t = line.strip(" \t\r")
            first = keep_first and t and min(places[t]) == (doc is not None, doc or 0, i)
            if not t or len(sites[t]) < least or first:
                kept.append(line)
        gone = len(lines) - len(kept)
        found.append((doc, "\n".join(kept) if gone else text, len(lines), gone))
    return sorted(found, key=str)


@pytest.mark.parametrize("keep_first", [True, False])
def test_line_dedup_equals_brute_force(documents, keep_first):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        lines = [rng.choice(["Cookie notice", " Cookie notice\t", "Menu", "", "rare", f"own {i}", f"x{rng.randint(0, 30)}"])
                 for _ in range(rng.randint(1, 6))]
        rows.append((i, "\n".join(lines), "en", f"s{rng.randint(0, 5)}"))
    rows += EDGES
    made = linededup.remove_boilerplate(documents(rows), min_sites=4, keep_first=keep_first)
    got = sorted(((r[0], r[1], r[2], r[3]) for r in made.select("row.doc_id", "text", "n_lines", "n_removed").collect()), key=str)
    assert got == cleaned(rows, 4, keep_first)


def contaminated(rows, items, width=10):
    windows = {}
    for item, text in items:
        w = split(PLAIN, text)
        k = min(width, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[p : p + k]), set()).add("" if item is None else str(item))
    found = []
    for doc, text, *_ in rows:
        w, hit, met = split(PLAIN, text), set(), set()
        for p in range(len(w)):
            for k in range(1, width + 1):
                names = windows.get(tuple(w[p : p + k])) if p + k <= len(w) else None
                if names:
                    met |= names
                    hit.update(range(p, p + k))
        sha = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        found.append((doc, len(w), len(hit), len(met), sha, bool(hit)))
    return sorted(found, key=str)


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WORDS, 30])
def test_decontamination_equals_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rng = random.Random(6)
    word = lambda: rng.choice(["a", "B", "c", "é", "d1", "x"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 3, 5, 10, 14, 25])))) for i in range(12)]
    items += [(None, None), (None, "c c c c"), (3, "z y x"), (50, "alone"), (50, "alone")]
    rows = [(i, rng.choice([" ", "-", "\n"]).join(word() for _ in range(rng.randint(0, 60))), "en", "s") for i in range(60)]
    rows += [(100 + i, f"so {t or ''} it is alone", "en", "s") for i, (_, t) in enumerate(items)] + EDGES
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(rows)
    made = decontaminate.contamination(docs, bench)
    got = made.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted((tuple(r) for r in got), key=str) == contaminated(rows, items)
    kept = decontaminate.clean_documents(docs, bench)
    assert kept.columns == docs.columns and kept.count() == made.where("NOT contaminated").count()


def test_longest_match_and_its_place(spark, documents):
    item = " ".join(f"t{i}" for i in range(20))
    bench = spark.createDataFrame([(7, item), (8, item + " x")], "item_id bigint, text string")
    docs = documents([(1, "before " + " ".join(f"t{i}" for i in range(3, 18)) + " after", "en", "s")])
    found = decontaminate.find_matches(docs, bench).first()
    assert [tuple(s) for s in found["spans"]] in ([(1, 15, "7", 3)], [(1, 15, "8", 3)])
    assert found["items"] == ["7", "8"]


def longest_matches(text, items, window):
    """Words hit, items met, and the longest match from each word, by comparing everything."""
    w, hit, met, longest = split(PLAIN, text), set(), set(), {}
    for name, item in items:
        x = split(PLAIN, item)
        k = min(window, len(x))
        for s, p in itertools.product(range(len(x) - k + 1 if x else 0), range(len(w) - k + 1)):
            if w[p : p + k] == x[s : s + k]:
                n = k
                while len(x) >= window and p + n < len(w) and s + n < len(x) and w[p + n] == x[s + n]:
                    n += 1
                hit.update(range(p, p + k))
                met.add(name)
                longest[p] = max(longest.get(p, 0), n)
    return hit, met, longest


@pytest.mark.parametrize("seed", range(60))
def test_matches_equal_brute_force(seed):
    rng = random.Random(seed)
    window, letters = rng.choice([1, 2, 3, 4]), rng.choice(["a", "ab", "abc"])
    words = lambda most: " ".join(rng.choice(letters) for _ in range(rng.randint(0, most)))
    texts = [words(25) for _ in range(5)]
    items = sorted({(str(rng.randint(0, 5)), words(12)) for _ in range(5)})
    rows = decontaminate._searcher(Value(decontaminate.TestBlock.of(items, window)), window)()(texts)
    names = dict(items)
    for text, row in zip(texts, rows):
        hit, met, longest = longest_matches(text, items, window)
        spans = [(s["start"], s["longest"]) for s in row["spans"]]
        assert {p for start, n in spans for p in range(start, start + n)} == hit
        assert set(row["items"]) == met and all(longest[start] == n for start, n in spans)
        assert max((n for _, n in spans), default=0) == max(longest.values(), default=0)
        assert all(s["item"] in names for s in row["spans"])


class Value:
    """Stands for a broadcast."""

    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize(
    "text, items, spans",
    [
        (" ".join(map(str, range(200_000))), [("1", " ".join(map(str, range(200_000))))], 1),
        ("a " * 3_000, [("1", "a " * 1_000)], 2_001),
        ("the " * 10_000, [(str(i), "the") for i in range(10_000)], 10_000),
        ("the " * 10_000, [(str(i), "the" + " " * i) for i in range(1_000)], 10_000),
    ],
)
def test_long_and_repetitive_matches_take_seconds(text, items, spans):
    started = time.monotonic()
    block = decontaminate.TestBlock.of(items, 10)
    (row,) = decontaminate._searcher(Value(block), 10)()([text])
    assert (len(row["spans"]), len(row["items"])) == (spans, len(items))
    assert time.monotonic() - started < 30


def test_no_items_or_documents(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contamination(documents(EDGES), none).where("contaminated").count() == 0
    some = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontaminate.contamination(documents([]), some).count() == 0
