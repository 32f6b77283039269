"""Quality, toxicity, language and token counts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalmark.llm import common, langid, quality, tokens, toxicity

FOLDER = "/root/testdata/sf0.01"
EDGES = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (None, "some words here", "en", "a"),
    (4, "12345 !!! ???", None, "b"),
    (5, "word " * 200_000, "en", "c"),
    (6, "the same row", "en", "c"),
    (6, "the same row", "en", "c"),
]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(
        f"{FOLDER}/labels.parquet"
    )


def held_out_accuracy(scored, labels, label):
    met = scored.where("held_out").join(labels, "doc_id").where(F.col(label).isNotNull())
    right, n = met.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    assert n > 20
    return right


def test_quality_on_held_out_rows(tables):
    documents, labels = tables
    scored = quality.score(documents, quality.train(documents, labels))
    assert held_out_accuracy(scored, labels, "quality") > 0.95
    assert scored.where("predicted <> CAST(score >= 0.7 AS INT) OR score NOT BETWEEN 0 AND 1").isEmpty()


def test_toxicity_on_held_out_rows(tables, documents):
    docs, labels = tables
    lexicon = toxicity.train(docs, labels)
    scored = toxicity.score(docs, lexicon)
    assert held_out_accuracy(scored, labels, "toxic") > 0.95
    clean, bad = "The is of and to " * 30, "you 1d10t, you mоrоn and $tup1d l0ser, pathet1c trash"
    got = toxicity.score(documents([(1, clean, None, None), (2, bad, None, None)]), lexicon)
    assert {r["doc_id"]: r["predicted"] for r in got.collect()} == {1: 0, 2: 1}


def test_held_out_labels_are_never_used(spark, tables):
    documents, labels = tables
    flipped = labels.withColumn(
        "quality",
        F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality"))
        .otherwise(F.col("quality")),
    )
    a, b = quality.train(documents, labels), quality.train(documents, flipped)
    assert np.array_equal(a.weights, b.weights) and a.cutoff == b.cutoff


def test_language_on_held_out_rows(tables):
    documents, _ = tables
    found = langid.identify(documents, langid.train(documents))
    met = found.where("held_out").join(documents.select("doc_id", "lang"), "doc_id")
    assert met.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_edge_rows(spark, documents):
    docs = documents(EDGES)
    labels = spark.createDataFrame(
        [(2, 1, 0), (4, 0, 1), (5, 1, 0), (6, 1, 0), (6, 0, 1), (None, 1, 1), (1, None, None)],
        "doc_id bigint, quality int, toxic int",
    )
    scored = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(scored) == len(EDGES) and all(0 <= r["score"] <= 1 for r in scored)
    lexicon = toxicity.train(docs, labels)
    scored = toxicity.score(docs, lexicon).collect()
    assert len(scored) == len(EDGES) and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.keep_clean(docs, lexicon).columns == docs.columns
    found = langid.identify(docs, langid.train(docs)).collect()
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert und == {1, 2, 4} and len(found) == len(EDGES)


def test_empty_tables(spark, documents):
    docs = documents([])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.score(docs, quality.train(docs, labels)).count() == 0
    assert toxicity.score(docs, toxicity.train(docs, labels)).count() == 0
    assert langid.identify(docs, langid.train(docs)).count() == 0
    some = documents(EDGES)
    assert quality.score(some, quality.train(docs, labels)).count() == len(EDGES)
    assert toxicity.score(some, toxicity.train(docs, labels)).where("predicted = 1").count() == 0
    assert {r["lang_pred"] for r in langid.identify(some, langid.train(docs)).collect()} == {"und"}


def test_pairwise_fit_orders_by_the_telling_feature():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    x = np.column_stack([rng.normal(size=400), y + rng.normal(0, 0.1, 400)])
    model = quality.fit(x, y)
    assert ((model.score(x) >= 0.7) == y).mean() > 0.99
    assert abs(model.weights[1]) > 5 * abs(model.weights[0])
    assert (quality.fit(x, np.ones(400)).score(x) >= 0.7).all()
    assert (quality.fit(x, np.zeros(400)).score(x) < 0.7).all()


def test_folding_and_exceptions():
    assert toxicity.fold("Tr4sh! тrаѕh\u200b, ТRASH$$") == " trash trash trash "
    lexicon = toxicity.Lexicon({" trash ": 2.0, " idio": 3.0}, {" trash can ", " idiom "})
    hits = lexicon.matcher()
    names = lambda text: [p for _, _, p in hits(toxicity.fold(text))]
    assert names("a trash can, an idiom") == []
    assert names("trash, idiotic") == [" trash ", " idio"]


@pytest.mark.parametrize("k", [0, 1, 2, 4, 7, 40])
def test_codewords_are_apart(k):
    code = langid.codewords(k)
    assert code.shape[0] == k
    for i in range(k):
        for j in range(i):
            assert (code[i] != code[j]).sum() >= max(1, code.shape[1] // 4)


def test_ngrams_of_a_word_do_not_depend_on_its_neighbours():
    alone, _ = langid.ngrams(["word"])
    together, owners = langid.ngrams(["a", "word", "bcd"])
    assert sorted(alone) == sorted(together[owners == 1])


def test_token_counts(spark, documents):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng, parts = random.Random(4), [*" \n\t aB1é!'", "  ", " the", "<|endoftext|>", "\n\n", "\x85", "中", " 's"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    texts += [None, "", "word " * 100_000, "x" * 300_000, "word " * 100_000]
    got = tokens.count_tokens(documents([(i, t, None, None) for i, t in enumerate(texts)]), path)
    encoder = Tokenizer.from_file(path)
    assert got.count() == len(texts)
    for r in got.collect():
        text = texts[r["doc_id"]] or ""
        n = len(encoder.encode(text, add_special_tokens=False))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 512), repr(text[:80])
    assert tokens.count_tokens(documents([]), path).count() == 0


@pytest.mark.parametrize("k", [7, 9, 20])
def test_code_columns_are_distinct_splits(k):
    code = langid.codewords(k)
    splits = {tuple(column * column[0]) for column in code.T}
    assert len(splits) == code.shape[1] and (np.abs(code.sum(0)) < k).all()


def test_texts_without_a_letter_have_no_language(spark, documents, tables):
    model = langid.train(tables[0])
    odd = ["½", "²", "①", "Ⅻ", "½ ² ①", "12 _ ¾", "é", "x²"]
    rows = [(i, t, None, "s") for i, t in enumerate(odd)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(documents(rows), model).collect()}
    assert [got[i] == "und" for i in range(len(odd))] == [not any(map(str.isalpha, t)) for t in odd]


def test_the_training_sample_is_the_same_on_every_cluster(spark, tables):
    samples = set()
    for partitions in (1, 4, 9, 31):
        labels = tables[1].repartition(partitions)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        drawn = common.training_labels(labels, "quality", 4, 2, 50).collect()
        samples.add(tuple(sorted(map(tuple, drawn))))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert len(samples) == 1


def test_clean_rows_keep_all_columns(documents, tables):
    lexicon = toxicity.train(*tables)
    docs = documents(EDGES)
    kept, scored = toxicity.keep_clean(docs, lexicon), toxicity.score(docs, lexicon)
    assert kept.columns == docs.columns
    assert kept.count() == scored.where("predicted = 0").count()
    assert not kept.where("text IS NULL").isEmpty()
