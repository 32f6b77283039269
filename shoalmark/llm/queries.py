"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    collocations,
    decontaminate,
    langid,
    linededup,
    mixing,
    neardup,
    neighbours,
    packing,
    quality,
    spelling,
    tokens,
    toxicity,
    urlfilter,
)

#: Host and path rules of the URL filter query.
URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]

#: The tree of the mixing query. The tables have no domain, so it is taken from the source: the one
#: large crawl, sources with one digit, and the others. Paths that are not listed weigh 1.
LEVELS = {
    "domain": (
        "CASE WHEN source = 'src0' THEN 'crawl' WHEN length(source) = 4 THEN 'forum' ELSE 'press' END"
    ),
    "lang": "lang",
    "source": "source",
}
WEIGHTS = {
    ("crawl",): 2,
    ("forum",): 3,
    ("press",): 5,
    **{(d, lang): w for d in ("crawl", "forum", "press")
       for lang, w in (("en", 5), ("de", 2), ("fr", 2), ("es", 1))},
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Bradley-Terry quality score of every document."""
    documents = table(spark, folder, "documents")
    return quality.score(documents, quality.train(documents, table(spark, folder, "labels")))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How often every document is taken in a mix as large as the corpus, in two epochs at most."""
    made = mixing.mix(table(spark, folder, "documents"), LEVELS, WEIGHTS)
    return made.select("row.doc_id", "domain", "lang", "source", "n_tokens", "copies")


def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest found of every twentieth vector."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return neardup.near_duplicates(table(spark, folder, "documents")).drop("text_key")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Lexicon toxicity score of every document."""
    documents = table(spark, folder, "documents")
    lexicon = toxicity.train(documents, table(spark, folder, "labels"))
    return toxicity.score(documents, lexicon)


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    found = decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the URL of every page; a page counts as bad if its document is labelled so."""
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    marks = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block")
    )
    mined = urlfilter.mine_rules(pages.join(marks, "page_id").select("url", "block"))
    judged = urlfilter.judge(pages, URL_RULES, mined)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document in the 50k byte-level vocabulary."""
    import public_tokenizers

    documents = table(spark, folder, "documents")
    return tokens.count_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    documents = table(spark, folder, "documents")
    return langid.identify(documents, langid.train(documents))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without lines that ten or more sources carry, but for their first place."""
    made = linededup.remove_boilerplate(table(spark, folder, "documents"))
    return made.select(
        "row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's token ids packed into sequences of at most 1024."""
    import public_tokenizers

    packed = packing.pack(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """The more frequent spelling of every word, one edit apart."""
    return spelling.spelling_variants(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The 2000 best-scoring phrases of every language."""
    return collocations.collocations(table(spark, folder, "documents"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE
    list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b
    ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sets
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id, doc_id = c AS kept
FROM sets JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) ON doc_id = x
"""

DECONTAMINATION_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS k
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS t
  FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM i)
), places AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)
), found AS (
  SELECT doc_id, k, p, item FROM places JOIN windows USING (k, t)
), hit AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS t
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.t, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

LINE_DEDUP_CTE = """
lines AS (
  SELECT doc_id, source, p, l, trim(l, ' ' || chr(9) || chr(13)) AS t
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS l,
               unnest(range(0, len(string_split(text, chr(10))))) AS p FROM documents)
), spread AS (
  SELECT t, min(row(doc_id, p)) AS first_place FROM lines WHERE t <> '' GROUP BY t
  HAVING count(DISTINCT source) >= 10
), judged AS (
  SELECT lines.*, spread.t IS NOT NULL AND row(doc_id, p) <> first_place AS gone
  FROM lines LEFT JOIN spread ON lines.t = spread.t
), cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(l, chr(10) ORDER BY p) FILTER (NOT gone), '') AS text
  FROM judged GROUP BY doc_id
)"""

LINE_DEDUP_SQL = f"""
WITH {LINE_DEDUP_CTE}
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(CASE WHEN n_removed > 0 THEN c.text ELSE d.text END) AS text_sha256
FROM documents d LEFT JOIN cleaned c USING (doc_id)
"""

MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source = 'src0' THEN 'crawl' WHEN length(source) = 4 THEN 'forum' ELSE 'press' END AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
), weights AS (
  SELECT * FROM (VALUES ('crawl', 2), ('forum', 3), ('press', 5)) v(name, w)
  UNION ALL SELECT * FROM (VALUES ('en', 5), ('de', 2), ('fr', 2), ('es', 1)) v(name, w)
), leaf AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(2 * sum(n_tokens) AS BIGINT) AS cap
  FROM d GROUP BY ALL
), a0 AS (
  SELECT domain, coalesce(w, 1) AS w, CAST(sum(cap) AS BIGINT) AS cap,
         CAST(least((SELECT sum(tokens) FROM leaf), (SELECT sum(cap) FROM leaf)) AS BIGINT) AS budget
  FROM leaf LEFT JOIN weights ON domain = name GROUP BY domain, w HAVING sum(cap) > 0
), a1 AS (
  SELECT *, cap * sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS whole
  FROM a0
), a AS (
  SELECT domain, CAST(CASE WHEN whole THEN cap ELSE
    ((budget - sum(CASE WHEN whole THEN cap ELSE 0 END) OVER ()) * w) // sum(CASE WHEN whole THEN 0 ELSE w END) OVER () END AS BIGINT) AS alloc
  FROM a1
), b0 AS (
  SELECT domain, lang, coalesce(w, 1) AS w, CAST(sum(cap) AS BIGINT) AS cap, any_value(alloc) AS budget
  FROM leaf JOIN a USING (domain) LEFT JOIN weights ON lang = name GROUP BY domain, lang, w HAVING sum(cap) > 0
), b1 AS (
  SELECT *, cap * sum(w) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= (budget - coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS whole
  FROM b0
), b AS (
  SELECT domain, lang, CAST(CASE WHEN whole THEN cap ELSE
    ((budget - sum(CASE WHEN whole THEN cap ELSE 0 END) OVER p) * w) // sum(CASE WHEN whole THEN 0 ELSE w END) OVER p END AS BIGINT) AS alloc
  FROM b1 WINDOW p AS (PARTITION BY domain)
), c1 AS (
  SELECT leaf.*, alloc AS budget, cap * count(*) OVER (PARTITION BY domain, lang ORDER BY cap / 1, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= (alloc - coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / 1, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS whole
  FROM leaf JOIN b USING (domain, lang) WHERE cap > 0
), c AS (
  SELECT domain, lang, source, tokens, CAST(CASE WHEN whole THEN cap ELSE
    (budget - sum(CASE WHEN whole THEN cap ELSE 0 END) OVER p) // sum(CASE WHEN whole THEN 0 ELSE 1 END) OVER p END AS BIGINT) AS alloc
  FROM c1 WINDOW p AS (PARTITION BY domain, lang)
), placed AS (
  SELECT d.*, coalesce(alloc // tokens, 0) AS epochs, coalesce(alloc % tokens, 0) AS rest
  FROM d LEFT JOIN c USING (domain, lang, source)
), summed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5('1:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, n_tokens) AS upto
  FROM placed
)
SELECT doc_id, domain, lang, source, n_tokens,
       CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM summed
"""

#: The typo hash is CRC-32, which is worked out here byte by byte from its polynomial. Words are near if
#: one is the other without one letter, or both are equal without the letter at the same place.
SPELLING_SQL = f"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(CAST(b AS BIGINT), range(8)),
    lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) ORDER BY b) AS crc
  FROM range(256) r(b)
), runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                                 '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
      list_prepend(4294967295, list_transform(range(octet_length(t)),
        lambda i: CAST(('0x' || hex(t)[2 * i + 1:2 * i + 2]) AS BIGINT))),
      lambda x, y: xor(x // 256, crc[xor(x % 256, y) + 1]))) AS h
  FROM (SELECT *, encode(concat(coalesce(CAST(doc_id AS VARCHAR), 'None'), ':', run)) AS t FROM runs), crc_table
), words AS MATERIALIZED (
  SELECT w, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS w, n
        FROM hashed)
  WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2
), without AS MATERIALIZED (
  SELECT w, n, i, w[1:i - 1] || w[i + 1:] AS v FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.w AS w, b.w AS o, b.n AS m FROM without a JOIN without b ON a.v = b.v AND a.i = b.i AND a.w <> b.w
  UNION SELECT a.w, b.w, b.n FROM without a JOIN words b ON a.v = b.w
  UNION SELECT b.w, a.w, a.n FROM without a JOIN words b ON a.v = b.w
), nearest AS (
  SELECT w, count(*) AS n_near, max(m) AS m, arg_min(o, (-m, o)) AS o FROM pairs GROUP BY w
), judged AS (
  SELECT w, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN o END AS form,
         CASE WHEN m >= 10 * n THEN m END AS form_n FROM words LEFT JOIN nearest USING (w)
), chain AS (
  SELECT w, w AS root, form AS following FROM judged
  UNION ALL
  SELECT c.w, j.w, j.form FROM chain c JOIN judged j ON c.following = j.w
)
SELECT w AS word, form, root, n, n_near, form_n FROM judged JOIN chain USING (w) WHERE following IS NULL
"""

COLLOCATIONS_SQL = f"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                            '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)
), phrases AS MATERIALIZED (
  SELECT lang, m, array_to_string(w[p:p + m - 1], ' ') AS phrase, any_value(w[p:p + m - 1]) AS w, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM pieces, range(1, 6) r(m) WHERE len(w) >= m)
  GROUP BY lang, m, phrase
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM phrases WHERE m = 1 GROUP BY lang
), inside AS (
  SELECT DISTINCT lang, array_to_string(w[s:s + k - 1], ' ') AS phrase, f
  FROM (SELECT lang, w, f, k, unnest(range(1, m - k + 2)) AS s
        FROM phrases, range(2, 5) r(k) WHERE f >= 100 AND k < m)
), kept AS (
  SELECT p.* FROM phrases p WHERE m > 1 AND f >= 100
    AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = p.lang AND i.phrase = p.phrase AND 100 * i.f >= 100 * p.f)
), cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, u.f AS l, v.f AS r, n,
         CAST((1000::HUGEINT * c.a * n) // (u.f::HUGEINT * v.f) AS BIGINT) AS score
  FROM cuts c JOIN phrases u ON u.lang = c.lang AND u.phrase = x
              JOIN phrases v ON v.lang = c.lang AND v.phrase = y JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

QUERIES = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_neighbours": op3_neighbours,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_url_filter": op7_url_filter,
    "op8_token_counts": op8_token_counts,
    "op9_language": op9_language,
    "op10_line_dedup": op10_line_dedup,
    "op11_packing": op11_packing,
    "op12_spelling": op12_spelling,
    "op13_collocations": op13_collocations,
}
ORACLES = {
    "op2_mixing": MIXING_SQL,
    "op4_near_duplicates": NEAR_DUPLICATES_SQL,
    "op6_decontamination": DECONTAMINATION_SQL,
    "op10_line_dedup": LINE_DEDUP_SQL,
    "op12_spelling": SPELLING_SQL,
    "op13_collocations": COLLOCATIONS_SQL,
}
