"""From raw documents to a training mix: five stages, each applying one operator to all it gets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoalmark.llm import decontaminate, linededup, mixing, neardup, toxicity
from shoalmark.llm.queries import LEVELS, WEIGHTS, table
from shoalmark.session import staged

#: Words of a shingle in the near-duplicate stage; ``op4_near_duplicates`` has two by its contract.
SHINGLE_WORDS = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    lexicon = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, lexicon)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more sources carry go, but for their first place, with what they leave empty."""
    return linededup.cleaned_documents(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by shingles of five words, stays."""
    return neardup.deduplicated(docs, SHINGLE_WORDS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words of a benchmark item in a row go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is taken into the mix, with ``copies`` as the number of times.

    Where the documents have such a column, in whatever case, the number is ``copies_``, and so on.
    """
    name, taken = "copies", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return mixing.mix(docs, LEVELS, WEIGHTS).where("copies > 0").select("row.*", F.col("copies").alias(name))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("near duplicates", drop_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]
#: Toxicity weights are learned, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
