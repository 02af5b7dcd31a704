"""From ``documents`` to token ids: language, lines, near copies, benchmark passages, encoding.

Each stage gets the documents its predecessor kept, as written Parquet, and all but
the last return rows with the columns of ``documents``. No stage can be put in SQL
as a whole (the first learns, the last is an encoder), so ``ORACLE_SQL`` is None and
the tests compare every stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnbrook.llm import bpe, contamination, jaccard, language, lines
from tarnbrook.llm.package import ship
from tarnbrook.llm.queries import vocabulary
from tarnbrook.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that the corpus teaches go."""
    ship(spark)
    return language.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in one of them."""
    return lines.without_repeated_lines(docs)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    ship(spark)
    return jaccard.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go, by the contamination rule."""
    ship(spark)
    return contamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of the ids and of what they decode to."""
    ship(spark)
    return bpe.round_trip(docs, vocabulary())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", join_near_copies),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
