"""Training-data pipeline over the documents table: language, near-duplicates, benchmark leaks, personal data, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshloom.llm.common import materialise, read_table, release
from meshloom.llm.decontaminate import drop_leaked, find_leaks
from meshloom.llm.langid import fit, identify
from meshloom.llm.mixing import mix
from meshloom.llm.neardup import drop_near_duplicates
from meshloom.llm.pii import pseudonymise_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go; lang becomes the predicted language of the others."""
    found = identify(docs, fit(docs))
    return found.where(~F.col("rejected")).withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaked(docs, materialise(find_leaks(docs, read_table(spark, sf_dir, "benchmark")), "leaks"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by pseudonyms; n_chars follows the text."""
    return pseudonymise_documents(docs, counts=False).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The uses of each document in the mixture, with the tokens taken from it."""
    return mix(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("pii", pii), ("mixing", mixing)]
#: The stages' classifiers, fingerprints and pseudonyms have no SQL form; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; a stage's table is deleted as soon as the next one has been written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
