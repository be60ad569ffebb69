"""The corpus pipeline: documents go through the stages in order, each on all that its predecessor kept.

Every stage's result is written as Parquet to the shared scratch folder and read again by the next one.
All stages but the last return the columns of ``documents``.

Defined cases: null texts count as empty and repeated rows are copies, of which exact dedup keeps one; a null id keeps its row as far as it is no
copy; empty and very long texts pass like others; ties go to the smallest id; an empty table gives an empty result; further columns of ``documents``,
whatever their names, reach the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brieflow.llm.bpe_lexicon import round_trip
from brieflow.llm.catalog import vocabulary
from brieflow.llm.common import stored, table
from brieflow.llm.decontaminate import drop_contaminated
from brieflow.llm.exact_dedup import drop_exact_copies
from brieflow.llm.simhash_bk import drop_near_copies
from brieflow.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of least id, of each group of near copies."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers and hashes of ids and decoded text of each document that is left."""
    return round_trip(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("bpe", bpe)]

#: a trained score, fingerprint components and BPE are beyond SQL; the tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
