"""A cleaning pipeline over ``documents``: five stages, each handed on through a Parquet table.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; all but the last return the
columns of ``documents``. Null and empty texts are rejected by the first stage (they have no language), so later
stages see texts with letters only; an empty table passes through as an empty table. Extra columns stay untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelforge.llm import op3_language_id, op5_exact_dedup, op6_decontamination, op7_sentencepiece, op10_simhash
from panelforge.llm.common import drop_written, scratch, table, written

#: Documents whose language is less likely than this are rejected.
MIN_LANGUAGE_SCORE = 0.5
#: Entries of the encoder's caches in a worker, which has run the other stages before; they change no result.
ENCODER_CACHE = 100_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that get a language, learned from rows outside the held-out third, with enough confidence."""
    model = op3_language_id.train(docs.where(~op3_language_id.is_held_out()))
    return op3_language_id.keep_identified(docs, model, MIN_LANGUAGE_SCORE)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each class of equal texts."""
    return op5_exact_dedup.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word Jaccard similarity 0.8 or more: the one with the smallest id."""
    return op10_simhash.keep_representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return op6_decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with the digests of ids and decoded text."""
    found = op7_sentencepiece.round_trip(docs, op7_sentencepiece.default_path(), entries=ENCODER_CACHE)
    return op7_sentencepiece.digests(found, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: SQL has no SentencePiece; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch() as keep:  # what a stage has written for itself goes when its result is there
            after = written(stage(spark, docs, sf_dir), f"stage-{name}")
            keep(after)
        drop_written(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
