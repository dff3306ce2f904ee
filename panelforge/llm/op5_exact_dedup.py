"""Exact deduplication by 128-bit content hash with a byte comparison inside each hash group.

Texts are equal when they are identical after each run of ASCII white space became one space; null counts as empty.
The hash (MD5 of the normalised text) is the join key. The byte comparison is the grouping itself: classes are made
by (hash, normalised text), so two texts that collide fall into different classes. The partial aggregate on the map
side leaves one text for each class and task, so a group that holds a third of all rows crosses the network as a
few rows. The way back goes by hash and SHA-256, which texts that collide do not share.

Defined results: empty tables give no rows. A repeated row (same id, same text) is counted in ``group_size``; exactly
one of the repetitions is kept. Null ids lose against any id; among null ids alone one row is kept. Very long texts are
compared whole. Other columns never take part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, table, text_or_empty, written

NAME = "op5_exact_dedup"
SPACE = "[\\x20\\x09-\\x0D]+"

ORACLE = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (
  SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.body) AS text_sha256
FROM n JOIN g ON n.body = g.body
"""


def normalised(text: str | Column = "text") -> Column:
    """The text with each run of ASCII white space replaced by one space."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per class of equal texts: content_hash (16 bytes), body, keep_id, group_size."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("body"))
    rows = rows.select("id", "body", F.unhex(F.md5("body")).alias("content_hash"))
    return rows.groupBy("content_hash", "body").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, content_hash."""
    # texts leave the plan here: texts that share the 128-bit hash yet differ have different digests, so the two
    # together name the class that the byte comparison made
    heads = classes(docs, id_col, text_col).select("content_hash", _digest(), "keep_id", "group_size")
    rows = docs.select(F.col(id_col).alias("doc_id"), normalised(text_col).alias("body"))
    rows = rows.select("doc_id", F.unhex(F.md5("body")).alias("content_hash"), _digest(), F.monotonically_increasing_id().alias("tie"))
    rows = written(rows, "digests")  # so that a row has one number only
    # of repeated rows with the smallest id exactly one stays, found by a minimum, which no large class gathers
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "tie")
    first = rows.groupBy("content_hash", "digest").agg(F.min_by("tie", order).alias("first"))
    return rows.join(heads.join(first, ["content_hash", "digest"]), ["content_hash", "digest"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("tie") == F.col("first")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "content_hash",
    )


def _digest() -> Column:
    return F.unhex(F.sha2("body", 256)).alias("digest")


def _row_key(id_value: Column, body: Column) -> Column:
    return F.concat_ws(":", F.coalesce(id_value.cast("string"), F.lit("null")), F.sha2(body, 256))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key, nth = fresh("key"), fresh("nth")
    stay = classes(docs, id_col, text_col).select(_row_key(F.col("keep_id"), F.col("body")).alias(key))
    keyed = docs.withColumn(key, _row_key(F.col(id_col), normalised(text_col)))
    first = Window.partitionBy(key).orderBy(F.lit(0))
    kept = keyed.join(stay, key, "left_semi").withColumn(nth, F.row_number().over(first))
    return kept.where(F.col(nth) == 1).drop(key, nth)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
