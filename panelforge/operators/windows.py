"""Window operators over logs and pages. Order always comes from an explicit ordinal that was fixed at ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..sources.shared import shared_folder


def last_rows(log: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """The last row of each key by append order.

    An aggregate, not a window: ``max_by`` keeps one row per key and task before the shuffle, so a key with a third of
    the log costs one task no more than another. Ordinals are unique, so there are no ties.
    """
    rest = [c for c in log.columns if c not in key]
    last = log.groupBy(*key).agg(F.max_by(F.struct(*rest), ordinal).alias("__last"))
    return last.select(*(F.col(c) if c in key else F.col(f"__last.{c}").alias(c) for c in log.columns))


def first_rows(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """The first row of each key by its ordinal."""
    rest = [c for c in df.columns if c not in key]
    first = df.groupBy(*key).agg(F.min_by(F.struct(*rest), ordinal).alias("__first"))
    return first.select(*(F.col(c) if c in key else F.col(f"__first.{c}").alias(c) for c in df.columns))


def latest_log(log: DataFrame, key: list[str], ordinal: str, place: str, keep_blank: bool) -> DataFrame:
    """Last-wins rows of a log; rows with a blank ``place`` are all kept, or all dropped."""
    latest = last_rows(log.where(~is_blank(place)), key, ordinal)
    return latest.unionByName(log.where(is_blank(place))) if keep_blank else latest


def last_status(log: DataFrame, key: list[str], status: str, ordinal: str) -> DataFrame:
    """The last status of each key."""
    return log.groupBy(*key).agg(F.max_by(status, ordinal).alias(status))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows without exact repetitions."""
    return df.dropDuplicates()


def broken_runs(df: DataFrame, scope: list[str], key: list[str], ordinal: str) -> DataFrame:
    """Keys that occur in more than one run of neighbouring rows inside their scope: scope, key, runs.

    A storage-order diagnostic: rows of a scope are read in order, so scopes must be bounded (a file, a page, a block).
    """
    by = Window.partitionBy(*scope).orderBy(ordinal)
    value = F.struct(*key)
    starts = df.withColumn("__start", (~value.eqNullSafe(F.lag(value).over(by))).cast("int"))
    return starts.groupBy(*scope, *key).agg(F.sum("__start").cast("long").alias("runs")).where("runs > 1")


def broken_stretches(df: DataFrame, key: list[str], ordinal: str, scope: list[str] | None = None) -> DataFrame:
    """``broken_runs`` for scopes of any size, all of a table included: a segmented scan over range partitions.

    Rows are dealt by ranges of (scope, ordinal) and written with the number of their range, so every later step sees
    the same ranges. Starts of runs are found inside each range; the first row of a range is no start if it goes on where
    the last row of the range before ends, which one row for each range tells. Rows of one ordinal must not differ in key.
    """
    scope = scope or []
    order = [*scope, ordinal]
    rows = df.select(*dict.fromkeys([*scope, *key, ordinal])).repartitionByRange(*order).sortWithinPartitions(*order)
    folder = shared_folder(df.sparkSession, "ranges")
    rows.withColumn("__range", F.spark_partition_id()).write.parquet(folder)
    rows = df.sparkSession.read.parquet(folder)
    place, value = F.struct(*order), F.struct(*scope, *key)
    inside = Window.partitionBy("__range").orderBy(*order)
    starts = rows.withColumn("__start", (~value.eqNullSafe(F.lag(value).over(inside))).cast("long"))
    edges = rows.groupBy("__range").agg(F.min_by(value, place).alias("__first"), F.max_by(value, place).alias("__last"))
    before = F.lag("__last").over(Window.orderBy("__range"))  # one row for each range
    goes_on = edges.withColumn("__before", before).where(F.col("__first").eqNullSafe(F.col("__before")))
    names = list(dict.fromkeys([*scope, *key]))
    counted = starts.select(*names, "__start").unionAll(goes_on.select(*(F.col(f"__first.{c}").alias(c) for c in names), F.lit(-1).cast("long").alias("__start")))
    return counted.groupBy(*names).agg(F.sum("__start").alias("runs")).where("runs > 1")


def repeated_pages(pages: DataFrame, scope: list[str], ordinal: str, signature: Column) -> DataFrame:
    """Pages whose signature equals that of the page before."""
    by = Window.partitionBy(*scope).orderBy(ordinal)
    marked = pages.withColumn("__signature", signature)
    return marked.withColumn("__before", F.lag("__signature").over(by)).where("__signature = __before").drop("__signature", "__before")


def top_examples(df: DataFrame, group: list[str], order: list[str], value: str, k: int = 3) -> DataFrame:
    """For each group: its size, the first ``k`` values in order, and how many more there are.

    Spark's rank filter keeps ``k`` rows for each group and task before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    first = df.withColumn("__rank", rank).where(F.col("__rank") <= k)
    shown = first.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("__rank", F.col(value).cast("string").alias("v")))), lambda x: x["v"]).alias("examples"))
    sizes = df.groupBy(*group).agg(F.count("*").alias("n"))
    return sizes.join(shown, group).withColumn("more", F.greatest(F.col("n") - k, F.lit(0)))


def positions(df: DataFrame, values: str, position: str = "position", value: str = "value") -> DataFrame:
    """One row per element of an array, numbered from 1."""
    rest = [c for c in df.columns if c != values]
    return df.select(*rest, F.posexplode(values).alias(position, value)).withColumn(position, F.col(position) + 1)


def first_n(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
