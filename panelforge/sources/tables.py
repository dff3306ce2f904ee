"""Typed scans and sinks of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.contracts import ContractError, require_schema, schema_differences


def typed_parquet(spark: SparkSession, path: str, declared: StructType) -> DataFrame:
    """A Parquet table that has exactly the declared columns and types."""
    return require_schema(spark.read.parquet(path), declared)


def pruned(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Some columns of a table; the scan reads only these."""
    return spark.read.parquet(path).select(*columns)


def typed_csv(spark: SparkSession, path: str, declared: StructType) -> DataFrame:
    """A CSV table with a header; empty strings stay empty strings, empty numbers are null."""
    df = spark.read.csv(path, header=True, schema=declared, multiLine=True, escape='"', enforceSchema=False, mode="FAILFAST")
    return df.withColumns({f.name: F.coalesce(f.name, F.lit("")) for f in declared.fields if isinstance(f.dataType, StringType)})


def text_csv(spark: SparkSession, path: str, place: str | None = None) -> DataFrame:
    """A CSV table with every column as a string and nothing null; with ``place``, a column that sorts as the rows stand.

    Quoted fields can hold line ends, so a file is read by one task: keep files of tables and logs of moderate size.
    """
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    out = {c: F.coalesce(c, F.lit("")) for c in df.columns}
    if place:
        out[place] = F.concat_ws(":", "_metadata.file_name", F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    return df.withColumns(out)


def vintages(df: DataFrame, column: str, wanted: list) -> DataFrame:
    """The rows of some vintages; each must have rows."""
    found = df.where(F.col(column).isin(wanted))
    seen = {r[0] for r in found.select(column).distinct().collect()}  # at most the wanted vintages
    if missing := [v for v in wanted if v not in seen]:
        raise ContractError([("vintage without rows", len(missing), [str(v) for v in missing])])
    return found


def write_sorted(df: DataFrame, path: str, key: list[str | Column], partition_by: list[str] | None = None) -> None:
    """Zstd Parquet in key order: range-partitioned, so the sort is global and no task holds it all."""
    out = df.repartitionByRange(*key).sortWithinPartitions(*key).write.option("compression", "zstd")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


def replace_vintages(df: DataFrame, path: str, vintage: str, key: list[str]) -> None:
    """Write the vintages of ``df`` in place of those that a table of vintages holds; others keep their files.

    Each vintage is a folder. Rows are dealt by ranges of (vintage, key), so a vintage of any size is many tasks.
    """
    rows = df.repartitionByRange(vintage, *key).sortWithinPartitions(vintage, *key)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(vintage).parquet(path)


def dealt(df: DataFrame, key: list[str], rows: int = 250_000) -> DataFrame:
    """``df`` dealt out by ``key`` once, about ``rows`` rows to a task, for a chain of groupings and joins by this key.

    They need no other shuffle, and no task holds more groups as the table grows. Adaptive execution merges partitions by
    their compressed bytes, of which narrow rows have so few that millions meet in one hash table; a number of partitions
    that is given stays. Counts ``df`` first, which must be cheap. Rows of one key meet in one task.
    """
    return df.repartition(parts(df, rows), *key)


def parts(df: DataFrame, rows: int = 250_000) -> int:
    """The number of parts of about ``rows`` rows of ``df``, for tables that are to be dealt out by one key alike. Counts ``df``."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def bucketed(df: DataFrame, key: list[str], buckets: int, folder: str, name: str) -> DataFrame:
    """``df`` written once as a table of ``buckets`` buckets by ``key``, one file each, and read back.

    Tables with the same buckets join and group by this key without a shuffle. ``name`` is the table's in the session's
    catalog, ``folder`` where its files are.
    """
    dealt = df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key)
    dealt.option("path", folder).format("parquet").mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def write_checked(df: DataFrame, path: str, declared: StructType, key: list[str] | None = None) -> DataFrame:
    """Write with the declared types, read back, and compare schema and the row count seen while writing."""
    spark, seen = df.sparkSession, Observation()
    out = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields))
    if key:
        out = out.repartitionByRange(*key).sortWithinPartitions(*key)
    # observed behind the range partitioning, which reads its input twice to find its bounds
    out.observe(seen, F.count("*").alias("n")).write.option("compression", "zstd").parquet(path)
    back = spark.read.parquet(path)
    found = schema_differences(back.schema, declared, nullability=False)
    n = back.count()
    if found or n != seen.get["n"]:
        raise ContractError([("read back", 1, found or [f"{n} of {seen.get['n']} rows"])])
    return back


def write_summary_csv(df: DataFrame, path: str) -> None:
    """A result-sized table as one CSV file with a header."""
    df.coalesce(1).write.csv(path, header=True)


def declared(fields: list[tuple[str, str]], required: list[str] | None = None) -> StructType:
    """A schema from (name, type) pairs; columns in ``required`` are not nullable."""
    kinds = StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in fields))
    return StructType([StructField(f.name, f.dataType, f.name not in (required or [])) for f in kinds.fields])


def staged(df: DataFrame, folder: str | None, name: str) -> DataFrame:
    """``df`` written once under ``folder`` and read back, so that what follows does not compute it again; as it is if
    there is no folder."""
    if folder is None:
        return df
    df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
