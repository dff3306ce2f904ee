"""Trees of blocks: a directory for each partition of the hierarchy, with tables, status files, sources and pages.

All scans read the whole tree at once; the block is a column that comes from the path of each file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Path components whose files are captures, not tables.
CAPTURE_FOLDERS = ("html", "debug")


def relative_path(root: str, path: str | Column = "_metadata.file_path") -> Column:
    """A file's path below ``root``, scheme and escapes removed."""
    path = F.try_url_decode(F.regexp_replace(F.col(path) if isinstance(path, str) else path, r"^[a-z0-9]+:/*", "/"))
    bare = "/" + root.split(":", 1)[-1].strip("/") + "/"
    return F.when(path.startswith(bare), F.substring(path, len(bare) + 1, 1 << 30)).otherwise(path)


def parent(path: str | Column) -> Column:
    return F.regexp_replace(F.col(path) if isinstance(path, str) else path, r"/?[^/]*$", "")


def in_capture(path: Column) -> Column:
    return path.rlike(r"(?:^|/)(?:" + "|".join(CAPTURE_FOLDERS) + ")/")


def read_tables(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """One table of all blocks, with ``block_dir`` (relative to the root) from each file's path."""
    df = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", name).parquet(root)
    place = relative_path(root)
    return df.select("*", parent(place).alias("__block"), place.alias("__path")).where(~in_capture(F.col("__path"))).drop("__path").withColumn("block_dir", F.col("__block")).drop("__block")


def page_path(block_dir: str, page: str) -> Column:
    """The capture that a row came from: ``html/page_NNN.html`` in its block."""
    number = F.col(page).try_cast("int")
    return F.when(number.isNotNull(), F.format_string("%s/html/page_%03d.html", F.col(block_dir), number)).otherwise("")


def with_provenance(df: DataFrame, block_dir: str = "block_dir", page: str = "block_page", target: str = "block_html_file") -> DataFrame:
    return df.withColumn(target, page_path(block_dir, page))


def read_statuses(spark: SparkSession, root: str, schema: StructType, names: tuple[str, ...] = ("DONE.json", "FAILED.json"), unreadable: str = "done_unreadable_json") -> DataFrame:
    """The status of every block: the first of ``names`` that it has. Unreadable JSON becomes a status of its own."""
    known = StructType([*schema.fields]).add("_corrupt", "string")

    def one(rank: int, name: str) -> DataFrame:
        df = spark.read.schema(known).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
        df = df.option("recursiveFileLookup", True).option("pathGlobFilter", name).json(root)
        return df.select("*", parent(relative_path(root)).alias("block_dir"), F.lit(rank).alias("__rank"))

    found = reduce(DataFrame.unionByName, (one(k, n) for k, n in enumerate(names)))
    status = F.when(F.col("_corrupt").isNotNull(), unreadable).otherwise(F.coalesce("status", F.lit("?")))
    found = found.withColumn("status", status).drop("_corrupt")
    first = F.row_number().over(Window.partitionBy("block_dir").orderBy("__rank"))
    return found.withColumn("__n", first).where("__n = 1").drop("__n", "__rank")


def read_pages(spark: SparkSession, root: str, pattern: str = "*.html") -> DataFrame:
    """(path, html) of all page captures."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(root, wholetext=True)
    return df.select(relative_path(root).alias("path"), F.col("value").alias("html"))


def inventory(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, bytes, sha256, kind) of every file; the content is hashed where it is read and goes no further."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(root)
    path = relative_path(root, "path")
    return files.select(path.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).withColumn("kind", file_kind("path"))


def file_kind(path: str | Column) -> Column:
    """html, status, table, json or other."""
    path = F.col(path) if isinstance(path, str) else path
    return (
        F.when(in_capture(path) | path.endswith(".html"), "html")
        .when(path.rlike(r"(?:^|/)(?:DONE|FAILED)\.json$"), "status")
        .when(path.rlike(r"\.(?:parquet|csv)$"), "table")
        .when(path.endswith(".json"), "json")
        .otherwise("other")
    )


def sizes_by_kind(files: DataFrame, by: list[str] | None = None) -> DataFrame:
    return files.groupBy(*(by or []), "kind").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
