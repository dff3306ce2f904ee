"""Append-only logs: a Parquet history followed by a CSV tail, both as strings, with an explicit append order.

The order of a log must survive storage, since Spark reads files in an order of its own. Logs that this module writes hold
it in the column ``log_line``: larger is later. Other Parquet files are ordered by file name and place in the file, CSV
files likewise. The column names ``src_rank``, ``line`` and ``log_line`` are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.contracts import ContractError
from ..operators.sets import multiset_difference
from .tables import text_csv

#: Columns that make the append order: the source (history before tail), then the place in it.
ORDER = ["src_rank", "line"]
#: The stored append order of a Parquet log.
STORED = "log_line"


def as_text(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """All columns as strings without nulls, legacy names replaced."""
    df = df.withColumnsRenamed({k: v for k, v in (renames or {}).items() if k in df.columns and v not in df.columns})
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))


def _place(number: Column) -> Column:
    """A number as a text that sorts like it."""
    return F.lpad(number.cast("long").cast("string"), 20, "0")


def numbered(df: DataFrame, rank: int, line: str | None = None) -> DataFrame:
    """``df`` with its append order: ``line`` if it is named, else the stored order, else that of the rows of ``df``."""
    line = line or (STORED if STORED in df.columns else None)
    place = _place(F.col(line)) if line else _place(F.monotonically_increasing_id())
    out = df.withColumns({"src_rank": F.lit(rank), "line": place})
    return out.drop(*({line, STORED} - {None, *ORDER}))


def combined_log(history: DataFrame | None, tail: DataFrame | None, renames: dict[str, str] | None = None, line: str | None = None) -> DataFrame:
    """History, then tail: all columns of either as strings, ``""`` where a row lacks one, with ``src_rank, line``."""
    parts = []
    for rank, df in enumerate((history, tail)):
        if df is not None:
            parts.append(numbered(as_text(df, renames), rank, line if line in df.columns else None))
    if not parts:
        raise ContractError([("log", 1, ["neither history nor tail"])])
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return out.select(*(F.coalesce(c, F.lit("")).alias(c) if c not in ORDER else F.col(c) for c in out.columns))


def read_log(spark: SparkSession, history_path: str | None, tail_path: str | None, renames: dict[str, str] | None = None) -> DataFrame:
    """``combined_log`` of the files at two paths; either may be absent."""
    history = tail = None
    if history_path:
        history = spark.read.parquet(history_path)
        if STORED not in history.columns:
            history = history.withColumn("line", F.concat_ws(":", "_metadata.file_name", _place(F.col("_metadata.row_index"))))
    if tail_path:
        # a file is one task, since its quoted fields can hold line ends, so numbers rise inside it
        tail = text_csv(spark, tail_path, place="line")
    parts = [None if df is None else as_text(df, renames) for df in (history, tail)]
    return _read(parts)


def _read(parts: list[DataFrame | None]) -> DataFrame:
    """The union of text tables whose column ``line`` is a place already, or which hold the stored order."""
    rows = []
    for rank, df in enumerate(parts):
        if df is not None:
            rows.append(df.withColumn("src_rank", F.lit(rank)) if "line" in df.columns else numbered(df, rank))
    if not rows:
        raise ContractError([("log", 1, ["neither history nor tail"])])
    out = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1], allowMissingColumns=True)
    names = [c for c in out.columns if c not in ORDER]
    return out.select(*(F.coalesce(c, F.lit("")).alias(c) for c in names), *ORDER)


def ordinal() -> Column:
    """The append order as one comparable value."""
    return F.struct(*ORDER)


def append_log(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Append rows to a Parquet log, behind all that it holds, in the order of ``order``, or of the rows of ``df``.

    One writer at a time may append; ``commits`` has logs for several. A log whose files do not store their order cannot be
    added to, since nothing would tell which rows are later: fold it first.
    """
    spark, before = df.sparkSession, None
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(place) and any(s.getPath().getName().endswith(".parquet") for s in fs.listStatus(place)):
        log = spark.read.option("mergeSchema", True).parquet(path)
        n, stored, before = log.agg(F.count("*"), F.count(STORED), F.max(STORED)).first() if STORED in log.columns else (1, 0, None)
        if stored < n:
            raise ContractError([("log without its order", n - stored, [path])])
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    line = F.monotonically_increasing_id() + F.lit(0 if before is None else before + 1)
    rows.withColumn(STORED, line).write.mode("append").parquet(path)


def fold_log(history: DataFrame | None, tail: DataFrame, path: str, renames: dict[str, str] | None = None) -> DataFrame:
    """Fold a tail into the history: union of columns, of exact repetitions the first row kept, append order stored.

    What was written is compared with what should be, cell for cell and in its order. Folding the same tail twice
    changes nothing.
    """
    spark = tail.sparkSession
    log = combined_log(history, tail, renames)
    names = [c for c in log.columns if c not in ORDER]
    once = log.groupBy(*names).agg(F.min(ordinal()).alias("__at"))
    rows = once.repartitionByRange("__at").sortWithinPartitions("__at").select(*names, F.monotonically_increasing_id().alias(STORED))
    rows.write.option("compression", "zstd").parquet(path)
    back = spark.read.parquet(path)
    if not multiset_difference(once.select(*names), back.select(*names)).isEmpty() or not misplaced(once.join(back, names), "__at", STORED).isEmpty():
        raise ContractError([("fold", 1, ["written rows differ"])])
    return back


def misplaced(rows: DataFrame, order: str, stored: str) -> DataFrame:
    """Where the stored order of ``rows`` disagrees with ``order``: inside the stretches of 2**33 stored numbers, which a
    task each wrote, and between neighbouring stretches. One row for each place, none if both orders agree."""
    parts = rows.select(F.col(order).alias("at"), F.col(stored).alias("number"), F.shiftrightunsigned(stored, 33).alias("part"))
    before = F.lag("at").over(Window.partitionBy("part").orderBy("number"))
    inside = parts.withColumn("before", before).where(F.col("before") >= F.col("at")).select("part")
    spans = parts.groupBy("part").agg(F.min("at").alias("low"), F.max("at").alias("high"))  # one row for each task
    between = spans.withColumn("next", F.lead("low").over(Window.orderBy("part"))).where(F.col("next") <= F.col("high")).select("part")
    return inside.unionAll(between)
