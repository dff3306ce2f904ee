"""Append-only logs with several writers: rows in folders of their own, and a sequence of commits that gives the order.

A writer puts its rows into a new folder and then takes the next number of the sequence by placing a commit file that
must not exist yet; who comes second takes the number behind. So appenders never wait for each other, a reader sees
all rows of a commit or none, and the order of the log is total: by commit, then by place in it. A snapshot joins the
commits up to a number; batch readers go on from there, streams read commits only, so a log can be compacted under a
running query. Placing a file that must not exist is a hard link on local disks, a rename elsewhere, which HDFS and
file systems like it do in one step.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.contracts import ContractError
from .logs import _place

_COMMIT = "number long, folder string, rows long"
#: The order of rows in what is read: the commit, then the place in it.
ORDINAL = "log_at"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder that are not hidden, sorted."""
    fs, target = _file_system(spark, folder)
    found = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return sorted(n for n in found if not n.startswith((".", "_")))


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Place a whole file unless there is one; False if there is."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            try:
                os.link(draft.toUri().getPath(), target.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return not fs.exists(target) and fs.rename(draft, target)
    finally:
        fs.delete(draft, False)


def _commit_file(path: str, number: int) -> str:
    return f"{path}/commits/{number:020d}.json"


def append(df: DataFrame, path: str, order: list[str] | None = None) -> int:
    """Append rows in the order of ``order``, or of the rows of ``df``; the number of the commit."""
    spark, folder = df.sparkSession, uuid.uuid4().hex
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    rows.withColumn("log_line", F.monotonically_increasing_id()).write.parquet(f"{path}/rows/{folder}")
    n = spark.read.parquet(f"{path}/rows/{folder}").count()
    names = _names(spark, f"{path}/commits")
    number = int(names[-1].removesuffix(".json")) + 1 if names else 0
    while not put_if_absent(spark, _commit_file(path, number), json.dumps({"number": number, "folder": folder, "rows": n})):
        number += 1
    return number


def commits(spark: SparkSession, path: str, after: int = -1, upto: int | None = None) -> list[dict]:
    """The commits of a log in order: a few numbers for each."""
    names = [n for n in _names(spark, f"{path}/commits") if int(n.removesuffix(".json")) > after and (upto is None or int(n.removesuffix(".json")) <= upto)]
    if not names:
        return []
    found = spark.read.schema(_COMMIT).json([f"{path}/commits/{n}" for n in names])
    return sorted((r.asDict() for r in found.collect()), key=lambda c: c["number"])


def _numbered(spark: SparkSession, path: str, chosen: list[dict]) -> DataFrame:
    """The rows of some commits with their order."""
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    df = spark.read.option("mergeSchema", True).parquet(*(f"{path}/rows/{c['folder']}" for c in chosen))
    number = F.broadcast(spark.createDataFrame([(c["folder"], c["number"]) for c in chosen], "__folder string, __number long"))
    at = F.concat_ws(":", _place(F.col("__number")), _place(F.col("log_line")))
    return df.withColumn("__folder", folder).join(number, "__folder").withColumn(ORDINAL, at).drop("__folder", "__number", "log_line")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their order in the column ``log_at``."""
    snapshots = _names(spark, f"{path}/snapshots")
    upto = int(snapshots[-1]) if snapshots else -1
    later = commits(spark, path, after=upto)
    parts = [spark.read.parquet(f"{path}/snapshots/{snapshots[-1]}")] if snapshots else []
    parts += [_numbered(spark, path, later)] if later else []
    if not parts:
        raise ContractError([("log", 1, [f"no commit in {path}"])])
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def compact(spark: SparkSession, path: str) -> int:
    """Join all commits so far into a snapshot, in which rows keep their order; the last commit in it.

    Nothing is deleted: readers and streams that have begun go on with what they listed.
    """
    last = commits(spark, path)[-1]["number"]
    chosen = commits(spark, path, upto=last)
    draft = f"{path}/drafts/{uuid.uuid4().hex}"
    _numbered(spark, path, chosen).repartitionByRange(ORDINAL).sortWithinPartitions(ORDINAL).write.parquet(draft)
    fs, target = _file_system(spark, f"{path}/snapshots/{last:020d}")
    fs.mkdirs(target.getParent())
    if not fs.exists(target) and not fs.rename(_file_system(spark, draft)[1], target):
        raise ContractError([("compact", 1, [str(target)])])
    return last


def stream(spark: SparkSession, path: str, publish: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Call ``publish`` with the rows of new commits, ``log_at`` included, batch by batch."""

    def batch(new: DataFrame, number: int) -> None:
        chosen = sorted((r.asDict() for r in new.collect()), key=lambda c: c["number"])  # a row for each new commit
        if chosen:
            publish(_numbered(spark, path, chosen), number)

    source = spark.readStream.schema(StructType.fromDDL(_COMMIT)).json(f"{path}/commits")
    writer = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
