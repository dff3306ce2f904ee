"""Helpers that the training-data operators share: table access, shared-folder tables, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in an Arrow batch sent to Python: whole texts can be long, so batches stay far below Spark's defaults.
BATCH_ROWS, BATCH_BYTES = 512, 16 << 20
#: Settings with Spark's default for them and the value that takes its place.
_BATCH_SETTINGS = (
    ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", str(BATCH_ROWS)),
    ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", str(BATCH_BYTES)),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def bucket(column: str | Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus``; null ids count as the text 'null'."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(value.cast("string"), F.lit("null")).cast("binary")) % modulus


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors and the driver share.

    It is the session's ``spark.checkpoint.dir``. Only where that is unset, as in tests on one machine, a fresh
    temporary folder is made and set for this context.
    """
    context = spark.sparkContext
    stated = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = stated or _own_folder.get(context.applicationId)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        folder = _own_folder[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


_own_folder: dict[str, str] = {}


#: Tables made by ``written`` and not deleted yet, in the scopes that are open; the first scope is the application's.
_made: list[list[DataFrame]] = [[]]


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    _made[-1].append(out)
    return out


def drop_written(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing will read again."""
    path = getattr(df, "_written_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
        for scope in _made:
            scope[:] = [x for x in scope if x is not df]


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], None]]:
    """Delete at the end what ``written`` makes inside, but for the tables given to the function that it yields."""
    held: list[DataFrame] = []
    outer = _made[-1]
    _made.append(held)

    def keep(df: DataFrame) -> None:
        held[:] = [x for x in held if x is not df]
        outer.append(df)

    try:
        yield keep
    finally:
        _made[:] = [x for x in _made if x is not held]
        for df in held:
            drop_written(df)


def drop_all_written() -> None:
    """Delete every table that is left. Results of this subpackage are lazy and read such tables, so call it when they
    have been used."""
    for scope in _made:
        for df in list(scope):
            drop_written(df)


#: Rows of a few numbers or a short key that are broadcast at most; larger tables are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(keys: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``keys``, rows of bounded width, with a hint to broadcast them if they are counted to be few."""
    return F.broadcast(keys) if keys.limit(most_rows + 1).count() <= most_rows else keys


def fresh(name: str) -> str:
    """A column name that no table has."""
    return f"__{name}_{uuid.uuid4().hex}"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; the session's Arrow batches from here on hold few rows and bytes.

    Spark reads these settings when a plan runs, so they stay set for the session. A value that differs from Spark's
    default is the user's and is left alone.
    """
    conf = df.sparkSession.conf
    for name, default, value in _BATCH_SETTINGS:
        if conf.get(name, default) == default:
            conf.set(name, value)
    return df


def in_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with small batches, so that long texts do not fill a worker's memory."""
    return small_batches(df).mapInArrow(function, schema)


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of ``path``: one without a scheme is on the session's default file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def slices(texts: list[str], most_chars: int) -> Iterable[tuple[int, int]]:
    """Consecutive ranges of ``texts`` with at most ``most_chars`` characters each; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > most_chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
