"""Versions of a table, compared by a tree of hash sums instead of by their rows.

Each row has a SHA-256; its first two bytes are the row's leaf among 65,536, the first one its branch among 256. A tree
holds for every leaf the number of rows and the sums of their hashes, so it is of fixed size whatever the table's.
Versions are stored by branch and sorted by leaf: two of them are compared by 256 sums, then by the leaves of branches
that differ, and only those branches' files are read to find the rows that changed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import hash_sums, row_hash

BRANCH, LEAF, HASH = "__branch", "__leaf", "__hash"
_SUMS = ["s0", "s1", "s2", "s3"]


def hashed(df: DataFrame) -> DataFrame:
    """``df`` with the hash, leaf and branch of each row."""
    out = df.withColumn(HASH, row_hash(sorted(df.columns)))
    out = out.withColumn(LEAF, F.conv(F.substring(HASH, 1, 4), 16, 10).cast("int"))
    return out.withColumn(BRANCH, F.shiftright(LEAF, 8))


def tree(rows: DataFrame) -> DataFrame:
    """(branch, leaf, n, sums) of hashed rows: 65,536 rows at most."""
    return rows.groupBy(BRANCH, LEAF).agg(F.count("*").alias("n"), *(s.alias(name) for s, name in zip(hash_sums(HASH), _SUMS)))


def store(df: DataFrame, path: str) -> None:
    """Write a version: rows by branch, sorted by leaf, and their tree.

    Rows are dealt by ranges of leaves, so a branch of any size is many tasks and a task writes few branches."""
    rows = hashed(df).repartitionByRange(LEAF).sortWithinPartitions(LEAF)
    rows.write.partitionBy(BRANCH).parquet(f"{path}/rows")
    hashed(df).limit(0).write.parquet(f"{path}/columns")  # the columns of a version without rows are known too
    tree(_rows(df.sparkSession, path)).coalesce(1).write.parquet(f"{path}/tree")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def load(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a version."""
    return _rows(spark, path).drop(HASH, LEAF, BRANCH)


def _differ(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Keys of two sets of sums that are not the same on both sides."""
    values = ["n", *_SUMS]
    theirs = b.select(*key, *(F.col(v).alias(f"b_{v}") for v in values))
    same = reduce(lambda x, v: x & F.col(v).eqNullSafe(F.col(f"b_{v}")), values, F.lit(True))
    return a.select(*key, *values).join(theirs, key, "full_outer").where(~same).select(*key)


def differing_leaves(a: DataFrame, b: DataFrame) -> tuple[list[int], DataFrame]:
    """The branches of two trees that differ (256 at most), and the leaves (branch, leaf) that differ in these."""

    def sums(t: DataFrame) -> DataFrame:
        return t.groupBy(BRANCH).agg(*(F.sum(v).alias(v) for v in ("n", *_SUMS)))

    branches = sorted(r[0] for r in _differ(sums(a), sums(b), [BRANCH]).collect())
    leaves = _differ(a.where(F.col(BRANCH).isin(branches)), b.where(F.col(BRANCH).isin(branches)), [BRANCH, LEAF])
    return branches, leaves


@dataclass
class Comparison:
    """``rows``: the rows of which one version has more, with ``change``, how many more the later one has (negative: the
    earlier one). ``branches``: what was read for that."""

    rows: DataFrame
    branches: list[int]


def compare(spark: SparkSession, earlier: str, later: str) -> Comparison:
    """The exact difference of two stored versions with the same columns, reading only what differs."""
    trees = [spark.read.parquet(f"{p}/tree") for p in (earlier, later)]
    branches, leaves = differing_leaves(*trees)
    few = F.broadcast(leaves)  # 65,536 pairs of numbers at most
    sides = []
    for path, sign in ((earlier, -1), (later, 1)):
        rows = _rows(spark, path).where(F.col(BRANCH).isin(branches))
        sides.append(rows.join(few, [BRANCH, LEAF], "left_semi").withColumn("__sign", F.lit(sign).cast("long")))
    columns = [c for c in sides[0].columns if c not in (HASH, LEAF, BRANCH, "__sign")]
    both = sides[0].unionByName(sides[1]).groupBy(HASH).agg(F.sum("__sign").alias("change"), F.any_value(F.struct(*columns)).alias("__row"))
    return Comparison(both.where("change <> 0").select("__row.*", "change"), branches)
