"""Set operations on tables, with multiplicity where that matters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concatenated(*tables: DataFrame) -> DataFrame:
    """All rows; columns that a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def difference(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(*key).distinct().join(right.select(*key), key, "left_anti")


def shared(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    return left.select(*key).intersect(right.select(*key))


def two_sided(observed: DataFrame, configured: DataFrame, key: list[str]) -> DataFrame:
    """Keys that only one side has: key, side."""
    a = observed.select(*key).distinct().withColumn("__a", F.lit(True))
    b = configured.select(*key).distinct().withColumn("__b", F.lit(True))
    side = F.when(F.col("__b").isNull(), "observed only").when(F.col("__a").isNull(), "configured only")
    return a.join(b, key, "full_outer").withColumn("side", side).where("side is not null").drop("__a", "__b")


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (with multiplicity) that only one side has, with the side."""
    right = right.select(*left.columns)
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionAll(right.exceptAll(left).withColumn("side", F.lit("right")))


def same_multiset(left: DataFrame, right: DataFrame) -> bool:
    return multiset_difference(left, right).isEmpty()
