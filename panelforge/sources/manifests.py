"""Manifests: what a set of derived tables holds, recomputed and compared instead of trusted.

A table's digest does not depend on the order of its rows or on its files, since several tasks write it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import multiset_digest
from ..operators.contracts import SCHEMA, ContractError
from ..operators.sets import multiset_difference

MANIFEST = "name string, rows long, digest string, schema string"


def table_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, rows, digest, schema) of every table, each from one pass."""

    def one(name: str, df: DataFrame) -> DataFrame:
        return multiset_digest(df).select(F.lit(name).alias("name"), F.col("n").alias("rows"), "digest", F.lit(df.schema.simpleString()).alias("schema"))

    return reduce(DataFrame.unionAll, (one(n, df) for n, df in tables.items()))


def audits_differ(name: str, declared: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Rows of an audit that only the manifest or only the data have, as violations."""
    found = multiset_difference(declared.select(*sorted(recomputed.columns)), recomputed.select(*sorted(recomputed.columns)))
    cells = F.to_json(F.struct(*sorted(recomputed.columns)))
    side = F.when(F.col("side") == "left", "declared only").otherwise("recomputed only")
    return found.select(F.lit(f"audit {name}").alias("rule"), cells.alias("key"), side.alias("detail"))


def require_manifest(tables: dict[str, DataFrame], declared: DataFrame) -> None:
    """Raise unless all tables have the declared rows, digests and schemas."""
    bad = audits_differ("tables", declared, table_manifest(tables))
    if rows := bad.limit(5).collect():
        raise ContractError([("manifest", len(rows), [f"{r['key']} {r['detail']}" for r in rows])])


def empty(spark) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
