"""Data contracts: a contract is a DataFrame of violations (rule, key, detail); an empty one is a contract kept.

Contracts are lazy and can be stored, joined or shown. ``row_rules`` tests many rules of a row in one pass. ``enforce``
writes what several contracts find once and raises with the count and a few examples of every rule that is broken.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import is_blank
from ..sources.shared import shared_folder

SCHEMA = "rule string, key string, detail string"


class ContractError(ValueError):
    """Some contract does not hold."""

    def __init__(self, broken: list[tuple[str, int, list[str]]]):
        self.broken = broken
        super().__init__("; ".join(f"{rule}: {n} ({', '.join(examples)})" for rule, n, examples in broken))


def key_text(columns: list[str]) -> Column:
    """A key as one text, parts separated by '|', nulls shown."""
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in columns))


def violations(df: DataFrame, rule: str, broken: Column, key: list[str], detail: Column | str = "") -> DataFrame:
    """Rows of ``df`` for which ``broken`` holds (null counts as broken)."""
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return df.where(F.coalesce(broken, F.lit(True))).select(F.lit(rule).alias("rule"), key_text(key).alias("key"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))


def union(*contracts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, contracts)


def examples(found: DataFrame, n: int = 5) -> DataFrame:
    """(rule, n, examples): how often each rule is broken, with its first keys.

    The rank keeps the first ``n`` keys of a rule; Spark filters by rank before its shuffle, so a rule that is broken
    by most rows is not gathered in one task.
    """
    counts = found.groupBy("rule").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("rule").orderBy("key", "detail"))
    first = found.withColumn("rank", rank).where(F.col("rank") <= n)
    shown = first.groupBy("rule").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "key", "detail"))), lambda x: F.concat_ws(" ", x["key"], x["detail"])).alias("examples"))
    return counts.join(shown, "rule")


def enforce(*contracts: DataFrame, n: int = 5) -> None:
    """Raise ``ContractError`` if any contract is broken. What they find is written once to the shared folder."""
    found = union(*contracts)
    spark = found.sparkSession
    path = shared_folder(spark, "violations")
    found.write.parquet(path)
    broken = examples(spark.read.schema(found.schema).parquet(path), n).orderBy("rule").collect()  # one row per rule
    if broken:
        raise ContractError([tuple(r) for r in broken])


def row_rules(df: DataFrame, key: list[str], rules: list[tuple[str, Column, Column | str]]) -> DataFrame:
    """Violations of several (rule, broken, detail) that look at one row each; null counts as broken. One pass over ``df``."""
    texts = [(rule, broken, F.lit(d) if isinstance(d, str) else d) for rule, broken, d in rules]
    hits = [F.when(F.coalesce(broken, F.lit(True)), F.struct(F.lit(rule).alias("rule"), F.coalesce(d.cast("string"), F.lit("")).alias("detail"))) for rule, broken, d in texts]
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    return df.select(key_text(key).alias("key"), F.explode(found).alias("hit")).select("hit.rule", "key", "hit.detail")


# ---- schema


def schema_differences(actual: StructType, declared: StructType, nullability: bool = True) -> list[str]:
    """How a schema differs from the declared one in names, order, types and, if asked, nullability."""

    def shape(s: StructType) -> list[tuple]:
        return [(f.name, f.dataType.simpleString(), f.nullable if nullability else None) for f in s.fields]

    a, b = shape(actual), shape(declared)
    if a == b:
        return []
    out = [f"missing {x[0]}" for x in b if x[0] not in {y[0] for y in a}]
    out += [f"unexpected {x[0]}" for x in a if x[0] not in {y[0] for y in b}]
    types = {x[0]: x for x in b}
    out += [f"{x[0]} is {x[1:]}, declared {types[x[0]][1:]}" for x in a if x[0] in types and x != types[x[0]]]
    return out or ["columns are in another order"]


def schema_violations(df: DataFrame, declared: StructType, exact: bool = True, rule: str = "schema") -> DataFrame:
    """How the schema of ``df`` differs from the declared one, as violations; if not ``exact``, other columns and another
    order are tolerated."""
    if exact:
        found = schema_differences(df.schema, declared, nullability=False)
    else:
        types = dict(df.dtypes)
        found = [f"missing {f.name}" if f.name not in types else f"{f.name} is {types[f.name]}" for f in declared.fields if types.get(f.name) != f.dataType.simpleString()]
    return df.sparkSession.createDataFrame([(rule, "", x) for x in found], SCHEMA)


def require_schema(df: DataFrame, declared: StructType, nullability: bool = False) -> DataFrame:
    """``df`` if it has exactly the declared schema. Parquet reads are always nullable, so that is compared on request."""
    found = schema_differences(df.schema, declared, nullability)
    if found:
        raise ContractError([("schema", len(found), found[:5])])
    return df


def require_columns(df: DataFrame, declared: StructType) -> DataFrame:
    """``df`` if it has at least the declared columns with their types."""
    types = dict(df.dtypes)
    found = [f.name for f in declared.fields if types.get(f.name) != f.dataType.simpleString()]
    if found:
        raise ContractError([("columns", len(found), found[:5])])
    return df


def coerced(df: DataFrame, declared: StructType) -> tuple[DataFrame, DataFrame]:
    """``df`` cast to the declared types, and the violations: values that are not blank and do not cast.

    String columns keep missing values as empty strings, numeric columns as null.
    """
    out, bad = [], []
    for f in declared.fields:
        kind = f.dataType.simpleString()
        if kind == "string":
            out.append(F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(f.name))
        else:
            value = F.col(f.name).try_cast(f.dataType)
            out.append(value.alias(f.name))
            bad.append(F.when(~is_blank(f.name) & value.isNull(), F.lit(f.name)))
    wrong = F.filter(F.array(*bad) if bad else F.array().cast("array<string>"), lambda x: x.isNotNull())
    key = [f.name for f in declared.fields][:2]
    return df.select(*out), violations(df, "coercion", F.size(wrong) > 0, key, F.array_join(wrong, ","))


# ---- values


def _named(conditions: list[Column]) -> Column:
    """The entries that are not null as one text."""
    return F.array_join(F.filter(F.array(*conditions), lambda x: x.isNotNull()), ",")


def blank_names(columns: list[str]) -> Column:
    """The names of the blank ones of ``columns``; empty if there is none."""
    return _named([F.when(is_blank(c), F.lit(c)) for c in columns])


def not_blank(df: DataFrame, columns: list[str], key: list[str], rule: str = "blank") -> DataFrame:
    """Rows with a blank value in any of ``columns``."""
    return violations(df, rule, blank_names(columns) != "", key, blank_names(columns))


def out_of_range(columns: list[str], low: float = 0.0, high: float = 100.0, nulls: bool = True) -> Column:
    """The values of ``columns`` that are NaN, infinite or outside the bounds, as name=value; null only counts if
    ``nulls`` is false. Empty if there is none."""

    def bad(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(v.isNull(), F.lit(not nulls)).otherwise(F.isnan(v) | (v < low) | (v > high))

    return _named([F.when(bad(c), F.concat(F.lit(c + "="), F.coalesce(F.col(c).cast("string"), F.lit("null")))) for c in columns])


def in_range(df: DataFrame, columns: list[str], key: list[str], low: float = 0.0, high: float = 100.0, nulls: bool = True, rule: str = "range") -> DataFrame:
    """Rows with a value that is NaN, infinite or outside the bounds; null only counts if ``nulls`` is false."""
    wrong = out_of_range(columns, low, high, nulls)
    return violations(df, rule, wrong != "", key, wrong)


def in_domain(df: DataFrame, column: str, domain: list, key: list[str], rule: str = "domain") -> DataFrame:
    """Rows whose value is not in ``domain``; null is not."""
    return violations(df, rule, ~F.coalesce(F.col(column).isin(domain), F.lit(False)), key, F.col(column))


def functional(df: DataFrame, determinant: list[str], dependent: list[str], rule: str = "functional") -> DataFrame:
    """Determinants with more than one combination of dependent values."""
    pairs = df.select(*determinant, *dependent).distinct()
    return violations(pairs.groupBy(*determinant).agg(F.count("*").alias("n")), rule, F.col("n") > 1, determinant, F.col("n"))


def required_when(df: DataFrame, condition: Column, required: Column, key: list[str], rule: str) -> DataFrame:
    """Rows where ``condition`` holds and ``required`` does not."""
    return violations(df, rule, F.coalesce(condition, F.lit(False)) & ~F.coalesce(required, F.lit(False)), key)


# ---- keys and counts


def unique_key(df: DataFrame, key: list[str], rule: str = "duplicate key") -> DataFrame:
    """Keys that occur more than once."""
    return violations(df.groupBy(*key).agg(F.count("*").alias("n")), rule, F.col("n") > 1, key, F.col("n"))


def conserved(counts: DataFrame, left: str, right: str, factor: int = 1, rule: str = "row conservation") -> DataFrame:
    """``counts`` (one row) must have ``left`` = ``factor`` x ``right``."""
    return violations(counts, rule, F.col(left) != F.col(right) * factor, [left, right])


def group_contract(df: DataFrame, key: list[str], member: str, members: list, order: str | None = None, special: Column | None = None, rule: str = "group") -> DataFrame:
    """Groups that do not hold each of ``members`` exactly once, unique orders, and exactly one ``special`` row."""
    aggregates = [F.count("*").alias("n"), F.array_sort(F.collect_set(member)).alias("members")]
    aggregates += [F.count_distinct(order).alias("orders")] if order else []
    aggregates += [F.count_if(special).alias("specials")] if special is not None else []
    bad = (F.col("n") != len(members)) | (F.col("members") != F.array_sort(F.array(*map(F.lit, members))))
    if order:
        bad |= F.col("orders") != len(members)
    if special is not None:
        bad |= F.col("specials") != 1
    return violations(df.groupBy(*key).agg(*aggregates), rule, bad, key, F.concat(F.lit("rows="), F.col("n")))


def holds(spark, condition: bool, rule: str, detail: str = "") -> DataFrame:
    """A contract on a single fact known to the driver."""
    return spark.createDataFrame([] if condition else [(rule, "", detail)], SCHEMA)
