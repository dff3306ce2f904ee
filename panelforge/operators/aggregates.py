"""Coverage, control and summary aggregates. All are hash aggregates with a partial step before their shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import mean_2

#: How the national level is named in controls.
TOTAL = "__total__"


def coverage(panel: DataFrame, by: list[str], flag: str = "score_available") -> DataFrame:
    """universe, scored and unscored units for each combination of ``by``."""
    return panel.groupBy(*by).agg(F.count("*").alias("universe"), F.count_if(flag).alias("scored"), F.count_if(~F.col(flag)).alias("unscored"))


def coverage_with_label(panel: DataFrame, by: list[str], label: str, order: list[str], flag: str = "score_available") -> DataFrame:
    """Coverage with the label of the first row in the order of ``order``."""
    first = F.min_by(label, F.struct(*order)).alias(label)
    return panel.groupBy(*by).agg(first, F.count("*").alias("universe"), F.count_if(flag).alias("scored"), F.count_if(~F.col(flag)).alias("unscored"))


def counts_with_total(df: DataFrame, vintage: str, group: str) -> DataFrame:
    """(vintage, group, n) with one more row per vintage for all groups together, named ``TOTAL``; one pass."""
    sets = df.groupingSets([[vintage, group], [vintage]], vintage, group).agg(F.count("*").alias("n"), F.grouping(group).alias("__all"))
    return sets.select(vintage, F.when(F.col("__all") == 1, TOTAL).otherwise(F.col(group).cast("string")).alias(group), "n")


def fold_back(counts: DataFrame, corrections: DataFrame, vintage: str, group: str, from_col: str, to_col: str) -> DataFrame:
    """Counts with every correction moved from one group to another; a group that ends at zero stays a row."""
    minus = corrections.select(vintage, F.col(from_col).alias(group), F.lit(-1).cast("long").alias("n"))
    plus = corrections.select(vintage, F.col(to_col).alias(group), F.lit(1).cast("long").alias("n"))
    return counts.select(vintage, group, "n").unionAll(minus).unionAll(plus).groupBy(vintage, group).agg(F.sum("n").alias("n"))


def group_summary(blocks: DataFrame, by: list[str], buckets: dict[str, Column], sums: list[str], total: str, n: str) -> DataFrame:
    """Blocks per bucket, sums of counts and the mean of a measure (null-skipping) for each group."""
    aggregates = [F.count_if(c).alias(name) for name, c in buckets.items()] + [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    return blocks.groupBy(*by).agg(*aggregates, mean_2(F.sum(total), F.sum(n)).alias("mean"))


def vintage_summary(groups: DataFrame, vintage: str, sums: list[str], with_data: Column) -> DataFrame:
    """Second level over ``group_summary``: groups, groups with data and sums for each vintage."""
    return groups.groupBy(vintage).agg(F.count("*").alias("groups"), F.count_if(with_data).alias("groups_with_data"), *(F.sum(c).alias(c) for c in sums))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of every table."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionAll, parts).groupBy().pivot("name", list(tables)).agg(F.first("n"))


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for every value of every column, in one pass."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    return df.select(cells.alias("cell")).groupBy("cell.column", "cell.value").agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, rows: list[str], column: str, values: list[str]) -> DataFrame:
    """Counts of ``rows`` x ``values``, zero where there is none."""
    return df.groupBy(*rows).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0, values)


def level_counts(units: DataFrame, vintage: str, levels: dict[str, list[str]], by: list[str] | None = None) -> DataFrame:
    """Distinct members of each level (a level is named by all ids above it) for each vintage, or finer by ``by``.

    Levels whose ids contain one another, as those of a hierarchy do, are counted from the finest up: rows become
    distinct members of the finest level once, and each coarser level groups the one below, carrying its counts along.
    So each level is one shuffle of its own size, and no row is multiplied by the number of levels.
    """
    group = [vintage, *(by or [])]
    chain = sorted(levels, key=lambda name: len(levels[name]), reverse=True)
    nested = all(set(levels[above]) <= set(levels[below]) for below, above in zip(chain, chain[1:]))
    if not nested:
        return units.groupBy(*group).agg(*(F.count_distinct(F.struct(*ids)).alias(name) for name, ids in levels.items()))
    out, carried = units, []
    for below, name in zip([None, *chain], chain):
        keys = list(dict.fromkeys([*group, *levels[name]]))
        counts = [F.sum(f"n_{c}").alias(f"n_{c}") for c in carried] + ([F.count("*").alias(f"n_{below}")] if below else [])
        out = out.groupBy(*keys).agg(*counts) if counts else out.select(*keys).distinct()
        carried += [below] if below else []
    totals = [F.sum(f"n_{c}").alias(c) for c in carried] + [F.count("*").alias(chain[-1])]
    return out.groupBy(*group).agg(*totals).select(*group, *levels)


def against_published(counts: DataFrame, controls: DataFrame, key: list[str], column: str) -> DataFrame:
    """Hierarchy counts with what is published and the difference."""
    published = controls.select(*key, F.col("n").alias("published"))
    return counts.join(published, key, "left").withColumn("hierarchy_minus_published", F.col(column) - F.col("published"))


def partially_scored(compared: DataFrame, column: str) -> DataFrame:
    """Groups of which some units are published and some are not."""
    return compared.where((F.col("published") > 0) & (F.col("published") < F.col(column)))


def uncontrolled(counts: DataFrame, controls: DataFrame, key: list[str]) -> DataFrame:
    """Groups without a control total."""
    return counts.join(controls.select(*key), key, "left_anti")


def pages_without_grades(rows: DataFrame, page: list[str], is_theme: Column, grade: str) -> DataFrame:
    """Pages with theme scores of which every grade is empty."""
    graded = is_theme & (F.coalesce(F.trim(grade), F.lit("")) != "")
    return rows.groupBy(*page).agg(F.count_if(is_theme).alias("themes"), F.count_if(graded).alias("graded")).where("themes > 0 and graded = 0")


#: Timestamps are hashed in UTC to the microsecond, whatever the session's time zone.
_EXACT = {
    "ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of a row with its column names, types' texts and nulls; null, empty and absent values all differ."""
    return F.sha2(F.to_json(F.struct(*columns), _EXACT), 256)


def hash_sums(hashed: str) -> list[Column]:
    """Sums of row hashes in four parts of 60 bits: they do not depend on the order of rows, and repeated rows count. They
    hold for 10^19 rows."""
    return [F.sum(F.conv(F.substring(hashed, 15 * k + 1, 15), 16, 10).cast("decimal(28,0)")) for k in range(4)]


def _digest(hashed: str) -> Column:
    """The sums as one text; null sums of rows that are there would make it null."""
    first, *rest = (p.cast("string") for p in hash_sums(hashed))
    joined = F.concat(first, *(x for p in rest for x in (F.lit(":"), p)))
    return F.when(F.count("*") == 0, "0:0:0:0").otherwise(joined)


def multiset_digest(df: DataFrame) -> DataFrame:
    """One row (n, digest): a digest of the rows as a multiset, whatever their order or files."""
    rows = df.select(row_hash(sorted(df.columns)).alias("__hash"))
    return rows.agg(F.count("*").alias("n"), _digest("__hash").alias("digest"))


def group_digest(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """A digest of each group's rows as a multiset, without collecting them."""
    rows = df.select(*by, row_hash(columns).alias("__hash"))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), _digest("__hash").alias("digest"))


def block_differences(universe: DataFrame, live: DataFrame, block: list[str], code: str) -> DataFrame:
    """For each block: rows with a code on either side (n_universe, n_live), and arrays of the codes that only one side
    has, null for blocks that do not differ.

    In two phases. First each block's codes are summed up by hash, those of one side counted against those of the other:
    that is one row for each block and task. Only blocks whose sums or counts differ are looked at code by code, so no code
    of an equal block is shuffled or collected. Two 64-bit sums that agree by chance would hide a difference.
    """
    sides = universe.select(*block, F.col(code).cast("string").alias("__code"), F.lit(1).alias("__side"))
    sides = sides.unionAll(live.select(*block, F.col(code).cast("string").alias("__code"), F.lit(-1).alias("__side")))
    there = F.col("__code").isNotNull()
    signed = [F.sum(F.when(there, F.col("__side") * F.xxhash64("__code", F.lit(k)).cast("decimal(28,0)")).otherwise(0)).alias(f"__h{k}") for k in range(2)]
    counts = [F.count_if(there & (F.col("__side") == sign)).alias(name) for name, sign in (("n_universe", 1), ("n_live", -1))]
    sums = sides.groupBy(*block).agg(*counts, *signed)
    differing = sums.where((F.col("n_universe") != F.col("n_live")) | (F.col("__h0") != 0) | (F.col("__h1") != 0))
    rows = sides.where(there).join(differing.select(*block), block, "left_semi")
    only = rows.groupBy(*block, "__code").agg(F.min("__side").alias("low"), F.max("__side").alias("high")).where("low = high")
    lists = [F.array_sort(F.collect_list(F.when(F.col("low") == sign, F.col("__code")))).alias(name) for name, sign in (("missing", 1), ("unexpected", -1))]
    return sums.drop("__h0", "__h1").join(only.groupBy(*block).agg(*lists), block, "left")


def block_audit(universe: DataFrame, live: DataFrame, block: list[str], code: str) -> DataFrame:
    """For each block: universe and live counts of different codes, their difference, and ';'-joined missing and unexpected
    codes, which are collected for blocks that differ only."""
    sides = universe.select(*block, code, F.lit(1).alias("side")).unionAll(live.select(*block, code, F.lit(2).alias("side")))
    both = sides.groupBy(*block, code).agg(F.max((F.col("side") == 1).cast("int")).alias("u"), F.max((F.col("side") == 2).cast("int")).alias("l"))
    counts = both.groupBy(*block).agg(F.sum("u").cast("long").alias("universe"), F.sum("l").cast("long").alias("live"), (F.sum("l") - F.sum("u")).cast("long").alias("delta"))

    def codes(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_list(F.when(condition, F.col(code).cast("string")))), ";")

    lists = both.where("u <> l").groupBy(*block).agg(codes(F.col("u") == 1).alias("missing"), codes(F.col("l") == 1).alias("unexpected"))
    return counts.join(lists, block, "left").na.fill("", ["missing", "unexpected"])


def missing_vintages(df: DataFrame, vintage: str, required: list) -> DataFrame:
    """(vintage, side): required and absent, or present and not required."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(v,) for v in required], f"{vintage} {df.schema[vintage].dataType.simpleString()}")
    seen = df.select(vintage).distinct()
    return wanted.join(seen, vintage, "left_anti").withColumn("side", F.lit("absent")).unionAll(seen.join(wanted, vintage, "left_anti").withColumn("side", F.lit("not required")))
