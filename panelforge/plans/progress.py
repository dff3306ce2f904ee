"""Progress and coverage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import statuses, windows

UNKNOWN = "(unknown)"


def latest(log: DataFrame, key: list[str], ordinal: str = "ordinal", place: str = "block_dir", year: str | None = None) -> DataFrame:
    """The last row of each block with its progress bucket; rows without a place do not count."""
    rows = log.where(F.col("year") == year) if year else log
    return windows.latest_log(rows, key, ordinal, place, keep_blank=False).withColumn("bucket", statuses.bucket("status", statuses.LOG_BUCKETS))


def totals(found: DataFrame) -> DataFrame:
    """Blocks per bucket, ``other`` included."""
    return found.groupBy("bucket").agg(F.count("*").alias("blocks"))


def state_coverage(found: DataFrame, group: str = "state") -> DataFrame:
    """success, no_data, failed and total per group over blocks with a known bucket."""
    rows = found.where("bucket <> 'other'")
    counted = [F.count_if(F.col("bucket") == b).alias(b) for b in ("success", "no_data", "failed")]
    return rows.groupBy(group).agg(*counted, F.count("*").alias("total"))


def failed_by_group(found: DataFrame, group: str = "state", label: str = "block", k: int = 3) -> DataFrame:
    """Failed blocks per group with the first ``k`` and how many more."""
    return windows.top_examples(found.where("bucket = 'failed'"), [group], [label], label, k)


def state_summary(blocks: DataFrame) -> DataFrame:
    """Per year and state: blocks by outcome, units and the mean measure of blocks with data.

    ``blocks`` has year, state, district, status, units, measure_sum, measure_n; a missing state is unknown and not
    listed. A status outside all buckets still makes its state appear.
    """
    rows = blocks.withColumns({"state": F.coalesce("state", F.lit(UNKNOWN)), "bucket": statuses.bucket("status", statuses.FILE_BUCKETS)}).where(F.col("state") != UNKNOWN)
    data = F.col("bucket") == "with_data"
    rows = rows.withColumns({c: F.when(data, F.col(c)) for c in ("units", "measure_sum", "measure_n")})
    buckets = {"blocks_with_data": data, "blocks_no_data": F.col("bucket").isin("no_data", "empty"), "blocks_failed": F.col("bucket") == "failed"}
    return agg.group_summary(rows, ["year", "state"], buckets, ["units"], "measure_sum", "measure_n")


def year_summary(blocks: DataFrame) -> DataFrame:
    """Per year: states, states with data, sums over states, and distinct districts (of unknown states too)."""
    counted = ["blocks_with_data", "blocks_no_data", "blocks_failed", "units"]
    years = agg.vintage_summary(state_summary(blocks), "year", counted, F.col("blocks_with_data") > 0)
    place = F.struct(F.coalesce("state", F.lit(UNKNOWN)), "district")
    districts = blocks.where(F.coalesce("district", F.lit("")) != "").groupBy("year").agg(F.count_distinct(place).alias("districts"))
    years = years.withColumnsRenamed({"groups": "states_total", "groups_with_data": "states_with_data"})
    return years.join(districts, "year", "left").na.fill(0, ["districts"])


def inspection(df: DataFrame, columns: list[str], group: str, k: int = 15) -> tuple[DataFrame, DataFrame]:
    """Value counts of some columns and the ``k`` largest groups, ties by name."""
    largest = df.groupBy(group).agg(F.count("*").alias("n")).orderBy(F.desc("n"), group).limit(k)
    return agg.value_counts(df, columns), largest
