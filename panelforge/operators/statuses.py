"""Status vocabularies, work-list decisions and the verdict on a block's units.

The three vocabularies differ on purpose: a finished block without rows has no data for a progress report, and is a
success for coverage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from .aggregates import block_differences
from .contracts import violations

# Statuses by vocabulary.
#: Statuses in a block's own status file.
FILE_BUCKETS = {
    "with_data": ["done"],
    "no_data": ["done_no_data_available"],
    "empty": ["done_no_rows"],
    "failed": ["failed", "state_page_load_failed", "year_page_load_failed", "year_crashed"],
}
#: Statuses of the run log, for progress.
LOG_BUCKETS = {
    "success": ["done", "skipped_done"],
    "no_data": ["done_no_data_available", "done_no_rows", "skipped_no_data"],
    "failed": ["failed", "state_page_load_failed", "year_page_load_failed", "year_crashed"],
}
#: Statuses of the run log that count as an outcome, for coverage.
SUCCESS = ["done", "done_no_data_available", "done_no_rows", "skipped_done", "skipped_no_data"]
NO_DATA = "done_no_data_available"


def bucket(status: str | Column, buckets: dict[str, list[str]], other: str = "other") -> Column:
    """The bucket of a status."""
    status = F.col(status) if isinstance(status, str) else status
    out = None
    for name, members in buckets.items():
        out = F.when(status.isin(members), name) if out is None else out.when(status.isin(members), name)
    return out.otherwise(other)


#: Texts and values of options that stand for no choice.
NO_CHOICE_TEXTS = ("-select-", "- select -", "- चुनें -", "लोडिंग", "loading", "चुनें")
NO_CHOICE_VALUES = ("", "0", "-1")


def options_kept(options: DataFrame, label: str, value: str, contains: str | None = None, values: list[str] | None = None) -> DataFrame:
    """Options that are a choice, contain a text whatever its case, and have one of ``values``."""
    text, code = F.coalesce(strip(label), F.lit("")), F.coalesce(strip(value), F.lit(""))
    choice = (text != "") & ~code.isin(list(NO_CHOICE_VALUES))
    for no_choice in NO_CHOICE_TEXTS:
        choice &= ~F.lower(text).contains(no_choice)
    out = options.where(choice)
    if contains:
        out = out.where(F.lower(label).contains(contains.lower()))
    return out.where(F.col(value).isin(values)) if values else out


def drop_unvalidated(rows: DataFrame, controls: DataFrame, vintage: str, group: str) -> tuple[DataFrame, DataFrame]:
    """Rows of groups that a controlled vintage does not list are dropped; vintages without controls keep all.

    Also gives (vintage, group, n) of what was dropped.
    """
    listed = controls.select(vintage, group).distinct().withColumn("__listed", F.lit(True))
    controlled = controls.select(vintage).distinct().withColumn("__controlled", F.lit(True))
    joined = rows.join(controlled, vintage, "left").join(listed, [vintage, group], "left")
    keep = F.col("__controlled").isNull() | F.col("__listed").isNotNull()
    dropped = joined.where(~keep).groupBy(vintage, group).agg(F.count("*").alias("n"))
    return joined.where(keep).drop("__listed", "__controlled").select(*rows.columns), dropped


@dataclass(frozen=True)
class WorkOptions:
    """What a work list redoes."""

    overwrite: bool = False
    retry_no_data: bool = False
    retry_empty: bool = False
    no_data_confirmations: int = 1
    completeness_confirmations: int = 1


def work_list(blocks: DataFrame, options: WorkOptions) -> DataFrame:
    """``blocks`` with ``decision``: collect, redo, skip_no_data or skip_done.

    Needs status (null if unfinished), n_rows, confirmations, cache_valid, re_verified.
    """
    no_data = F.col("status") == NO_DATA
    required = F.when(no_data, 1 + options.no_data_confirmations).otherwise(1 + options.completeness_confirmations)
    settled = (F.coalesce("confirmations", F.lit(0)) >= required) & F.coalesce("cache_valid", F.lit(False))
    decision = (
        F.when(F.lit(options.overwrite) | F.col("status").isNull() | ~settled, "collect")
        .when(no_data & F.lit(options.retry_no_data) & ~F.coalesce("re_verified", F.lit(False)), "redo")
        .when(no_data, "skip_no_data")
        .when((F.coalesce("n_rows", F.lit(0)) > 0) | F.lit(not options.retry_empty), "skip_done")
        .otherwise("redo")
    )
    return blocks.withColumn("decision", decision)


def unit_verdicts(universe: DataFrame, scores: DataFrame, block: list[str], code: str, allowed: DataFrame, subset_blocks: DataFrame, confirmed: DataFrame | None = None) -> DataFrame:
    """For each block, how its scored units compare with the universe.

    ``allowed`` (block, codes array) holds reviewed missing units; ``subset_blocks`` (block) the blocks of groups that
    may be scored in part; ``confirmed`` (block) those whose empty result was confirmed. Gives block, missing,
    unexpected, verdict; a verdict that starts with "error" is a violation. Codes are compared by sums of hashes, and
    looked at one by one for blocks that differ only; of these the codes of one side alone are an array.
    """
    none = F.array().cast("array<string>")
    joined = block_differences(universe, scores, block, code)
    joined = joined.join(allowed.select(*block, F.col("codes").alias("__a")), block, "left")
    joined = joined.join(subset_blocks.select(*block).distinct().withColumn("__subset", F.lit(True)), block, "left")
    if confirmed is not None:
        joined = joined.join(confirmed.select(*block).distinct().withColumn("__confirmed", F.lit(True)), block, "left")
    else:
        joined = joined.withColumn("__confirmed", F.lit(False))
    missing, unexpected, reviewed = (F.coalesce(c, none) for c in ("missing", "unexpected", "__a"))
    joined = joined.withColumns({"missing": missing, "unexpected": unexpected, "__a": F.array_sort(F.array_distinct(reviewed)), "__empty": F.col("n_live") == 0})
    some, differs = F.size("missing") > 0, F.col("missing") != F.col("__a")
    subset = F.coalesce("__subset", F.lit(False)) & some & differs
    verdict = (
        F.when(F.size("unexpected") > 0, "error: unexpected units")
        .when(subset & F.col("__empty") & ~F.coalesce("__confirmed", F.lit(False)), "error: unconfirmed absence")
        .when(subset, "subset_in_partially_scored_state")
        .when(differs, "error: missing units or stale exception")
        .when(some, "reviewed_exception")
        .otherwise("exact_universe_match")
    )
    return joined.select(*block, "missing", "unexpected", verdict.alias("verdict"))


def verdict_violations(verdicts: DataFrame, block: list[str]) -> DataFrame:
    return violations(verdicts, "units", F.col("verdict").startswith("error"), block, F.col("verdict"))
