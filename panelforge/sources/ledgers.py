"""Reviewed ledgers: small tables of evidenced exceptions, each with a row contract of its own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import canonical_id, canonical_score, code_from_url, collapse_space, split_list
from ..operators.contracts import enforce, functional, not_blank, union, unique_key, violations
from .tables import text_csv


@dataclass(frozen=True)
class Ledger:
    """Columns of a ledger, its key, and the columns that must be evidence, hashes, ids or counts (the first above the second)."""

    columns: tuple[str, ...]
    key: tuple[str, ...]
    required: tuple[str, ...]
    hashes: tuple[str, ...] = ()
    ids: tuple[str, ...] = ()
    counts: tuple[str, ...] = ()


#: The column names of the ledger files.
LEDGERS = {
    "score_value_exceptions": Ledger(("year", "gp_code", "theme_slug", "evidence", "source_path", "source_sha256"), ("year", "gp_code", "theme_slug"), ("year", "gp_code", "theme_slug", "evidence", "source_path"), ("source_sha256",), ("gp_code",)),
    "theme_header_links": Ledger(("theme_header", "theme_slug", "language", "evidence"), ("theme_header",), ("theme_header", "theme_slug", "language", "evidence")),
    "gp_score_vector_links": Ledger(
        ("year", "state_value", "district_value", "block_value", "score_gp_name", "score_signature", "gp_code", "scorecard_url", "evidence_url", "retrieved_utc", "source_sha256", "evidence"),
        ("year", "state_value", "district_value", "block_value", "score_gp_name", "score_signature"),
        ("year", "state_value", "district_value", "block_value", "score_gp_name", "gp_code", "scorecard_url", "evidence"),
        ("source_sha256",),
        ("gp_code",),
    ),
    "hierarchy_exclusions": Ledger(("year", "state_value", "district_value", "correct_state_value", "source_sha256", "evidence"), ("year", "state_value", "district_value"), ("year", "state_value", "district_value", "correct_state_value", "evidence"), ("source_sha256",), ("state_value", "district_value", "correct_state_value")),
    "gp_universe_exceptions": Ledger(("year", "state_value", "district_value", "block_value", "allowed_missing_gp_codes", "evidence"), ("year", "state_value", "district_value", "block_value"), ("year", "state_value", "district_value", "block_value", "allowed_missing_gp_codes", "evidence")),
    "official_count_exceptions": Ledger(("year", "state", "official_count", "portal_count", "evidence"), ("year", "state"), ("year", "state", "evidence"), counts=("official_count", "portal_count")),
    "gp_name_links": Ledger(("year", "state_value", "district_value", "block_value", "score_gp_name", "gp_code", "evidence"), ("year", "state_value", "district_value", "block_value", "score_gp_name"), ("year", "score_gp_name", "gp_code", "evidence"), ids=("gp_code",)),
}


def ledger_contract(df: DataFrame, ledger: Ledger, slugs: list[str] | None = None) -> DataFrame:
    """Violations of a ledger: blank evidence, malformed hash, id or count, counts in the wrong order, repeated key, unknown measure."""
    key = list(ledger.key)
    parts = [not_blank(df, list(ledger.required), key, "ledger blank"), unique_key(df, key, "ledger key")]
    parts += [violations(df, "ledger hash", ~F.col(c).rlike("^[0-9a-f]{64}$"), key, F.col(c)) for c in ledger.hashes]
    parts += [violations(df, "ledger id", canonical_id(c).isNull(), key, F.col(c)) for c in ledger.ids]
    if ledger.counts:
        upper, lower = (F.when(F.trim(c).rlike("^[0-9]{1,18}$"), F.trim(c).cast("long")) for c in ledger.counts)
        parts.append(violations(df, "ledger counts", ~(lower < upper), key, F.concat_ws("/", *ledger.counts)))
    if slugs and "theme_slug" in ledger.columns:
        parts.append(violations(df, "ledger measure", ~F.col("theme_slug").isin(slugs), key, F.col("theme_slug")))
    return union(*parts)


def header_contract(df: DataFrame, slugs: list[str]) -> DataFrame:
    """A header dictionary must name a header once (white space collapsed), and cover all measures."""
    rows = df.select(collapse_space("theme_header").alias("theme_header"), "theme_slug")
    wanted = df.sparkSession.createDataFrame([(s,) for s in slugs], "theme_slug string")
    missing = violations(wanted.join(rows, "theme_slug", "left_anti"), "measure without header", F.lit(True), ["theme_slug"])
    twofold = functional(rows, ["theme_header"], ["theme_slug"], "header of two measures")
    return union(unique_key(rows, ["theme_header"], "repeated header"), twofold, missing)


def vector_contract(df: DataFrame, n_scores: int, parameter: str) -> DataFrame:
    """Score-vector links: the right number of canonical scores, and a URL that holds the code."""
    key = list(LEDGERS["gp_score_vector_links"].key)
    scores = F.split("score_signature", r"\|")
    canonical = F.transform(scores, lambda s: F.coalesce(canonical_score(s), F.lit("?")))
    wrong = (F.size(scores) != n_scores) | (canonical != scores)
    return violations(df, "signature form", wrong, key, F.col("score_signature")).unionByName(violations(df, "link URL", code_from_url("scorecard_url", parameter) != F.col("gp_code"), key, F.col("scorecard_url")))


def read_ledger(spark: SparkSession, path: str, name: str, slugs: list[str] | None = None, parameter: str = "gp") -> DataFrame:
    """A ledger from CSV that keeps its contract; ``slugs`` are the measures, ``parameter`` holds the code in a URL."""
    ledger = LEDGERS[name]
    df = text_csv(spark, path).select(*ledger.columns)
    parts = [ledger_contract(df, ledger, slugs)]
    if slugs and name == "theme_header_links":
        parts.append(header_contract(df, slugs))
    if slugs and name == "gp_score_vector_links":
        parts.append(vector_contract(df, len(slugs), parameter))
    enforce(*parts)
    return df


def allowed_missing(df: DataFrame) -> DataFrame:
    """Universe exceptions with their codes as an array."""
    return df.withColumn("codes", F.array_sort(F.array_distinct(split_list("allowed_missing_gp_codes"))))
