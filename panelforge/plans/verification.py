"""Contracts on how tables came about: provenance of a universe, its build, and a store of finished blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import contracts as con
from ..operators import joins, sets


def universe_provenance(universe: DataFrame, crawl_counts: DataFrame, controls: DataFrame, unscored: DataFrame, required: list[str], stated_digest: str | None, crawl_digest: str, vintage: str = "year", group: str = "state") -> DataFrame:
    """The denominator must be the independent nationwide crawl.

    ``crawl_counts`` has (vintage, rows, groups) as the crawl recorded them, ``controls`` and ``unscored`` (vintage,
    group) the groups that must be there. Violations: another or no crawl, a vintage missing, other row counts, groups
    missing, or an inventory of another size.
    """
    spark = universe.sparkSession
    parts = [con.holds(spark, stated_digest == crawl_digest, "universe source", f"{stated_digest} is not {crawl_digest}")]
    wanted = spark.createDataFrame([(v,) for v in required], f"{vintage} string")
    observed = universe.groupBy(F.col(vintage).cast("string").alias(vintage)).agg(F.count("*").alias("observed"))
    counted = wanted.join(crawl_counts, vintage, "left").join(observed, vintage, "left")
    parts.append(con.violations(counted, "vintage not crawled", F.col("rows").isNull(), [vintage]))
    differs = F.col("rows").isNotNull() & (F.coalesce("observed", F.lit(0)) != F.col("rows"))
    parts.append(con.violations(counted, "universe rows", differs, [vintage], F.concat_ws("/", F.col("observed").cast("string"), F.col("rows").cast("string"))))
    groups = controls.where(F.col(group) != agg.TOTAL).select(vintage, group).union(unscored.select(vintage, group)).distinct().join(wanted, vintage, "left_semi")
    parts.append(joins.uncovered(groups, universe.select(F.col(vintage).cast("string").alias(vintage), group), [vintage, group], "not nationwide"))
    sizes = groups.groupBy(vintage).agg(F.count("*").alias("n")).join(crawl_counts, vintage)
    parts.append(con.violations(sizes, "inventory size", F.col("n") != F.col("groups"), [vintage], F.col("n")))
    return con.union(*parts)


def universe_build(units: DataFrame, endpoint_counts: DataFrame, applied: DataFrame, exclusions: DataFrame, key: list[str], exclusion_key: list[str], vintage: str = "year") -> DataFrame:
    """A universe from a hierarchy walk: unique keys, rows as the endpoints gave them, and exactly the reviewed exclusions.

    ``endpoint_counts`` has (vintage, n).
    """
    counted = units.groupBy(vintage).agg(F.count("*").alias("rows")).join(endpoint_counts, vintage, "full_outer")
    used = sets.two_sided(applied, exclusions, exclusion_key)
    return con.union(
        con.unique_key(units, key, "universe key"),
        con.violations(counted, "endpoint rows", ~F.col("rows").eqNullSafe(F.col("n")), [vintage], F.concat_ws("/", F.col("rows").cast("string"), F.col("n").cast("string"))),
        con.violations(used, "exclusions", F.lit(True), exclusion_key, F.col("side")),
    )


def status_conservation(statuses: DataFrame, metadata: DataFrame, long: DataFrame, block: str = "block_dir", done: str = "done") -> DataFrame:
    """Every finished block must hold as many units and scores as its status says, and no other block any."""
    units, scores = (df.groupBy(block).agg(F.count("*").alias(n)) for df, n in ((metadata, "units"), (long, "scores")))
    stated = statuses.where(F.col("status") == done).select(block, F.coalesce("unit_rows", F.lit(0)).alias("unit_rows"), F.coalesce("score_rows", F.lit(0)).alias("score_rows"))
    both = stated.join(units, block, "full_outer").join(scores, block, "full_outer")
    wrong = ~(F.col("unit_rows").eqNullSafe(F.coalesce("units", F.lit(0))) & F.col("score_rows").eqNullSafe(F.coalesce("scores", F.lit(0))))
    return con.violations(both, "status rows", wrong, [block], F.concat_ws("/", F.col("units").cast("string"), F.col("scores").cast("string")))


def shared_units(metadata: DataFrame, key: list[str], block: str = "block_dir") -> DataFrame:
    """Units that several blocks hold."""
    blocks = metadata.groupBy(*key).agg(F.count_distinct(block).alias("n"))
    return con.violations(blocks, "unit in several blocks", F.col("n") > 1, key, F.col("n"))


def store(statuses: DataFrame, metadata: DataFrame, long: DataFrame, wide: DataFrame, row_contract: DataFrame, listing: DataFrame, stored: DataFrame, exceptions: DataFrame, key: list[str], block: str = "block_dir") -> DataFrame:
    """All contracts on a store of blocks.

    ``row_contract`` holds the violations of the rows of all blocks; ``listing`` and ``stored`` (path, sha256) what the
    manifest lists and what is there; ``exceptions`` the reviewed null cells with their sources.
    """
    files = joins.reconcile_listings(listing, stored, "path", "sha256")
    counts = agg.table_counts({"metadata": metadata, "wide": wide})
    return con.union(
        con.violations(statuses.where(F.col("status") == "failed"), "failed block", F.lit(True), [block]),
        con.violations(files, "stored files", F.col("outcome") != "equal", ["path"], F.col("outcome")),
        row_contract,
        con.conserved(counts, "metadata", "wide", rule="wide conservation"),
        shared_units(metadata, key, block),
        status_conservation(statuses, metadata, long, block),
        joins.stale_sources(exceptions, stored),
    )
