"""A bundle of tables rebuilt from a tree of blocks, and a release with its manifest: written, checked, then declared.

Tables are written first and checked as they were written; the manifest comes last, so a folder with a manifest is whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import contracts as con
from ..operators import windows
from ..sources import manifests, tables
from ..spec import PanelSpec
from . import pipelines, verification


@dataclass
class BundleSource:
    """What a bundle is made of: tables of all blocks with their ``block_dir``, status files, run log and option log
    with an append order, and the universe of an independent crawl with its rows by vintage."""

    metadata: DataFrame
    long: DataFrame
    wide: DataFrame
    statuses: DataFrame
    log: DataFrame
    options: DataFrame
    universe: DataFrame
    crawl_counts: DataFrame


@dataclass
class BundleRules:
    """Names and ledgers of a bundle's contracts; ``key`` names a unit in a vintage, ``block`` a run of the log."""

    key: list[str]
    block: list[str]
    slug: str
    slugs: list[str]
    order: str
    overall: str
    score: str
    required: list[str]
    vintage: str = "year"
    group: str = "state"
    ordinal: str = "log_at"
    controls: DataFrame | None = None
    null_exceptions: DataFrame | None = None
    count_exceptions: DataFrame | None = None
    legacy: object = None
    later: list[str] = field(default_factory=list)


def selected(source: BundleSource, rules: BundleRules, vintages: list | None) -> dict[str, DataFrame]:
    """The tables of a bundle for some vintages: consolidated rows, the last run of each block, each option once, and the
    universe."""

    def chosen(df: DataFrame) -> DataFrame:
        return df if vintages is None or rules.vintage not in df.columns else df.where(F.col(rules.vintage).isin(vintages))

    universe = source.universe if vintages is None else tables.vintages(source.universe, rules.vintage, vintages)
    return {
        "metadata": chosen(source.metadata),
        "long": chosen(source.long),
        "wide": chosen(source.wide),
        "runs": windows.latest_log(chosen(source.log), [rules.vintage, *rules.block], rules.ordinal, rules.block[-1], keep_blank=True),
        "options": windows.distinct_rows(chosen(source.options)),
        "universe": universe,
    }


def bundle_contract(parts: dict[str, DataFrame], source: BundleSource, rules: BundleRules, vintages: list | None = None) -> DataFrame:
    """Contracts of a bundle as written: consolidated tables (J2), universe (J3) with the rows that its crawl counted, and
    the rows that the status files of the blocks state (D9)."""
    held = pipelines.global_contract(
        parts["metadata"], parts["long"], rules.key, rules.slug, rules.slugs, rules.order, rules.overall, rules.score, rules.controls, rules.vintage,
        rules.group, rules.null_exceptions, parts["wide"], rules.count_exceptions, rules.legacy, rules.later,
    )
    units, _ = pipelines.universe_contract(parts["universe"], parts["metadata"], rules.key, rules.required)
    counted = parts["universe"].groupBy(rules.vintage).agg(F.count("*").alias("rows")).join(source.crawl_counts.select(rules.vintage, "n"), rules.vintage, "left")
    crawl = con.violations(counted, "universe rows", F.col("rows") != F.col("n"), [rules.vintage], F.concat_ws("/", F.col("rows").cast("string"), F.col("n").cast("string")))
    stated = source.statuses if vintages is None or rules.vintage not in source.statuses.columns else source.statuses.where(F.col(rules.vintage).isin(vintages))
    return con.union(held, units, crawl, verification.status_conservation(stated, parts["metadata"], parts["long"]))


def rebuild(spark: SparkSession, source: BundleSource, rules: BundleRules, out: str, vintages: list | None = None) -> dict[str, DataFrame]:
    """Write a bundle under the new folder ``out``, check what was written, and declare it in ``out``/manifest.

    Gives the tables as read back and the manifest. Raises ``ContractError`` before anything is declared.
    """
    parts = {}
    for name, df in selected(source, rules, vintages).items():
        key = [c for c in (rules.key if name in ("metadata", "long", "wide", "universe") else [rules.vintage, *rules.block]) if c in df.columns]
        tables.write_sorted(df, f"{out}/{name}", key or df.columns[:1])
        parts[name] = spark.read.schema(df.schema).parquet(f"{out}/{name}")
    con.enforce(bundle_contract(parts, source, rules, vintages))
    empty = [n for n in ("metadata", "long", "wide", "universe") if parts[n].isEmpty()]
    if empty:
        raise con.ContractError([("rows", len(empty), empty)])
    manifests.table_manifest(parts).coalesce(1).write.parquet(f"{out}/manifest")
    return parts | {"manifest": spark.read.parquet(f"{out}/manifest")}


def read_declared(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Tables of a bundle or release, which must be as its manifest says."""
    parts = {n: spark.read.parquet(f"{folder}/{n}") for n in names}
    declared = spark.read.parquet(f"{folder}/manifest").where(F.col("name").isin(names))
    manifests.require_manifest(parts, declared)
    return parts


def publish(release: pipelines.Release, out: str, spec: PanelSpec, schema) -> DataFrame:
    """Enforce a release's contracts, write panel, audits and corrections under the new folder ``out``, and declare all of
    them there (P1). Gives the manifest: name, rows, digest, schema."""
    panel = pipelines.write_release(release, f"{out}/panel", schema, spec.key)
    spark = panel.sparkSession
    parts = {"panel": panel}
    audits = {"coverage": release.coverage, "state_coverage": release.state_coverage, "corrections": release.corrections, "dropped": release.dropped}
    for name, df in audits.items():
        df.write.parquet(f"{out}/{name}")
        parts[name] = spark.read.schema(df.schema).parquet(f"{out}/{name}")
    manifests.table_manifest(parts).coalesce(1).write.parquet(f"{out}/manifest")
    return spark.read.parquet(f"{out}/manifest")


def verify_published(spark: SparkSession, folder: str, spec: PanelSpec, null_exceptions: DataFrame, url: str, **more) -> DataFrame:
    """Violations of a published release: tables that are not as declared, and all that ``pipelines.verify_release``
    recomputes from the panel."""
    names = ["panel", "coverage", "state_coverage"]
    parts = {n: spark.read.parquet(f"{folder}/{n}") for n in names}
    declared = spark.read.parquet(f"{folder}/manifest").where(F.col("name").isin(names))
    return con.union(
        manifests.audits_differ("tables", declared, manifests.table_manifest(parts)),
        pipelines.verify_release(parts["panel"], spec, parts["coverage"], parts["state_coverage"], null_exceptions, url, **more),
    )
