"""End-user pipelines: build, rebuild and verify a release, universes and indicator frameworks from stored responses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import text as fn
from ..operators import aggregates as agg
from ..operators import agreement
from ..operators import contracts as con
from ..operators import joins, reshape, sets, statuses, windows
from ..sources import manifests, tables
from ..spec import PanelSpec


@dataclass
class Release:
    """A release panel, its audits, and the contracts that it must keep."""

    panel: DataFrame
    corrections: DataFrame
    coverage: DataFrame
    state_coverage: DataFrame
    dropped: DataFrame
    violations: DataFrame


def reviewed_nulls(panel: DataFrame, spec: PanelSpec, exceptions: DataFrame, flag: str = "score_available") -> DataFrame:
    """Null cells of scored units must be exactly the reviewed ones of the panel's vintages, both ways."""
    scored = panel.where(flag)
    key = [*spec.key, "measure"]
    observed = reshape.null_cells(scored, spec.key, {m: m for m in spec.measures}).select(*(F.col(c).cast("string").alias(c) for c in key))
    present = panel.select(F.col(spec.vintage).cast("string").alias(spec.vintage)).distinct()
    configured = exceptions.select(*(F.col(c).cast("string").alias(c) for c in key)).join(present, spec.vintage, "left_semi")
    found = sets.two_sided(observed, configured, key)
    return con.violations(found, "reviewed nulls", F.lit(True), key, F.col("side"))


def score_values(panel: DataFrame, spec: PanelSpec, exceptions: DataFrame, flag: str = "score_available") -> DataFrame:
    """Scores are finite and within bounds, and null exactly where reviewed."""
    bad = con.in_range(panel.where(flag), list(spec.measures), spec.key, *spec.bounds)
    return bad.unionByName(reviewed_nulls(panel, spec, exceptions, flag))


def _shortfall(controls: DataFrame, exceptions: DataFrame | None, vintage: str, group: str) -> DataFrame | None:
    """Reviewed counts of groups, and of the totals, which fall short by what their groups do."""
    if exceptions is None:
        return None
    by_vintage = exceptions.groupBy(vintage).agg(F.sum(F.col("official_count") - F.col("portal_count")).alias("short"))
    of_total = controls.where(F.col(group) == agg.TOTAL).join(by_vintage, vintage)
    totals = of_total.select(vintage, group, F.col("n").alias("official_count"), (F.col("n") - F.col("short")).alias("portal_count"))
    return exceptions.select(vintage, group, "official_count", "portal_count").unionByName(totals)


def _control_violations(counts: DataFrame, controls: DataFrame, exceptions: DataFrame | None, vintage: str, group: str) -> DataFrame:
    """Counts of groups and their totals against controls."""
    total = counts.groupBy(vintage).agg(F.sum("n").alias("n")).select(vintage, F.lit(agg.TOTAL).alias(group), "n")
    compared = joins.against_controls(counts.unionAll(total), controls, [vintage, group], _shortfall(controls, exceptions, vintage, group))
    return con.violations(compared, "control totals", F.col("outcome") != "equal", [vintage, group], F.concat_ws(" ", "outcome", F.col("observed").cast("string"), F.col("expected").cast("string")))


def release_coverage(counts: DataFrame, corrections: DataFrame, controls: DataFrame, exceptions: DataFrame | None, vintage: str, group: str) -> DataFrame:
    """Scored units per group against controls, corrections folded back, totals over all groups.

    ``counts`` has (vintage, group, n) of groups; ``controls`` also the total, named ``aggregates.TOTAL``.
    """
    folded = agg.fold_back(counts, corrections, vintage, group, "universe_group", "outcome_group")
    controlled = folded.join(controls.select(vintage).distinct(), vintage, "left_semi")
    return _control_violations(controlled, controls, exceptions, vintage, group)


def national_controls(metadata: DataFrame, controls: DataFrame, exceptions: DataFrame | None, vintage: str, group: str) -> DataFrame:
    """Rows of the consolidated tables against the controls of the vintages that are there.

    Every group with a control must be there with its reviewed or official count; groups without one are tolerated and
    left out of the total, which falls short by what reviewed exceptions do.
    """
    counts = metadata.groupBy(vintage, group).agg(F.count("*").alias("n"))
    listed = controls.where(F.col(group) != agg.TOTAL).select(vintage, group)
    present = counts.select(vintage).distinct()
    wanted = controls.join(present, vintage, "left_semi")
    reviewed = None if exceptions is None else exceptions.join(present, vintage, "left_semi")
    return _control_violations(counts.join(listed, [vintage, group], "left_semi"), wanted, reviewed, vintage, group)


def block_coverage(universe: DataFrame, log: DataFrame, block: list[str], ordinal: str, status: str = "status") -> DataFrame:
    """Blocks of the universe whose latest outcome is no success."""
    latest = windows.last_status(log, block, status, ordinal)
    return joins.uncovered(universe, latest.where(F.col(status).isin(statuses.SUCCESS)), block, "block coverage")


def _row_rules(panel: DataFrame, spec: PanelSpec, flag: str = "score_available") -> DataFrame:
    """Blank ids, which a panel has from its universe, and scores out of range: one pass."""
    fields, outside = [*spec.key, *spec.level_ids], con.out_of_range(list(spec.measures), *spec.bounds)
    return con.row_rules(panel, spec.key, [("blank", con.blank_names(fields) != "", con.blank_names(fields)), ("range", F.col(flag) & (outside != ""), outside)])


def _membership(scores: DataFrame, universe: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur twice on either side, and scores that the universe lacks: one aggregate."""
    both = agreement.balance({"universe": universe, "scores": scores}, key)
    return agreement.broken(both, key, [agreement.unique("universe", "universe key"), agreement.unique("scores", "score key"), agreement.within("scores", "universe")])


def build_release(
    scores: DataFrame, universe: DataFrame, spec: PanelSpec, group: str, controls: DataFrame, null_exceptions: DataFrame,
    exclusions: DataFrame | None = None, count_exceptions: DataFrame | None = None, target: str = "correct_state_value", staging: str | None = None,
) -> Release:
    """Universe-left release panel with all its contracts.

    With a folder ``staging`` the inputs and the panel are written there once, and every contract, audit and the release
    itself read them from there; else nothing is written and each computes them anew.
    """
    scores, dropped = statuses.drop_unvalidated(scores, controls.where(F.col(group) != agg.TOTAL), spec.vintage, group)
    scores, universe = tables.staged(scores, staging, "scores"), tables.staged(universe, staging, "universe")
    levels = spec.level_ids
    moves = joins.hierarchy_disagreements(scores, universe, spec.key, levels)
    if exclusions is None:
        corrections = moves.where(F.lit(False))
        disagreements = con.violations(moves, "hierarchy disagreement", F.lit(True), spec.key, F.array_join("differing", ","))
    else:
        corrections, disagreements = joins.reviewed_moves(moves, exclusions, spec.vintage, levels[0], levels[1], target)
    panel = tables.staged(joins.universe_left(universe, scores, spec.key, list(spec.measures)), staging, "panel")
    folds = corrections.select(spec.vintage, F.col(levels[0]).alias("universe_group"), F.col(f"outcome_{levels[0]}").alias("outcome_group"))
    counts = panel.where("score_available").groupBy(spec.vintage, F.col(group).alias(group)).agg(F.count("*").alias("n"))
    found = con.union(
        _membership(scores, universe, spec.key), _row_rules(panel, spec), disagreements, reviewed_nulls(panel, spec, null_exceptions),
        release_coverage(counts, folds, controls, count_exceptions, spec.vintage, group),
        con.functional(universe, [spec.vintage, spec.hierarchy[0][0]], [spec.hierarchy[0][1]], "label of a group"),
    )
    coverage = agg.coverage(panel, [spec.vintage])
    by_state = agg.coverage_with_label(panel, [spec.vintage, spec.hierarchy[0][0]], spec.hierarchy[0][1], [*levels, spec.unit])
    return Release(panel, corrections, coverage, by_state, dropped, found)


def write_release(release: Release, path: str, schema, key: list[str]) -> DataFrame:
    """Enforce all contracts, then write the panel in key order and read it back."""
    con.enforce(release.violations)
    return tables.write_checked(release.panel, path, schema, key)


def verify_release(
    panel: DataFrame, spec: PanelSpec, declared_coverage: DataFrame, declared_states: DataFrame, null_exceptions: DataFrame, url: str, flag: str = "score_available",
    schema: StructType | None = None, vintages: list | None = None, controls: DataFrame | None = None, group: str | None = None,
    corrections: DataFrame | None = None, count_exceptions: DataFrame | None = None,
) -> DataFrame:
    """Recompute what a release states about itself (P3, J9): schema, keys, hierarchy, nulls, URLs, vintages, control
    totals and audits.

    Every field of the hierarchy, ids and labels, must be there for every unit. A unit without scores has neither values nor
    a URL, not even an empty one. ``controls`` by ``group`` are those of the release, ``corrections`` (vintage,
    universe_group, outcome_group) its moved units. Rules that are not asked for are left out.
    """
    scored, measures = F.col(flag), [F.col(m) for m in spec.measures]
    all_null = F.lit(True)
    for m in measures:
        all_null &= m.isNull()
    by_state = agg.coverage_with_label(panel, [spec.vintage, spec.hierarchy[0][0]], spec.hierarchy[0][1], [*spec.level_ids, spec.unit])
    outside = con.out_of_range(list(spec.measures), *spec.bounds)
    fields = [*spec.key, *spec.level_ids, *spec.level_labels]
    rows = [
        ("blank", con.blank_names(fields) != "", con.blank_names(fields)),
        ("scored without URL", scored & fn.is_blank(url), ""),
        ("unscored with values", ~scored & ~(F.col(url).isNull() & all_null), ""),
        ("range", scored & (outside != ""), outside),
    ]
    parts = [
        con.unique_key(panel, spec.key), con.row_rules(panel, spec.key, rows), reviewed_nulls(panel, spec, null_exceptions, flag),
        manifests.audits_differ("coverage", declared_coverage, agg.coverage(panel, [spec.vintage])),
        manifests.audits_differ("state coverage", declared_states, by_state),
    ]
    if schema is not None:
        parts.append(con.schema_violations(panel, schema))
    if vintages is not None:
        parts.append(con.violations(agg.missing_vintages(panel, spec.vintage, vintages), "vintages", F.lit(True), [spec.vintage], F.col("side")))
    if controls is not None:
        counts = panel.where(scored).groupBy(spec.vintage, group).agg(F.count("*").alias("n"))
        moved = corrections if corrections is not None else counts.where("false").select(spec.vintage, F.col(group).alias("universe_group"), F.col(group).alias("outcome_group"))
        parts.append(release_coverage(counts, moved, controls, count_exceptions, spec.vintage, group))
    return con.union(*parts)


def identity_rules(key: list[str], required: list[str], vintage: str, legacy: object, later: list[str]) -> list[tuple]:
    """Rules on one metadata row: required fields, and those that every vintage but the ``legacy`` one has to have."""
    out = [("blank", con.blank_names(required) != "", con.blank_names(required))] if required else []
    if later:
        newer = ~F.col(vintage).eqNullSafe(F.lit(legacy))
        out.append(("identity", newer & (con.blank_names(later) != ""), con.blank_names(later)))
    return out


def _agreement(metadata: DataFrame, long: DataFrame, wide: DataFrame | None, key: list[str], slug: str, slugs: list[str], order: str, overall: str, block: list[str]) -> DataFrame:
    """Repeated keys, keys that a table lacks, groups and conservation, all from one signed aggregate."""
    sides = {"metadata": metadata, "long": long} | ({} if wide is None else {"wide": wide})
    aggregates, group = agreement.members("long", slug, slugs, order, F.col(f"__{slug}") == overall)
    both = agreement.balance(sides, key, {"long": [slug, order]}, aggregates)
    rules = [agreement.unique("metadata", "duplicate key"), group, *agreement.same(list(sides))]
    parts = [agreement.conserved(both, block, "long", "metadata", len(slugs))]
    if wide is not None:
        rules.append(agreement.unique("wide", "wide key"))
        parts.append(agreement.conserved(both, block, "wide", "metadata", rule="wide conservation"))
    return con.union(agreement.broken(both, key, rules), *parts)


def block_contract(
    metadata: DataFrame, long: DataFrame, wide: DataFrame, key: list[str], slug: str, slugs: list[str], order: str, overall: str, score: str, columns: dict[str, str],
    exceptions: DataFrame | None = None, block: list[str] | None = None, required: list[str] | None = None, vintage: str = "year", legacy: object = None,
    later: list[str] | None = None, schemas: dict[str, StructType] | None = None,
) -> DataFrame:
    """Contracts on the rows of all blocks at once (J1): schemas, identities, conservation, groups, agreement of long and wide.

    With ``block``, parts of the key, rows are conserved in each block. ``later`` are fields that no vintage but ``legacy``
    may leave blank, ``schemas`` the columns that metadata, long and wide must have at least.
    """
    values = long if exceptions is None else long.join(exceptions.select(*key, slug), [*key, slug], "left_anti")
    parts = [
        con.row_rules(metadata, key, identity_rules(key, [*key, *(required or [])], vintage, legacy, later or [])),
        _agreement(metadata, long, wide, key, slug, slugs, order, overall, block or []),
        joins.cell_disagreements(long, wide, key, slug, score, columns), con.in_range(values, [score], [*key, slug], nulls=False),
    ]
    for name, df in (("metadata", metadata), ("long", long), ("wide", wide)):
        if name in (schemas or {}):
            parts.append(con.schema_violations(df, schemas[name], exact=False, rule=f"{name} schema"))
    return con.union(*parts)


def global_contract(
    metadata: DataFrame, long: DataFrame, key: list[str], slug: str, slugs: list[str], order: str, overall: str, score: str, controls: DataFrame | None = None,
    vintage: str = "year", group: str = "state", null_exceptions: DataFrame | None = None, wide: DataFrame | None = None, count_exceptions: DataFrame | None = None,
    legacy: object = None, later: list[str] | None = None, stored: str | None = None, schemas: dict[str, StructType] | None = None,
) -> DataFrame:
    """Contracts on the consolidated tables (J2): keys of metadata, long and wide, groups, identities, nulls, ranges, controls.

    ``stored`` names a column of ``long`` with the storage order, in which the rows of a unit must stand together.
    """
    parts = [_agreement(metadata, long, wide, key, slug, slugs, order, overall, [])]
    nulls = long.where(F.col(score).isNull()).select(*key, slug)
    if null_exceptions is None:
        parts.append(con.violations(nulls, "null score", F.lit(True), [*key, slug]))
    else:
        present = metadata.select(*key).distinct()
        parts.append(con.violations(sets.two_sided(nulls, null_exceptions.join(present, key, "left_semi"), [*key, slug]), "reviewed nulls", F.lit(True), [*key, slug], F.col("side")))
    parts.append(con.in_range(long, [score], [*key, slug]))
    if later:
        parts.append(con.row_rules(metadata, key, identity_rules(key, [], vintage, legacy, later)))
    if stored:
        parts.append(con.violations(windows.broken_stretches(long, key, stored), "rows apart", F.lit(True), key, F.col("runs")))
    if controls is not None:
        parts.append(national_controls(metadata, controls, count_exceptions, vintage, group))
    for name, df in (("metadata", metadata), ("long", long), ("wide", wide)):
        if df is not None and name in (schemas or {}):
            parts.append(con.schema_violations(df, schemas[name], exact=False, rule=f"{name} schema"))
    return con.union(*parts)


def universe_contract(universe: DataFrame, metadata: DataFrame, key: list[str], required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Contracts on the universe and one row of (universe, scored, unscored)."""
    marked = joins.universe_left(universe, metadata.select(*key).distinct(), key, [])
    return con.union(con.not_blank(universe, required, key), con.unique_key(universe, key), joins.orphans(metadata, universe, key)), agg.coverage(marked, [])


def repaired_blocks(metadata: DataFrame, long: DataFrame, wide: DataFrame, vector_links: DataFrame, header_links: DataFrame, base: list[str], scores: list[str], parameter: str, code: str = "unit", url: str = "url", slug: str = "theme_slug", header: str = "theme_header", values: dict[str, str] | None = None, staging: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Repair and consolidate the rows of all blocks (P2): score vectors first, then codes from URLs, then headers.

    The order matters: headers are regrouped by unit, so units of one name need their codes before.

    With a folder ``staging`` links, marked units, ids, long rows, measures and the wide table are written there once, and
    each step, the contracts and the results read them from there. Rows meet by unit in parts of a fixed number of rows:
    merged by their compressed bytes, millions of such narrow rows would be sorted and grouped in one task.
    """
    # written, links have a size that Spark knows, so small ones are broadcast before the rows are shuffled for them
    vector_links, header_links = tables.staged(vector_links, staging, "vectors"), tables.staged(header_links, staging, "headers")
    signed = wide.select("row_id", *base, code, url, fn.score_signature(scores).alias("signature"))
    restored, wrong = joins.restore_by_signature(signed, vector_links, base, "signature", {code: "new_code", url: "new_url"}, staging)
    restored = restored.withColumn("__decoded", fn.code_from_url(url, parameter))
    ids = restored.select("row_id", fn.preferred_code(code, "__decoded").alias("__code"), F.col(url).alias("__url"))
    ids = tables.staged(ids, staging, "ids")
    # few parts: beyond 200 of them Spark sorts the rows of a map task in memory before it shuffles them
    key, n = ["row_id"], tables.parts(long, 1_000_000)

    def identified(df: DataFrame) -> DataFrame:
        kept = df.repartition(n, *key).join(ids.repartition(n, *key), key)
        return kept.withColumns({code: F.col("__code"), url: F.col("__url")}).select(*df.columns)

    metadata, long = identified(metadata), identified(long)
    long = tables.staged(joins.with_slugs(long, header_links, header, slug), staging, "long")
    unknown, slugs = joins.unknown_headers(long, slug), sorted(s.removesuffix("_score") for s in scores)
    measures = reshape.counted_measures(long.repartition(n, *key), key, slug, slugs, values or {"score": "score"})
    measures = tables.staged(measures, staging, "measures")
    rebuilt = tables.staged(metadata.join(measures.repartition(n, *key), key, "left"), staging, "wide")
    missing = reshape.incomplete_keys(rebuilt, key, slugs).unionAll(reshape.repeated_measures(measures, key, slug))
    return {"metadata": metadata, "long": long.drop("__header"), "wide": rebuilt.drop("__rows")}, con.union(wrong, unknown, missing)


def indicators_from_pages(pages: DataFrame, page: list[str], html: str) -> tuple[DataFrame, DataFrame]:
    """Indicator records from stored pages (P8): five-cell rows, ids from labels, the first row of an id kept."""
    rows = F.regexp_extract_all(html, F.lit(r"(?s)<tr>(.*?)</tr>"), F.lit(1))
    found = pages.select(*page, F.posexplode(rows).alias("position", "__row"))
    cells = F.regexp_extract_all("__row", F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1))
    found = found.withColumn("__cells", cells).where(F.size("__cells") == 5)

    def cell(k: int) -> Column:
        return fn.collapse_space(fn.unescape(F.regexp_replace(F.get("__cells", F.lit(k)), r"<[^>]+>", "")))

    suffix = r"(?U)\s*\[[0-9]+\]\s*$"
    found = found.select(*page, "position", cell(1).alias("mandatory"), *(cell(k).alias(n) for k, n in ((2, "indicator"), (3, "numerator"), (4, "denominator"))))
    found = found.withColumn("indicator_id", fn.trailing_id("indicator"))
    bad = con.violations(found, "indicator without id", F.col("indicator_id").isNull(), [*page, "position"], F.col("indicator"))
    found = found.withColumns({n: F.regexp_replace(n, suffix, "") for n in ("indicator", "numerator", "denominator")})
    first = windows.first_rows(found.where("indicator_id is not null"), [*page, "indicator_id"], "position")
    return first.withColumn("kind", fn.classify_indicator("indicator", "numerator", "denominator")).drop("position"), bad


def indicator_contract(df: DataFrame, key: list[str], required: list[str], versions: DataFrame, themes: DataFrame) -> DataFrame:
    """The indicator framework's contract (J11). ``versions`` has version, fiscal_year, n_rows, n_ids; ``themes`` number, slug."""
    per_version = df.groupBy("version").agg(F.count("*").alias("rows"), F.count_distinct("indicator_id").alias("ids"))
    counted = versions.join(per_version, "version", "full_outer")
    wrong = ~(F.col("rows").eqNullSafe(F.col("n_rows")) & F.col("ids").eqNullSafe(F.col("n_ids")))
    every = versions.select("version").crossJoin(F.broadcast(themes.select(F.col("number").alias("theme_number"))))  # a handful of each
    return con.union(
        con.unique_key(df, key), con.not_blank(df, required, key),
        con.in_domain(df, "kind", ["binary", "number", "ratio"], key, "kind"), con.in_domain(df, "mandatory", ["Mandatory", "Optional"], key, "mandatory"),
        con.required_when(df, F.col("kind") == "ratio", ~fn.is_blank("denominator"), key, "ratio without denominator"),
        con.violations(df.join(themes.withColumnRenamed("number", "theme_number"), "theme_number", "left"), "theme slug", ~F.col("theme_slug").eqNullSafe(F.col("slug")), key),
        con.violations(df.join(versions.select("version", F.col("fiscal_year").alias("__year")), "version", "left"), "fiscal year", ~F.col("fiscal_year").eqNullSafe(F.col("__year")), key),
        con.violations(counted, "version counts", wrong, ["version"]), joins.uncovered(every, df, ["version", "theme_number"], "theme coverage"),
    )


def migrated(spark: SparkSession, csv: DataFrame, renames: dict[str, str], dropped: list[str], declared) -> tuple[DataFrame, DataFrame]:
    """All-string rows of legacy CSV caches in the typed form (P9), with violations for values that do not cast."""
    df = csv.withColumnsRenamed(renames).drop(*dropped)
    return con.coerced(df, declared)
