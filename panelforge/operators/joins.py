"""Joins of a panel: universe-left, membership, identity resolution, reconciliation.

Ledgers and controls are small reviewed tables; they join by key and Spark broadcasts them by their measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_score, code_from_url, collapse_space, is_blank
from ..sources.tables import staged
from .contracts import key_text, violations


def universe_left(universe: DataFrame, outcomes: DataFrame, key: list[str], measures: list[str], flag: str = "score_available") -> DataFrame:
    """Every unit of the universe with its measures; ``flag`` tells whether the unit has an outcome row.

    The flag is a marker column, not a test of measures, since an outcome may hold null measures. Labels come from the
    universe. Nothing is imputed.
    """
    marked = outcomes.select(*key, *measures, F.lit(True).alias(flag))
    return universe.join(marked, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def orphans(outcomes: DataFrame, universe: DataFrame, key: list[str], rule: str = "orphan") -> DataFrame:
    """Outcomes whose key is not in the universe, as violations."""
    return violations(outcomes.join(universe.select(*key).distinct(), key, "left_anti"), rule, F.lit(True), key)


def uncovered(expected: DataFrame, observed: DataFrame, key: list[str], rule: str = "uncovered") -> DataFrame:
    """Distinct keys of ``expected`` that ``observed`` lacks."""
    return violations(expected.select(*key).distinct().join(observed.select(*key), key, "left_anti"), rule, F.lit(True), key)


def hierarchy_disagreements(outcomes: DataFrame, universe: DataFrame, key: list[str], levels: list[str]) -> DataFrame:
    """Outcomes whose hierarchy differs from the universe's: key, universe and outcome values, differing levels."""
    theirs = outcomes.select(*key, *(F.col(c).alias(f"outcome_{c}") for c in levels))
    both = universe.select(*key, *levels).join(theirs, key)
    differing = F.filter(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"outcome_{c}")), F.lit(c)) for c in levels)), lambda x: x.isNotNull())
    return both.withColumn("differing", differing).where(F.size("differing") > 0)


def reviewed_moves(disagreements: DataFrame, exclusions: DataFrame, vintage: str, top: str, second: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Split disagreements into corrections and violations.

    A disagreement is a correction only if the top level alone differs and a reviewed exclusion names this vintage,
    the outcome's top and second level, and the universe's top level as ``target``.
    """
    ledger = exclusions.select(F.col(vintage), F.col(top).alias(f"outcome_{top}"), F.col(second).alias(f"outcome_{second}"), F.col(target).alias("__target"))
    joined = disagreements.join(ledger, [vintage, f"outcome_{top}", f"outcome_{second}"], "left")
    allowed = F.coalesce((F.col("__target") == F.col(top)) & (F.array_join("differing", ",") == top), F.lit(False))
    corrections = joined.where(allowed).drop("__target")
    keys = [c for c in disagreements.columns if c != "differing" and not c.startswith("outcome_")]
    return corrections, violations(joined, "hierarchy disagreement", ~allowed, keys, F.array_join("differing", ","))


def canonical_headers(df: DataFrame, links: DataFrame, header: str, slug: str = "theme_slug") -> tuple[DataFrame, DataFrame]:
    """``df`` with the canonical slug of its header (white space collapsed), and violations for unknown headers."""
    named = with_slugs(df, links, header, slug)
    return named.drop("__header"), unknown_headers(named, slug)


def with_slugs(df: DataFrame, links: DataFrame, header: str, slug: str = "theme_slug") -> DataFrame:
    """``df`` with the canonical slug of its header, null if unknown, and the header as it was looked up in ``__header``."""
    ledger = links.select(collapse_space("theme_header").alias("__header"), F.col("theme_slug").alias("__slug"))
    joined = df.withColumn("__header", collapse_space(header)).join(ledger, "__header", "left")
    return joined.withColumn(slug, F.col("__slug")).drop("__slug")


def unknown_headers(named: DataFrame, slug: str = "theme_slug") -> DataFrame:
    """Headers in the rows of ``with_slugs`` that have no slug, as violations."""
    return violations(named.where(F.col(slug).isNull()).select("__header").distinct(), "unknown header", F.lit(True), ["__header"])


def unit_key(vintage: str, url: str, code: str, levels: list[tuple[str, str]], name: str, parameter: str) -> Column:
    """The key of a unit: by the code in its URL, else its stored code, else its place and name; the kind is part of it."""
    decoded, stored = code_from_url(url, parameter), F.trim(F.coalesce(F.col(code), F.lit("")))
    place = [F.when(is_blank(i), F.col(label)).otherwise(F.col(i)) for i, label in levels]
    empty = F.lit("")

    def key(kind: str, *parts: Column) -> Column:
        parts = [F.coalesce(p.cast("string"), empty) for p in parts]
        return F.struct(F.coalesce(F.col(vintage).cast("string"), empty).alias("vintage"), F.lit(kind).alias("kind"), F.array(*parts).alias("parts"))

    return F.when(decoded != "", key("url_code", decoded)).when(stored != "", key("code", stored)).otherwise(key("place_name", *place, F.col(name)))


def fill_codes(rows: DataFrame, universe: DataFrame, links: DataFrame, block: list[str], code: str, name: Column, unit_name: Column) -> tuple[DataFrame, DataFrame]:
    """Fill codes that the universe does not know, and violations where that is not possible.

    ``rows`` and ``universe`` have ``block`` (with the vintage) and ``code``. In order: a code of the universe stays;
    a reviewed link (block, normalised name) gives its code, which must be in the universe; a single unit of the block
    with the same normalised name gives its code. Several or no candidates are a violation; row order plays no part.
    """
    known = universe.select(*block, code).distinct().withColumn("__known", F.lit(True))
    named = universe.select(*block, unit_name.alias("__name"), F.col(code).alias("__candidate")).groupBy(*block, "__name").agg(F.collect_set("__candidate").alias("__candidates"))
    ledger = links.select(*block, F.col("name").alias("__name"), F.col("code").alias("__linked"))
    out = rows.withColumn("__name", name)
    out = out.join(known, [*block, code], "left").join(ledger, [*block, "__name"], "left")
    valid = known.withColumnsRenamed({code: "__linked", "__known": "__valid"})
    out = out.join(valid, [*block, "__linked"], "left").join(named, [*block, "__name"], "left")
    single = F.when(F.size("__candidates") == 1, F.get("__candidates", F.lit(0)))
    found = F.when(F.col("__known").isNotNull(), F.col(code)).when(F.col("__linked").isNotNull(), F.when(F.col("__valid"), F.col("__linked"))).otherwise(single)
    reason = F.when(F.col("__linked").isNotNull(), "link not in universe").when(F.size("__candidates") > 1, "several candidates").otherwise("no candidate")
    out = out.withColumn("__found", found).withColumn("__reason", reason)
    bad = violations(out, "unresolved code", F.col("__found").isNull(), [*block, "__name"], F.col("__reason"))
    return out.withColumn(code, F.coalesce("__found", code)).select(*rows.columns), bad


def restore_by_signature(units: DataFrame, links: DataFrame, base: list[str], signature: str, targets: dict[str, str], staging: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Restore identities by exact score vectors.

    ``units`` has one row per unit with ``base`` columns and a ``signature`` array of canonical scores; ``links`` has
    base, signature and the new values (``targets``: column of units -> column of links). The multiset of vectors
    must match: for each (base, signature) as many units as links. Equal units are paired with equal links by number,
    and any pairing is right since they do not differ. Only units whose base and vector the ledger names are numbered.
    With a folder ``staging`` units are written there once with the mark that tells these apart, else each use finds it anew.
    """
    joined_signature = F.array_join(F.col(signature), "|", "null")
    pair = Window.partitionBy(*base, "__signature").orderBy(F.lit(0))
    left = units.withColumn("__signature", joined_signature)
    right = links.withColumn("__signature", joined_signature)
    named = [*base, "__signature"]
    listed = right.select(*named).distinct().withColumn("__listed", F.lit(True))
    marked = staged(left.join(listed, named, "left"), staging, "marked")
    reviewed = marked.where("__listed")
    counts_left = reviewed.groupBy(*base, "__signature").agg(F.count("*").alias("units"))
    counts_right = right.groupBy(*base, "__signature").agg(F.count("*").alias("links"))
    compared = counts_right.join(counts_left, [*base, "__signature"], "left")
    bad = violations(compared, "signature multiset", F.coalesce(F.col("units"), F.lit(0)) != F.col("links"), [*base, "__signature"])
    numbered = right.withColumn("__n", F.row_number().over(pair)).select(*base, "__signature", "__n", *(F.col(v).alias(f"__new_{k}") for k, v in targets.items()))
    out = reviewed.withColumn("__n", F.row_number().over(pair)).join(numbered, [*base, "__signature", "__n"], "left")
    out = out.withColumns({k: F.coalesce(F.col(f"__new_{k}"), F.col(k)) for k in targets}).select(*units.columns)
    others = marked.where("__listed is null").select(*units.columns)
    return others.unionAll(out), bad


def cell_disagreements(long: DataFrame, wide: DataFrame, key: list[str], name: str, value: str, columns: dict[str, str]) -> DataFrame:
    """Cells whose canonical score differs between the long and the wide table; null equals blank.

    ``columns`` maps names in the long table to columns of the wide one.
    """
    melted = wide.unpivot(key, [F.col(c).alias(n) for n, c in columns.items()], name, "__wide")
    both = long.select(*key, name, F.col(value).alias("__long")).join(melted, [*key, name], "full_outer")
    differs = ~F.coalesce(canonical_score("__long"), F.lit("?")).eqNullSafe(F.coalesce(canonical_score("__wide"), F.lit("?")))
    return violations(both, "long and wide differ", differs, [*key, name], F.concat_ws("/", F.col("__long").cast("string"), F.col("__wide").cast("string")))


def reconcile_listings(left: DataFrame, right: DataFrame, key: str, checksum: str) -> DataFrame:
    """(key, left, right, outcome): equal, missing (left only), unexpected (right only) or checksum differs."""
    a, b = left.select(key, F.col(checksum).alias("left_checksum")), right.select(key, F.col(checksum).alias("right_checksum"))
    outcome = F.when(F.col("right_checksum").isNull(), "missing").when(F.col("left_checksum").isNull(), "unexpected")
    outcome = outcome.when(F.col("left_checksum") == F.col("right_checksum"), "equal").otherwise("checksum differs")
    return a.join(b, key, "full_outer").withColumn("outcome", outcome)


def against_controls(counts: DataFrame, controls: DataFrame, key: list[str], exceptions: DataFrame | None = None) -> DataFrame:
    """Observed counts against control totals: key, observed, control, expected, outcome.

    A reviewed exception (key, official_count, portal_count) overrides what is expected; its official count must be
    the control. Outcomes: equal, differs, uncontrolled, unobserved, exception disagrees.
    """
    both = counts.select(*key, F.col("n").alias("observed")).join(controls.select(*key, F.col("n").alias("control")), key, "full_outer")
    if exceptions is None:
        both = both.withColumns({"official_count": F.lit(None).cast("long"), "portal_count": F.lit(None).cast("long")})
    else:
        both = both.join(exceptions.select(*key, "official_count", "portal_count"), key, "left")
    expected = F.coalesce("portal_count", "control")
    outcome = (
        F.when(F.col("official_count").isNotNull() & ~F.col("official_count").eqNullSafe(F.col("control")), "exception disagrees")
        .when(F.col("control").isNull(), "uncontrolled")
        .when(F.col("observed").isNull(), "unobserved")
        .when(F.col("observed") == expected, "equal")
        .otherwise("differs")
    )
    return both.select(*key, "observed", "control", expected.alias("expected"), outcome.alias("outcome"))


def payload_contract(payloads: DataFrame, provenance: DataFrame, place: str) -> tuple[DataFrame, DataFrame]:
    """Payloads with their provenance, and violations: no provenance, hash, HTTP status or row count wrong.

    ``payloads`` has ``place, sha256, n_rows``; ``provenance`` ``place, sha256, http_status, n_rows``.
    """
    theirs = provenance.withColumnsRenamed({"sha256": "stated_sha256", "n_rows": "stated_rows"})
    joined = payloads.join(theirs, place, "left")
    wrong = F.array(
        F.when(F.col("stated_sha256").isNull(), F.lit("no provenance")),
        F.when(F.col("stated_sha256") != F.col("sha256"), F.lit("hash")),
        F.when(F.coalesce(F.col("http_status").cast("int"), F.lit(0)) != 200, F.lit("status")),
        F.when(F.col("stated_rows").cast("long") != F.col("n_rows"), F.lit("rows")),
    )
    wrong = F.filter(wrong, lambda x: x.isNotNull())
    return joined, violations(joined, "payload", F.size(wrong) > 0, [place], F.array_join(wrong, ","))


def apply_exclusions(rows: DataFrame, exclusions: DataFrame, key: list[str], source_hash: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` without reviewed exclusions, and violations: a changed source, or an exclusion that nothing used."""
    ledger = exclusions.select(*key, F.col("source_sha256").alias("__reviewed"))
    joined = rows.join(ledger, key, "left")
    changed = violations(joined.where(F.col("__reviewed").isNotNull()), "exclusion source changed", ~F.col("__reviewed").eqNullSafe(F.col(source_hash)), key)
    unused = violations(ledger.join(rows.select(*key).distinct(), key, "left_anti"), "exclusion unused", F.lit(True), key)
    return joined.where(F.col("__reviewed").isNull()).drop("__reviewed"), changed.unionByName(unused)


def baseline_delta(live: DataFrame, baseline: DataFrame, key: list[str]) -> DataFrame:
    """Live counts with the baseline's and the difference, null where there is no baseline."""
    prior = baseline.select(*key, F.col("n").alias("baseline"))
    return live.select(*key, F.col("n").alias("live")).join(prior, key, "left").withColumn("delta", F.col("live") - F.col("baseline"))


def stale_sources(exceptions: DataFrame, inventory: DataFrame, path: str = "source_path", digest: str = "source_sha256") -> DataFrame:
    """Reviewed sources that the inventory lacks or holds with another hash."""
    seen = inventory.select(F.col("path").alias(path), F.col("sha256").alias("__now"))
    joined = exceptions.select(path, digest).distinct().join(seen, path, "left")
    return violations(joined, "stale source", ~F.col(digest).eqNullSafe(F.col("__now")), [path])


def same_keys(left: DataFrame, right: DataFrame, key: list[str], rule: str = "keys differ") -> DataFrame:
    """Keys (with multiplicity) that one side has and the other lacks."""
    a, b = left.select(*key), right.select(*key)
    only = a.exceptAll(b).withColumn("__side", F.lit("left only")).unionAll(b.exceptAll(a).withColumn("__side", F.lit("right only")))
    return only.select(F.lit(rule).alias("rule"), key_text(key).alias("key"), F.col("__side").alias("detail"))
