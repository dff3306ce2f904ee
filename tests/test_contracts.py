"""Contracts accept what is right and reject each defect by name."""

import pytest
from pyspark.sql import functions as F

from panelforge.operators import contracts as con
from panelforge.operators import joins, statuses
from panelforge.plans import pipelines, progress
from panelforge.sources import ledgers, manifests
from panelforge.spec import PanelSpec

SPEC = PanelSpec("year", "unit", (("state_value", "state"), ("district_value", "district")), ("a", "b"))
UNIVERSE = "year string, unit string, state_value string, state string, district_value string, district string"
SCORES = "year string, unit string, state_value string, district_value string, a double, b double"
CONTROLS = "year string, state_value string, n long"


def universe(spark, *units):
    return spark.createDataFrame([("2024", u, "9", "North", "1", "D") for u in units], UNIVERSE)


def scores(spark, *rows):
    return spark.createDataFrame([("2024", u, s, "1", a, b) for u, s, a, b in rows], SCORES)


def controls(spark, n, state="9"):
    return spark.createDataFrame([("2024", state, n), ("2024", "__total__", n)], CONTROLS)


def nulls(spark, *cells):
    return spark.createDataFrame([("2024", u, m) for u, m in cells], "year string, unit string, measure string")


def rules(df):
    return sorted({r["rule"] for r in df.collect()})


def test_release_keeps_unscored_units(spark):
    out = pipelines.build_release(scores(spark, ("100", "9", 1.0, 2.0)), universe(spark, "100", "101"), SPEC, "state_value", controls(spark, 1), nulls(spark))
    assert rules(out.violations) == []
    rows = {r["unit"]: r for r in out.panel.collect()}
    assert rows["101"]["score_available"] is False and rows["101"]["a"] is None
    assert tuple(out.coverage.first()) == ("2024", 2, 1, 1)


@pytest.mark.parametrize(
    "row, rule",
    [
        (("999", "9", 1.0, 2.0), "orphan"),
        (("100", "9", float("nan"), 2.0), "range"),
        (("100", "9", 101.0, 2.0), "range"),
        (("100", "9", None, 2.0), "reviewed nulls"),
        (("100", "9", 1.0, -0.5), "range"),
    ],
)
def test_release_rejects(spark, row, rule):
    out = pipelines.build_release(scores(spark, row), universe(spark, "100"), SPEC, "state_value", controls(spark, 1), nulls(spark))
    assert rule in rules(out.violations)
    with pytest.raises(con.ContractError):
        con.enforce(out.violations)


def test_reviewed_null_must_be_used(spark):
    ok = pipelines.build_release(scores(spark, ("100", "9", None, 2.0)), universe(spark, "100"), SPEC, "state_value", controls(spark, 1), nulls(spark, ("100", "a")))
    assert rules(ok.violations) == []
    stale = pipelines.build_release(scores(spark, ("100", "9", 1.0, 2.0)), universe(spark, "100"), SPEC, "state_value", controls(spark, 1), nulls(spark, ("100", "a")))
    assert rules(stale.violations) == ["reviewed nulls"]


def test_reviewed_move_is_folded_back(spark):
    moved = scores(spark, ("100", "8", 1.0, 2.0))
    ledger = spark.createDataFrame([("2024", "8", "1", "9")], "year string, state_value string, district_value string, correct_state_value string")
    out = pipelines.build_release(moved, universe(spark, "100"), SPEC, "state_value", controls(spark, 1, "8"), nulls(spark), ledger)
    # the hierarchy's state stays in the counts with zero units, for which there is no control
    assert rules(out.violations) == ["control totals"]
    assert out.corrections.count() == 1
    unreviewed = pipelines.build_release(moved, universe(spark, "100"), SPEC, "state_value", controls(spark, 1, "8"), nulls(spark))
    assert "hierarchy disagreement" in rules(unreviewed.violations)


def test_state_without_control_is_dropped(spark):
    out = pipelines.build_release(scores(spark, ("100", "7", 1.0, 2.0)), universe(spark, "100"), SPEC, "state_value", controls(spark, 1), nulls(spark))
    assert [tuple(r) for r in out.dropped.collect()] == [("2024", "7", 1)]


def test_staged_release_is_written_and_read_back(spark, tmp_path):
    parts = scores(spark, ("100", "9", 1.0, None)), universe(spark, "101", "100"), SPEC, "state_value", controls(spark, 1), nulls(spark, ("100", "b"))
    plain, staged = pipelines.build_release(*parts), pipelines.build_release(*parts, staging=str(tmp_path / "stage"))
    assert sorted(map(tuple, plain.panel.collect())) == sorted(map(tuple, staged.panel.select(*plain.panel.columns).collect()))
    back = pipelines.write_release(staged, str(tmp_path / "release"), staged.panel.schema, ["year", "unit"])
    assert [r["unit"] for r in back.collect()] == ["100", "101"] and (tmp_path / "stage" / "panel").exists()
    broken = pipelines.build_release(*parts[:5], nulls(spark), staging=str(tmp_path / "other"))
    with pytest.raises(con.ContractError, match="reviewed nulls"):
        pipelines.write_release(broken, str(tmp_path / "never"), broken.panel.schema, ["year", "unit"])
    assert not (tmp_path / "never").exists()


def test_repeated_measure_is_a_violation(spark):
    from panelforge.operators import reshape

    long = spark.createDataFrame([("1", "a", 1.0), ("1", "a", 2.0), ("1", "b", 3.0)], "k string, slug string, v double")
    _, bad = reshape.rebuilt_wide(long.select("k").distinct(), long, ["k"], "slug", ["a", "b"], {"score": "v"})
    assert [(r["rule"], r["key"], r["detail"]) for r in bad.collect()] == [("measure repeated", "1|a", "2")]


def test_enforce_reports_every_rule(spark):
    df = spark.createDataFrame([("1", " "), ("1", "x")], "k string, v string")
    with pytest.raises(con.ContractError) as e:
        con.enforce(con.unique_key(df, ["k"]), con.not_blank(df, ["v"], ["k"]))
    assert [b[0] for b in e.value.broken] == ["blank", "duplicate key"]


def test_schema_differences(spark):
    declared = con.StructType.fromDDL("a int, b string")
    assert con.schema_differences(declared, declared) == []
    assert con.schema_differences(con.StructType.fromDDL("b string, a int"), declared) == ["columns are in another order"]
    assert con.schema_differences(con.StructType.fromDDL("a long"), declared)[0] == "missing b"


def test_block_contract(spark):
    slugs = ["overall", "t1"]
    metadata = spark.createDataFrame([("2024", "100")], "year string, unit string")
    long = spark.createDataFrame([("2024", "100", s, k, 50.0 + k) for k, s in enumerate(slugs)], "year string, unit string, slug string, ord int, score double")
    wide = spark.createDataFrame([("2024", "100", 50.0, 51.0)], "year string, unit string, overall_score double, t1_score double")
    columns = {"overall": "overall_score", "t1": "t1_score"}

    def check(m=metadata, lo=long, w=wide):
        return rules(pipelines.block_contract(m, lo, w, ["year", "unit"], "slug", slugs, "ord", "overall", "score", columns))

    assert check() == []
    assert "group" in check(lo=long.where("slug = 't1'"))
    assert "duplicate key" in check(m=metadata.union(metadata))
    assert "range" in check(lo=long.withColumn("score", F.lit(None).cast("double")))
    assert "long and wide differ" in check(w=wide.withColumn("t1_score", F.lit(7.0)))
    assert rules(pipelines.global_contract(metadata, long, ["year", "unit"], "slug", slugs, "ord", "overall", "score")) == []


@pytest.mark.parametrize(
    "expected, found, allowed, subset, confirmed, verdict",
    [
        ("12", "12", "", False, False, "exact_universe_match"),
        ("12", "1", "2", False, False, "reviewed_exception"),
        ("12", "12", "2", False, False, "error: missing units or stale exception"),
        ("12", "1", "", False, False, "error: missing units or stale exception"),
        ("12", "13", "", False, False, "error: unexpected units"),
        ("12", "1", "", True, False, "subset_in_partially_scored_state"),
        ("12", "", "", True, False, "error: unconfirmed absence"),
        ("12", "", "", True, True, "subset_in_partially_scored_state"),
    ],
)
def test_unit_verdicts(spark, expected, found, allowed, subset, confirmed, verdict):
    def codes(text):
        return spark.createDataFrame([("b", c) for c in text], "block string, code string")

    ledger = spark.createDataFrame([("b", list(allowed))] if allowed else [], "block string, codes array<string>")
    block = spark.createDataFrame([("b",)], "block string")
    none = block.where("1 = 0")
    out = statuses.unit_verdicts(codes(expected), codes(found), ["block"], "code", ledger, block if subset else none, block if confirmed else none)
    assert [r["verdict"] for r in out.collect()] == [verdict]


@pytest.mark.parametrize(
    "status, rows, confirmations, valid, options, decision",
    [
        (None, 0, 9, True, {}, "collect"),
        ("done", 5, 2, True, {}, "skip_done"),
        ("done", 5, 1, True, {}, "collect"),
        ("done", 5, 2, False, {}, "collect"),
        ("done", 5, 2, True, {"overwrite": True}, "collect"),
        ("done", 0, 2, True, {}, "skip_done"),
        ("done", 0, 2, True, {"retry_empty": True}, "redo"),
        ("done_no_data_available", 0, 2, True, {}, "skip_no_data"),
        ("done_no_data_available", 0, 2, True, {"retry_no_data": True}, "redo"),
    ],
)
def test_work_list(spark, status, rows, confirmations, valid, options, decision):
    df = spark.createDataFrame([(status, rows, confirmations, valid, False)], "status string, n_rows int, confirmations int, cache_valid boolean, re_verified boolean")
    assert statuses.work_list(df, statuses.WorkOptions(**options)).first()["decision"] == decision


def test_identity_by_signature(spark):
    units = spark.createDataFrame([("b", ["1", "2"], "x"), ("b", ["3", "4"], "x")], "base string, signature array<string>, unit string")
    links = spark.createDataFrame([("b", ["3", "4"], "200"), ("b", ["1", "2"], "100")], "base string, signature array<string>, new string")
    out, bad = joins.restore_by_signature(units, links, ["base"], "signature", {"unit": "new"})
    assert {(tuple(r["signature"]), r["unit"]) for r in out.collect()} == {(("1", "2"), "100"), (("3", "4"), "200")}
    assert rules(bad) == []
    _, short = joins.restore_by_signature(units.limit(1), links, ["base"], "signature", {"unit": "new"})
    assert rules(short) == ["signature multiset"]


def test_ledger_contract(spark):
    ledger = ledgers.LEDGERS["score_value_exceptions"]
    good = [("2024", "007", "t1", "seen", "p", "a" * 64)]
    df = spark.createDataFrame(good, ", ".join(f"{c} string" for c in ledger.columns))
    assert rules(ledgers.ledger_contract(df, ledger, ["t1"])) == []
    bad = spark.createDataFrame([("2024", "x", "t9", " ", "p", "zz"), *good, *good], df.schema)
    assert rules(ledgers.ledger_contract(bad, ledger, ["t1"])) == ["ledger blank", "ledger hash", "ledger id", "ledger key", "ledger measure"]


def test_summary_numbers(spark):
    blocks = spark.createDataFrame(
        [("2024", "S1", "D1", "done", 2, 110.0, 2), ("2024", "S1", "D1", "done_no_rows", None, None, None), ("2024", "S2", "D2", "done_no_data_available", None, None, None), ("2024", None, "D3", "done", 1, 1.0, 1)],
        "year string, state string, district string, status string, units long, measure_sum double, measure_n long",
    )
    states = {r["state"]: r for r in progress.state_summary(blocks).collect()}
    assert states["S1"]["mean"] == 55.0 and states["S1"]["units"] == 2 and states["S2"]["mean"] is None
    year = progress.year_summary(blocks).first()
    assert (year["states_total"], year["states_with_data"], year["districts"], year["blocks_no_data"]) == (2, 1, 3, 2)


def test_manifest_notices_a_changed_cell(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    declared = manifests.table_manifest({"t": df})
    manifests.require_manifest({"t": df.repartition(3)}, declared)
    with pytest.raises(con.ContractError):
        manifests.require_manifest({"t": df.withColumn("v", F.when(F.col("id") == 3, 1).otherwise(F.col("v")))}, declared)


def test_store(spark):
    from panelforge.plans import verification

    statuses_ = spark.createDataFrame([("b1", "done", 1, 2), ("b2", "failed", 0, 0)], "block_dir string, status string, unit_rows long, score_rows long")
    metadata = spark.createDataFrame([("2024", "100", "b1")], "year string, unit string, block_dir string")
    long = metadata.union(metadata)
    files = spark.createDataFrame([("p", "h")], "path string, sha256 string")
    sources = spark.createDataFrame([("p", "h")], "source_path string, source_sha256 string")
    none = con.holds(spark, True, "x")

    def check(s=statuses_.where("status = 'done'"), m=metadata, stored=files):
        return rules(verification.store(s, m, long, m, none, files, stored, sources, ["year", "unit"]))

    assert check() == []
    assert check(s=statuses_) == ["failed block"]
    assert check(m=metadata.union(metadata.withColumn("block_dir", F.lit("b3")))) == ["status rows", "unit in several blocks"]
    assert check(stored=files.withColumn("sha256", F.lit("other"))) == ["stale source", "stored files"]


def test_universe_build(spark):
    from panelforge.plans import verification

    units = spark.createDataFrame([("2024", "1"), ("2024", "2")], "year string, unit string")
    ends = spark.createDataFrame([("2024", 2)], "year string, n long")
    reviewed = spark.createDataFrame([("2024", "9", "1")], "year string, state_value string, district_value string")
    key = reviewed.columns
    assert rules(verification.universe_build(units, ends, reviewed, reviewed, ["year", "unit"], key)) == []
    assert rules(verification.universe_build(units.union(units), ends, reviewed.where("1 = 0"), reviewed, ["year", "unit"], key)) == ["endpoint rows", "exclusions", "universe key"]
