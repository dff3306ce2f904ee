"""Agreement by one aggregate, versions, segmented scans, and layouts that spare shuffles and files."""

import datetime
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelforge.functions import text as fn
from panelforge.operators import aggregates, agreement, reshape, windows
from panelforge.plans import pipelines, registry
from panelforge.sources import tables, versions
from panelforge.spec import PanelSpec


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """The number of files that the only scan of a plan reads."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    node = node.executedPlan() if node.nodeName().startswith("Adaptive") else node
    while node.children().size():
        node = node.children().apply(0)
    return node.metrics().apply("numFiles").value()


def rules(df):
    return sorted({r["rule"] for r in df.collect()})


def test_balance_is_one_shuffle(spark):
    a = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "k string")
    b = spark.createDataFrame([(1, "x"), (3, "x"), (3, "y")], "k int, v string")
    both = agreement.balance({"a": a, "b": b}, ["k"], {"b": ["v"]}, {"x": F.count_if(F.col("__v") == "x")})
    assert {r["k"]: (r["n_a"], r["n_b"], r["x"]) for r in both.collect()} == {"1": (2, 1, 1), "2": (1, 0, 0), "3": (0, 2, 1), None: (1, 0, 0)}
    assert len(re.findall(r"Exchange hashpartitioning", both._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1])) == 1


SLUGS = ["overall", "t1"]


def three(spark, units=("100", "101"), legacy=()):
    metadata = spark.createDataFrame([("2023" if u in legacy else "2024", u, "S", "/u") for u in units], "year string, unit string, state string, url string")
    long = metadata.select("year", "unit", F.explode(F.array(*(F.struct(F.lit(s).alias("slug"), F.lit(k).alias("ord"), F.lit(50.0 + k).alias("score")) for k, s in enumerate(SLUGS)))).alias("r")).select("year", "unit", "r.*")
    wide = metadata.select("year", "unit", F.lit(50.0).alias("overall_score"), F.lit(51.0).alias("t1_score"))
    return metadata, long, wide


def test_keys_of_equal_number_that_differ(spark):
    metadata, long, wide = three(spark)
    other = long.withColumn("unit", F.when(F.col("unit") == "101", "102").otherwise(F.col("unit")))

    def check(m=metadata, lo=long, w=wide, **more):
        return rules(pipelines.global_contract(m, lo, ["year", "unit"], "slug", SLUGS, "ord", "overall", "score", wide=w, **more))

    assert check() == []
    assert check(lo=other) == ["keys differ"]
    assert check(w=wide.limit(1)) == ["keys differ", "wide conservation"]
    assert "wide key" in check(w=wide.union(wide))
    assert "duplicate key" in check(m=metadata.union(metadata.limit(1)))
    same_place = long.withColumn("ord", F.lit(3))
    assert check(lo=same_place) == ["group"]
    assert check(m=metadata.withColumn("url", F.lit(" ")), legacy="2023", later=["url"]) == ["identity"]
    assert check(m=metadata.withColumn("url", F.lit(" ")), legacy="2024", later=["url"]) == []
    declared = metadata.schema
    assert check(m=metadata.drop("url"), schemas={"metadata": declared}) == ["metadata schema"]


def test_controls_of_present_vintages(spark):
    metadata = three(spark)[0]
    controls = spark.createDataFrame([("2024", "S", 2), ("2024", "__total__", 2), ("2025", "S", 9), ("2025", "__total__", 9)], "year string, state string, n long")

    def check(m=metadata, c=controls, e=None):
        return sorted((r["key"], r["detail"]) for r in pipelines.national_controls(m, c, e, "year", "state").collect())

    assert check() == []
    unlisted = metadata.unionAll(metadata.limit(1).withColumn("state", F.lit("T")))
    assert check(m=unlisted) == []
    more = controls.unionAll(spark.createDataFrame([("2024", "U", 5)], controls.schema))
    assert check(c=more) == [("2024|U", "unobserved 5")]
    short = spark.createDataFrame([("2024", "S", 4, 2)], "year string, state string, official_count long, portal_count long")
    official = controls.withColumn("n", F.when(F.col("year") == "2024", 4).otherwise(F.col("n")).cast("long"))
    assert check(c=official, e=short) == []
    assert check(c=controls, e=short)[0] == ("2024|S", "exception disagrees 2 2")


def test_wrong_blocks_do_not_cancel_out(spark):
    long = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "2"), ("b", "2")], "block string, unit string")
    metadata = spark.createDataFrame([("a", "1"), ("b", "2")], "block string, unit string")
    both = agreement.balance({"metadata": metadata, "long": long}, ["block", "unit"])
    assert agreement.conserved(both, [], "long", "metadata", 2).count() == 0
    assert [r["key"] for r in agreement.conserved(both, ["block"], "long", "metadata", 2).orderBy("key").collect()] == ["a|1|1", "b|3|1"]


def test_verified_fields(spark):
    spec = PanelSpec("year", "unit", (("state_value", "state"),), ("a",))
    panel = spark.createDataFrame([("2024", "1", "9", "North", True, 5.0, "/u"), ("2024", "2", "9", "North", False, None, None)], "year string, unit string, state_value string, state string, score_available boolean, a double, url string")
    none = spark.createDataFrame([], "year string, unit string, measure string")

    def check(p, **more):
        coverage = aggregates.coverage(p, ["year"])
        by_state = aggregates.coverage_with_label(p, ["year", "state_value"], "state", ["state_value", "unit"])
        return rules(pipelines.verify_release(p, spec, coverage, by_state, none, "url", **more))

    assert check(panel, schema=panel.schema, vintages=["2024"]) == []
    assert check(panel.withColumn("state", F.when(F.col("unit") == "2", " ").otherwise("North"))) == ["blank"]
    assert check(panel.withColumn("url", F.coalesce("url", F.lit("")))) == ["unscored with values"]
    assert check(panel, vintages=["2024", "2025"]) == ["vintages"] == check(panel, vintages=[])
    assert check(panel.withColumn("x", F.lit(1)), schema=panel.schema) == ["schema"]
    controls = spark.createDataFrame([("2024", "9", 1), ("2024", "__total__", 1)], "year string, state_value string, n long")
    assert check(panel, controls=controls, group="state_value") == []
    assert check(panel, controls=controls.withColumn("n", F.col("n") + 1), group="state_value") == ["control totals"]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_a_microsecond_changes_the_digest(spark, kind):
    at = datetime.datetime(2024, 1, 1, 12, 0, 0, 123456)
    one = spark.createDataFrame([(1, at)], f"k int, t {kind}")
    two = spark.createDataFrame([(1, at.replace(microsecond=123457))], f"k int, t {kind}")
    digests = {aggregates.multiset_digest(df).first()["digest"] for df in (one, two)}
    assert len(digests) == 2
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    assert aggregates.multiset_digest(one).first()["digest"] in digests
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_only_what_differs_is_read(spark, tmp_path, capsys):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("v"))
    later = rows.where("id <> 40").unionAll(rows.where("id = 50")).withColumn("v", F.when(F.col("id") == 70, F.lit("")).otherwise(F.col("v")))
    versions.store(rows, f"{tmp_path}/a")
    versions.store(later.repartition(3), f"{tmp_path}/b")
    found = versions.compare(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert sorted((r["id"], r["v"], r["change"]) for r in found.rows.collect() if r["v"] is not None) == [(40, "40", -1), (50, "50", 1), (70, "", 1)]
    assert [(r["id"], r["change"]) for r in found.rows.collect() if r["v"] is None] == [(70, -1)]
    assert 1 <= len(found.branches) <= 4
    found.rows.explain("formatted")
    scans = re.findall(r"PartitionFilters: \[([^\n]*__branch[^\n]*)\]", capsys.readouterr().out)
    assert scans and all(f"IN ({','.join(map(str, found.branches))})" in x or f"= {found.branches[0]}" in x for x in scans)
    same = versions.compare(spark, f"{tmp_path}/a", f"{tmp_path}/a")
    assert same.branches == [] and same.rows.count() == 0
    assert sorted(versions.load(spark, f"{tmp_path}/a").collect()) == sorted(rows.collect())
    empty = rows.where("false")
    versions.store(empty, f"{tmp_path}/c")
    assert versions.compare(spark, f"{tmp_path}/c", f"{tmp_path}/a").rows.count() == 5000


@pytest.mark.parametrize("seed", range(4))
def test_stretches_over_ranges(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("xy"), rng.choice(["a", "b", None]) if seed else "a", i) for i in range(300)]
    wanted = {}
    for scoped in (False, True):
        runs, last = Counter(), {}
        for s, k, _ in rows:
            at = s if scoped else ""
            if (at not in last) or last[at] != k:
                runs[(at, k)] += 1
            last[at] = k
        wanted[scoped] = {key: n for key, n in runs.items() if n > 1}
    df = spark.createDataFrame(rows, "s string, k string, i int").repartition(5)
    found = windows.broken_stretches(df, ["k"], "i")
    assert {("", r["k"]): r["runs"] for r in found.collect()} == wanted[False]
    found = windows.broken_stretches(df, ["k"], "i", ["s"])
    assert {(r["s"], r["k"]): r["runs"] for r in found.collect()} == wanted[True]


def test_levels_are_counted_from_below(spark):
    rows = [(y, a, b, c) for y in ("1", "2") for a in (1, None) for b in range(3) for c in range(b + 1)] * 2
    df = spark.createDataFrame(rows, "y string, a int, b int, c int")
    levels = {"top": ["a"], "middle": ["a", "b"], "leaf": ["a", "b", "c"]}
    found = aggregates.level_counts(df, "y", levels)
    assert sorted(tuple(r) for r in found.collect()) == [("1", 2, 6, 12), ("2", 2, 6, 12)]
    assert "Expand" not in plan(found)
    apart = aggregates.level_counts(df, "y", {"top": ["a"], "other": ["b"]})
    assert sorted(tuple(r) for r in apart.collect()) == [("1", 2, 3), ("2", 2, 3)]
    finer = aggregates.level_counts(df, "y", levels, ["a"])
    assert sorted((r["y"], r["a"] or 0, r["top"], r["middle"], r["leaf"]) for r in finer.collect()) == [(y, a, 1, 3, 6) for y in "12" for a in (0, 1)]


def test_bucketed_join_has_no_exchange(spark, sf_dir):
    from panelforge.plans import registry

    panel = registry.queries()["bucketed_panel"](spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        panel = panel.select("*")
        assert "Exchange" not in plan(panel)
        assert panel.count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_other_vintages_keep_their_files(spark, tmp_path):
    folder = str(tmp_path / "v")
    df = spark.range(300).select((F.col("id") % 3).alias("year"), "id")
    tables.replace_vintages(df, folder, "year", ["id"])

    def files(year):
        return {(f, os.stat(f"{folder}/year={year}/{f}").st_mtime_ns) for f in os.listdir(f"{folder}/year={year}") if f.endswith(".parquet")}

    before = {y: files(y) for y in range(3)}
    tables.replace_vintages(df.where("year = 1 and id < 30"), folder, "year", ["id"])
    after = {y: files(y) for y in range(3)}
    assert before[0] == after[0] and before[2] == after[2] and not before[1] & after[1]
    found = spark.read.parquet(folder).where("year = 1")
    assert found.count() == 10 and "PartitionFilters: [isnotnull(year" in plan(found)
    assert files_read(found) == len(after[1])
    wanted = spark.createDataFrame([(2,)], "year long").where("year > 0")
    pruned = spark.read.parquet(folder).join(F.broadcast(wanted), "year")
    assert pruned.count() == 100 and "dynamicpruning" in plan(pruned).lower()


@pytest.mark.parametrize("seed", range(5))
def test_blocks_are_compared_by_sums_first(spark, seed):
    rng = random.Random(seed)
    sides = []
    for _ in range(2):
        rows = [(b, rng.choice(["1", "2", "3", None])) for b in range(12) for _ in range(rng.randrange(0, 5))]
        sides.append(rows + [(b, c) for b in range(12, 16) for c in ("7", "8", "8")])
    u, s = ({b: {c for x, c in rows if x == b and c is not None} for b in {x for x, _ in rows}} for rows in sides)
    frames = [spark.createDataFrame(rows, "b int, c string") for rows in sides]
    found = {r["b"]: r for r in aggregates.block_differences(*frames, ["b"], "c").collect()}
    assert found.keys() == u.keys() | s.keys()
    for b, r in found.items():
        mine, theirs = u.get(b, set()), s.get(b, set())
        assert (r["missing"] or [], r["unexpected"] or []) == (sorted(mine - theirs), sorted(theirs - mine))
        assert (r["n_live"] == 0) == (not theirs) and (b < 12 or r["missing"] is None)
    audit = {r["b"]: (r["universe"], r["live"], r["delta"], r["missing"], r["unexpected"]) for r in aggregates.block_audit(*(f.where("c is not null") for f in frames), ["b"], "c").collect()}
    for b, (n, m, delta, missing, unexpected) in audit.items():
        mine, theirs = u.get(b, set()), s.get(b, set())
        assert (n, m, delta, missing, unexpected) == (len(mine), len(theirs), len(theirs) - len(mine), ";".join(sorted(mine - theirs)), ";".join(sorted(theirs - mine)))


def test_rows_of_a_response_do_not_carry_it(spark):
    """A response of many rows is exploded without a copy of the response on each of them."""
    listed = ",".join(f'["{k}","n [{k}]"]' for k in range(1, 3001))
    df = spark.createDataFrame([("a", f'{{"columns":["id","nm"],"rows":[{listed},[null,null]]}}')], "place string, body string")
    found, sentinels, bad = reshape.payload_rows(df, ["place"], "body", "id")
    for each in (found, sentinels, bad):
        carried = re.findall(r"Generate posexplode\(.*?\), \[(.*?)\]", plan(each))
        assert carried and all(re.fullmatch(r"place#\d+(, __n#\d+)?", c) for c in carried), carried
    assert sorted(r["position"] for r in found.collect()) == list(range(3000))
    assert [tuple(r) for r in sentinels.collect()] == [("a", 1)] and bad.count() == 0


def test_dealt_rows_need_no_other_shuffle(spark, sf_dir):
    """Parts grow in number with the table, and what groups or joins by the key stays in them."""
    assert tables.dealt(spark.range(1000), ["id"], rows=10).rdd.getNumPartitions() == 100
    assert tables.dealt(spark.range(0), ["id"]).count() == 0
    text = plan(registry.queries()["block_audit"](spark, sf_dir))
    assert "REPARTITION_BY_NUM" in text and "ENSURE_REQUIREMENTS" not in re.sub("BroadcastExchange.*", "", text)


def repaired(spark, units, long, links, **more):
    """The repair of ``units`` (row, block, unit, url, t1, t2) with ``long`` (row, header, score) and ``links`` (block, t1, t2, code)."""
    wide = spark.createDataFrame(units, "row_id long, block int, unit string, url string, t1_score double, t2_score double")
    rows = spark.createDataFrame(long, "row_id long, theme_header string, score double").withColumns({"unit": F.lit("old"), "url": F.lit("")})
    linked = spark.createDataFrame(links, "block int, t1 double, t2 double, new_code string")
    vectors = linked.select("block", fn.score_signature(["t1", "t2"]).alias("signature"), "new_code", F.lit("").alias("new_url"))
    headers = spark.createDataFrame([("Head one", "t1"), ("Head two", "t2")], "theme_header string, theme_slug string")
    return pipelines.repaired_blocks(wide.select("row_id", "unit", "url"), rows, wide, vectors, headers, ["block"], ["t1_score", "t2_score"], "unit", **more)


def test_rows_of_a_repair_meet_in_parts_of_fixed_size(spark, tmp_path, monkeypatch):
    """Every join and grouping by unit has as many parts as its rows need, and staged results need none again."""
    units = [(k, k % 3, "old", "/card?unit=MTI=" if k == 5 else "", None if k == 6 else float(k % 4), 2.0) for k in range(10)]
    units[9] = (9, None, "old", "", 1.0, 2.0)  # in no block: no link is for it
    long = [(k, h, s) for k, _, _, _, a, b in units for h, s in ((" Head  one", a), ("Head two ", b))]
    long.remove((3, "Head two ", 2.0))
    long += [(4, "Head one", 0.5), (7, "Head three", 1.0), (99, "Head four", 1.0), (None, "Head one", 1.0)]
    links = [(1, 1.0, 2.0, "L1"), (1, 3.0, 2.0, "L7"), (2, 0.0, 2.0, "L8"), (0, 0.0, 2.0, "L0"), (0, 1.0, 2.0, "none")]
    links[4] = (0, 9.0, 2.0, "none")
    monkeypatch.setattr(tables, "parts", lambda df, rows=0: 7)
    plain, bad = repaired(spark, units, long, links)
    placed = [int(n) for n in re.findall(r"Exchange hashpartitioning\(row_id#\w+, (\d+)\)", plan(plain["wide"]))]
    assert placed and set(placed) == {7}, placed
    staged, found = repaired(spark, units, long, links, staging=str(tmp_path / "staged"))
    text = plan(staged["wide"])
    assert "Exchange" not in text and "Aggregate" not in text
    assert {"vectors", "headers", "marked", "ids", "long", "measures", "wide"} == set(os.listdir(tmp_path / "staged"))
    codes = {k: "old" for k in range(10)} | {1: "L1", 7: "L7", 8: "L8", 0: "L0", 5: "12"}
    for out, violated in ((plain, bad), (staged, found)):
        rows = {r["row_id"]: r for r in out["wide"].collect()}
        assert {k: r["unit"] for k, r in rows.items()} == codes
        assert out["wide"].columns == ["row_id", "unit", "url", "t1_score", "t2_score"]
        for k, _, _, _, a, b in units:
            assert rows[k]["t1_score"] == a or k == 4 and rows[k]["t1_score"] == 0.5
            assert rows[k]["t2_score"] == (None if k == 3 else b)
        assert {(r["row_id"], r["unit"]) for r in out["long"].collect()} == set(codes.items())
        assert sorted(tuple(r) for r in violated.collect()) == [
            ("measure repeated", "4|t1", "2"), ("measures missing", "3", "1"),
            ("signature multiset", "0|9|2", ""), ("unknown header", "Head three", ""),
        ]


def test_measures_by_one_aggregate(spark):
    """Values and row counts of measures need one grouping; a measure that never occurs, blank names and blank keys count as stated."""
    rows = [(1, "a", 1.0, "x"), (1, "b", None, "y"), (1, "b", 3.0, "z"), (2, "c", 4.0, "x"), (3, None, 5.0, "x"), (None, "a", 1.0, "x"), (None, "a", 1.0, "x")]
    long = spark.createDataFrame(rows, "k int, slug string, v double, g string")
    metadata = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    wide, bad = reshape.rebuilt_wide(metadata, long, ["k"], "slug", ["a", "b"], {"v": "v", "g": "g"})
    assert wide.columns == ["k", "a_v", "a_g", "b_v", "b_g"]
    found = {r["k"]: tuple(r)[1:] for r in wide.collect()}
    assert found[1][:3] == (1.0, "x", 3.0) and found[1][3] in ("y", "z") and found.keys() == {1, 2, 3, 4}
    assert {found[k] for k in (2, 3, 4)} == {(None,) * 4}
    assert sorted(tuple(r) for r in bad.collect()) == [
        ("measure repeated", "1|b", "2"), ("measure repeated", "<null>|a", "2"),
        ("measures missing", "2", "0"), ("measures missing", "3", "0"), ("measures missing", "4", ""),
    ]
    text = plan(reshape.counted_measures(long.select("k", "slug", "v"), ["k"], "slug", ["a", "b"], {"v": "v"}))
    assert len(re.findall(r"HashAggregate\(keys", text.split("Initial Plan")[-1])) == 2  # one partial, one final
