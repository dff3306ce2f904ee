"""Files in, files out: trees of blocks, logs, payloads, typed tables, the stream."""

import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from panelforge.functions import text as fn
from panelforge.operators import reshape, windows
from panelforge.operators.contracts import ContractError, StructType
from panelforge.plans import pipelines, progress
from panelforge.sources import logs, payloads, tables, trees
from panelforge.streaming import progress as stream


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression().alias("x")).first()["x"]


@pytest.mark.parametrize(
    "expression, value, wanted",
    [
        (lambda: fn.clean_label("v"), " Agra [118] ", "Agra"),
        (lambda: fn.collapse_space("v"), " a  \tb\n", "a b"),
        (lambda: fn.slugify("v"), " Poverty free! ", "poverty_free"),
        (lambda: fn.safe_component("v"), "../a b/c [9]", "a_b_c"),
        (lambda: fn.first_number("v"), "about -3.50 of 7", -3.5),
        (lambda: fn.canonical_score("v"), " 50.10 ", "50.1"),
        (lambda: fn.canonical_score("v"), "-0.0", "0"),
        (lambda: fn.canonical_score("v"), " ", ""),
        (lambda: fn.canonical_score("v"), "NaN", None),
        (lambda: fn.canonical_id("v"), " 0272 ", "0272"),
        (lambda: fn.canonical_id("v"), "0", None),
        (lambda: fn.normalize_name("v"), " ＡＢ  Straße ", "ab strasse"),
        (lambda: fn.unescape("v"), "a &amp; &eacute;", "a & é"),
        (lambda: fn.strip_tags("v"), "<b>a</b> &lt;x&gt;", "a <x>"),
        (lambda: fn.code_from_url("v", "gp"), "/c?x=1&gp=" + base64.b64encode(b"1001").decode().rstrip("="), "1001"),
        (lambda: fn.code_from_url("v", "gp"), "/c?gp=%%%", ""),
        (lambda: fn.classify_indicator("v", F.lit("n"), F.lit("")), "Number of homes", "number"),
        (lambda: fn.classify_indicator("v", F.lit("n"), F.lit("N")), "Whether so", "binary"),
        (lambda: fn.classify_indicator("v", F.lit("n"), F.lit("d")), "Whether so", "ratio"),
    ],
)
def test_functions(spark, expression, value, wanted):
    assert one(spark, value, expression) == wanted


def test_block_tree(spark, tmp_path):
    for name, rows in (("a", 2), ("b", 1)):
        block = tmp_path / "2024" / name
        (block / "html").mkdir(parents=True)
        spark.createDataFrame([(str(k), "1") for k in range(rows)], "unit string, block_page string").coalesce(1).write.parquet(str(block / "t"))
        part = next((block / "t").glob("*.parquet"))
        part.rename(block / "scores.parquet")
        for f in (block / "t").iterdir():
            f.unlink()
        (block / "html" / "page_001.html").write_text("<p>x</p>")
    (tmp_path / "2024" / "a" / "DONE.json").write_text(json.dumps({"status": "done", "state": "S"}))
    (tmp_path / "2024" / "a" / "FAILED.json").write_text(json.dumps({"status": "failed"}))
    (tmp_path / "2024" / "b" / "DONE.json").write_text("{broken")
    root = str(tmp_path)
    df = trees.with_provenance(trees.read_tables(spark, root, "scores.parquet", StructType.fromDDL("unit string, block_page string")))
    assert {(r["block_dir"], r["block_html_file"]) for r in df.collect()} == {(f"2024/{b}", f"2024/{b}/html/page_001.html") for b in "ab"}
    found = {r["block_dir"]: r["status"] for r in trees.read_statuses(spark, root, StructType.fromDDL("status string, state string")).collect()}
    assert found == {"2024/a": "done", "2024/b": "done_unreadable_json"}
    kinds = {r["kind"]: r["files"] for r in trees.sizes_by_kind(trees.inventory(spark, root)).collect()}
    assert kinds["html"] == 2 and kinds["status"] == 3 and kinds["table"] == 2
    assert trees.read_pages(spark, root).count() == 2


def test_log_order_and_fold(spark, tmp_path):
    history = spark.createDataFrame([("007", "done")], "code string, old_status string")
    tail = spark.createDataFrame([("008", "failed"), ("007", "failed")], "code string, status string").coalesce(1)
    log = logs.combined_log(history, tail, {"old_status": "status"})
    last = windows.last_rows(log.withColumn("o", logs.ordinal()), ["code"], "o")
    assert {(r["code"], r["status"]) for r in last.collect()} == {("007", "failed"), ("008", "failed")}
    once = logs.fold_log(history, tail, str(tmp_path / "one"), {"old_status": "status"})
    twice = logs.fold_log(once, tail, str(tmp_path / "two"))
    assert once.count() == twice.count() == 3
    (tmp_path / "tail.csv").write_text("code,status\n009,\n")
    assert [tuple(r)[:2] for r in logs.read_log(spark, None, str(tmp_path / "tail.csv")).collect()] == [("009", "")]


def test_typed_tables(spark, tmp_path):
    declared = tables.declared([("k", "string"), ("n", "int")])
    df = spark.createDataFrame([("b", "2"), ("a", "1")], "k string, n string")
    assert tables.write_checked(df, str(tmp_path / "t"), declared, ["k"]).count() == 2
    assert tables.typed_parquet(spark, str(tmp_path / "t"), declared).count() == 2
    with pytest.raises(ContractError):
        tables.typed_parquet(spark, str(tmp_path / "t"), tables.declared([("k", "string")]))
    with pytest.raises(ContractError):
        tables.vintages(df, "k", ["a", "z"])
    (tmp_path / "x.csv").write_text("k,n\n,1\n")
    assert tuple(tables.typed_csv(spark, str(tmp_path / "x.csv"), declared).first()) == ("", 1)


def test_payload_rows(spark):
    def rows(body, sentinel="last"):
        df = spark.createDataFrame([("p", body)], "place string, body string")
        found, sentinels, bad = reshape.payload_rows(df, ["place"], "body", "id", sentinel=sentinel)
        return [(r["id"], r["label"]) for r in found.collect()], {r["rule"] for r in bad.collect()}

    good = {"columns": ["id", "nm"], "rows": [[272000, "A [272000]"], [None, None]]}
    assert rows(json.dumps(good)) == ([("272000", "A [272000]")], set())
    first = {"columns": ["id", "nm"], "rows": [[None, None], [1, "A [1]"]]}
    assert rows(json.dumps(first))[1] == {"payload row"}
    assert rows(json.dumps(first), "any")[1] == set()
    twice = {"columns": ["id", "nm"], "rows": [[1, "A"], [1, "B"]]}
    assert rows(json.dumps(twice))[1] == {"duplicate id"}
    assert "payload shape" in rows("{nonsense")[1]


def test_universe_from_payloads(spark, tmp_path):
    block = tmp_path / "b1"
    block.mkdir()
    body = json.dumps({"columns": ["gp_code", "nm"], "rows": [[7, "Seven [7]"]]})
    (block / "gps.json").write_text(body)
    side = {"year": "2024", "state": "S", "http_status": 200, "n_rows": 1, "sha256": hashlib.sha256(body.encode()).hexdigest()}
    (block / "source.json").write_text(json.dumps(side))
    stored = payloads.stored_payloads(spark, str(tmp_path), "gps.json")
    units, bad = payloads.universe_from_payloads(stored, payloads.stored_provenance(spark, str(tmp_path), "source.json"))
    assert [(r["unit"], r["unit_name"], r["state"]) for r in units.collect()] == [("7", "Seven", "S")]
    assert bad.isEmpty()
    (block / "source.json").write_text(json.dumps(side | {"sha256": "0" * 64, "n_rows": 2}))
    _, bad = payloads.universe_from_payloads(stored, payloads.stored_provenance(spark, str(tmp_path), "source.json"))
    assert bad.first()["detail"] == "hash,rows"


def test_universe_from_levels(spark):
    def response(level, parent, *rows):
        return ("2024", level, parent, json.dumps({"columns": ["id", "nm"], "rows": [[i, f"{n} [{i}]"] for i, n in rows]}), level)

    levels = spark.createDataFrame(
        [response("state", "", (9, "North")), response("district", "9", (118, "Agra"), (119, "Out")), response("block", "9/118", (803, "Achh")), response("unit", "9/118/803", (1001, "V1"), (1002, "V2"))],
        "year string, level string, parent string, body string, sha256 string",
    )
    exclusions = spark.createDataFrame([("2024", "9/119", "district")], "year string, path string, source_sha256 string")
    units, _, bad = payloads.universe_from_levels(levels, ["state", "district", "block", "unit"], exclusions)
    assert {(r["state"], r["district_value"], r["unit"]) for r in units.collect()} == {("North", "118", "V1"), ("North", "118", "V2")}
    assert bad.isEmpty()


def test_indicator_contract(spark):
    versions = spark.createDataFrame([("v1", "2022", 1, 1)], "version string, fiscal_year string, n_rows long, n_ids long")
    themes = spark.createDataFrame([(1, "t1")], "number int, slug string")
    row = ("v1", "2022", 1, "t1", 469, "Mandatory", "ratio", "i", "n", "d")
    schema = "version string, fiscal_year string, theme_number int, theme_slug string, indicator_id long, mandatory string, kind string, indicator string, numerator string, denominator string"
    key = ["version", "theme_number", "indicator_id"]

    def check(r):
        return {x["rule"] for x in pipelines.indicator_contract(spark.createDataFrame([r], schema), key, ["indicator"], versions, themes).collect()}

    assert check(row) == set()
    assert check((*row[:5], "Maybe", "ratio", "", "n", "")) == {"mandatory", "blank", "ratio without denominator"}


def test_stream_equals_batch(spark, tmp_path):
    rows = [("2024", "S", str(k % 7), "d", s, k) for k, s in enumerate(["done", "failed", "started", "skipped_done"] * 10)]
    log = spark.createDataFrame(rows, "year string, state string, block_value string, block_dir string, status string, ordinal long")
    batch = progress.latest(log, ["year", "state", "block_value"]).groupBy("state", "bucket").count()
    streamed = stream.drained_progress(spark, log, ["year", "state", "block_value"], "state")
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, streamed.collect()))
