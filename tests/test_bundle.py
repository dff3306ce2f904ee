"""Logs with several writers, bundles and releases with manifests, incremental scans, and payloads kept as variants."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelforge.operators import reshape
from panelforge.operators.contracts import ContractError
from panelforge.plans import bundle, bundle_queries, registry
from panelforge.sources import commits, logs
from panelforge.streaming import blocks


def test_two_appenders_keep_one_order(spark, tmp_path):
    folder = str(tmp_path / "log")
    numbers, threads = [], []
    for w in range(2):

        def work(w=w):
            for k in range(3):
                rows = spark.createDataFrame([(w, k, i) for i in range(5)], "writer int, turn int, i int").repartition(3)
                numbers.append((w, k, commits.append(rows, folder, ["i"])))

        threads.append(threading.Thread(target=work))
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(n for *_, n in numbers) == list(range(6))
    rows = commits.read(spark, folder).orderBy(commits.ORDINAL).collect()
    assert len({r[commits.ORDINAL] for r in rows}) == len(rows) == 30
    wanted = [(w, k, i) for w, k, _ in sorted(numbers, key=lambda x: x[2]) for i in range(5)]
    assert [(r["writer"], r["turn"], r["i"]) for r in rows] == wanted
    for w in range(2):  # what one writer appends later stands later
        assert [n for x, _, n in numbers if x == w] == sorted(n for x, _, n in numbers if x == w)


def test_compaction_under_a_stream(spark, tmp_path):
    folder, seen = str(tmp_path / "log"), []

    def add(*rows):
        commits.append(spark.createDataFrame(list(rows), "k string, v int").coalesce(1), folder)

    def drain():
        commits.stream(spark, folder, lambda df, n: seen.extend((r["k"], r["v"], r[commits.ORDINAL]) for r in df.collect()), str(tmp_path / "ck")).awaitTermination()

    add(("a", 1), ("b", 2))
    drain()
    add(("a", 3))
    assert commits.compact(spark, folder) == 1
    add(("c", 4))
    drain()
    batch = sorted((r["k"], r["v"], r[commits.ORDINAL]) for r in commits.read(spark, folder).collect())
    assert sorted(seen) == batch and len(batch) == 4
    assert commits.compact(spark, folder) == 2
    assert sorted((r["k"], r["v"], r[commits.ORDINAL]) for r in commits.read(spark, folder).collect()) == batch
    with pytest.raises(ContractError):
        commits.read(spark, str(tmp_path / "none"))


def test_a_file_is_placed_once(spark, tmp_path):
    path = f"file://{tmp_path}/c/1.json"
    assert commits.put_if_absent(spark, path, "one") and not commits.put_if_absent(spark, path, "two")
    assert (tmp_path / "c/1.json").read_text() == "one"
    assert [p.name for p in (tmp_path / "c").iterdir() if p.suffix == ".json"] == ["1.json"]


def test_append_to_a_log_without_order(spark, tmp_path):
    old = spark.createDataFrame([("a", "done")], "code string, status string")
    old.write.parquet(str(tmp_path / "old"))
    with pytest.raises(ContractError, match="without its order"):
        logs.append_log(old, str(tmp_path / "old"))
    logs.append_log(old, str(tmp_path / "new"))
    logs.append_log(old.withColumn("status", F.lit("failed")), str(tmp_path / "new"))
    rows = logs.read_log(spark, str(tmp_path / "new"), None)
    assert [r["status"] for r in rows.orderBy(*logs.ORDER).collect()] == ["done", "failed"]
    old.write.mode("append").parquet(str(tmp_path / "new"))  # by another hand
    with pytest.raises(ContractError, match="without its order"):
        logs.append_log(old, str(tmp_path / "new"))
    (tmp_path / "empty").mkdir()
    logs.append_log(old, str(tmp_path / "empty"))
    assert spark.read.parquet(str(tmp_path / "empty")).count() == 1


SLUGS = ["overall", "t1"]


def source(spark, universe_rows=3, stated=2):
    metadata = spark.createDataFrame([("2024", "S", "1", "b"), ("2024", "S", "2", "b")], "year string, state string, unit string, block_dir string")
    long = metadata.select("year", "unit", "block_dir", F.explode(F.array(*(F.struct(F.lit(s).alias("slug"), F.lit(k).alias("ord"), F.lit(5.0).alias("score")) for k, s in enumerate(SLUGS)))).alias("m")).select("year", "unit", "block_dir", "m.*")
    wide = metadata.select("year", "unit", F.lit(5.0).alias("overall_score"), F.lit(5.0).alias("t1_score"))
    statuses = spark.createDataFrame([("b", "done", stated, 4)], "block_dir string, status string, unit_rows long, score_rows long")
    log = spark.createDataFrame([("2024", "b", "failed", 1), ("2024", "b", "done", 2), ("2024", "", "x", 3)], "year string, block_dir string, status string, log_at int")
    universe = spark.createDataFrame([("2024", str(k), "S") for k in range(1, universe_rows + 1)], "year string, unit string, state string")
    counts = spark.createDataFrame([("2024", 3)], "year string, n long")
    return bundle.BundleSource(metadata, long, wide, statuses, log, log.drop("log_at"), universe, counts)


RULES = bundle.BundleRules(["year", "unit"], ["block_dir"], "slug", SLUGS, "ord", "overall", "score", ["state"])


def test_bundle_is_declared_only_if_whole(spark, tmp_path):
    parts = bundle.rebuild(spark, source(spark), RULES, str(tmp_path / "good"))
    assert {r["name"]: r["rows"] for r in parts["manifest"].collect()} == {"metadata": 2, "long": 4, "wide": 2, "runs": 2, "options": 3, "universe": 3}
    back = bundle.read_declared(spark, str(tmp_path / "good"), ["metadata", "universe"])
    assert back["metadata"].count() == 2
    for k, (bad, rule) in enumerate(((source(spark, stated=3), "status rows"), (source(spark, universe_rows=1), "orphan"), (source(spark, universe_rows=4), "universe rows"))):
        with pytest.raises(ContractError, match=rule):
            bundle.rebuild(spark, bad, RULES, str(tmp_path / f"bad{k}"))
        assert not (tmp_path / f"bad{k}" / "manifest").exists()
    back["metadata"].limit(1).write.mode("append").parquet(str(tmp_path / "good" / "metadata"))
    with pytest.raises(ContractError, match="manifest"):
        bundle.read_declared(spark, str(tmp_path / "good"), ["metadata"])
    with pytest.raises(ContractError, match="vintage without rows"):
        bundle.rebuild(spark, source(spark), RULES, str(tmp_path / "none"), ["2031"])


def test_second_scan_reads_new_blocks_only(spark, tmp_path):
    schema = StructType.fromDDL("unit string, n int")

    def add(name, *rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.parquet(str(tmp_path / "tree" / name))

    def scan():
        blocks.scan_new(spark, str(tmp_path / "tree"), schema, str(tmp_path / "table"), str(tmp_path / "ck"))

    add("2024/a", ("1", 1), ("2", 2))
    scan()
    before = spark.read.parquet(str(tmp_path / "table")).agg(F.max("batch")).first()[0]
    add("2024/b", ("3", 3))
    add("2025/a", ("4", 4))
    scan()
    new = spark.read.parquet(str(tmp_path / "table")).where(F.col("batch") > before)
    assert sorted((r["block_dir"], r["unit"]) for r in new.collect()) == [("2024/b", "3"), ("2025/a", "4")]
    whole = {(r["block_dir"], r["unit"], r["n"]) for r in blocks.scanned(spark, str(tmp_path / "table")).collect()}
    assert whole == {("2024/a", "1", 1), ("2024/a", "2", 2), ("2024/b", "3", 3), ("2025/a", "4", 4)}


def test_variant_rows_keep_what_they_cannot_read(spark):
    bodies = ['{"id": 7, "name": "x"}', '{"id": "many", "name": null}', '{"id": 1, "name": "y", "more": [1], "also": 2}', "{", None, "[1, 2]", '{"id": 1.5}']
    df = spark.createDataFrame(list(enumerate(bodies)), "p int, body string")
    rows = {r["p"]: r for r in reshape.variant_rows(df, ["p"], "body", {"id": ("$.id", "long"), "name": ("$.name", "string")}, ["id", "name"]).drop("payload").collect()}
    assert len(rows) == 7
    assert (rows[0]["id"], rows[0]["name"], rows[0]["problem"]) == (7, "x", None)
    assert rows[1]["id"] is None and rows[1]["problem"] == "id is no number"
    assert rows[2]["problem"] == "extra: also,more" and rows[3]["problem"] == rows[4]["problem"] == "unreadable"
    assert rows[5]["id"] is None and rows[5]["problem"] is None


def test_no_fixed_number_of_tasks_in_the_manifest(spark, sf_dir):
    """Tables that are dealt out anew go to as many tasks as their size asks for."""
    found = registry.queries()["table_manifest"](spark, sf_dir)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in text and "REPARTITION_BY_NUM" not in text


def test_blocks_of_a_source_are_read_once(spark, sf_dir):
    """The tables of a bundle's source come from rows written once, not each from the tree and the paths of its files."""
    source = bundle_queries._source(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)
    for df in (source.metadata, source.long, source.wide, source.universe):
        assert df.inputFiles() and all("/rows/" in path for path in df.inputFiles())
    assert source.metadata.count() == source.wide.count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
