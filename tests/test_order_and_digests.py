"""Append order that survives storage, digests that see nulls, ledger rules, staged releases, and the stream's batches."""

import pytest
from pyspark.sql import functions as F

from panelforge.operators import aggregates, contracts, windows
from panelforge.operators.contracts import ContractError
from panelforge.sources import ledgers, logs, tables
from panelforge.streaming import progress as stream


def rules(df):
    return sorted({r["rule"] for r in df.collect()})


def last_statuses(log):
    return {r["code"]: r["status"] for r in windows.last_rows(log.withColumn("o", logs.ordinal()), ["code"], "o").collect()}


def test_order_of_files_of_unequal_size(spark, tmp_path):
    """Spark reads large files first; the log's order is that of the appends."""
    for k, n in enumerate((3, 4000, 200)):
        rows = [(str(i % 3), f"step{k}-{i}", "x" * (1 + i % 50)) for i in range(n)]
        logs.append_log(spark.createDataFrame(rows, "code string, status string, filler string").repartition(1 + k).sortWithinPartitions("status"), str(tmp_path / "log"))
    log = logs.read_log(spark, str(tmp_path / "log"), None)
    assert log.count() == 4203 and {s[:5] for s in last_statuses(log).values()} == {"step2"}
    (tmp_path / "tail.csv").write_text("code,status\n0,later\n1,first\n1,second\n")
    assert last_statuses(logs.read_log(spark, str(tmp_path / "log"), str(tmp_path / "tail.csv")))["1"] == "second"


def test_unordered_parquet_is_read_by_file_and_place(spark, tmp_path):
    for name, rows in (("a", [("1", "old")] * 5), ("b", [("1", "older"), ("1", "last")])):
        spark.createDataFrame(rows, "code string, status string").coalesce(1).write.parquet(str(tmp_path / name))
        next((tmp_path / name).glob("*.parquet")).rename(tmp_path / f"{name}.parquet")
    assert last_statuses(logs.read_log(spark, str(tmp_path / "*.parquet"), None)) == {"1": "last"}


def test_fold_keeps_the_order(spark, tmp_path):
    """Two hundred blocks, each failed before it was done; folding must not undo that."""
    first = spark.createDataFrame([(f"b{i:03}", "failed") for i in range(200)], "code string, status string")
    second = spark.createDataFrame([(f"b{i:03}", "done") for i in reversed(range(200))], "code string, status string")
    for df in (first, second):
        logs.append_log(df.repartition(7), str(tmp_path / "history"))
    tail = spark.createDataFrame([("b007", "failed"), ("b007", "again"), ("b008", "started")], "code string, status string").coalesce(1)
    folded = logs.fold_log(spark.read.parquet(str(tmp_path / "history")), tail, str(tmp_path / "folded"))
    found = last_statuses(logs.read_log(spark, str(tmp_path / "folded"), None))
    # the tail's first row repeats one of the history, so it is no new event
    assert found == {f"b{i:03}": "done" for i in range(200)} | {"b007": "again", "b008": "started"}
    again = logs.fold_log(folded, tail, str(tmp_path / "twice"))
    assert again.count() == folded.count() == 402 and last_statuses(logs.read_log(spark, str(tmp_path / "twice"), None)) == found


def test_misplaced_rows_show(spark):
    rows = [(k, k) for k in range(10)]
    assert logs.misplaced(spark.createDataFrame(rows, "at long, log_line long"), "at", "log_line").isEmpty()
    rows[3] = (9, 3)
    assert not logs.misplaced(spark.createDataFrame(rows, "at long, log_line long"), "at", "log_line").isEmpty()
    far = [(5, 0), (4, 1 << 33)]
    assert not logs.misplaced(spark.createDataFrame(far, "at long, log_line long"), "at", "log_line").isEmpty()


@pytest.mark.parametrize("a, b", [([(None, "1"), ("2", None)], [("1", None), (None, "2")]), ([("", None)], [(None, "")]), ([("1", "1")], [("1", "1"), ("1", "1")]), ([("12", "3")], [("1", "23")])])
def test_digest_sees_nulls_and_repetitions(spark, a, b):
    one, two = (spark.createDataFrame(rows, "x string, y string") for rows in (a, b))
    assert aggregates.multiset_digest(one).first()["digest"] != aggregates.multiset_digest(two).first()["digest"]
    assert aggregates.multiset_digest(one).first() == aggregates.multiset_digest(one.repartition(3)).first()
    grouped = [aggregates.group_digest(df.withColumn("g", F.lit(1)), ["g"], ["x", "y"]).first()["digest"] for df in (one, two)]
    assert grouped[0] != grouped[1]


def test_digest_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x string")
    assert tuple(aggregates.multiset_digest(df).first()) == (0, "0:0:0:0")


@pytest.mark.parametrize("official, portal, ok", [("12", "10", True), ("12", "0", True), ("10", "12", False), ("10", "10", False), ("x", "1", False), ("5", "", False), ("5", "-1", False)])
def test_count_exceptions(spark, official, portal, ok):
    ledger = ledgers.LEDGERS["official_count_exceptions"]
    df = spark.createDataFrame([("2024", "S", official, portal, "seen")], ", ".join(f"{c} string" for c in ledger.columns))
    assert rules(ledgers.ledger_contract(df, ledger)) == ([] if ok else ["ledger counts"])


def test_header_ledger(spark, tmp_path):
    path = tmp_path / "h.csv"
    good = "theme_header,theme_slug,language,evidence\nOne,t1,en,seen\nTwo  words,t2,en,seen\n"
    path.write_text(good)
    assert ledgers.read_ledger(spark, str(path), "theme_header_links", ["t1", "t2"]).count() == 2
    for more, rule in (("Two words,t2,hi,seen\n", "repeated header"), ("One ,t2,en,seen\n", "header of two measures"), (",t1,en,seen\n", "ledger blank"), ("Three,t9,en,seen\n", "ledger measure")):
        path.write_text(good + more)
        with pytest.raises(ContractError, match=rule):
            ledgers.read_ledger(spark, str(path), "theme_header_links", ["t1", "t2"])
    path.write_text(good)
    with pytest.raises(ContractError, match="measure without header"):
        ledgers.read_ledger(spark, str(path), "theme_header_links", ["t1", "t2", "t3"])


def test_vector_ledger(spark):
    key = ledgers.LEDGERS["gp_score_vector_links"].columns
    row = {c: "x" for c in key} | {"score_signature": "50|60.5", "gp_code": "1001", "scorecard_url": "/c?gp=MTAwMQ"}

    def check(**change):
        df = spark.createDataFrame([tuple((row | change)[c] for c in key)], ", ".join(f"{c} string" for c in key))
        return rules(ledgers.vector_contract(df, 2, "gp"))

    assert check() == []
    assert check(score_signature="50|60.50") == ["signature form"] == check(score_signature="50")
    assert check(gp_code="1002") == ["link URL"]


def test_row_rules_equal_single_contracts(spark):
    df = spark.createDataFrame([("1", " ", 5.0), ("2", "x", float("nan")), ("3", None, None), ("4", "y", 101.0)], "k string, v string, s double")
    wrong = contracts.out_of_range(["s"])
    fused = contracts.row_rules(df, ["k"], [("blank", contracts.blank_names(["v"]) != "", contracts.blank_names(["v"])), ("range", wrong != "", wrong)])
    single = contracts.not_blank(df, ["v"], ["k"]).unionAll(contracts.in_range(df, ["s"], ["k"]))
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, single.collect()))


def test_sorted_sink_and_summary(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") % 3).alias("p"))
    tables.write_sorted(df, str(tmp_path / "s"), ["k"], ["p"])
    back = tables.pruned(spark, str(tmp_path / "s"), ["k"])
    assert back.columns == ["k"] and sorted(r["k"] for r in back.collect()) == list(range(1000))
    tables.write_summary_csv(df.groupBy("p").count().orderBy("p"), str(tmp_path / "c"))
    assert tables.text_csv(spark, str(tmp_path / "c")).count() == 3
    assert tables.staged(df, None, "x") is df and tables.staged(df, str(tmp_path / "st"), "x").count() == 1000


def test_stream_batches_hold_changes_only(spark, tmp_path):
    schema = "state string, block_value string, block_dir string, status string, ordinal long"

    def add(*rows):
        spark.createDataFrame([("S", b, "d", s, o) for b, s, o in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        query = stream.start(spark, str(tmp_path / "log"), spark.createDataFrame([], schema).schema, ["state", "block_value"], str(tmp_path / "table"), str(tmp_path / "ck"), available_now=True)
        query.awaitTermination()

    add(*((f"b{k}", "started", k) for k in range(50)))
    add(("b3", "done", 100), ("b4", "failed", 101))
    changed = spark.read.parquet(str(tmp_path / "table")).where("batch > 0")
    assert sorted(r["block_value"] for r in changed.collect()) == ["b3", "b4"]
    add(("b3", "failed", 99))  # an older row that came late
    found = {r["block_value"]: r["status"] for r in stream.published(spark, str(tmp_path / "table"), ["state", "block_value"]).collect()}
    assert len(found) == 50 and found["b3"] == "done" and found["b4"] == "failed" and found["b5"] == "started"
    whole = stream.compact(spark, str(tmp_path / "table"), str(tmp_path / "whole"), ["state", "block_value"])
    assert whole.count() == 50
