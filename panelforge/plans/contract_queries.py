"""Contracts of blocks, universes and ledgers with planted defects, the rebuild of a bundle, and sinks read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as fn
from ..operators import contracts as con
from ..sources import ledgers, tables
from ..sources.shared import shared_folder
from . import pipelines
from .registry import query


def _block_rows(read):
    """Orders as units with two measures, long and wide: some long rows missing, some wide cells changed, some scores out of range."""
    k = F.col("o_orderkey")
    overall = F.when(k % 83 == 2, 101.0).otherwise((k % 100).cast("double"))
    units = read("orders").select(F.col("o_orderkey").alias("unit"), overall.alias("overall_score"), (F.col("o_custkey") % 100).cast("double").alias("t1_score"))
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("slug"), F.lit(i).alias("ord"), F.col(f"{n}_score").alias("score")) for i, n in enumerate(("overall", "t1")))))
    long = units.select("unit", rows.alias("r")).select("unit", "r.slug", "r.ord", "r.score").where((F.col("unit") % 89 != 4) | (F.col("slug") != "t1"))
    wide = units.withColumn("t1_score", F.col("t1_score") + F.when(F.col("unit") % 97 == 5, 0.5).otherwise(0.0))
    return units.select("unit"), long, wide


_BLOCK_ROWS = """k AS (SELECT o_orderkey AS unit FROM orders),
g AS (SELECT 'group' AS rule, CAST(unit AS VARCHAR) AS key FROM k WHERE unit % 89 = 4),
r AS (SELECT 'range' AS rule, unit || '|overall' AS key FROM k WHERE unit % 83 = 2),
c AS (SELECT 'row conservation' AS rule, (SELECT 2 * count(*) - count(*) FILTER (unit % 89 = 4) FROM k) || '|' || (SELECT count(*) FROM k) AS key)"""


@query(f"""WITH {_BLOCK_ROWS} SELECT * FROM g UNION ALL SELECT * FROM r UNION ALL SELECT * FROM c WHERE EXISTS (SELECT 1 FROM g)
UNION ALL SELECT 'long and wide differ', unit || '|t1' FROM k WHERE unit % 97 = 5 OR unit % 89 = 4""")
def block_contract(read, spark):
    """All contracts on the rows of blocks at once must name every planted defect."""
    metadata, long, wide = _block_rows(read)
    columns = {"overall": "overall_score", "t1": "t1_score"}
    found = pipelines.block_contract(metadata, long, wide, ["unit"], "slug", ["overall", "t1"], "ord", "overall", "score", columns)
    return found.select("rule", "key")


@query(f"""WITH {_BLOCK_ROWS} SELECT * FROM g UNION ALL SELECT * FROM r UNION ALL SELECT * FROM c WHERE EXISTS (SELECT 1 FROM g)""")
def global_contract(read, spark):
    metadata, long, _ = _block_rows(read)
    return pipelines.global_contract(metadata, long, ["unit"], "slug", ["overall", "t1"], "ord", "overall", "score").select("rule", "key")


@query("""SELECT 'blank' AS rule, CAST(o_orderkey AS VARCHAR) AS key, 'o_orderpriority' AS detail FROM orders WHERE o_orderkey % 200 = 3
UNION ALL SELECT 'duplicate key', CAST(o_orderkey AS VARCHAR), '2' FROM orders WHERE o_orderkey % 300 = 7
UNION ALL SELECT 'orphan', CAST(l_orderkey + 1000000000 AS VARCHAR), '' FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 50 = 11)""")
def universe_contract(read, spark):
    """Orders as a universe with blank labels, units that occur twice, and outcomes that it lacks."""
    orders = read("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 200 != 3, F.col("o_orderpriority")).otherwise(" ").alias("o_orderpriority"))
    universe = orders.unionAll(orders.where("o_orderkey % 300 = 7"))
    k = F.col("l_orderkey")
    outcomes = read("lineitem").select(F.when(k % 50 == 11, k + 1_000_000_000).otherwise(k).alias("o_orderkey")).distinct()
    return pipelines.universe_contract(universe, outcomes, ["o_orderkey"], ["o_orderpriority"])[0]


@query("""SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 100 = 1 THEN 'L' || o_orderkey WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'old' END AS unit,
  CAST(o_orderkey AS DOUBLE) AS t1_score, CAST(o_custkey AS DOUBLE) AS t2_score FROM orders""")
def repaired_blocks(read, spark):
    """A bundle rebuilt: units named by reviewed score vectors, by the code of their URL, and measures by reviewed headers."""
    encoded = F.regexp_replace(F.base64(F.col("o_orderkey").cast("string").cast("binary")), "=+$", "")
    url = F.when((F.col("o_orderkey") % 3 == 0) & (F.col("o_orderkey") % 100 != 1), F.concat(F.lit("/card?unit="), encoded)).otherwise("")
    units = read("orders").select(F.col("o_orderkey").alias("row_id"), (F.col("o_custkey") % 50).alias("block"), F.lit("old").alias("unit"), url.alias("url"), F.col("o_orderkey").cast("double").alias("t1_score"), F.col("o_custkey").cast("double").alias("t2_score"))
    metadata = units.select("row_id", "unit", "url")
    scores = F.explode(F.array(F.struct(F.lit(" Head  one").alias("theme_header"), F.col("t1_score").alias("score")), F.struct(F.lit("Head two ").alias("theme_header"), F.col("t2_score").alias("score"))))
    long = units.select("row_id", "unit", "url", scores.alias("s")).select("row_id", "unit", "url", "s.theme_header", "s.score")
    linked = units.where("row_id % 100 = 1").withColumn("signature", fn.score_signature(["t1_score", "t2_score"]))
    vectors = linked.select("block", "signature", F.concat(F.lit("L"), "row_id").alias("new_code"), F.lit("").alias("new_url"))
    headers = spark.createDataFrame([("Head one", "t1"), ("Head two", "t2")], "theme_header string, theme_slug string")
    out, bad = pipelines.repaired_blocks(metadata, long, units, vectors, headers, ["block"], ["t1_score", "t2_score"], "unit", staging=shared_folder(spark, "repaired"))
    con.enforce(bad)
    return out["wide"].select("row_id", "unit", "t1_score", "t2_score")


@query("""SELECT 'ledger counts' AS rule, '2024|' || c_custkey AS key FROM customer WHERE NOT (c_custkey % 40 < c_custkey % 37) UNION ALL SELECT 'ledger blank', '2024|' || c_custkey FROM customer WHERE c_custkey % 90 = 4""")
def ledger_violations(read, spark):
    """Customers as groups whose published and displayed counts are reviewed: what is displayed must be less."""
    k = F.col("c_custkey")
    evidence = F.when(k % 90 == 4, " ").otherwise("seen")
    rows = read("customer").select(F.lit("2024").alias("year"), k.cast("string").alias("state"), (k % 37).cast("string").alias("official_count"), (k % 40).cast("string").alias("portal_count"), evidence.alias("evidence"))
    return ledgers.ledger_contract(rows, ledgers.LEDGERS["official_count_exceptions"]).select("rule", "key")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS unit, CASE WHEN o_orderkey % 41 <> 0 AND o_orderkey % 43 <> 0 THEN o_totalprice END AS price, o_orderkey % 41 = 0 AS rejected FROM orders""")
def migrated_rows(read, spark):
    """Legacy rows of strings in their typed form: blank prices are null, prices that are no number are named."""
    k = F.col("o_orderkey")
    price = F.when(k % 41 == 0, "n/a").when(k % 43 == 0, " ").otherwise(F.col("o_totalprice").cast("string"))
    legacy = read("orders").select(k.cast("string").alias("code"), price.alias("total"), F.lit("x").alias("old"))
    declared = tables.declared([("unit", "string"), ("price", "double")])
    rows, bad = pipelines.migrated(spark, legacy, {"code": "unit", "total": "price"}, ["old"], declared)
    named = bad.select(F.split("key", r"\|")[0].alias("unit"), F.lit(True).alias("rejected"))
    return rows.join(named, "unit", "left").select("unit", "price", F.coalesce("rejected", F.lit(False)).alias("rejected"))


@query("""SELECT o_orderkey, o_orderstatus FROM orders""")
def sorted_sink(read, spark):
    """Orders written in key order by status, and two columns of them read back."""
    folder = shared_folder(spark, "sorted")
    tables.write_sorted(read("orders"), folder, ["o_orderkey"], ["o_orderstatus"])
    return tables.pruned(spark, folder, ["o_orderkey", "o_orderstatus"])


@query("""SELECT o_orderpriority AS priority, CAST(count(*) AS VARCHAR) AS orders FROM orders GROUP BY 1""")
def summary_csv(read, spark):
    """A summary written as CSV and read back as text."""
    folder = shared_folder(spark, "summary")
    counts = read("orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("orders"))
    tables.write_summary_csv(counts, folder)
    return tables.text_csv(spark, folder)
