"""Agreement of tables by one aggregate, versions compared by hash trees, and tables laid out for joins and replacement."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import joins, windows
from ..sources import tables, versions
from ..sources.shared import shared_folder
from ..spec import PanelSpec
from . import pipelines
from .coverage_queries import _PLACED
from .pipeline_queries import _inputs, _release
from .registry import query

_SLUGS = ["overall", "t1"]


def _tables(read):
    """Orders as units of a year and a state with two measures: metadata, long and wide tables with planted defects."""
    k = F.col("k")
    units = read("orders").select(F.year("o_orderdate").cast("string").alias("year"), F.col("o_orderpriority").alias("state"), F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("unit"))
    units = units.withColumns({"overall_score": (k % 100).cast("double"), "t1_score": (k % 90).cast("double")})
    metadata = units.where(k % 211 != 3).withColumn("url", F.when(k % 229 != 6, F.concat(F.lit("/u/"), "unit")).otherwise(" "))
    rows = F.explode(F.array(*(F.struct(F.lit(s).alias("slug"), F.lit(i).alias("ord"), F.col(f"{s}_score").alias("score")) for i, s in enumerate(_SLUGS))))
    long = units.select("year", "unit", "k", rows.alias("r")).select("year", "unit", "k", "r.*").where((k % 223 != 4) & ((k % 239 != 8) | (F.col("ord") == 0)))
    long = long.withColumn("place", k * 2 + F.col("ord") + F.when((k % 233 == 7) & (F.col("ord") == 1), F.lit(10**12)).otherwise(0))
    wide = units.unionAll(units.where(k % 227 == 5))
    return metadata, long, wide


_TABLES = """u AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderpriority AS state, o_orderkey AS k, CAST(year(o_orderdate) AS VARCHAR) || '|' || o_orderkey AS key FROM orders),
c AS (SELECT year, state, count(*) AS n FROM u WHERE k % 211 <> 3 GROUP BY 1, 2),
t AS (SELECT year, sum(n) AS n FROM c GROUP BY 1),
s AS (SELECT count(*) FILTER (k % 211 <> 3) AS m, 2 * count(*) FILTER (k % 223 <> 4) - count(*) FILTER (k % 223 <> 4 AND k % 239 = 8) AS l, count(*) + count(*) FILTER (k % 227 = 5) AS w FROM u)"""


@query(f"""WITH {_TABLES}
SELECT 'keys differ' AS rule, key, 'long without metadata' AS detail FROM u WHERE k % 211 = 3 AND k % 223 <> 4
UNION ALL SELECT 'keys differ', key, 'wide without metadata' FROM u WHERE k % 211 = 3
UNION ALL SELECT 'keys differ', key, 'metadata without long' FROM u WHERE k % 211 <> 3 AND k % 223 = 4
UNION ALL SELECT 'keys differ', key, 'wide without long' FROM u WHERE k % 223 = 4
UNION ALL SELECT 'wide key', key, '2' FROM u WHERE k % 227 = 5
UNION ALL SELECT 'group', key, 'rows=1' FROM u WHERE k % 223 <> 4 AND k % 239 = 8
UNION ALL SELECT 'identity', key, 'url' FROM u WHERE k % 211 <> 3 AND k % 229 = 6 AND year <> '1995'
UNION ALL SELECT 'rows apart', key, '2' FROM u WHERE k % 223 <> 4 AND k % 239 <> 8 AND k % 233 = 7
UNION ALL SELECT 'row conservation', l || '|' || m, '' FROM s WHERE l <> 2 * m UNION ALL SELECT 'wide conservation', w || '|' || m, '' FROM s WHERE w <> m
UNION ALL SELECT 'control totals', year || '|6-NONE', 'unobserved 7' FROM t
UNION ALL SELECT 'control totals', year || '|__total__', 'differs ' || (t.n - x.n)::BIGINT || ' ' || (t.n + 7 - x.n)::BIGINT FROM t JOIN (SELECT year, sum(n) FILTER (state = '1-URGENT' AND year = '1996') AS x FROM c GROUP BY 1) y USING (year), LATERAL (SELECT coalesce(y.x, 0) AS n) x
""")
def global_rules(read, spark):
    """The contract of the consolidated tables must name each planted defect: keys that one of three tables lacks or has
    twice, incomplete units, identities missing in newer vintages, rows of a unit that do not stand together, and a state
    that is missing. A state without a control and a reviewed shortfall are right."""
    metadata, long, wide = _tables(read)
    counts = metadata.groupBy("year", "state").agg(F.count("*").alias("n"))
    short = F.col("state") == "2-HIGH"
    exceptions = counts.where(short).select("year", "state", (F.col("n") + 3).alias("official_count"), F.col("n").alias("portal_count"))
    listed = counts.where(~((F.col("state") == "1-URGENT") & (F.col("year") == "1996"))).withColumn("n", F.col("n") + F.when(short, 3).otherwise(0))
    listed = listed.unionAll(counts.select("year").distinct().select("year", F.lit("6-NONE").alias("state"), F.lit(7).cast("long").alias("n")))
    controls = listed.unionAll(listed.groupBy("year").agg(F.sum("n").alias("n")).select("year", F.lit(agg.TOTAL).alias("state"), "n"))
    return pipelines.global_contract(
        metadata, long, ["year", "unit"], "slug", _SLUGS, "ord", "overall", "score", controls, null_exceptions=None, wide=wide,
        count_exceptions=exceptions, legacy="1995", later=["unit", "url"], stored="place",
    )


@query("""WITH u AS (SELECT o_custkey AS block, o_orderkey AS k, o_orderkey % 61 = 4 AS less, o_orderkey % 61 = 5 AS more FROM orders)
SELECT 'group' AS rule, block || '|' || k AS key FROM u WHERE less OR more
UNION ALL SELECT 'row conservation', block || '|' || (2 * count(*) - count(*) FILTER (less) + count(*) FILTER (more)) || '|' || count(*) FROM u GROUP BY block HAVING count(*) FILTER (less) <> count(*) FILTER (more)
UNION ALL SELECT 'long and wide differ', block || '|' || k || '|t1' FROM u WHERE less""")
def block_rules(read, spark):
    """Conservation block by block: one unit too few and one too many make up for each other in all blocks together."""
    k = F.col("unit")
    units = read("orders").select(F.col("o_custkey").alias("block"), F.col("o_orderkey").alias("unit"), (k0 := F.col("o_orderkey") % 100).cast("double").alias("overall_score"), k0.cast("double").alias("t1_score"))
    rows = F.explode(F.array(*(F.struct(F.lit(s).alias("slug"), F.lit(i).alias("ord"), F.col(f"{s}_score").alias("score")) for i, s in enumerate(_SLUGS))))
    long = units.select("block", "unit", rows.alias("r")).select("block", "unit", "r.*").where((k % 61 != 4) | (F.col("ord") == 0))
    long = long.unionAll(long.where((k % 61 == 5) & (F.col("ord") == 1)))
    columns = {"overall": "overall_score", "t1": "t1_score"}
    found = pipelines.block_contract(units, long, units, ["block", "unit"], "slug", _SLUGS, "ord", "overall", "score", columns, block=["block"])
    return found.select("rule", "key")


@query(f"""WITH {_PLACED}, s AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderkey AS k, o_orderstatus <> 'P' AS scored, CAST(r_regionkey AS VARCHAR) AS state FROM placed),
y AS (SELECT DISTINCT year FROM s WHERE scored AND state = '1')
SELECT 'blank' AS rule, year || '|' || k AS key, 'district' AS detail FROM s WHERE k % 113 = 1
UNION ALL SELECT 'unscored with values', year || '|' || k, '' FROM s WHERE NOT scored AND k % 13 = 5
UNION ALL SELECT 'vintages', '2099', 'absent' UNION ALL SELECT 'schema', '', 'unexpected extra'
UNION ALL SELECT 'control totals', year || '|1', '' FROM y UNION ALL SELECT 'control totals', year || '|__total__', '' FROM y""")
def verified_rules(read, spark):
    """What a release states about its fields, vintages and official counts, with a blank label, an empty URL of units
    without scores, a vintage that is not there, a column too many and a control that is off."""
    panel, (_, _, controls, nulls) = _release(read, spark).panel, _inputs(read)
    k, scored = F.col("unit").cast("long"), F.col("score_available")
    columns = ["year", "unit", "state_value", "state", "district_value", "district", "score_available", "price", "url"]
    panel = panel.withColumns({"url": F.when(scored, F.lit("/u")).when(k % 13 == 5, F.lit("")), "district": F.when(k % 113 != 1, F.col("district")).otherwise(" ")})
    panel = panel.select(*columns, F.lit(1).alias("extra"))
    schema = panel.drop("extra").schema
    there = sorted(r[0] for r in panel.select("year").distinct().collect())
    wrong = controls.withColumn("n", F.col("n") + F.when(F.col("state_value") == "1", 1).otherwise(0))
    has_one = controls.where("state_value = '1'").select("year").distinct().withColumn("one", F.lit(1))
    wrong = wrong.join(has_one, "year", "left").withColumn("n", F.col("n") + F.when(F.col("state_value") == agg.TOTAL, F.coalesce("one", F.lit(0))).otherwise(0))
    coverage = agg.coverage(panel, ["year"])
    by_state = agg.coverage_with_label(panel, ["year", "state_value"], "state", ["state_value", "district_value", "unit"])
    found = pipelines.verify_release(panel, _SPEC, coverage, by_state, nulls, "url", schema=schema, vintages=[*there, "2099"], controls=wrong.select("year", "state_value", "n"), group="state_value")
    return found.withColumn("detail", F.when(F.col("rule") == "control totals", "").otherwise(F.col("detail")))


_SPEC = PanelSpec("year", "unit", (("state_value", "state"), ("district_value", "district")), ("price",), (0.0, 1e9))


@query("""SELECT event_id, ts, change FROM (
  SELECT event_id, ts, CAST(-1 AS BIGINT) AS change FROM events WHERE event_id % 997 = 3 UNION ALL SELECT event_id, ts + INTERVAL 1 MICROSECOND, 1 FROM events WHERE event_id % 997 = 3
  UNION ALL SELECT event_id, ts, -1 FROM events WHERE event_id % 1009 = 5 AND event_id % 997 <> 3
  UNION ALL SELECT event_id, ts, 1 FROM events WHERE event_id % 1013 = 6 AND event_id % 997 <> 3 AND event_id % 1009 <> 5)""")
def changed_rows(read, spark):
    """Two stored versions of the events: some rows a microsecond later, some gone, some there twice."""
    events, k = read("events"), F.col("event_id")
    later = events.where((k % 997 == 3) | (k % 1009 != 5)).withColumn("ts", F.when(k % 997 == 3, F.col("ts") + F.expr("INTERVAL '0.000001' SECOND")).otherwise(F.col("ts")))
    later = later.unionAll(events.where((k % 1013 == 6) & (k % 997 != 3) & (k % 1009 != 5)))
    folder = shared_folder(spark, "versions")
    versions.store(events, f"{folder}/a")
    versions.store(later, f"{folder}/b")
    return versions.compare(spark, f"{folder}/a", f"{folder}/b").rows.select("event_id", "ts", "change")


@query("""SELECT event_type, CAST(sum(s) AS BIGINT) AS runs FROM (SELECT event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (ORDER BY event_id) THEN 1 ELSE 0 END AS s FROM events) GROUP BY event_type HAVING sum(s) > 1""")
def event_runs(read, spark):
    """Runs of neighbouring events of one type, all events being one scope."""
    return windows.broken_stretches(read("events"), ["event_type"], "event_id")


@query("""SELECT o_orderkey, o_orderstatus, l.n IS NOT NULL AS score_available, l.n AS items, l.quantity FROM orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem WHERE l_orderkey % 7 <> 2 GROUP BY 1) l ON o_orderkey = l_orderkey""")
def bucketed_panel(read, spark):
    """A panel of two tables that were dealt by key when they were written: neither the grouping nor the join shuffles."""
    folder, tag = shared_folder(spark, "buckets"), uuid.uuid4().hex
    universe = tables.bucketed(read("orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 16, f"{folder}/universe", f"universe_{tag}")
    items = read("lineitem").where("l_orderkey % 7 <> 2").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    outcomes = tables.bucketed(items, ["o_orderkey"], 16, f"{folder}/outcomes", f"outcomes_{tag}")
    counted = outcomes.groupBy("o_orderkey").agg(F.count("*").alias("items"), F.sum("l_quantity").alias("quantity"))
    return joins.universe_left(universe, counted, ["o_orderkey"], ["items", "quantity"])


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders, sum(CASE WHEN year(o_orderdate) = 1997 THEN 2 * o_custkey ELSE o_custkey END)::BIGINT AS customers FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY 1""")
def replaced_vintage(read, spark):
    """Orders by vintage of which one was written again, and two of which are read."""
    folder = shared_folder(spark, "vintages")
    orders = read("orders").select(F.year("o_orderdate").alias("year"), "o_orderkey", "o_custkey")
    tables.replace_vintages(orders, folder, "year", ["o_orderkey"])
    tables.replace_vintages(orders.where("year = 1997").withColumn("o_custkey", F.col("o_custkey") * 2), folder, "year", ["o_orderkey"])
    kept = spark.read.parquet(folder).where(F.col("year").isin(1996, 1997))
    return kept.groupBy("year").agg(F.count("*").alias("orders"), F.sum("o_custkey").alias("customers"))


@query("""SELECT count(*) AS rows, CAST(0 AS BIGINT) AS inside, CAST(0 AS BIGINT) AS between FROM orders""")
def sorted_order(read, spark):
    """Orders written by price: rows that do not follow in their file, and files that do not follow each other."""
    folder = shared_folder(spark, "ordered")
    tables.write_sorted(read("orders"), folder, ["o_totalprice", "o_orderkey"])
    rows = spark.read.parquet(folder).select(F.struct("o_totalprice", "o_orderkey").alias("k"), F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    before = F.lag("k").over(Window.partitionBy("f").orderBy("i"))
    files = rows.groupBy("f").agg(F.min("k").alias("low"), F.max("k").alias("high"))  # one row for each file
    files = files.withColumn("last", F.lag("high").over(Window.orderBy("low")))
    inside = rows.withColumn("before", before).agg(F.count("*").alias("rows"), F.count_if(F.col("before") >= F.col("k")).alias("inside"))
    return inside.crossJoin(files.agg(F.count_if(F.col("last") >= F.col("low")).alias("between")))
