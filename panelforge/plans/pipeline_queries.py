"""Whole pipelines over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import reshape
from ..sources import manifests
from ..sources.shared import shared_folder
from ..spec import PanelSpec
from . import pipelines, verification
from .coverage_queries import _PLACED, placed_orders
from .registry import query

_SPEC = PanelSpec("year", "unit", (("state_value", "state"), ("district_value", "district")), ("price",), (0.0, 1e9))


def _inputs(read):
    """Orders as units of a release; those not pending are scored, every 50th with a reviewed null."""
    placed = placed_orders(read).withColumn("unit", F.col("o_orderkey").cast("string"))
    place = [F.col("r_regionkey").cast("string").alias("state_value"), F.col("r_name").alias("state"), F.col("n_nationkey").cast("string").alias("district_value"), F.col("n_name").alias("district")]
    universe = placed.select(F.year("o_orderdate").cast("string").alias("year"), "unit", *place, "o_orderstatus", "o_orderkey", "o_totalprice")
    price = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice"))
    scores = universe.where("o_orderstatus <> 'P'").withColumn("price", price)
    nulls = scores.where("price is null").select("year", "unit", F.lit("price").alias("measure"))
    controls = agg.counts_with_total(scores, "year", "state_value")
    return scores, universe.drop("o_orderstatus", "o_totalprice"), controls, nulls


def _release(read, spark, inputs=None):
    scores, universe, controls, nulls = inputs or _inputs(read)
    return pipelines.build_release(scores, universe, _SPEC, "state_value", controls, nulls, staging=shared_folder(spark, "release"))


@query(f"""WITH {_PLACED} SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(o_orderkey AS VARCHAR) AS unit, r_name AS state, n_name AS district,
  o_orderstatus <> 'P' AS score_available, CASE WHEN o_orderstatus <> 'P' AND o_orderkey % 50 <> 0 THEN o_totalprice END AS price FROM placed""")
def release_panel(read, spark):
    return _release(read, spark).panel.select("year", "unit", "state", "district", "score_available", "price")


@query(f"""WITH {_PLACED}, s AS (SELECT CAST(year(o_orderdate) AS VARCHAR) || '|' || o_orderkey AS unit, o_orderkey AS k, o_orderstatus <> 'P' AS scored FROM placed)
SELECT 'range' AS rule, unit AS key, 'price=-1.0' AS detail FROM s WHERE scored AND k % 50 <> 0 AND k % 331 = 7
UNION ALL SELECT 'orphan', unit || 'x', '' FROM s WHERE scored AND k % 257 = 3
UNION ALL SELECT 'reviewed nulls', unit || '|price', 'observed only' FROM s WHERE scored AND k % 150 = 0
UNION ALL SELECT 'reviewed nulls', unit || '|price', 'configured only' FROM s WHERE scored AND k % 350 = 1 AND k % 50 <> 0""")
def release_violations(read, spark):
    """All contracts of a release with planted defects: prices out of range, units that the universe lacks, null prices
    that nobody reviewed, and reviewed nulls that are none."""
    scores, universe, controls, nulls = _inputs(read)
    key = F.col("o_orderkey")
    price = F.when(F.col("price").isNotNull() & (key % 331 == 7), F.lit(-1.0)).otherwise(F.col("price"))
    strangers = scores.where(key % 257 == 3).withColumn("unit", F.concat("unit", F.lit("x"))).withColumn("price", F.lit(1.0))
    stale = scores.where((key % 350 == 1) & F.col("price").isNotNull()).select("year", "unit", F.lit("price").alias("measure"))
    known = nulls.where(F.col("unit").cast("long") % 150 != 0).unionAll(stale)
    return _release(read, spark, (scores.withColumn("price", price).unionByName(strangers), universe, controls, known)).violations


@query(f"""WITH {_PLACED}, s AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(r_regionkey AS VARCHAR) AS state_value, o_orderstatus FROM placed)
SELECT 'control totals' AS rule, year || '|' || k AS key FROM (
  SELECT year, state_value AS k FROM s WHERE o_orderstatus <> 'P' AND state_value = '3' GROUP BY 1, 2 UNION SELECT year, '__total__' FROM s WHERE o_orderstatus <> 'P' AND state_value = '3')""")
def broken_controls(read, spark):
    """The release contract must name every control that is off by one, and the total with it."""
    scores, universe, controls, nulls = _inputs(read)
    off = F.col("state_value") == "3"
    touched = controls.where(off).select("year").distinct().withColumn("__off", F.lit(1))
    total = F.col("state_value") == agg.TOTAL
    wrong = controls.join(touched, "year", "left").withColumn("n", F.col("n") + F.when(off | total, F.coalesce("__off", F.lit(0))).otherwise(0)).drop("__off")
    return _release(read, spark, (scores, universe, wrong, nulls)).violations.select("rule", "key")


@query(f"""WITH {_PLACED} SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(r_regionkey AS VARCHAR) AS state_value, min(r_name) AS state, count(*) AS universe, count(*) FILTER (o_orderstatus <> 'P') AS scored, count(*) FILTER (o_orderstatus = 'P') AS unscored FROM placed GROUP BY 1, 2""")
def release_coverage(read, spark):
    return _release(read, spark).state_coverage


@query(f"""WITH {_PLACED}, s AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderkey AS k, o_orderstatus <> 'P' AS scored, r_regionkey FROM placed)
SELECT 'scored without URL' AS rule, year || '|' || k AS key, '' AS detail FROM s WHERE scored AND k % 317 = 5
UNION ALL SELECT 'unscored with values', year || '|' || k, '' FROM s WHERE NOT scored AND k % 11 = 4
UNION ALL SELECT 'range', year || '|' || k, 'price=NaN' FROM s WHERE scored AND k % 50 <> 0 AND k % 401 = 9
UNION ALL SELECT 'audit state coverage', year, d FROM (SELECT DISTINCT year FROM s WHERE r_regionkey = 2), (VALUES ('declared only'), ('recomputed only')) v(d)""")
def verified_release(read, spark):
    """A release with planted defects against what it states about itself: URLs missing, values of unscored units, a
    price that is no number, and audits of one state that are off by one."""
    release = _release(read, spark)
    key, scored = F.col("unit").cast("long"), F.col("score_available")
    price = F.when(scored & F.col("price").isNotNull() & (key % 401 == 9), F.lit(float("nan"))).when(~scored & (key % 11 == 4), F.lit(5.0)).otherwise(F.col("price"))
    panel = release.panel.withColumns({"url": F.when(scored & (key % 317 != 5), F.concat(F.lit("/u/"), "unit")), "price": price})
    declared = release.state_coverage.withColumn("universe", F.col("universe") + F.when(F.col("state_value") == "2", 1).otherwise(0))
    _, _, _, nulls = _inputs(read)
    found = pipelines.verify_release(panel, _SPEC, release.coverage, declared, nulls, "url")
    year = F.when(F.startswith("rule", F.lit("audit")), F.get_json_object("key", "$.year")).otherwise(F.col("key"))
    return found.withColumn("key", year)


@query("""SELECT name, rows, changed = 0 AS same FROM (
  SELECT 'orders' AS name, count(*) AS rows, count(*) FILTER (o_orderkey % 1000 = 1) AS changed FROM orders UNION ALL
  SELECT 'lineitem', count(*), 0 FROM lineitem UNION ALL
  SELECT 'documents', count(*), count(*) FILTER (doc_id % 97 = 3 AND lang IS NOT NULL) FROM documents UNION ALL
  SELECT 'events', count(*), count(*) FILTER (event_id < 0) FROM events)""")
def table_manifest(read, spark):
    """Row counts, and whether content digests agree: with the rows in other files they must, with a cent added to some
    prices or with a value moved between columns that are null by turns they must not."""
    tables = {n: read(n) for n in ("orders", "lineitem", "documents", "events")}
    moved = F.col("doc_id") % 97 == 3
    documents = tables["documents"].select("doc_id", "text", F.when(~moved, F.col("lang")).alias("lang"), "source", "n_chars", F.when(moved, F.col("lang")).alias("other"))
    tables["documents"] = tables["documents"].withColumn("other", F.lit(None).cast("string"))
    price = F.col("o_totalprice") + F.when(F.col("o_orderkey") % 1000 == 1, 0.01).otherwise(0.0)
    later = {"orders": tables["orders"].withColumn("o_totalprice", price), "documents": documents}
    # dealt out by key, so that the number of tasks grows with the table
    later |= {"lineitem": tables["lineitem"].repartition("l_orderkey", "l_linenumber"), "events": tables["events"].repartition("event_id")}
    first = manifests.table_manifest(tables)
    second = manifests.table_manifest(later).select("name", F.col("digest").alias("digest2"))
    return first.join(second, "name").select("name", "rows", (F.col("digest") == F.col("digest2")).alias("same"))


@query("""SELECT 'block coverage' AS rule, c_nationkey || '|' || c_custkey AS key, '' AS detail FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS s FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE s IS NULL OR s = 'P'""")
def block_coverage(read, spark):
    log = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    log = log.select("c_nationkey", "c_custkey", "o_orderkey", F.when(F.col("o_orderstatus") == "P", "failed").otherwise("done").alias("status"))
    return pipelines.block_coverage(read("customer"), log, ["c_nationkey", "c_custkey"], "o_orderkey")


@query("""SELECT p_brand || '/' || (p_partkey // 200) AS page, p_partkey AS indicator_id, p_name AS indicator, CASE WHEN p_partkey % 2 = 0 THEN 'Mandatory' ELSE 'Optional' END AS mandatory, CASE WHEN p_partkey % 2 = 0 THEN 'ratio' ELSE 'binary' END AS kind FROM part""")
def indicator_pages(read, spark):
    """Indicator pages of a few parts, each row twice; the first row of an id counts."""
    part = read("part")
    label = F.concat("p_name", F.lit(" ["), "p_partkey", F.lit("]"))
    must = F.when(F.col("p_partkey") % 2 == 0, "Mandatory").otherwise("Optional")
    denominator = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("all &amp; <b>any</b> [1]"))).otherwise("")
    cells = F.concat(F.lit("<td>1</td><td>"), must, F.lit("</td><td>"), label, F.lit("</td><td>n</td><td>"), denominator, F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), cells, F.lit("</tr>"))
    pages = part.groupBy(F.concat_ws("/", "p_brand", F.floor(F.col("p_partkey") / 200)).alias("page")).agg(F.array_join(F.array_sort(F.collect_list(F.concat(row, F.lit("\n"), row))), "\n").alias("html"))
    return pipelines.indicators_from_pages(pages, ["page"], "html")[0].select("page", "indicator_id", "indicator", "mandatory", "kind")


@query(f"""WITH {_PLACED}, c AS (SELECT DISTINCT c_custkey, r_regionkey, r_name FROM placed)
SELECT 'not nationwide' AS rule, '2024|' || r_name AS key, '' AS detail FROM (SELECT DISTINCT r_name FROM c WHERE r_regionkey = 3)
UNION ALL SELECT 'universe rows', '2024', (SELECT count(*) FROM c WHERE r_regionkey <> 3) || '/' || (SELECT count(*) FROM c) UNION ALL SELECT 'vintage not crawled', '2025', ''""")
def universe_provenance(read, spark):
    """Customers with orders as units of a universe that lacks a region, against the whole crawl."""
    units = placed_orders(read).select(F.lit("2024").alias("year"), F.col("r_name").alias("state"), "r_regionkey", "c_custkey").distinct()
    crawl = units.groupBy("year").agg(F.count("*").alias("rows"), F.count_distinct("state").alias("groups"))
    controls = units.select("year", "state").distinct()
    return verification.universe_provenance(units.where("r_regionkey <> 3"), crawl, controls, controls.where("1 = 0"), ["2024", "2025"], "d", "d")


@query("""WITH l AS (SELECT l_orderkey AS block_dir, count(*) AS n FROM lineitem GROUP BY 1), s AS (SELECT o_orderkey AS block_dir, CASE WHEN o_orderkey % 40 = 0 THEN n + 1 ELSE n END AS u FROM orders JOIN l ON o_orderkey = block_dir WHERE o_orderkey % 100 <> 7)
SELECT 'status rows' AS rule, CAST(l.block_dir AS VARCHAR) AS key, n || '/' || n AS detail FROM l LEFT JOIN s USING (block_dir) WHERE s.u IS DISTINCT FROM n""")
def status_conservation(read, spark):
    """Orders as blocks whose status files state the number of their items, some of them wrongly or not at all."""
    items = read("lineitem").select(F.col("l_orderkey").alias("block_dir"))
    counted = items.groupBy("block_dir").agg(F.count("*").alias("score_rows"))
    stated = counted.withColumn("unit_rows", F.col("score_rows") + F.when(F.col("block_dir") % 40 == 0, 1).otherwise(0))
    statuses = stated.where("block_dir % 100 <> 7").withColumn("status", F.lit("done"))
    return verification.status_conservation(statuses, items, items)


@query("""SELECT 'unit in several blocks' AS rule, CAST(l_partkey AS VARCHAR) AS key, CAST(count(DISTINCT l_suppkey) AS VARCHAR) AS detail FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1""")
def shared_units(read, spark):
    return verification.shared_units(read("lineitem"), ["l_partkey"], "l_suppkey")


@query("""WITH a AS (SELECT DISTINCT o_orderstatus AS before, o_orderkey FROM orders) SELECT before, CASE before WHEN 'O' THEN 'open' ELSE 'final' END AS after, count(*) AS n FROM a WHERE before <> 'P' GROUP BY 1, 2""")
def changed_measures(read, spark):
    before = read("orders").select("o_orderkey", F.col("o_orderstatus").alias("slug"))
    renamed = F.when(F.col("slug") == "O", "open").when(F.col("slug") == "F", "final").otherwise(F.col("slug"))
    return reshape.changed_measures(before, before.withColumn("slug", renamed), ["o_orderkey"], "slug")


@query("""WITH w AS (SELECT user_id, max(value) FILTER (event_type = 'view') AS v, max(value) FILTER (event_type = 'error') AS e FROM events WHERE user_id % 3 > 0 OR event_type <> 'view' GROUP BY user_id),
m AS (SELECT DISTINCT user_id FROM events)
SELECT 'measures missing' AS rule, CAST(user_id AS VARCHAR) AS key, CAST((v IS NOT NULL)::INTEGER + (e IS NOT NULL)::INTEGER AS VARCHAR) AS detail FROM m JOIN w USING (user_id) WHERE v IS NULL OR e IS NULL""")
def missing_measures(read, spark):
    events = read("events").where("user_id % 3 > 0 or event_type <> 'view'")
    long = events.groupBy("user_id", "event_type").agg(F.max("value").alias("value"))
    metadata = read("events").select("user_id").distinct()
    return reshape.rebuilt_wide(metadata, long, ["user_id"], "event_type", ["view", "error"], {"score": "value"})[1]


@query("""SELECT doc_id, source, page AS source_page FROM (SELECT doc_id, source, CAST(doc_id % 20 AS BIGINT) AS page FROM documents) WHERE page < 10""")
def enriched_rows(read, spark):
    docs = read("documents").select("doc_id", (F.col("doc_id") % 20).alias("page"))
    pages = read("documents").select((F.col("doc_id") % 20).alias("page"), "source").where("page < 10").distinct()
    pages = pages.withColumn("source_page", F.col("page"))
    return reshape.enriched(docs, pages, ["page"], ["source", "source_page"]).drop("page")
