"""Trees of blocks written from the test tables and read back, bundles rebuilt from them, logs with several writers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..operators import aggregates as agg
from ..operators import contracts as con
from ..operators import reshape, windows
from ..sources import commits, tables, trees
from ..sources.shared import shared_folder
from . import bundle
from .coverage_queries import _PLACED
from .pipeline_queries import _SPEC, _inputs, _release
from .registry import query

_SLUGS = ["overall", "t1"]
_ROW = StructType([StructField(n, DoubleType() if n == "score" else StringType()) for n in ("year", "state", "unit", "block_page", "score")])


def _units(read):
    """Orders as units of blocks (year and priority)."""
    k = F.col("o_orderkey")
    units = read("orders").select(F.year("o_orderdate").cast("string").alias("year"), F.col("o_orderpriority").alias("state"), k.cast("string").alias("unit"))
    return units.withColumns({"block_page": (F.col("unit").cast("long") % 3 + 1).cast("string"), "score": (F.col("unit").cast("long") % 100).cast("double")})


def _tree(read, spark):
    """A folder for each block with its units, a status file and a page; every fifth year has a status that is no JSON."""
    root, units = shared_folder(spark, "tree"), _units(read)
    place = {"y": F.col("year"), "s": F.regexp_replace("state", "[^A-Za-z0-9]", "_")}
    units.withColumns(place).repartition("y", "s").write.partitionBy("y", "s").parquet(f"{root}/units")
    blocks = units.withColumns(place).groupBy("y", "s", "year", "state").agg(F.count("*").alias("unit_rows"))
    status = F.to_json(F.struct(F.lit("done").alias("status"), "year", "state", "unit_rows", (F.col("unit_rows") * 2).alias("score_rows")))
    status = F.when(F.col("year") % 5 == 0, F.lit("{broken")).otherwise(status)
    blocks.select("y", "s", status.alias("value")).repartition("y", "s").write.partitionBy("y", "s").text(f"{root}/status")
    blocks.select("y", "s", F.concat(F.lit("<p>"), "state", F.lit("</p>")).alias("value")).repartition("y", "s").write.partitionBy("y", "s").text(f"{root}/pages")
    return root


_BLOCKS = """b AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderpriority AS state, 'y=' || year(o_orderdate) || '/s=' || regexp_replace(o_orderpriority, '[^A-Za-z0-9]', '_', 'g') AS block_dir,
  o_orderkey AS k, o_orderkey % 3 + 1 AS page FROM orders)"""


@query(f"WITH {_BLOCKS} SELECT year, state, CAST(k AS VARCHAR) AS unit, block_dir, block_dir || '/html/page_00' || page || '.html' AS block_html_file FROM b")
def tree_rows(read, spark):
    """The rows of all blocks of a tree, with the block and the capture that each came from."""
    rows = trees.read_tables(spark, f"{_tree(read, spark)}/units", "*.parquet", _ROW)
    return trees.with_provenance(rows).select("year", "state", "unit", "block_dir", "block_html_file")


@query(f"""WITH {_BLOCKS} SELECT block_dir, CASE WHEN CAST(year AS INTEGER) % 5 = 0 THEN 'done_unreadable_json' ELSE 'done' END AS status,
  CASE WHEN CAST(year AS INTEGER) % 5 <> 0 THEN count(*) END AS unit_rows FROM b GROUP BY block_dir, year""")
def tree_statuses(read, spark):
    schema = StructType.fromDDL("status string, unit_rows long")
    return trees.read_statuses(spark, f"{_tree(read, spark)}/status", schema, ("*.txt",)).select("block_dir", "status", "unit_rows")


@query(f"WITH {_BLOCKS} SELECT DISTINCT block_dir, '<p>' || state || '</p>' || chr(10) AS html, sha256('<p>' || state || '</p>' || chr(10)) AS sha256, CAST(length(state) + 8 AS BIGINT) AS bytes FROM b")
def tree_pages(read, spark):
    """Page captures with what the inventory of files says of them."""
    root = f"{_tree(read, spark)}/pages"
    pages = trees.read_pages(spark, root, "*.txt")
    files = trees.inventory(spark, root, "*.txt").select("path", "sha256", "bytes")
    return pages.join(files, "path").select(trees.parent("path").alias("block_dir"), "html", "sha256", "bytes")


@query(f"WITH {_BLOCKS} SELECT 'table' AS kind, count(DISTINCT block_dir) AS files FROM b")
def tree_sizes(read, spark):
    """Files by kind of the tables of a tree."""
    sizes = trees.sizes_by_kind(trees.inventory(spark, f"{_tree(read, spark)}/units", "*.parquet"))
    return sizes.where("bytes > 0").select("kind", "files")


@query(f"""WITH {_PLACED}, s AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(r_regionkey AS VARCHAR) AS state FROM placed)
SELECT 'panel' AS name, count(*) AS rows FROM s UNION ALL SELECT 'coverage', count(DISTINCT year) FROM s UNION ALL SELECT 'state_coverage', count(*) FROM (SELECT DISTINCT year, state FROM s)
UNION ALL SELECT 'corrections', 0 UNION ALL SELECT 'dropped', 0""")
def published_release(read, spark):
    """The manifest beside a release; what was written is verified against it."""
    release, (_, _, _, nulls) = _release(read, spark), _inputs(read)
    folder = shared_folder(spark, "published")
    columns = ["year", "unit", "state_value", "state", "district_value", "district", "score_available", "price", "url"]
    release.panel = release.panel.withColumn("url", F.when(F.col("score_available"), F.lit("/u"))).select(*columns)
    schema = release.panel.schema
    manifest = bundle.publish(release, folder, _SPEC, schema)
    con.enforce(bundle.verify_published(spark, folder, _SPEC, nulls, "url", schema=schema))
    return manifest.select("name", "rows")


def _source(read, spark):
    """A bundle's source: the tree of orders, its run log with repeated runs, options listed twice, and the universe."""
    root = _tree(read, spark)
    # read once, since all tables of the bundle and their contracts are made of these rows and their paths
    rows = tables.staged(trees.read_tables(spark, f"{root}/units", "*.parquet", _ROW), root, "rows")
    metadata = rows.select("year", "state", "unit", "block_dir", "block_page")
    members = F.explode(F.array(*(F.struct(F.lit(s).alias("slug"), F.lit(i).alias("ord"), (F.col("score") + i / 2).alias("score")) for i, s in enumerate(_SLUGS))))
    long = rows.select("year", "unit", "block_dir", members.alias("m")).select("year", "unit", "block_dir", "m.*")
    wide = rows.select("year", "unit", F.col("score").alias("overall_score"), (F.col("score") + 0.5).alias("t1_score"))
    statuses = trees.read_statuses(spark, f"{root}/status", StructType.fromDDL("status string, year string, unit_rows long, score_rows long"), ("*.txt",))
    log = metadata.select("year", "block_dir").distinct().select("*", F.explode(F.array(F.lit("started"), F.lit("done"))).alias("status"))
    log = log.withColumn("log_at", F.concat("block_dir", F.when(F.col("status") == "done", "2").otherwise("1")))
    options = metadata.select("year", "state").distinct().select("*", F.explode(F.array(F.lit(1), F.lit(1))).alias("n")).drop("n")
    universe = metadata.select("year", "unit", "state").unionByName(metadata.where("cast(unit as long) % 10 = 0").select("year", F.concat(F.lit("u"), "unit").alias("unit"), "state"))
    counts = universe.groupBy("year").agg(F.count("*").alias("n"))
    return bundle.BundleSource(metadata, long, wide, statuses, log, options, universe, counts)


_RULES = ["year", "unit"], ["block_dir"], "slug", _SLUGS, "ord", "overall", "score", ["state"]


@query("""WITH y AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderpriority AS state, o_orderkey AS k FROM orders WHERE year(o_orderdate) IN (1996, 1997))
SELECT 'metadata' AS name, count(*) AS rows FROM y UNION ALL SELECT 'long', 2 * count(*) FROM y UNION ALL SELECT 'wide', count(*) FROM y
UNION ALL SELECT 'runs', count(*) FROM (SELECT DISTINCT year, state FROM y) UNION ALL SELECT 'options', count(*) FROM (SELECT DISTINCT year, state FROM y)
UNION ALL SELECT 'universe', count(*) + count(*) FILTER (k % 10 = 0) FROM y""")
def rebuilt_bundle(read, spark):
    """Two vintages rebuilt from a written tree of blocks: every table checked as written, then declared in a manifest."""
    source = _source(read, spark)
    two = source.metadata.where(F.col("year").isin("1996", "1997"))
    rules = bundle.BundleRules(*_RULES, controls=agg.counts_with_total(two, "year", "state"), legacy="1996", later=["block_page"])
    out = shared_folder(spark, "bundle")
    bundle.rebuild(spark, source, rules, out, ["1996", "1997"])
    return spark.read.parquet(f"{out}/manifest").select("name", "rows")


@query("""WITH y AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, 'y=' || year(o_orderdate) || '/s=' || regexp_replace(o_orderpriority, '[^A-Za-z0-9]', '_', 'g') AS block_dir, o_orderkey AS k FROM orders)
SELECT 'status rows' AS rule, block_dir AS key FROM y GROUP BY year, block_dir HAVING count(*) FILTER (k % 71 = 6) > 0 OR CAST(year AS INTEGER) % 5 = 0
UNION ALL SELECT 'keys differ', year || '|' || k FROM y, (VALUES (1), (2)) WHERE k % 71 = 6
UNION ALL SELECT 'orphan', year || '|' || k FROM y WHERE k % 73 = 8 AND k % 71 <> 6 UNION ALL SELECT 'universe rows', year FROM y GROUP BY year HAVING count(*) FILTER (k % 73 = 8) > 0
UNION ALL SELECT 'row conservation', (2 * count(*)) || '|' || (count(*) - count(*) FILTER (k % 71 = 6)) FROM y HAVING count(*) FILTER (k % 71 = 6) > 0
UNION ALL SELECT 'wide conservation', count(*) || '|' || (count(*) - count(*) FILTER (k % 71 = 6)) FROM y HAVING count(*) FILTER (k % 71 = 6) > 0""")
def bundle_violations(read, spark):
    """A bundle's contracts with units lost from metadata, a universe that lacks some, and statuses that cannot be read."""
    source, k = _source(read, spark), F.col("unit").try_cast("long")
    source.metadata = source.metadata.where(k % 71 != 6)
    source.universe = source.universe.where(F.coalesce(k % 73 != 8, F.lit(True)))
    rules = bundle.BundleRules(*_RULES)
    parts = bundle.selected(source, rules, None)
    return bundle.bundle_contract(parts, source, rules).select("rule", "key")


@query("""SELECT o_custkey, arg_max(o_orderstatus, (o_orderkey % 3, o_orderkey)) AS status FROM orders GROUP BY o_custkey""")
def committed_log(read, spark):
    """Orders appended by three writers, the first two commits compacted before the third: the last row of each customer."""
    folder = shared_folder(spark, "commits")
    orders = read("orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"))
    for part in range(3):
        if part == 2:
            commits.compact(spark, folder)
        commits.append(orders.where(F.col("o_orderkey") % 3 == part), folder, ["o_orderkey"])
    return windows.last_status(commits.read(spark, folder), ["o_custkey"], "status", commits.ORDINAL)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS unit, o_totalprice AS price FROM orders WHERE o_orderkey % 2 = 0""")
def checked_sink(read, spark):
    """Orders written with declared types, read back as a typed table."""
    declared = tables.declared([("unit", "string"), ("price", "double")])
    folder = shared_folder(spark, "checked")
    rows = read("orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("unit"), F.col("o_totalprice").alias("price"))
    tables.write_checked(rows, folder, declared, ["unit"])
    return tables.typed_parquet(spark, folder, declared)


@query("""SELECT 'orders' AS name, 'missing extra' AS detail UNION ALL SELECT 'orders', 'o_custkey is bigint' UNION ALL SELECT 'customer', 'unexpected c_acctbal' UNION ALL SELECT 'customer', 'unexpected c_mktsegment'""")
def schema_violations(read, spark):
    """Schemas against declared ones that ask for a column more and another type, or for fewer columns."""
    wanted = StructType.fromDDL("o_orderkey bigint, o_custkey string, extra int")
    exact = StructType.fromDDL("c_custkey bigint, c_name string, c_nationkey int")
    found = con.schema_violations(read("orders"), wanted, exact=False, rule="orders").unionAll(con.schema_violations(read("customer"), exact, rule="customer"))
    return found.select(F.col("rule").alias("name"), "detail")


@query("""SELECT c_custkey, o_orderkey, o_totalprice FROM (SELECT o_custkey AS c_custkey, o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 25""")
def first_of_order(read, spark):
    """The first rows of a global order."""
    orders = read("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return windows.first_n(orders, [F.desc("o_totalprice"), "o_orderkey"], 25)


@query("""SELECT doc_id, source, CASE WHEN doc_id % 7 = 2 THEN NULL ELSE n_chars END AS size, CASE WHEN doc_id % 7 = 2 THEN 'unreadable' WHEN doc_id % 7 = 3 THEN 'extra: note' WHEN doc_id % 7 = 4 THEN 'size is no number' END AS problem FROM (
  SELECT doc_id, CASE WHEN doc_id % 7 = 2 THEN NULL ELSE source END AS source, CASE WHEN doc_id % 7 = 4 THEN NULL ELSE n_chars END AS n_chars FROM documents)""")
def variant_payloads(read, spark):
    """Stored JSON payloads with unreadable ones, unknown fields and values of another type: all rows are kept and named."""
    size = F.when(F.col("doc_id") % 7 == 4, F.lit('"many"')).otherwise(F.col("n_chars").cast("string"))
    extra = F.when(F.col("doc_id") % 7 == 3, F.lit(', "note": {"by": ["x"]}')).otherwise("")
    body = F.concat(F.lit('{"source": '), F.to_json(F.array("source")), F.lit(', "size": '), size, extra, F.lit("}"))
    body = F.when(F.col("doc_id") % 7 == 2, F.lit('{"source": [')).otherwise(body)
    stored = read("documents").select("doc_id", body.alias("body"))
    rows = reshape.variant_rows(stored, ["doc_id"], "body", {"source": ("$.source[0]", "string"), "size": ("$.size", "long")}, known=["source", "size"])
    return rows.select("doc_id", "source", "size", "problem")


@query(f"""WITH {_BLOCKS} SELECT year, count(DISTINCT block_dir) AS blocks, count(*) AS units FROM b GROUP BY year""")
def scanned_blocks(read, spark):
    """A tree read block by block as it grows: two scans, the second of which reads only what came after the first."""
    from ..streaming import blocks

    folder, units = shared_folder(spark, "growing"), _units(read)
    for later in (False, True):
        part = units.where((F.col("year") >= "1998") == F.lit(later)).withColumns({"y": F.col("year"), "s": F.regexp_replace("state", "[^A-Za-z0-9]", "_")})
        part.repartition("y", "s").write.mode("append").partitionBy("y", "s").parquet(f"{folder}/tree")
        blocks.scan_new(spark, f"{folder}/tree", _ROW, f"{folder}/table", f"{folder}/state")
    rows = blocks.scanned(spark, f"{folder}/table")
    return rows.groupBy("year").agg(F.count_distinct("block_dir").alias("blocks"), F.count("*").alias("units"))


