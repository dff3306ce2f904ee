"""Universes from stored responses, and contracts on their builds, on indicators and on stores of blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import contracts as con
from ..sources import payloads, tables, trees
from ..sources.shared import shared_folder
from . import pipelines, verification
from .bundle_queries import _source, _tree
from .registry import query


def _response(id_column: str, rows: Column) -> Column:
    """A stored response: the names of two columns, and rows of an id and a label."""
    return F.to_json(F.struct(F.array(F.lit(id_column), F.lit("nm")).alias("columns"), rows.alias("rows")))


def _pair(i: Column, label: Column) -> Column:
    return F.array(i.cast("string"), label)


def _stored(read):
    """Customers as units of blocks of fifty: a response for each block with its provenance, some of them wrong."""
    i, g = F.col("c_custkey") + 1, F.col("g")
    named = F.when(i % 90 == 11, i + 1).otherwise(i).cast("string")
    label = F.concat("c_name", F.lit(" ["), named, F.lit("]"))
    customers = read("customer").withColumn("g", F.floor(F.col("c_custkey") / 50))
    blocks = customers.groupBy("g").agg(F.array_sort(F.collect_list(_pair(i, label))).alias("rows"), F.count("*").alias("n"))
    place = F.concat(F.lit("block/"), g.cast("string"))
    stored = blocks.select(g, "n", place.alias("place"), _response("gp_code", F.col("rows")).alias("body")).withColumn("sha256", F.sha2("body", 256))
    stated = stored.where(g % 17 != 3).select(
        "place", F.lit("2024").alias("year"), F.concat(F.lit("S"), g % 5).alias("state"), F.when(g % 17 == 5, 500).otherwise(200).cast("string").alias("http_status"),
        (F.col("n") + F.when(g % 17 == 7, 1).otherwise(0)).cast("string").alias("n_rows"), F.when(g % 17 == 9, F.lit("0")).otherwise(F.col("sha256")).alias("sha256"),
    )
    return payloads.universe_from_payloads(stored.drop("g", "n"), stated)


_CUSTOMERS = "c AS (SELECT c_custkey + 1 AS i, c_custkey // 50 AS g, 'block/' || (c_custkey // 50) AS place, c_name, c_nationkey FROM customer)"


@query(f"""WITH {_CUSTOMERS} SELECT place, CAST(i AS VARCHAR) AS unit, CASE WHEN i % 90 <> 11 THEN c_name END AS unit_name, CASE WHEN g % 17 <> 3 THEN 'S' || (g % 5) END AS state FROM c""")
def payload_universe(read, spark):
    return _stored(read)[0].select("place", "unit", "unit_name", "state")


@query(f"""WITH {_CUSTOMERS}, b AS (SELECT DISTINCT place, g FROM c)
SELECT 'label' AS rule, place || '|' || i AS key, c_name || ' [' || (i + 1) || ']' AS detail FROM c WHERE i % 90 = 11
UNION ALL SELECT 'payload', place, CASE g % 17 WHEN 3 THEN 'no provenance,status' WHEN 5 THEN 'status' WHEN 7 THEN 'rows' ELSE 'hash' END FROM b WHERE g % 17 IN (3, 5, 7, 9)""")
def payload_violations(read, spark):
    """Labels that name another unit, and responses without provenance, of another status, size or content."""
    return _stored(read)[1]


@query("""SELECT CAST(r_regionkey + 1 AS VARCHAR) AS state_value, r_name AS state, CAST(n_nationkey + 1 AS VARCHAR) AS district_value, n_name AS district, CAST(c_custkey // 100 + 1 AS VARCHAR) AS block_value, CAST(c_custkey + 1 AS VARCHAR) AS unit_value, c_name AS unit
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 3""")
def walked_universe(read, spark):
    """Four levels of stored responses walked from the top; one district is excluded by review."""
    nations = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    units = read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    ids = {"state": F.col("r_regionkey") + 1, "district": F.col("n_nationkey") + 1, "block": F.floor(F.col("c_custkey") / 100) + 1, "unit": F.col("c_custkey") + 1}
    names = {"state": F.col("r_name"), "district": F.col("n_name"), "block": F.concat(F.lit("B"), ids["block"]), "unit": F.col("c_name")}
    levels, path = None, []
    for level, i in ids.items():
        parent = F.concat_ws("/", *(p.cast("string") for p in path)) if path else F.lit("")
        members = units.select(parent.alias("parent"), _pair(i, F.concat(names[level], F.lit(" ["), i.cast("string"), F.lit("]"))).alias("row")).distinct()
        here = members.groupBy("parent").agg(F.array_sort(F.collect_list("row")).alias("rows"))
        here = here.select(F.lit("2024").alias("year"), F.lit(level).alias("level"), "parent", _response("id", F.col("rows")).alias("body"))
        levels = here if levels is None else levels.unionAll(here)
        path.append(i)
    levels = tables.staged(levels.withColumn("sha256", F.sha2("body", 256)), shared_folder(spark, "walk"), "responses")
    # the review names the response that lists the district
    excluded = levels.where("level = 'district'").select("year", F.concat("parent", F.lit("/4")).alias("path"), F.col("sha256").alias("source_sha256"), F.col("body"))
    excluded = excluded.where(F.col("body").contains('["4",')).drop("body")
    found, _, bad = payloads.universe_from_levels(levels, list(ids), excluded)
    con.enforce(bad)
    return found.select("state_value", "state", "district_value", "district", "block_value", "unit_value", "unit")


@query("""WITH y AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderkey AS k FROM orders)
SELECT 'universe key' AS rule, year || '|' || k AS key FROM y WHERE k % 400 = 9
UNION ALL SELECT 'endpoint rows', year FROM y GROUP BY year HAVING count(*) FILTER (k % 400 = 9) > 0
UNION ALL SELECT 'exclusions', year || '|9' FROM y WHERE year <> '1996' GROUP BY year UNION ALL SELECT 'exclusions', '2030|9'""")
def universe_build_violations(read, spark):
    """A universe with units that stand twice, exclusions that were not applied, and one that nobody reviewed."""
    units = read("orders").select(F.year("o_orderdate").cast("string").alias("year"), F.col("o_orderkey").alias("unit"))
    ends = units.groupBy("year").agg(F.count("*").alias("n"))
    reviewed = units.select("year", F.lit("9").alias("state_value")).distinct()
    applied = reviewed.where("year = '1996'").unionAll(spark.range(1).select(F.lit("2030").alias("year"), F.lit("9").alias("state_value")))
    twice = units.unionAll(units.where("unit % 400 = 9"))
    return verification.universe_build(twice, ends, applied, reviewed, ["year", "unit"], ["year", "state_value"]).select("rule", "key")


@query("""WITH p AS (SELECT p_partkey AS k, 'v' || (1 + p_partkey % 2) AS version, CAST(1 + p_partkey % 3 AS INTEGER) AS t FROM part), q AS (SELECT *, version || '|' || t || '|' || k AS key FROM p)
SELECT 'mandatory' AS rule, key FROM q WHERE k % 50 = 3 UNION ALL SELECT 'ratio without denominator', key FROM q WHERE k % 60 = 4 UNION ALL SELECT 'theme slug', key FROM q WHERE k % 70 = 5
UNION ALL SELECT 'fiscal year', key FROM q WHERE k % 80 = 6 UNION ALL SELECT 'blank', key FROM q WHERE k % 90 = 7
UNION ALL SELECT 'version counts', 'v2' UNION ALL SELECT 'theme coverage', 'v1|4' UNION ALL SELECT 'theme coverage', 'v2|4'""")
def indicator_violations(read, spark):
    """Parts as indicators of two versions and three themes: fields, slugs, years, counts and coverage that are not as declared."""
    k = F.col("p_partkey")
    theme = (k % 3 + 1).cast("int")
    kind = F.when(k % 60 == 4, "ratio").otherwise("number")
    slug = F.concat(F.lit("t"), F.when(k % 70 == 5, 9).otherwise(theme))
    year = F.concat(F.lit("20"), F.when(k % 80 == 6, 99).otherwise(k % 2 + 21))
    df = read("part").select(
        F.concat(F.lit("v"), k % 2 + 1).alias("version"), year.alias("fiscal_year"), theme.alias("theme_number"), slug.alias("theme_slug"), k.alias("indicator_id"),
        F.when(k % 50 == 3, "Maybe").otherwise("Optional").alias("mandatory"), kind.alias("kind"), F.when(k % 90 == 7, " ").otherwise(F.col("p_name")).alias("indicator"),
        F.lit("n").alias("numerator"), F.lit("").alias("denominator"),
    )
    versions = df.groupBy("version").agg(F.count("*").alias("n"), F.count_distinct("indicator_id").alias("n_ids"))
    off = F.when(F.col("version") == "v2", 1).otherwise(0)
    versions = versions.select("version", F.when(F.col("version") == "v1", "2021").otherwise("2022").alias("fiscal_year"), (F.col("n") + off).alias("n_rows"), "n_ids")
    themes = spark.range(1, 5).select(F.col("id").cast("int").alias("number"), F.concat(F.lit("t"), "id").alias("slug"))
    return pipelines.indicator_contract(df, ["version", "theme_number", "indicator_id"], ["indicator"], versions, themes).select("rule", "key")


@query("""WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'y=' || year(o_orderdate) || '/s=' || regexp_replace(o_orderpriority, '[^A-Za-z0-9]', '_', 'g') AS block_dir FROM orders), b AS (SELECT DISTINCT * FROM y)
SELECT 'failed block' AS rule, block_dir AS key FROM b WHERE year = 1996 UNION ALL SELECT 'status rows', block_dir FROM b WHERE year = 1996 OR year % 5 = 0
UNION ALL SELECT 'stored files', block_dir FROM b WHERE year = 1998 UNION ALL SELECT 'stale source', block_dir FROM b WHERE year = 1998""")
def store_violations(read, spark):
    """A store of blocks of which some failed, some have statuses that cannot be read, and some files are not as listed."""
    source = _source(read, spark)
    root = f"{_tree(read, spark)}/units"
    stored = trees.inventory(spark, root, "*.parquet").select("path", "sha256")
    changed = F.col("path").startswith("y=1998/")
    listing = stored.withColumn("sha256", F.when(changed, F.lit("0")).otherwise(F.col("sha256")))
    exceptions = listing.select(F.col("path").alias("source_path"), F.col("sha256").alias("source_sha256"))
    statuses = source.statuses.withColumn("status", F.when(F.col("block_dir").startswith("y=1996/"), "failed").otherwise(F.col("status")))
    none = con.holds(spark, True, "rows")
    found = verification.store(statuses, source.metadata, source.long, source.wide, none, listing, stored, exceptions, ["year", "unit"])
    return found.select("rule", F.regexp_replace("key", r"/[^/]*\.parquet$", "").alias("key"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS unit, CASE WHEN o_orderkey % 9 <> 4 THEN CAST(o_custkey AS INTEGER) END AS n, CASE WHEN o_orderkey % 8 <> 3 THEN 'a "b", ' || chr(10) || o_orderpriority ELSE '' END AS note FROM orders""")
def typed_csv(read, spark):
    """A CSV table with quotes, commas and line ends inside fields, read with declared types."""
    folder, k = shared_folder(spark, "csv"), F.col("o_orderkey")
    note = F.when(k % 8 != 3, F.concat(F.lit('a "b", \n'), "o_orderpriority"))
    rows = read("orders").select(k.cast("string").alias("unit"), F.when(k % 9 != 4, F.col("o_custkey")).cast("int").alias("n"), note.alias("note"))
    rows.write.csv(folder, header=True, escape='"')
    return tables.typed_csv(spark, folder, tables.declared([("unit", "string"), ("n", "int"), ("note", "string")]))
