"""Identity resolution, reconciliation of listings and verdicts over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import joins, statuses
from ..sources import tables
from .coverage_queries import _PLACED, placed_orders
from .registry import query


@query(f"""WITH {_PLACED} SELECT c_custkey, r_regionkey, n_nationkey, (r_regionkey + CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END) AS outcome_r_regionkey,
  CASE WHEN c_custkey % 75 = 0 THEN 99 ELSE n_nationkey END AS outcome_n_nationkey,
  concat_ws(',', CASE WHEN c_custkey % 50 = 0 THEN 'r_regionkey' END, CASE WHEN c_custkey % 75 = 0 THEN 'n_nationkey' END) AS differing
FROM (SELECT DISTINCT c_custkey, r_regionkey, n_nationkey FROM placed) WHERE c_custkey % 50 = 0 OR c_custkey % 75 = 0""")
def hierarchy_disagreements(read, spark):
    universe = placed_orders(read).select("c_custkey", "r_regionkey", "n_nationkey").distinct()
    moved = F.when(F.col("c_custkey") % 50 == 0, F.col("r_regionkey") + 1).otherwise(F.col("r_regionkey"))
    renamed = F.when(F.col("c_custkey") % 75 == 0, 99).otherwise(F.col("n_nationkey"))
    outcomes = universe.select("c_custkey", moved.alias("r_regionkey"), renamed.alias("n_nationkey"))
    found = joins.hierarchy_disagreements(outcomes, universe, ["c_custkey"], ["r_regionkey", "n_nationkey"])
    return found.withColumn("differing", F.array_join("differing", ","))


@query(f"""WITH {_PLACED}, u AS (SELECT DISTINCT '2024' AS year, c_custkey, r_regionkey, n_nationkey FROM placed), o AS (
  SELECT year, c_custkey, r_regionkey + CASE WHEN c_custkey % 50 = 0 THEN 1 ELSE 0 END AS r, n_nationkey AS n FROM u)
SELECT c_custkey, u.r_regionkey, r AS outcome_r_regionkey FROM o JOIN u USING (year, c_custkey)
WHERE r <> u.r_regionkey AND n % 2 = 0""")
def reviewed_moves(read, spark):
    universe = placed_orders(read).select(F.lit("2024").alias("year"), "c_custkey", "r_regionkey", "n_nationkey").distinct()
    moved = F.when(F.col("c_custkey") % 50 == 0, F.col("r_regionkey") + 1).otherwise(F.col("r_regionkey"))
    outcomes = universe.withColumn("r_regionkey", moved)
    found = joins.hierarchy_disagreements(outcomes, universe, ["year", "c_custkey"], ["r_regionkey", "n_nationkey"])
    # the ledger names every nation, half of them with another target than the universe has
    target = F.col("n_regionkey") + F.col("n_nationkey") % 2
    ledger = read("nation").select(F.lit("2024").alias("year"), (F.col("n_regionkey") + 1).alias("r_regionkey"), "n_nationkey", target.alias("target"))
    corrections, _ = joins.reviewed_moves(found, ledger, "year", "r_regionkey", "n_nationkey", "target")
    return corrections.select("c_custkey", "r_regionkey", "outcome_r_regionkey")


@query("""SELECT event_id, upper(event_type) AS slug FROM events""")
def canonical_headers(read, spark):
    events = read("events").select("event_id", F.concat(F.lit("  "), "event_type", F.lit(" \t")).alias("header"))
    links = read("events").select("event_type").distinct().select(F.col("event_type").alias("theme_header"), F.upper("event_type").alias("theme_slug"))
    return joins.canonical_headers(events, links, "header", "slug")[0].select("event_id", "slug")


@query("""SELECT 'unknown header' AS rule, event_type AS key, '' AS detail FROM (SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('view', 'click'))""")
def unknown_headers(read, spark):
    links = read("events").where("event_type in ('view', 'click')").select(F.col("event_type").alias("theme_header"), F.col("event_type").alias("theme_slug")).distinct()
    return joins.canonical_headers(read("events"), links, "event_type")[1]


def _coded_orders(read):
    """Orders as units: every third has a URL with its code, every third a stored code, the rest only a name."""
    url = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("/card?x=1&unit="), F.regexp_replace(F.base64(F.col("o_orderkey").cast("string").cast("binary")), "=+$", "")))
    code = F.when(F.col("o_orderkey") % 3 == 1, F.col("o_orderkey").cast("string")).otherwise("")
    return read("orders").select("o_orderkey", "o_custkey", F.lit("2024").alias("year"), F.coalesce(url, F.lit("")).alias("url"), code.alias("code"), F.col("o_orderpriority").alias("name"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'url_code' WHEN 1 THEN 'code' ELSE 'place_name' END AS kind,
  CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderkey AS VARCHAR) ELSE o_custkey || '|' || o_orderpriority END AS parts FROM orders""")
def unit_keys(read, spark):
    units = _coded_orders(read).withColumns({"place": F.col("o_custkey").cast("string"), "label": F.lit("unused")})
    key = joins.unit_key("year", "url", "code", [("place", "label")], "name", "unit")
    return units.select("o_orderkey", key["kind"].alias("kind"), F.array_join(key["parts"], "|").alias("parts"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS code, CAST(o_orderkey % 3 = 0 AS INTEGER) AS changed FROM orders""")
def repaired_codes(read, spark):
    from ..functions.text import repaired_code

    fixed = repaired_code("code", "url", "unit")
    return _coded_orders(read).select("o_orderkey", fixed.alias("code"), (fixed != F.col("code")).cast("int").alias("changed"))


def _fill(read):
    part = read("part").withColumns({"block": F.col("p_brand"), "id": F.col("p_partkey").cast("string")})
    universe = part.where("p_partkey % 5 <> 0").select("block", F.col("id").alias("code"), "p_name")
    rows = part.select("p_partkey", "block", F.when(F.col("p_partkey") % 4 == 0, F.col("id")).otherwise("").alias("code"), "p_name")
    # a link names a block and a name, so only names that are unique among the linked parts of a block are reviewed
    links = part.where("p_partkey % 7 = 0").groupBy("block", F.lower("p_name").alias("name")).agg(F.min("id").alias("code"), F.count("*").alias("n")).where("n = 1").drop("n")
    return joins.fill_codes(rows, universe, links, ["block"], "code", F.lower("p_name"), F.lower("p_name"))


_FILL_SQL = """WITH u AS (SELECT DISTINCT p_brand AS block, CAST(p_partkey AS VARCHAR) AS code, lower(p_name) AS name FROM part WHERE p_partkey % 5 <> 0),
named AS (SELECT block, name, count(DISTINCT code) AS k, min(code) AS one FROM u GROUP BY 1, 2),
l AS (SELECT p_brand AS block, lower(p_name) AS name, min(CAST(p_partkey AS VARCHAR)) AS linked FROM part WHERE p_partkey % 7 = 0 GROUP BY 1, 2 HAVING count(*) = 1),
r AS (SELECT p_partkey, p_brand AS block, CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS code, lower(p_name) AS name FROM part),
j AS (SELECT r.*, (r.block, r.code) IN (SELECT (block, code) FROM u) AS known, linked, (r.block, linked) IN (SELECT (block, code) FROM u) AS valid, k, one
  FROM r LEFT JOIN named USING (block, name) LEFT JOIN l USING (block, name)),
f AS (SELECT *, CASE WHEN known THEN code WHEN linked IS NOT NULL THEN CASE WHEN valid THEN linked END WHEN k = 1 THEN one END AS found FROM j)"""


@query(f"{_FILL_SQL} SELECT p_partkey, coalesce(found, code) AS code FROM f")
def filled_codes(read, spark):
    return _fill(read)[0].select("p_partkey", "code")


@query(f"""{_FILL_SQL} SELECT 'unresolved code' AS rule, block || '|' || name AS key,
  CASE WHEN linked IS NOT NULL THEN 'link not in universe' WHEN k > 1 THEN 'several candidates' ELSE 'no candidate' END AS detail FROM f WHERE found IS NULL""")
def unresolved_codes(read, spark):
    return _fill(read)[1]


@query("""WITH s AS (SELECT l_orderkey, min(l_suppkey) AS unit, list_aggregate(list(CAST(l_quantity AS INTEGER) ORDER BY l_quantity), 'string_agg', '|') AS sig FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN l_orderkey % 10 = 0 THEN -l_orderkey ELSE unit END AS unit FROM s""")
def restored_identities(read, spark):
    quantities = F.transform(F.array_sort(F.collect_list("l_quantity")), lambda q: q.cast("int").cast("string"))
    units = read("lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("unit"), quantities.alias("signature"))
    links = units.where("l_orderkey % 10 = 0").select("l_orderkey", "signature", (-F.col("l_orderkey")).alias("new"))
    restored, _ = joins.restore_by_signature(units, links, ["l_orderkey"], "signature", {"unit": "new"})
    return restored.select("l_orderkey", "unit")


@query("""WITH a AS (SELECT page_id, sha256(html) AS s FROM pages WHERE page_id % 10 <> 3), b AS (SELECT page_id, sha256(CASE WHEN page_id % 10 = 5 THEN url ELSE html END) AS s FROM pages WHERE page_id % 10 <> 7)
SELECT coalesce(a.page_id, b.page_id) AS page_id, a.s AS left_checksum, b.s AS right_checksum,
  CASE WHEN b.s IS NULL THEN 'missing' WHEN a.s IS NULL THEN 'unexpected' WHEN a.s = b.s THEN 'equal' ELSE 'checksum differs' END AS outcome FROM a FULL JOIN b USING (page_id)""")
def inventory_reconcile(read, spark):
    pages = read("pages")
    left = pages.where("page_id % 10 <> 3").select("page_id", F.sha2("html", 256).alias("s"))
    right = pages.where("page_id % 10 <> 7").select("page_id", F.sha2(F.when(F.col("page_id") % 10 == 5, F.col("url")).otherwise(F.col("html")), 256).alias("s"))
    return joins.reconcile_listings(left, right, "page_id", "s")


@query("""SELECT 'stale source' AS rule, url || '#' || page_id AS key, '' AS detail FROM pages WHERE page_id % 9 = 0""")
def stale_sources(read, spark):
    path = F.concat_ws("#", "url", "page_id")
    files = read("pages").select(path.alias("path"), F.sha2("html", 256).alias("sha256"))
    reviewed = read("pages").select(path.alias("source_path"), F.when(F.col("page_id") % 9 == 0, "x").otherwise(F.sha2("html", 256)).alias("source_sha256"))
    return joins.stale_sources(reviewed, files)


@query(f"""WITH {_PLACED}, live AS (SELECT n_name, count(*) AS n FROM placed WHERE o_orderstatus <> 'F' GROUP BY 1), base AS (SELECT n_name, count(*) AS n FROM placed WHERE o_orderstatus = 'F' AND n_nationkey % 4 <> 0 GROUP BY 1)
SELECT n_name, live.n AS live, base.n AS baseline, live.n - base.n AS delta FROM live LEFT JOIN base USING (n_name)""")
def baseline_delta(read, spark):
    placed = placed_orders(read)
    live = placed.where("o_orderstatus <> 'F'").groupBy("n_name").agg(F.count("*").alias("n"))
    base = placed.where("o_orderstatus = 'F' and n_nationkey % 4 <> 0").groupBy("n_name").agg(F.count("*").alias("n"))
    return joins.baseline_delta(live, base, ["n_name"])


@query("""SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def after_exclusions(read, spark):
    orders = read("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.lit("h").alias("hash"))
    reviewed = read("customer").where("c_acctbal < 0").select("c_custkey", F.lit("h").alias("source_sha256"))
    return joins.apply_exclusions(orders, reviewed, ["c_custkey"], "hash")[0].select("o_orderkey")


@query("""SELECT CASE WHEN c_custkey % 2 = 0 THEN 'exclusion source changed' END AS rule, CAST(c_custkey AS VARCHAR) AS key, '' AS detail FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_acctbal < 0 AND c_custkey % 2 = 0
UNION ALL SELECT 'exclusion unused', CAST(c_custkey AS VARCHAR), '' FROM customer WHERE c_acctbal < 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def exclusion_violations(read, spark):
    orders = read("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.lit("h").alias("hash"))
    reviewed = read("customer").where("c_acctbal < 0").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, "old").otherwise("h").alias("source_sha256"))
    return joins.apply_exclusions(orders, reviewed, ["c_custkey"], "hash")[1]


_LINES = """WITH s AS (SELECT DISTINCT l_orderkey AS block, l_linenumber AS n FROM lineitem), b AS (SELECT DISTINCT block FROM s), u AS (SELECT block, n FROM b, range(1, 8) r(n)),
m AS (SELECT block, string_agg(CAST(u.n AS VARCHAR), ';' ORDER BY u.n) FILTER (s.n IS NULL) AS missing, count(s.n) AS live FROM u LEFT JOIN s USING (block, n) GROUP BY block)"""


def _line_sides(read, dealt: bool = False):
    """Every order as a block: seven line numbers expected, those of its items found; if ``dealt``, parted by block."""
    items = read("lineitem").select(F.col("l_orderkey").alias("block"), F.col("l_linenumber").cast("string").alias("code"))
    found = (tables.dealt(items, ["block"]) if dealt else items).distinct()
    expected = found.select("block").distinct().withColumn("code", F.explode(F.array(*(F.lit(str(k)) for k in range(1, 8)))))
    return expected, found


@query(f"""{_LINES} SELECT block, coalesce(missing, '') AS missing, '' AS unexpected, CASE
  WHEN block % 2 = 0 AND missing IS NOT NULL AND missing <> (CASE WHEN block % 5 = 0 THEN '7' ELSE '' END) THEN 'subset_in_partially_scored_state'
  WHEN coalesce(missing, '') <> (CASE WHEN block % 5 = 0 THEN '7' ELSE '' END) THEN 'error: missing units or stale exception'
  WHEN missing IS NOT NULL THEN 'reviewed_exception' ELSE 'exact_universe_match' END AS verdict FROM m""")
def partial_units(read, spark):
    expected, found = _line_sides(read)
    blocks = found.select("block").distinct()
    allowed = blocks.where("block % 5 = 0").withColumn("codes", F.array(F.lit("7")))
    out = statuses.unit_verdicts(expected, found, ["block"], "code", allowed, blocks.where("block % 2 = 0"))
    return out.withColumns({c: F.array_join(c, ";") for c in ("missing", "unexpected")})


@query(f"""{_LINES} SELECT block, CAST(7 AS BIGINT) AS universe, live, live - 7 AS delta, coalesce(missing, '') AS missing, '' AS unexpected FROM m""")
def block_audit(read, spark):
    expected, found = _line_sides(read, dealt=True)
    return agg.block_audit(expected, found, ["block"], "code")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'collect' WHEN o_orderkey % 4 < (CASE o_orderstatus WHEN 'F' THEN 2 ELSE 3 END) OR o_orderkey % 5 = 0 THEN 'collect'
  WHEN o_orderstatus = 'F' THEN 'redo' WHEN o_custkey % 2 > 0 THEN 'skip_done' ELSE 'redo' END AS decision FROM orders""")
def work_list(read, spark):
    status = F.when(F.col("o_orderstatus") == "F", "done_no_data_available").when(F.col("o_orderstatus") == "O", "done")
    blocks = read("orders").select(
        "o_orderkey", status.alias("status"), (F.col("o_custkey") % 2).alias("n_rows"), (F.col("o_orderkey") % 4).cast("int").alias("confirmations"),
        (F.col("o_orderkey") % 5 != 0).alias("cache_valid"), F.lit(False).alias("re_verified"),
    )
    options = statuses.WorkOptions(retry_no_data=True, retry_empty=True, no_data_confirmations=1, completeness_confirmations=2)
    return statuses.work_list(blocks, options).select("o_orderkey", "decision")
