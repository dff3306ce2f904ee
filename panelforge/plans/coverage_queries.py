"""Coverage, controls, contracts and reshape over the test tables.

Documents are units, their language the vintage, and labels the outcomes. Orders are units of the hierarchy region >
nation > customer, with line items as outcomes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import contracts as con
from ..operators import joins, reshape, sets, statuses
from .registry import query


def labelled(read) -> DataFrame:
    """Documents, each with its labels if it has any."""
    universe = read("documents").select(F.col("lang").alias("vintage"), "doc_id", "source")
    return joins.universe_left(universe, read("labels"), ["doc_id"], ["quality", "toxic"])


def placed_orders(read) -> DataFrame:
    """Orders with their customer, nation and region."""
    customers = read("customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_regionkey", "r_name")
    orders = read("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderdate", "o_totalprice")
    return orders.join(customers, "c_custkey").join(nations, "n_nationkey")


_PLACED = """placed AS (SELECT o_orderkey, c_custkey, o_orderstatus, o_orderdate, o_totalprice, n_nationkey, n_name, r_regionkey, r_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query("""SELECT lang AS vintage, count(*) AS universe, count(l.doc_id) AS scored, count(*) - count(l.doc_id) AS unscored
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang""")
def panel_coverage(read, spark):
    return agg.coverage(labelled(read), ["vintage"])


@query("""SELECT lang AS vintage, d.doc_id AS unit, source, l.doc_id IS NOT NULL AS score_available, quality, toxic
FROM documents d LEFT JOIN labels l USING (doc_id) ORDER BY 1, 2""")
def panel_rows(read, spark):
    return labelled(read).select("vintage", F.col("doc_id").alias("unit"), "source", "score_available", "quality", "toxic").orderBy("vintage", "unit")


@query("SELECT doc_id, quality, toxic FROM documents JOIN labels USING (doc_id)")
def scored_only(read, spark):
    return labelled(read).where("score_available").select("doc_id", "quality", "toxic")


@query(f"""WITH {_PLACED}, k AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT r_regionkey, n_nationkey, min(n_name) AS n_name, count(*) AS universe, count(l_orderkey) AS scored, count(*) - count(l_orderkey) AS unscored
FROM placed LEFT JOIN k ON o_orderkey = l_orderkey GROUP BY r_regionkey, n_nationkey""")
def coverage_by_state(read, spark):
    outcomes = read("lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    panel = joins.universe_left(placed_orders(read), outcomes, ["o_orderkey"], [])
    return agg.coverage_with_label(panel, ["r_regionkey", "n_nationkey"], "n_name", ["o_orderkey"])


def _region_counts(read) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Observed counts, controls (orders not pending) and one reviewed exception, each by vintage and region."""
    orders = placed_orders(read).select(F.year("o_orderdate").cast("string").alias("year"), F.col("r_name").alias("state"), "o_orderstatus")
    observed = agg.counts_with_total(orders, "year", "state")
    controls = agg.counts_with_total(orders.where("o_orderstatus <> 'P'"), "year", "state")
    exceptions = observed.where("state = 'ASIA'").withColumnRenamed("n", "portal_count")
    exceptions = exceptions.join(controls.withColumnRenamed("n", "official_count"), ["year", "state"])
    return observed, controls, exceptions


_COUNTS = f"""{_PLACED}, o AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CASE WHEN grouping(r_name) = 1 THEN '__total__' ELSE r_name END AS state, count(*) AS n
  FROM placed GROUP BY GROUPING SETS ((year(o_orderdate), r_name), (year(o_orderdate)))), c AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, CASE WHEN grouping(r_name) = 1 THEN '__total__' ELSE r_name END AS state, count(*) AS n
  FROM placed WHERE o_orderstatus <> 'P' GROUP BY GROUPING SETS ((year(o_orderdate), r_name), (year(o_orderdate))))"""


@query(f"WITH {_COUNTS} SELECT year, state, n FROM o")
def counts_with_total(read, spark):
    return _region_counts(read)[0]


@query(f"""WITH {_COUNTS} SELECT coalesce(o.year, c.year) AS year, coalesce(o.state, c.state) AS state, o.n AS observed, c.n AS control,
  CASE WHEN coalesce(o.state, c.state) = 'ASIA' THEN o.n ELSE c.n END AS expected,
  CASE WHEN c.n IS NULL THEN 'uncontrolled' WHEN o.n IS NULL THEN 'unobserved' WHEN o.n = c.n OR o.state = 'ASIA' THEN 'equal' ELSE 'differs' END AS outcome
FROM o FULL JOIN c ON o.year = c.year AND o.state = c.state""")
def control_counts(read, spark):
    observed, controls, exceptions = _region_counts(read)
    return joins.against_controls(observed, controls, ["year", "state"], exceptions)


@query(f"""WITH {_PLACED}, moves AS (SELECT o_orderstatus AS year, r_regionkey, (r_regionkey + 1) % 5 AS target FROM placed WHERE o_totalprice > 400000)
SELECT year, state, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT o_orderstatus AS year, r_regionkey AS state, count(*) AS n FROM placed GROUP BY 1, 2
  UNION ALL SELECT year, r_regionkey, -1 FROM moves UNION ALL SELECT year, target, 1 FROM moves) GROUP BY year, state""")
def fold_back_counts(read, spark):
    orders = placed_orders(read).select(F.col("o_orderstatus").alias("year"), F.col("r_regionkey").alias("state"), "o_totalprice")
    moves = orders.where("o_totalprice > 400000").withColumn("target", ((F.col("state") + 1) % 5).cast("int"))
    counts = orders.groupBy("year", "state").agg(F.count("*").alias("n"))
    return agg.fold_back(counts, moves, "year", "state", "state", "target")


@query("""SELECT 'orphan' AS rule, CAST(o_orderkey AS VARCHAR) AS key, '' AS detail FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def orphans(read, spark):
    universe = read("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.orphans(read("orders"), universe, ["o_orderkey"])


@query("""SELECT 'uncovered' AS rule, CAST(c_custkey AS VARCHAR) AS key, '' AS detail FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def uncovered(read, spark):
    finished = read("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.uncovered(read("customer"), finished, ["c_custkey"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(read, spark):
    return agg.duplicates(read("lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT 'range' AS rule, CAST(event_id AS VARCHAR) AS key FROM events WHERE value < 0 OR value > 100 OR isnan(value)")
def range_violations(read, spark):
    return con.in_range(read("events"), ["value"], ["event_id"]).select("rule", "key")


@query("""WITH v AS (SELECT 'range' AS rule, CAST(event_id AS VARCHAR) AS key FROM events WHERE value < 0 OR value > 100
  UNION ALL SELECT 'blank', CAST(doc_id AS VARCHAR) FROM documents WHERE trim(coalesce(text, '')) = ''
  UNION ALL SELECT 'domain', o_orderkey FROM (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders WHERE o_orderstatus NOT IN ('O', 'F'))),
r AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY key) AS k FROM v)
SELECT rule, count(*) AS n, string_agg(key, ',' ORDER BY k) FILTER (k <= 5) AS examples FROM r GROUP BY rule""")
def violation_examples(read, spark):
    found = con.union(
        con.in_range(read("events"), ["value"], ["event_id"]).withColumn("detail", F.lit("")),
        con.not_blank(read("documents"), ["text"], ["doc_id"]).withColumn("detail", F.lit("")),
        con.in_domain(read("orders"), "o_orderstatus", ["O", "F"], ["o_orderkey"]).withColumn("detail", F.lit("")),
    )
    out = con.examples(found)
    return out.withColumn("examples", F.array_join(F.transform("examples", lambda x: F.trim(x)), ","))


@query("""SELECT 'functional' AS rule, p_brand AS key, CAST(count(DISTINCT p_size) AS VARCHAR) AS detail FROM part GROUP BY p_brand HAVING count(DISTINCT p_size) > 1""")
def functional_dependency(read, spark):
    return con.functional(read("part"), ["p_brand"], ["p_size"])


@query("""SELECT 'returned needs shipped' AS rule, concat_ws('|', l_orderkey, l_linenumber) AS key, '' AS detail FROM lineitem WHERE l_returnflag = 'R' AND NOT (l_linestatus = 'F')""")
def conditional_requirement(read, spark):
    return con.required_when(read("lineitem"), F.col("l_returnflag") == "R", F.col("l_linestatus") == "F", ["l_orderkey", "l_linenumber"], "returned needs shipped")


@query("""SELECT 'coercion' AS rule, concat_ws('|', user_id, event_id) AS key, 'value' AS detail FROM events WHERE try_cast(split_part(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', 2) AS INTEGER) > 49""")
def coercion_violations(read, spark):
    cents = F.substring_index(F.col("value").cast("decimal(18,2)").cast("string"), ".", -1)
    raw = read("events").select("user_id", "event_id", F.when(cents.cast("int") > 49, F.lit("n/a")).otherwise(cents).alias("value"))
    declared = con.StructType.fromDDL("user_id long, event_id long, value int")
    return con.coerced(raw.select(*(F.col(c).cast("string").alias(c) for c in raw.columns)), declared)[1]


_MEASURES = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax"}


@query("""SELECT measure, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
  SELECT 'quantity' AS measure, l_quantity AS value FROM lineitem UNION ALL SELECT 'price', l_extendedprice FROM lineitem
  UNION ALL SELECT 'discount', l_discount FROM lineitem UNION ALL SELECT 'tax', l_tax FROM lineitem) GROUP BY measure""")
def unpivot_measures(read, spark):
    long = reshape.wide_to_long(read("lineitem"), ["l_orderkey", "l_linenumber"], _MEASURES)
    return long.groupBy("measure").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@query("""SELECT d.doc_id, measure FROM documents d LEFT JOIN labels l USING (doc_id), (VALUES ('quality'), ('toxic')) m(measure)
WHERE CASE measure WHEN 'quality' THEN quality ELSE toxic END IS NULL""")
def null_cells(read, spark):
    return reshape.null_cells(labelled(read), ["doc_id"], {"quality": "quality", "toxic": "toxic"})


@query("""SELECT user_id, max(value) FILTER (event_type = 'click') AS click_score, max(value) FILTER (event_type = 'error') AS error_score,
  max(value) FILTER (event_type = 'purchase') AS purchase_score, max(value) FILTER (event_type = 'view') AS view_score FROM events GROUP BY user_id""")
def long_to_wide(read, spark):
    long = read("events").groupBy("user_id", "event_type").agg(F.max("value").alias("value"))
    return reshape.long_to_wide(long, ["user_id"], "event_type", ["click", "error", "purchase", "view"], {"score": "value"})


@query("""WITH long AS (SELECT user_id, event_type, max(value) AS value FROM events GROUP BY 1, 2), wide AS (
  SELECT user_id, event_type, max(value + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) AS value FROM events GROUP BY 1, 2),
m AS (SELECT u.user_id, t.event_type, value FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (VALUES ('click'), ('error'), ('purchase'), ('view')) t(event_type) LEFT JOIN wide USING (user_id, event_type))
SELECT 'long and wide differ' AS rule, concat_ws('|', coalesce(l.user_id, m.user_id), coalesce(l.event_type, m.event_type)) AS key
FROM long l FULL JOIN m ON l.user_id = m.user_id AND l.event_type = m.event_type
WHERE CAST(l.value AS DECIMAL(38,18)) IS DISTINCT FROM CAST(m.value AS DECIMAL(38,18))""")
def cell_disagreements(read, spark):
    long = read("events").groupBy("user_id", "event_type").agg(F.max("value").alias("value"))
    changed = F.max(F.col("value") + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)).alias("value")
    types = ["click", "error", "purchase", "view"]
    wide = reshape.long_to_wide(read("events").groupBy("user_id", "event_type").agg(changed), ["user_id"], "event_type", types, {"score": "value"})
    return joins.cell_disagreements(long, wide, ["user_id"], "event_type", "value", {t: f"{t}_score" for t in types}).select("rule", "key")


@query("""SELECT 'group' AS rule, CAST(l_orderkey AS VARCHAR) AS key, 'rows=' || count(*) AS detail FROM lineitem GROUP BY l_orderkey
HAVING count(*) <> 7 OR count(DISTINCT l_linenumber) <> 7 OR count(*) FILTER (l_linenumber = 1) <> 1""")
def group_contract(read, spark):
    return con.group_contract(read("lineitem"), ["l_orderkey"], "l_linenumber", list(range(1, 8)), special=F.col("l_linenumber") == 1)


@query("""SELECT 'row conservation' AS rule, concat_ws('|', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM orders)) AS key, '' AS detail
WHERE (SELECT count(*) FROM lineitem) <> 4 * (SELECT count(*) FROM orders)
UNION ALL SELECT 'documents', concat_ws('|', (SELECT count(*) FROM documents), (SELECT count(*) FROM labels)), '' WHERE (SELECT count(*) FROM documents) <> (SELECT count(*) FROM labels)""")
def row_conservation(read, spark):
    items = agg.table_counts({"lineitem": read("lineitem"), "orders": read("orders")})
    docs = agg.table_counts({"documents": read("documents"), "labels": read("labels")})
    return con.union(con.conserved(items, "lineitem", "orders", 4), con.conserved(docs, "documents", "labels", rule="documents"))


@query("""SELECT c, v, n FROM (SELECT 'l_returnflag' AS c, l_returnflag AS v, count(*) AS n FROM lineitem GROUP BY 2
  UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2)""")
def value_counts(read, spark):
    return agg.value_counts(read("lineitem"), ["l_returnflag", "l_linestatus"]).select(F.col("column").alias("c"), F.col("value").alias("v"), "n")


@query("""SELECT p_brand, count(*) FILTER (p_size <= 10) AS small, count(*) FILTER (p_size > 10 AND p_size <= 30) AS medium, count(*) FILTER (p_size > 30) AS large FROM part GROUP BY p_brand""")
def crosstab(read, spark):
    sized = read("part").withColumn("kind", F.when(F.col("p_size") <= 10, "small").when(F.col("p_size") <= 30, "medium").otherwise("large"))
    return agg.crosstab(sized, ["p_brand"], "kind", ["small", "medium", "large"])


@query(f"""WITH {_PLACED} SELECT n_name, count(*) AS n FROM placed GROUP BY n_name ORDER BY n DESC, n_name LIMIT 15""")
def top_groups(read, spark):
    counts = placed_orders(read).groupBy("n_name").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "n_name").limit(15)


@query(f"""WITH {_PLACED} SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(DISTINCT r_regionkey) AS regions, count(DISTINCT n_nationkey) AS nations,
  count(DISTINCT c_custkey) AS customers, count(DISTINCT o_orderkey) AS units FROM placed GROUP BY 1""")
def level_counts(read, spark):
    units = placed_orders(read).withColumn("year", F.year("o_orderdate").cast("string"))
    region, nation, customer = ["r_regionkey"], ["r_regionkey", "n_nationkey"], ["r_regionkey", "n_nationkey", "c_custkey"]
    return agg.level_counts(units, "year", {"regions": region, "nations": nation, "customers": customer, "units": [*customer, "o_orderkey"]})


@query(f"""WITH {_PLACED}, h AS (SELECT n_name, count(*) AS units FROM placed GROUP BY 1), p AS (SELECT n_name, count(*) AS n FROM placed WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT n_name, units, n AS published, units - n AS hierarchy_minus_published FROM h JOIN p USING (n_name) WHERE 0 < n AND n < units""")
def partially_scored(read, spark):
    placed = placed_orders(read)
    counts = placed.groupBy("n_name").agg(F.count("*").alias("units"))
    controls = placed.where("o_orderstatus = 'P'").groupBy("n_name").agg(F.count("*").alias("n"))
    return agg.partially_scored(agg.against_published(counts, controls, ["n_name"], "units"), "units")


@query("""SELECT source, count(*) AS n FROM documents WHERE source NOT IN (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) GROUP BY source""")
def uncontrolled_groups(read, spark):
    counts = read("documents").groupBy("source").agg(F.count("*").alias("n"))
    controls = labelled(read).where("toxic = 1").select("source").distinct()
    return agg.uncontrolled(counts, controls, ["source"])


@query("""WITH c AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, o_custkey FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderdate, o_custkey, o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT d FROM c) OR (CAST(o_orderdate AS DATE), o_custkey) IN (SELECT d, o_custkey FROM c)""")
def validated_rows(read, spark):
    orders = read("orders").withColumn("d", F.to_date("o_orderdate"))
    kept, _ = statuses.drop_unvalidated(orders, orders.where("o_orderstatus = 'O'"), "d", "o_custkey")
    return kept.select("o_orderdate", "o_custkey", "o_orderkey")


@query("""WITH c AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, o_custkey FROM orders WHERE o_orderstatus = 'O')
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, o_custkey, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT d FROM c) AND (CAST(o_orderdate AS DATE), o_custkey) NOT IN (SELECT d, o_custkey FROM c) GROUP BY 1, 2""")
def unvalidated_rows(read, spark):
    orders = read("orders").withColumn("d", F.to_date("o_orderdate"))
    return statuses.drop_unvalidated(orders, orders.where("o_orderstatus = 'O'"), "d", "o_custkey")[1].withColumn("d", F.col("d").cast("string"))


@query("""SELECT o_custkey, 'observed only' AS side FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT o_custkey, 'configured only' FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def two_sided(read, spark):
    orders = read("orders")
    return sets.two_sided(orders.where("o_orderstatus = 'P'"), orders.where("o_orderstatus = 'F'"), ["o_custkey"])


@query("SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def shared_keys(read, spark):
    orders = read("orders")
    return sets.shared(orders.where("o_orderstatus = 'P'"), orders.where("o_orderstatus = 'F'"), ["o_custkey"])


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def key_difference(read, spark):
    orders = read("orders")
    return sets.difference(orders.where("o_orderstatus = 'P'"), orders.where("o_orderstatus = 'F'"), ["o_custkey"])


@query("""WITH a AS (SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_orderkey % 2 = 0), b AS (SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_orderkey % 2 = 1)
SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'right' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def multiset_diff(read, spark):
    items = read("lineitem").select("l_suppkey", "l_linenumber", "l_orderkey")
    return sets.multiset_difference(items.where("l_orderkey % 2 = 0").drop("l_orderkey"), items.where("l_orderkey % 2 = 1").drop("l_orderkey"))


@query("""WITH a AS (SELECT o_orderkey FROM orders), b AS (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)
SELECT 'keys differ' AS rule, CAST(o_orderkey AS VARCHAR) AS key, 'left only' AS detail FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT 'keys differ', CAST(l_orderkey AS VARCHAR), 'right only' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def key_agreement(read, spark):
    first = read("lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.same_keys(read("orders"), first, ["o_orderkey"])


@query("""SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, 'not required' AS side FROM orders WHERE year(o_orderdate) NOT IN (1993, 1994, 2031)
UNION ALL SELECT y, 'absent' FROM (VALUES (1993), (1994), (2031)) v(y) WHERE y NOT IN (SELECT year(o_orderdate) FROM orders)""")
def missing_vintages(read, spark):
    return agg.missing_vintages(read("orders").select(F.year("o_orderdate").alias("y")), "y", [1993, 1994, 2031])
