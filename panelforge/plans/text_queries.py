"""Scalar functions, pages and payloads over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as fn
from ..operators import pages, reshape, statuses, windows
from .registry import query


@query("""SELECT p_partkey, p_name || ' x' AS cleaned, CAST(p_partkey AS VARCHAR) AS suffix, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS named, CASE WHEN p_partkey % 3 > 0 THEN p_name END AS optional FROM part""")
def clean_labels(read, spark):
    part = read("part").withColumn("id", F.col("p_partkey").cast("string"))
    suffixed = F.concat("p_name", F.lit(" ["), "id", F.lit("] "))
    wrong = F.concat("p_name", F.lit(" [9999999]"))
    part = part.withColumns({"a": F.concat(F.lit(" "), "p_name", F.lit(" x [abc] ")), "b": suffixed, "c": F.when(F.col("p_partkey") % 2 == 0, suffixed).otherwise(wrong)})
    part = part.withColumn("d", F.when(F.col("p_partkey") % 3 == 0, wrong).when(F.col("p_partkey") % 3 == 1, suffixed).otherwise(F.col("p_name")))
    return part.select("p_partkey", fn.clean_label("a").alias("cleaned"), fn.label_suffix("b").alias("suffix"), fn.label_with_id("c", "id").alias("named"), fn.label_with_optional_id("d", "id").alias("optional"))


@query(r"""SELECT c_custkey, lower(trim(regexp_replace(c_name, '\s+', ' ', 'g'))) AS folded, regexp_replace(regexp_replace(lower(c_name || ' / ' || c_custkey), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug,
  left(regexp_replace(regexp_replace(regexp_replace(c_name || '/a b', '[^A-Za-z0-9_.() -]+', '_', 'g'), '\s+', '_', 'g'), '^[._ ]+|[._ ]+$', '', 'g'), 90) || '__' || c_custkey AS component FROM customer""")
def label_forms(read, spark):
    return read("customer").select(
        "c_custkey",
        fn.normalize_ascii_name(F.concat(F.lit(" \t"), "c_name", F.lit(" "))).alias("folded"),
        fn.slugify(F.concat_ws(" / ", "c_name", "c_custkey")).alias("slug"),
        fn.component_with_code(F.concat("c_name", F.lit("/a b")), "c_custkey").alias("component"),
    )


@query("""SELECT p_partkey, lower(p_name) || ' ff' AS folded FROM part""")
def unicode_names(read, spark):
    """Full-width spaces and ligatures fold by NFKC."""
    return read("part").select("p_partkey", fn.normalize_name(F.concat("p_name", F.lit("　ﬀ "))).alias("folded"))


@query("""SELECT l_orderkey, l_linenumber, round(l_quantity * 100000 / 1048576, 1) AS mb FROM lineitem""")
def sizes_in_megabytes(read, spark):
    return read("lineitem").select("l_orderkey", "l_linenumber", fn.megabytes(F.col("l_quantity") * 100000).alias("mb"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN '' WHEN p_partkey % 10 = 1 THEN NULL ELSE regexp_replace(regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(38,18)) AS VARCHAR), '0+$', ''), '\\.$', '') END AS score FROM part""".replace("\\\\", "\\"))
def canonical_scores(read, spark):
    price = F.col("p_retailprice").cast("string")
    raw = F.when(F.col("p_partkey") % 10 == 0, "  ").when(F.col("p_partkey") % 10 == 1, "n/a").otherwise(F.concat(F.lit(" "), price, F.lit(" ")))
    return read("part").select("p_partkey", fn.canonical_score(raw).alias("score"))


@query("""SELECT c_custkey, CAST(regexp_extract(c_name, '[0-9]+') AS DOUBLE) AS number, CASE WHEN c_custkey > 0 THEN CAST(c_custkey AS VARCHAR) END AS id, CASE WHEN c_nationkey > 0 THEN '00' || c_nationkey END AS nation_id, c_mktsegment || ':' || c_nationkey AS key FROM customer""")
def identifiers(read, spark):
    return read("customer").select(
        "c_custkey",
        fn.first_number(F.regexp_replace("c_name", "#", " ")).alias("number"),
        fn.canonical_id(F.concat(F.lit(" "), F.col("c_custkey").cast("string"))).alias("id"),
        fn.canonical_id(F.concat(F.lit("00"), F.col("c_nationkey").cast("string"))).alias("nation_id"),
        fn.partition_key("c_mktsegment", "c_nationkey").alias("key"),
    )


@query("""SELECT page_id, coalesce(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, CASE WHEN page_id % 2 = 0 THEN CAST(page_id + 100 AS VARCHAR) ELSE '' END AS code FROM pages""")
def url_code(read, spark):
    digits = F.regexp_replace(F.base64((F.col("page_id") + 100).cast("string").cast("binary")), "=+$", "")
    made = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/card?unit="), digits)).otherwise(F.concat(F.lit("/card?unit="), F.base64(F.lit("abc").cast("binary"))))
    page = F.coalesce(F.try_parse_url("url", F.lit("QUERY"), F.lit("page")), F.lit(""))
    return read("pages").select("page_id", page.alias("page"), fn.code_from_url(made, "unit").alias("code"))


@query("""SELECT page_id, 'https://h/q?a%20b=' || page_id || '&z=%2F' AS url FROM pages""")
def request_urls(read, spark):
    parameters = F.create_map(F.lit("z"), F.lit("/"), F.lit("a b"), F.col("page_id").cast("string"))
    return read("pages").select("page_id", F.replace(fn.request_url(F.lit("https://h/q"), parameters), F.lit("+"), F.lit("%20")).alias("url"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'ratio' WHEN p_partkey % 4 = 1 THEN 'number' ELSE 'binary' END AS kind FROM part""")
def indicator_kinds(read, spark):
    k = F.col("p_partkey") % 4
    label = F.when(k == 1, F.concat(F.lit("Number of "), "p_name")).otherwise(F.concat(F.lit("Whether "), "p_name"))
    denominator = F.when(k == 0, F.col("p_type")).when(k == 2, F.upper("p_name")).otherwise("")
    return read("part").select("p_partkey", fn.classify_indicator(label, "p_name", denominator).alias("kind"))


@query("""SELECT l_orderkey, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ';' ORDER BY CAST(l_linenumber AS VARCHAR)) AS listed, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY l_orderkey""")
def joined_lists(read, spark):
    listed = read("lineitem").groupBy("l_orderkey").agg(fn.join_sorted(F.collect_set(F.col("l_linenumber").cast("string"))).alias("listed"))
    return listed.withColumn("n", F.size(fn.split_list(F.concat(F.lit("; "), "listed", F.lit(" ;")))).cast("long"))


@query(r"""SELECT page_id, r.i - 1 AS position, trim(regexp_replace(regexp_replace(x[r.i], '<[^>]+>', '', 'g'), '\s+', ' ', 'g')) AS cell FROM (
  SELECT page_id, regexp_extract_all(html, '<li>((?:[^<]|<[^/]|</[^l])*)</li>', 1) AS x FROM pages), range(1, len(x) + 1) r(i)""")
def html_cells(read, spark):
    items = F.regexp_extract_all("html", F.lit(r"<li>((?:[^<]|<[^/]|</[^l])*)</li>"), F.lit(1))
    cells = read("pages").select("page_id", F.posexplode(items).alias("position", "cell"))
    return cells.withColumns({"cell": fn.strip_tags("cell"), "position": F.col("position").cast("long")})


@query("""SELECT page_id, n, CAST(i AS INTEGER) AS position, v AS value FROM (SELECT page_id, string_split(split_part(url, '?', 1), '/') AS p FROM pages), LATERAL (SELECT len(p) AS n), LATERAL (SELECT unnest(p) AS v, generate_subscripts(p, 1) AS i)""")
def row_positions(read, spark):
    parts = read("pages").select("page_id", F.split(F.substring_index("url", "?", 1), "/").alias("p"))
    return windows.positions(parts.select("page_id", F.size("p").cast("long").alias("n"), "p"), "p")


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def json_payload(read, spark):
    return read("events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


def _payloads(read):
    """Handler payloads of fifty customers each, whose last row is a sentinel."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda r: F.array((r["c_custkey"] + 1).cast("string"), r["c_name"]))
    sentinel = F.array(F.array(F.lit(None).cast("string"), F.lit(None).cast("string")))
    made = read("customer").groupBy(F.floor(F.col("c_custkey") / 50).alias("parent")).agg(rows.alias("r"))
    body = F.to_json(F.struct(F.array(F.lit("id"), F.lit("nm")).alias("columns"), F.concat("r", sentinel).alias("rows")))
    return reshape.payload_rows(made.select("parent", body.alias("body")), ["parent"], "body", "id")


@query("""SELECT c_custkey // 50 AS parent, c_name AS label, CAST(c_custkey + 1 AS VARCHAR) AS id FROM customer""")
def hierarchy_payloads(read, spark):
    """Payloads of a hierarchy's level, read back into rows."""
    return _payloads(read)[0].select("parent", "label", "id")


@query("""SELECT c_custkey // 50 AS parent, count(*) AS rows, CAST(1 AS BIGINT) AS sentinels FROM customer GROUP BY 1""")
def payload_sentinels(read, spark):
    found, sentinels, _ = _payloads(read)
    return found.groupBy("parent").agg(F.count("*").alias("rows")).join(sentinels, "parent")


def _legacy_pages(read):
    """Legacy tables built from orders: a header row, then a details cell and two stacked score cells per order."""
    cell = F.concat(F.lit("<td><a href='/card?u="), "o_orderkey", F.lit("'>"), "o_orderpriority", F.lit("</a></td><td>"), "o_totalprice", F.lit("<br>"), "o_orderstatus", F.lit("<br/>b1</td><td>"), "o_custkey", F.lit("<div>G</div></td>"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", cell.alias("c")))), lambda r: F.concat(F.lit("<tr class=x>"), r["c"], F.lit("</tr>")))
    header = F.lit("<table id='g'><tr><th>Unit</th><th>Price</th><th>Customer</th></tr>")
    return read("orders").groupBy(F.floor(F.col("o_orderkey") / 200).alias("page")).agg(F.concat(header, F.array_join(rows, "\n"), F.lit("</table>")).alias("html"))


@query("""SELECT o_orderkey // 200 AS page, o_orderpriority AS unit, '/card?u=' || o_orderkey AS link, t AS theme_header, CASE t WHEN 'Price' THEN o_totalprice ELSE o_custkey END AS score,
  CASE t WHEN 'Price' THEN o_orderstatus ELSE 'G' END AS grade, CASE t WHEN 'Price' THEN 'b1' ELSE '' END AS band FROM orders, (VALUES ('Price'), ('Customer')) v(t)""")
def stacked_scores(read, spark):
    found = reshape.stacked_scores(_legacy_pages(read), ["page"], "html")
    return found.select("page", "unit", "link", "theme_header", "score", "grade", "band")


@query("""SELECT o_orderkey // 200 AS page, CAST(o_orderkey AS VARCHAR) AS unit, CAST(o_totalprice AS DOUBLE) AS score, o_orderstatus AS grade FROM orders""")
def paired_scores(read, spark):
    cell = F.concat(F.lit("<td>"), "o_orderkey", F.lit("</td><td>"), "o_totalprice", F.lit("</td><td> "), "o_orderstatus", F.lit("</td>"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", cell.alias("c")))), lambda r: F.concat(F.lit("<tr>"), r["c"], F.lit("</tr>")))
    pages = read("orders").groupBy(F.floor(F.col("o_orderkey") / 200).alias("page")).agg(F.concat(F.lit("<tr><th>Unit</th><th>Price</th><th>Price-Grade</th></tr>"), F.array_join(rows, "")).alias("html"))
    found = reshape.paired_scores(pages, ["page"], "html", ["Unit"])
    return found.select("page", F.element_at("ids", F.lit("Unit")).alias("unit"), "score", "grade")


@query("""SELECT c_custkey // 50 AS page, c_name AS label, CAST(c_custkey + 1 AS VARCHAR) AS value FROM customer""")
def select_options(read, spark):
    option = F.concat(F.lit('<option value="'), F.col("c_custkey") + 1, F.lit('">'), "c_name", F.lit("</option>"))
    listed = F.array_join(F.array_sort(F.collect_list(option)), "")
    pages = read("customer").groupBy(F.floor(F.col("c_custkey") / 50).alias("page")).agg(F.concat(F.lit('<select name="s" id="ddl"><option value="-1">- Select -</option>'), listed, F.lit("</select>")).alias("html"))
    found = reshape.select_options(pages, ["page"], "html", "ddl")
    return statuses.options_kept(found, "label", "value").select("page", "label", "value")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey > 0 AND contains(lower(c_name), 'r#00') AND c_custkey < 700""")
def options_kept(read, spark):
    customers = read("customer").withColumn("value", F.col("c_custkey").cast("string"))
    kept = statuses.options_kept(customers, "c_name", "value", contains="R#00", values=[str(k) for k in range(700)])
    return kept.select("c_custkey", "c_name")


@query("""WITH p AS (SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part)
SELECT p_partkey, 0 AS "table", CAST(NULL AS INTEGER) AS parent_column, 0 AS "row", 0 AS "column", p_name AS text, '/p/' || p_partkey AS href FROM p
UNION ALL SELECT p_partkey, 0, NULL, 0, 1, 'before' || chr(10) || p_type, NULL FROM p
UNION ALL SELECT p_partkey, 1, 1, 0, 0, p_brand, NULL FROM p UNION ALL SELECT p_partkey, 1, 1, 1, 0, '<' || p_size || '>', NULL FROM p""")
def nested_tables(read, spark):
    """Pages with a table inside a cell of another, end tags left out: each cell has its own text only."""
    inner = F.concat(F.lit("<table><tr><td>"), "p_brand", F.lit("<tr><td>&lt;"), F.col("p_size").cast("string"), F.lit("&gt;</table>"))
    page = F.concat(F.lit('<TABLE class="a>b"><tr><td><a href="/p/'), F.col("p_partkey").cast("string"), F.lit('">'), "p_name", F.lit("</a></td><td colspan=2> before "), inner, F.lit("  "), "p_type", F.lit("</td></tr></TABLE>"))
    parts = read("part").repartition("p_partkey")  # a small file of many pages is not left to the one task that reads it
    cells = pages.table_cells(parts.select("p_partkey", page.alias("html")), ["p_partkey"], "html")
    return cells.select("p_partkey", "table", "parent_column", "row", "column", "text", "href")
