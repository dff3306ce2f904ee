"""Append logs, statuses, progress and page sequences over events, orders and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators import statuses, windows
from ..sources import logs
from ..sources.shared import shared_folder
from . import progress
from .registry import query


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS k FROM events) WHERE k = 1""")
def last_rows(read, spark):
    return windows.last_rows(read("events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events) WHERE k = 1""")
def first_rows(read, spark):
    return windows.first_rows(read("events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_status(read, spark):
    return windows.last_status(read("events"), ["user_id"], "event_type", "event_id")


def _placed_log(read):
    """Events as a log whose place is blank for every eleventh row."""
    return read("events").select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 11 == 0, " ").otherwise("dir").alias("block_dir"))


@query("""WITH e AS (SELECT event_id, user_id, event_type, CASE WHEN event_id % 11 = 0 THEN ' ' ELSE 'dir' END AS block_dir FROM events)
SELECT event_id, user_id, event_type, block_dir FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM e WHERE block_dir = 'dir') WHERE k = 1
UNION ALL SELECT event_id, user_id, event_type, block_dir FROM e WHERE block_dir = ' '""")
def latest_log(read, spark):
    return windows.latest_log(_placed_log(read), ["user_id"], "event_id", "block_dir", keep_blank=True)


@query("""WITH e AS (SELECT *, arg_max(event_type, event_id) OVER (PARTITION BY user_id) AS x FROM events WHERE event_id % 11 <> 0)
SELECT CASE t WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'no_data' WHEN 'error' THEN 'failed' ELSE 'other' END AS bucket, count(*) AS blocks
FROM (SELECT user_id, arg_max(event_type, event_id) AS t FROM events WHERE event_id % 11 <> 0 GROUP BY user_id) GROUP BY 1""")
def status_buckets(read, spark):
    buckets = {"success": ["purchase"], "no_data": ["view"], "failed": ["error"]}
    latest = windows.latest_log(_placed_log(read), ["user_id"], "event_id", "block_dir", keep_blank=False)
    return latest.groupBy(statuses.bucket("event_type", buckets).alias("bucket")).agg(F.count("*").alias("blocks"))


def run_log(read):
    """Events as the run log of a collection: users are blocks in ten states, types are statuses."""
    status = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "view", "skipped_no_data").when(F.col("event_type") == "error", "failed").otherwise("started")
    return read("events").select(F.lit("2024").alias("year"), (F.col("user_id") % 10).cast("string").alias("state"), F.col("user_id").cast("string").alias("block_value"), F.lit("d").alias("block_dir"), status.alias("status"), F.col("event_id").alias("ordinal"))


_LAST = """l AS (SELECT CAST(user_id % 10 AS VARCHAR) AS state, user_id, arg_max(CASE event_type WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'no_data' WHEN 'error' THEN 'failed' ELSE 'other' END, event_id) AS b FROM events GROUP BY 1, 2)"""


@query(f"""WITH {_LAST} SELECT state, count(*) FILTER (b = 'success') AS success, count(*) FILTER (b = 'no_data') AS no_data, count(*) FILTER (b = 'failed') AS failed, count(*) AS total FROM l WHERE b <> 'other' GROUP BY state""")
def state_coverage(read, spark):
    return progress.state_coverage(progress.latest(run_log(read), ["year", "state", "block_value"]), "state")


@query(f"""WITH {_LAST}, f AS (SELECT *, row_number() OVER (PARTITION BY state ORDER BY CAST(user_id AS VARCHAR)) AS k FROM l WHERE b = 'failed')
SELECT state, count(*) AS n, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY k) FILTER (k <= 3) AS examples, greatest(count(*) - 3, 0) AS more FROM f GROUP BY state""")
def topk_failed(read, spark):
    found = progress.failed_by_group(progress.latest(run_log(read), ["year", "state", "block_value"]), "state", "block_value")
    return found.withColumn("examples", F.array_join("examples", ","))


@query("""SELECT o_orderstatus AS status, r_name AS state, count(*) AS blocks FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def status_by_region(read, spark):
    from .coverage_queries import placed_orders

    return placed_orders(read).groupBy(F.col("o_orderstatus").alias("status"), F.col("r_name").alias("state")).agg(F.count("*").alias("blocks"))


_BLOCKS = """b AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, n_name AS state, c_mktsegment AS district, o_orderstatus, n, total FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(CAST(l_quantity AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey),
s AS (SELECT year, state, count(*) FILTER (o_orderstatus = 'F') AS blocks_with_data, count(*) FILTER (o_orderstatus = 'O') AS blocks_no_data, count(*) FILTER (o_orderstatus = 'P') AS blocks_failed,
  CAST(coalesce(sum(n) FILTER (o_orderstatus = 'F'), 0) AS BIGINT) AS units, round(CAST(sum(total) FILTER (o_orderstatus = 'F') AS DOUBLE) / sum(n) FILTER (o_orderstatus = 'F'), 2) AS mean FROM b GROUP BY 1, 2)"""


def _blocks(read):
    """Orders as blocks: F has data, O has none, P failed; items are the block's units, quantity the measure."""
    items = read("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("units"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("total"))
    customers = read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = read("orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "done_no_rows").otherwise("failed")
    return orders.select(F.year("o_orderdate").cast("string").alias("year"), F.col("n_name").alias("state"), F.col("c_mktsegment").alias("district"), status.alias("status"), "units", F.col("total").cast("double").alias("measure_sum"), F.col("units").alias("measure_n"))


@query(f"WITH {_BLOCKS} SELECT year, state, blocks_with_data, blocks_no_data, blocks_failed, units, mean FROM s")
def state_summary(read, spark):
    return progress.state_summary(_blocks(read))


@query(f"""WITH {_BLOCKS}, d AS (SELECT year, count(DISTINCT (state, district)) AS districts FROM b GROUP BY 1)
SELECT year, count(*) AS states_total, count(*) FILTER (blocks_with_data > 0) AS states_with_data, CAST(sum(blocks_with_data) AS BIGINT) AS blocks_with_data, CAST(sum(blocks_no_data) AS BIGINT) AS blocks_no_data,
  CAST(sum(blocks_failed) AS BIGINT) AS blocks_failed, CAST(sum(units) AS BIGINT) AS units, any_value(districts) AS districts FROM s JOIN d USING (year) GROUP BY year""")
def year_summary(read, spark):
    return progress.year_summary(_blocks(read))


@query("""SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role AS speaker, CASE WHEN conv_id % 2 = 0 THEN text ELSE '' END AS text, CASE WHEN conv_id % 2 = 0 THEN '' ELSE CAST(length(text) AS VARCHAR) END AS size,
  CASE WHEN conv_id % 2 = 0 THEN 0 ELSE 1 END AS src_rank FROM conversations""")
def log_union(read, spark):
    rows = read("conversations")
    history = rows.where("conv_id % 2 = 0").select("conv_id", "turn", F.col("role").alias("author"), "text")
    tail = rows.where("conv_id % 2 = 1").select("conv_id", "turn", F.col("role").alias("speaker"), F.length("text").alias("size"))
    return logs.combined_log(history, tail, {"author": "speaker"}).drop("line")


@query("SELECT DISTINCT role, text FROM conversations")
def exact_rows(read, spark):
    return windows.distinct_rows(read("conversations").select("role", "text"))


@query("""SELECT user_id, CAST(sum(s) AS BIGINT) AS runs, event_type FROM (SELECT user_id, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 1 ELSE 0 END AS s FROM events) GROUP BY user_id, event_type HAVING sum(s) > 1""")
def key_runs(read, spark):
    return windows.broken_runs(read("events"), ["user_id"], ["event_type"], "event_id")


@query("""SELECT conv_id, turn FROM (SELECT conv_id, turn, length(text) // 200 AS s, lag(length(text) // 200) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations) WHERE s = b""")
def repeated_pages(read, spark):
    size = F.floor(F.length("text") / 200)
    return windows.repeated_pages(read("conversations"), ["conv_id"], "turn", size).select("conv_id", "turn")


@query("""SELECT o_custkey, count(*) FILTER (o_orderstatus <> 'P') AS themes, count(*) FILTER (o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT') AS graded FROM orders GROUP BY o_custkey
HAVING count(*) FILTER (o_orderstatus <> 'P') > 0 AND count(*) FILTER (o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT') = 0""")
def pages_without_grades(read, spark):
    rows = read("orders").withColumn("grade", F.when(F.col("o_orderpriority") == "1-URGENT", "A").otherwise(" "))
    return agg.pages_without_grades(rows, ["o_custkey"], F.col("o_orderstatus") != "P", "grade")


@query("""SELECT user_id, count(*) AS n, count(*) FILTER (event_id % 37 = 5 OR event_id % 41 = 6) = 0 AS same FROM events GROUP BY user_id""")
def retrieval_signature(read, spark):
    """Two retrievals of the same rows, in another order and another number of parts, have the same signature, but for the
    users of whom a value changed or moved between columns that are null by turns."""
    changed, moved = F.col("event_id") % 37 == 5, F.col("event_id") % 41 == 6
    events = read("events").select("user_id", "event_id", "event_type", "value", F.lit(None).cast("string").alias("note"))
    again = events.select("user_id", "event_id", F.when(~moved, F.col("event_type")).alias("event_type"), (F.col("value") + F.when(changed, 1.0).otherwise(0.0)).alias("value"), F.when(moved, F.col("event_type")).alias("note"))
    columns = ["event_id", "event_type", "value", "note"]
    first = agg.group_digest(events, ["user_id"], columns)
    second = agg.group_digest(again.repartition(3, "event_id"), ["user_id"], columns).withColumnsRenamed({"n": "n2", "digest": "digest2"})
    return first.join(second, "user_id").select("user_id", "n", ((F.col("n") == F.col("n2")) & (F.col("digest") == F.col("digest2"))).alias("same"))


@query("""WITH t AS (SELECT conv_id, turn, role, 0 AS batch FROM conversations WHERE turn % 3 = 0 UNION ALL SELECT conv_id, turn, role, 1 FROM conversations WHERE turn % 3 = 1 UNION ALL
  SELECT conv_id, turn, role, 2 FROM conversations WHERE turn % 3 = 2 UNION ALL SELECT conv_id, turn, role || '!', 3 FROM conversations WHERE conv_id % 4 = 1)
SELECT CAST(conv_id AS VARCHAR) AS conv_id, arg_max(role, batch * 1000000 + turn) AS role, count(DISTINCT (turn, role)) AS n FROM t GROUP BY conv_id""")
def folded_log(read, spark):
    """A log appended to in three steps of many files, and a tail that repeats some of it: folded, each conversation's
    last row by append order is the same, and repeated rows count once."""
    turns = read("conversations").select("conv_id", "turn", "role")
    folder = shared_folder(spark, "log")
    for k in range(3):
        logs.append_log(turns.where(F.col("turn") % 3 == k), f"{folder}/history", ["turn", "conv_id"])
    later = turns.where("conv_id % 4 = 1").withColumn("role", F.concat("role", F.lit("!")))
    logs.append_log(turns.where("turn % 3 = 1").unionAll(later), f"{folder}/tail", ["turn", "role", "conv_id"])
    history, tail = (spark.read.parquet(f"{folder}/{name}") for name in ("history", "tail"))
    # rows of the tail that the history has already are no new events
    folded = logs.fold_log(history, tail, f"{folder}/folded")
    log = logs.combined_log(folded, None).withColumn("at", logs.ordinal())
    return log.groupBy("conv_id").agg(F.max_by("role", "at").alias("role"), F.count("*").alias("n"))


@query("SELECT event_id, user_id FROM events ORDER BY ts, event_id LIMIT 25")
def first_options(read, spark):
    return windows.first_n(read("events").select("event_id", "user_id", "ts"), ["ts", "event_id"], 25).select("event_id", "user_id")


@query(f"""WITH {_LAST} SELECT state, b AS bucket, count(*) AS blocks FROM l GROUP BY 1, 2""")
def streamed_progress(read, spark):
    """The progress report as a stream over the log, read to its end; it must equal the batch answer."""
    from ..streaming.progress import drained_progress

    return drained_progress(spark, run_log(read), ["year", "state", "block_value"], "state")
