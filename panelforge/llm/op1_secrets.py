"""Secret scan with corpus-wide ownership frequency, in DataFrame operations only.

1. One pass over the texts finds candidates: assignments, access keys, hexadecimal runs (the base kinds) and long
   tokens that mix cases and digits. Places are prefix sums over ``split`` pieces and matches, in code points.
2. Every candidate value is hashed. Hashes are counted by distinct owner and repository over the whole corpus, each
   step partially aggregated before its shuffle, so a value that is copied everywhere crosses the network a few times.
3. A value that looks live (no placeholder words, enough different characters) is owner-specific if it has few owners
   and few repositories; one with many of either is widely copied. A mixed token on its own is too weak a sign, so it
   becomes a span only if it is owner-specific; base spans stay whatever their frequency.

Defined results: null counts as the empty text. Each row of the input gives one row, repeated rows repeated results.
A null repository or owner counts as one value. Spans sort by start, then by kind in the order assign, access, hex,
token. Very long texts are read whole; places are prefix sums in three levels, so many matches in one text cost little
more than their number. An empty table gives no rows. Other columns never take part, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, written

NAME = "op1_secrets"
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A match shorter than required inside a run of the same characters is the whole run, so these may ask for the length.
KINDS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}", "token": r"[A-Za-z0-9+/_-]{24,}"}
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|redacted|your[_-]?|xxxx|0000|1234567"
#: Values of at most so many owners and repositories are owner-specific.
MAX_OWNERS, MAX_REPOS = 2, 8
_GROUP = 64
#: Of a value in the corpus: uses, distinct repositories, distinct owners.
FREQUENCIES = ("n_uses", "n_repos", "n_owners")


def _spans(text: Column, kind: str) -> tuple[Column, Column]:
    """(pieces between matches, matches) of a kind; both empty where the cheap test fails."""
    pattern = F.lit(KINDS[kind])
    none = F.array().cast("array<string>")
    hit = text.rlike(KINDS[kind])
    return F.when(hit, F.split(text, KINDS[kind], -1)).otherwise(none), F.when(hit, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(none)


def _sum(sizes: Column) -> Column:
    return F.aggregate(sizes, F.lit(0), lambda a, x: a + x)


def _group_sums(sizes: str) -> Column:
    """The sums of groups of _GROUP entries."""
    groups = F.sequence(F.lit(0), F.ceil(F.size(sizes) / _GROUP).cast("int"))
    return F.transform(groups, lambda g: _sum(F.slice(sizes, g * _GROUP + 1, F.lit(_GROUP))))


def _before(groups_before: str, sizes: str, i: Column) -> Column:
    """The sum of the entries of ``sizes`` before place ``i``, from the sums before each group."""
    group = F.floor(i / _GROUP).cast("int")
    return F.get(groups_before, group) + _sum(F.slice(sizes, group * _GROUP + 1, i % _GROUP))


def _sums_before(sizes: str) -> Column:
    """For each entry the sum of those before it, by adding them all: for short arrays."""
    return F.transform(sizes, lambda _, i: _sum(F.slice(sizes, F.lit(1), i)))


def _all_before(groups_before: str, sizes: str) -> Column:
    return F.transform(sizes, lambda _, i: _before(groups_before, sizes, i))


def candidates(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> DataFrame:
    """Row number, id, repo, owner and the candidate spans of every row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), repo.cast("string").alias("repo"), owner.cast("string").alias("owner"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    found = {f"{kind}_{what}": c for kind in KINDS for what, c in zip(("pieces", "matches"), _spans(F.col("text"), kind))}
    rows = rows.withColumns(found).drop("text")
    # prefix sums in three levels: sums of groups of _GROUP lengths, of groups of _GROUP groups, and inside a group
    rows = rows.withColumns({f"{k}_sizes": F.zip_with(f"{k}_pieces", f"{k}_matches", lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0))) for k in KINDS})
    rows = rows.withColumns({f"{k}_sums": _group_sums(f"{k}_sizes") for k in KINDS})
    rows = rows.withColumns({f"{k}_high": _group_sums(f"{k}_sums") for k in KINDS})
    rows = rows.withColumns({f"{k}_high_before": _sums_before(f"{k}_high") for k in KINDS})
    rows = rows.withColumns({f"{k}_before": _all_before(f"{k}_high_before", f"{k}_sums") for k in KINDS})

    def span(k: str, order: int) -> Column:
        def one(match: Column, i: Column) -> Column:
            start = _before(f"{k}_before", f"{k}_sizes", i) + F.length(F.get(f"{k}_pieces", i))
            value = F.regexp_extract(match, ASSIGN, 2) if k == "assign" else match
            return F.struct(start.alias("start"), F.lit(order).alias("rank"), F.lit(k).alias("kind"), (start + F.length(match)).alias("end"), value.alias("value"))

        spans = F.transform(f"{k}_matches", one)
        if k == "assign":
            spans = F.filter(spans, lambda s: F.length(s["value"]) >= 12)
        if k == "token":
            spans = F.filter(spans, lambda s: s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]"))
        return spans

    rows = rows.withColumns({k: span(k, o) for o, k in enumerate(KINDS)})
    base = F.array_sort(F.concat("assign", "access", "hex"))
    rows = rows.select("row", "doc_id", "repo", "owner", base.alias("base"), F.col("token"), *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")))
    # a token that overlaps a base span is that span
    apart = F.filter("token", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return rows.withColumn("token", apart)


def ownership(found: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """For each secret hash: uses, repositories, owners and verdict (owner_specific, widely_copied or placeholder)."""
    uses = found.select("repo", "owner", F.explode(F.concat("base", "token")).alias("s"))
    uses = uses.select("repo", "owner", F.sha2("s.value", 256).alias("secret"), live_looking(F.col("s.value")).alias("live"))
    by_repo = uses.groupBy("secret", "live", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("secret", "live", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
    total = by_owner.groupBy("secret", "live").agg(F.sum("n").alias("n_uses"), F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))
    verdict = F.when(~F.col("live"), "placeholder").when((F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos), "owner_specific").otherwise("widely_copied")
    return total.select("secret", "n_uses", "n_repos", "n_owners", verdict.alias("verdict"))


def live_looking(value: Column) -> Column:
    """No placeholder words, and at least eight different characters."""
    return ~value.rlike(PLACEHOLDER) & (F.size(F.array_distinct(F.split(value, ""))) >= 8)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per row of ``docs``: doc_id, counts by kind, base_spans, all_spans, n_owner_specific, n_widely_copied, and
    the most uses, repositories and owners that any candidate value of the row has in the corpus."""
    nothing = F.lit(None).cast("string")
    found = written(candidates(docs, id_col, text_col, nothing if repo is None else repo, nothing if owner is None else owner), "secrets")
    span = F.explode(F.concat("base", "token")).alias("s")
    uses = found.where("size(base) + size(token) > 0").select("row", span).withColumn("secret", F.sha2("s.value", 256))
    judged = uses.join(ownership(found, max_owners, max_repos), "secret")
    own, token = F.col("verdict") == "owner_specific", F.col("s.kind") == "token"
    by_row = judged.groupBy("row").agg(
        F.count_if(own).alias("n_owner_specific"),
        F.count_if(F.col("verdict") == "widely_copied").alias("n_widely_copied"),
        *(F.max(c).alias(c) for c in FREQUENCIES),
        F.collect_list(F.when(own & token, F.col("s"))).alias("added"),
    )
    out = found.join(by_row, "row", "left")
    none = F.slice("token", 1, 0)
    every = F.array_sort(F.concat("base", F.coalesce("added", none)))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_owner_specific", "n_widely_copied", *FREQUENCIES)}
    return out.withColumns(zero | {"all_spans": every}).select("doc_id", "n_assign", "n_access", "n_hex", F.col("base").alias("base_spans"), "all_spans", *zero)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan(docs, repo=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(_listed(F.col("base_spans")), 256).alias("base_sha256"),
        _listed(F.col("all_spans")).alias("spans"), "n_owner_specific", "n_widely_copied", *FREQUENCIES,
    )


_SQL_ASSIGN = (
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)


def _sql_kind(kind: str, order: int) -> str:
    pattern = _SQL_ASSIGN if kind == "assign" else KINDS[kind]
    value = f"regexp_extract(m[i], '{pattern}', 2)" if kind == "assign" else "m[i]"
    return f"""
  SELECT rid, '{kind}' AS kind, {order} AS ord, i, {value} AS value, length(m[i]) AS n,
         coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS start
  FROM (SELECT rid, m, p, unnest(range(1, len(m) + 1)) AS i FROM (
    SELECT rid, regexp_extract_all(text, '{pattern}') AS m, regexp_split_to_array(text, '{pattern}') AS p FROM d WHERE regexp_matches(text, '{pattern}')))"""


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS owner, concat_ws('/', source, lang) AS repo, coalesce(text, '') AS text FROM documents
), raw AS ({" UNION ALL ".join(_sql_kind(k, o) for o, k in enumerate(KINDS))}
), cand AS (
  SELECT rid, kind, ord, CAST(start AS BIGINT) AS start, CAST(start + n AS BIGINT) AS stop, sha256(value) AS secret,
         NOT regexp_matches(value, '{PLACEHOLDER}') AND len(list_distinct(string_split(value, ''))) >= 8 AS live
  FROM raw
  WHERE kind IN ('access', 'hex') OR (kind = 'assign' AND length(value) >= 12)
     OR (kind = 'token' AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]'))
), kept AS (
  SELECT * FROM cand c WHERE kind <> 'token'
    OR NOT EXISTS (SELECT 1 FROM cand b WHERE b.rid = c.rid AND b.kind <> 'token' AND b.start < c.stop AND c.start < b.stop)
), freq AS (
  SELECT secret, live, count(*) AS uses, count(DISTINCT coalesce(owner, '')) AS owners, count(DISTINCT coalesce(owner, '') || ' ' || repo) AS repos
  FROM kept JOIN d USING (rid) GROUP BY secret, live
), judged AS (
  SELECT kept.*, uses, repos, owners, CASE WHEN NOT kept.live THEN 'placeholder' WHEN owners <= {MAX_OWNERS} AND repos <= {MAX_REPOS} THEN 'owner_specific' ELSE 'widely_copied' END AS verdict
  FROM kept JOIN freq USING (secret)
), byrow AS (
  SELECT rid,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (kind <> 'token') AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord) FILTER (kind <> 'token' OR verdict = 'owner_specific') AS spans,
    count(*) FILTER (verdict = 'owner_specific') AS n_owner_specific, count(*) FILTER (verdict = 'widely_copied') AS n_widely_copied,
    max(uses) AS n_uses, max(repos) AS n_repos, max(owners) AS n_owners
  FROM judged GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_owner_specific, 0) AS n_owner_specific, coalesce(n_widely_copied, 0) AS n_widely_copied,
       coalesce(n_uses, 0) AS n_uses, coalesce(n_repos, 0) AS n_repos, coalesce(n_owners, 0) AS n_owners
FROM d LEFT JOIN byrow USING (rid)
"""
