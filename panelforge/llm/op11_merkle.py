"""Merkle manifest of a data set: a tree for each source, a tree over the sources, and a proof for each row.

A row's leaf is the digest of its fields. Leaves of a source stand in the order of their ids; every 16 consecutive
nodes become their parent until one is left, the source's subroot; the subroots in the order of the sources become
the root in the same way. A proof holds the siblings of all levels, so one row is checked without the others.

How it runs: one scan makes the leaves, texts go no further. A range partitioning by (source, id) gives places: the
number of a row in its sorted partition plus the rows of its source before, from counts by partition and source, so no
source is in one task. Digests go up by partial groups of 16. Nodes above the superblocks (16 to the power of
``local_levels`` leaves) come down again as paths: each run of 16 hands its digests and its own path to its children,
so no join key has more than 16 rows. In the end the leaves and the outer nodes that their proofs need are cogrouped
by superblock, where ``applyInPandas`` finishes the local reduction, joins the proofs and folds them. A superblock is
bounded (4,096 leaves of about 200 bytes), so a hot source is many groups. Memory and depth do not depend on the data:
levels grow with the logarithm of the rows.

Defined results: a null field is ``-``, an empty one ``0:``. A null source is a source of its own and the first; null
ids stand first in their source. Rows with equal ids stand in the order of their leaves, repeated rows each have
a leaf of their own. An empty table gives no rows. A source of one row has its leaf as subroot, a table of one
source has its subroot as root. Texts of any length are hashed whole. Other columns never take part, whatever their
names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, bucket, scratch, table, written

NAME = "op11_merkle"
#: Children of a node.
FAN = 16
#: Levels inside a superblock: 4,096 leaves.
LOCAL_LEVELS = 3
#: Fields of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(fields: list[Column]) -> Column:
    """SHA-256 (32 bytes) of the fields' texts, each with its length in bytes in front."""
    as_text = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in as_text]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _joined(digests: Column) -> Column:
    """The hex text of an array of digests."""
    return F.lower(F.array_join(F.transform(digests, lambda d: F.hex(d)), ""))


@dataclass
class Manifest:
    """``rows``: tree, pos, total, id, leaf, changed. ``trees``: tree, value, total. ``paths``: tree, block, path (runs
    of digests from the superblock to the root). ``root``: one row, none if the table is empty."""

    rows: DataFrame
    trees: DataFrame
    paths: DataFrame
    root: DataFrame
    local_levels: int
    id_type: str


def _sorted_rows(leaves: DataFrame) -> DataFrame:
    """``leaves`` in global order, ``at`` being the partition (upper bits) and the place in it."""
    order = ["value", "id", "leaf", "changed", "tie"]  # the tie spreads repeated rows over partitions
    rows = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(rows.drop("tie").withColumn("at", F.monotonically_increasing_id()), "merkle-sorted")
    return rows.withColumn("part", F.shiftright("at", 33))


def _places(rows: DataFrame) -> DataFrame:
    """For each partition and tree: its number in the order of the trees, ``shift`` (from ``at`` to the place in the
    tree) and ``total``. As many rows as partitions and trees together."""
    pieces = written(rows.groupBy("part", "value").agg(F.min("at").alias("first"), F.count("*").alias("n")), "merkle-pieces")
    one_tree = Window.partitionBy("value")
    before = F.coalesce(F.sum("n").over(one_tree.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select("part", "value", "first", before.alias("before"), F.sum("n").over(one_tree).alias("total"))
    # a tree is numbered in the partition where it begins; the one window without a key has a row for each partition
    begins = pieces.where("before = 0")
    counts = begins.groupBy("part").agg(F.count("*").alias("n"))
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("part", earlier.alias("earlier"))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("first")) - 1
    trees = begins.join(counts, "part").select(F.col("value").alias("name"), (F.col("earlier") + nth).alias("tree"))
    out = pieces.join(trees, F.col("value").eqNullSafe(F.col("name")))
    return out.select("part", "value", "tree", (F.col("before") - F.col("first")).alias("shift"), "total")


def _up(nodes: DataFrame) -> DataFrame:
    """The level above ``nodes`` (tree, pos, total, digest), with the digests of each node's children. The single node
    of a finished tree stays as it is."""
    runs = nodes.groupBy("tree", F.shiftright("pos", 4).alias("pos")).agg(
        F.first("total").alias("was"), F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("run")
    )
    runs = runs.withColumn("run", F.transform("run", lambda x: x["digest"]))
    digest = F.when(F.col("was") == 1, F.col("run")[0]).otherwise(F.unhex(F.sha2(_joined(F.col("run")), 256)))
    return runs.select("tree", "pos", F.ceil(F.col("was") / FAN).cast("long").alias("total"), digest.alias("digest"), "run")


@dataclass
class _Climb:
    """``runs[k]``: nodes (tree, pos) of level k + 1 with the digests of their children; ``ends[k]``: trees (tree,
    digest) whose single node is at level k."""

    runs: list[DataFrame]
    ends: list[DataFrame]


def _climb(nodes: DataFrame) -> _Climb:
    """All levels above ``nodes``, a table in the shared folder for each."""
    out = _Climb([], [nodes.where("total = 1").select("tree", "digest")])
    most = nodes.agg(F.max("total")).first()[0] or 0
    while most > 1:
        above = written(_up(nodes.where("total > 1")), "merkle-level")
        out.runs.append(above.select("tree", "pos", "run"))
        out.ends.append(above.where("total = 1").select("tree", "digest"))
        nodes, most = above, -(-most // FAN)
    return out


_PATH = "array<struct<at:int,above:boolean,run:array<binary>>>"


def _down(climb: _Climb, starts: list[DataFrame], above: bool) -> DataFrame:
    """(tree, pos, path) of the nodes that ``climb`` began with. ``starts[k]``: (tree, pos, path) of trees that end at
    level k. Each run gives its digests and its path to its at most 16 children."""
    at = starts[-1]
    for runs, ended in zip(reversed(climb.runs), reversed(starts[:-1])):
        children = at.join(runs, ["tree", "pos"]).select("tree", "pos", "path", "run", F.posexplode("run").alias("k", "digest"))
        step = F.array(F.struct(F.col("k").alias("at"), F.lit(above).alias("above"), "run"))
        children = children.select("tree", (F.col("pos") * FAN + F.col("k")).alias("pos"), F.concat(step.cast(_PATH), "path").alias("path"))
        at = children.union(ended)
    return at


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    tree_col: str = "source",
    changed: Mapping[str, Column] | None = None,
    local_levels: int = LOCAL_LEVELS,
) -> Manifest:
    """The manifest of ``docs``. ``changed`` gives fields as they are found later, to be checked by ``proofs``."""
    with scratch() as keep:
        now = [(changed or {}).get(f, F.col(f)) for f in fields]
        leaves = docs.select(
            F.col(tree_col).alias("value"),
            F.col(id_col).alias("id"),
            leaf([F.col(f) for f in fields]).alias("leaf"),
            (leaf(now) if changed else F.lit(None).cast("binary")).alias("changed"),
            F.monotonically_increasing_id().alias("tie"),
        )
        rows = _sorted_rows(written(leaves, "merkle-leaves"))
        places = written(_places(rows), "merkle-places")
        few = broadcast_if_small(places.select("part", F.col("value").alias("name"), "tree", "shift", "total"))
        rows = rows.join(few, (rows["part"] == few["part"]) & rows["value"].eqNullSafe(few["name"]))
        rows = written(rows.select("tree", (F.col("at") + F.col("shift")).alias("pos"), "total", "id", "leaf", F.coalesce("changed", "leaf").alias("changed")), "merkle-rows")
        keep(rows)

        nodes = rows.select("tree", "pos", "total", F.col("leaf").alias("digest"))
        nodes = reduce(lambda x, _: _up(x).drop("run"), range(local_levels), nodes)
        climb = _climb(written(nodes, "merkle-superblocks"))
        trees = written(places.select("tree", "value", "total").distinct(), "merkle-trees")
        keep(trees)
        subroots = reduce(DataFrame.union, climb.ends).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(trees.count()).cast("long").alias("total"), "digest")
        top = _climb(written(subroots, "merkle-subroots"))
        root = written(reduce(DataFrame.union, top.ends).select("digest"), "merkle-root")
        keep(root)

        # of the tree over the sources exactly one level ends: the path begins there
        none = [end.select("tree", F.lit(0).cast("long").alias("pos"), F.array().cast(_PATH).alias("path")) for end in top.ends]
        whole = written(_down(top, none, above=True).select(F.col("pos").alias("tree"), "path"), "merkle-top")
        starts = [end.join(whole, "tree").select("tree", F.lit(0).cast("long").alias("pos"), "path") for end in climb.ends]
        paths = written(_down(climb, starts, above=False).select("tree", F.col("pos").alias("block"), "path"), "merkle-paths")
        keep(paths)
    return Manifest(rows, trees, paths, root, local_levels, dict(docs.dtypes)[id_col])


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


_FOUND = "tree long, pos long, id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _finish(levels: int):
    """The function of one superblock: its leaves and the runs on its way to the root."""

    def step(text: str, slot: int, proof, folded: str) -> str:
        left, right = text[: 64 * slot], text[64 * slot + 64 :]
        proof.update((left + right).encode())
        return _h(left + folded + right)

    def finish(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        leaves = [bytes(x).hex() for x in rows["leaf"]]
        folded = [bytes(x).hex() for x in rows["changed"]]
        proofs = [hashlib.sha256() for _ in leaves]
        nodes, total = leaves, int(rows["total"].iloc[0]) if len(rows) else 1
        for level in range(levels):
            if total == 1:
                break
            runs = ["".join(nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)]
            for i, proof in enumerate(proofs):
                at = i // FAN**level
                folded[i] = step(runs[at // FAN], at % FAN, proof, folded[i])
            nodes, total = [_h(run) for run in runs], -(-total // FAN)
        node = subroot = nodes[0] if nodes else None
        for slot, above, run in outer.sort_values("step")[["at", "above", "run"]].itertuples(index=False):
            kids = [bytes(x).hex() for x in run]
            if kids[slot] != node:
                raise ValueError("the leaves of a superblock do not have its digest")
            text = "".join(kids)
            folded = [step(text, slot, proof, f) for proof, f in zip(proofs, folded)]
            node = _h(text)
            subroot = subroot if above else node
        out = {"tree": rows["tree"], "pos": rows["pos"], "id": rows["id"], "leaf": leaves, "subroot": subroot, "root": node}
        return pd.DataFrame(out | {"proof_sha256": [p.hexdigest() for p in proofs], "folded_root": folded, "verified": [f == node for f in folded]})

    return finish


def proofs(made: Manifest) -> DataFrame:
    """One row per row: tree, pos, id, leaf, subroot, root, proof_sha256 (digest of the siblings on its way to the root),
    folded_root (made from the changed leaf and these siblings) and verified."""
    block = F.shiftright("pos", 4 * made.local_levels).alias("block")
    leaves = made.rows.select("tree", block, "pos", "total", F.col("id").cast("string").alias("id"), "leaf", "changed")
    outer = made.paths.select("tree", "block", F.posexplode("path").alias("step", "x")).select("tree", "block", "step", "x.at", "x.above", "x.run")
    found = leaves.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(_finish(made.local_levels), _FOUND)
    return found.withColumn("id", F.col("id").cast(made.id_type))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, checked against texts of which a fifth have lost their capitals."""
    tampered = F.when(bucket("doc_id", 5) == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    found = proofs(manifest(table(spark, sf_dir, "documents"), changed={"text": tampered}))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _levels(node: str, run: str, key: str, most: int) -> str:
    """SQL of ``most`` levels of trees by ``key``: tables run0, run1, ... and node1, node2, ..."""
    return "".join(
        f"""
{run}{k} AS MATERIALIZED (
  SELECT {key}, pos // 16 AS pos, any_value(n) AS n, string_agg(h, '' ORDER BY pos) AS txt FROM {node}{k} WHERE n > 1 GROUP BY {key}, pos // 16
),
{node}{k + 1} AS MATERIALIZED (
  SELECT {key}, pos, (n + 15) // 16 AS n, sha256(txt) AS h FROM {run}{k} UNION ALL SELECT {key}, pos, n, h FROM {node}{k} WHERE n = 1
),"""
        for k in range(most)
    )


def _folds(run: str, key: str, first: int, most: int) -> str:
    """SQL of the steps up: fold tables from ``first`` on, one for each level."""
    return "".join(
        f"""
fold{first + k + 1} AS MATERIALIZED (
  SELECT f.* REPLACE (
    CASE WHEN r.txt IS NULL THEN f.slot ELSE f.slot // 16 END AS slot,
    f.proof || coalesce(r.txt[:64 * (f.slot % 16)] || r.txt[64 * (f.slot % 16) + 65:], '') AS proof,
    CASE WHEN r.txt IS NULL THEN f.folded ELSE sha256(r.txt[:64 * (f.slot % 16)] || f.folded || r.txt[64 * (f.slot % 16) + 65:]) END AS folded
  ) FROM fold{first + k} f LEFT JOIN {run}{k} r ON f.{key} IS NOT DISTINCT FROM r.{key} AND f.slot // 16 = r.pos
),"""
        for k in range(most)
    )


#: Levels that the SQL spells out: 16 million rows of a source, 65,536 sources.
_SOURCE_LEVELS, _ROOT_LEVELS = 6, 4
_LEAF = "sha256({})".format(" || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in FIELDS))
ORACLE = f"""
WITH crc_bytes AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
),
rows_now AS MATERIALIZED (
  SELECT doc_id, source, {_LEAF} AS leaf,
    CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 5 = 0
      THEN {_LEAF.replace("text::VARCHAR", f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_LEAF} END AS changed
  FROM documents, crc_bytes
),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM rows_now
),
node0 AS (SELECT source, pos, n, leaf AS h FROM numbered),{_levels("node", "run", "source", _SOURCE_LEVELS)}
top0 AS MATERIALIZED (
  SELECT 0 AS one, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, h FROM node{_SOURCE_LEVELS}
),{_levels("top", "above", "one", _ROOT_LEVELS)}
fold0 AS (SELECT 0 AS one, source, doc_id, leaf, pos AS slot, '' AS proof, changed AS folded FROM numbered),{_folds("run", "source", 0, _SOURCE_LEVELS)}
fold100 AS (SELECT f.* REPLACE (t.pos AS slot), t.h AS subroot FROM fold{_SOURCE_LEVELS} f JOIN top0 t ON f.source IS NOT DISTINCT FROM t.source),{_folds("above", "one", 100, _ROOT_LEVELS)}
root AS (SELECT h AS root FROM top{_ROOT_LEVELS})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM fold{100 + _ROOT_LEVELS}, root
"""
