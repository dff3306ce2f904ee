"""SimHash near-duplicates linked by the generalised pigeonhole principle.

1. Fingerprint (Arrow batches): 64 bits; a bit is set if more than half of the shingle hashes have it set.
2. Equal fingerprints are one node from here on, so exact and very near copies never meet in a group again.
3. Bits are grouped: from the 64 x 64 co-occurrence counts of all fingerprints, correlated bits go to one partition,
   which leaves the other partitions selective.
4. Thresholds: if two fingerprints differ in at most ``tau`` bits, then for any thresholds t_i (-1 or more) with
   sum(t_i + 1) = tau + 1 some partition i differs in at most t_i bits. Dynamic programming picks the t_i with the
   least estimated candidates; the estimate starts from the exact collision count of each partition over all
   fingerprints and grows by the odds of a differing bit, again from all fingerprints.
5. Probe: a node is sent to its own bucket in each partition with t_i >= 0, and as a visitor to the buckets within
   t_i bits. A bucket is read in blocks of bounded size: a large bucket becomes pairs of blocks, so no task holds a
   whole bucket and nothing is capped. Inside a block pair, numpy compares all members and gives back only the links
   that join parts not yet joined (at most one per member), never the list of all near pairs.
6. Links become components by minima; the smallest doc_id of a component names it.

Defined results: null and white-space-only texts have fingerprint zero and link like any other. Rows with repeated
ids are fingerprinted one by one, and a component takes the smallest id. Rows with a null id get a fingerprint and the component of
their group (null if no row in it has an id). Very long texts are read whole. An empty table gives no rows. Other
columns never take part, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import similar_sets
from .common import drop_written, fresh, in_batches, table, text_or_empty, written
from .components import components

NAME = "op10_simhash"
TAU = 3
SHINGLE = 3
#: Members of a bucket block: a task compares two blocks at a time.
BLOCK = 2048
#: Bucket blocks of at most so many members are compared together, without a forest of their links.
_SMALL = 8
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text. Only ASCII letters change case and only ASCII white space parts words."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    words = [w for w in words if w]
    if not words:
        return 0
    if len(words) <= size:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    else:
        joined = memoryview(b" ".join(words))
        ends = list(itertools.accumulate([len(w) + 1 for w in words]))
        starts = [0, *ends]
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, [joined[a : b - 1] for a, b in zip(starts, ends[size - 1 :])], itertools.repeat(42)),
            np.uint64,
            len(words) - size + 1,
        )
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) with fp the fingerprint as a signed long."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [_signed(fingerprint(x)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return in_batches(rows, batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


# ---- partitions and thresholds


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together, over all of them."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((64, 64), np.int64)
        for batch in it:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += (bits.T @ bits).astype(np.int64)
            n += len(fps)
        if n:
            i, j = np.divmod(np.arange(64 * 64), 64)
            cols = [i, j, total.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], ["i", "j", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (-1, -1, n)], ["i", "j", "n"])

    rows = nodes.select("fp").mapInArrow(batches, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    counts, n = np.zeros((64, 64)), 0
    for i, j, x in rows:  # 64 x 64 sums, whatever the size of the table
        if i < 0:
            n = x
        else:
            counts[i, j] = x
    return n, counts


def partitions(n: int, counts: np.ndarray) -> list[list[int]]:
    """Bits in partitions: two to four by the number of fingerprints, correlated bits together, equal widths."""
    parts = 4 if n < 1 << 20 else 3 if n < 1 << 27 else 2
    width = [64 // parts + (i < 64 % parts) for i in range(parts)]
    if not n:
        return [list(range(sum(width[:i]), sum(width[: i + 1]))) for i in range(parts)]
    p = np.diag(counts) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(counts / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    left, out = set(range(64)), []
    for w in width:
        rest = sorted(left)
        group = [max(rest, key=lambda b: (corr[b, rest].sum(), -b))]
        while len(group) < w:
            rest = sorted(left - set(group))
            group.append(max(rest, key=lambda b: (corr[b, group].sum(), -b)))
        left -= set(group)
        out.append(sorted(group))
    return out


def thresholds(groups: list[list[int]], n: int, counts: np.ndarray, collisions: list[float], tau: int = TAU) -> list[int]:
    """Thresholds t_i of at least -1 with sum(t_i + 1) = tau + 1 and the least estimated candidates and probes.

    ``collisions[i]`` is the sum of squared bucket sizes of partition i. With radius r the estimate grows by the
    elementary symmetric sums of the odds that a bit differs; a probe costs as much as one candidate.
    """
    p = np.diag(counts) / max(n, 1)
    differ = np.clip(2 * p * (1 - p), 1e-6, 0.5)
    costs = []
    for bits, same in zip(groups, collisions):
        poly, cost, probes = [1.0] + [0.0] * tau, [0.0], 0.0
        for b in bits:
            odds = differ[b] / (1 - differ[b])
            for r in range(tau, 0, -1):
                poly[r] += poly[r - 1] * odds
        ball = 1
        for r in range(tau + 1):
            probes += n * ball
            cost.append(same * sum(poly[: r + 1]) + probes)
            ball = ball * (len(bits) - r) // (r + 1)
        costs.append(cost)  # costs[i][t + 1]
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (spent, chosen) in best.items():
            for extra in range(tau + 2 - used):
                option = (spent + cost[extra], [*chosen, extra - 1])
                if used + extra not in step or option < step[used + extra]:
                    step[used + extra] = option
        best = step
    return best[tau + 1][1]


def _values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bits of a partition as one number."""
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


def _as_fps(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype("<i8").view("<u8")


def collision_counts(nodes: DataFrame, groups: list[list[int]]) -> list[float]:
    """Sum of squared bucket sizes for each partition, over all fingerprints."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fps = _as_fps(batch.column(0))
            part = np.repeat(np.arange(len(groups), dtype=np.int32), len(fps))
            value = np.concatenate([_values(fps, bits) for bits in groups]).view("<i8")
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(value)], ["part", "value"])

    sizes = nodes.select("fp").mapInArrow(batches, "part int, value long").groupBy("part", "value").count()
    rows = sizes.groupBy("part").agg(F.sum(F.col("count").cast("double") ** 2)).collect()
    found = dict(map(tuple, rows))
    return [found.get(i, 0.0) for i in range(len(groups))]


# ---- probe and verify


def probes(nodes: DataFrame, groups: list[list[int]], radius: list[int]) -> DataFrame:
    """(part, value, fp, home): every fingerprint in its own buckets (home) and, as a visitor, in those within reach."""
    balls = []
    for bits, t in zip(groups, radius):
        flips = [sum(1 << k for k in c) for r in range(1, max(t, 0) + 1) for c in itertools.combinations(range(len(bits)), r)]
        balls.append(np.array(flips, np.uint64))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            fps = _as_fps(batch.column(0))
            for i, (bits, t) in enumerate(zip(groups, radius)):
                if t < 0:
                    continue
                own = _values(fps, bits)
                for flip in [np.uint64(0), *balls[i]]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(fps), i, np.int32)), pa.array((own ^ flip).view("<i8")), batch.column(0), pa.array(np.full(len(fps), flip == 0))],
                        ["part", "value", "fp", "home"],
                    )

    return nodes.select("fp").mapInArrow(batches, "part int, value long, fp long, home boolean")


def _join_near(a: np.ndarray, b: np.ndarray, tau: int) -> list[tuple[int, int]]:
    """Links between fingerprints of ``a`` and ``b`` at most ``tau`` bits apart: a forest that joins all that are linked."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    in_a, in_b = at[: len(a)], at[len(a) :]
    label, links = np.arange(len(nodes)), []
    for start in range(0, len(a), 256):
        near = np.bitwise_count(a[start : start + 256, None] ^ b[None, :]) <= tau
        unjoined = near & (label[in_a[start : start + 256], None] != label[in_b][None, :])
        for k in np.flatnonzero(unjoined.any(axis=1)):
            i = in_a[start + k]
            while (left := near[k] & (label[in_b] != label[i])).any():
                j = in_b[np.argmax(left)]
                links.append((int(nodes[i]), int(nodes[j])))
                label[label == label[j]] = label[i]
    return links


def near_links(nodes: DataFrame, groups: list[list[int]], radius: list[int], tau: int = TAU, block: int = BLOCK) -> DataFrame:
    """(u, v): links that join all fingerprints of ``nodes`` (fp) that are at most ``tau`` bits apart."""
    sent = probes(nodes, groups, radius)
    sizes = sent.groupBy("part", "value").agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
    met = sizes.where("n > 1 and homes > 0").select("part", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    rows = sent.join(met, ["part", "value"])
    # bucket of several blocks: a member goes to the pair of its block with each block, itself included
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("part", "value", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "fp", "home")

    placed = rows.repartition("part", "value", "low", "high").sortWithinPartitions("part", "value", "low", "high")

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in itertools.chain(it, [None]):
            if batch is not None:
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                rest = columns if rest is None else [np.concatenate(pair) for pair in zip(rest, columns)]
            if rest is None or not len(rest[0]):
                continue
            new = np.any([c[1:] != c[:-1] for c in rest[:4]], axis=0)
            ends = np.append(np.flatnonzero(new) + 1, [len(rest[0])] if batch is None else [])
            if not len(ends):
                continue  # one bucket block so far, and it may go on
            cut = int(ends[-1])
            links = _bucket_links([c[:cut] for c in rest], ends.astype(np.int64), tau)
            rest = [c[cut:] for c in rest]
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["u", "v"])

    return placed.mapInArrow(compare, "u long, v long")


def _bucket_links(columns: list[np.ndarray], ends: np.ndarray, tau: int) -> np.ndarray:
    """Links inside each of the bucket blocks that end at ``ends``; visitors only meet members at home."""
    _, _, low, high, mine, fp, home = columns
    fps, sizes = fp.astype("<i8").view("<u8"), np.diff(ends, prepend=0)
    found = []
    # small blocks all at once: every member with the next, the one after that, and so on
    small = np.repeat(sizes <= _SMALL, sizes)
    block = np.repeat(np.arange(len(sizes)), sizes)
    for step in range(1, _SMALL):
        i = np.flatnonzero(small[:-step] & (block[:-step] == block[step:])) if len(fps) > step else np.zeros(0, np.int64)
        i = i[(home[i] | home[i + step]).astype(bool) & (fps[i] != fps[i + step])]
        i = i[np.bitwise_count(fps[i] ^ fps[i + step]) <= tau]
        found.append(np.stack([fps[i], fps[i + step]], axis=1))
    for k in np.flatnonzero(sizes > _SMALL):
        at = slice(ends[k] - sizes[k], ends[k])
        here, own, whose = fps[at], home[at].astype(bool), mine[at]
        for x, y in {(low[at.start], high[at.start]), (high[at.start], low[at.start])}:
            links = _join_near(here[(whose == x) & own], here[whose == y], tau)
            found.append(np.array(links, np.uint64).reshape(-1, 2))
    return np.concatenate(found).view("<i8") if found else np.zeros((0, 2), np.int64)


def link_components(prints: DataFrame, tau: int = TAU, block: int = BLOCK) -> DataFrame:
    """(fp, component_id) for every fingerprint of ``prints`` (doc_id, fp)."""
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fps")
    n, counts = bit_counts(nodes)
    groups = partitions(n, counts)
    radius = thresholds(groups, n, counts, collision_counts(nodes, groups), tau)
    joined = components(near_links(nodes, groups, radius, tau, block))
    found = nodes.join(joined, nodes.fp == joined.node, "left").select("fp", "least_id", F.coalesce("component", "fp").alias("root"))
    names = found.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return found.join(names, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    prints = written(fingerprints(docs, id_col, text_col), "prints")
    found = link_components(prints, tau, block)
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_pairs(prints: DataFrame, tau: int = TAU, block: int = BLOCK) -> DataFrame:
    """(u, v): nodes of ``prints`` (node, fp) that equal fingerprints, or links between near ones, bring together."""
    heads = written(prints.groupBy("fp").agg(F.min("node").alias("head")), "fps")
    n, counts = bit_counts(heads)
    groups = partitions(n, counts)
    radius = thresholds(groups, n, counts, collision_counts(heads, groups), tau)
    links = near_links(heads, groups, radius, tau, block)
    ends = [heads.select(F.col("fp").alias(c), F.col("head").alias(f"node_{c}")) for c in "uv"]
    far = links.join(ends[0], "u").join(ends[1], "v").select(F.col("node_u").alias("u"), F.col("node_v").alias("v"))
    same = prints.select("fp", "node").distinct().join(heads, "fp").where("node <> head").select(F.col("node").alias("u"), F.col("head").alias("v"))
    return far.union(same).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def keep_representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = similar_sets.SHINGLE, least: float = similar_sets.LEAST,
    tau: int = TAU, block: int = BLOCK,
) -> DataFrame:
    """One row of ``docs``, with all its columns, for each group of texts linked by sets of ``size``-word shingles with
    Jaccard similarity ``least`` or more.

    Fingerprints of the sets that are at most ``tau`` bits apart give the first pairs, confirmed by the exact
    similarity. Bits alone find few sets of similarity 0.8 (they differ in about ten of 64), so ``similar_sets`` finds
    the links that are left, exactly. The row with the smallest id stays, null after all others, of equal ids the one
    with the smallest hash of its text, of equal rows any one.
    """
    found = written(similar_sets.prints(docs, id_col, text_col, size, least), "shingles")
    joined = similar_sets.link_components(docs, found, id_col, text_col, size, least, block, near_pairs(found, tau, block))
    roots = found.join(joined, "node", "left").select("doc_id", "text_hash", F.coalesce("component", "node").alias("root"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    names = roots.groupBy("root").agg(F.min(row).alias("name"), F.count("*").alias("n")).where("n > 1")
    other = ~(F.col("doc_id").eqNullSafe(F.col("name.doc_id")) & (F.col("text_hash") == F.col("name.text_hash")))
    key, of_id, of_text = fresh("key"), fresh("id"), fresh("text")
    columns = [F.col("doc_id").alias(of_id), F.col("text_hash").alias(of_text)]
    gone = written(roots.join(names, "root").where(other).select(*columns).distinct(), "gone")
    repeated = written(roots.groupBy("doc_id", "text_hash").count().where("count > 1").select(*columns), "repeated")
    keyed = docs.withColumn(key, similar_sets.text_hash(text_col))

    def join(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return rows.join(keys, F.col(key).eqNullSafe(F.col(of_text)) & rows[id_col].eqNullSafe(keys[of_id]), how)

    kept = join(keyed, gone, "left_anti")
    if not repeated.isEmpty():
        first = Window.partitionBy(id_col, key).orderBy(F.lit(0))
        nth = fresh("nth")
        once = join(kept, repeated, "left_semi").withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).drop(nth)
        kept = join(kept, repeated, "left_anti").unionByName(once)
    return kept.drop(key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
