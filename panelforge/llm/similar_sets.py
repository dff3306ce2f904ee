"""Texts whose sets of word shingles are alike: an exact set-similarity join, then links between sets.

1. The shingles of a text are hashed to 64 bits; equal sets are one node, named by a hash of the set.
2. All shingles stand in one order: those that a sample of the texts shows to be common come last, by their count, and
   the others by hash. Two sets with Jaccard similarity ``least`` or more must share one of the first
   n - ceil(least * n) + 1 shingles of each (prefix filter). Any order gives the same pairs, so the sample only saves work.
3. Each shingle of a prefix is a bucket. Buckets with one node fall away; of the pairs in the others those remain whose
   sizes, and whose places of the shared shingle, leave room for enough common shingles. Neither test loses a pair.
4. A sketch holds, for classes of shingles by hash, whether an odd number of the set falls in each. Where two sketches
   differ the sets differ, so the differing bits bound the shingles that are not common from below, and no similar pair is
   refused. The pairs left are confirmed by the exact similarity of their whole sets.
5. First every bucket offers its members with one of them, which is the same for only some of the buckets of a group, and
   a caller can add pairs found by other means. Then it offers a few pairs of any two parts that links do not join yet:
   that joins most of what is alike. Last it offers all pairs of parts that are still apart, so none is lost. Buckets are
   compared in blocks of bounded size.

Defined results: texts shorter than a shingle are one shingle; null and white-space-only texts are alike. Only ASCII
letters change case and only ASCII white space parts words. An empty table gives no rows. Very long texts are read whole.
No pair of similar texts is lost, except that two shingles or two sets with equal 64-bit hashes count as equal.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, drop_written, fresh, in_batches, text_or_empty, written
from .components import components

SHINGLE = 5
LEAST = 0.8
#: One text of so many is read to find common shingles, of which at most so many are held.
SAMPLE, MAX_COMMON = 16, 200_000
#: Different members that the buckets of one group offer first; pairs of two parts in a block that are tried before all.
CENTRES, FEW = 8, 4
#: Members of a bucket block: a task compares two blocks at a time.
BLOCK = 2048
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_EPS = 1e-9


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """The distinct shingle hashes of a text in ascending order."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    joined = memoryview(b" ".join(words))
    starts = [0, *itertools.accumulate([len(w) + 1 for w in words])]
    parts = [joined[a : b - 1] for a, b in zip(starts, starts[size:])]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts, itertools.repeat(42)), np.uint64, len(parts)))


def _node(found: np.ndarray) -> int:
    value = xxhash.xxh64_intdigest(found.astype("<u8").tobytes(), 7)
    return value - (1 << 64) if value >> 63 else value


def prefix(found: np.ndarray, common: np.ndarray, rank: np.ndarray, least: float = LEAST) -> np.ndarray:
    """The first shingles of a set in the order of all shingles; ``common`` is sorted, with the rank of each."""
    keep = len(found) - int(np.ceil(least * len(found) - _EPS)) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        is_common = common[at] == found
        late = found[is_common][np.argsort(rank[at[is_common]])]
        found = np.concatenate([found[~is_common], late])
    return found[:keep]


def sketch(found: np.ndarray) -> np.ndarray:
    """The size of the set, then one bit for each class by the low bits of the hash: whether an odd number falls in it.
    There are two to four classes for each shingle, 64 at least; 64-bit words."""
    classes = 1 << max((2 * len(found) - 1).bit_length(), 6)
    odd = np.bincount((found & np.uint64(classes - 1)).astype(np.int64), minlength=classes).astype(np.uint8) & 1
    return np.concatenate([np.array([len(found)], np.uint64), np.packbits(odd, bitorder="little").view("<u8")])


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Sketches (without their sizes, one in a row) with classes put together until ``words`` words are left."""
    return np.bitwise_xor.reduce(bits.reshape(len(bits), -1, words), axis=1)


def _apart(size_a, size_b, least: float):
    """The most shingles that two similar sets may have besides the common ones."""
    return (1 - least) / (1 + least) * (size_a + size_b) + _EPS


def coarse(packed: bytes) -> bytes:
    """A sketch with at most one class or two for each shingle, for the buckets."""
    words = np.frombuffer(packed, "<u8")
    if len(words) <= 2:
        return packed
    return np.concatenate([words[:1], folded(words[None, 1:], (len(words) - 1) // 2)[0]]).tobytes()


def may_be_similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sketches may belong to similar sets."""
    words = min(len(a), len(b)) - 1
    differ = np.bitwise_count(folded(a[None, 1:], words) ^ folded(b[None, 1:], words)).sum()
    return bool(differ <= _apart(int(a[0]), int(b[0]), least))


def common_shingles(docs: DataFrame, text_col: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of several texts in a sample, sorted, with their rank by count."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [shingles(x, size) for x in batch.column(0).to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["token"])

    text = text_or_empty(text_col)
    sample = docs.select(text.alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = in_batches(sample, batches, "token long").groupBy("token").count().where("count >= 3")
    # at most MAX_COMMON pairs of numbers, whatever the size of the table
    rows = counts.orderBy(F.desc("count"), "token").limit(MAX_COMMON).toArrow()
    token, count = rows["token"].to_numpy().view(np.uint64), rows["count"].to_numpy()
    order = np.lexsort((token, count))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    by_token = np.argsort(token)
    return token[by_token], rank[by_token]


def fingerprint_of(found: np.ndarray) -> int:
    """64 bits, each set if more than half of the shingle hashes have it set; as a signed number."""
    ones = np.unpackbits(found.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(found), bitorder="little").view("<i8")[0])


def prints(docs: DataFrame, id_col: str, text_col: str, size: int, least: float) -> DataFrame:
    """(doc_id, text_hash, node, fp, size, sketch, coarse, prefix) for every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, text_col, size))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, rank = held.value
        for batch in it:
            found = [shingles(x, size) for x in batch.column(2).to_pylist()]
            first = [prefix(x, common, rank, least) for x in found]
            ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
            values = np.concatenate(first).view(np.int64) if first else np.zeros(0, np.int64)
            numbers = [pa.array(list(map(f, found)), kind) for f, kind in ((_node, pa.int64()), (fingerprint_of, pa.int64()), (len, pa.int32()))]
            fine = [sketch(x).tobytes() for x in found]
            sketches = [pa.array(fine, pa.binary()), pa.array(list(map(coarse, fine)), pa.binary())]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *numbers, *sketches, lists], ["doc_id", "text_hash", "node", "fp", "size", "sketch", "coarse", "prefix"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).select("doc_id", text_hash("text"), "text")
    return in_batches(rows, batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, node long, fp long, size int, sketch binary, coarse binary, prefix array<long>")


def text_hash(text: str | Column) -> Column:
    return F.xxhash64(text_or_empty(text)).alias("text_hash")


def buckets(found: DataFrame) -> DataFrame:
    """(token, node, size, place): the members of all buckets with two nodes or more."""
    rows = found.select("node", "size", F.posexplode("prefix").alias("place", "token"))
    # size and place as one number make the shuffle smaller
    rows = rows.select("token", "node", (F.col("size") * F.lit(1 << 31) + F.col("place")).alias("packed"))
    placed = rows.repartition("token").sortWithinPartitions("token", "node")

    def several(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # only the last row stays from batch to batch, however large a bucket is
        held: list[np.ndarray] | None = None
        shown = False
        for batch in it:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
            token, node, packed = columns
            fresh = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))
            token, node, packed = token[fresh], node[fresh], packed[fresh]
            same = token[1:] == token[:-1]
            keep = np.append(same, False) | np.append(False, same)
            last = bool(keep[-1]) or shown and len(token) == 1
            if held is not None and shown:
                keep[0] = False  # it went out with the batch before
            held, shown = [token[-1:], node[-1:], packed[-1:]], last
            out = [token[keep], node[keep], (packed[keep] >> 31).astype(np.int32), (packed[keep] & 0x7FFFFFFF).astype(np.int32)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, out)), ["token", "node", "size", "place"])

    return placed.mapInArrow(several, "token long, node long, size int, place int")


def _room(size_a, place_a, size_b, place_b, least: float):
    """Whether two sets that share a shingle at these places can be similar; columns or arrays."""
    need = least / (1 + least) * (size_a + size_b) - _EPS
    return (size_a >= least * size_b - _EPS) & (size_b >= least * size_a - _EPS) & (size_a - place_a >= need) & (size_b - place_b >= need)


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def star_pairs(members: DataFrame, least: float) -> DataFrame:
    """(u, v): every member of a bucket with one of them, if they can be similar and are not joined yet."""
    order = F.xxhash64("node", F.pmod("token", F.lit(CENTRES)))
    middle = members.groupBy("token").agg(F.min_by(F.struct("node", "size", "place", "label"), order).alias("m"))
    pairs = members.join(middle, "token").where((F.col("label") != F.col("m.label")))
    pairs = pairs.where(_room(F.col("size"), F.col("place"), F.col("m.size"), F.col("m.place"), least))
    return pairs.select(*_pairs(F.col("node"), F.col("m.node"))).distinct()


def all_pairs(members: DataFrame, sketches: DataFrame, least: float, block: int = BLOCK, few: int | None = None) -> DataFrame:
    """(u, v): all pairs of a bucket that can be similar, by their sketches (node, coarse) too, and are not joined yet.

    With ``few`` only so many for each two labels of a block; then a row (token, null) names every bucket of which pairs
    were left out.
    """
    sizes = members.groupBy("token").agg(F.count("*").alias("n"), F.min("label").alias("a"), F.max("label").alias("b"))
    open_ = sizes.where("a <> b").select("token", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    rows = members.join(open_, "token").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.join(sketches, "node")
    rows = rows.select("token", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "node", "size", "place", "label", "coarse")
    placed = rows.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high")

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[list[np.ndarray]] = []
        for batch in itertools.chain(it, [None]):
            if batch is not None and batch.num_rows:
                rest.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if not rest or batch is not None and (not batch.num_rows or all(rest[0][k][0] == rest[-1][k][-1] for k in range(3))):
                continue
            columns = [np.concatenate(c) for c in zip(*rest)]
            new = np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)
            ends = [*(np.flatnonzero(new) + 1), *([len(columns[0])] if batch is None else [])]
            start, found, left = 0, [], []
            for end in ends:
                pairs, more = _block_pairs([c[start:end] for c in columns], least, few)
                found.append(pairs)
                left += [columns[0][start]] if more else []
                start = end
            rest = [[c[start:] for c in columns]] if start < len(columns[0]) else []
            out, left = np.unique(np.concatenate(found), axis=0), np.unique(np.array(left, np.int64))
            v = pa.concat_arrays([pa.array(out[:, 1]), pa.nulls(len(left), pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([out[:, 0], left])), v], ["u", "v"])

    return placed.mapInArrow(compare, "u long, v long").distinct()


def _block_pairs(columns: list[np.ndarray], least: float, few: int | None) -> tuple[np.ndarray, bool]:
    """Pairs of a block, and whether some were left out."""
    _, low, high, mine, node, size, place, label, sketches = columns
    a, b = np.flatnonzero(mine == low[0]), np.flatnonzero(mine == high[0])
    found, tables = [np.zeros((0, 2), np.int64)], _Sketches(sketches)
    groups = np.unique(label, return_inverse=True)[1]
    seen, more = np.zeros(0, np.int64), False
    for start in range(0, len(a), 256):
        i = a[start : start + 256, None]
        can = (label[i] != label[b]) & _room(size[i], place[i], size[b], place[b], least)
        if low[0] == high[0]:
            can &= node[i] < node[b]
        x, y = np.nonzero(can)
        x, y = i[x, 0], b[y]
        near = tables.differ(x, y) <= _apart(size[x].astype(np.int64), size[y], least)
        x, y = x[near], y[near]
        if few is not None:  # the first so many of each two labels, over all of the block
            both = np.minimum(groups[x], groups[y]) * (len(groups) + 1) + np.maximum(groups[x], groups[y])
            keep = _nth(np.concatenate([seen, both]))[len(seen) :] < few
            seen, more = np.concatenate([seen, both[keep]]), more or not keep.all()
            x, y = x[keep], y[keep]
        x, y = node[x], node[y]
        found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
    return np.concatenate(found), more


def _nth(values: np.ndarray) -> np.ndarray:
    """For each entry, how many equal ones stand before it."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))
    return out


class _Sketches:
    """The sketches of a block in tables by their length."""

    def __init__(self, packed: np.ndarray):
        self.words = np.fromiter(map(len, packed), np.int64, len(packed)) // 8 - 1
        self.row, self.tables = np.zeros(len(packed), np.int64), {}
        for n in np.unique(self.words).tolist():
            which = np.flatnonzero(self.words == n)
            self.row[which] = np.arange(len(which))
            self.tables[n] = np.frombuffer(b"".join(packed[which].tolist()), "<u8").reshape(-1, n + 1)[:, 1:]

    def differ(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """In how many classes the sketches ``x`` and ``y`` differ, pair by pair."""
        out = np.zeros(len(x), np.int64)
        shape = self.words[x] * (1 << 32) + self.words[y]
        for key in np.unique(shape).tolist():
            m, n = key >> 32, key & 0xFFFFFFFF
            pairs = np.flatnonzero(shape == key)
            for at in range(0, len(pairs), max(1, (1 << 20) // max(m, n))):
                part = pairs[at : at + max(1, (1 << 20) // max(m, n))]
                left, right = (folded(self.tables[k][self.row[i[part]]], min(m, n)) for k, i in ((m, x), (n, y)))
                out[part] = np.bitwise_count(left ^ right).sum(axis=1)
        return out


def whole_sets(docs: DataFrame, found: DataFrame, nodes: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(node, hashes): the sets of ``nodes`` (node), read again from the texts."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sets = [shingles(x, size) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(list(map(_node, sets)), pa.int64()), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())], ["node", "hashes"])

    name = fresh("id")
    ids = written(found.select("doc_id", "node").join(nodes, "node").groupBy("node").agg(F.min("doc_id").alias(name)).select(name).distinct(), "set-ids")
    rows = docs.join(broadcast_if_small(ids), F.col(id_col).eqNullSafe(F.col(name)), "left_semi").select(text_or_empty(text_col).alias("text"))
    return in_batches(rows, batches, "node long, hashes binary").join(nodes, "node", "left_semi").groupBy("node").agg(F.first("hashes").alias("hashes"))


def _where(pairs: DataFrame, facts: DataFrame, test, kind: str) -> DataFrame:
    """The pairs (u, v) whose ``facts`` (node, fact), as arrays of ``kind``, pass ``test``."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            keep = [bool(test(*(np.frombuffer(x.as_buffer(), kind) for x in both))) for both in zip(batch.column(2), batch.column(3))]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    left, right = (facts.select(F.col("node").alias(n), F.col("fact").alias(f"of_{n}")) for n in "uv")
    return in_batches(pairs.join(left, "u").join(right, "v").select("u", "v", "of_u", "of_v"), batches, "u long, v long").distinct()


def _similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common >= least * (len(both) - common) - _EPS


def link_components(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, size: int, least: float, block: int = BLOCK, first: DataFrame | None = None) -> DataFrame:
    """(node, component) for every node that is similar to another; ``first`` (u, v) are pairs to try with the first ones."""
    members = written(buckets(found), "buckets")
    sketches = written(found.groupBy("node").agg(F.first("sketch").alias("fact"), F.first("coarse").alias("coarse")), "sketches")
    fine, coarse_ones = sketches.select("node", "fact"), sketches.select("node", "coarse")
    kept = [members, sketches]

    def may_be(pairs: DataFrame) -> DataFrame:
        return _where(pairs, fine, lambda a, b: may_be_similar(a, b, least), "<u8")

    tried = joined = None
    sets: list[DataFrame] = []  # the whole sets read so far, each once
    for turn in ("star", "few", "all"):
        labelled = members.withColumn("label", F.col("node"))
        if joined is not None:  # what links join already is not compared again
            labelled = members.join(joined, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
        if turn == "star":
            pairs = star_pairs(labelled, least)
            near = may_be(pairs if first is None else pairs.union(first).distinct())
        elif turn == "few":
            tested = written(all_pairs(labelled, coarse_ones, least, block, FEW), "tested")
            kept.append(tested)
            near = may_be(tested.where("v is not null"))
        else:  # buckets of which no pair was left out have been tried in full
            left_out = broadcast_if_small(tested.where("v is null").select(F.col("u").alias("token")).distinct())
            near = may_be(all_pairs(labelled.join(left_out, "token", "left_semi"), coarse_ones, least, block))
        near = written(near if tried is None else near.join(tried, ["u", "v"], "left_anti"), "near")
        nodes = near.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        for known in sets:
            nodes = nodes.join(known, "node", "left_anti")
        sets.append(written(whole_sets(docs, found, nodes, id_col, text_col, size), "sets"))
        facts = reduce(DataFrame.union, sets).withColumnRenamed("hashes", "fact")
        new = written(_where(near, facts, lambda a, b: _similar(a, b, least), "<u8"), "links")
        tried = near if tried is None else tried.union(near)
        kept += [near, new]
        # what earlier links have joined goes on as edges to the smallest node of each part
        before, joined = joined, components(new if joined is None else new.union(joined.select(F.col("node").alias("u"), F.col("component").alias("v"))))
        if before is not None:
            drop_written(before)
    for df in kept + sets:
        drop_written(df)
    return joined
