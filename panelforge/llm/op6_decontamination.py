"""Benchmark decontamination by greedy string tiling.

Words are the lower-cased runs between ASCII punctuation and white space. A seed is a run of ``min_match`` (five) words.

1. Items with the same words are one from here on. Their seeds become a table; a seed that several items hold says
   little, so every item goes without its commonest ones, as long as the windows of those left out cover too few of its
   words to make a document contaminated. Tiles lie inside windows of shared seeds, so a contaminated document shares at
   least one of the others. Items that have an instruction in common meet no document by it.
2. One scan of the documents hashes their seeds and passes on those that a bit filter of the item seeds knows; the filter
   is broadcast and has a fixed greatest size, beyond which it only passes on more. Equal texts count once.
3. Seeds passed on are joined with the items' seeds; a pair is a candidate if the windows of the seeds that it shares,
   with those left out, cover enough words. The places of a pair are gathered, which are no more than an item's words.
4. Every candidate pair whose shared windows cover enough words is tiled. The longest match of unmarked words is found by running Karp-Rabin: windows of a
   length are hashed on both sides, the length is searched by halving, and all matches of the greatest length are
   compared word by word and marked, until none of ``min_match`` words is left. A text of one repeated word costs no
   more than another. Marked words are used once, so a passage whose parts were reordered still adds up.

A document is contaminated by an item if tiles cover at least ``threshold`` (0.8) of the item's words.

Defined results: null and empty texts match nothing. Items of fewer than ``min_match`` words are too short to tell
and match nothing. Repeated documents and repeated items give one row for each pair; so do items with equal text.
Ties between equally long matches go to the earlier place in the item, then in the document. Very long texts are read
whole. An empty table on either side gives no rows. Other columns never take part, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, fresh, in_batches, table, text_or_empty, written

NAME = "op6_decontamination"
MIN_MATCH = 5
THRESHOLD = 0.8
#: Bits of the broadcast filter: sixteen for each seed of the benchmark, but within these bounds.
FILTER_BITS = (1 << 22, 1 << 27)
_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ODD = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)))
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACES).split()


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``size`` ids, modulo 2**64."""
    n = len(ids) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        out = out * _BASE + ids[k : k + n].astype(np.uint64) + np.uint64(1)
    return out


# ---- greedy string tiling


class _Windows:
    """Karp-Rabin hashes of the windows of any length of a sequence of numbers, modulo 2**64."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        with np.errstate(over="ignore"):
            power, self.inverse = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b)]).astype(np.uint64)) for b in (_BASE, _INVERSE))
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum((ids.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64)])

    def free(self, used: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, hashes) of the windows of ``size`` without a used place."""
        if size > len(used):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        count = np.concatenate([[0], np.cumsum(used)])
        at = np.flatnonzero(count[size:] == count[:-size])
        with np.errstate(over="ignore"):
            return at, (self.sums[at + size] - self.sums[at]) * self.inverse[at]


def tiles(item: list[bytes], doc: list[bytes], min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles as (start in item, start in doc, length)."""
    number = {w: k for k, w in enumerate(dict.fromkeys(item))}
    a = np.array([number[w] for w in item], np.int64)
    b = np.array([number.get(w, -1) for w in doc], np.int64)
    windows_a, windows_b = _Windows(a), _Windows(b)
    used_a, used_b, out = np.zeros(len(a), bool), b < 0, []
    most = min(len(a), len(b))
    while most >= min_match:
        # the greatest length at which some unmarked window is on both sides: if one of a length is, a shorter one is
        low, high = min_match - 1, most
        while low < high:
            size = (low + high + 1) // 2
            if np.isin(windows_b.free(used_b, size)[1], windows_a.free(used_a, size)[1]).any():
                low = size
            else:
                high = size - 1
        if low < min_match:
            break
        _mark(a, b, windows_a.free(used_a, low), windows_b.free(used_b, low), used_a, used_b, low, out)
        most = low - 1
    return out


def _mark(a, b, free_a, free_b, used_a, used_b, size: int, out: list) -> None:
    """Mark the matches of ``size`` words in order of their place in ``a``, then in ``b``."""
    (at_a, hash_a), (at_b, hash_b) = free_a, free_b
    both = np.isin(hash_b, hash_a)
    places = defaultdict(list)
    for h, j in zip(hash_b[both][::-1].tolist(), at_b[both][::-1].tolist()):
        places[h].append(j)  # the first place last
    end = 0
    for h, i in zip(hash_a.tolist(), at_a.tolist()):
        if i < end or h not in places:
            continue
        left, unlike = places[h], []
        while left:
            j = left.pop()
            if used_b[j : j + size].any():
                continue  # never free again
            if not np.array_equal(a[i : i + size], b[j : j + size]):
                unlike.append(j)  # equal hashes of unequal words
                continue
            used_a[i : i + size] = used_b[j : j + size] = True
            out.append((i, j, size))
            end = i + size
            break
        left += unlike[::-1]


def may_match(item: list[bytes], doc: list[bytes], min_match: int, threshold: float) -> bool:
    """Whether the windows that both share cover enough of the item's words; tiles lie inside them."""
    shared = np.isin(seeds_of(item, min_match), seeds_of(doc, min_match))
    edges = np.zeros(len(item) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(shared), 1)
    np.add.at(edges, np.flatnonzero(shared) + min_match, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum()) >= threshold * len(item) - 1e-9


def matched(item: list[bytes], doc: list[bytes], min_match: int = MIN_MATCH, threshold: float = THRESHOLD) -> tuple | None:
    """What ``contaminations`` returns of one pair, from item_words on; nothing if too few words are covered."""
    if not may_match(item, doc, min_match, threshold):
        return None
    found = tiles(item, doc, min_match)
    covered = sum(k for *_, k in found)
    if not found or covered < threshold * len(item):
        return None
    in_doc = [i for i, _, _ in sorted(found, key=lambda t: t[1])]
    span = min(j for _, j, _ in found), max(j + k for _, j, k in found)
    return len(item), covered, covered / len(item), len(found), max(k for *_, k in found), in_doc != sorted(in_doc), *span


# ---- candidates by a join of seeds


def seeds_of(found: list[bytes], min_match: int) -> np.ndarray:
    return rolling(np.fromiter(map(zlib.crc32, found), np.uint32, len(found)), min_match)


def item_tables(benchmark: DataFrame, id_col: str, text_col: str, min_match: int) -> DataFrame:
    """(item_id, item, words, seeds): ``item`` names the words, which are joined by blanks; items too short are left out."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [words(x) for x in batch.column(1).to_pylist()]
            keep = [i for i, x in enumerate(found) if len(x) >= min_match]
            seeds = [seeds_of(found[i], min_match).view(np.int64) for i in keep]
            joined = pa.array([b" ".join(found[i]).decode("utf-8", "replace") for i in keep], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), joined, pa.array(seeds, pa.list_(pa.int64()))], ["item_id", "words", "seeds"])

    rows = benchmark.select(F.col(id_col).alias("item_id"), text_or_empty(text_col).alias("text"))
    found = in_batches(rows, batches, f"item_id {rows.schema['item_id'].dataType.simpleString()}, words string, seeds array<long>")
    return found.withColumn("item", F.md5("words"))


def left_out(commonness: np.ndarray, n_words: int, min_match: int, threshold: float) -> np.ndarray:
    """Places of the seeds to leave out: the commonest of those that several items hold, in falling order (then by
    place), while all windows left out together cover less than ``threshold`` of the words."""
    free, out = math.ceil(threshold * n_words - 1e-9) - 1, []
    covered = np.zeros(n_words, bool)
    for at in np.lexsort((np.arange(len(commonness)), -commonness)).tolist():
        if commonness[at] < 2:
            break
        more = min_match - int(covered[at : at + min_match].sum())
        if more <= free:
            free -= more
            covered[at : at + min_match] = True
            out.append(at)
    return np.array(sorted(out), np.int64)


def needed_seeds(items: DataFrame, min_match: int, threshold: float) -> DataFrame:
    """(item, n_words, seeds array<struct<place, seed>>, left array): the seeds to look for, and the places of the others."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = []
            for item, seeds in zip(*(c.to_pylist() for c in batch.columns)):
                seeds.sort(key=lambda x: x["place"])
                n_words = len(seeds) + min_match - 1
                left = left_out(np.array([x["n"] for x in seeds]), n_words, min_match, threshold).tolist()
                out = set(left)
                found.append((item, n_words, [{"place": x["place"], "seed": x["seed"]} for x in seeds if x["place"] not in out], left))
            kinds = [pa.string(), pa.int32(), pa.list_(pa.struct([("place", pa.int32()), ("seed", pa.int64())])), pa.list_(pa.int32())]
            columns = zip(*found) if found else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["item", "n_words", "seeds", "left"])

    # items with the same words have the same seeds
    rows = items.groupBy("item").agg(F.first("seeds").alias("seeds")).select("item", F.posexplode("seeds").alias("place", "seed"))
    common = rows.groupBy("seed").agg(F.count_distinct("item").alias("n"))
    counted = rows.join(common, "seed").groupBy("item").agg(F.collect_list(F.struct("place", "seed", "n")).alias("seeds"))
    return in_batches(counted, batches, "item string, n_words int, seeds array<struct<place:int,seed:long>>, left array<int>")


def _places(seeds: np.ndarray, bits: int, odd: np.uint64) -> np.ndarray:
    """A bit of a filter for each seed; there is one for each number of ``_ODD``."""
    return (seeds * odd) >> np.uint64(65 - bits.bit_length())


def seed_filter(seeds: DataFrame, bits: tuple[int, int] = FILTER_BITS) -> np.ndarray:
    """The bit filter of (seed, ..) as bytes; a power of two of bits within ``bits``."""
    n = seeds.count()
    size = min(max(1 << (16 * max(n, 1) - 1).bit_length(), bits[0]), bits[1])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            seeds = batch.column(0).to_numpy().view(np.uint64)
            at = np.concatenate([_places(seeds, size, odd) for odd in _ODD])
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(5)).astype(np.int64)), pa.array(np.int64(1) << (at & np.uint64(31)).astype(np.int64))], ["cell", "bit"])

    cells = seeds.select("seed").mapInArrow(batches, "cell long, bit long")
    rows = cells.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most FILTER_BITS[1] / 32 rows
    out = np.zeros(size // 32, "<u4")
    out[rows["cell"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def shared_seeds(docs: DataFrame, text_col: str, bits: np.ndarray, min_match: int) -> DataFrame:
    """(text_key, seed): distinct seeds of every text that pass the filter."""
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in it:
            hits = []
            for text in batch.column(1).to_pylist():
                seeds = seeds_of(words(text), min_match)
                for odd in _ODD:
                    place = _places(seeds, 8 * len(known), odd)
                    seeds = seeds[(known[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]
                hits.append(np.unique(seeds))
            if hits:
                which = np.repeat(np.arange(len(hits)), [len(x) for x in hits])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which)), pa.array(np.concatenate(hits).view(np.int64))], ["text_key", "seed"])

    rows = docs.select(text_key(text_col).alias("text_key"), text_or_empty(text_col).alias("text"))
    return in_batches(rows, batches, "text_key string, seed long").distinct()


def text_key(text_col: str) -> Column:
    return F.md5(text_or_empty(text_col))


def _matched_rows(rows: DataFrame, extra: str, min_match: int, threshold: float) -> DataFrame:
    """The rows (.., item_words, text) whose text the item contaminates, with what ``matched`` says of them."""
    names = [x.split()[0] for x in extra.split(", ")]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [matched(i.encode().split(b" "), words(t), min_match, threshold) for i, t in zip(batch.column("item_text").to_pylist(), batch.column("text").to_pylist())]
            keep = [k for k, x in enumerate(found) if x is not None]
            columns = list(zip(*(found[k] for k in keep))) or [()] * len(names)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
            kept = batch.drop_columns(["item_text", "text"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(c, k) for c, k in zip(columns, kinds))], [*kept.schema.names, *names])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in ("item_text", "text"))
    return in_batches(rows, batches, f"{kept}, {extra}")


_FOUND = "item_words long, matched_words long, coverage double, n_tiles long, longest_tile long, reordered boolean, first_word long, last_word long"


def contaminated_texts(
    docs: DataFrame, benchmark: DataFrame, min_match: int, threshold: float, filter_bits: tuple[int, int], text_col: str, item_col: str, item_text_col: str,
) -> tuple[DataFrame, DataFrame]:
    """(text_key, item, ...) for each contaminated pair of distinct texts, and the items (item_id, item)."""
    items = written(item_tables(benchmark, item_col, item_text_col, min_match), "items")
    needed = written(needed_seeds(items, min_match, threshold), "seeds")
    seeds = needed.select("item", F.inline("seeds"))
    hits = shared_seeds(docs, text_col, seed_filter(seeds, filter_bits), min_match)
    shared = hits.join(seeds, "seed").groupBy("text_key", "item").agg(F.collect_set("place").alias("places"))
    windows = F.transform(F.concat("places", "left"), lambda p: F.sequence(p, p + (min_match - 1)))
    covered = F.size(F.array_distinct(F.flatten(windows)))
    sizes = needed.select("item", "n_words", "left")
    enough = covered >= F.ceil(F.col("n_words") * threshold - 1e-9)
    pairs = written(shared.join(sizes, "item").where(enough).select("text_key", "item"), "pairs")
    texts = docs.select(text_key(text_col).alias("text_key"), text_or_empty(text_col).alias("text"))
    wanted = broadcast_if_small(written(pairs.select("text_key").distinct(), "keys"))
    texts = texts.join(wanted, "text_key", "left_semi").groupBy("text_key").agg(F.first("text").alias("text"))
    sides = items.groupBy("item").agg(F.first("words").alias("item_text"))
    rows = pairs.join(sides, "item").join(texts, "text_key").select("text_key", "item", "item_text", "text")
    return written(_matched_rows(rows, _FOUND, min_match, threshold), "matched"), items.select("item_id", "item")


def contaminations(
    docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD, filter_bits: tuple[int, int] = FILTER_BITS,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row for each contaminated pair: doc_id, item_id, item_words, matched_words, coverage, n_tiles, longest_tile,
    reordered, first_word and last_word (places of the tiles in the document, end exclusive)."""
    found, items = contaminated_texts(docs, benchmark, min_match, threshold, filter_bits, text_col, item_col, item_text_col)
    ids = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("text_key"))
    rows = ids.join(broadcast_if_small(found), "text_key").join(items, "item")
    return rows.select("doc_id", "item_id", *(x.split()[0] for x in _FOUND.split(", ")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD, text_col: str = "text", filter_bits: tuple[int, int] = FILTER_BITS) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    found, _ = contaminated_texts(docs, benchmark, min_match, threshold, filter_bits, text_col, "item_id", "text")
    key = fresh("key")
    dirty = broadcast_if_small(written(found.select(F.col("text_key").alias(key)).distinct(), "dirty"))
    return docs.join(dirty, text_key(text_col) == F.col(key), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
