"""Vector code compression: each vector cut into parts, each part replaced by the index of its nearest codebook entry.

All arithmetic is in whole numbers (components times ``scale``, floored), so codes and codebooks do not depend on
the order of rows or on the number of tasks. The nearest entry is found by slices and bitmasks: for each dimension
the entries' coordinates are sorted and carry, for each prefix, the mask of the entries in it. The distance to one
entry is the initial radius; two binary searches in a dimension give the range within that radius and two prefix masks
its entries; the masks of all dimensions, ANDed, are the candidates. The nearest entry is always one of them, since no
coordinate can be farther away than the whole vector; only candidates are measured.

How it runs: each round is one scan of the vectors in Arrow batches; a task hands on one row for each entry with
the count and sums of its parts, and these are added up in a grouping. Codebooks (entries x length numbers) are all that
the driver holds and ships. The codes are written once; errors are summed by label in partial aggregates and joined back.

Defined results: rows whose vector is null or holds a null or non-finite component are left out. Ids that are
null stand last when the first entries are chosen, equal ids stand in the order of their vectors; repeated rows count
each. With fewer vectors than entries the codebooks are smaller. The length of vectors is the most frequent one (of
several, the greatest) among those that divide into the parts; a kept vector of another length has no code (null) and
takes no part in anything. Components of any size are exact (Python integers take over where 64 bits would not do); an
error that a long cannot hold is null, and so is the error of its label. An empty table gives no rows. Other columns never
take part, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, in_batches, table, written

NAME = "op13_vector_codes"
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Entries in one mask.
_MASK = 64
#: Rows that are coded together.
_TOGETHER = 8192
#: Bits of a whole number in one long of a sum; larger sums take several.
_LIMB = 60


def kept(vector: Column) -> Column:
    """Whether the vector and all its components are there and finite."""
    x = vector.cast("array<double>")
    return F.coalesce(~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(False))


def whole(values: np.ndarray, scale: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * values) row by row, and which rows stay within ``limit``; the others are zero there."""
    scaled = np.floor(values * float(scale)) if values.size else values
    fits = (np.abs(scaled) < limit).all(axis=1)
    return np.where(fits[:, None], scaled, 0).astype(np.int64), fits


def whole_exact(row: np.ndarray, scale: int) -> list[int]:
    """floor(scale * x) of components of any size."""
    return [int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in row.tolist()]


class Slices:
    """Up to 64 entries, their coordinates sorted in each dimension with a mask of entries for each prefix."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        order = np.argsort(entries, axis=0, kind="stable")
        self.first = order[:, 0]
        self.sorted = np.ascontiguousarray(np.take_along_axis(entries, order, axis=0).T)
        prefixes = np.bitwise_or.accumulate(np.uint64(1) << order.astype(np.uint64), axis=0)
        self.prefixes = np.ascontiguousarray(np.vstack([np.zeros((1, entries.shape[1]), np.uint64), prefixes]).T)

    def candidates(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The mask of entries within ``radius`` of each row in every dimension."""
        found = np.full(len(x), np.uint64(0xFFFFFFFFFFFFFFFF))
        for column, at, masks in zip(x.T, self.sorted, self.prefixes):
            found &= masks[np.searchsorted(at, column + radius, "right")] & ~masks[np.searchsorted(at, column - radius, "left")]
        return found

    def start(self, x: np.ndarray) -> np.ndarray:
        """Squared distance to the entry that stands next in the first dimension."""
        near = self.first[np.minimum(np.searchsorted(self.sorted[0], x[:, 0]), len(self.first) - 1)]
        return ((x - self.entries[near]) ** 2).sum(axis=1)


def _nearest(x: np.ndarray, blocks: list[tuple[int, Slices]]) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each row's nearest entry; of equally near ones the lowest index."""
    best = blocks[0][1].start(x)
    at = np.full(len(x), -1)
    for base, slices in blocks:
        radius = np.sqrt(best.astype(np.float64)).astype(np.int64) + 1
        masks = slices.candidates(x, radius)
        for k in range(len(slices.entries)):
            rows = np.flatnonzero(masks >> np.uint64(k) & np.uint64(1))
            far = ((x[rows] - slices.entries[k]) ** 2).sum(axis=1)
            better = (far < best[rows]) | (far == best[rows]) & (at[rows] < 0)
            best[rows[better]], at[rows[better]] = far[better], base + k
    return at, best


class PartCodebook:
    """The entries of one part position, as rows of Python integers of any size."""

    def __init__(self, entries: list[list[int]], limit: int):
        self.entries, self.limit = entries, limit
        small = [k for k, e in enumerate(entries) if all(abs(v) < limit for v in e)]
        self.small = np.array(small, np.int64)
        self.large = [k for k in range(len(entries)) if k not in set(small)]
        table_ = np.array([entries[k] for k in small], np.int64)
        self.blocks = [(b, Slices(table_[b : b + _MASK])) for b in range(0, len(small), _MASK)]
        #: Squared distance below which no large entry can be from a row within the limit.
        self.clear = min((max(0, max(map(abs, entries[k])) - limit) ** 2 for k in self.large), default=None)

    def exact(self, row: list[int]) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(row, e)), k) for k, e in enumerate(self.entries))[::-1]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of rows within the limit; both -1 where a large entry may be nearest."""
        if not len(x) or not self.blocks:
            return np.full(len(x), -1), np.full(len(x), -1)
        at, far = _nearest(x, self.blocks)
        at = self.small[at]
        if self.clear is not None:
            unsure = far >= min(self.clear, 2**63 - 1)
            at[unsure] = far[unsure] = -1
        return at, far


@dataclass
class Codebooks:
    """``entries[part][entry]``: whole numbers."""

    entries: list[list[list[int]]]
    length: int
    scale: int = SCALE

    @property
    def parts(self) -> int:
        return len(self.entries)

    def sha256(self) -> str:
        """Digest of all numbers by part, entry and position."""
        return hashlib.sha256(",".join(str(v) for part in self.entries for e in part for v in e).encode()).hexdigest()


class _Coder:
    """Codes batches of vectors in a task."""

    def __init__(self, books: Codebooks):
        self.books, self.parts = books, books.parts
        self.width = books.length // books.parts
        self.limit = int(math.sqrt(2**62 / books.length) / 2)
        self.of_part = [PartCodebook(e, self.limit) for e in books.entries]

    def code(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, tuple[list[int], list[int]]]]:
        """Codes (rows x parts), squared distances, components, and what is not in these: by row its components and
        squared distances as Python integers."""
        x, fits = whole(values, self.books.scale, self.limit)
        codes, far = np.full((len(x), self.parts), -1), np.full((len(x), self.parts), -1)
        rows = np.flatnonzero(fits)
        for p, book in enumerate(self.of_part):
            codes[rows, p], far[rows, p] = book.assign(x[rows, p * self.width : (p + 1) * self.width])
        apart = {}
        for i in np.flatnonzero((codes < 0).any(axis=1)).tolist():
            row = whole_exact(values[i], self.books.scale)
            found = [book.exact(row[p * self.width : (p + 1) * self.width]) for p, book in enumerate(self.of_part)]
            codes[i], apart[i] = [k for k, _ in found], (row, [d for _, d in found])
        return codes, far, x, apart


def _together(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in it:
        held.append(batch)
        size += batch.num_rows
        if size >= _TOGETHER:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def _vectors(column: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are kept, which of them have ``length``, and these vectors."""
    sizes = np.asarray(pc.list_value_length(column).fill_null(0))
    there = np.asarray(column.is_valid())
    values = column.flatten()
    bad = np.concatenate([[0], np.cumsum(~np.asarray(pc.is_finite(values).fill_null(False)))])
    ends = np.cumsum(sizes)
    is_kept = there & (bad[ends] == bad[ends - sizes])
    fitting = is_kept & (sizes == length)
    found = column.filter(pa.array(fitting)).flatten().to_numpy(zero_copy_only=False)
    return is_kept, fitting, found.reshape(-1, length)


def _limbs(value: int, n: int) -> list[int]:
    return [value >> _LIMB * k & (1 << _LIMB) - 1 if k < n - 1 else value >> _LIMB * k for k in range(n)]


def _task_sums(books: Codebooks):
    """For each part and entry the count and the sums of a task's parts, in as many limbs as they need."""

    def sums(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder(books)
        n_entries, width = len(books.entries[0]), coder.width
        counts = np.zeros((coder.parts, n_entries), np.int64)
        total = np.zeros((coder.parts, n_entries, width), object)
        for batch in _together(it):
            codes, _, x, apart = coder.code(_vectors(batch.column(0), books.length)[2])
            inside = np.ones(len(x), bool)
            for i, (row, _) in apart.items():
                inside[i] = False
                for p, k in enumerate(codes[i].tolist()):
                    counts[p, k] += 1
                    total[p, k] += np.array(row[p * width : (p + 1) * width], object)
            for p in range(coder.parts):
                k = codes[inside, p]
                counts[p] += np.bincount(k, minlength=n_entries)
                part = np.zeros((n_entries, width), np.int64)
                np.add.at(part, k, x[inside, p * width : (p + 1) * width])
                total[p] += part
        rows = []
        for p, k in zip(*np.nonzero(counts)):
            values = [int(v) for v in total[p, k]]
            n = max(1, *(v.bit_length() // _LIMB + 1 for v in values))
            split = [_limbs(v, n) for v in values]
            rows += [(int(p), int(k), j, int(counts[p, k]) if j == 0 else 0, [s[j] for s in split]) for j in range(n)]
        names = ["part", "entry", "limb", "n", "sums"]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names)

    return sums


def _moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floored mean of the parts that are nearest to it."""
    width = books.length // books.parts
    rows = in_batches(vectors.select("vector"), _task_sums(books), "part int, entry int, limb int, n long, sums array<long>")
    total = rows.groupBy("part", "entry", "limb").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)))
    counts: dict[tuple[int, int], int] = {}
    sums: dict[tuple[int, int], list[int]] = {}
    for r in total.collect():  # at most parts x entries rows for each limb
        key = (r["part"], r["entry"])
        counts[key] = counts.get(key, 0) + r["n"]
        sums[key] = [a + (int(r[f"s{j}"]) << _LIMB * r["limb"]) for j, a in enumerate(sums.get(key, [0] * width))]
    entries = [[[s // counts[p, k] for s in sums[p, k]] if (p, k) in counts else e for k, e in enumerate(part)] for p, part in enumerate(books.entries)]
    return Codebooks(entries, books.length, books.scale)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of the rows (id, vector); None if no vector divides into the parts."""
    usable = vectors.where(kept(F.col("vector")))
    size = F.size("vector")
    most = usable.where((size > 0) & (size % parts == 0)).groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if most is None:
        return None
    length = most["size"]
    first = usable.where(size == length).orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries)
    rows = [whole_exact(np.array(r["vector"], float), scale) for r in first.select("vector").collect()]
    width = length // parts
    books = Codebooks([[row[p * width : (p + 1) * width] for row in rows] for p in range(parts)], length, scale)
    for _ in range(rounds):
        books = _moved(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, code binary of one byte for each part, error) of the kept rows (id, label, vector)."""

    def codes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder(books)
        for batch in _together(it):
            is_kept, fitting, values = _vectors(batch.column("vector"), books.length)
            found, far, _, apart = coder.code(values)
            errors = far.sum(axis=1).astype(object)
            for i, (_, distances) in apart.items():
                errors[i] = sum(distances) if sum(distances) < 2**63 else None
            where = np.flatnonzero(fitting)
            code, error = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            code[where] = [row.tobytes() for row in found.astype(np.uint8)]
            error[where] = errors
            out = [pa.array(code, pa.binary()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *out], ["id", "label", "code", "error"]).filter(pa.array(is_kept))

    if len(books.entries[0]) > 256:
        raise ValueError("a code has one byte for each part, so at most 256 entries")
    rows = vectors.select("id", "label", "vector")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return in_batches(rows, codes, f"id {kinds['id']}, label {kinds['label']}, code binary, error long")


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes``, written once, with the sum of errors over equal labels (null labels together)."""
    codes = written(codes, "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    complete = F.count("error") == F.count("code")
    by_label = codes.groupBy(F.col("label").alias("of_label")).agg(F.when(complete, total).try_cast("long").alias("label_error"))
    by_label = written(by_label, "label-errors")
    out = codes.join(broadcast_if_small(by_label), F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")
    return out


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[Codebooks | None, DataFrame]:
    """Codebooks trained on all of ``df``, and (id, label, code, error, label_error) of its kept rows."""
    vectors = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    books = train(vectors.select("id", "vector"), parts, entries, rounds, scale)
    if books is None:
        none = vectors.where(kept(F.col("vector"))).select("id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return None, none.withColumn("label_error", F.lit(None).cast("long"))
    return books, with_label_errors(encode(vectors, books))


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with ``vector``, the components that its code stands for."""
    numbers = F.array(*(F.array(*(F.array(*(F.lit(v / books.scale) for v in e)) for e in part)) for part in books.entries))
    places = F.sequence(F.lit(0), F.lit(books.parts - 1))
    entry = lambda p: F.conv(F.hex(F.substring("code", p + 1, 1)), 16, 10).cast("int")
    return codes.withColumn("vector", F.when(F.col("code").isNotNull(), F.flatten(F.transform(places, lambda p: numbers[p][entry(p)]))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    books, codes = compress(table(spark, sf_dir, "embeddings"))
    sha = F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256")
    return codes.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", sha)


def _rounds() -> str:
    return "".join(
        f"""
near{r} AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM (
    SELECT x.vec_id, x.part, e.entry, list_sum(list_transform(list_zip(x.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
    FROM x JOIN book{r} e ON x.part = e.part
  ) GROUP BY vec_id, part
)"""
        + (
            f""",
book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY k) AS v FROM (
      SELECT n.part, n.entry, k, ((sum(x.v[k]) - ((sum(x.v[k]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS mean
      FROM near{r} n JOIN x ON n.vec_id = x.vec_id AND n.part = x.part, range(1, 9) t(k) GROUP BY n.part, n.entry, k
    ) GROUP BY part, entry
  ) m ON b.part = m.part AND b.entry = m.entry
),"""
            if r < ROUNDS
            else ""
        )
        for r in range(ROUNDS + 1)
    )


#: Vectors of 64 components, ids that do not repeat.
ORACLE = f"""
WITH whole AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda v: floor(4096 * v::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda v: coalesce(isfinite(v), false)))
),
x AS MATERIALIZED (SELECT vec_id, part, v[8 * part + 1:8 * part + 8] AS v FROM whole, range(8) p(part)),
book0 AS MATERIALIZED (
  SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, v FROM x WHERE vec_id IN (SELECT vec_id FROM whole ORDER BY vec_id LIMIT 16)
),{_rounds()},
coded AS (
  SELECT n.vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM near{ROUNDS} n GROUP BY n.vec_id
),
sha AS (
  SELECT sha256(string_agg(numbers, ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM (SELECT part, entry, array_to_string(v, ',') AS numbers FROM book{ROUNDS})
)
SELECT c.vec_id, code, error, sum(error) OVER (PARTITION BY w.label)::BIGINT AS label_error, codebooks_sha256
FROM coded c JOIN whole w ON c.vec_id = w.vec_id, sha
"""
