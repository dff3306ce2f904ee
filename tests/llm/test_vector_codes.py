"""Vector codes against a plain version of the whole computation, and the candidate search against all distances."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from panelforge.llm import op13_vector_codes as op13

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string, id int"


def plain(rows, parts=8, entries=16, rounds=6):
    """(id, code, error, label_error, digest) of rows (id, vector, label) with vectors of one length."""
    fine = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, [math.floor(4096 * x) if abs(x) < 2**53 else 4096 * int(x) for x in v], label) for i, v, label in rows if fine(v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    assign = lambda v: [min((far(cut(v, p), e), k) for k, e in enumerate(books[p])) for p in range(parts)]
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v, _ in kept:
            for p, (_, k) in enumerate(assign(v)):
                groups[p, k].append(cut(v, p))
        books = [[[sum(c) // len(c) for c in zip(*groups[p, k])] if (p, k) in groups else e for k, e in enumerate(book)] for p, book in enumerate(books)]
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded = [(i, label, assign(v)) for i, v, label in kept]
    by_label = defaultdict(int)
    for _, label, found in coded:
        by_label[label] += sum(d for d, _ in found)
    long = lambda n: n if n < 2**63 else None
    total = {label: None if any(long(sum(d for d, _ in f)) is None for _, x, f in coded if x == label) else long(n) for label, n in by_label.items()}
    return sorted(repr((i, "".join(f"{k:02x}" for _, k in f), long(sum(d for d, _ in f)), total[label], sha)) for i, label, f in coded)


def found(spark, rows, **settings):
    docs = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA).repartition(3)
    books, codes = op13.compress(docs, **settings)
    return sorted(repr((r["id"], bytes(r["code"]).hex(), r["error"], r["label_error"], books.sha256())) for r in codes.collect())


def vectors(n, length=16, seed=1, span=2.0):
    rng = random.Random(seed)
    return [(i, [rng.choice([rng.uniform(-span, span), 0.0, 0.5]) for _ in range(length)], rng.choice([0, 1, 2, None])) for i in range(n)]


def test_codes_are_the_plain_ones(spark):
    rows = vectors(120)
    rows += [(500, None, 1), (501, [None] + [0.0] * 15, 1), (502, [float("nan")] * 16, 2), (503, [float("inf")] + [0.0] * 15, None), (-3, [-0.0001] * 16, 9)]
    rows += [(7, [1.0] * 16, 1)] * 20 + [(None, [0.25] * 16, 1)]
    assert found(spark, rows) == plain(rows)


def test_components_beyond_64_bits(spark):
    rows = vectors(40, seed=2) + [(3, [1e30] * 16, 1), (100, [3e38, -3e38] * 8, 5), (101, [1e6] * 16, 6), (102, [1e30] * 15 + [0.0], 1)]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [1, 5, 16])
def test_fewer_vectors_than_entries(spark, n):
    rows = vectors(n, seed=n)
    assert found(spark, rows) == plain(rows)


def test_other_lengths_and_none(spark):
    rows = vectors(30) + [(90, [1.0] * 24, 1), (91, [], 1), (92, [1.0] * 5, None)]
    docs = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA)
    codes = {r["id"]: r for r in op13.compress(docs)[1].collect()}
    assert len(codes) == 33 and [codes[i]["code"] for i in (90, 91, 92)] == [None] * 3
    alone = op13.compress(docs.where("vec_id < 30"))[1].collect()
    assert all(codes[r["id"]]["code"] == r["code"] for r in alone)
    books, none = op13.compress(docs.where("false"))
    assert books is None and none.count() == 0
    assert op13.compress(docs.where("vec_id = 92"))[1].collect()[0]["code"] is None


@pytest.mark.parametrize("n", [1, 2, 16, 64, 150])
def test_candidates_hold_the_nearest(n):
    rng = np.random.default_rng(n)
    entries = rng.integers(-50, 50, (n, 5))
    entries[n // 2] = entries[0]  # equal entries: the lower index
    book = op13.PartCodebook(entries.tolist(), 1 << 28)
    x = rng.integers(-60, 60, (500, 5))
    at, far = book.assign(x)
    distances = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (at == distances.argmin(axis=1)).all() and (far == distances.min(axis=1)).all()
    slices = op13.Slices(entries[:64])
    radius = np.full(500, 9)
    masks = slices.candidates(x, radius)
    inside = (np.abs(x[:, None, :] - entries[None, :64]) <= 9).all(axis=2)
    assert all(int(m) == sum(1 << k for k in np.flatnonzero(row)) for m, row in zip(masks, inside))


def test_decode(spark):
    rows = vectors(20, seed=4)
    docs = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], SCHEMA)
    books, codes = op13.compress(docs)
    for r in op13.decode(codes, books).collect():
        numbers = [v for p, k in enumerate(bytes(r["code"])) for v in books.entries[p][k]]
        assert r["vector"] == [v / 4096 for v in numbers]
