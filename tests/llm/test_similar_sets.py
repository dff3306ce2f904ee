"""The similarity join of the pipeline's near_dedup stage against all pairs compared."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from panelforge.llm import op10_simhash, similar_sets


def words_brute(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))}


def kept_brute(rows):
    sets = [words_brute(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return sorted(min(rows[k][0] for k in range(len(rows)) if root[k] == r) for r in set(root))


def edited(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"edit{rng.randrange(10**6)}"
    return out


def sample_rows():
    rng = random.Random(3)
    rows = [(0, "a short text"), (1, "A  short text"), (2, None), (3, " "), (4, "")]
    line = [f"line{k}" for k in range(12)]
    for base in range(30):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(30, 300))]
        for copy in range(5):
            body = [*line, *edited(rng, words, rng.randrange(len(words) // 20 + 1))]
            rows.append((len(rows), " ".join(body)))
    words = [f"g{k}" for k in range(150)]
    rows += [(len(rows) + k, " ".join(edited(rng, words, rng.randrange(4)))) for k in range(60)]
    return rows


@pytest.mark.parametrize("block", [similar_sets.BLOCK, 4])
def test_brute_force(spark, block):
    rows = sample_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(r["doc_id"] for r in op10_simhash.keep_representatives(docs, block=block).collect())
    assert found == kept_brute(rows) and len(found) < len(rows) - 60


def test_stage_drops_five_word_near_copies(spark):
    words = [f"w{k}" for k in range(200)]
    copy = [*words[:100], "changed", *words[101:150], "other", *words[151:]]
    rows = [(1, " ".join(words), "en"), (2, " ".join(copy), "en"), (3, " ".join(reversed(words)), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3]


@pytest.mark.parametrize("with_ids", [True, False])
def test_one_row_of_each_group_with_repeated_rows_and_null_ids(spark, with_ids):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(60)]
    base, near = " ".join(words), " ".join([*words[:30], "changed", *words[31:]])
    rows = [(1, base), (1, base), (1, base), (2, near), (None, base), (None, near), (7, "alone here"), (7, "alone here"), (7, "Alone  here")]
    rows += [(8, "other text of that id"), (8, "a second text under one id, quite another"), (None, None), (None, ""), (None, "no id and alone"), (None, "no id and alone")]
    rows = [(i if with_ids else None, t) for i, t in rows]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, "x", k) for k, r in enumerate(rows)], "doc_id long, text string, node string, fp long").repartition(4)
    found = op10_simhash.keep_representatives(docs)
    assert found.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in found.collect()]
    # groups: base and near; alone here; the two of id 8; no text; no id and alone
    kinds = Counter("base" if (t or "").startswith("w0") else (t or "").lower().replace("  ", " ") for _, t in found)
    assert set(kinds.values()) == {1} and len(kinds) == 6
    if with_ids:
        assert (1, base) in found and any(i == 7 for i, _ in found)


def test_sketch_refuses_no_similar_pair():
    rng = np.random.default_rng(9)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        a = np.unique(pool[:n])
        b = np.unique(np.concatenate([pool[: int(rng.integers(0, n + 1))], pool[n : n + int(rng.integers(1, n + 1))]]))
        common = len(np.intersect1d(a, b))
        similar = common >= 0.8 * (len(a) + len(b) - common)
        may = similar_sets.may_be_similar(similar_sets.sketch(a), similar_sets.sketch(b), 0.8)
        assert may or not similar
        table = similar_sets._Sketches(np.array([similar_sets.sketch(x).tobytes() for x in (a, b)] + [b""], object)[:2])
        assert bool(table.differ(np.array([0]), np.array([1]))[0] <= similar_sets._apart(len(a), len(b), 0.8)) == may


def test_fingerprints_alone_find_some_pairs(spark):
    """Pairs of the first turn are those of near fingerprints; the similarity confirms or refuses them."""
    rows = sample_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = similar_sets.prints(docs, "doc_id", "text", 5, 0.8)
    prints = {r["node"]: r["fp"] for r in found.collect()}
    pairs = {(r["u"], r["v"]) for r in op10_simhash.near_pairs(found).collect()}
    assert pairs and all((prints[u] ^ prints[v]).bit_count() <= 3 for u, v in pairs)
