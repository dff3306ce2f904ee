"""Merkle manifests against a plain version of the whole computation."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelforge.llm import op11_merkle
from panelforge.llm.common import bucket

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos int, leaf string, value int, total int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def ascii_lower(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """The last node, and for each first node the runs and places on its way."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, way in enumerate(ways):
            way.append((nodes[at[i] // 16 * 16 :][:16], at[i] % 16))
            at[i] //= 16
        nodes = [h("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], ways


def plain(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    sources = defaultdict(list)
    for r in rows:
        low = zlib.crc32(b"null" if r[0] is None else str(r[0]).encode()) % 5 == 0
        sources[r[1]].append((r[0], plain_leaf(r), plain_leaf((*r[:4], ascii_lower(r[4]))) if low else plain_leaf(r)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        leaves = sorted(sources[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees.append((leaves, *climb([x[1] for x in leaves])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (leaves, subroot, ways), top in zip(trees, tops):
        for (doc_id, leaf, changed), way in zip(leaves, ways):
            proof, node = "", changed
            for run, k in way + top:
                proof += "".join(run[:k] + run[k + 1 :])
                node = h("".join(run[:k] + [node] + run[k + 1 :]))
            out.append((doc_id, leaf, subroot, root, h(proof), node, node == root))
    return sorted(map(repr, out))


def found(spark, rows, levels):
    padded = [(*r, "a", 1, "b", 2, 3) for r in rows]  # columns named like those inside
    docs = spark.createDataFrame(padded, SCHEMA).repartition(3)
    low = F.when(bucket("doc_id", 5) == 0, F.translate("text", op11_merkle.UPPER, op11_merkle.LOWER)).otherwise(F.col("text"))
    made = op11_merkle.manifest(docs, changed={"text": low}, local_levels=levels)
    columns = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(repr(tuple(r)) for r in op11_merkle.proofs(made).select(*columns).collect())


def hard_rows():
    rng = random.Random(5)
    text = lambda: rng.choice([None, "", "Ä Capital É", "plain", "A" * 50_000, "日本 Ω X"])
    rows = [(i, "hot", rng.choice(["en", None, ""]), rng.choice([None, 0, 7]), text()) for i in range(300)]
    rows += [(i, rng.choice([None, "", "b", "B", "ß", "zz"]), "de", i, text()) for i in range(300, 340)]
    rows += [(3, "hot", "en", 1, "Other Text"), (None, "hot", "en", 1, "No Id"), (None, None, None, None, None), (2**60 + 1, "hot", "x", 1, "Big")]
    return rows + [(400, "copies", "en", 2, "Same")] * 40 + [(-7, f"s{i}", "en", 1, "Q") for i in range(20)]


@pytest.mark.parametrize("levels", [1, 3])
def test_proofs_are_the_plain_ones(spark, levels):
    rows = hard_rows()
    assert found(spark, rows, levels) == plain(rows)


def test_one_row_one_source_and_none(spark):
    for rows in ([(1, "a", "en", 1, "One")], [(i, "a", "en", 1, "Row") for i in range(17)]):
        assert found(spark, rows, 1) == plain(rows)
    assert found(spark, [], 2) == []


def test_only_changed_rows_fail(spark, sf_dir):
    rows = op11_merkle.query(spark, sf_dir).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        tampered = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and ascii_lower(docs[r["doc_id"]]) != docs[r["doc_id"]]
        assert r["verified"] == (not tampered)
    assert 0 < sum(not r["verified"] for r in rows) < len(rows) / 2
