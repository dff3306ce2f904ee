"""Packing: every id in exactly one piece, windows of their context sizes, and the library's ids for any text."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from panelforge.llm import op12_packing

PIECES = [
    *" \n\t\r\x0b\x1c\x1d\x85\xa0 　", "  ", "\n\n", ". ", ", ", "...", "%%%", "'s", "'ll", "'", "’t", "word", "Word,", "don't", "I'M.", "42", "4.5", "x9", "é", "Straße!", "İ", "ŉ",
    "Ωmega", "ΟΔΟΣ", "日本語", "🙂", "é", "é", "́", "‍", "ß.", "ª", "µ", "²", "½", "Ǆ", "ɐ", "ſ", "<|endoftext|>", "<|endoftext", "<|startoftext|>s", "$5", "#tag", "a|b", "(x)", "-", "_", "\x00", "ﬁ", "٣", "क्ष",
]


def test_encode_is_the_librarys():
    rng = random.Random(12)
    path = op12_packing.default_path()
    bpe, library = op12_packing.WordBpe(path), Tokenizer.from_file(path)
    assert bpe.splits
    texts = ["".join(rng.choice(PIECES) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(0, 12))) for _ in range(5000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0x10000, 0x1F000)])) for _ in range(rng.randrange(1, 30))) for _ in range(2000)]
    for _ in range(2):  # the second time from the cache
        for k in range(0, len(texts), 1000):
            part = texts[k : k + 1000]
            for text, ids in zip(part, bpe.encode(pa.array(part, pa.string())).to_pylist()):
                assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_another_vocabulary_is_encoded_whole():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    bpe = op12_packing.WordBpe(path)
    assert not bpe.splits
    assert bpe.encode(pa.array(["two  words\n", ""])).to_pylist() == [Tokenizer.from_file(path).encode("two  words\n").ids, []]


def whole(rows):
    """Checks all rules; ids by (document, tokens)."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] > 0 and len(r["ids"]) == 4 * r["length"]
        by_sequence[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at & (at - 1) == 0 and len({r["step"] for r in pieces}) == 1
        sizes.append(at)
    out = {}
    for doc, pieces in by_doc.items():
        ids = b""
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] * 4 == len(ids)
            ids += bytes(r["ids"])
        assert {r["doc_tokens"] for r in pieces} == {len(ids) // 4}
        out[doc] = ids
    return out, sizes


def test_query_packs_every_id_once(spark, sf_dir):
    library = Tokenizer.from_file(op12_packing.default_path())
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    packed = op12_packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), op12_packing.default_path())
    ids, sizes = whole(packed.collect())
    assert ids.keys() == docs.keys()
    for doc, text in docs.items():
        assert ids[doc] == np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
    assert sum(s < 256 for s in sizes) <= 8 * packed.rdd.getNumPartitions()
    for r in op12_packing.query(spark, sf_dir).collect():
        assert r["ids_crc32"] == zlib.crc32(ids[r["doc_id"]][4 * r["start"] : 4 * (r["start"] + r["length"])])
        assert r["doc_tokens"] == len(ids[r["doc_id"]]) // 4


def test_hard_rows(spark):
    texts = [None, "", " \n ", "a", "word " * 5000, "x" * 3000, *["same text here"] * 30, *[f"n {i} " * (i % 40) for i in range(300)]]
    rows = [(None if i == 4 else i, t, 1, 2, "s", 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, start int, step string, ids int").repartition(3)
    ids, _ = whole(op12_packing.pack(docs, op12_packing.default_path()).collect())
    assert len(ids) == len(rows)
    assert ids[0] == ids[1] == ids[2] == np.array([1], "<u4").tobytes()
    twice = op12_packing.pack(docs.selectExpr("1 as doc_id", "text"), op12_packing.default_path()).collect()
    assert sum(r["length"] for r in twice) == sum(len(x) // 4 for x in ids.values())
    assert op12_packing.pack(docs.where("false"), op12_packing.default_path()).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_windows_and_the_rest(seed):
    rng = random.Random(seed)
    pool, lengths = op12_packing.Pool((64, 32, 16)), {}
    for doc in range(rng.randrange(0, 200)):
        lengths[doc] = rng.randrange(1, 65)
        pool.put(doc, 0, lengths[doc])
    full = list(pool.windows())
    assert all(sum(n for *_, n in w) in (64, 32, 16) for w in full)
    last = list(pool.rest())
    sizes = [sum(n for *_, n in w) for w in last]
    assert sizes == sorted(sizes, reverse=True) and all(n & (n - 1) == 0 for n in sizes) and sum(sizes) < 128
    assert not pool.lengths
    covered = defaultdict(set)
    for doc, start, n in (p for w in full + last for p in w):
        assert not covered[doc] & set(range(start, start + n))
        covered[doc] |= set(range(start, start + n))
    assert {d: len(x) for d, x in covered.items()} == lengths


def test_steps_are_balanced():
    rng = random.Random(3)
    windows = [[(k, 0, rng.choice([2048, 1024, 512, 256]))] for k in range(500)]
    groups = op12_packing.steps(windows, 1 << 15)
    sizes = [sum(n for w in g for *_, n in w) for g in groups]
    assert sum(map(len, groups)) == 500 and max(sizes) - min(sizes) <= 256


def test_sequences(spark, sf_dir):
    packed = op12_packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), op12_packing.default_path())
    rows = op12_packing.sequences(packed).collect()
    assert all(len(r["ids"]) == 4 * r["length"] == 4 * sum(r["lengths"]) for r in rows)
    assert sum(r["length"] for r in rows) == sum(r["length"] for r in packed.collect())
