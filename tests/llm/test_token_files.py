"""Token-id files: encoding by parts against the library on random texts, and writing jobs that add, replace or fail."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelforge.llm import op9_token_files, packed_ids

PIECES = [
    *" \n\t\r\x0b\x1c\x1d\x85\xa0 　", "  ", "\n\n", ". ", ", ", "...", "%%%", "'s", "'ll", "'", "’t", "word", "Word,", "don't", "I'm.", "42", "4.5", "x9", "é", "Straße!",
    "Ωmega", "日本語", "🙂", "é", "‍", "ß.", "ª", "µ", "²", "½", "Ǆ", "ɐ", "ſ", "<|endoftext|>", "<|endoftext", "$5", "#tag", "a|b", "(x)", "-", "_", "\x00", "\x7f", "ﬁ", "٣", "क्ष",
]


def test_encode_is_the_librarys():
    rng = random.Random(11)
    path = op9_token_files.default_path()
    bpe, library = op9_token_files.ByteBpe(path), Tokenizer.from_file(path)
    texts = ["".join(rng.choice(PIECES) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(0, 12))) for _ in range(6000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0x10000, 0x1F000)])) for _ in range(rng.randrange(1, 30))) for _ in range(2000)]
    for _ in range(2):  # the second time from the cache
        for k in range(0, len(texts), 1000):
            part = texts[k : k + 1000]
            for text, ids in zip(part, bpe.encode(pa.array(part, pa.string())).to_pylist()):
                assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_cache_generations():
    bpe = op9_token_files.ByteBpe(op9_token_files.default_path())
    bpe.stems.entries = 20
    library = bpe.tokenizer
    for k in range(30):
        text = " ".join(f"wort{chr(97 + (k * j) % 26)}{chr(97 + j)}" for j in range(15))
        assert bpe.encode(pa.array([text])).to_pylist() == [library.encode(text, add_special_tokens=False).ids]
    assert len(bpe.stems.known) + len(bpe.stems.old) < 80


def numbered(spark, first, n):
    return spark.range(first, first + n).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id").cast("string")).alias("text"))


def starts_follow(rows):
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += len(r["ids"])


def test_append_and_overwrite(spark, tmp_path):
    folder, path = f"{tmp_path}/a", op9_token_files.default_path()  # no scheme: the session's default file system
    op9_token_files.write_ids(numbered(spark, 10, 20), folder, path)
    op9_token_files.write_ids(numbered(spark, 0, 5), folder, path)
    rows = op9_token_files.read_ids(spark, folder).collect()
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == [*range(10, 30), *range(5)]
    starts_follow(rows)
    op9_token_files.write_ids(numbered(spark, 7, 2), folder, path, mode="overwrite")
    rows = op9_token_files.read_ids(spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == [7, 8]
    starts_follow(rows)
    named = {f["name"] for f in json.loads((tmp_path / "a/manifest.json").read_text())["files"]}
    assert {p.name for p in (tmp_path / "a").glob("*.pack")} == named


def test_equal_ids_spread_over_files(spark, tmp_path):
    docs = spark.range(4000).select(F.lit(3).alias("doc_id"), F.concat(F.lit("row "), F.col("id").cast("string")).alias("text"))
    op9_token_files.write_ids(docs, f"file://{tmp_path}/b", op9_token_files.default_path())
    rows = op9_token_files.read_ids(spark, f"file://{tmp_path}/b").collect()
    assert len(rows) == 4000
    starts_follow(rows)


def test_failed_job_leaves_nothing_behind_the_next(spark, tmp_path):
    spark.dataSource.register(packed_ids.PackedIds)
    bad = spark.range(0, 100, 1, 4).selectExpr("id as doc_id", "array(cast(id as int)) as ids")
    with pytest.raises(Exception, match="does not fit"):
        bad.write.format("packed_ids").mode("append").option("bits", 5).save(f"file://{tmp_path}/c")
    assert not (tmp_path / "c/manifest.json").exists()
    good = spark.range(0, 20, 1, 4).selectExpr("id as doc_id", "array(cast(id as int)) as ids")
    good.write.format("packed_ids").mode("append").option("bits", 5).save(f"file://{tmp_path}/c")
    named = {f["name"] for f in json.loads((tmp_path / "c/manifest.json").read_text())["files"]}
    assert {p.name for p in (tmp_path / "c").glob("*.pack")} == named
    assert sorted(r["ids"] for r in op9_token_files.read_ids(spark, f"file://{tmp_path}/c").collect()) == [[k] for k in range(20)]


def test_bare_path_is_refused():
    with pytest.raises(ValueError, match="no scheme"):
        packed_ids._open("/shared/ids")
