"""The pipeline against a brute-force version, and the queries of this subpackage against their SQL."""

import hashlib
import math
import os
import re
from collections import Counter, defaultdict

import duckdb
import pytest
import sentencepiece

import corpus_pipeline
from panelforge.llm import op3_language_id, op7_sentencepiece, op10_simhash, registry
from panelforge.llm.common import table, written
from tests.llm.test_brute_force import crc, documents, naive_contaminations, naive_grams
from tests.llm.test_operators import components_brute, simhash_brute
from tests.llm.test_similar_sets import kept_brute


def naive_languages(rows):
    """Language and probability of each text by a plain naive Bayes model, learned outside of the held-out third."""
    buckets, counts, n = op3_language_id.BUCKETS, defaultdict(Counter), Counter()
    for i, text, lang in rows:
        if lang is not None and crc(i) % 3 != 1:
            counts[lang].update(naive_grams(text, buckets))
            n[lang] += 1
    for _, text, _ in rows:
        logs = {x: math.log(n[x] / n.total()) for x in n}
        for g, k in Counter(naive_grams(text, buckets)).items():
            for x in n:
                logs[x] += k * math.log((counts[x][g] + op3_language_id.ALPHA) / (counts[x].total() + op3_language_id.ALPHA * buckets))
        best = max(logs.values())
        yield any(map(str.isalpha, text)), 1 / sum(math.exp(v - best) for v in logs.values())


def kept_before_near_dedup(spark, sf_dir):
    rows = documents(spark, sf_dir)
    kept = [(i, t) for (i, t, _), (lettered, score) in zip(rows, naive_languages(rows)) if lettered and score >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    first = {}
    for i, t in kept:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    return list(first.values())


def clean_and_encoded(spark, sf_dir, kept):
    items = [(r["item_id"], r["text"] or "") for r in table(spark, sf_dir, "benchmark").collect()]
    dirty = {row[0] for row in naive_contaminations(kept, items)}
    library = sentencepiece.SentencePieceProcessor(model_file=op7_sentencepiece.default_path())
    return {i: hashlib.sha256(",".join(map(str, library.encode(t))).encode()).hexdigest() for i, t in kept if i not in dirty}


def test_pipeline_brute_force(spark, sf_dir):
    """Every stage by plain code; near copies are texts linked by five-word Jaccard similarity 0.8 or more, as the stage states."""
    kept = kept_before_near_dedup(spark, sf_dir)
    stay = set(kept_brute(kept))
    wanted = clean_and_encoded(spark, sf_dir, [(i, t) for i, t in kept if i in stay])
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"]: r["ids_sha256"] for r in found} == wanted and len(found) == len(wanted)


def test_three_bit_groups_in_the_pipeline(spark, sf_dir):
    """The stages with op10's own links (three words, three bits) in the place of the stage's."""
    kept = kept_before_near_dedup(spark, sf_dir)
    parts = components_brute({i: simhash_brute(t) for i, t in kept})
    wanted = clean_and_encoded(spark, sf_dir, [(i, t) for i, t in kept if parts[i] == i])
    stages = dict(corpus_pipeline.STAGES)
    docs = table(spark, sf_dir, "documents")
    for name in ("language_id", "exact_dedup"):
        docs = written(stages[name](spark, docs, sf_dir), name)
    roots = op10_simhash.near_duplicates(docs).where("doc_id = component_id").select("doc_id")
    docs = stages["decontaminate"](spark, docs.join(roots, "doc_id", "left_semi"), sf_dir)
    found = stages["encode"](spark, docs, sf_dir).collect()
    assert {r["doc_id"]: r["ids_sha256"] for r in found} == wanted and len(found) == len(wanted)


def test_stages_keep_columns(spark):
    rows = [(1, "the first of the texts", "en", "s", 1, "a"), (2, "the first  of the texts", "en", None, None, "b"), (3, None, None, "s", 1, "c"), (4, "", "fr", "s", 1, "d"), (5, "le premier des textes", "fr", "s", 1, "e"), (1, "the first of the texts", "en", "s", 1, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        assert out.where("doc_id = 5").count() == 1
        empty = stage(spark, docs.where("1 = 0"), "/root/testdata/sf0.001")
        assert empty.columns == docs.columns and empty.count() == 0
    assert corpus_pipeline.STAGES[1][1](spark, docs, "").where("doc_id in (1, 2)").count() == 1
    assert sorted(r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()) == [1, 1, 2, 3, 4, 5]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for t in os.listdir(sf_dir):
        connection.execute(f"create view {t[:-8]} as select * from '{sf_dir}/{t}'")
    found, wanted = registry.queries()[name](spark, sf_dir), connection.execute(registry.oracle_sql()[name])
    columns = sorted(c[0] for c in wanted.description)
    assert sorted(found.columns) == columns
    order = [[c[0] for c in wanted.description].index(c) for c in columns]

    def cell(v):
        return "" if v is None or isinstance(v, float) and math.isnan(v) else str(v)

    assert sorted(tuple(cell(r[c]) for c in columns) for r in found.collect()) == sorted(tuple(cell(r[i]) for i in order) for r in wanted.fetchall())
