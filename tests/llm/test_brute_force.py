"""Queries that SQL cannot express against plain versions of the whole computation, and how pieces change nothing."""

import functools
import html
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest

from panelforge.llm import op2_quality, op3_language_id, op4_toxicity, op6_decontamination, op8_html
from panelforge.llm.common import table
from panelforge.llm.op2_quality import label_means


def crc(i):
    return zlib.crc32(str(i).encode())


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    values, start = np.asarray(scores)[order], 0
    for end in [*(np.flatnonzero(np.diff(values)) + 1), len(values)]:
        ranks[order[start:end]] = (start + end + 1) / 2
        start = end
    labels = np.asarray(labels, bool)
    n, m = labels.sum(), (~labels).sum()
    return (ranks[labels].sum() - n * (n + 1) / 2) / (n * m)


def balanced(predicted, labels):
    predicted, labels = np.asarray(predicted, bool), np.asarray(labels, bool)
    return (predicted[labels].mean() + (~predicted[~labels]).mean()) / 2


def documents(spark, sf_dir):
    return sorted((r["doc_id"], r["text"] or "", r["lang"]) for r in table(spark, sf_dir, "documents").collect())


TEXTS = ["", " ", "a", "one two", "Wow!!! yes???no... !!!", "x" * 50, "word word word\nword\n\nWord. End", "é ß Σίσυφος İstanbul 日本 123", "a!!!b ???? ,,,\t,,,  \x1c\x85 end", "\U00032001\U00032002 \U00032001"]


# ---- 2 quality


def naive_statistics(text):
    words, data = text.split(), text.encode()
    counts, n, size = Counter(words), max(len(words), 1), max(len(data), 1)
    lines = text.split("\n")
    upper = sum(65 <= c <= 90 for c in data)
    lower = sum(97 <= c <= 122 or c >= 128 for c in data)
    digits = sum(48 <= c <= 57 for c in data)
    symbols = sum(c < 128 and not chr(c).isalnum() and c not in b" ,." and not 9 <= c <= 13 for c in data)
    entropy = -sum(x / size * math.log2(x / size) for x in Counter(data).values())
    runs = sum(len(re.findall(r"([^\w\s])\1\1", w)) for w in words)
    return [
        math.log1p(len(text)), math.log1p(len(words)), sum(map(len, words)) / n, len(counts) / n, math.log1p(len(counts)), max(counts.values(), default=0) / n,
        upper / max(upper + lower, 1), digits / size, symbols / size, (data.count(b",") + data.count(b".")) / n, entropy, math.log1p(len(lines)),
        1 - len(set(lines)) / len(lines), sum(a == b for a, b in zip(words, words[1:])) / n, runs / n, sum(len(w) <= 3 for w in words) / n,
        sum(len(w) == 1 and not w.isalnum() for w in words) / n, (sum(w[0].isupper() for w in words) - sum(w[-1] in ".!?" for w in words)) / n,
    ]


@pytest.mark.parametrize("stretch", [1, 7, 10**9])
def test_quality_statistics(monkeypatch, stretch):
    whole = [op2_quality.statistics(t) for t in TEXTS]
    monkeypatch.setattr(op2_quality, "_STRETCH", stretch)
    rng = random.Random(5)
    for text in [*TEXTS, *("".join(rng.choice("ab!? .\n") for _ in range(60)) for _ in range(200))]:
        assert np.allclose(op2_quality.statistics(text), naive_statistics(text), rtol=1e-12, atol=1e-12), repr(text)
    assert [op2_quality.statistics(t) for t in TEXTS] == whole


def test_quality_query(spark, sf_dir):
    """Standardised statistics, random features, ridge in closed form and isotonic bins, all in one numpy matrix."""
    docs = documents(spark, sf_dir)
    stats = np.array([naive_statistics(t) for _, t, _ in docs])
    labels = defaultdict(list)
    for r in table(spark, sf_dir, "labels").collect():
        if r["quality"] is not None and crc(r["doc_id"]) % 4 != 2:
            labels[r["doc_id"]].append(r["quality"])
    rows = [k for k, (i, _, _) in enumerate(docs) if i in labels]
    y = np.array([np.mean(labels[docs[k][0]]) for k in rows])
    mean, scale = stats[rows].mean(axis=0), stats[rows].std(axis=0)
    scale[scale <= 1e-9] = 1
    draw, n_stats = np.random.default_rng(op2_quality.SEED), stats.shape[1]
    w = draw.normal(0, math.sqrt(2 * op2_quality.GAMMA / n_stats), (n_stats, op2_quality.FEATURES))
    b = draw.uniform(0, 2 * math.pi, op2_quality.FEATURES)
    x = np.clip((stats - mean) / scale, -6, 6)
    x = np.hstack([np.cos(x @ w + b) * math.sqrt(2 / op2_quality.FEATURES), x, np.ones((len(x), 1))])
    a = x[rows]
    raw = x @ np.linalg.solve(a.T @ a + op2_quality.RIDGE * len(rows) / a.shape[1] * np.eye(a.shape[1]), a.T @ y)
    bins = np.clip((raw[rows] + 0.5) / 2 * op2_quality.BINS, 0, op2_quality.BINS - 1).astype(int)
    used = np.unique(bins)
    means, counts = [y[bins == k].mean() for k in used], [(bins == k).sum() for k in used]
    levels = [max(min(np.average(means[s:e], weights=counts[s:e]) for e in range(k + 1, len(used) + 1)) for s in range(k + 1)) for k in range(len(used))]
    wanted = np.interp(raw, (used + 0.5) / op2_quality.BINS * 2 - 0.5, levels)
    found = {r["doc_id"]: r for r in op2_quality.query(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for (i, _, _), score in zip(docs, wanted):
        assert abs(found[i]["score"] - score) < 1e-6 and found[i]["held_out"] == (crc(i) % 4 == 2)


def test_quality_held_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op2_quality.query(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").where("held_out").collect()
    labels = [r["quality"] for r in rows]
    assert auc([r["score"] for r in rows], labels) >= 0.95 and balanced([r["predicted"] for r in rows], labels) >= 0.9


# ---- 3 language ID


def naive_grams(text, buckets):
    codes = [32]
    for c in text.lower():
        if c.isalpha():
            codes.append(ord(c))
        elif codes[-1] != 32:
            codes.append(32)
    if codes[-1] != 32:
        codes.append(32)
    m, shift, out = 0xFFFFFFFF, 32 - (buckets.bit_length() - 1), []
    for k in range(len(codes) - 1):
        two = (codes[k] * 0x9E3779B1 + codes[k + 1] * 0x85EBCA77) & m
        out.append((two * 0x2545F491 & m) >> shift)
        if k + 2 < len(codes):
            three = (two * 0xC2B2AE3D + codes[k + 2] * 0x27D4EB2F) & m
            three ^= three >> 15
            out.append((three * 0x9E3779B1 & m) >> shift)
    return out


@pytest.mark.parametrize("piece", [1, 2, 7, 10**9])
def test_language_grams(monkeypatch, piece):
    monkeypatch.setattr(op3_language_id, "_PIECE", piece)
    rng = random.Random(6)
    texts = [*TEXTS, *("".join(rng.choice("ab éΣİ\n1ß.\U00032001") for _ in range(rng.randrange(40))) for _ in range(300))]
    found, lettered = defaultdict(list), set()
    for whose, grams, seen in op3_language_id.gram_groups(texts, 1 << 12):
        for i, g in zip(whose.tolist(), grams.tolist()):
            found[i].append(g)
        lettered |= set(seen.tolist())
    for i, text in enumerate(texts):
        assert sorted(found[i]) == sorted(naive_grams(text, 1 << 12)), repr(text)
        assert (i in lettered) == any(map(str.isalpha, text.lower()))


def test_language_query(spark, sf_dir):
    docs, buckets = documents(spark, sf_dir), op3_language_id.BUCKETS
    counts, n = defaultdict(Counter), Counter()
    for i, text, lang in docs:
        if lang is not None and crc(i) % 3 != 1:
            counts[lang].update(naive_grams(text, buckets))
            n[lang] += 1
    langs = sorted(n)
    unit = {x: {g: round(float((np.log(c + op3_language_id.ALPHA) - np.log(counts[x].total() + op3_language_id.ALPHA * buckets)) * 2**20)) for g, c in [*counts[x].items(), (-1, 0)]} for x in langs}
    found = {r["doc_id"]: r for r in op3_language_id.query(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    right = []
    for i, text, lang in docs:
        if not any(map(str.isalpha, text)):
            assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0)
            continue
        grams = naive_grams(text, buckets)
        total = [round(math.log(n[x] / n.total()) * 2**20) + sum(unit[x].get(g, unit[x][-1]) for g in grams) for x in langs]
        best = max(total)
        share = 1 / sum(math.exp((t - best) / 2**20) for t in total)
        assert found[i]["lang_pred"] == langs[total.index(best)] and abs(found[i]["score"] - share) < 1e-4
        right += [found[i]["lang_pred"] == lang] if lang is not None and crc(i) % 3 == 1 else []
    assert np.mean(right) >= 0.97


def test_language_of_rare_letters_and_many_languages(spark):
    rows = [(i, f"\U00032001\U00032002 text{i}", f"l{i % 40}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = op3_language_id.train(docs)
    assert model.score(["\U00032001"])[0][0] != "und" and len(model.langs) == 40


def test_languages_in_blocks_score_as_in_one(spark, monkeypatch):
    rng = random.Random(9)
    words = {k: [f"w{chr(97 + rng.randrange(26))}{chr(97 + k % 26)}{chr(97 + rng.randrange(26))}" for _ in range(8)] for k in range(30)}
    rows = [(i, " ".join(rng.choices(words[i % 30], k=12)), f"l{i % 30:02}", "x", 1.0) for i in range(240)]
    rows += [(900, None, None, "x", 1.0), (901, "12 34", None, "x", 1.0), (902, rows[0][1], None, "x", 1.0), (902, rows[0][1], None, "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, best string, mass double")
    whole = op3_language_id.train(docs, buckets=1 << 10)
    wanted = sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in op3_language_id.identify(docs, whole).collect())
    kept = sorted(map(tuple, op3_language_id.keep_identified(docs, whole, 0.5).collect()))
    monkeypatch.setattr(op3_language_id, "MATRIX_LIMIT", 7 * 4 << 10)
    blocks = op3_language_id.train(docs, buckets=1 << 10)
    assert len(blocks) == 5
    assert sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in op3_language_id.identify(docs, blocks).collect()) == wanted
    found = op3_language_id.keep_identified(docs, blocks, 0.5)
    assert found.columns == docs.columns and sorted(map(tuple, found.collect())) == kept
    monkeypatch.setattr(op3_language_id, "MOST_LANGUAGES", 10)
    with pytest.raises(ValueError, match="no column of languages"):
        op3_language_id.train(docs)


def test_language_score_does_not_depend_on_the_batch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = op3_language_id.train(docs)
    texts = [t for _, t, _ in documents(spark, sf_dir)][:60]
    names, scores = model.score(texts)
    alone = [model.score([t]) for t in texts]
    assert names == [x[0][0] for x in alone] and scores.tolist() == [x[1][0] for x in alone]


# ---- 4 toxicity


@functools.lru_cache(maxsize=None)
def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def naive_features(weights, text):
    text = text.lower()
    words = [(m[0], m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
    total = top = quoted = exact = fuzzy = 0.0
    for k, (word, a, b) in enumerate(words):
        near = [(d, -weights[t], t) for t in weights if abs(len(t) - len(word)) <= 2 and (d := distance(word, t)) <= op4_toxicity.edits(len(t))]
        if not near:
            continue
        d, _, term = min(near)
        around = {w for w, _, _ in words[max(k - 6, 0) : k + 7]}
        line = text.rfind("\n", 0, a) + 1
        end = text.find("\n", b)
        marks = lambda s: sum(c in '"“”„«»' for c in s)
        inside = marks(text[line:a]) % 2 == 1 and marks(text[b : len(text) if end < 0 else end]) > 0
        reported = inside or bool(around & op4_toxicity.REPORTING)
        weight = weights[term] / (1 + d) * (0.3 if reported else 1) * (1.5 if around & op4_toxicity.ADDRESSING else 1)
        total, top, quoted = total + weight, max(top, weight), quoted + reported
        exact, fuzzy = exact + (d == 0), fuzzy + (d > 0)
    if not exact + fuzzy:
        return [0.0] * 6 + [1.0]
    return [math.log1p(total), top, math.log1p(exact), math.log1p(fuzzy), quoted / (exact + fuzzy), 100 * total / len(words), 1.0]


def test_toxicity_features():
    weights = {"moron": 3.0, "idiot": 2.5, "scum": 2.0, "git": 1.5, "pathetic": 1.0}
    model = op4_toxicity.ToxicityModel(op4_toxicity.Lexicon(weights), np.zeros(7))
    rng = random.Random(7)
    words = ["moron", "m0ron", "idiots", "scum", "git", "gits", "pathetik", "you", "said", '"', "“", "”", "\n", "fine", "word,", "plain", "x" * 60]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    for filler in (5, 400, 5000):
        texts.append(f'she wrote long ago "{"x " * filler} moron {"y " * filler}" end')
        texts.append(f'"{"x " * filler}" then {"y " * 9} moron {"y " * filler} "later"')
    assert np.allclose(model.features(texts), [naive_features(weights, t) for t in texts], rtol=1e-12)
    assert np.allclose(model.features(texts[::-1]), [naive_features(weights, t) for t in texts[::-1]], rtol=1e-12)  # from the cache
    assert model.features(texts[300:301])[0, 4] == 1 == model.features(texts[304:305])[0, 4]


def test_toxicity_learns_short_terms_not_copied_passages(spark):
    rng = random.Random(8)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    passage = "this passage stands copied in many of the toxic texts zebra quagga okapi"
    for i in range(400):
        words = rng.choices(plain, k=20)
        toxic = i % 4 == 0
        if toxic:
            words.insert(rng.randrange(20), "git")
            words += passage.split() if i % 8 == 0 else []
        rows.append((i, " ".join(words)))
        labels.append((i, float(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = op4_toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, label double"))
    assert "git" in model.lexicon.weights and not {"zebra", "quagga", "okapi"} & set(model.lexicon.weights)


def naive_lexicon(rows):
    """Weights of terms from (text, toxic) rows, with every count taken word by word."""
    toxic_in, all_in, before = Counter(), Counter(), defaultdict(Counter)
    for text, toxic in rows:
        found = re.findall(r"[^\W_]+", text.lower())
        for w in set(found):
            at = found.index(w)
            all_in[w] += 1
            toxic_in[w] += toxic
            before[w][found[at - 1] if at else ""] += toxic
    n, n_toxic = len(rows), sum(t for _, t in rows)
    share, out = n_toxic / n, {}
    for w, m in all_in.items():
        a, b = toxic_in[w], m - toxic_in[w]
        counts = [c for c in before[w].values() if c]
        if a < 3 or a / m < 0.8 or len(counts) < 3 or sum(counts) ** 2 / sum(c * c for c in counts) < 2:
            continue
        if 2 * (a * math.log(a / (m * share)) + (b * math.log(b / (m * (1 - share))) if b else 0)) >= 20:
            out[w] = math.log((a + 0.5) / (b + 0.5)) - math.log(share / (1 - share))
    return out


def naive_fit(x, y):
    """Plain gradient steps with backtracking, then Newton steps by least squares, to the minimum of the penalised loss."""
    penalty = np.array([1e-2] * 6 + [1e-6])
    loss = lambda w: np.logaddexp(0, x @ w).sum() - y @ (x @ w) + (penalty * w * w).sum() / 2
    w = np.zeros(7)
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope, root = x.T @ (p - y) + penalty * w, np.sqrt(np.maximum(p * (1 - p), 1e-14))
        step = np.linalg.lstsq(np.vstack([x * root[:, None], np.diag(np.sqrt(penalty + 1e-9))]).T @ np.vstack([x * root[:, None], np.diag(np.sqrt(penalty + 1e-9))]), slope, rcond=None)[0]
        size = 1.0
        while loss(w - size * step) > loss(w) + 1e-12 and size > 1e-9:
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-9:
            break
    return w


def test_toxicity_query_is_the_plain_one(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    labels = defaultdict(list)
    for r in table(spark, sf_dir, "labels").collect():
        if r["toxic"] is not None and crc(r["doc_id"]) % 5:
            labels[r["doc_id"]].append(r["toxic"])
    rows = [(texts[i], int(sum(x) / len(x) >= 0.5)) for i, x in labels.items() if i in texts]
    weights = naive_lexicon(rows)
    assert weights
    fitted = naive_fit(np.array([naive_features(weights, t) for t, _ in rows]), np.array([y for _, y in rows]))
    found = {r["doc_id"]: r for r in op4_toxicity.query(spark, sf_dir).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        wanted = 1 / (1 + math.exp(-max(min(float(np.dot(naive_features(weights, text), fitted)), 30), -30)))
        assert found[i]["score"] == pytest.approx(wanted, abs=2e-3), i
        assert found[i]["held_out"] == (crc(i) % 5 == 0) and found[i]["predicted"] == int(found[i]["score"] >= 0.5)


def test_toxicity_of_a_very_long_term(spark):
    term = "abcdefghij" * 2000
    rows = [(i, f"w{i} {term if i % 3 == 0 else 'plain'} w{i + 1}") for i in range(150)]
    labels = spark.createDataFrame([(i, float(i % 3 == 0)) for i in range(150)], "doc_id long, label double")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = op4_toxicity.train(docs, labels)
    assert set(model.lexicon.weights) == {term}
    odd = spark.createDataFrame([(1, term[:-1]), (2, term[::-1]), (3, "plain")], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in op4_toxicity.scored(odd, model).collect()}
    assert scores[1] > 0.5 > scores[3] == scores[2]


def test_toxicity_held_out(spark):
    sf_dir = "/root/testdata/sf0.1"  # the smaller tables hold six held-out toxic documents or fewer
    rows = op4_toxicity.query(spark, sf_dir).join(label_means(table(spark, sf_dir, "labels"), "toxic"), "doc_id").where("held_out").collect()
    labels = [r["label"] >= 0.5 for r in rows]
    assert auc([r["score"] for r in rows], labels) >= 0.94 and balanced([r["predicted"] for r in rows], labels) >= 0.93


def test_toxicity_repeated_ids_train_once(spark):
    rows = [(1, f"row {k} you moron") for k in range(50)] + [(2, "fine words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1.0), (2, 0.0)], "doc_id long, label double")
    assert op4_toxicity.scored(docs, op4_toxicity.train(docs, labels)).count() == 51


# ---- 6 decontamination


def naive_tiles(item, doc, least):
    used_item, used_doc, out = [False] * len(item), [False] * len(doc), []
    places = defaultdict(list)
    for j in range(len(doc) - least + 1):
        places[tuple(doc[j : j + least])].append(j)
    while True:
        best = None
        for i in range(len(item) - least + 1):
            for j in places[tuple(item[i : i + least])]:
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not used_item[i + k] and not used_doc[j + k]:
                    k += 1
                if k >= least and (best is None or k > best[2]):
                    best = (i, j, k)
        if best is None:
            return out
        for x in range(best[2]):
            used_item[best[0] + x] = used_doc[best[1] + x] = True
        out.append(best)


def test_tiles():
    rng = random.Random(2)
    for _ in range(1500):
        letters = [bytes([97 + k]) for k in range(rng.randrange(1, 7))]
        item = [rng.choice(letters) for _ in range(rng.randrange(0, 20))]
        doc = [rng.choice([*letters, b"x"]) for _ in range(rng.randrange(0, 30))]
        least = rng.choice([2, 3, 5])
        assert sorted(op6_decontamination.tiles(item, doc, least)) == sorted(naive_tiles(item, doc, least))
    assert op6_decontamination.tiles([b"w"] * 1000, [b"w"] * 200_000) == [(0, 0, 1000)]


def naive_contaminations(docs, items):
    word = re.compile(r"[\x80-\U0010ffff]|[0-9a-z]")

    def words(text):
        return "".join(c if word.match(c) else " " for c in text.lower()).split(" ")

    out = set()
    split = {i: [w for w in words(t) if w] for i, t in docs}
    for item_id, text in items:
        item = [w for w in words(text) if w]
        runs = {tuple(item[k : k + 5]) for k in range(len(item) - 4)}
        for d, doc in split.items():
            if len(item) < 5 or not any(tuple(doc[k : k + 5]) in runs for k in range(len(doc) - 4)):
                continue
            found = naive_tiles(item, doc, 5)
            covered = sum(k for *_, k in found)
            if covered >= 0.8 * len(item):
                order = [i for i, _, _ in sorted(found, key=lambda t: t[1])]
                ends = min(j for _, j, _ in found), max(j + k for _, j, k in found)
                out.add((d, item_id, len(item), covered, covered / len(item), len(found), max(k for *_, k in found), order != sorted(order), *ends))
    return out


def test_decontamination_query(spark, sf_dir):
    docs = [(i, t) for i, t, _ in documents(spark, sf_dir)]
    items = [(r["item_id"], r["text"] or "") for r in table(spark, sf_dir, "benchmark").collect()]
    found = [tuple(r) for r in op6_decontamination.query(spark, sf_dir).collect()]
    assert len(found) == len(set(found)) and set(found) == naive_contaminations(docs, items)


@pytest.mark.parametrize("bits", [(64, 64), op6_decontamination.FILTER_BITS])
def test_decontamination_of_cut_and_common_passages(spark, bits):
    """Items that share most of their words, passages cut into the shortest tiles, and a filter that lets nearly all pass."""
    rng = random.Random(10)
    common = [f"c{k}" for k in range(30)]
    items = [(k, " ".join([*common[: rng.randrange(0, 30)], *(f"i{k}w{j}" for j in range(rng.randrange(5, 25)))])) for k in range(40)]
    docs = []
    for i in range(120):
        words = rng.choice(items)[1].split()
        parts = [words[k : k + n] for n in [rng.randrange(4, 12)] for k in range(0, len(words), n)]
        rng.shuffle(parts)
        docs.append((i, " zz ".join(" ".join(p) for p in parts[rng.randrange(0, 2) :]).upper()))
    found = op6_decontamination.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), filter_bits=bits)
    assert {tuple(r) for r in found.collect()} == naive_contaminations(docs, items)


def test_decontamination_keeps_columns_and_null_ids(spark):
    item = "seven wizards watch from the old tower while the fox jumps"
    rows = [(None, item, "a", 1), (None, "clean text of some words in a row", "b", 2), (5, item, "c", 3), (5, "another clean text of id five here", "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key string, seed long")
    items = spark.createDataFrame([(None, item), (1, item)], "item_id long, text string")
    assert sorted(r["text_key"] for r in op6_decontamination.keep_clean(docs, items).collect()) == ["b", "d"]
    assert op6_decontamination.keep_clean(docs, items).columns == docs.columns
    found = [(r["doc_id"], r["item_id"]) for r in op6_decontamination.contaminations(docs, items).collect()]
    assert Counter(found) == Counter([(None, None), (None, 1), (5, None), (5, 1)])


# ---- 8 HTML


class Walk(HTMLParser):
    """The characters of a page outside of what is never shown, with the marks of list items."""

    HIDDEN = {"head", "script", "style", "template", "title", "noscript", "iframe"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.lists, self.out = 0, [], []

    def handle_starttag(self, tag, attributes):
        if tag in self.HIDDEN:
            self.depth += 1
        if tag in ("ul", "ol") and not self.depth:
            self.lists.append(int(dict(attributes).get("start") or 1) if tag == "ol" else None)
        if tag == "li" and not self.depth:
            if self.lists and self.lists[-1] is not None:
                self.out.append(f"{self.lists[-1]}.")
                self.lists[-1] += 1
            else:
                self.out.append("-")

    def handle_endtag(self, tag):
        if tag in self.HIDDEN:
            self.depth = max(self.depth - 1, 0)
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def signs(text):
    return "".join(text.replace("\xa0", " ").split())


def test_html_pages_hold_the_same_characters(spark, sf_dir):
    """All visible characters, in order but for the lines of table cells, which stand side by side."""
    pages = {r["page_id"]: r["html"] or "" for r in table(spark, sf_dir, "pages").collect()}
    same = 0
    for r in op8_html.query(spark, sf_dir).collect():
        walk = Walk()
        walk.feed(pages[r["page_id"]])
        walk.close()
        wanted, found = signs("".join(walk.out)), signs(r["text"])
        assert Counter(found) == Counter(wanted), r["page_id"]
        same += found == wanted
    assert same >= 0.9 * len(pages)


@pytest.mark.parametrize(
    "page, text",
    [
        ('<div style="visibility:hidden">no<span style="visibility:visible">yes</span></div>', "yes"),
        ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
        ("<table><tbody><tr><td rowspan=9>A<td>B<tbody><tr><td>C<td>D</table>", "A  B\nC  D"),
        ("<table><tr><td colspan=2>very wide cell<td>x<tr><td>a<td>b<td>c</table>", "very wide cell  x\na  b            c"),
        ("<table><tr><td>日本<td>x<tr><td>abcdef<td>y</table>", "日本    x\nabcdef  y"),
        ("<table><tr><td>a<table><tr><td>in<td>ner</table><td>b</table>", "a        b\n\nin  ner"),
        ("a <select><option>one<option selected>two</select> b", "a two b"),
        ("<select multiple><option>one<option>two</select>", "one\ntwo"),
        ("<select></select>x", "x"),
        ("<textarea>\na &amp; b\n  c</textarea>", "a & b\n  c"),
        ("<svg><title>t</title>no<text>seen</text><path/></svg>", "seen"),
        ("<math><mi>x</mi><annotation>hid</annotation></math>", "x"),
        ("<object>fallback</object><video>no</video>", "fallback"),
        ("<ol><li value=5>x<li>y</ol>", "5. x\n6. y"),
        ("<xmp><b>&amp;</xmp>", "<b>&amp;"),
    ],
)
def test_html_layout(page, text):
    assert op8_html.render(page) == text


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "deep", "<b><p>" * 20_000 + "deep", "<blockquote>" * 20_000 + "deep", "<span>" + "</b>" * 20_000 + "deep", "<table><tr><td>" * 4000 + "deep"])
def test_html_deep_pages(page):
    assert op8_html.render(page).strip() == "deep"


def test_html_entities_once():
    assert op8_html.render(html.escape(html.escape("<b>"))) == html.escape("<b>")


def test_shared_preamble_makes_no_candidates(spark, monkeypatch):
    """Items with an instruction in common: documents with that instruction alone are never tiled."""
    preamble = " ".join(f"inst{i}" for i in range(60))
    items = [(i, preamble + " " + " ".join(f"q{i}w{j}" for j in range(30))) for i in range(40)]
    docs = [(i, preamble + " " + " ".join(f"d{i}w{j}" for j in range(50))) for i in range(40)] + [(99, "so: " + items[7][1])]
    rows = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    seen = []
    plain = op6_decontamination._matched_rows
    monkeypatch.setattr(op6_decontamination, "_matched_rows", lambda rows, *more: (seen.append(rows.count()), plain(rows, *more))[1])
    found = [(r["doc_id"], r["item_id"]) for r in op6_decontamination.contaminations(*rows).collect()]
    assert found == [(99, 7)] and seen == [1]


@pytest.mark.parametrize("seed", range(30))
def test_left_out_seeds_cannot_contaminate(seed):
    rng = random.Random(seed)
    n_words = rng.randrange(5, 60)
    common = np.array([rng.choice([1, 1, 2, 5, 9]) for _ in range(n_words - 4)])
    left = op6_decontamination.left_out(common, n_words, 5, 0.8)
    covered = {w for p in left for w in range(p, p + 5)}
    assert len(covered) < 0.8 * n_words and all(common[p] > 1 for p in left)
    more = [p for p in np.flatnonzero(common > 1) if p not in left]
    assert all(len(covered | set(range(p, p + 5))) >= 0.8 * n_words for p in more)
