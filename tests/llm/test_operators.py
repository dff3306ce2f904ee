"""Training-data operators against brute force, the libraries they must equal, and odd inputs."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelforge.llm import (
    op1_secrets,
    op2_quality,
    op3_language_id,
    op4_toxicity,
    op5_exact_dedup,
    op6_decontamination,
    op7_sentencepiece,
    op8_html,
    op9_token_files,
    op10_simhash,
)
from panelforge.llm.common import slices, table
from panelforge.llm.components import components
from panelforge.llm.packed_ids import PackedFile, pack, unpack, width

LONG = "word " * 30_000
ODD = [None, "", " ", "\n", "a", "same text", "same  text", "same\ttext", "Ünï 日本語 😀", "x" * 50_000, LONG, "a b c", "a b c", "  lead and trail ", "<|endoftext|> <s>", "\x1c\x00 é"]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts with repeated rows, a null id, null attributes and columns of clashing names."""
    rows = [(i, t, None if i % 3 else "en", "s", 0, "x", 1, True) for i, t in enumerate(ODD)]
    rows += [rows[5], (None, "no id", "en", None, 0, "y", 2, False)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, body string, keep_id long, kept boolean")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def texts_of(df):
    return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}


# ---- 1 secrets


def secrets_brute(text):
    kinds = [("assign", re.compile(r"(?i:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)")), ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+"))]
    least = {"access": 18, "hex": 16}
    out = []
    for order, (kind, pattern) in enumerate(kinds):
        for m in pattern.finditer(text):
            if len(m[2] if kind == "assign" else m[0]) >= least.get(kind, 12):
                out.append((m.start(), order, kind, m.end()))
    return sorted(out)


def test_secrets(spark):
    texts = [*ODD, 'é😀 password = "abcdefghijkl" AKIA' + "Q" * 16, "secret=token : abcdefghijklmn", "0123456789abcdef" * 3 + " token=0123456789abcdef01", "Token: " + "aB3" * 10, "password=x " * 500 + "api_key:'0011223344556677'"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in op1_secrets.scan(df).collect():
        found = secrets_brute(texts[r["doc_id"]] or "")
        assert [(s["start"], s["rank"], s["kind"], s["end"]) for s in r["base_spans"]] == found
        assert set(map(tuple, r["base_spans"])) <= set(map(tuple, r["all_spans"]))


def test_secret_ownership(spark):
    own, copied = "password=q7w8e9r0t1y2u3", "password=a1b2c3d4e5f6g7h8"
    rows = [(i, copied, f"o{i}") for i in range(5)] + [(9, own, "o1"), (10, own, "o1"), (11, "password=changeme123456", "o1"), (12, "x Ab1" + "cD2eF3" * 5, "o2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in op1_secrets.scan(df, owner=F.col("source")).collect()}
    assert found[0]["n_widely_copied"] == 1 and found[9]["n_owner_specific"] == 1
    assert found[11]["n_owner_specific"] == found[11]["n_widely_copied"] == 0
    assert [s["kind"] for s in found[12]["all_spans"]] == ["token"]


# ---- 2, 3, 4 classifiers


def test_quality_accuracy(spark, sf_dir):
    found = op2_quality.query(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in found]) >= 0.9


def test_quality_odd(spark, odd, empty):
    stats = op2_quality.stats_table(odd)
    assert stats.count() == odd.count()
    none = spark.createDataFrame([], "doc_id long, label double")
    assert {r["score"] for r in op2_quality.scored(stats, op2_quality.train(stats, none)).collect()} == {0.5}
    one = spark.createDataFrame([(0, 1.0), (0, 1.0)], "doc_id long, label double")
    assert {r["score"] for r in op2_quality.scored(stats, op2_quality.train(stats, one)).collect()} == {1.0}
    assert op2_quality.stats_table(empty).count() == 0


def test_isotonic():
    assert op2_quality.isotonic(np.array([1.0, 0.0, 3.0]), np.array([1.0, 1.0, 2.0])).tolist() == [0.5, 0.5, 3.0]


def test_language_accuracy(docs):
    model = op3_language_id.train(docs.where(~op3_language_id.is_held_out()))
    found = op3_language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(op3_language_id.is_held_out()).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_odd(docs, odd, empty):
    model = op3_language_id.train(docs)
    found = {r["doc_id"]: r for r in op3_language_id.identify(odd, model).collect()}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in range(4))
    assert found[9]["lang_pred"] in model.langs
    nothing = op3_language_id.train(empty)
    assert {r["lang_pred"] for r in op3_language_id.identify(odd, nothing).collect()} == {"und"}
    assert op3_language_id.identify(empty, model).count() == 0


def test_toxicity_accuracy(spark, sf_dir):
    found = op4_toxicity.query(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in found]) >= 0.9


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_levenshtein_automata():
    terms = ["moron", "idiot", "pathetic", "scum", "worthless"]
    lexicon = op4_toxicity.Lexicon(dict.fromkeys(terms, 1.0))
    rng = np.random.default_rng(1)
    words = []
    for _ in range(600):
        w = list(rng.choice(terms))
        for _ in range(rng.integers(0, 4)):
            k = rng.integers(0, len(w) + 1)
            w[k : k + rng.integers(0, 2)] = list(rng.choice(["a", "x", "", "t"]))
        words.append("".join(w) or "a")
    for w in words:
        best = min(((edit_distance(w, t), t) for t in terms if edit_distance(w, t) <= op4_toxicity.edits(len(t))), default=None)
        found = lexicon.match(w)
        assert (found is None) == (best is None)
        assert found is None or found[1] == best[0]
        assert found is None or w in lexicon.close([w])


def test_quotation_counts_less():
    model = op4_toxicity.ToxicityModel(op4_toxicity.Lexicon({"moron": 3.0}), np.array([0, 1.0, 0, 0, 0, 0, -1]))
    abuse, quote, plain = model.score(["you are a m0ron moron", 'he said "moron" in court', "fine"])
    assert abuse > quote > plain


def test_toxicity_odd(spark, odd, empty):
    labels = spark.createDataFrame([(0, 0.0), (5, 1.0)], "doc_id long, label double")
    assert op4_toxicity.scored(odd, op4_toxicity.train(odd, labels)).count() == odd.count()
    assert op4_toxicity.scored(odd, op4_toxicity.train(odd, labels.where("label > 2"))).where("score >= 0.5").count() == 0
    assert op4_toxicity.scored(empty, op4_toxicity.train(empty, labels)).count() == 0


# ---- 5, 10 duplicates


def test_exact_dedup(odd):
    rows = [(r["doc_id"], re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")) for r in odd.collect()]
    found = op5_exact_dedup.exact_dedup(odd).collect()
    assert len(found) == len(rows)
    for r in found:
        digests = [(i, b) for i, b in rows if hashlib.sha256(b.encode()).hexdigest() == r["text_sha256"]]
        ids = [i for i, _ in digests if i is not None]
        assert r["group_size"] == len(digests) and r["keep_id"] == (min(ids) if ids else None)
    assert sum(r["kept"] for r in found) == len({b for _, b in rows})
    kept = op5_exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == len({b for _, b in rows})


def test_dedup_empty(empty):
    assert op5_exact_dedup.exact_dedup(empty).count() == 0
    assert op5_exact_dedup.keep_first(empty).count() == 0
    assert op10_simhash.near_duplicates(empty).count() == 0


def simhash_brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    parts = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components_brute(prints, tau=3):
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= tau:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in prints}


def test_simhash_brute_force(docs):
    texts = texts_of(docs)
    prints = {i: simhash_brute(t) for i, t in texts.items()}
    wanted = components_brute(prints)
    for r in op10_simhash.near_duplicates(docs).collect():
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}" and r["component_id"] == wanted[r["doc_id"]]


@pytest.mark.parametrize("block", [8, 2048])
def test_simhash_dense_groups(spark, block):
    """A thick cluster around one fingerprint and chains, in one block and in many."""
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    prints = {i: centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for i in range(120)}
    prints |= {200 + i: int(x) for i, x in enumerate(rng.integers(0, 1 << 62, 60))}
    prints |= {300 + i: ((1 << (2 * i)) - 1) for i in range(12)} | {400: 0}
    df = spark.createDataFrame([(i, op10_simhash._signed(p)) for i, p in prints.items()], "doc_id long, fp long")
    found = {r["fp"]: r["component_id"] for r in op10_simhash.link_components(df, block=block).collect()}
    wanted = components_brute(prints)
    assert all(found[op10_simhash._signed(p)] == wanted[i] for i, p in prints.items())


def test_thresholds_cover():
    counts = np.full((64, 64), 25.0) + np.diag(np.full(64, 25.0))
    groups = op10_simhash.partitions(100, counts)
    assert sorted(sum(groups, [])) == list(range(64))
    t = op10_simhash.thresholds(groups, 100, counts, [50.0, 5e6, 50.0, 50.0])
    assert sum(x + 1 for x in t) == 4 and min(t) >= -1 and t[1] == min(t)


def test_simhash_odd(odd):
    found = op10_simhash.near_duplicates(odd).collect()
    assert len(found) == odd.count()
    zero = {r["component_id"] for r in found if r["fingerprint"] == "0" * 16}
    assert len(zero) == 1
    kept = op10_simhash.keep_representatives(odd)
    assert kept.columns == odd.columns


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(1000 + i, 1001 + i) for i in range(50)] + [(2000, 2001 + i) for i in range(50)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert found == {x: root(x) for x in parent}


# ---- 6 decontamination


def test_tiles_reordered():
    item = "a b c d e f g h i j k l".split()
    doc = "x g h i j k l y z a b c d e f x".split()
    found = op6_decontamination.tiles([w.encode() for w in item], [w.encode() for w in doc])
    assert sorted(found) == [(0, 9, 6), (6, 1, 6)]


def test_decontamination(spark):
    item = "The quick brown fox jumps over the lazy dog, while seven wizards watch from the old tower."
    words = item.split()
    rows = [(1, "Intro. " + item.upper() + " end"), (2, " ".join(words[8:]) + " and then some " + " ".join(words[:8])), (3, " ".join(words[:7])), (4, None), (5, ""), (6, LONG), (1, item)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(0, item), (1, "too short item"), (2, None), (3, item)], "item_id long, text string")
    found = sorted((r["doc_id"], r["item_id"], r["reordered"]) for r in op6_decontamination.contaminations(df, items).collect())
    assert found == [(1, 0, False), (1, 0, False), (1, 3, False), (1, 3, False), (2, 0, True), (2, 3, True)]
    filtered = op6_decontamination.contaminations(df, items, filter_bits=(64, 64))
    assert sorted((r["doc_id"], r["item_id"], r["reordered"]) for r in filtered.collect()) == found
    assert sorted(r["doc_id"] for r in op6_decontamination.keep_clean(df, items).collect()) == [3, 4, 5, 6]
    assert op6_decontamination.contaminations(df, items.where("item_id > 9")).count() == 0
    assert op6_decontamination.contaminations(df.where("doc_id > 9"), items).count() == 0


def test_decontamination_brute_force(spark, sf_dir):
    docs, items = texts_of(table(spark, sf_dir, "documents")), {r["item_id"]: r["text"] for r in table(spark, sf_dir, "benchmark").collect()}
    wanted = set()
    for i, item in items.items():
        a = [w.decode() for w in op6_decontamination.words(item)]
        for d, text in docs.items():
            joined = " " + " ".join(w.decode() for w in op6_decontamination.words(text)) + " "
            covered = set()
            for k in range(len(a) - 4):
                if " " + " ".join(a[k : k + 5]) + " " in joined:
                    covered.update(range(k, k + 5))
            if a and len(covered) >= 0.8 * len(a):
                wanted.add((d, i))
    assert {(r["doc_id"], r["item_id"]) for r in op6_decontamination.query(spark, sf_dir).collect()} == wanted


# ---- 7, 9 tokens


def test_sentencepiece(docs, odd, empty):
    path = op7_sentencepiece.default_path()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for df in (docs, odd.where("doc_id is not null").dropDuplicates(["doc_id"])):
        texts = texts_of(df)
        for r in op7_sentencepiece.decode(op7_sentencepiece.encode(df, path), path).collect():
            ids = library.encode(texts[r["doc_id"]])
            assert r["ids"] == ids and r["decoded"] == library.decode(ids)
        both = op7_sentencepiece.decode(op7_sentencepiece.encode(df, path), path)
        assert sorted(map(str, both.collect())) == sorted(map(str, op7_sentencepiece.round_trip(df, path).collect()))
    assert op7_sentencepiece.encode(odd, path).count() == odd.count()
    assert op7_sentencepiece.encode(empty, path).count() == 0


def test_agenda_and_lock_step_agree():
    bpe = op7_sentencepiece.BpeModel(op7_sentencepiece.default_path())
    rng = np.random.default_rng(2)
    words = ["▁" + "".join(rng.choice(list("theandéß日.,01▁"), rng.integers(0, 30))) for _ in range(500)] + ["▁" * 40, "￿"]
    assert bpe.encode_all(words) == [bpe.encode_segment(w) for w in words]


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000)
    assert unpack(pack(ids, bits), len(ids), bits).tolist() == ids.tolist()
    assert width(50257) == 16 and width(65537) == 17 and width(1) == 1


def test_token_files(spark, docs, odd, empty, tmp_path):
    path = op9_token_files.default_path()
    library = Tokenizer.from_file(path)
    for name, df in (("docs", docs), ("odd", odd), ("empty", empty)):
        folder = f"file://{tmp_path}/{name}"
        op9_token_files.write_ids(df, folder, path)
        found = op9_token_files.read_ids(spark, folder).collect()
        rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        start = 0
        assert len(found) == len(rows)
        for r, (i, text) in zip(sorted(found, key=lambda r: r["start"]), rows):
            ids = library.encode(text, add_special_tokens=False).ids + [0]
            assert (r["doc_id"], r["start"], r["ids"]) == (i, start, ids)
            start += len(ids)


def test_token_file_random_access(spark, docs, tmp_path):
    op9_token_files.write_ids(docs.limit(20), str(tmp_path / "f"), op9_token_files.default_path())
    rows = [r["ids"] for r in sorted(op9_token_files.read_ids(spark, str(tmp_path / "f")).collect(), key=lambda r: r["start"])]
    files = [PackedFile(str(p)) for p in (tmp_path / "f").glob("*.pack")]
    assert sum(f.n_ids for f in files) == sum(map(len, rows))
    first = max(files, key=lambda f: f.n_ids)
    whole = first.ids(0, first.n_ids)
    assert first.ids(3, 17).tolist() == whole[3:17].tolist() and first.ids(5, 5).tolist() == []


def test_token_digest(spark, sf_dir, docs):
    library = Tokenizer.from_file(op9_token_files.default_path())
    texts = texts_of(docs)
    for r in op9_token_files.query(spark, sf_dir).collect():
        ids = np.array(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [0], "<u4")
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


# ---- 8 HTML


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>One<p>Two <b>bold</b>\n text", "One\n\nTwo bold text"),
        ("a<br>b", "a\nb"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=3><li>x<li>y</ol>", "3. x\n4. y"),
        ("<table><tr><th>Name<th>Age<tr><td>Bob &amp; co<td>3</table>", "Name      Age\nBob & co  3"),
        ("<table><tr><td>a<td>b<tr><td colspan=2>wide cell</table>", "a  b\nwide cell"),
        ("<head><title>t</title></head><body>x<script>if(a<b){}</script><div hidden>h</div><p style='display: none'>n</p>y", "xy"),
        ("<pre>\n a\n   b</pre>", " a\n   b"),
        ("<details>zz<summary>S</summary>no</details>", "S"),
        ("a<!-- c -->b<!-- open", "ab"),
        ("<div>a</span></p>b</div>c", "a\n\nb\nc"),
        ("<td>loose</td>", "loose"),
        ("<unknown a='>'>x</unknown>", "x"),
        ("x < y <", "x < y <"),
        ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ],
)
def test_html(page, text):
    assert op8_html.render(page) == text


def test_html_pages(spark, sf_dir, empty):
    pages = table(spark, sf_dir, "pages")
    found = op8_html.extract(pages).collect()
    assert len(found) == pages.count() and all(r["text"] and "<p>" not in r["text"] and "track(" not in r["text"] for r in found)
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "<b>x"), (2, "<div>" * 20_000 + "deep")], "page_id long, html string")
    assert sorted((r["page_id"] or 0, r["text"]) for r in op8_html.extract(odd).collect()) == [(0, "x"), (1, ""), (1, ""), (2, "deep")]
    assert op8_html.extract(spark.createDataFrame([], odd.schema)).count() == 0


def test_slices():
    assert list(slices(["a" * 5, "b" * 5, "c" * 50, "d"], 10)) == [(0, 2), (2, 3), (3, 4)]
    assert list(slices([], 10)) == []


def test_exact_dedup_of_many_equal_rows(spark):
    rows = [(None, "same")] * 50 + [(5, "same ")] * 3 + [(6, "same")] + [(None, "alone")] * 4 + [(7, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = op5_exact_dedup.exact_dedup(docs).collect()
    kept = sorted((r["doc_id"] or -1, r["group_size"]) for r in found if r["kept"])
    assert len(found) == len(rows) and kept == [(-1, 4), (5, 3), (6, 51), (7, 2)]
