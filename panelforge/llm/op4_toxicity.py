"""Toxicity: a learned lexicon in a trie, Levenshtein automata for misspellings, context windows against quotation.

1. Training rows are a sample of at most ``max_train`` labelled ids (a documented bound), chosen by a hash of the id,
   with one text each.
2. The lexicon holds the words, of any length, that toxic training texts have far more often than others
   (log-likelihood ratio of ``MIN_RATIO`` or more), with varied words before them, so that a passage copied into many
   toxic texts does not fill it. All words with that evidence are terms; the sample bounds their number.
3. A word matches a term if the Levenshtein automaton of the word, run along the trie, accepts: no edit for terms up to
   four letters, one up to seven, two beyond. States are bit sets, one for each number of edits.
4. Every match looks at the words and signs around it: inside quotation marks of its line or near a reporting word it
   counts less, near a second-person word more. A logistic model over sums of these weights gives the score.

All rows are scored on whole texts. Defined results: null and empty texts have no match and get the score of such
texts. Several labels of an id count by their mean (toxic from 0.5 on). Of rows that share an id the one with the
smallest hash of its text trains; each is scored by itself, so repeated rows get equal scores. Without labels of both
kinds the score is the share of toxic labels, 0 without any. Of terms that match a word with equally many edits the one with
the largest weight counts, then the first by its letters. An empty table
gives no rows. Other columns never take part, whatever their names.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket, in_batches, table, text_or_empty, written
from .op2_quality import label_means

NAME = "op4_toxicity"
MAX_TRAIN = 20_000
MIN_RATIO = 20.0
#: Different words before a term in toxic training texts, and how many there are in effect (by their shares) at least.
MIN_BEFORE, MIN_EFFECTIVE = 3, 2.0
WINDOW = 6
#: Words of a worker's cache, known to match or not to match.
CACHE_WORDS = 500_000
#: Pairs of a word and a term that are compared at a time.
_PAIRS = 1 << 20
_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile("[\"“”„«»\n]")
#: Words that report speech, and words that address somebody, in the languages served.
REPORTING = frozenset("said says called calls wrote writes quoted quotes quote word term according sagte schrieb nannte wort zitat dit disait écrit appelé mot dijo escribió llamó palabra".split())
ADDRESSING = frozenset("you your yours youre ur du dich dir dein deine ihr euch tu toi te ton ta vous votre tú ti usted ustedes eres vosotros".split())
N_FEATURES = 7


def edits(length: int) -> int:
    """Edits allowed for a term of so many letters."""
    return 0 if length <= 4 else 1 if length <= 7 else 2


class Lexicon:
    """Terms with weights in a trie, matched by Levenshtein automata.

    Only the weights are shipped. The trie is two flat lists, by node: its children by letter, and the term that ends there.
    """

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.below: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for term in sorted(weights):
            node = 0
            for c in term:
                if c not in self.below[node]:
                    self.below[node][c] = len(self.below)
                    self.below.append({})
                    self.term.append(None)
                node = self.below[node][c]
            self.term[node] = term
        terms = sorted(weights, key=lambda t: (len(t), t))
        sizes = np.array([len(t) for t in terms], np.int64)
        #: Letter sets of the terms of each length.
        self.by_size = {int(n): np.unique(self._letters([terms[i] for i in np.flatnonzero(sizes == n)])) for n in np.unique(sizes)}

    def __reduce__(self):
        return Lexicon, (self.weights,)

    @staticmethod
    def _letters(words: list[str]) -> np.ndarray:
        """The set of letters of each word as bits (by code point modulo 64)."""
        if not words:
            return np.zeros(0, np.uint64)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        bits = np.uint64(1) << (code & np.uint32(63)).astype(np.uint64)
        return np.bitwise_or.reduceat(bits, np.cumsum(sizes) - sizes)

    def close(self, words: list[str]) -> list[str]:
        """The words that can match some term by length and letters: an edit changes the letter set by two at most."""
        if not self.by_size or not words:
            return []
        sizes, letters = np.fromiter(map(len, words), np.int64, len(words)), self._letters(words)
        possible = np.zeros(len(words), bool)
        for size, terms in self.by_size.items():
            near = np.flatnonzero((np.abs(sizes - size) <= edits(size)) & ~possible)
            step = max(1, _PAIRS // len(terms))
            for k in range(0, len(near), step):
                some = near[k : k + step]
                possible[some] = (np.bitwise_count(letters[some, None] ^ terms) <= 2 * edits(size)).any(axis=1)
        return [words[i] for i in np.flatnonzero(possible)]

    def match(self, word: str) -> tuple[str, int] | None:
        """The term with the fewest edits (then the largest weight), and the edits."""
        n, most = len(word), edits(len(word) + 2)
        place: dict[str, int] = {}
        for i, c in enumerate(word):
            place[c] = place.get(c, 0) | 1 << i
        whole, best = (1 << (n + 1)) - 1, None
        stack = [(0, [(1 << (d + 1)) - 1 & whole for d in range(most + 1)])]
        while stack:
            node, states = stack.pop()
            term = self.term[node]
            if term is not None:
                d = next((d for d, s in enumerate(states) if s >> n & 1), None)
                if d is not None and d <= edits(len(term)):
                    rank = (d, -self.weights[term], term)
                    best = rank if best is None or rank < best else best
            for c, below in self.below[node].items():
                here, after = place.get(c, 0), []
                for d, s in enumerate(states):
                    now = (s & here) << 1
                    if d:
                        now |= states[d - 1] | states[d - 1] << 1 | after[d - 1] << 1
                    after.append(now & whole)
                if any(after):
                    stack.append((below, after))
        return None if best is None else (best[2], best[0])


def quoted_at(text: str) -> Callable[[int, int], bool]:
    """Whether a place stands in quotation marks: an odd number of marks of its line before it, and one behind it.

    The marks of the text are found once, so the work is in proportion to its length however many places are asked for.
    """
    quotes, lines, before = [], [], [0]
    for m in _MARKS.finditer(text):
        if m[0] == "\n":
            lines.append(m.start())
            before.append(len(quotes))
        else:
            quotes.append(m.start())
    before.append(len(quotes))

    def inside(a: int, b: int) -> bool:
        line = bisect_left(lines, a)
        left, right = bisect_left(quotes, a), bisect_left(quotes, b)
        return (left - before[line]) % 2 == 1 and right < before[line + 1]

    return inside


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    known: dict[str, tuple[str, int]] = field(default_factory=dict)
    passed: set[str] = field(default_factory=set)

    def __getstate__(self):
        return self.lexicon, self.weights

    def __setstate__(self, state):
        self.lexicon, self.weights = state
        self.known, self.passed = {}, set()

    def learn(self, words: set[str]) -> None:
        """Match the words not met before."""
        new = [w for w in words - self.passed if w not in self.known]
        if len(self.passed) + len(self.known) > CACHE_WORDS:
            new = list(words)
            self.passed, self.known = set(), {}
        for w in self.lexicon.close(new):
            found = self.lexicon.match(w)
            if found:
                self.known[w] = found
        self.passed.update(w for w in new if w not in self.known and len(w) <= 40)

    def features(self, texts: list[str]) -> np.ndarray:
        lowered = [t.lower() for t in texts]
        found = [set(_WORD.findall(t)) for t in lowered]
        self.learn(set().union(*found))
        out = np.zeros((len(texts), N_FEATURES))
        out[:, -1] = 1
        for i, words in enumerate(found):
            if not self.known.keys().isdisjoint(words):
                out[i, :-1] = self._context(lowered[i])
        return out

    def _context(self, text: str) -> list[float]:
        """Sums over the matches of a text, each weighed by its window."""
        spans = [(m.group(), m.start(), m.end()) for m in _WORD.finditer(text)]
        inside = quoted_at(text)
        total = top = quoted = exact = fuzzy = 0.0
        for k, (word, a, b) in enumerate(spans):
            if word not in self.known:
                continue
            term, d = self.known[word]
            around = {w for w, _, _ in spans[max(k - WINDOW, 0) : k + WINDOW + 1]}
            reported = inside(a, b) or bool(around & REPORTING)
            weight = self.lexicon.weights[term] / (1 + d) * (0.3 if reported else 1) * (1.5 if around & ADDRESSING else 1)
            total += weight
            top = max(top, weight)
            quoted += reported
            exact, fuzzy = exact + (d == 0), fuzzy + (d > 0)
        return [math.log1p(total), top, math.log1p(exact), math.log1p(fuzzy), quoted / (exact + fuzzy), 100 * total / len(spans)]

    def score(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -30, 30)))


def lexicon_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, n, before, effective): toxic and all texts with the word; different words in front of it in toxic
    texts, and the number of equally frequent ones that would vary as much."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            words, toxic, before = [], [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = _WORD.findall(text.lower())
                first = dict(zip(reversed(found), reversed(["", *found[:-1]])))
                words += first
                before += [zlib.crc32(p.encode("utf-8", "surrogatepass")) for p in first.values()]
                toxic += [int(label)] * len(first)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32()), pa.array(before, pa.int64())], ["word", "toxic", "before"])

    rows = in_batches(sample, batches, "word string, toxic int, before long")
    by_before = rows.groupBy("word", "before").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n"))
    share = F.sum("toxic") / F.sqrt(F.sum(F.col("toxic") * F.col("toxic")))
    return by_before.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"), F.count_if(F.col("toxic") > 0).alias("before"), (share * share).alias("effective"))


def learn_lexicon(sample: DataFrame, n: int, n_toxic: int) -> Lexicon:
    """The terms of (text, toxic) rows; ``n`` rows of which ``n_toxic`` are toxic."""
    share = n_toxic / n
    a, b = F.col("toxic"), F.col("n") - F.col("toxic")
    ratio = 2 * (a * F.log(a / (F.col("n") * share)) + F.when(b > 0, b * F.log(b / (F.col("n") * (1 - share)))).otherwise(0))
    terms = lexicon_counts(sample).where((a >= 3) & (a / F.col("n") >= 0.8) & (F.col("before") >= MIN_BEFORE) & (F.col("effective") >= MIN_EFFECTIVE))
    terms = terms.withColumn("ratio", ratio).where(F.col("ratio") >= MIN_RATIO).select("word", "toxic", "n").collect()
    odds = math.log(share / (1 - share))
    return Lexicon({r["word"]: math.log((r["toxic"] + 0.5) / (r["n"] - r["toxic"] + 0.5)) - odds for r in terms})


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps for a ridge-penalised logistic model; the last column is the constant and not penalised."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        step *= min(1, 4 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Fit on at most ``max_train`` labelled ids: those of ``labels`` (doc_id, label) with the smallest hashes."""
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # at most max_train pairs of numbers, whatever the size of the tables
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))
    sample = written(one.select("text", (F.col("label") >= 0.5).cast("int").alias("toxic")), "toxic-train")
    n, n_toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    constant = np.zeros(N_FEATURES)
    if not n or n_toxic in (0, n):
        constant[-1] = 30 if n and n_toxic == n else -30
        return ToxicityModel(Lexicon({}), constant)
    model = ToxicityModel(learn_lexicon(sample, n, n_toxic), constant)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = held.value.features(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), batch.column(1)], [*(f"f{k}" for k in range(N_FEATURES)), "toxic"])

    # at most max_train rows of a few numbers
    schema = ", ".join(f"f{k} double" for k in range(N_FEATURES)) + ", toxic int"
    seen = in_batches(sample, batches, schema).toArrow()
    model.weights = fit_logistic(np.stack([seen[f"f{k}"].to_numpy() for k in range(N_FEATURES)], axis=1), seen["toxic"].to_numpy())
    return model


def scored(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held.value.score(batch.column(1).to_pylist()))], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return in_batches(rows, batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def is_held_out(id_col: str = "doc_id") -> Column:
    return bucket(id_col, 5) == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = label_means(table(spark, sf_dir, "labels"), "toxic").where(~is_held_out())
    out = scored(docs, train(docs, labels))
    return out.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
