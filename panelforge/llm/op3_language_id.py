"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums n-gram counts in each task and then in Spark by (language, bucket), over every labelled row. The
log-probability matrix (buckets x languages) is broadcast; its size is bounded: of so many languages that it would pass
MATRIX_LIMIT, a block at a time is made, shipped and scored, and each text carries the best sum so far and the mass of all
others to the next block, so every language has its say and scores stay the same. Scoring is a sparse product in numpy: the rows of
the matrix that the n-grams of a batch name are gathered and summed for each text. Log-probabilities are whole numbers
of 2**-20, so sums are exact: they depend neither on the batch that a text stands in nor on how it is cut.

N-grams are pairs and triples of letters and word borders: texts are lower-cased and every run of other characters
counts as one border, as do both ends. Long texts are read in pieces that hand on their last two signs, so every n-gram
counts once, memory is bounded and no text is cut.

Defined results: a text that is null or has no letter (``str.isalpha``) gives ``und`` with score 0, and so does every
text if no row has a language. Equal scores go to the language first in code-point order. Rows with null language only
score. Repeated rows count as often as they occur in training. An empty table gives no rows. Other columns never take
part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket, drop_written, fresh, in_batches, table, text_or_empty, written

NAME = "op3_language_id"
BUCKETS = 1 << 15
ALPHA = 0.05
UNKNOWN = "und"
#: Most bytes of a broadcast matrix, and the most names of languages that the driver holds.
MATRIX_LIMIT, MOST_LANGUAGES = 64 << 20, 1_000_000
#: Log-probabilities are multiples of one over this.
_UNIT = 1 << 20
#: Characters that are read together; a longer text is read in pieces.
_PIECE = 200_000
_BORDER = 32
_letters: list[np.ndarray] = []


def _is_letter(code: np.ndarray) -> np.ndarray:
    if not _letters:  # by code point, all of Unicode
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0][code]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _hashed(c: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the pairs and of the triples that start at each place of ``c``."""
    shift = np.uint32(32 - buckets.bit_length() + 1)
    two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F)
    three ^= three >> np.uint32(15)
    return ((two * np.uint32(0x2545F491)) >> shift).astype(np.int64), ((three * np.uint32(0x9E3779B1)) >> shift).astype(np.int64)


def _short(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of each n-gram of short texts, in order of the texts, and which texts have letters."""
    lowered = [f" {t.lower()} " for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    code = _codes("".join(lowered))
    letter, owner = _is_letter(code), np.repeat(np.arange(len(texts)), sizes)
    stay = letter.copy()  # of each run of other characters the first one stays, as the border
    stay[1:] |= letter[:-1]
    stay[np.cumsum(sizes) - sizes] = True
    c, owner = np.where(letter, code, _BORDER)[stay].astype(np.uint32), owner[stay]
    if len(c) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), bool)
    two, three = _hashed(c, buckets)
    ok2, ok3 = owner[:-1] == owner[1:], owner[:-2] == owner[2:]
    whose = np.concatenate([owner[:-1][ok2], owner[:-2][ok3]])
    order = np.argsort(whose, kind="stable")
    return whose[order], np.concatenate([two[ok2], three[ok3]])[order], np.bincount(owner[c != _BORDER], minlength=len(texts)) > 0


def _long(text: str, buckets: int) -> Iterator[tuple[np.ndarray, bool]]:
    """(buckets of the n-grams, whether there are letters) of pieces of one text; together they are those of ``_short``."""
    lowered = text.lower()
    last, open_word = np.array([_BORDER], np.uint32), False
    for at in range(0, len(lowered) + 1, _PIECE):
        code = _codes(lowered[at : at + _PIECE])
        if at + _PIECE > len(lowered):
            code = np.append(code, np.uint32(_BORDER))  # the border at the end
        letter = _is_letter(code)
        stay = letter.copy()
        stay[1:] |= letter[:-1]
        stay[0] |= open_word
        open_word = bool(letter[-1])
        c = np.concatenate([last, np.where(letter, code, _BORDER)[stay].astype(np.uint32)])
        two, three = _hashed(c, buckets) if len(c) > 1 else (np.zeros(0, np.int64),) * 2
        yield np.concatenate([two[len(last) - 1 :], three]), bool(letter.any())
        last = c[-2:]


def grams(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, n-grams of each text) over short texts."""
    whose, found, _ = _short(texts, buckets)
    return found, np.bincount(whose, minlength=len(texts))


def gram_groups(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each n-gram in ascending order, its bucket, texts with a letter) over groups of bounded size."""
    held, size = [], 0

    def close() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        whose, found, seen = _short([texts[i] for i in held], buckets)
        index = np.array(held)
        return index[whose], found, index[seen]

    for i, text in enumerate(texts):
        if len(text) > _PIECE:
            for found, seen in _long(text, buckets):
                yield np.full(len(found), i), found, np.array([i] if seen else [], np.int64)
            continue
        held.append(i)
        size += len(text)
        if size >= _PIECE:
            yield close()
            held, size = [], 0
    if held:
        yield close()


def count_grams(rows: DataFrame, buckets: int) -> DataFrame:
    """(lang, bucket, n) summed over all rows of (text, lang)."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in it:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names = sorted(set(langs))
            at = {x: k for k, x in enumerate(names)}
            number = np.array([at[x] for x in langs], np.int64)
            for whose, found, _ in gram_groups(texts, buckets):
                used, which = np.unique(number[whose], return_inverse=True)
                sums = np.bincount(which * buckets + found, minlength=len(used) * buckets).reshape(len(used), buckets)
                for k, row in zip(used.tolist(), sums):
                    totals[names[k]] = totals.get(names[k], 0) + row
        for name, row in totals.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(row[at])], ["lang", "bucket", "n"])

    counted = in_batches(rows, batches, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class LanguageModel:
    langs: list[str]
    log_prob: np.ndarray  # buckets x languages, in units
    prior: np.ndarray  # in units

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of each text and language, and which texts have a letter."""
        total = np.zeros((len(texts), max(len(self.langs), 1)), np.int64)
        seen = np.zeros(len(texts), bool)
        for whose, found, letters in gram_groups(texts, len(self.log_prob)) if self.langs else ():
            if len(whose):
                starts = np.flatnonzero(np.append(True, whose[1:] != whose[:-1]))
                total[whose[starts]] += np.add.reduceat(self.log_prob[found], starts, axis=0).astype(np.int64)
            seen[letters] = True
        total += self.prior.astype(np.int64) if self.langs else 0
        return total, seen

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of each text."""
        total, seen = self.sums(texts)
        best = total.argmax(axis=1)
        share = 1 / np.exp((total - total.max(axis=1, keepdims=True)) / _UNIT).sum(axis=1)
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best, seen)], np.where(seen, share, 0.0)


def units(log_prob: np.ndarray) -> np.ndarray:
    """Log-probabilities as whole numbers of 1 / _UNIT."""
    return np.rint(log_prob * _UNIT).astype(np.int32)


@dataclass
class LanguageBlocks:
    """A model of more languages than one matrix holds: ``block(k)`` makes the matrix of the k-th stretch of names."""

    counts: DataFrame  # lang, bucket, n
    known: dict[str, int]
    buckets: int
    alpha: float
    per_block: int

    def __len__(self) -> int:
        return -(-len(self.known) // self.per_block)

    def block(self, k: int) -> LanguageModel:
        langs = sorted(self.known)[k * self.per_block : (k + 1) * self.per_block]
        rows = self.counts.where(F.col("lang").between(langs[0], langs[-1])) if langs else self.counts
        return _model(rows, langs, self.known, self.buckets, self.alpha)


def _model(counted: DataFrame, langs: list[str], known: dict[str, int], buckets: int, alpha: float) -> LanguageModel:
    """The model of ``langs``, whose counts are in ``counted``."""
    at = {name: i for i, name in enumerate(langs)}
    counts = np.zeros((buckets, len(langs)))
    if langs:
        sums = counted.toArrow()  # at most buckets x languages rows, as many as a matrix may have
        column = np.array([at[x] for x in sums["lang"].to_pylist()], np.int64)
        counts[sums["bucket"].to_numpy(), column] = sums["n"].to_numpy()
    log_prob = np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * buckets)
    total = sum(known.values())
    return LanguageModel(langs, np.ascontiguousarray(units(log_prob)), units(np.log(np.array([known[x] / total for x in langs]))))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS, alpha: float = ALPHA) -> LanguageModel | LanguageBlocks:
    """Fit on all rows of ``docs`` with a language."""
    if buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    rows = docs.where(F.col(lang_col).isNotNull()).select(text_or_empty(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = {r[0]: r[1] for r in rows.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()}
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of {lang_col}: that is no column of languages")
    per_block = max(MATRIX_LIMIT // (4 * buckets), 1)
    if len(known) > per_block:
        return LanguageBlocks(written(count_grams(rows, buckets), "gram-counts"), known, buckets, alpha, per_block)
    return _model(count_grams(rows, buckets), sorted(known), known, buckets, alpha)


def _by_blocks(docs: DataFrame, model: LanguageBlocks, text_col: str) -> tuple[DataFrame, str, str]:
    """``docs`` with the best language of all blocks and its score in new columns, and the names of these.

    One scan for each block, which hands its rows on in a table, so a task never holds more than one matrix.
    """
    best_, lang_, mass_ = fresh("best"), fresh("lang"), fresh("mass")
    rows = docs.withColumns({best_: F.lit(None).cast("long"), lang_: F.lit(None).cast("string"), mass_: F.lit(0.0)})
    for k in range(len(model)):
        held = docs.sparkSession.sparkContext.broadcast(model.block(k))

        def batches(it: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in it:
                block = held.value
                total, seen = block.sums([x or "" for x in batch.column(text_col).to_pylist()])
                own = total.max(axis=1)
                before = batch.column(best_)
                new_ = np.asarray(before.is_null())
                old = np.where(new_, own, before.fill_null(0).to_numpy(zero_copy_only=False))
                best = np.maximum(old, own)
                mass = batch.column(mass_).to_numpy() * np.exp((old - best) / _UNIT) + np.exp((total - best[:, None]) / _UNIT).sum(axis=1)
                at, names = total.argmax(axis=1), batch.column(lang_).to_pylist()
                langs = [(block.langs[a] if f or o < w else n) if s else UNKNOWN for a, f, o, w, n, s in zip(at, new_, old, own, names, seen)]
                mass = np.where(seen, mass, np.inf)
                columns = {best_: pa.array(best), lang_: pa.array(langs, pa.string()), mass_: pa.array(mass)}
                yield pa.RecordBatch.from_arrays([columns.get(n, c) for n, c in zip(batch.schema.names, batch.columns)], batch.schema.names)

        after = written(in_batches(rows, batches, rows.schema), "languages")
        held.destroy()
        drop_written(rows)
        rows = after
    return rows.withColumn(mass_, 1 / F.col(mass_)).drop(best_), lang_, mass_


def identify(docs: DataFrame, model: LanguageModel | LanguageBlocks, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    if isinstance(model, LanguageBlocks):
        found, lang, score = _by_blocks(rows, model, "text")
        return found.select("doc_id", F.col(lang).alias("lang_pred"), F.col(score).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            names, score = held.value.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return in_batches(rows, batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel | LanguageBlocks, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text gets a learned language with ``min_score`` or more, with all their columns."""
    if isinstance(model, LanguageBlocks):
        found, lang, score = _by_blocks(docs, model, text_col)
        return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).drop(lang, score)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            names, score = held.value.score([x or "" for x in batch.column(text_col).to_pylist()])
            keep = np.array([x != UNKNOWN for x in names], bool) & (score >= min_score)
            yield batch.filter(pa.array(keep))

    return in_batches(docs, batches, docs.schema)


def is_held_out(id_col: str = "doc_id") -> Column:
    return bucket(id_col, 3) == 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs.where(~is_held_out())))
    return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
