"""Quality classifier: random Fourier features, ridge regression from summed normal equations, isotonic calibration.

1. One pass over the texts turns every document into statistics (lengths, character classes, repetition, entropy).
   They are written once to the shared folder; all later steps read this small table and never the texts.
2. Random Fourier features of the standardised statistics approximate a Gaussian kernel: cos(w x + b), w and b drawn
   from a fixed seed.
3. Each task sums its part of the normal equations; a second round of tasks sums those sums, and the driver gets at
   most ``SUM_TASKS`` matrices of fixed size and solves the ridge system.
4. Raw scores of all training rows are counted in a fixed number of bins; pool-adjacent-violators on the bins gives
   the calibration curve, which is linear between bin centres.

Labels are joined by id to the statistics, all of them, so nothing is sampled.

Defined results: null counts as the empty text, which is scored like any other. Very long texts are read whole. If an
id has several labels their mean counts; null labels do not. Repeated rows train as often as they occur. Without labels
every score is 0.5, with labels of one value that value. An empty table gives no rows. Other columns never take part,
whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket, in_batches, table, text_or_empty, written

NAME = "op2_quality"
FEATURES = 256
GAMMA = 0.5
RIDGE = 1e-2
BINS = 1000
SUM_TASKS = 32
SEED = 7
_RUN = re.compile(r"([^\w\s])\1\1")
_SPACE = re.compile(r"\s")
#: A text is read in stretches of at least so many characters, each of which ends at white space.
_STRETCH = 1_000_000
N_STATS = 18


def statistics(text: str) -> list[float]:
    """The statistics of one text, all of it; long texts are read in stretches, which change no value."""
    data = np.zeros(256, np.int64)
    counts: Counter = Counter()
    repeats = runs = chars_in_words = short = lone = titled = ended = 0
    last = None
    at = 0
    while at < len(text):
        border = _SPACE.search(text, at + _STRETCH)
        end = border.start() if border else len(text)  # so no word and no run of signs crosses a border
        part, at = text[at:end], end
        data += np.bincount(np.frombuffer(part.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
        found = part.split()
        counts.update(found)
        repeats += sum(map(eq, found, found[1:])) + bool(found and found[0] == last)
        last = found[-1] if found else last
        runs += len(_RUN.findall(part))
    n_words = counts.total()
    for w, n in counts.items():
        size = len(w)
        chars_in_words += size * n
        short += n * (size <= 3)
        lone += n * (not w.isalnum() and size == 1)
        titled += n * w[:1].isupper()
        ended += n * (w[-1] in ".!?")
    lines = text.split("\n")
    n, size = max(n_words, 1), max(int(data.sum()), 1)
    upper, lower = int(data[65:91].sum()), int(data[97:123].sum()) + int(data[128:].sum())
    share = data[data > 0] / size
    symbols = int(data.sum()) - upper - lower - int(data[48:58].sum()) - int(data[9:14].sum()) - int(data[32]) - int(data[44]) - int(data[46])
    return [
        math.log1p(len(text)), math.log1p(n_words), chars_in_words / n, len(counts) / n, math.log1p(len(counts)), max(counts.values(), default=0) / n,
        upper / max(upper + lower, 1), int(data[48:58].sum()) / size, symbols / size, (int(data[44]) + int(data[46])) / n,
        float(-(share * np.log2(share)).sum()), math.log1p(len(lines)), 1 - len(set(lines)) / len(lines), repeats / n, runs / n, short / n, lone / n,
        (titled - ended) / n,
    ]


def stats_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats array<double>)."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = np.array([statistics(x) for x in batch.column(1).to_pylist()]).reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * N_STATS), pa.array(found, pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "stats"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return in_batches(rows, batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, stats array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATS)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        wave = np.cos(x @ self.frequencies + self.phases) * math.sqrt(2 / len(self.phases))
        return np.hstack([wave, x, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0, 1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the closest non-decreasing sequence."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else np.zeros(0)


def _summed(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Normal equations over all rows of (stats, label)."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    size = len(model.phases) + N_STATS + 1

    def partial(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in it:
            x = held.value.features(_matrix(batch.column(0)))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            total += np.hstack([x.T @ x, (x.T @ y)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * (size + 1))
        for batch in it:
            for part in batch.column(0):
                total += np.frombuffer(part.as_buffer(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = in_batches(rows, partial, "part binary").repartition(SUM_TASKS).mapInArrow(merge, "part binary")
    total = sum((np.frombuffer(r[0], np.float64) for r in parts.collect()), np.zeros(size * (size + 1))).reshape(size, size + 1)
    return total[:, :-1], total[:, -1]


def train(stats: DataFrame, labels: DataFrame, seed: int = SEED) -> QualityModel:
    """Fit on every row of ``stats`` (doc_id, stats) with a label in ``labels`` (doc_id, label)."""
    rows = stats.join(labels, "doc_id").select("stats", F.col("label").cast("double").alias("label"))
    rows = written(rows, "quality-train")
    sums = rows.select([F.avg(F.get("stats", F.lit(k))).alias(f"m{k}") for k in range(N_STATS)] + [F.stddev_pop(F.get("stats", F.lit(k))).alias(f"s{k}") for k in range(N_STATS)] + [F.count("*").alias("n"), F.avg("label").alias("y")]).first()
    draw = np.random.default_rng(seed)
    w, b = draw.normal(0, math.sqrt(2 * GAMMA / N_STATS), (N_STATS, FEATURES)), draw.uniform(0, 2 * math.pi, FEATURES)
    model = QualityModel(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(FEATURES + N_STATS + 1), w, b, np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    if not sums["n"]:
        return model
    if sums["y"] in (0.0, 1.0):
        model.levels = np.full(2, sums["y"])
        return model
    model.mean = np.array([sums[f"m{k}"] for k in range(N_STATS)])
    model.scale = np.array([sums[f"s{k}"] if sums[f"s{k}"] > 1e-9 else 1.0 for k in range(N_STATS)])
    gram, right = _summed(rows, model)
    model.weights = np.linalg.solve(gram + RIDGE * sums["n"] / len(gram) * np.eye(len(gram)), right)
    held = rows.sparkSession.sparkContext.broadcast(model)

    def binned(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            bins = np.clip((held.value.raw(_matrix(batch.column(0))) + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], ["bin", "label"])

    counted = in_batches(rows, binned, "bin int, label double").groupBy("bin").agg(F.avg("label"), F.count("*")).orderBy("bin").collect()
    bins, means, counts = (np.array(x, float) for x in zip(*counted))  # at most BINS rows
    model.knots, model.levels = (bins + 0.5) / BINS * 2 - 0.5, isotonic(means, counts)
    return model


def scored(stats: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) for every row of ``stats``."""
    held = stats.sparkSession.sparkContext.broadcast(model)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held.value.score(_matrix(batch.column(1))))], ["doc_id", "score"])

    return in_batches(stats.select("doc_id", "stats"), batches, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")


def label_means(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label): the mean of an id's labels that are not null."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    return rows.groupBy(F.col(id_col).alias("doc_id")).agg(F.avg(F.col(label_col).cast("double")).alias("label"))


def is_held_out(id_col: str = "doc_id") -> Column:
    return bucket(id_col, 4) == 2


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(stats_table(table(spark, sf_dir, "documents")), "quality-stats")
    labels = label_means(table(spark, sf_dir, "labels"), "quality").where(~is_held_out())
    out = scored(stats, train(stats, labels))
    return out.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
