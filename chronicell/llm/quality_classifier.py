"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Features are statistics of the whole text only. The Gaussian kernel over the standardised statistics is approximated by
cosines; the normal equations of the ridge fit are sums over rows, so each partition sends its part of the sums and
only a fixed number of them reaches the driver; calibration pools adjacent violators over a fixed grid of scores. Every
labelled row that may be learned from is used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronicell.llm.base import materialize, small_batches, table, text_or_empty
from chronicell.llm.hashing import word_hashes

FEATURES, SEED, RIDGE, BANDWIDTH = 128, 20240501, 1e-3, 3.0
BINS, LOW, HIGH = 2000, -0.5, 1.5
_SLICE = 1 << 19
#: Classes of bytes: upper, lower, digit, space, sentence marks, symbols, pipes, exclamation marks, other ASCII, beyond ASCII.
_KINDS = 10


def _kinds() -> np.ndarray:
    out = np.full(256, 8, np.int64)
    for k, chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\n\x0b\x0c\r", ".,;:?", "#*$%&<>", "|", "!")):
        out[list(chars.encode())] = k
    out[128:] = 9
    return out


_KIND = _kinds()
STATISTICS = ("log_bytes", "log_words", "word_bytes", "upper", "digits", "marks", "symbols", "pipes", "exclamations", "other", "beyond_ascii", "distinct_words", "repeated_next", "repeated_in_ten", "repeated_lines")


def statistics(texts: list[bytes]) -> np.ndarray:
    """(texts, statistics): sizes as logarithms, the rest as shares of bytes, words or lines; all 0 for an empty text."""
    n = len(texts)
    size = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    kinds = np.bincount(np.repeat(np.arange(n), size) * _KINDS + _KIND[data], minlength=n * _KINDS).reshape(n, _KINDS)
    words, counts = word_hashes([t.lower() for t in texts])
    doc = np.repeat(np.arange(n), counts)
    per_word, per_byte = 1 / np.maximum(counts, 1), 1 / np.maximum(size, 1)

    def same_as(k: int) -> np.ndarray:
        return np.append(np.zeros(min(k, len(words)), bool), (words[k:] == words[:-k]) & (doc[k:] == doc[:-k]))

    in_ten = np.zeros(len(words), bool)
    for k in range(1, 11):
        in_ten |= same_as(k)
    distinct = np.array([len(np.unique(x)) for x in np.split(words, np.cumsum(counts)[:-1])])
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    repeated = np.array([(len(x) - len(set(x))) / max(len(x), 1) for x in lines])
    count = lambda mask: np.bincount(doc[mask], minlength=n)
    return np.stack(
        [np.log1p(size), np.log1p(counts), (size - kinds[:, 3]) * per_word / 10, kinds[:, 0] * per_byte, kinds[:, 2] * per_byte, kinds[:, 4] * per_word, kinds[:, 5] * per_word, kinds[:, 6] * per_word, kinds[:, 7] * per_word, kinds[:, 8] * per_word, kinds[:, 9] * per_byte, distinct * per_word, count(same_as(1)) * per_word, count(in_ten) * per_word, repeated], 1
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        lo = size = 0
        for k in range(len(texts) + 1):
            if k == len(texts) or (size and size + len(texts[k]) > _SLICE):
                if k > lo:
                    x = statistics(texts[lo:k])
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, k - lo), lists], ["doc_id", "x"])
                lo, size = k, 0
            if k < len(texts):
                size += len(texts[k])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and x array<double>, the values of STATISTICS; one row for each row, null texts as empty ones."""
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return own.mapInArrow(_measure, "doc_id bigint, x array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def _summed(rows: DataFrame, of, size: int) -> np.ndarray:
    """The sum over all rows of ``of(x, y)``, a vector of ``size``; partitions send vectors, Spark adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of(_matrix(batch), batch.column("y").to_numpy())
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["i", "v"])

    out = np.zeros(size)
    for r in rows.mapInArrow(run, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r.i] = r.v
    return out


def _first_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])


def pool_adjacent(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Isotonic means: for bins in order with their weights and sums, the non-decreasing fit of least squares.

    The pooled value holds from the first to the last bin with weight of each pool; bins between pools are interpolated,
    those before the first and after the last pool take its value. Without any weight: 0.5.
    """
    pools: list[list[float]] = []  # weight, sum, first bin, last bin
    for k in np.flatnonzero(weight).tolist():
        pools.append([float(weight[k]), float(total[k]), k, k])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w, s, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + w, pools[-1][1] + s, pools[-1][2], last]
    if not pools:
        return np.full(len(weight), 0.5)
    at = [k for p in pools for k in p[2:]]
    return np.interp(np.arange(len(weight)), at, [p[1] / p[0] for p in pools for _ in range(2)])


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    coefficients: np.ndarray
    steps: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -5, 5)
        cos = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / self.directions.shape[1])
        return np.concatenate([cos, np.ones((len(x), 1))], 1)

    def bins(self, x: np.ndarray) -> np.ndarray:
        raw = self.features(x) @ self.coefficients
        return np.clip((raw - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.steps[self.bins(x)], 0, 1)


def fit(train: DataFrame, features: int = FEATURES, seed: int = SEED) -> QualityModel:
    """Fit on rows (x array<double>, y 0 or 1). Without any rows the model scores 0.5 everywhere."""
    d = len(STATISTICS)
    sums = _summed(train, _first_sums, 2 + 2 * d)
    n = max(sums[0], 1)
    mean = sums[2 : 2 + d] / n
    spread = np.sqrt(np.maximum(sums[2 + d :] / n - mean**2, 1e-9))
    rng = np.random.default_rng(seed)
    directions, phases = rng.normal(0, 1 / BANDWIDTH, (d, features)), rng.uniform(0, 2 * np.pi, features)
    model = QualityModel(mean, spread, directions, phases, np.zeros(features + 1), np.full(BINS, 0.5))
    if not sums[0]:
        return model
    m = features + 1
    upper = np.triu_indices(m)

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(x)
        return np.concatenate([(z.T @ z)[upper], z.T @ y])

    sums = _summed(train, equations, len(upper[0]) + m)
    gram = np.zeros((m, m))
    gram[upper] = sums[: len(upper[0])]
    gram = gram + gram.T - np.diag(np.diag(gram))
    penalty = np.append(np.full(features, RIDGE * n), 1e-9 * n)
    model.coefficients = np.linalg.solve(gram + np.diag(penalty), sums[len(upper[0]) :])

    def histogram(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = model.bins(x)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    sums = _summed(train, histogram, 2 * BINS)
    model.steps = pool_adjacent(sums[:BINS], sums[BINS:])
    return model


def score(measured: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score, a double from 0 to 1: the calibrated share of good documents among those that score alike."""
    sent = measured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sent.value.score(_matrix(batch)))], ["doc_id", "score"])

    return measured.mapInArrow(run, "doc_id bigint, score double")


def is_held_out(doc_id: str = "doc_id"):
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 modulo 3 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out, score all: doc_id, held_out, score, predicted.

    One row for each row of ``docs``; repeated rows score alike. Null quality labels teach nothing; several labels of
    an id count as their mean. Null ids are scored and never learned from. Other columns are ignored.
    """
    measured = materialize(document_statistics(docs), "document-statistics", narrow=False)
    taught = labels.filter(~is_held_out() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    train = materialize(measured.join(taught, "doc_id").select("x", F.col("y").cast("double")), "quality-training")
    scored = score(measured, fit(train))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
