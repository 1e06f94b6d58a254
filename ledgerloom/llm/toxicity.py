"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed words is trained from confirmed toxic texts and unlabelled text. The risk is
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with the logistic loss: what the unlabelled texts cost as negatives, less
the share that the positives among them cost; where a batch drives this below zero, the step goes against it.

Training texts are a bounded sample (``positives`` and ``unlabelled`` texts, by the hash of their doc_id), so the ids that are
joined, the features that reach the driver and the model have a proven size. Every text is scored, over its whole length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.texts import ALNUM, chunks, map_batches, schema_of, without, words
from ledgerloom.session import settle

#: bounds of the training sample, in texts; hash buckets of words
POSITIVES, UNLABELLED, BUCKETS = 4000, 16000, 1 << 18
#: what a bucket must show in the sample to be used
MIN_TEXTS, MIN_Z = 8, 4.5
STEPS, BATCH, RATE, DECAY = 1500, 512, 0.1, 1e-3


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


@dataclass
class Features:
    """Rows of (bucket, weight), one behind the other, each row of length one."""

    bucket: np.ndarray
    weight: np.ndarray
    bounds: np.ndarray


def features(bucket: np.ndarray, count: np.ndarray, row: np.ndarray, n_rows: int, use: np.ndarray) -> Features:
    some = use[bucket]
    bucket, row = bucket[some], row[some]
    bucket = (np.cumsum(use) - 1)[bucket]  # numbered among those in use
    weight = np.log1p(count[some])
    norm = np.sqrt(np.bincount(row, weight**2, n_rows))
    return Features(bucket, weight / np.maximum(norm[row], 1e-12), np.searchsorted(row, np.arange(n_rows + 1)))


def counted(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct buckets of each row with counts, row by row."""
    h, first = words(data, bounds, ALNUM)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    key, count = np.unique(row * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    return key % BUCKETS, count, key // BUCKETS


def telling(positive: np.ndarray, unlabelled: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """Buckets whose share of texts differs between both kinds by ``MIN_Z`` standard errors and that ``MIN_TEXTS`` texts have. Rare words
    would only let the classifier learn the sample, wrong labels included, by heart."""
    both = (positive + unlabelled) / (n_p + n_u)
    error = np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    z = (positive / n_p - unlabelled / n_u) / np.maximum(error, 1e-12)
    return (np.abs(z) >= MIN_Z) & (positive + unlabelled >= MIN_TEXTS)


def margins(f: Features, weights: np.ndarray, bias: float) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(weights[f.bucket] * f.weight)])
    return sums[f.bounds[1:]] - sums[f.bounds[:-1]] + bias


@dataclass
class Model:
    weights: np.ndarray
    use: np.ndarray
    bias: float


def fit(positive: Features, unlabelled: Features, prior: float, use: np.ndarray) -> Model:
    """Adam on batches of both kinds; the same result for the same input."""
    rng = np.random.Generator(np.random.PCG64(7))
    w = np.zeros(int(use.sum()) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    n_p, n_u = len(positive.bounds) - 1, len(unlabelled.bounds) - 1

    def push(f: Features, rows: np.ndarray, sign: float) -> tuple[float, np.ndarray]:
        """Mean logistic loss of rows as class ``sign``, and its gradient."""
        size = f.bounds[rows + 1] - f.bounds[rows]
        at = np.repeat(f.bounds[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        own = np.repeat(np.arange(len(rows)), size)
        z = np.bincount(own, w[f.bucket[at]] * f.weight[at], len(rows)) + w[-1]
        away = np.clip(-sign * z, -50, 50)
        loss = np.log1p(np.exp(away))
        pull = -sign / (1 + np.exp(-away)) / len(rows)
        g = np.zeros_like(w)
        g[:-1] = np.bincount(f.bucket[at], pull[own] * f.weight[at], len(w) - 1)
        g[-1] = pull.sum()
        return loss.mean(), g

    for step in range(1, STEPS + 1):
        u = rng.integers(0, n_u, BATCH)
        p = rng.integers(0, n_p, BATCH // 2)
        _, as_positive = push(positive, p, 1.0)
        r_p, less = push(positive, p, -1.0)
        r_u, more = push(unlabelled, u, -1.0)
        rest = more - prior * less
        g = prior * as_positive + rest if r_u - prior * r_p >= 0 else -rest
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        rate = RATE * (1 - step / (STEPS + 1))
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w[:-1] *= 1 - DECAY * rate
    return Model(w[:-1], use, float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """A model from the training rows of ``labels`` (doc_id, toxic) and texts of ``docs`` (doc_id, text); None without a toxic one.

    The class prior is the share of toxic rows among training labels. Null labels and null doc_ids are not used.
    """
    known = labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    n, share = known.agg(F.count(F.lit(1)), F.avg(F.col("toxic").cast("double"))).first()
    if not n or not share:
        return None
    order = F.xxhash64(F.lit("sample"), "doc_id")
    toxic = known.where("toxic = 1").select("doc_id").distinct().orderBy(order, "doc_id").limit(positives)
    free = docs.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(order, "doc_id").limit(unlabelled)
    picked = toxic.withColumn("toxic", F.lit(True)).union(free.withColumn("toxic", F.lit(False)))
    picked = picked.groupBy("doc_id").agg(F.max("toxic").alias("positive"), F.min("toxic").alias("only"))
    sample = settle(picked, "toxicity-sample")  # at most positives + unlabelled rows, of a size that Spark then knows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in chunks(batches, "text"):
            bucket, count, row = counted(data, bounds)
            cut = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cut, pa.array(x, pa.int32())) for x in (bucket, count)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *lists], ["doc_id", "positive", "only", "bucket", "count"])

    rows = docs.select("doc_id", F.col(text).alias("text")).join(sample, "doc_id").select("doc_id", "positive", "only", "text")
    got = map_batches(rows, run, "doc_id bigint, positive boolean, only boolean, bucket array<int>, count array<int>").toArrow().sort_by("doc_id").combine_chunks()
    if not len(got):
        return None
    bucket, count = (got.column(c).combine_chunks() if isinstance(got.column(c), pa.ChunkedArray) else got.column(c) for c in ("bucket", "count"))
    sizes = np.diff(np.asarray(bucket.offsets))
    row = np.repeat(np.arange(len(got)), sizes)
    bucket, count = np.asarray(bucket.flatten()).astype(np.int64), np.asarray(count.flatten()).astype(np.float64)
    is_p, only = np.asarray(got.column("positive")), np.asarray(got.column("only"))
    p, u = np.flatnonzero(is_p), np.flatnonzero(~only)
    if not len(p) or not len(u):
        return None
    use = telling(*(np.bincount(bucket[of[row]], minlength=BUCKETS) for of in (is_p, ~only)), len(p), len(u))

    def pick(rows: np.ndarray) -> Features:
        place = np.full(len(got), -1)
        place[rows] = np.arange(len(rows))
        some = place[row] >= 0
        return features(bucket[some], count[some], place[row[some]], len(rows), use)

    return fit(pick(p), pick(u), float(share), use)


def score(docs: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` with ``out``, from 0 to 1. Null, empty and wordless texts get the score of the bias alone; without a model
    every score is 0. Nothing shuffles. An input column called like the new one gives way to it."""
    docs = without(docs, out)
    if model is None:
        return docs.withColumn(out, F.lit(0.0))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in chunks(batches, text):
            bucket, count, row = counted(data, bounds)
            z = margins(features(bucket, count, row, batch.num_rows, model.use), model.weights, model.bias)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))], [*names, out])

    return map_batches(docs, run, f"{schema_of(docs)}, `{out}` double")
