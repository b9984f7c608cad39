"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network in numpy.

Every word (and every word shape: last byte, upper case, same word as before) has a sparse random index vector given by
its hash. A word's vector is its own index vector plus the index vectors of the words within two places of it, summed
over the fit sample, so words met in like company get like vectors. A document is the mean of its words' vectors, the mean
of its shapes' vectors and a few pooled figures. A two-layer network gives a logit, and a temperature fitted on fit
rows which the weights have not seen turns it into a calibrated probability.

Only the fit uses labels, of at most ``max_fit_rows`` rows (a documented bound; the rows with the smallest hashes).
Scores are computed from the whole text alone, for every row.

Defined results: null and empty texts get the score of a document without words; no labels, or labels of one kind only,
give the share of label 1 (0.5 without any) as every score; repeated labels count as often as they come; a null doc_id
is scored and not held out.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan as ts
from tessera.llm.common import small_batches, written

_BUCKET_BITS, _DIM, _SHAPES, _SHAPE_DIM = 14, 48, 1024, 48


def index_vectors(n: int, dim: int, seed: int, ones: int = 6) -> np.ndarray:
    """(n, dim) sparse ternary vectors."""
    rng = np.random.default_rng(seed)
    out = np.zeros((n, dim), np.float32)
    at = rng.integers(0, dim, (n, ones))
    np.put_along_axis(out, at, rng.choice([-1.0, 1.0], (n, ones)).astype(np.float32), 1)
    return out


_WORD_INDEX = index_vectors(1 << _BUCKET_BITS, _DIM, 1)
_SHAPE_INDEX = index_vectors(_SHAPES, _SHAPE_DIM, 2, 12)


def words_and_shapes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket, word shape and document of each word."""
    low = ts.LOWER[data]
    s, e, doc = ts.white_words(low, offsets)
    if not len(s):
        z = np.zeros(0, np.int64)
        return z, z, z
    h = ts.span_hash(low, s, e)
    upper = np.concatenate([[0], np.cumsum(low != data)])
    lower = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    shouting = ((upper[e] - upper[s]) > 0) & (lower[e] == lower[s])
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    shape = data[e - 1].astype(np.int64) * 4 + shouting * 2 + again
    return (h & np.uint64((1 << _BUCKET_BITS) - 1)).astype(np.int64), shape, doc


def context_sums(bucket: np.ndarray, doc: np.ndarray, reach: int = 2) -> np.ndarray:
    out = np.zeros_like(_WORD_INDEX)
    for k in range(1, reach + 1):
        a, b = bucket[:-k], bucket[k:]
        near = doc[:-k] == doc[k:]
        a, b = a[near], b[near]
        np.add.at(out, a, _WORD_INDEX[b])
        np.add.at(out, b, _WORD_INDEX[a])
    return out


def _mean(vectors: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, vectors.shape[1]), np.float32)
    if len(doc):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        sums = np.add.reduceat(vectors, first, axis=0)
        out[doc[first]] = sums / np.diff(np.concatenate([first, [len(doc)]]))[:, None]
    return out


def features(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    bucket, shape, doc = words_and_shapes(data, offsets)
    words = _mean(vectors[bucket], doc, n)
    shapes = _mean(_SHAPE_INDEX[shape], doc, n)
    again = _mean((shape & 1).astype(np.float32)[:, None], doc, n)
    shouting = _mean((shape >> 1 & 1).astype(np.float32)[:, None], doc, n)
    count = np.bincount(doc, minlength=n).astype(np.float32)
    norm = np.sqrt((words ** 2).sum(1, keepdims=True))
    return np.hstack([words, shapes, again, shouting, norm, np.log1p(count)[:, None]]).astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(np.float64) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 5) -> Model:
    """Adam on cross-entropy over four fifths of the rows; the temperature is fitted on the rest."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    model = Model(vectors, mean.astype(np.float32), scale.astype(np.float32))
    if len(y) < 10 or y.min() == y.max():
        model.constant = float(y.mean()) if len(y) else 0.5
        return model
    order = rng.permutation(len(y))
    fit, rest = order[len(y) // 5:], order[:len(y) // 5]
    d = x.shape[1]
    model.weights = w = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)).astype(np.float32), np.zeros(hidden, np.float32),
                         rng.normal(0, (2 / hidden) ** 0.5, hidden).astype(np.float32), np.zeros(1, np.float32)]
    m, v, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    z = (x - model.mean) / model.scale
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs) + 1e-5
        rng.shuffle(fit)
        for k in range(0, len(fit), 128):
            at = fit[k:k + 128]
            h = np.maximum(z[at] @ w[0] + w[1], 0)
            p = 1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30)))
            g = (p - y[at]).astype(np.float32) / len(at)
            gh = np.outer(g, w[2]) * (h > 0)
            grads = [z[at].T @ gh + 1e-4 * w[0], gh.sum(0), h.T @ g + 1e-4 * w[2], g.sum(keepdims=True)]
            step += 1
            for i, gr in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * gr
                v[i] = 0.999 * v[i] + 0.001 * gr * gr
                w[i] -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    out = model.logits(x[rest]).astype(np.float64)
    loss = lambda t: np.logaddexp(0, -np.where(y[rest] == 1, 1, -1) * out / t).mean()
    model.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return model


def _context_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros_like(_WORD_INDEX)
    for batch in batches:
        for _, _, data, offsets in ts.slices(batch.column(0)):
            bucket, _, doc = words_and_shapes(data, offsets)
            total += context_sums(bucket, doc)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def fit_quality(docs: DataFrame, labels: DataFrame, max_fit_rows: int = 6000, seed: int = 11) -> Model:
    """Fit on rows of ``docs`` that ``labels`` marks (quality 0 or 1) and that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    chosen = known.select("doc_id", F.col("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "quality").limit(max_fit_rows)
    chosen = written(chosen, "fit")  # at most max_fit_rows rows, so it may be broadcast
    sample = written(docs.select("doc_id", F.col("text").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality"), "fit")
    few = sample.select("text").coalesce(8)
    sums = np.zeros_like(_WORD_INDEX)
    for row in few.mapInArrow(ts.tidy(_context_batches), "sums binary").toLocalIterator():  # one matrix of fixed size per task
        sums += np.frombuffer(row.sums, np.float32).reshape(sums.shape)
    vectors = _WORD_INDEX + sums / np.maximum(np.sqrt((sums ** 2).sum(1, keepdims=True)), 1) * 2
    model = Model(vectors.astype(np.float32), np.zeros(1), np.ones(1))
    rows = sample.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "quality").select("quality", pooled_column(model)(F.col("text")).alias("x"))
    got = rows.toPandas()
    if not len(got):
        model.constant = 0.5
        return model
    return train(np.stack(got["x"].to_numpy()).astype(np.float32), got["quality"].to_numpy(), model.vectors)


def pooled_column(model: Model):
    vectors = model.vectors

    @F.arrow_udf("array<float>")
    def pooled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = np.vstack([features(data, offsets, vectors) for _, _, data, offsets in ts.slices(texts)])
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))

    return pooled


def score_column(spark, model: Model):
    """The model as a column function of the text. The model is of fixed size and shipped as a broadcast variable."""
    shared = spark.sparkContext.broadcast(pickle.dumps(model))

    def work(batches):
        model = pickle.loads(shared.value)
        for texts in batches:
            parts = [model.score(features(data, offsets, model.vectors)) for _, _, data, offsets in ts.slices(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return ts.tidy(work)(batches)

    return score.asNondeterministic()  # else the planner may repeat it for each use of the score


def quality_scores(docs: DataFrame, labels: DataFrame, max_fit_rows: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    small_batches(docs.sparkSession)
    model = fit_quality(docs, labels, max_fit_rows)
    score = score_column(docs.sparkSession, model)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    out = docs.select("doc_id", held.alias("held_out"), score(F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
