"""Quality classifier: random-indexing word vectors pooled by document, and a two-layer network.

Every token bucket has a sparse random index vector, made from a seed. Over a bounded sample of
labelled documents a bucket's context vector sums the index vectors of its neighbours within their document, in whole numbers; scaled to unit
length it is the bucket's word vector (buckets that the sample lacks keep their index vector). A
document is the mean of its tokens' vectors with a few figures of the same pooling (length of the
mean, number and repetition of tokens). A network with one hidden layer is trained in numpy on the
driver, and a temperature, fitted on a part of the sample that it doesn't train on, calibrates its
probabilities. Every text is scored whole.

Bounds: SAMPLE labelled documents are learned from, VECTOR_SAMPLE of them for the vectors; both are chosen by a hash of the id. Without
two classes to learn from, all scores are the smoothed share of label 1. The same tables give the same scores, however they are partitioned.

Null texts count as empty, and an empty text has a score like any other. A null id is in no fold that is learned from. Labels other than 0 and 1 and null labels
are passed over, repeated labels of an id count as the largest, and of repeated ids the smallest text is learned from; every row is scored. Equal texts get equal
scores. Empty tables: no rows, or nothing learned. Columns of other names, ``score`` and ``predicted`` among them, are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantora.llm.common import crc_mod, give_back, map_batches, slices, table

TOKEN = re.compile(r"[^\W\d_]+|\d+|_+|[^\w\s]+")
BUCKETS, DIM, NONZERO, REACH = 1 << 14, 32, 4, 2
SAMPLE, VECTOR_SAMPLE = 12_000, 4_000
HIDDEN, EPOCHS, RATE, DECAY = 24, 400, 0.02, 1e-4
#: Tokens whose buckets a Python worker remembers.
CACHE = 200_000
FIGURES = 5
#: Pairs of neighbours whose signs are added up in one go.
PAIRS = 1 << 15


class Buckets:
    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > CACHE:
            known.clear()
        tokens = TOKEN.findall(text.lower())
        try:
            return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            for t in tokens:
                if t not in known:
                    known[t] = zlib.crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS
            return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))


def index_signs(seed: int = 9) -> np.ndarray:
    """For each bucket NONZERO entries of 1 or -1, all others 0."""
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS, DIM), np.int64)
    at = rng.random((BUCKETS, DIM)).argsort(1)[:, :NONZERO]
    np.put_along_axis(out, at, rng.choice([-1, 1], (BUCKETS, NONZERO)), 1)
    return out


def contexts(texts: list[np.ndarray], signs: np.ndarray, into: np.ndarray) -> None:
    """Add the signs of the neighbours of each token to its row; each of ``texts`` (bucket ids) by itself. All in whole numbers, so that
    neither the order of texts nor their batches change a sum."""
    gap = np.full(REACH, -1)
    ids = np.concatenate([np.empty(0, np.int64), *(x for t in texts for x in (t, gap))])
    for k in range(1, REACH + 1):
        one, two = ids[:-k], ids[k:]
        inside = (one >= 0) & (two >= 0)
        one, two = one[inside], two[inside]
        every, times = np.unique(np.concatenate([one * BUCKETS + two, two * BUCKETS + one]), return_counts=True)
        for at in range(0, len(every), PAIRS):
            word, near = np.divmod(every[at : at + PAIRS], BUCKETS)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            into[word[starts]] += np.add.reduceat(signs[near] * times[at : at + PAIRS, None], starts, 0)


def unit(sums: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Word vectors: sums of unit length; a bucket without any has its index vector."""
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.where(length > 0, sums / np.where(length > 0, length, 1), signs / NONZERO**0.5).astype(np.float32)


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of one document. A text without tokens: zeros."""
    out = np.zeros(DIM + FIGURES)
    if n := len(ids):
        counts = np.bincount(ids, minlength=BUCKETS)
        at = np.flatnonzero(counts)
        mean = counts[at].astype(np.float32) @ vectors[at] / n
        same = float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0
        out[:DIM] = mean
        out[DIM:] = np.linalg.norm(mean), np.log1p(n), len(at) / n, counts.max() / n, same
    return out


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float
    prior: float
    trained: bool

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(features), self.prior)
        hidden = np.tanh((features - self.mean) / self.scale @ self.w1 + self.b1)
        return 1 / (1 + np.exp(-np.clip((hidden @ self.w2 + self.b2) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, seed: int = 3) -> Model:
    """The network on features ``x`` and labels ``y`` (0 or 1); every fifth row fits the temperature."""
    prior = (float(y.sum()) + 1) / (len(y) + 2)
    k = x.shape[1] if x.ndim == 2 else DIM + FIGURES
    rng = np.random.default_rng(seed)
    m = Model(vectors, np.zeros(k), np.ones(k), rng.normal(0, k**-0.5, (k, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0, 1.0, prior, False)
    held = np.arange(len(y)) % 5 == 4
    tx, ty = x[~held], y[~held]
    if len(np.unique(ty)) < 2:
        return m
    m.mean, m.scale, m.trained = tx.mean(0), tx.std(0) + 1e-6, True
    z = (tx - m.mean) / m.scale
    weight = 0.5 / np.where(ty == 1, ty.mean(), 1 - ty.mean())  # both classes count alike ...
    weight = np.sqrt(weight)  # ... halfway
    weight /= weight.sum()
    b2 = np.zeros(1)
    state = [(p, np.zeros_like(p), np.zeros_like(p)) for p in (m.w1, m.b1, m.w2, b2)]
    for step in range(1, EPOCHS + 1):
        hidden = np.tanh(z @ m.w1 + m.b1)
        p = 1 / (1 + np.exp(-np.clip(hidden @ m.w2 + b2[0], -40, 40)))
        d = (p - ty) * weight
        back = d[:, None] * m.w2 * (1 - hidden**2)
        rate = RATE * (1 - step / (EPOCHS + 1))
        for (value, first, second), g in zip(state, (z.T @ back + DECAY * m.w1, back.sum(0), hidden.T @ d + DECAY * m.w2, np.array([d.sum()])), strict=True):
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            value -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    m.b2 = float(b2[0])
    if len(np.unique(y[held])) == 2:
        logit = np.tanh((x[held] - m.mean) / m.scale @ m.w1 + m.b1) @ m.w2 + m.b2
        grid = np.geomspace(0.25, 8, 60)
        loss = [np.logaddexp(0, np.where(y[held] == 1, -1, 1) * logit / t).mean() for t in grid]
        m.temperature = float(grid[int(np.argmin(loss))])
    return m


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, vector_sample: int = VECTOR_SAMPLE) -> Model:
    """Learn from rows of ``labels`` (doc_id, quality) -- at most ``sample`` ids, chosen by a hash -- and their
    texts. Repeated labels of an id count as the largest; of repeated ids the smallest text is taken."""
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # at most `sample` rows of 12 bytes: a proven bound for the broadcast
    chosen = chosen.orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("quality").alias("quality"))
    signs = index_signs()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, sums = Buckets(), np.zeros((BUCKETS, DIM), np.int64)
        for b in batches:
            for part in slices(b, 1 << 20):
                contexts([buckets.of(t) for t in part.column("text").to_pylist()], signs, sums)
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    few = rows.where(F.pmod(F.xxhash64(F.lit("vectors"), "doc_id"), F.lit(sample)) < vector_sample).select("text").repartition(4)
    # 4 partitions, 4 MB each
    sums = sum((np.frombuffer(r["sums"], np.int64).reshape(BUCKETS, DIM) for r in few.mapInArrow(add_up, "sums binary").collect()), np.zeros((BUCKETS, DIM), np.int64))
    vectors = unit(sums, signs)
    # as Arrow: rows of Python numbers take four times as much of the driver's memory
    got = features(rows, vectors, ["quality"]).toArrow().sort_by("doc_id")
    x = np.array(got["x"].combine_chunks().flatten(), float).reshape(got.num_rows, DIM + FIGURES)
    model = train(x, np.array(got["quality"], float), vectors)
    del got, x
    give_back()
    return model


def features(docs: DataFrame, vectors: np.ndarray, more: list[str]) -> DataFrame:
    """(doc_id, *more, x) per row."""
    sent = docs.sparkSession.sparkContext.broadcast(vectors)
    kept = docs.select("doc_id", *more, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "text") + ", x array<double>"

    def make() -> Callable:
        buckets, v = Buckets(), sent.value

        def run(b: pa.RecordBatch) -> pa.RecordBatch:
            x = [pooled(buckets.of(t or ""), v) for t in b.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", *more)] + [pa.array(x, pa.list_(pa.float64()))], ["doc_id", *more, "x"])

        return run

    return map_batches(kept, make, schema)


def classify(docs: DataFrame, model: Model, keep_columns: bool = False) -> DataFrame:
    """(doc_id, score, predicted) per row; with ``keep_columns``, all columns of ``docs`` of the rows predicted 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        buckets, m = Buckets(), sent.value

        def run(b: pa.RecordBatch) -> pa.RecordBatch | None:
            if not b.num_rows:
                return None
            score = m.score(np.array([pooled(buckets.of(t or ""), m.vectors) for t in b.column("text").to_pylist()]))
            if keep_columns:
                return b.filter(pa.array(score >= 0.5))
            return pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score, pa.float64()), pa.array(score >= 0.5).cast(pa.int32())], ["doc_id", "score", "predicted"])

        return run

    return map_batches(docs if keep_columns else docs.select("doc_id", "text"), make, docs.schema if keep_columns else "doc_id long, score double, predicted int")


def learn_fold(docs: DataFrame, labels: DataFrame) -> Model:
    """The fixed fold: labels of ids whose crc32 modulo 3 is not 1."""
    return learn(docs, labels.where(crc_mod("doc_id", 3) != 1))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = learn_fold(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model).select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")
