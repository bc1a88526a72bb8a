"""Quality classifier: learned hashed word and character n-gram vectors, averaged per document, with a softmax on top.

A document is the sum of two means of learned vectors: of its word features (words and word pairs)
and of its character 3- to 5-grams inside word bounds.  Word pairs whose two words are equal share
one bucket, so repetition is visible whatever the word.  Vectors and the softmax layer are trained
together by stochastic gradient descent in numpy, one document a step.  As the average is linear,
scoring folds vectors and softmax into one weight a bucket and never forms a document vector.

Fitting uses at most ``SAMPLE`` labelled rows, chosen by hash of doc_id from the labels table alone
(the bound of what is collected and broadcast); scoring is one narrow pass over all whole texts.

Defined cases: null and empty texts have no features and get the softmax of the bias; ids whose
labels disagree or are null are not learnt from; an id with several texts is learnt from by the least of them; with no labelled row the
score is 0.5; repeated rows are scored each; a text of any length is scored whole; extra columns are ignored (kept by the
stage, whatever their names); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import U64, Words, crc_mod, mix64, one_text, slices, table

#: Documented bound of the labelled rows used for fitting.
SAMPLE = 6000
BUCKETS = 1 << 16
DIM = 16
EPOCHS = 6
RATE = 0.4
GRAMS = (3, 4, 5)
#: Bytes of text whose n-grams are held at once (a few hundred bytes of arrays for each).
SLICE = 1 << 17
THRESHOLD = 0.3


def features(texts: list[bytes]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of every word feature and of every character feature; buckets of the latter follow."""
    w = Words(texts, lower=False)
    pair_ok = np.zeros(len(w.hash), bool)
    pair_ok[1:] = w.doc[1:] == w.doc[:-1]
    prev = np.roll(w.hash, 1)
    pair = np.where(w.hash == prev, U64(7), mix64(prev * U64(3) + w.hash))[pair_ok]
    words = np.concatenate((w.hash, pair))
    word_doc = np.concatenate((w.doc, w.doc[pair_ok]))
    gap = np.concatenate(([0], np.cumsum((w.data == 32) | ((w.data >= 9) & (w.data <= 13)))))
    ends = np.zeros(len(w.data), bool)
    ends[w.offsets[1:] - 1] = True
    codes, docs = [], []
    data = w.data.astype(U64)
    for n in GRAMS:
        at = np.arange(len(w.data) - n + 1)
        at = at[gap[at + n - 1] - gap[at + 1] == 0]  # no white space strictly inside
        at = at[~ends[at]]  # the line break between two texts is in neither: a text's features are its own, whatever stands beside it
        h = np.full(len(at), n, U64)
        for i in range(n):
            h = h * U64(0x100000001B3) + data[at + i] + U64(1)
        codes.append(mix64(h) & U64(BUCKETS - 1))
        docs.append(np.searchsorted(w.offsets, at, side="right") - 1)
    return (word_doc, (words & U64(BUCKETS - 1)).astype(np.int64)), (np.concatenate(docs), np.concatenate(codes).astype(np.int64) + BUCKETS)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document, distinct buckets and their weights in the sum of the two means."""
    for part, texts in slices(batches, limit=SLICE):
        rows: list[list] = [[] for _ in texts]
        for doc, bucket in features(texts):
            order = np.argsort(doc, kind="stable")
            edge = np.searchsorted(doc[order], np.arange(len(texts) + 1))
            for i in range(len(texts)):
                b, c = np.unique(bucket[order[edge[i] : edge[i + 1]]], return_counts=True)
                rows[i].append((b.astype("<i4"), (c / max(1, c.sum())).astype("<f4")))
        yield pa.record_batch({
            "doc_id": part.column(0), "label": part.column(2),
            "bucket": pa.array([b"".join(b.tobytes() for b, _ in r) for r in rows], pa.binary()),
            "weight": pa.array([b"".join(c.tobytes() for _, c in r) for r in rows], pa.binary()),
        })


def learn(samples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fit by SGD; returns the vectors of the buckets, the softmax layer and its bias."""
    bias = np.zeros(2)
    if not samples:
        return np.zeros((2 * BUCKETS, DIM), np.float32), np.zeros((DIM, 2), np.float32), bias
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1.0 / DIM, (2 * BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 1.0, (DIM, 2)).astype(np.float32)
    share = np.clip(np.mean([y for _, _, y in samples]), 1e-3, 1 - 1e-3)
    bias[:] = [np.log(1 - share), np.log(share)]
    steps, done = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)):
            bucket, weight, y = samples[i]
            rate = RATE * (1 - done / steps)
            done += 1
            rows = vectors[bucket]
            doc = weight @ rows
            z = doc @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1.0
            grad = out @ p
            out -= rate * 0.1 * np.outer(doc, p)
            bias -= rate * 0.02 * p
            # frequent buckets share the step of a document: weights sum to two a document
            vectors[bucket] = rows - (rate * 25.0) * weight[:, None] * grad[None, :].astype(np.float32)
    return vectors, out, bias


def train(samples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> tuple[np.ndarray, float]:
    """The fitted model, folded: the log-odds of label 1 that each bucket adds, and the bias."""
    vectors, out, bias = learn(samples, seed)
    z = vectors @ out
    return (z[:, 1] - z[:, 0]).astype(np.float64), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Fit on at most ``sample`` rows of ``labels(doc_id, quality)``, joined to their whole texts."""
    known = labels.groupBy("doc_id").agg(F.min("quality").alias("lo"), F.max("quality").alias("hi"))
    known = known.where(F.col("doc_id").isNotNull() & (F.col("lo") == F.col("hi")))
    chosen = known.select("doc_id", F.col("lo").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = one_text(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "label")
    sparse = texts.mapInArrow(_sparse, "doc_id long, label int, bucket binary, weight binary")
    # one task fits the model, on no more than ``sample`` rows; only the weights come to the driver
    rows = sparse.repartition(1).mapInArrow(_train, "folded binary, bias double").collect()
    return (np.frombuffer(rows[0].folded, "<f4"), rows[0].bias) if rows else train([])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for b in batches:
        for i in range(b.num_rows):
            rows.append((b.column(0)[i].as_py(), np.frombuffer(b.column(2)[i].as_py(), "<i4"), np.frombuffer(b.column(3)[i].as_py(), "<f4"), int(b.column(1)[i].as_py() > 0)))
    rows.sort(key=lambda r: r[0])
    folded, bias = train([r[1:] for r in rows])
    yield pa.record_batch({"folded": pa.array([folded.astype("<f4").tobytes()], pa.binary()), "bias": [bias]})


def scores(texts: list[bytes], folded: np.ndarray, bias: float) -> np.ndarray:
    z = np.full(len(texts), bias)
    for doc, bucket in features(texts):
        n = np.bincount(doc, minlength=len(texts))
        z += np.bincount(doc, weights=folded[bucket], minlength=len(texts)) / np.maximum(n, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def predict(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """Score ``docs(doc_id, text)``: doc_id, score, predicted."""
    weights = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))  # fixed size: two tables of BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded, bias = weights.value
        for part, texts in slices(batches, limit=SLICE):
            p = scores(texts, folded, bias)
            yield pa.record_batch({"doc_id": part.column(0), "score": p, "predicted": (p >= THRESHOLD).astype(np.int32)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def accepted(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """The rows of ``docs`` whose text is predicted 1, with all their columns."""
    weights = docs.sparkSession.sparkContext.broadcast((model[0].astype(np.float32), model[1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded, bias = weights.value
        for part, texts in slices(batches, limit=SLICE):
            yield part.filter(pa.array(scores(texts, folded, bias) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> tuple[np.ndarray, float]:
    """The production model: learnt from labelled rows whose crc32(doc_id as text) mod 5 is not 0."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(crc_mod("doc_id", 5) != 0)
    return fit(docs, labels)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = predict(docs, quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    return accepted(docs, quality_model(spark, table(spark, sf_dir, "documents"), sf_dir))
