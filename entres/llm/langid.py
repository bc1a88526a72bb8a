"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters 1- to 3-grams of the lower-cased text are hashed into ``BUCKETS``; weights are
term frequency times inverse document frequency, scaled to unit length.  Document frequencies cover
every training text (one sparse row per bucket and task, summed before anything leaves the
executors).  The weights of the classes are fitted by follow-the-regularised-leader with elastic-net
penalties on at most ``SAMPLE`` rows chosen by hash of doc_id, a tenth of which is held back to fit
the temperature of the softmax.

Defined cases: null text and text without a letter (Unicode category L) is ``und`` with score 0; with nothing to learn
from, every text is ``und``; null lang is not learnt from; an id with several rows is learnt from by the least lang and the least text;
repeated rows are predicted each; a text of any length counts whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import U64, crc_mod, mix64, one_text, slices, table

#: Documented bound of the labelled rows used for fitting.
SAMPLE = 5000
BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.01
EPOCHS = 2
_LETTER = regex.compile(r"\p{L}")


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams of a batch and the bounds of each document's run of them."""
    low = [t.decode("utf-8", "replace").lower() for t in texts]
    chars = [np.frombuffer(("\n" + s + "\n").encode("utf-32-le"), "<u4") for s in low]
    out, size = [], np.zeros(len(texts), np.int64)
    for x in chars:
        c = np.where((x < 33) | (x == 0xA0), 32, x).astype(U64)
        h, parts = np.zeros(len(c), U64), []
        for n in range(1, max(ORDERS) + 1):
            h = h[: len(c) - n + 1] * U64(0x100000001B3) + c[n - 1 :] + U64(n) if len(c) >= n else h[:0]
            if n in ORDERS:
                parts.append((h * U64(0x9E3779B97F4A7C15)) >> U64(49))
        out.append(np.concatenate(parts))
    size = np.array([len(x) for x in out], np.int64)
    return (np.concatenate(out) if out else np.zeros(0, U64)).astype(np.int64), np.concatenate(([0], np.cumsum(size)))


def counts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per document, its distinct buckets and their counts."""
    bucket, edge = grams(texts)
    for i in range(len(texts)):
        full = np.bincount(bucket[edge[i] : edge[i + 1]], minlength=BUCKETS)
        idx = np.flatnonzero(full)
        yield idx, full[idx]


def weigh(idx: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1.0 + np.log(count)) * idf[idx]
    return v / max(1e-12, np.sqrt(v @ v))


def _df(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, n = np.zeros(BUCKETS + 1, np.int64), 0
    for _, texts in slices(batches):
        for idx, _ in counts(texts):
            seen[idx] += 1
        n += len(texts)
    seen[BUCKETS] = n
    at = np.flatnonzero(seen)
    yield pa.record_batch({"bucket": at, "n": seen[at]})


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Document frequency of every bucket over all of ``docs``; what is collected is bounded by the buckets."""
    rows = docs.select("text").mapInArrow(_df, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(BUCKETS + 1, np.int64)
    df[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return df[:BUCKETS], int(df[BUCKETS])


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        idx, val = [], []
        for i, c in counts(texts):
            idx.append(i.astype("<i4").tobytes())
            val.append(c.astype("<i4").tobytes())
        yield pa.record_batch({"doc_id": part.column(0), "lang": part.column(2), "idx": pa.array(idx, pa.binary()), "val": pa.array(val, pa.binary())})


class Ftrl:
    """FTRL-proximal for multinomial logistic regression: one pair of accumulators a bucket and class."""

    def __init__(self, classes: int):
        self.z = np.zeros((BUCKETS + 1, classes))
        self.n = np.zeros((BUCKETS + 1, classes))

    def weights(self, idx) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        w[np.abs(z) <= L1] = 0.0
        return w

    def step(self, idx: np.ndarray, x: np.ndarray, y: int) -> None:
        idx, x = np.append(idx, BUCKETS), np.append(x, 0.2)  # the last row is the bias
        w = self.weights(idx)
        p = softmax(x @ w)
        p[y] -= 1.0
        g = x[:, None] * p[None, :]
        n = self.n[idx]
        self.z[idx] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[idx] = n + g * g


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log-loss on held-back rows, on a geometric grid."""
    if not len(y):
        return 1.0
    grid = np.geomspace(0.05, 5.0, 60)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, sample: int = SAMPLE) -> dict:
    """Fit on ``docs(doc_id, text, lang)``: document frequencies on all rows, weights on the sample."""
    docs = docs.where(F.col("lang").isNotNull())
    df, n = document_frequency(docs)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    chosen = docs.groupBy("doc_id").agg(F.min("lang").alias("lang")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = one_text(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "lang")
    counted = texts.mapInArrow(_sample, "doc_id long, lang string, idx binary, val binary")
    # one task fits the model, on no more than ``sample`` rows; only weights come to the driver
    rows = counted.repartition(1).mapInArrow(_fitter(idf), "classes array<string>, w binary, t double").collect()
    if not rows:
        return {"classes": [], "idf": idf, "w": np.zeros((BUCKETS + 1, 0)), "t": 1.0}
    return {"classes": list(rows[0].classes), "idf": idf, "w": np.frombuffer(rows[0].w, "<f8").reshape(BUCKETS + 1, -1), "t": rows[0].t}


def _fitter(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
        data = []
        classes = sorted({r["lang"] for r in rows})
        for r in rows:
            idx = np.frombuffer(r["idx"], "<i4").astype(np.int64)
            data.append((idx, weigh(idx, np.frombuffer(r["val"], "<i4"), idf), classes.index(r["lang"])))
        w, t = learn(data, len(classes))
        if classes:
            yield pa.record_batch({"classes": pa.array([classes], pa.list_(pa.string())), "w": pa.array([w.astype("<f8").tobytes()], pa.binary()), "t": [t]})

    return run


def learn(data: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, float]:
    """Weights fitted by FTRL on (buckets, weights, class) rows, and the temperature fitted on a tenth held back."""
    model, rng = Ftrl(classes), np.random.default_rng(11)
    order = rng.permutation(len(data))
    back, rest = order[: len(data) // 10], order[len(data) // 10 :]
    for _ in range(EPOCHS):
        for i in rng.permutation(rest):
            model.step(*data[i])
    w = model.weights(slice(None))
    logits = np.array([data[i][1] @ w[data[i][0]] + 0.2 * w[BUCKETS] for i in back]).reshape(len(back), classes)
    return w, temperature(logits, np.array([data[i][2] for i in back], int))


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """Predict the language of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by buckets times classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        classes, idf, w, t = m["classes"], m["idf"], m["w"], m["t"]
        for part, texts in slices(batches):
            pred, score = [], []
            for text, (idx, c) in zip(texts, counts(texts), strict=True):
                if not classes or not _LETTER.search(text.decode("utf-8", "replace")):
                    pred.append("und")
                    score.append(0.0)
                    continue
                p = softmax((weigh(idx, c, idf) @ w[idx] + 0.2 * w[BUCKETS]) / t)
                k = int(np.argmax(p))
                pred.append(classes[k])
                score.append(float(p[k]))
            yield pa.record_batch({"doc_id": part.column(0), "lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = fit(docs.where(crc_mod("doc_id", 4) != 2))
    return predict(docs, model).select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
