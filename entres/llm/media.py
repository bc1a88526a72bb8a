"""Media columns: texts as 8-bit WAV, short-time Fourier transforms and spectral-peak pair fingerprints.

``encode_wav`` stores a payload as an 8-bit mono WAV file in a binary column; ``fingerprint`` reads
the stored file back with the wave module and computes everything else from what it read.  Both are
narrow (no shuffle) and hold one piece of a batch, bounded in bytes, at a time.

A fingerprint is a time-coded array: each entry packs the frame of an anchor peak, its frequency
bin, the bin of a later peak and the frames between them.  A peak is a bin stronger than its four
neighbours in time and frequency, the strongest ``PEAKS`` of a frame count (lower bins first among equals); an anchor pairs with the
first ``FAN`` peaks, in order of time and then strength, of the next ``REACH`` frames.  These bounds are the definition of the feature; the
query returns its digest.

Defined cases: null or empty text is one unit of padding; repeated rows and equal texts give equal
values; a text of any length is stored whole; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .util import slices, table

UNIT = 576
FRAME = 144
HOP = FRAME // 2
RATE = 8000
PEAKS, REACH, FAN = 3, 3, 4
BINS = FRAME // 2 + 1
PAD = b"\xff"


def pad(payload: bytes) -> bytes:
    """Append bytes 255 up to a positive multiple of the unit."""
    return payload + PAD * (max(UNIT, -(-len(payload) // UNIT) * UNIT) - len(payload))


def wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def unwav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        if w.getnchannels() != 1 or w.getsampwidth() != 1:
            raise ValueError("not 8-bit mono")
        return w.readframes(w.getnframes())


_WINDOW = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(FRAME) / FRAME)


def fingerprints(payloads: list[bytes]) -> list[np.ndarray]:
    """Fingerprints of payloads whose lengths are multiples of the unit; each depends on its own payload only."""
    if not payloads:
        return []
    hops = np.array([len(p) // HOP for p in payloads])
    samples = np.frombuffer(b"".join(payloads), np.uint8).astype(np.float64) - 128.0
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    doc = np.repeat(np.arange(len(payloads)), hops)[: len(frames)]
    first = np.concatenate(([0], np.cumsum(hops)))[:-1]
    keep = np.arange(len(frames)) < (first + hops - 1)[doc]  # a frame does not reach into the next payload
    doc, place = doc[keep], (np.arange(len(frames)) - first[doc])[keep]
    spectrum = np.fft.rfft(frames[keep] * _WINDOW, axis=1)
    power = np.rint(64.0 * np.log2(1.0 + spectrum.real**2 + spectrum.imag**2)).astype(np.int32)
    power[:, 0] = 0  # the mean level is no peak
    top = power.copy()
    inner = power[:, 1:-1]
    peak = np.zeros(power.shape, bool)
    peak[:, 1:-1] = (inner > power[:, :-2]) & (inner >= power[:, 2:])
    same = doc[1:] == doc[:-1]
    peak[1:] &= ~same[:, None] | (power[1:] > power[:-1])
    peak[:-1] &= ~same[:, None] | (power[:-1] >= power[1:])
    # strongest first, lower bins first among equals: one sortable number a bin
    top = np.where(peak, power.astype(np.int64) * 1024 + (1023 - np.arange(BINS)), -1)
    best = -np.sort(-np.partition(top, BINS - PEAKS, axis=1)[:, BINS - PEAKS :], axis=1)
    bins = np.where(best >= 0, 1023 - best % 1024, -1)
    row, rank = np.nonzero(bins >= 0)
    f, t, d = bins[row, rank], place[row], doc[row]
    out_key, out_doc, out_at = [], [], []
    fan = np.zeros(len(row), np.int64)
    for step in range(1, PEAKS * (REACH + 1)):
        a, b = np.arange(len(row) - step), np.arange(step, len(row))
        dt = t[b] - t[a]
        ok = (d[a] == d[b]) & (dt >= 1) & (dt <= REACH) & (fan[a] < FAN)
        a, b, dt = a[ok], b[ok], dt[ok]
        fan[a] += 1
        out_key.append((t[a].astype(np.int64) << 32) | (f[a].astype(np.int64) << 20) | (f[b].astype(np.int64) << 8) | dt)
        out_doc.append(d[a])
        out_at.append(a * 64 + step)
    key, at, who = np.concatenate(out_key), np.concatenate(out_at), np.concatenate(out_doc)
    order = np.argsort(at, kind="stable")
    key, who = key[order], who[order]
    return np.split(key, np.searchsorted(who, np.arange(1, len(payloads))))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches, limit=2 << 20):
        yield pa.record_batch({"doc_id": part.column(0), "n_bytes": pa.array([len(t) for t in texts], pa.int64()), "media": pa.array([wav(pad(t)) for t in texts], pa.binary())})


FEATURES = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("fingerprint", pa.list_(pa.int64()))]
)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, media in slices(batches, text="media", limit=2 << 20):
        payloads = [unwav(m) for m in media]
        prints = fingerprints(payloads)
        yield pa.record_batch(
            {
                "doc_id": part.column(0), "n_bytes": part.column(1), "payload_bytes": [len(p) for p in payloads],
                "payload_sha256": [hashlib.sha256(p).hexdigest() for p in payloads], "tail_crc32": [zlib.crc32(p[-32:]) for p in payloads],
                "media_bytes": [len(m) for m in media], "media_sha256": [hashlib.sha256(m).hexdigest() for m in media],
                "feature": [f"{len(x)}:{hashlib.sha1(x.astype('<i8').tobytes()).hexdigest()}" for x in prints],
                "fingerprint": pa.array([x for x in prints], pa.list_(pa.int64())),
            },
            schema=FEATURES,
        )


def encode_wav(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with each text stored as a WAV file in the binary column ``media``."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_encode, "doc_id long, n_bytes long, media binary")


def fingerprint(media: DataFrame) -> DataFrame:
    """Read ``media(doc_id, n_bytes, media)`` back and compute digests and fingerprints of what was read."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(
        _features, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, fingerprint array<long>"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(encode_wav(table(spark, sf_dir, "documents"))).drop("fingerprint")
