"""A quality classifier: logistic regression on hashed n-grams, trained by follow-the-regularised-leader
(FTRL-proximal) updates, scored as sparse dot products over whole texts.

Tokens are runs of letters and digits, and runs of other characters. Features are hashes of tokens
(one and two in a row) and of token shapes (case, kind, whether a token repeats the one before;
three in a row). Each text's counts are scaled to length one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as K
from .shared import materialise, only, workspace

#: Bits of a feature's hash: the weights take 2 ** BITS * 4 bytes wherever they are.
BITS = 18
#: Labelled rows used for training, and bytes of their texts, at most: those whose ids hash lowest. One task learns from them.
TRAIN_ROWS, TRAIN_BYTES = 6000, 64 << 20
#: A text of over this share of those bytes isn't learned from, and takes no other text's room.
LONGEST_SHARE = 64
#: FTRL-proximal's parameters, and passes over the rows.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 1e-4, 1e-4, 3

_CLASSES = np.full(256, 2, np.uint8)
_CLASSES[[9, 10, 11, 12, 13, 32]] = 0
_CLASSES[np.r_[0x30:0x3A, 0x41:0x5B, 0x61:0x7B, 0x80:0x100]] = 1
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The feature numbers of all texts and the n + 1 offsets: for each text its tokens, pairs and shapes."""
    s, e, first = K.words(data, off, _CLASSES)
    n = len(off) - 1
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    h = K.word_hashes(data, s, e)
    kind = _CLASSES[data[s]].astype(np.uint64)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    ups, size = upper[e] - upper[s], e - s
    case = np.where(ups == 0, 0, np.where((ups == size) & (size > 1), 1, 2)).astype(np.uint64)
    again = np.zeros(len(s), np.uint64)
    again[1:] = (h[1:] == h[:-1]) & (kind[1:] == 1)
    again[2:] |= ((h[2:] == h[:-2]) & (kind[2:] == 1)).astype(np.uint64) * np.uint64(2)
    again[first[:-1][first[:-1] < len(s)]] = 0
    shape = np.where(kind == 1, K.mix(np.uint64(16) + case * np.uint64(4) + again), h)
    doc = np.repeat(np.arange(n), np.diff(first))
    last = first[1:][doc]
    row = np.arange(len(s))
    parts, docs = [K.mix(h ^ np.uint64(1))], [doc]
    for grams, k, salt in ((K.ngram_hashes(h, 2), 2, 2), (K.ngram_hashes(shape, 3), 3, 3)):
        inside = row[: len(grams)] + k <= last[: len(grams)]
        parts.append(K.mix(grams[inside] ^ np.uint64(salt)))
        docs.append(doc[: len(grams)][inside])
    where = np.concatenate(docs)
    order = np.argsort(where, kind="stable")
    cell = (np.concatenate(parts)[order] >> np.uint64(64 - BITS)).astype(np.int64)
    return cell, np.searchsorted(where[order], np.arange(n + 1))


def _sparse(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, count = np.unique(cells, return_counts=True)
    value = np.sqrt(count.astype(np.float64))
    return at, value / np.sqrt((value**2).sum()) if len(at) else value


def train(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias's) by FTRL-proximal over (feature numbers, label) in the order given."""
    size = 1 << BITS
    z, n, w = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    ready = [(np.append(at, size), np.append(x, 0.3), y) for cells, y in rows for at, x in [_sparse(cells)]]
    for _ in range(epochs):
        for at, x, y in ready:
            zz, nn = z[at], n[at]
            ww = np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(nn)) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(float(ww @ x), -35, 35)))
            g = (p - y) * x
            z[at] = zz + g - (np.sqrt(nn + g * g) - np.sqrt(nn)) / ALPHA * ww
            n[at] = nn + g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> np.ndarray:
    """Learn from at most ``rows`` labelled rows, and ``size`` bytes of text, for which ``keep`` (over the column doc_id) holds.
    Of these rows, texts of over ``size / LONGEST_SHARE`` bytes are left out alone; the rest are taken in order while they fit.

    Of several labels of one id the larger counts, of several texts the least; null labels and ids don't. Without any
    labelled text all weights are zero (every score is 0.5). The labels that are used are at most ``rows`` small
    rows, so they go to the texts.
    """
    own = only(labels, doc_id=id_col, label=label_col).where("doc_id is not null and label is not null").where(keep)
    own = own.groupBy("doc_id").agg(F.max("label").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    src = only(docs, doc_id=id_col, text=text_col).join(F.broadcast(own), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    src = materialise(src, workspace(docs.sparkSession, "training"))
    sizes = src.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n")).where(F.col("n") <= size // LONGEST_SHARE)
    total = F.sum("n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))  # at most ``rows`` numbers
    some = sizes.withColumn("total", total).where(F.col("total") <= size).select("doc_id")
    src = src.join(F.broadcast(some), "doc_id", "left_semi").select("doc_id", "label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = K.text_buffer(b.column(2))
            cells, cut = features(data, off)
            packed = [cells[x:y].astype("<u4").tobytes() for x, y in zip(cut.tolist(), cut[1:].tolist(), strict=False)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(packed, pa.binary())], names=["doc_id", "label", "cells"])

    kind = src.schema["doc_id"].dataType.simpleString()

    def learn(own: pd.DataFrame) -> pd.DataFrame:
        order = own.assign(k=[zlib.crc32(str(x).encode()) for x in own["doc_id"]]).sort_values(["k", "doc_id"])
        weights = train([(np.frombuffer(c, "<u4").astype(np.int64), int(y)) for c, y in zip(order["cells"], order["label"], strict=True)])
        return pd.DataFrame({"weights": [weights.tobytes()]})

    sparse = src.mapInArrow(extract, f"doc_id {kind}, label int, cells binary")
    got = sparse.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "weights binary").first()  # at most ``rows`` rows, 1 MB of weights
    return np.frombuffer(got.weights, np.float32) if got else np.zeros((1 << BITS) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row; a null or empty text scores by the bias alone. Repeated rows and null ids stay rows
    of their own, an empty table gives no rows; a long text is worked on whole."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS + 1 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value.astype(np.float64)
        bias, size = float(w[-1]) * 0.3, 1 << BITS
        for b in batches:
            data, off = K.text_buffer(b.column(1))
            out = [np.zeros(0)]
            for lo, hi in K.chunks(off):
                cells, cut = features(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                doc = np.repeat(np.arange(hi - lo), np.diff(cut))
                # a cell's value is the root of its count over the root of the number of all
                key = np.sort(doc * size + cells)
                edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
                count = np.diff(np.append(edge, len(key)))
                dot = np.bincount(key[edge] // size, weights=np.sqrt(count) * w[key[edge] % size], minlength=hi - lo)
                total = np.maximum(np.diff(cut), 1)
                out.append(1 / (1 + np.exp(-np.clip(dot / np.sqrt(total) + bias, -35, 35))))
            yield pa.record_batch([b.column(0), pa.array(np.concatenate(out))], names=["doc_id", "score"])

    src = only(docs, doc_id=id_col, text=text_col)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double")


def held_out(column: str = "doc_id") -> Column:
    """True for ids (as text) whose crc32 leaves 1 when divided by 3; false for null ids."""
    return F.coalesce(F.crc32(F.encode(F.col(column).cast("string"), "utf-8")) % 3 == 1, F.lit(False))
