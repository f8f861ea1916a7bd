"""Language identification by the nearest centroid.

A text's vector counts its letter n-grams (three and four bytes of UTF-8, at word ends with the space beside them), hashed
into ``2 ** BITS`` cells, as (1 + log count) times the cell's inverse document frequency, scaled to length one. Frequencies
come from all rows that may be learned from; centroids, several for each language, from spherical k-means over a bounded
sample of each language's rows. A text gets the language of the centroid at the least cosine distance; one that is further
from it than the cluster's own texts reach is rejected.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textkernel as K
from .shared import materialise, only, read_file, trim, workspace

#: Bits of a cell's number, so a centroid takes 2 ** BITS * 4 bytes.
BITS = 14
#: The bound of the sample that centroids are fitted on: texts for each language (those whose ids hash lowest).
TRAIN_ROWS = 600
#: Clusters of each language, k-means steps.
CLUSTERS, STEPS = 3, 8
#: A cluster reaches as far as this share of its sample, and this many times as far again.
REACH_SHARE, REACH = 0.99, 1.15
#: Bytes of texts whose grams are counted together: a task's arrays take some two hundred times as much.
CHUNK = 1 << 18
#: Bytes of one long text that are counted at a time, and centroids that are held at a time where all of them take over MODEL_BYTES.
PIECE, BLOCK, MODEL_BYTES = 1 << 20, 64, 32 << 20
UNKNOWN = "und"

_SPACE = 0x20
_LETTER = ((K.LOWER >= 0x61) & (K.LOWER <= 0x7A)) | (np.arange(256) >= 0x80)
#: Lower-cased letters and bytes above ASCII; all else is a space.
_MAP = np.where(_LETTER, K.LOWER, _SPACE).astype(np.uint8)


def _grams(mapped: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """doc * 2 ** BITS + cell of every gram. ``mapped``: texts with a space before, between and after them; ``doc``: whose byte it is."""
    letter, out = mapped != _SPACE, []
    wide = mapped.astype(np.uint64)
    for size in (3, 4):
        n = len(mapped) - size + 1
        if n <= 0:
            continue
        inner = letter[1 : n + 1].copy()
        for k in range(2, size - 1):
            inner &= letter[k : n + k]
        at = np.flatnonzero(inner)
        code = np.full(len(at), size, np.uint64)
        for k in range(size):
            code = (code << np.uint64(8)) | wide[at + k]
        cell = (K.mix(code) >> np.uint64(64 - BITS)).astype(np.int64)
        out.append((doc[at + 1] << BITS) + cell)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[edge], np.diff(np.append(edge, len(keys)))


def _cut_text(mapped: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end at a space (a word of over PIECE bytes is cut)."""
    at = 0
    while at < len(mapped):
        end = min(at + PIECE, len(mapped))
        if end < len(mapped):
            gaps = np.flatnonzero(mapped[end : end + PIECE] == _SPACE)
            end += int(gaps[0]) if len(gaps) else 0
        yield mapped[at:end]
        at = end


def gram_counts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: the text's number, the cell and the count, in order of text and cell."""
    n = len(off) - 1
    mapped = _MAP[data]
    if n == 1 and len(data) > PIECE:
        total = np.zeros(1 << BITS, np.int64)
        for piece in _cut_text(mapped):
            own = np.concatenate([[_SPACE], piece, [_SPACE]]).astype(np.uint8)
            total += np.bincount(_grams(own, np.zeros(len(own), np.int64)), minlength=1 << BITS)
        cell = np.flatnonzero(total)
        return np.zeros(len(cell), np.int64), cell, total[cell]
    doc = np.repeat(np.arange(n), np.diff(off))
    place = np.arange(len(data)) + doc + 1
    spaced, owner = np.full(len(data) + n + 1, _SPACE, np.uint8), np.zeros(len(data) + n + 1, np.int64)
    spaced[place], owner[place] = mapped, doc
    key, count = _runs(_grams(spaced, owner))
    return key >> BITS, key & ((1 << BITS) - 1), count


def vectors(data: np.ndarray, off: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: the text's number, the cell and the value; each text's values have length one."""
    doc, cell, count = gram_counts(data, off)
    value = (1 + np.log(count)) * idf[cell]
    length = np.sqrt(np.bincount(doc, weights=value * value, minlength=len(off) - 1))
    return doc, cell, (value / length[doc]).astype(np.float32)


def _chunked(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, off = K.text_buffer(column)
    for lo, hi in K.chunks(off, CHUNK):
        yield data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
    trim()


def learnable(column: str = "doc_id") -> Column:
    """True for ids (as text) whose crc32 doesn't leave 2 when divided by 4; false for null ids."""
    return F.coalesce(F.crc32(F.encode(F.col(column).cast("string"), "utf-8")) % 4 != 2, F.lit(False))


def held_out(column: str = "doc_id") -> Column:
    """True for ids (as text) whose crc32 leaves 2 when divided by 4; false for null ids."""
    return F.coalesce(F.crc32(F.encode(F.col(column).cast("string"), "utf-8")) % 4 == 2, F.lit(False))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cell and n (texts that have it), once for each task; cell -1 counts the texts."""
    n, texts = np.zeros(1 << BITS, np.int64), 0
    for b in batches:
        texts += b.num_rows
        for data, off in _chunked(b.column(0)):
            n += np.bincount(gram_counts(data, off)[1], minlength=1 << BITS)
    cell = np.flatnonzero(n)
    yield pa.record_batch([pa.array(np.append(cell, -1)), pa.array(np.append(n[cell], texts))], names=["cell", "n"])


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """The inverse document frequency of every cell over all rows of the one column ``text``: 2 ** BITS numbers for the driver."""
    rows = texts.mapInArrow(_frequencies, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    n = {r.cell: r.n for r in rows}
    own = np.array([n.get(k, 0) for k in range(1 << BITS)], np.float64)
    return np.log((1 + n.get(-1, 0)) / (1 + own)) + 1


def cluster(x: np.ndarray, k: int = CLUSTERS, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means over rows of length one: centroids of length one, and how far each reaches.

    It starts from the row nearest to the mean and then the rows furthest from all centres so far."""

    def unit(v: np.ndarray) -> np.ndarray:
        return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)

    centres = x[[int(np.argmax(x @ unit(x.mean(axis=0))))]]
    while len(centres) < min(k, len(x)):
        near = (x @ centres.T).max(axis=1)
        if near.min() > 1 - 1e-6:  # all rows are a centre already
            break
        centres = np.vstack([centres, x[int(np.argmin(near))]])
    for _ in range(steps):
        of = np.argmax(x @ centres.T, axis=1)
        centres = unit(np.vstack([x[of == c].mean(axis=0) for c in range(len(centres)) if (of == c).any()]))
    near = x @ centres.T
    of = np.argmax(near, axis=1)
    used = np.unique(of)
    reach = [float(np.quantile(1 - near[of == c, c], REACH_SHARE)) * REACH for c in used]
    return centres[used].astype(np.float32), np.minimum(reach, 1.0)


def lowest(ids: DataFrame, rows: int) -> DataFrame:
    """Of distinct (lang, h) the ``rows`` least h of each language.

    The hashes are counted by their first 16 bits, which shows below which of these all that are wanted lie, so the task
    that orders a language's hashes gets little more than ``rows``, however many tasks there are."""
    part = F.shiftright("h", 48).alias("part")
    counts = ids.groupBy("lang", part).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("part"))  # 65,536 rows of a language at most
    last = counts.withColumn("before", upto - F.col("n")).where(F.col("before") < rows).groupBy("lang").agg(F.max("part").alias("last_part"))
    last = materialise(last, workspace(ids.sparkSession, "prefixes"))  # a row for each language, so Spark knows that it is small where it is
    some = ids.join(last, "lang").where(F.shiftright("h", 48) <= F.col("last_part"))
    first = Window.partitionBy("lang").orderBy("h")
    return some.withColumn("k", F.row_number().over(first)).where(F.col("k") <= rows).select("lang", "h")


class Model:
    """Fitted centroids: a table (lang, reach, centre) in the shared folder, and the cells' weights."""

    def __init__(self, table: DataFrame, idf: np.ndarray):
        self.centres, self.files, self.idf = table.count(), sorted(table.inputFiles()), idf


def fit(docs: DataFrame, keep: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """Learn from the rows for which ``keep`` (over the column doc_id) holds and whose text, id and language aren't null.

    Frequencies are taken over all of them. Centroids are fitted on at most ``rows`` texts of each language: of ids that hash
    lowest, one text (the least) for each. Texts without a letter-like byte teach nothing.
    """
    spark = docs.sparkSession
    at = workspace(spark, "languages")
    own = only(docs, doc_id=id_col, text=text_col, lang=lang_col).where(keep).where("doc_id is not null and text is not null and lang is not null")
    idf = document_frequencies(own.select("text"))
    own = own.select("lang", F.xxhash64(F.col("doc_id").cast("string")).alias("h"), "text")
    low = materialise(lowest(own.select("lang", "h").distinct(), rows).groupBy("lang").agg(F.max("h").alias("last")), f"{at}/sample")
    sample = own.join(low, "lang").where(F.col("h") <= F.col("last")).groupBy("lang", "h").agg(F.min("text").alias("text"))
    sent = spark.sparkContext.broadcast(idf)  # 2 ** BITS numbers

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells, values = [], []
            for data, off in _chunked(b.column(2)):
                doc, cell, value = vectors(data, off, sent.value)
                cut = np.searchsorted(doc, np.arange(len(off)))
                cells += [cell[i:j].astype("<u2").tobytes() for i, j in zip(cut, cut[1:], strict=False)]
                values += [value[i:j].astype("<f4").tobytes() for i, j in zip(cut, cut[1:], strict=False)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(cells, pa.binary()), pa.array(values, pa.binary())], names=["lang", "h", "cells", "values"])

    def learn(key: tuple, got: pd.DataFrame) -> pd.DataFrame:
        got = got[got["cells"].str.len() > 0].sort_values("h")
        if got.empty:
            return pd.DataFrame({"lang": pd.Series(dtype=object), "reach": pd.Series(dtype=float), "centre": pd.Series(dtype=object)})
        x = np.zeros((len(got), 1 << BITS), np.float32)
        for k, (c, v) in enumerate(zip(got["cells"], got["values"], strict=True)):
            x[k, np.frombuffer(c, "<u2")] = np.frombuffer(v, "<f4")
        centres, reach = cluster(x)
        return pd.DataFrame({"lang": key[0], "reach": reach, "centre": [c.astype("<f4").tobytes() for c in centres]})

    made = sample.mapInArrow(sparse, "lang string, h long, cells binary, values binary").groupBy("lang").applyInPandas(learn, "lang string, reach double, centre binary")
    return Model(materialise(made, f"{at}/centres"), idf)


def _blocks(files: list[str], size: int) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Languages, reaches and centroids (a column each), some ``size`` at a time."""
    for f in files:
        for b in pq.ParquetFile(io.BytesIO(read_file(f))).iter_batches(size, columns=["lang", "reach", "centre"]):
            centre = np.frombuffer(b"".join(b.column(2).to_pylist()), "<f4").reshape(b.num_rows, 1 << BITS)
            yield b.column(0).to_pylist(), np.array(b.column(1)), np.ascontiguousarray(centre.T)


def _nearest(doc: np.ndarray, cell: np.ndarray, value: np.ndarray, n: int, blocks) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of n texts the language of the nearest centroid (of equally near ones the least), its cosine and its reach."""
    lang, best, reach = [None] * n, np.full(n, -1.0), np.zeros(n)
    edge = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    for names, reaches, centres in blocks:
        near = np.zeros((n, len(names)), np.float32)
        for lo in range(0, centres.shape[1], 16):  # a few columns at a time
            if len(edge):
                near[doc[edge], lo : lo + 16] = np.add.reduceat(centres[cell, lo : lo + 16] * value[:, None], edge, axis=0)
        near = np.round(near.astype(np.float64), 6)
        order = sorted(range(len(names)), key=lambda c: names[c])
        at = np.array(order)[np.argmax(near[:, order], axis=1)]
        top = near[np.arange(n), at]
        for k in np.flatnonzero(top >= best):
            name = names[at[k]]
            if top[k] > best[k] or lang[k] is None or name < lang[k]:
                lang[k], best[k], reach[k] = name, top[k], reaches[at[k]]
    return lang, np.clip(best, 0, 1), reach


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[np.r_[0x41:0x5B, 0x61:0x7B]] = True


def _lettered(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which texts have a letter of any script."""
    upto = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    out = upto[off[1:]] > upto[off[:-1]]
    for k in np.flatnonzero(~out & (np.diff(off) > 0)).tolist():
        out[k] = _has_letter(data[off[k] : off[k + 1]].tobytes())
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (cosine to the nearest centroid, from 0 to 1) and rejected of every row.

    ``und``, score 0 and rejected: null texts, texts without a letter, and all texts if nothing could be learned. rejected also
    marks texts that lie further from the nearest centroid than its cluster reaches; lang_pred still names it. Repeated
    rows and null ids stay rows of their own, an empty table gives no rows, and a long text is counted whole.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.idf, model.files))  # 2 ** BITS numbers and names of files
    whole = model.centres << (BITS + 2) <= MODEL_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, files = sent.value
        held = list(_blocks(files, BLOCK)) if whole else None
        for b in batches:
            langs, scores, out = [], [], []
            for data, off in _chunked(b.column(1)):
                n, known = len(off) - 1, _lettered(data, off)
                lang, near, reach = _nearest(*vectors(data, off, idf), n, held if whole else _blocks(files, BLOCK))
                known &= np.array([x is not None for x in lang], bool)
                langs += [x if ok else UNKNOWN for x, ok in zip(lang, known, strict=True)]
                scores.append(np.where(known, near, 0.0))
                out.append(~known | (1 - near > reach))
            join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
            yield pa.record_batch([b.column(0), pa.array(langs, pa.string()), pa.array(join(scores, float)), pa.array(join(out, bool))], names=["doc_id", "lang_pred", "score", "rejected"])

    src = only(docs, doc_id=id_col, text=text_col)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")
