"""Token counts of whole texts: pieces are counted once for each distinct pre-token of the corpus, joined to
every document's pre-token frequencies, and summed. No ids are kept.

A pre-token here ends where no pattern of the library's split goes on: at white space, around a digit, between
an ASCII letter and other ASCII characters (a letter after an apostrophe stays with it: "'s"). What holds other
characters may be several of the library's, which no merge crosses. The most frequent ones (``HEAD_ROWS`` and ``HEAD_BYTES`` bound them) go to all
workers and are joined there, so no frequent word is ever shuffled; of the rest none holds more than about
one in ``HEAD_ROWS`` of all words or one in ``HEAD_BYTES`` of all bytes, and a shuffled join takes those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .shared import materialise, only, workspace
from .tokens import encoder, split

#: Pre-tokens, and their bytes, that are sent to every worker; bytes of text that are worked on at a time.
HEAD_ROWS, HEAD_BYTES, BLOCK_BYTES = 100_000, 8 << 20, 4 << 20


def _blocks(column: pa.Array) -> Iterator[tuple]:
    """Blocks of whole texts: first and last row, bytes, offsets, each text's first pre-token (n + 1), pre-tokens
    (A-Z in lower case, as these vocabularies take them) as numbers, and the distinct ones."""
    data, off = K.text_buffer(column)
    for lo, hi in K.chunks(off, BLOCK_BYTES):
        here, at = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        start, end, first = split(here, at, True, False)
        lengths = end - start
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        words = K.LOWER[here[K.SPACED[here] != 0]]
        found = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(words.tobytes())).dictionary_encode()
        yield lo, hi, here, at, first, found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _frequencies(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for b in batches:
            for *_, which, distinct in _blocks(b.column(0)):
                plain = ~own.odd(distinct.to_pylist())
                n = np.bincount(which, minlength=len(distinct))
                yield pa.record_batch([distinct.filter(pa.array(plain)), pa.array(n[plain].astype(np.int64))], names=["chunk", "freq"])

    return run


def _pieces(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for b in batches:
            n = [own.size(x) for x in b.column(0).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["chunk", "freq", "pieces"])

    return run


def _sums(tokenizer: str, head):
    """Of each row: a number of its own, the pieces of its frequent pre-tokens, and the others with frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known, row = encoder(tokenizer), head.value, TaskContext.get().partitionId() << 40
        for b in batches:
            for lo, hi, here, at, first, which, distinct in _blocks(b.column(1)):
                rows, names = hi - lo, distinct.to_pylist()
                of = np.repeat(np.arange(rows), np.diff(first))
                each = np.array([known.get(x, -1) for x in names], np.int64)[which]
                number = np.bincount(of, np.maximum(each, 0), rows).astype(np.int64)
                odd = np.bincount(of, own.odd(names)[which], rows) > 0
                raw = here.tobytes()
                if any(x.encode() in raw for x in own.special):
                    odd |= np.array([any(x.encode() in raw[i:j] for x in own.special) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
                for k in np.flatnonzero(odd).tolist():  # these depend on their whole text
                    number[k] = len(own.library(raw[at[k] : at[k + 1]].decode()))
                rare = (each < 0) & ~odd[of]
                pair, freq = np.unique(of[rare] * max(len(names), 1) + which[rare], return_counts=True)
                cut = pa.array(np.searchsorted(pair // max(len(names), 1), np.arange(rows + 1)).astype(np.int32))
                chunks = pa.ListArray.from_arrays(cut, distinct.take(pa.array(pair % max(len(names), 1))))
                times = pa.ListArray.from_arrays(cut, pa.array(freq.astype(np.int64)))
                own_rows = pa.array(np.arange(row, row + rows))
                row += rows
                yield pa.record_batch([own_rows, b.column(0).slice(lo, rows), pa.array(np.diff(at)), pa.array(number), chunks, times], names=["row", "doc_id", "n_bytes", "n", "chunk", "freq"])

    return run


def _head(pieces: DataFrame) -> dict[str, int]:
    """The pre-tokens from the least frequency on from which they keep within both bounds."""
    level = F.floor(F.log2("freq") * 2).cast("int").alias("level")  # at most 128 of them
    levels = pieces.groupBy(level).agg(F.count("*").alias("n"), F.sum(F.octet_length("chunk")).alias("bytes")).collect()
    least, n, size = None, 0, 0
    for r in sorted(levels, reverse=True):
        n, size = n + r["n"], size + r["bytes"]
        if n > HEAD_ROWS or size > HEAD_BYTES:
            break
        least = r["level"]
    if least is None:
        return {}
    found = pieces.where(F.floor(F.log2("freq") * 2) >= least).select("chunk", "pieces").toArrow()
    return dict(zip(found["chunk"].to_pylist(), found["pieces"].to_pylist(), strict=True))


def _in_worker(src: DataFrame, tokenizer: str, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for b in batches:
            _, off = K.text_buffer(b.column(1))
            yield pa.record_batch([b.column(0), pa.array(np.diff(off)), pa.array(own.counts(b.column(1)))], names=["doc_id", "n_bytes", "n_tokens"])

    return src.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit of every row; a null text is empty, repeated rows and
    null ids stay rows of their own, an empty table gives none.

    Texts whose characters or special strings make counts depend on their neighbours go to the library whole.
    So do all texts, or their chunks by a worker's own table, where the vocabulary doesn't split at white space.
    """
    spark, src = docs.sparkSession, only(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    over = (F.col("n_tokens") > limit).alias("over_limit")
    if not (encoder(tokenizer).known and encoder(tokenizer).words):
        return _in_worker(src, tokenizer, kind).select("*", over)
    at = workspace(spark, "tokencount")
    freq = src.select("text").mapInArrow(_frequencies(tokenizer), "chunk string, freq long").groupBy("chunk").agg(F.sum("freq").alias("freq"))
    pieces = materialise(freq.mapInArrow(_pieces(tokenizer), "chunk string, freq long, pieces long"), f"{at}/pieces")
    head = spark.sparkContext.broadcast(_head(pieces))
    held = src.mapInArrow(_sums(tokenizer, head), f"row long, doc_id {kind}, n_bytes long, n long, chunk array<string>, freq array<long>")
    held = materialise(held, f"{at}/rows")
    rare = held.select("row", F.explode(F.arrays_zip("chunk", "freq")).alias("x")).select("row", "x.chunk", "x.freq")
    more = rare.join(pieces.select("chunk", "pieces"), "chunk").groupBy("row").agg(F.sum(F.col("freq") * F.col("pieces")).alias("more"))
    out = held.select("row", "doc_id", "n_bytes", "n").join(more, "row", "left")
    return out.select("doc_id", "n_bytes", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_tokens")).select("*", over)
