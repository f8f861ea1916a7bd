"""Near-duplicates by Jaccard similarity of word shingles: SimHash trees and MinHash bands find candidates, whole sets decide.

Points whose SimHash fingerprints are linked by the vantage-point trees are checked first; what these links join need not
be compared again. Fingerprints of a similarity of 0.8 mostly differ by more bits than any tree can prune by, so
MinHash bands supply the rest. A pair of similarity 0.8 shares one of 24 bands of five MinHash values with a probability of
1 - (1 - 0.8 ** 5) ** 24 > 0.9999, a closer pair with a higher one. Equal sets are one point. Every point
of a bucket is checked against the bucket's least; then all pairs of a bucket that these links have
not joined are checked block by block, so no candidate that could connect two groups goes unchecked, while a
group of copies close to its least costs one pair for each. Similarity is computed over the sets of 64-bit hashes of all distinct shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .components import connected_components, forest
from .shared import materialise, only, text_key, workspace
from .simhash import links as tree_links
from .simhash import simhash

BANDS, VALUES = 24, 5
#: Rows of a part of a large bucket, and shingles compared at a time in a block.
BLOCK, _SLICE = 256, 1 << 13
_SEEDS = K.mix(np.arange(1, 2 * BANDS * VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, -1)
#: Bits of the filter that tells which texts' sets are wanted; in pieces as ``bitmap_construct_agg`` makes them.
_FILTER, _PIECE = 1 << 26, 1 << 15


def shingle_sets(data: np.ndarray, off: np.ndarray, shingle: int) -> list[np.ndarray]:
    """Of each text the sorted hashes of its distinct shingles; a text of fewer words, but not none, has one of them all."""
    low = K.LOWER[data]
    s, e, first = K.words(low, off, K.SPACED)
    h = K.word_hashes(low, s, e)
    grams = K.ngram_hashes(h, shingle)
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        out.append(np.unique(grams[a : b - shingle + 1] if b - a >= shingle else K.ngram_hashes(h[a:b], max(1, b - a))))
    return out


def _keys(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) for x in sets], np.int64)


def _bands(sets: list[np.ndarray]) -> np.ndarray:
    """A row of band values for each set, none of which is empty."""
    size = np.array([len(x) for x in sets])
    g, start = np.concatenate(sets), np.cumsum(size) - size
    out = np.zeros((len(sets), BANDS), np.uint64)
    for k, (seed, factor) in enumerate(_SEEDS.T):
        value = np.minimum.reduceat((g ^ seed) * (factor | np.uint64(1)), start)
        out[:, k // VALUES] = K.mix(out[:, k // VALUES] + value + np.uint64(k))
    return out.view(np.int64)


def _per_text(column: pa.Array, shingle: int) -> Iterator[list[np.ndarray]]:
    data, off = K.text_buffer(column)
    for lo, hi in K.chunks(off):
        yield shingle_sets(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], shingle)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, text_key, key (of the set of shingles), size, bands and fp of every row; a null or wordless text has no band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, size, bands = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            data, off = K.text_buffer(b.column(1))
            fps = [np.zeros(0, np.uint64)] + [simhash(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], shingle) for lo, hi in K.chunks(off)]
            for sets in _per_text(b.column(1), shingle):
                keys.append(_keys(sets))
                size.append(np.array([len(x) for x in sets], np.int64))
                some = [x for x in sets if len(x)]
                bands += [_bands(some).ravel()] if some else []
            n = np.concatenate(size)
            cut = np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(bands)))
            yield pa.record_batch([b.column(0), b.column(2), pa.array(np.concatenate(keys)), pa.array(n), listed, pa.array(np.concatenate(fps).view(np.int64))], names=["doc_id", "text_key", "key", "size", "bands", "fp"])

    src = only(docs, doc_id=id_col, text=text_col).withColumn("text_key", text_key(F.col("text")))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_key long, key long, size long, bands array<long>, fp long")


def _wanted_sets(docs: DataFrame, text_col: str, shingle: int, keys: DataFrame) -> DataFrame:
    """key and shingles (bytes) of at least the keys given; a filter of fixed size keeps most other sets back."""
    bit = keys.selectExpr(f"pmod(key, {_FILTER}L) + 1 bit")
    pieces = bit.groupBy(F.bitmap_bucket_number("bit").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    bits = np.zeros(_FILTER // 8, np.uint8)
    for r in pieces.toLocalIterator():
        bits[(r.piece - 1) * _PIECE // 8 : r.piece * _PIECE // 8] = np.frombuffer(r.bits, np.uint8)
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sets in _per_text(b.column(0), shingle):
                keys = _keys(sets)
                at = np.mod(keys, _FILTER)
                hit = (sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                one = np.unique(keys[hit], return_index=True)[1]
                some = np.flatnonzero(hit)[one]
                yield pa.record_batch([pa.array(keys[some]), pa.array([sets[i].tobytes() for i in some], pa.binary())], names=["key", "shingles"])

    return only(docs, text=text_col).mapInArrow(run, "key long, shingles binary").dropDuplicates(["key"])


def _similar(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Of the pairs u, v those whose sets have a Jaccard similarity of at least ``similar``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near[i] = both >= similar * (len(x) + len(y) - both) - 1e-9
            yield pa.record_batch([b.column(0), b.column(1)], names=["u", "v"]).filter(pa.array(near))

    one = pairs.join(sets.select(F.col("key").alias("u"), F.col("shingles").alias("x")), "u")
    two = one.join(sets.select(F.col("key").alias("v"), F.col("shingles").alias("y")), "v")
    return two.select("u", "v", "x", "y").mapInArrow(run, "u long, v long")


def _near_in(sets: list[np.ndarray], root: np.ndarray, second: np.ndarray, similar: float) -> np.ndarray:
    """The similar pairs of a block, as rows of two places: of different roots and, in a block of two parts, across them."""
    n = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    ask = np.triu(root[:, None] != root[None, :], 1)
    if second.any():
        ask &= second[:, None] != second[None, :]
    both = np.zeros((n, n), np.float32)  # counts stay below 2 ** 24 in each slice
    total = np.zeros((n, n), np.int64)
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    column = np.cumsum(times > 1) - 1  # shingles of one set alone are in no intersection
    row, at = row[times[at] > 1], column[at[times[at] > 1]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    width = int(min(_SLICE, at[-1] + 1)) if len(at) else 1
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        a, b = np.searchsorted(at, [lo, lo + width])
        held = np.zeros((n, width), np.float32)
        held[row[a:b], at[a:b] - lo] = 1
        np.matmul(held, held.T, out=both)
        total += both.astype(np.int64)
    return np.argwhere(ask & (total >= similar * (size[:, None] + size[None, :] - total) - 1e-9))


def _blocks(apart: DataFrame, sets: DataFrame, similar: float, at: str) -> DataFrame:
    """``apart``: bucket, key and root. Links u and v among similar pairs of a bucket whose roots differ.

    A bucket's rows are dealt into parts of about ``BLOCK`` rows; two parts (or one with itself) make a block, so a
    large bucket goes to many tasks and a set moves once for each part, not for each pair.
    """
    parts = materialise(apart.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("parts")), f"{at}/parts")
    rows = apart.join(parts, "bucket").selectExpr("bucket", "key", "root", "pmod(xxhash64(key), parts) i", "explode(sequence(0L, parts - 1)) j")
    rows = rows.selectExpr("bucket", "least(i, j) p", "greatest(i, j) q", "key", "root", "i > j second").join(sets, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def out(held: pa.Table) -> Iterator[pa.RecordBatch]:
            block = np.stack([held.column(i).to_numpy() for i in range(3)], 1)
            edge = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]).any(axis=1), [True]]))
            key, root = held.column(3).to_numpy(), held.column(4).to_numpy()
            second = held.column(5).to_numpy().astype(bool)
            own = [np.frombuffer(x.as_buffer(), np.uint64) for x in held.column(6)]
            u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for lo, hi in zip(edge.tolist(), edge[1:].tolist(), strict=False):
                if hi - lo > 1:
                    pair = lo + _near_in(own[lo:hi], root[lo:hi], second[lo:hi], similar)
                    u.append(key[pair[:, 0]])
                    v.append(key[pair[:, 1]])
            u, v = forest(np.concatenate(u), np.concatenate(v)) if len(u) > 1 else (u[0], v[0])
            yield pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])

        for b in batches:
            if not b.num_rows:
                continue
            if kept and [kept[-1].column(i)[-1] for i in range(3)] != [b.column(i)[0] for i in range(3)]:
                yield from out(pa.Table.from_batches(kept))
                kept = []
            block = np.stack([b.column(i).to_numpy() for i in range(3)], 1)
            change = np.flatnonzero((block[1:] != block[:-1]).any(axis=1))
            if len(change):
                cut = int(change[-1]) + 1
                yield from out(pa.Table.from_batches([*kept, b.slice(0, cut)]))
                kept = [b.slice(cut)]
            else:
                kept.append(b)
        if kept:
            yield from out(pa.Table.from_batches(kept))

    by = rows.repartition("bucket", "p", "q").sortWithinPartitions("bucket", "p", "q")
    return by.select("bucket", "p", "q", "key", "root", "second", "shingles").mapInArrow(run, "u long, v long")


def _by_trees(points: DataFrame, bits: int, at: str) -> DataFrame:
    """Candidates u and v: points of one fingerprint (each and the least), and of fingerprints that the trees link."""
    first = materialise(points.groupBy("fp").agg(F.min("key").alias("head")), f"{at}/first")
    linked = tree_links(first.select("fp"), bits)
    u, v = (first.select(F.col("fp").alias(c), F.col("head").alias(f"{c}_key")) for c in ("u", "v"))
    far = linked.join(u, "u").join(v, "v").select(F.col("u_key").alias("u"), F.col("v_key").alias("v"))
    equal = points.select("fp", "key").join(first, "fp").where("key <> head").select(F.col("head").alias("u"), F.col("key").alias("v"))
    return materialise(far.unionByName(equal), f"{at}/bytrees")


def links(docs: DataFrame, points: DataFrame, text_col: str, shingle: int, similar: float, bits: int, at: str) -> DataFrame:
    """``points``: key, size, bands and fp, one row for each key. Returns u and v: links that connect what all similar candidates connect."""
    rows = points.select("key", "size", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min(F.struct("key", "size")).alias("first"), F.max("key").alias("last")).where("first.key < last")
    shared = materialise(shared.selectExpr("bucket", "first.key head", "first.size head_size"), f"{at}/shared")
    near = materialise(rows.join(shared, "bucket"), f"{at}/near")
    trees = _by_trees(points, bits, at)
    wanted = near.select("key").unionByName(trees.select(F.col("u").alias("key"))).unionByName(trees.select(F.col("v").alias("key")))
    sets = materialise(_wanted_sets(docs, text_col, shingle, wanted), f"{at}/sets")
    close = materialise(_similar(trees, sets, similar), f"{at}/close")
    known = materialise(connected_components(close), f"{at}/known")
    a, b = known.select(F.col("node").alias("u"), F.col("root").alias("ru")), known.select(F.col("node").alias("v"), F.col("root").alias("rv"))
    stars = near.where(f"key <> head and least(size, head_size) >= {similar} * greatest(size, head_size) - 1e-9").selectExpr("head u", "key v").distinct()
    stars = stars.join(a, "u", "left").join(b, "v", "left").where("coalesce(ru, u) <> coalesce(rv, v)").select("u", "v")
    found = materialise(_similar(stars, sets, similar).unionByName(close), f"{at}/stars")
    joined = connected_components(found)
    named = near.join(joined, near.key == joined.node, "left").select("bucket", "key", F.coalesce("root", "key").alias("root"))
    named = materialise(named, f"{at}/named")
    mixed = named.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("bucket")
    mixed = materialise(mixed, f"{at}/mixed")  # of known size, like the buckets' heads: where they are few, hot buckets needn't meet
    apart = materialise(named.join(mixed, "bucket", "left_semi"), f"{at}/apart")
    return found.unionByName(_blocks(apart, sets, similar, at))


def members(docs: DataFrame, id_col: str, text_col: str, shingle: int, similar: float, bits: int) -> DataFrame:
    """doc_id, text_key, key, root (of the group) and component_id of every row of ``docs``."""
    at = workspace(docs.sparkSession, "neardup")
    marks = materialise(signatures(docs, id_col, text_col, shingle), f"{at}/marks")
    points = materialise(marks.groupBy("key").agg(F.min("doc_id").alias("least"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.min("fp").alias("fp")), f"{at}/points")
    joined = connected_components(materialise(links(docs, points.select("key", "size", "bands", "fp"), text_col, shingle, similar, bits, at), f"{at}/links"))
    rooted = points.join(joined, points.key == joined.node, "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    rooted = materialise(rooted, f"{at}/rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    member = rooted.select("key", "root").join(least, "root").select(F.col("key").alias("point"), "root", "component_id")
    return marks.select("doc_id", "text_key", "key").join(member, F.col("key") == F.col("point")).select("doc_id", "text_key", "key", "root", "component_id")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similar: float = 0.8, bits: int = 3) -> DataFrame:
    """doc_id, key and component_id (the least doc_id that links reach) of every row of ``docs``.

    Repeated rows stay repeated; a group all of whose ids are null has a null component_id; an empty table gives no rows.
    """
    return members(docs, id_col, text_col, shingle, similar, bits).select("doc_id", "key", "component_id")
