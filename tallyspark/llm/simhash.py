"""SimHash near-duplicates: fingerprints, exact Hamming links by vantage-point trees, groups.

Of two 64-bit fingerprints within ``bits`` bits one half of 32 bits differs in at most half as many. Each half has a
vantage-point tree (vptree.py) of its own, built from a bounded sample of the fingerprints: its leaves are shards, a fingerprint
has one home in each tree, and visits the shards whose boundary its ball crosses. Inside a shard a further tree prunes before the
full distance is checked. What a shard holds beyond ``PART_ROWS`` is dealt into parts that are compared two by two in
separate tasks. Every link is found, for any number of bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from . import vptree
from .components import connected_components, forest
from .shared import materialise, one_of_each, only, text_key, workspace

#: Fingerprints of a shard (a leaf) as far as levels allow, levels at most, and the sample that trees are built from.
SHARD_ROWS, LEVELS, SAMPLE = 2000, 14, 1 << 16
#: Fingerprints of a shard before it is dealt into parts.
PART_ROWS = 50_000
#: Linked pairs that a task holds before it keeps only those that connect.
_HELD = 1 << 22


def simhash(data: np.ndarray, offsets: np.ndarray, shingle: int, seed: int = 42) -> np.ndarray:
    """Unsigned 64-bit fingerprints of texts: a bit is set if over half of the shingles' XXH64 have it."""
    low = K.LOWER[data]
    starts, ends, first = K.words(low, offsets, K.SPACED)
    n = len(offsets) - 1
    out = np.zeros(n, np.uint64)
    if not len(starts):
        return out
    word = K.SPACED[low].astype(bool)
    keep = word.copy()
    keep[1:] |= word[:-1]  # and the one byte after a word, which becomes the space
    place = np.cumsum(keep) - 1
    low[~word] = 32
    joined = low[keep]
    ws, we = place[starts], place[ends - 1] + 1
    count = np.diff(first)
    m = np.where(count >= shingle, count - shingle + 1, np.minimum(count, 1))
    before = np.cumsum(m) - m
    doc = np.repeat(np.arange(n), m)
    at = first[doc] + np.arange(len(doc)) - before[doc]
    h = K.xxh64(joined, ws[at], we[at + np.minimum(count, shingle)[doc] - 1], seed)
    some = np.flatnonzero(m)
    votes = np.zeros((len(some), 64), np.int64)
    step = 1 << 16  # rows of unpacked bits at a time
    for lo in range(0, len(h), step):
        hi = min(len(h), lo + step)
        a = int(np.searchsorted(before[some], lo, side="right")) - 1
        b = int(np.searchsorted(before[some], hi, side="left"))
        bits = np.unpackbits(h[lo:hi].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes[a:b] += np.add.reduceat(bits, np.maximum(before[some[a:b]] - lo, 0), axis=0, dtype=np.int32)
    out[some] = np.packbits(2 * votes > m[some][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fp (the fingerprint as a signed long) of every row; a null or wordless
    text has fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = K.text_buffer(b.column(1))
            fps = [np.zeros(0, np.uint64)]
            fps += [simhash(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], shingle) for lo, hi in K.chunks(off)]
            yield pa.record_batch([b.column(0), b.column(2), pa.array(np.concatenate(fps).view(np.int64))], names=["doc_id", "text_key", "fp"])

    src = only(docs, doc_id=id_col, text=text_col).withColumn("text_key", text_key(F.col("text")))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_key long, fp long")


def trees(fps: DataFrame, bits: int) -> list[vptree.Tree]:
    """A tree for each half, from some SAMPLE fingerprints (those that hash below what so many of all do; never twice as many)."""
    n = fps.count()
    levels = int(np.clip(np.ceil(np.log2(max(n, 1) / SHARD_ROWS)), 0, LEVELS))
    low = F.xxhash64("fp") <= F.lit(min((1 << 63) - 1, int(SAMPLE / max(n, 1) * 2.0**64) - (1 << 63))).cast("long")
    sample = fps.where(low).limit(2 * SAMPLE).toArrow().column(0).to_numpy() if levels else np.zeros(0, np.int64)
    halves = _halves(np.sort(sample).view(np.uint64))
    return [vptree.build(h, levels, bits // 2) for h in halves]


def _halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32)


def shards(fps: DataFrame, forest_: list[vptree.Tree], bits: int) -> DataFrame:
    """half, shard, fp and visits: a row for each home of a fingerprint and each shard that it visits."""
    sent = fps.sparkSession.sparkContext.broadcast(forest_)  # two trees of 2 ** LEVELS nodes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for k, (half, tree) in enumerate(zip(_halves(fp), sent.value, strict=True)):
                row, leaf, home, _ = vptree.place(half, tree, bits // 2)
                yield pa.record_batch([pa.array(np.full(len(row), k, np.int32)), pa.array(leaf.astype(np.int32)), pa.array(fp[row].view(np.int64)), pa.array(~home)], names=["half", "shard", "fp", "visits"])

    return fps.select("fp").mapInArrow(run, "half int, shard int, fp long, visits boolean")


def traffic(fps: DataFrame, bits: int = 3) -> dict[str, int]:
    """What the trees do with some fingerprints: shards, homes, visits over boundaries, and branches pruned."""
    made = trees(fps, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for half, tree in zip(_halves(fp), made, strict=True):
                _, _, home, pruned = vptree.place(half, tree, bits // 2)
                yield pa.record_batch([pa.array([int(home.sum())]), pa.array([int((~home).sum())]), pa.array([pruned])], names=["homes", "visits", "pruned"])

    total = fps.select("fp").mapInArrow(run, "homes long, visits long, pruned long").agg(*[F.sum(c).alias(c) for c in ("homes", "visits", "pruned")]).first()
    return {"shards": sum(1 << t.levels for t in made), **{k: v or 0 for k, v in total.asDict().items()}}


def links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """``fps``: one row for each distinct fp. Returns u and v: links within ``bits`` that connect what all such links connect."""
    if not 0 <= bits <= 64:
        raise ValueError("fingerprints differ in 0 to 64 bits")
    at = workspace(fps.sparkSession, "shards")
    rows = shards(fps, trees(fps, bits), bits)
    full = rows.where("not visits").groupBy("half", "shard").agg(F.ceil(F.count("*") / PART_ROWS).alias("parts")).where("parts > 1")
    full = materialise(full, f"{at}/full")
    if full.isEmpty():
        rows = rows.withColumn("part", F.lit(0).cast("long"))
    else:  # two parts, or one with itself, make a block; a fingerprint goes to one block for each part there is
        rows = rows.join(full, ["half", "shard"], "left").withColumn("i", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1).cast("long"))))
        block = F.transform(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1), lambda j: F.least("i", j) * 1_000_000 + F.greatest("i", j))
        rows = rows.withColumn("part", F.explode(block)).select("half", "shard", "fp", "visits", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 5  # half, shard, part, fp, visits
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def held() -> tuple[np.ndarray, np.ndarray]:
            return forest(np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]))

        def out(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            place = np.stack(cols[:3], 1)
            edge = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]).any(axis=1), [True]])) if len(place) else [0]
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                fp = cols[3][lo:hi].view(np.uint64)
                for pair in vptree.near_pairs(_halves(fp)[cols[0][lo]], fp, cols[4][lo:hi].astype(bool), bits // 2, bits):
                    found.append(pair)
                    if sum(len(x) for x, _ in found) > _HELD:
                        found[:] = [held()]
            if found:
                u, v = held()
                found.clear()
                yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for b in batches:
            cols = [np.concatenate([k, b.column(i).to_numpy(zero_copy_only=False).astype(np.int64)]) for i, k in enumerate(kept)]
            if len(cols[0]):
                change = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1]))
                cut = int(change[-1]) + 1 if len(change) else 0
                kept = [c[cut:] for c in cols]
                yield from out([c[:cut] for c in cols])
        yield from out(kept)

    by = rows.repartition("half", "shard", "part").sortWithinPartitions("half", "shard", "part")
    return by.select("half", "shard", "part", "fp", "visits").mapInArrow(run, "u long, v long")


def _members(docs: DataFrame, id_col: str, text_col: str, shingle: int, bits: int) -> DataFrame:
    """doc_id, text_key, fp, root (of the group) and component_id of every row of ``docs``."""
    at = workspace(docs.sparkSession, "simhash")
    fps = materialise(fingerprints(docs, id_col, text_col, shingle), f"{at}/fps")
    points = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), f"{at}/points")
    joined = connected_components(materialise(links(points.select("fp"), bits), f"{at}/links"))
    rooted = points.join(joined, points.fp == joined.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted, f"{at}/rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    member = rooted.select("fp", "root").join(least, "root").select(F.col("fp").alias("point"), "root", "component_id")
    return fps.join(member, fps.fp == member.point).select("doc_id", "text_key", "fp", "root", "component_id")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, bits: int = 3) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id that links reach) of every row of ``docs``.

    Equal fingerprints are one point throughout, so copies make no pairs. Repeated rows stay
    repeated; a group all of whose ids are null has a null component_id; an empty table gives no rows.
    """
    return _members(docs, id_col, text_col, shingle, bits).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, bits: int = 3, similar: float | None = None) -> DataFrame:
    """Of each group of linked rows of ``docs`` one row, with all its columns: that of the least id (a null one comes
    last), of several texts under it the one whose hash is least. So rows that share an id, or have none, are told apart
    by their texts, and no text goes that isn't in a group with one that stays.

    Without ``similar`` rows are linked by fingerprints within ``bits``. With it they are linked by a Jaccard
    similarity of their shingles of at least ``similar``: the trees' links are checked by it and MinHash bands supply
    those that lie further apart than ``bits``.
    """
    if similar is None:
        members = _members(docs, id_col, text_col, shingle, bits)
    else:
        from .neardup import members as by_similarity

        members = by_similarity(docs, id_col, text_col, shingle, similar, bits)
    return one_of_each(docs, id_col, text_col, members)
