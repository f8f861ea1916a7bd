"""Packing documents' tokens into sequences of a fixed size by a distributed grouping genetic algorithm.

Documents become pieces of at most a sequence's size. Pieces are dealt evenly into shards; for
each shard several islands breed packings, the first of which take the pieces in random order: crossover injects
whole well-filled bins of another parent, bins that hold a piece twice give way, so do the emptiest, and displaced
pieces are placed anew by best fit. Between epochs the best packings of each island also go to the next.
An island rests when it has as few bins as can be, or bred nothing better for a while. What lies in
the shards' emptiest bins is dealt into new shards and packed again. Only lengths take part.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise, only, workspace
from .tokens import encoder

SEQUENCE = 2048
#: Pieces in a shard, islands for each shard, epochs (migration between them), generations of an epoch, packings on an
#: island, and generations without a better packing after which an island rests.
SHARD_PIECES, ISLANDS, EPOCHS, GENERATIONS, POPULATION, PATIENCE = 5_000, 2, 2, 30, 10, 10
#: Generations and patience on the last level: one shard, which decides whether the sequences are as few as can be.
LAST_GENERATIONS, LAST_PATIENCE = 300, 150
#: Best packings of an island that stay, and also go to the next one, between epochs.
ELITES = 3
#: Shares of a parent's bins that crossover injects, and of the child's emptiest bins that are dealt anew: islands take turns
#: at these rates, careful ones that improve what they have and bold ones that try more, so what migrates is of another kind.
INJECTED, EMPTIEST = 0.1, (0.05, 0.2)
#: Share of the child's bins, full ones too, that are dealt anew besides, by chance: new combinations for a pool that has become alike.
MUTATED = 0.02
#: Share of a shard's bins, the emptiest that aren't full, whose pieces are packed again with those of other shards.
LOOSE = 0.1
_LAST = 1 << 62  # above every piece's number


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json", end_id: int = 0, size: int = SEQUENCE) -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32: each text's ids and then ``end_id``, cut only where
    they exceed ``size``. A null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for b in batches:
            ids, n = own.encode(b.column(1))
            doc, piece, start, length, crc, at = [], [], [], [], [], 0
            end = np.array([end_id], "<u4").tobytes()
            for k, count in enumerate(n.tolist()):
                raw = ids[at : at + count].astype("<u4").tobytes() + end
                at += count
                for p, lo in enumerate(range(0, count + 1, size)):
                    doc.append(k)
                    piece.append(p)
                    start.append(lo)
                    length.append(min(size, count + 1 - lo))
                    crc.append(zlib.crc32(raw[4 * lo : 4 * (lo + size)]))
            yield pa.record_batch([b.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    src = only(docs, doc_id=id_col, text=text_col)
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


class Packing:
    """Bins of item numbers with their free room."""

    def __init__(self, bins: list[list[int]], room: list[int]):
        self.bins, self.room = bins, room

    def place(self, items: list[int], length: list[int], size: int) -> None:
        """Best fit, in the order given: into the bin with the least room that suffices."""
        by_room: list[list[int]] = [[] for _ in range(size + 1)]
        mask = 0
        for b, r in enumerate(self.room):
            if r:
                by_room[r].append(b)
                mask |= 1 << r
        for i in items:
            n = length[i]
            fits = mask >> n
            if fits:
                r = n + (fits & -fits).bit_length() - 1
                b = by_room[r].pop()
                if not by_room[r]:
                    mask ^= 1 << r
                self.bins[b].append(i)
            else:
                r, b = size, len(self.bins)
                self.bins.append([i])
                self.room.append(size)
            left = r - n
            self.room[b] = left
            if left:
                by_room[left].append(b)
                mask |= 1 << left

    def refill(self, loose: list[int], length: list[int]) -> list[int]:
        """Pieces of bins with room give way to displaced ones (``loose``) that fill their bin better: the room's best filler first.
        Returns what is then displaced, smaller pieces that are easier to place."""
        held = sorted((length[i], i) for i in loose)
        for b, r in enumerate(self.room):
            if not r or not held:
                continue
            items = self.bins[b]
            gain, which, by = 0, -1, -1
            for k, i in enumerate(items):
                at = bisect.bisect_right(held, (length[i] + r, _LAST)) - 1
                if at >= 0 and held[at][0] - length[i] > gain:
                    gain, which, by = held[at][0] - length[i], k, at
                    if gain == r:
                        break
            if gain:
                old = items[which]
                items[which] = held.pop(by)[1]
                bisect.insort(held, (length[old], old))
                self.room[b] = r - gain
        return [i for _, i in held]

    def fitness(self, size: int) -> float:
        """The mean squared fill: more for fewer, fuller bins."""
        return sum((1 - r / size) ** 2 for r in self.room) / max(1, len(self.room))

    def chromosome(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int32)
        for b, items in enumerate(self.bins):
            out[items] = b
        return out


def decode(chromosome: np.ndarray, length: np.ndarray, size: int) -> Packing:
    n = int(chromosome.max(initial=-1)) + 1
    order = np.argsort(chromosome, kind="stable")
    cuts = np.searchsorted(chromosome[order], np.arange(1, n))
    fill = np.bincount(chromosome, weights=length, minlength=n)
    return Packing([x.tolist() for x in np.split(order, cuts)] if n else [], (size - fill).astype(np.int64).tolist())


def crossover(a: Packing, b: Packing, length: list[int], size: int, rng: np.random.Generator, emptiest: float = EMPTIEST[0]) -> Packing:
    """``a`` with some whole well-filled bins of ``b``: a's bins that share an item with them give way, so do the
    emptiest, and their other items are placed anew, longest first."""
    room = np.array(b.room)
    full = np.argsort(room, kind="stable")[: max(1, len(room) // 2)]
    take = rng.choice(full, min(len(full), max(1, int(len(room) * INJECTED))), replace=False) if len(full) else full
    taken = [b.bins[k] for k in take.tolist()]
    twice = {i for x in taken for i in x}
    kept, loose = [], []
    for items, r in zip(a.bins, a.room, strict=True):
        if twice.isdisjoint(items):
            kept.append((items, r))
        else:
            loose += [i for i in items if i not in twice]
    worst = np.argsort(-np.array([r for _, r in kept]), kind="stable")[: max(1, int(len(kept) * emptiest))].tolist() if kept else []
    drop = {k for k in worst if kept[k][1]}
    if kept and drop:
        drop |= set(rng.integers(0, len(kept), int(len(kept) * MUTATED)).tolist())
    loose += [i for k in drop for i in kept[k][0]]
    kept = [x for k, x in enumerate(kept) if k not in drop]
    child = Packing([list(x) for x, _ in kept] + [list(x) for x in taken], [r for _, r in kept] + [int(b.room[k]) for k in take.tolist()])
    loose = child.refill(loose, length)
    child.place(sorted(loose, key=lambda i: -length[i]), length, size)
    return child


def evolve(length: np.ndarray, size: int, seed: int, elites: list[np.ndarray], generations: int = GENERATIONS, population: int = POPULATION, patience: int = PATIENCE, emptiest: float = EMPTIEST[0]) -> list[tuple[np.ndarray, int, float]]:
    """The best packings found of items of these lengths, the best one first: each item's bin, the number of bins, the fitness.

    Items of the whole size have a bin each; the others are bred from ``elites`` (packings of all items) and
    packings in random order. No bin is empty."""
    rng = np.random.default_rng(seed)
    whole = length >= size
    rest = np.flatnonzero(~whole)
    own = length[rest]
    lengths = own.tolist()
    bound = math.ceil(int(own.sum()) / size)
    pool = [decode(np.unique(x[rest], return_inverse=True)[1], own, size) for x in elites]
    while len(pool) < population:
        one = Packing([], [])
        one.place(rng.permutation(len(own)).tolist(), lengths, size)
        pool.append(one)
    rank = lambda p: (len(p.bins), -p.fitness(size))
    pool = sorted(pool, key=rank)[: max(population, len(elites))]
    best, since = rank(pool[0]), 0
    for _ in range(generations):
        if len(pool[0].bins) <= bound or len(pool) < 2 or since >= patience:
            break
        i, j = sorted(rng.choice(len(pool), 2, replace=False).tolist())
        pool += [crossover(pool[i], pool[j], lengths, size, rng, emptiest), crossover(pool[j], pool[i], lengths, size, rng, emptiest)]
        pool = sorted(pool, key=rank)[:population]
        best, since = min(best, rank(pool[0])), 0 if rank(pool[0]) < best else since + 1

    def whole_packing(p: Packing) -> tuple[np.ndarray, int, float]:
        out = np.empty(len(length), np.int32)
        out[rest] = p.chromosome(len(own))
        out[whole] = len(p.bins) + np.arange(int(whole.sum()))
        return out, len(p.bins) + int(whole.sum()), p.fitness(size)

    return [whole_packing(p) for p in pool[: 1 if len(pool[0].bins) <= bound else ELITES]]


def breed(length: np.ndarray, size: int, epoch: int, island: int, elites: list[np.ndarray], last: bool = False) -> list[tuple[np.ndarray, int, float]]:
    """An island's epoch: a seed and a rate of its own, and the elites that stayed or came."""
    longer = {"generations": LAST_GENERATIONS, "patience": LAST_PATIENCE} if last else {}
    return evolve(length, size, 1000 * epoch + island, elites, **longer, emptiest=EMPTIEST[island % len(EMPTIEST)])


def _level(held: DataFrame, at: str, level: int, size: int, shard_pieces: int, islands: int, epochs: int) -> tuple[DataFrame, int]:
    """``held``: a written table with a row number. Its rows with sequence_id, offset and whether they are to be packed
    again (``loose``), and the number of shards."""
    spark = held.sparkSession
    shards = max(1, math.ceil(held.count() / shard_pieces))
    held = held.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(shards)).cast("int"))
    items = held.select("shard", "row", "length").withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
    kind = "shard int, island int, bins int, fitness double, chromosome binary"
    best = None

    def breeder(epoch: int):
        def run(key, own: pd.DataFrame, elite: pd.DataFrame) -> pd.DataFrame:
            if not len(own):
                return pd.DataFrame({"shard": [], "island": [], "bins": [], "fitness": [], "chromosome": []}).astype({"shard": "int32", "island": "int32", "bins": "int32", "fitness": "float64"})
            length = own.sort_values("row")["length"].to_numpy()
            seeds = [np.frombuffer(x, np.int32) for x in elite.sort_values(["bins", "fitness"], ascending=[True, False])["chromosome"]]
            got = breed(length, size, epoch, int(key[1]), seeds, level > 0 and shards == 1)
            return pd.DataFrame({"shard": key[0], "island": key[1], "bins": [x[1] for x in got], "fitness": [x[2] for x in got], "chromosome": [x[0].tobytes() for x in got]})

        return run

    for epoch in range(epochs):
        if best is None:
            moved = spark.createDataFrame([], kind)
        else:  # an island's best ones stay and also go to the next island
            moved = best.unionByName(best.withColumn("island", F.pmod(F.col("island") + 1, F.lit(islands)))).dropDuplicates(["shard", "island", "chromosome"])
        grown = items.groupBy("shard", "island").cogroup(moved.groupBy("shard", "island")).applyInPandas(breeder(epoch), kind)
        best = materialise(grown, f"{at}/epoch{level}-{epoch}")
    winner = best.groupBy("shard").agg(F.min_by("chromosome", F.struct("bins", -F.col("fitness"), "island", "chromosome")).alias("chromosome"))
    out_kind = held.schema.simpleString()[len("struct<") : -1].replace(":", " ")

    def assign(key, own: pd.DataFrame, won: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("row")
        bins = np.frombuffer(won["chromosome"].iloc[0], np.int32).astype(np.int64)
        order = np.argsort(bins, kind="stable")
        length = own["length"].to_numpy()[order]
        before = np.cumsum(length) - length
        first = np.searchsorted(bins[order], bins[order])
        offset = np.empty(len(bins), np.int64)
        offset[order] = before - before[first]
        filled = np.bincount(bins, weights=own["length"].to_numpy())
        again = np.zeros(len(filled), bool)
        if shards > 1:
            again[np.argsort(filled, kind="stable")[: max(1, int(len(filled) * LOOSE))]] = True
            again &= filled < size
        return own.assign(sequence_id=(level << 56) + (int(key[0]) << 24) + bins, offset=offset, loose=again[bins])

    placed = held.groupBy("shard").cogroup(winner.groupBy("shard")).applyInPandas(assign, f"{out_kind}, sequence_id long, offset long, loose boolean")
    return materialise(placed.drop("shard"), f"{at}/placed{level}"), shards


def pack(parts: DataFrame, size: int = SEQUENCE, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``parts``: rows as pieces() gives them. The same rows with sequence_id and offset.

    Every level but the last leaves a few pieces of each shard for the next one."""
    at = workspace(parts.sparkSession, "packing")
    held, out, level = materialise(parts.withColumn("row", F.monotonically_increasing_id()), f"{at}/pieces"), None, 0
    while True:
        placed, shards = _level(held, at, level, size, shard_pieces, islands, epochs)
        done = placed.where("not loose").select(*parts.columns, "sequence_id", "offset")
        out = done if out is None else out.unionByName(done)
        if shards == 1:
            return out
        held, level = placed.where("loose").drop("sequence_id", "offset", "loose"), level + 1


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json", end_id: int = 0, size: int = SEQUENCE) -> DataFrame:
    """Of every text (a null is empty) its ids and ``end_id``, packed: a row for each piece with doc_id, piece, start, length,
    ids_crc32, sequence_id and offset.

    Repeated rows and null ids stay rows of their own, an empty table gives no rows, other columns don't matter; a text of
    any length is cut into pieces of ``size``. Equal lengths are ties that the seeded search decides by row number.
    """
    return pack(pieces(docs, id_col, text_col, tokenizer, end_id, size), size)
