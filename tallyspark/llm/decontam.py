"""Benchmark decontamination by suffix arrays over the training texts.

Every ``SHARD_BYTES`` of whole training texts are a shard with a suffix array over all its words: the places
of all suffixes, in the order of their word numbers, up to each text's end. Every test suffix is searched in
every shard by bisection, two words at a time: the places that share its first words are a range of the
array, which the next words narrow down. What still is not empty after a whole window (``WINDOW`` words, or an
item of fewer) are all the window's occurrences. Windows that go on from one word to the next, in text and item
alike, make up the longest verbatim matches, so no match is extended word by word.

Training texts never move. The test set is written in blocks of bounded size below the shared folder; a worker
reads one at a time. Words are the same only if their bytes are: hashes only order them.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .shared import free_name, materialise, only, read_file, workspace, write_file

#: Bytes of test texts in one block (what a worker holds of the test set), and of training texts in one shard.
BLOCK_BYTES, SHARD_BYTES = 16 << 20, 8 << 20
#: Words of a window: an item of fewer is one window.
WINDOW = 10


class Vocabulary:
    """The distinct words of some texts, numbered by their hashes' order."""

    def __init__(self, data: np.ndarray, s: np.ndarray, e: np.ndarray):
        keys = K.word_keys(data, s, e)
        h = K.key_hashes(data, s, e, keys)
        self.hash, at, self.ids = np.unique(h, return_index=True, return_inverse=True)
        self.data, self.start, self.keys = data, s[at], tuple(k[at] for k in keys)
        self.exact: dict[bytes, int] | None = None
        if not self._same(self.ids, data, s, keys).all():  # different words share a hash: number them by their bytes
            raw = data.tobytes()
            self.exact = {}
            self.ids = np.array([self.exact.setdefault(raw[a:b], len(self.exact)) for a, b in zip(s.tolist(), e.tolist(), strict=True)], np.int64)

    def _same(self, of: np.ndarray, data: np.ndarray, s: np.ndarray, keys: tuple) -> np.ndarray:
        out = (self.keys[0][of] == keys[0]) & (self.keys[1][of] == keys[1]) & (self.keys[2][of] == keys[2])
        long = np.flatnonzero(out & (keys[2] > K.SHORT))
        if len(long):
            out[long] = K.equal_ranges(self.data, self.start[of[long]], data, s[long], keys[2][long])
        return out

    def find(self, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The numbers of other texts' words, or -1."""
        if self.exact is not None:
            raw = data.tobytes()
            return np.array([self.exact.get(raw[a:b], -1) for a, b in zip(s.tolist(), e.tolist(), strict=True)], np.int64)
        keys = K.word_keys(data, s, e)
        h = K.key_hashes(data, s, e, keys)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where((self.hash[at] == h) & self._same(at, data, s, keys), at, -1)


class Block:
    """Some test items, made ready for searching: their distinct words, and their suffixes' windows, each distinct one once."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        data, off = K.text_buffer(pa.array([x for _, x in items], pa.string()))
        low = K.LOWER[data]
        s, e, first = K.words(low, off, K.ALNUM)
        vocabulary = Vocabulary(low, s, e)
        one = np.unique(vocabulary.ids, return_index=True)[1]
        n = e[one] - s[one]
        self.word_start = np.cumsum(n) - n  # of the distinct words alone, one after another
        self.word_end = self.word_start + n
        self.words = low[np.repeat(s[one] - self.word_start, n) + np.arange(int(n.sum()))] if len(one) else low[:0]
        count = np.diff(first)
        width = np.minimum(count, window)
        suffixes = np.where(count > 0, count - width + 1, 0)  # those that hold a whole window
        owner = np.repeat(np.arange(len(items)), suffixes)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(suffixes) - suffixes, suffixes)
        at = first[owner] + within
        rows = np.full((len(owner), window + 1), -1, np.int32)
        rows[:, window] = width[owner]
        for k in range(window):
            has = k < width[owner]
            rows[has, k] = vocabulary.ids[at[has] + k]
        distinct, which = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows, np.zeros(0, np.int64))
        self.window, self.width = distinct[:, :window], distinct[:, window].astype(np.int64)
        order = np.argsort(which.ravel(), kind="stable")
        #: Of each window (n + 1) the test places that it starts: the item's number and its word's.
        self.cut = np.searchsorted(which.ravel()[order], np.arange(len(distinct) + 1))
        self.owner, self.within = owner[order], within[order]
        names = sorted({i for i, _ in items if i is not None})
        self.names = [*names, None]  # numbers in the names' order
        number = {x: k for k, x in enumerate(self.names)}
        self.item = np.array([number[None if i is None else i] for i, _ in items], np.int64)


class Found(NamedTuple):
    """The occurrences of windows in some texts: the first word and the window of each."""

    place: np.ndarray
    window: np.ndarray


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """The places of all suffixes in order, by prefix doubling; the last number must not occur before."""
    n = len(seq)
    key = (seq.astype(np.int64) << 32) | np.append(seq[1:], 0)
    sa = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)  # the first place in ``sa`` of the suffixes that are equal so far
    ordered, where, at, depth = key[sa], sa, np.arange(n), 2
    while True:
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        head = np.maximum.accumulate(np.where(new, at, 0))
        rank[where] = head
        alone = new & np.append(new[1:], True)
        if alone.all():
            return sa
        at, where = at[~alone], where[~alone]
        key = (rank[where] << 32) | rank[where + depth]
        order = np.argsort(key, kind="stable")
        ordered, where = key[order], where[order]
        sa[at] = where
        depth *= 2


class Shard:
    """Whole texts and the suffix array over their words."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.low = K.LOWER[data]
        self.s, self.e, self.first = K.words(self.low, off, K.ALNUM)
        self.texts = len(off) - 1
        if not len(self.s):
            return
        self.vocabulary = Vocabulary(self.low, self.s, self.e)
        # an end mark after each text, of a number of its own and below all words: no match goes on past it
        seq = np.empty(len(self.s) + self.texts, np.int64)
        text = np.repeat(np.arange(self.texts), np.diff(self.first))
        seq[np.arange(len(self.s)) + text] = self.vocabulary.ids + self.texts
        seq[self.first[1:] + np.arange(self.texts)] = np.arange(self.texts)
        self.sa = suffix_array(seq)
        self.pair = (seq << 32) | np.append(seq[1:], 0)
        self.text_of = np.repeat(np.arange(self.texts), np.diff(self.first) + 1)

    def _bisect(self, lo: np.ndarray, hi: np.ndarray, depth: int, key: np.ndarray) -> np.ndarray:
        """The first place of each range of the array whose two words ``depth`` words on are at least ``key``."""
        lo, hi = lo.copy(), hi.copy()
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self.pair[self.sa[mid] + depth] < key[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        return lo

    def search(self, block: Block) -> Found:
        """All occurrences of the block's windows."""
        none = np.zeros(0, np.int64)
        if not len(self.s) or not len(block.width):
            return Found(none, none)
        own = self.vocabulary.find(block.words, block.word_start, block.word_end)
        number = np.append(np.where(own >= 0, own + self.texts, -1), -1)
        window = number[block.window]
        live = np.arange(len(window))
        lo, hi = np.zeros(len(window), np.int64), np.full(len(window), len(self.sa), np.int64)
        for depth in range(0, window.shape[1], 2):
            more = live[block.width[live] > depth]
            a = window[more, depth]
            two = block.width[more] > depth + 1
            b = window[more, min(depth + 1, window.shape[1] - 1)]
            known = (a >= 0) & (~two | (b >= 0))
            gone, more, a, b, two = more[~known], more[known], a[known], b[known], two[known]
            hi[gone] = lo[gone]
            least, beyond = (a << 32) | np.where(two, b, 0), np.where(two, (a << 32) | (b + 1), (a + 1) << 32)
            frm = self._bisect(lo[more], hi[more], depth, least)
            hi[more] = self._bisect(frm, hi[more], depth, beyond)
            lo[more] = frm
            live = live[lo[live] < hi[live]]
        n = (hi - lo)[live]
        at = np.repeat(lo[live] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        place = self.sa[at]
        return Found(place - self.text_of[place], np.repeat(live, n))

    def text(self, word: np.ndarray) -> np.ndarray:
        """The text of each word."""
        return np.searchsorted(self.first, word, side="right") - 1


@lru_cache(maxsize=1)
def _block(path: str) -> Block:
    return pickle.loads(read_file(path))


def blocks(bench: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Write the test set's blocks; returns their paths, one for each ``block_bytes`` of text or so."""
    uri = workspace(bench.sparkSession, "testset")
    src = only(bench, item=item_col, text=text_col).select(F.col("item").cast("string").alias("item"), "text").where("text is not null")
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, size, n = TaskContext.get().partitionId(), [], 0, 0

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array([write_file(uri, f"block-{part:05d}-{n:05d}", pickle.dumps(Block(rows, window)))])], names=["path"])

        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows.append((item, text))
                size += len(text.encode())
                if size >= block_bytes:
                    yield flush()
                    rows, size, n = [], 0, n + 1
        if rows:
            yield flush()

    made = materialise(src.repartition(max(1, -(-size // block_bytes))).mapInArrow(run, "path string"), f"{uri}/manifest")
    return sorted(r.path for r in made.collect())


def _each(docs: DataFrame, text_at: int, paths: list[str], make, schema: str) -> DataFrame:
    """``make`` of each shard: its rows, the shard, and its occurrences block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = K.text_buffer(b.column(text_at))
            for lo, hi in K.chunks(off, SHARD_BYTES):
                here = off[lo : hi + 1] - off[lo]
                shard = Shard(data[off[lo] : off[hi]], here)
                yield make(b.slice(lo, hi - lo), here, shard, ((block, shard.search(block)) for block in map(_block, paths)))

    return docs.mapInArrow(run, schema)


def matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", bench_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The longest verbatim matches of a window or more and where they are: doc_id, item_id (a string),
    doc_word, item_word (the first word's number), n_words, byte_start, byte_end (in the text's UTF-8).

    A match is as long as it can be in both directions. A window that an item repeats matches at each of its places
    there. Null texts have no words; a null item_id stays null.
    """
    src = only(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "item_id", "doc_word", "item_word", "n_words", "byte_start", "byte_end"]

    def make(b, off, shard, searched):
        rows: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
        item: list[str | None] = []
        for block, found in searched:
            n = np.diff(block.cut)[found.window]
            test = np.repeat(block.cut[found.window] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            place, width = np.repeat(found.place, n), block.width[np.repeat(found.window, n)]
            owner, within = block.owner[test], block.within[test]
            # windows one word apart on both sides belong to one match
            order = np.lexsort((place, place - within, owner))
            place, width, owner, within = place[order], width[order], owner[order], within[order]
            goes_on = np.zeros(len(place), bool)
            goes_on[1:] = (owner[1:] == owner[:-1]) & (place[1:] == place[:-1] + 1) & (within[1:] == within[:-1] + 1)
            head = np.flatnonzero(~goes_on)
            length = np.diff(np.append(head, len(place))) + width[head] - 1
            for out, x in zip(rows, (shard.text(place[head]), place[head], within[head], length), strict=True):
                out.append(x)
            item += [block.names[k] for k in block.item[owner[head]].tolist()]
        doc, place, within, length = (np.concatenate(x) for x in rows)
        some = len(place) > 0
        return pa.record_batch([b.column(0).take(pa.array(doc)), pa.array(item, pa.string()), pa.array(place - shard.first[doc] if some else place), pa.array(within), pa.array(length), pa.array(shard.s[place] - off[doc] if some else place), pa.array(shard.e[place + length - 1] - off[doc] if some else place)], names=names)

    return _each(src, 1, blocks(bench, item_col, bench_text_col, window, block_bytes), make, f"doc_id {kind}, item_id string, doc_word long, item_word long, n_words long, byte_start long, byte_end long")


def verdicts(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", bench_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Of every row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence of a window) and
    items (ids, as sorted strings, of the items with occurring windows; of items without an id one null, last).

    A null text has no words; repeated rows and null ids stay rows of their own; empty tables give no rows, or no hits.
    """
    src = only(docs, doc_id=id_col, text=text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def make(b, off, shard, searched):
        n = len(off) - 1
        cover = np.zeros(len(shard.s) + 1, np.int64)
        items: dict[int, set] = {}
        for block, found in searched:
            np.add.at(cover, found.place, 1)
            np.add.at(cover, found.place + block.width[found.window], -1)
            both = np.unique(shard.text(found.place) * max(1, len(block.width)) + found.window)
            doc, which = both // max(1, len(block.width)), both % max(1, len(block.width))
            k = np.diff(block.cut)[which]
            test = np.repeat(block.cut[which] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
            pair = np.unique(np.repeat(doc, k) * len(block.names) + block.item[block.owner[test]])
            for d, i in zip((pair // len(block.names)).tolist(), (pair % len(block.names)).tolist(), strict=True):
                items.setdefault(d, set()).add(block.names[i])
        total = np.concatenate([[0], np.cumsum(np.cumsum(cover)[:-1] > 0)])
        listed = [sorted(items.get(k, ()), key=lambda x: (x is None, x or "")) for k in range(n)]
        return pa.record_batch([b.column(0), pa.array(np.diff(shard.first)), pa.array(total[shard.first[1:]] - total[shard.first[:-1]]), pa.array(listed, pa.list_(pa.string()))], names=["doc_id", "n_words", "n_hit", "items"])

    return _each(src, 1, blocks(bench, item_col, bench_text_col, window, block_bytes), make, f"doc_id {kind}, n_words long, n_hit long, items array<string>")


def drop_contaminated(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", bench_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window of a test item occurs."""

    def make(b, off, shard, searched):
        clean = np.ones(len(off) - 1, bool)
        for _, found in searched:
            clean[shard.text(found.place)] = False
        return b.filter(pa.array(clean))

    names = docs.columns
    own = [free_name(docs, f"c{i}") for i in range(len(names))]  # clashing names never meet
    out = docs.toDF(*own)
    out = _each(out, names.index(text_col), blocks(bench, item_col, bench_text_col, window, block_bytes), make, out.schema)
    return out.select(*[F.col(o).alias(n) for o, n in zip(own, names, strict=True)])


def report(docs: DataFrame, bench: DataFrame, **columns) -> DataFrame:
    """verdicts() with the number of items and a digest of their ids in place of the list, and ``contaminated``."""
    return verdicts(docs, bench, **columns).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
