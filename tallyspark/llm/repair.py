"""Token-id files compressed by Re-Pair grammars.

A shard's ids are rewritten round by round until no pair of neighbours occurs ``LEAST`` times: adjacent pairs are
counted over the whole shard (every other one of a run like "aaaa"), those above the round's bar become
nonterminals, and their occurrences (the more frequent pair first where two overlap) are replaced. The bar falls
from the largest count by ``SHRINK`` a round down to ``LEAST``; a pair that wins fewer places than that waits.
A file holds the rules, their expansion lengths, the rewritten symbols with a checkpoint of the expanded position
every ``STEP`` symbols, and the documents' starts, so any range of ids is decoded from the symbols around it alone.
There may be any number of rules: they are packed into as many bits as the largest symbol needs. Of the rewritten
symbols the most frequent, as many as pay, are written as short numbers, with a bit for each symbol that tells.

File format (little-endian): magic; the counts (rules, symbols, tokens, documents, first nonterminal, bits of a
symbol, rounds, bits of a length, bits of a short number, short symbols) as unsigned 64-bit; rules of each round (u4);
rules (two symbols each, packed); expansion lengths (packed); the frequent symbols (packed); checkpoints (u8) and the
long symbols before them (u4); documents' starts (u8, one more than documents); documents' ids (i8) and whether null
(u1); whether a symbol is short (bits); short symbols (packed); long symbols (packed). What is packed starts at a
byte, its lowest bits first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise, only, read_file, trim, workspace, write_file
from .textkernel import mix
from .tokens import encoder

MAGIC = b"TSREPAI3"
STEP = 1024
#: Ids are below this: readers hold a table of so many entries at most.
MOST_IDS = 1 << 24
#: Ids of a shard; occurrences from which a rule (two symbols) is shorter than what it replaces; the bar's fall from round to round.
SHARD_TOKENS, LEAST, SHRINK = 2_000_000, 3, 16
#: Files that a task reads one after another, where there are enough for ``LEAST_TASKS``; tasks at most.
TASK_FILES, LEAST_TASKS, MOST_TASKS = 4, 64, 50_000
#: Rows, and bytes of text, that are encoded at a time; a shard's share of ids by which it may be too large.
SLICE_ROWS, SLICE_BYTES, OVER = 512, 4 << 20, 0.1
#: While decoding, expansions are held whole up to so many ids each, and up to any length if all together fit in ``_POOL`` ids:
#: longer ones are taken apart first.
_WHOLE, _POOL = 64, 1 << 21


def _grouped(left: np.ndarray, right: np.ndarray, at: np.ndarray, out: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs of symbols below ``top`` in order, without those at the indices ``out``: left << wide | right; their places; ``wide``."""
    wide, deep, n = top.bit_length(), int(at[-1]).bit_length(), len(at) - len(out)
    key = left.astype(np.uint64)
    key <<= np.uint64(wide)
    key |= right
    if 2 * wide + deep > 64:
        key, at = np.delete(key, out), np.delete(at, out)
        order = np.argsort(key)
        return key[order], at[order], wide
    # a pair and its place in one number: sorting numbers is several times faster than sorting their places
    key <<= np.uint64(deep)
    key |= at.view(np.uint64)
    key[out] = np.iinfo(np.uint64).max  # the last ones
    key.sort()
    key = key[:n]
    at = (key & np.uint64((1 << deep) - 1)).view(np.int64)
    key >>= np.uint64(deep)
    return key, at, wide


def compress(ids: np.ndarray, least: int = LEAST, shrink: int = SHRINK) -> tuple[np.ndarray, list[np.ndarray], int]:
    """The rewritten symbols, the rules (n, 2) of each round, and the first nonterminal."""
    base = int(ids.max(initial=0)) + 1
    if base > MOST_IDS:
        raise ValueError(f"ids must be below {MOST_IDS}")
    seq, made, count, bar = ids.astype(np.uint32), [], 0, 0
    near = None  # at the lowest bar: places near the last replacements
    while len(seq) > 1:
        if near is None:
            at, left, right = np.arange(len(seq) - 1), seq[:-1], seq[1:]
        elif len(near):  # any other pair was too rare in the last round already, and has not become more frequent
            at, left, right = near, seq[near], seq[near + 1]
        else:
            break
        # of a run of equal ids every other pair counts
        equal = np.flatnonzero(left == right)
        same = at[equal]
        k = np.arange(len(same))
        first = np.concatenate([[True], same[1:] != same[:-1] + 1])[: len(same)]
        out = equal[(k - np.maximum.accumulate(np.where(first, k, 0))) & 1 == 1]
        ordered, at, wide = _grouped(left, right, at, out, base + count)
        edge = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
        times = np.diff(np.append(edge, len(at)))
        bar = bar or max(least, int(times.max()) // shrink)
        often = times >= bar
        chosen = np.flatnonzero(often)
        if not len(chosen):
            if bar == least:
                break
            bar = max(least, bar // shrink)
            continue
        pair, size = ordered[edge[chosen]], times[chosen]
        pair = np.stack([pair >> np.uint64(wide), pair & np.uint64((1 << wide) - 1)], 1)
        # by frequency (in steps of half a power of two), then as hashes fall, so that neighbours don't wait in long lines
        step = np.floor(np.log2(size) * 2).astype(np.uint64)
        line = np.argsort(((np.uint64(127) - step) << np.uint64(57)) | (mix((pair[:, 0] << np.uint64(32)) | pair[:, 1]) >> np.uint64(7)))
        rank = np.empty(len(chosen), np.int64)
        rank[line] = np.arange(len(chosen))
        # by place: of overlapping occurrences, which are neighbours then, the lowest rank wins
        place, rank = at[np.flatnonzero(np.repeat(often, times))], np.repeat(rank, size)
        if len(place) < len(seq) // 8:
            order = np.argsort(place)
            place, rank = place[order], rank[order]
        else:  # nearly every place has one
            ranks = np.full(len(seq), -1, np.int32)
            ranks[place] = rank
            place = np.flatnonzero(ranks >= 0)
            rank = ranks[place]
        beside, lower = place[1:] == place[:-1] + 1, rank[1:] < rank[:-1]
        won = np.ones(len(place), bool)
        won[1:] = ~beside | lower
        won[:-1] &= ~(beside & lower)
        good = np.bincount(rank[np.flatnonzero(won)], minlength=len(chosen)) >= least  # true of rank 0 at any rate
        won &= good[rank]
        here = np.flatnonzero(won)
        own = place[here]
        made.append(pair[line][good].astype(np.uint32))
        seq[own] = base + count + (np.cumsum(good) - 1)[rank[here]]
        count += len(made[-1])
        stay = np.ones(len(seq), bool)
        stay[own + 1] = False
        kept = stay if len(own) < len(seq) // 32 else np.flatnonzero(stay)
        if bar == least:
            watch = np.zeros(len(seq), bool)
            watch[place[np.flatnonzero(~won)]] = watch[same] = True  # a run counts whole: which of its places do may change
            watch = watch[kept]
            own -= np.arange(len(own))  # the new symbols' places, as what went was behind earlier ones
            watch[own] = watch[np.maximum(own, 1) - 1] = True
            near = np.flatnonzero(watch[:-1])
        seq = seq[kept]
        bar = max(least, bar // shrink)
    return seq, made, base


def expansion_lengths(rules: list[np.ndarray], base: int) -> np.ndarray:
    """The ids that each nonterminal stands for: a round's rules refer to earlier rounds alone."""
    out, done = np.ones(base + sum(map(len, rules)), np.int64), base
    for own in rules:
        out[done : done + len(own)] = out[own].sum(axis=1)
        done += len(own)
    return out[base:]


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """Numbers of ``width`` bits each (none: all are zero), the lowest first."""
    parts, step = [], 1 << 16  # a multiple of 64: parts end at a whole word
    for lo in range(0, len(values) if width else 0, step):
        some = values[lo : lo + step]
        rows = np.zeros(-(-len(some) // 64) * 64, np.uint64)
        rows[: len(some)] = some
        rows = rows.reshape(-1, 64)  # 64 numbers fill ``width`` words
        out = np.zeros((width, len(rows)), np.uint64)
        for k, x in enumerate(rows.T):
            word, bit = divmod(k * width, 64)
            out[word] |= x << np.uint64(bit)
            if bit + width > 64:
                out[word + 1] |= x >> np.uint64(64 - bit)
        parts.append(out.T.astype("<u8").tobytes()[: -(-len(some) * width // 8)])
    return b"".join(parts)


def unpack_bits(raw: np.ndarray, width: int, lo: int, hi: int) -> np.ndarray:
    """The numbers lo .. hi of what pack_bits() packed (as bytes, with eight more behind them)."""
    bit = np.arange(lo, hi, dtype=np.int64) * width
    at8 = np.ndarray((max(0, len(raw) - 7),), "<u8", raw, 0, (1,))
    return ((at8[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.int64)


def serialise(seq: np.ndarray, rules: list[np.ndarray], base: int, starts: np.ndarray, doc_ids: list[int | None]) -> bytes:
    lengths = expansion_lengths(rules, base)
    width, wide = max(1, int(base + len(lengths) - 1).bit_length()), max(1, int(lengths.max(initial=0)).bit_length())
    each = np.ones(len(seq), np.int64)
    big = seq >= base
    each[big] = lengths[seq[big].astype(np.int64) - base]
    total = np.cumsum(each)
    checkpoints = np.concatenate([[0], total])[:-1][::STEP] if len(seq) else np.zeros(0, np.int64)
    # short numbers of k bits for the 2 ** k most frequent symbols, where that saves most
    times = np.bincount(seq, minlength=1)
    often = np.argsort(-times, kind="stable")[: 1 << (width - 1)]
    covered = np.concatenate([[0], np.cumsum(times[often])])
    k = min(range(width), key=lambda k: width * min(len(often), 1 << k) - int(covered[min(len(often), 1 << k)]) * (width - k))
    often = often[: 1 << k]
    number = np.full(len(times), -1, np.int32)
    number[often] = np.arange(len(often))
    code = number[seq]
    short = code >= 0
    before = np.concatenate([[0], np.cumsum(~short)])[:-1][::STEP] if len(seq) else np.zeros(0, np.int64)
    head = np.array([len(lengths), len(seq), int(total[-1]) if len(seq) else 0, len(doc_ids), base, width, len(rules), wide, k, int(short.sum())], "<u8")
    null = np.array([x is None for x in doc_ids], np.uint8)
    ids = np.array([x or 0 for x in doc_ids], "<i8")
    flat = np.concatenate([np.zeros(0, np.uint32), *(x.ravel() for x in rules)])
    rounds = np.array([len(x) for x in rules], "<u4")
    tables = [rounds.tobytes(), pack_bits(flat, width), pack_bits(lengths, wide), pack_bits(np.pad(often, (0, (1 << k) - len(often))), width)]
    places = [checkpoints.astype("<u8").tobytes(), before.astype("<u4").tobytes(), starts.astype("<u8").tobytes(), ids.tobytes(), null.tobytes()]
    return b"".join([MAGIC, head.tobytes(), *tables, *places, np.packbits(short, bitorder="little").tobytes(), pack_bits(code[short], k), pack_bits(seq[~short], width)])


class Shard:
    """A file's content, decoded as far as asked for."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a Re-Pair token file")
        n_rules, self.n_symbols, self.n_tokens, n_docs, self.base, self.width, n_rounds, wide, self.bits, n_short = np.frombuffer(raw, "<u8", 10, 8).tolist()
        at = 88

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        def packed(n: int, bits: int) -> np.ndarray:
            return np.append(take("u1", -(-n * bits // 8)), np.zeros(8, np.uint8))

        rounds = take("<u4", n_rounds).tolist()
        self.rules = unpack_bits(packed(2 * n_rules, self.width), self.width, 0, 2 * n_rules).reshape(-1, 2)
        self.lengths = unpack_bits(packed(n_rules, wide), wide, 0, n_rules)
        self.often = unpack_bits(packed(1 << self.bits, self.width), self.width, 0, 1 << self.bits)
        self.checkpoints = take("<u8", -(-self.n_symbols // STEP)).astype(np.int64)
        self.before = take("<u4", -(-self.n_symbols // STEP)).astype(np.int64)
        self.starts = take("<u8", n_docs + 1).astype(np.int64)
        ids, null = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if z else i for i, z in zip(ids.tolist(), null.tolist(), strict=True)]
        self.short, self.codes = take("u1", -(-self.n_symbols // 8)), packed(n_short, self.bits)
        self.long = packed(self.n_symbols - n_short, self.width)
        # the expansions of all symbols of at most ``whole`` ids, one after another: terminals first, then round by round
        self.size = np.concatenate([np.ones(self.base, np.int64), self.lengths])
        rising = np.sort(self.lengths)
        over = np.flatnonzero(np.cumsum(rising) > _POOL)
        self.whole = max(_WHOLE, int(rising[over[0]]) - 1 if len(over) else int(self.lengths.max(initial=0)))
        held = np.where(self.size <= self.whole, self.size, 0)
        self.at = np.cumsum(held) - held
        self.pool = np.zeros(int(held.sum()), np.uint32)
        self.pool[: self.base] = np.arange(self.base)
        done = self.base
        for n in rounds:
            own = done + np.flatnonzero(held[done : done + n])
            if len(own):
                self.pool[self.at[own[0]] : self.at[own[-1]] + held[own[-1]]] = self._copy(self.rules[own - self.base].ravel())
            done += n

    def _copy(self, symbols: np.ndarray) -> np.ndarray:
        size = self.size[symbols]
        total = np.cumsum(size)
        return self.pool[np.repeat(self.at[symbols] - (total - size), size) + np.arange(int(total[-1]) if len(total) else 0)]

    def _symbols(self, lo: int, hi: int) -> np.ndarray:
        """Symbols from a checkpoint's on."""
        short = np.unpackbits(self.short[lo // 8 : -(-hi // 8)], bitorder="little")[: hi - lo].astype(bool)
        long = int(self.before[lo // STEP])
        n = int(short.sum())
        out = np.empty(hi - lo, np.int64)
        out[short] = self.often[unpack_bits(self.codes, self.bits, lo - long, lo - long + n)]
        out[~short] = unpack_bits(self.long, self.width, long, long + hi - lo - n)
        return out

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        while (long := self.size[symbols] > self.whole).any():
            n = np.where(long, 2, 1)
            at = np.cumsum(n) - n
            out = np.repeat(symbols, n)
            out[at[long]], out[at[long] + 1] = self.rules[symbols[long] - self.base].T
            symbols = out
        return self._copy(symbols)

    def decode(self, start: int, n: int) -> np.ndarray:
        """Ids start .. start + n: expands only the symbols between the checkpoints around them."""
        if n <= 0 or not self.n_symbols:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(self.checkpoints, start, side="right")) - 1
        b = int(np.searchsorted(self.checkpoints, start + n, side="left"))
        got = self._expand(self._symbols(a * STEP, min(b * STEP, self.n_symbols)))
        return got[start - self.checkpoints[a] : start - self.checkpoints[a] + n]

    def document(self, k: int) -> np.ndarray:
        return self.decode(int(self.starts[k]), int(self.starts[k + 1] - self.starts[k]))


def write(docs: DataFrame, uri: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "byte_bpe_50k.json", end_id: int = 0, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode all texts (a null is empty), each with ``end_id`` after it, in ascending id order, and write shards.

    Returns the manifest: part and file (the shards' order), path, n_docs, n_tokens, n_symbols, n_bytes, start (ids
    of all shards before). Ids are whole numbers (others are an error of Spark's cast). Rows of one id are ordered by their
    texts, repeated rows stay repeated; a null id comes first; an empty table gives no files; other columns don't
    matter. A shard has at most a tenth more than ``shard_tokens`` ids, unless a single document has. Files of attempts that were lost are in no manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(tokenizer), TaskContext.get().partitionId()
        ids, numbers, doc_ids, n, file = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, numbers, doc_ids, n, file
            flat, count = np.concatenate(ids), np.concatenate(numbers)
            ids = []
            seq, rules, base = compress(flat)
            raw = serialise(seq, rules, base, np.concatenate([[0], np.cumsum(count)]), doc_ids)
            path = write_file(uri, f"ids-{part:06d}-{file:06d}", raw)
            row = [[part], [file], [path], [len(doc_ids)], [len(flat)], [len(seq)], [len(raw)]]
            ids, numbers, doc_ids, n, file = [], [], [], 0, file + 1
            trim()
            return pa.record_batch([pa.array(row[0], pa.int32()), pa.array(row[1], pa.int32()), *map(pa.array, row[2:])], names=["part", "file", "path", "n_docs", "n_tokens", "n_symbols", "n_bytes"])

        most = int(shard_tokens * (1 + OVER))
        for b in batches:
            size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False))])
            lo = 0
            while lo < b.num_rows:
                hi = int(np.searchsorted(size, size[lo] + SLICE_BYTES, side="right")) - 1
                hi = min(max(hi, lo + 1), lo + SLICE_ROWS, b.num_rows)
                some, lo = b.slice(lo, hi - lo), hi
                flat, count = own.encode(some.column(1))
                flat, count, names = np.insert(flat, np.cumsum(count), end_id), count + 1, some.column(0).to_pylist()
                cut, done = np.concatenate([[0], np.cumsum(count)]), 0
                while done < len(count):  # as many documents as the shard has room for
                    to = int(np.searchsorted(cut, cut[done] + most - n, side="right")) - 1
                    if to == done and n:
                        yield flush()
                        continue
                    to = max(to, done + 1)  # a document that is longer than a shard is one of its own
                    full = np.flatnonzero(cut[done + 1 : to + 1] - cut[done] + n >= shard_tokens)
                    to = done + 1 + int(full[0]) if len(full) else to
                    ids.append(flat[cut[done] : cut[to]])
                    numbers.append(count[done:to])
                    doc_ids += names[done:to]
                    n += int(cut[to] - cut[done])
                    done = to
                    if n >= shard_tokens:
                        yield flush()
        if doc_ids:
            yield flush()

    src = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    # a text's first letters keep the order and split the rows of a frequent id
    ordered = src.repartitionByRange("doc_id", F.substring("text", 1, 16)).sortWithinPartitions("doc_id", "text")
    made = materialise(ordered.mapInArrow(run, "part int, file int, path string, n_docs long, n_tokens long, n_symbols long, n_bytes long"), f"{uri}/manifest")
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return made.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read(manifest: DataFrame, ids: bool = True) -> DataFrame:
    """Each document of the files, decoded: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                shard = Shard(read_file(path))
                step = 256  # documents decoded at a time
                for lo in range(0, len(shard.doc_ids), step):
                    cut = shard.starts[lo : lo + step + 1]
                    flat = shard.decode(int(cut[0]), int(cut[-1] - cut[0])).astype("<u4")
                    raw, rel = flat.tobytes(), (cut - cut[0]).tolist()
                    cols = [pa.array(shard.doc_ids[lo : lo + step], pa.int64()), pa.array(base + cut[:-1]), pa.array(np.diff(cut)), pa.array([zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(rel, rel[1:], strict=False)], pa.int64())]
                    if ids:
                        cols.append(pa.ListArray.from_arrays(pa.array(rel, pa.int32()), pa.array(flat.astype(np.int64))))
                    yield pa.record_batch(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * ids])

    some = manifest.select("path", "start")
    files = manifest.count()
    some = some.repartition(max(1, min(MOST_TASKS, files, max(LEAST_TASKS, files // TASK_FILES))))
    return some.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)


def round_trip(docs: DataFrame, **options) -> DataFrame:
    return read(write(docs, workspace(docs.sparkSession, "repair"), **options), ids=False)
