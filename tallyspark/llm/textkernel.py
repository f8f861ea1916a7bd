"""Array primitives over the bytes of Arrow string columns: words, word and n-gram hashes, XXH64.

Everything works on one chunk of whole texts at a time, so memory follows ``CHUNK_BYTES``
(or one text, where a single text is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_ALL = np.arange(256)
#: A-Z to a-z, every other byte as it is.
LOWER = np.where((_ALL >= 0x41) & (_ALL <= 0x5A), _ALL + 32, _ALL).astype(np.uint8)
#: 1 for bytes of words ``[^\x20\x09-\x0D]+``.
SPACED = (~((_ALL == 0x20) | ((_ALL >= 9) & (_ALL <= 13)))).astype(np.uint8)
#: 1 for bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text.
ALNUM = (((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)).astype(np.uint8)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the n + 1 offsets; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of one non-zero class inside a text, and each text's first run (n + 1)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cls = classes[data]
    cut = np.empty(n + 1, bool)  # a boundary before byte i
    cut[1:n] = cls[1:] != cls[:-1]
    cut[0] = cut[n] = True
    cut[offsets] = True
    at = np.flatnonzero(cut)
    real = cls[at[:-1]] != 0
    starts, ends = at[:-1][real], at[1:][real]
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Up to this many bytes a word is its length, first eight and last eight bytes.
SHORT = 16


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each byte range's first eight bytes, last eight bytes (as numbers) and length. Ranges of at most
    ``SHORT`` bytes are equal if these are; longer ones must be compared byte by byte."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[8 : 8 + len(data)] = data
    at8 = np.ndarray((len(data) + 9,), "<u8", padded, 0, (1,))
    n = ends - starts
    first = at8[starts + 8] & _MASKS[np.minimum(n, 8)]
    return first, np.where(n >= 8, at8[ends], first), n


def key_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each byte range, given its word_keys(): XXH64 for long ones. Different ranges may share
    one, so whoever needs certainty compares keys and, of long ranges, bytes."""
    first, last, n = keys
    h = mix(first ^ np.uint64(0x9E3779B97F4A7C15))
    h += last * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= n.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    h = mix(h)
    long = np.flatnonzero(n > SHORT)
    if len(long):
        h[long] = xxh64(data, starts[long], ends[long])
    return h


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range."""
    return key_hashes(data, starts, ends, word_keys(data, starts, ends))


def equal_ranges(a: np.ndarray, a_from: np.ndarray, b: np.ndarray, b_from: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether n[i] bytes of ``a`` from a_from[i] are those of ``b`` from b_from[i]; works in pieces of bounded size."""
    out, lo, total = np.ones(len(n), bool), 0, np.cumsum(n)
    while lo < len(n):
        done = int(total[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, done + CHUNK_BYTES, side="right")))
        for skip in range(0, int(n[lo]) if hi == lo + 1 else 1, CHUNK_BYTES):
            k = np.minimum(n[lo:hi] - skip, CHUNK_BYTES) if hi == lo + 1 else n[lo:hi]
            step = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + skip
            same = a[np.repeat(a_from[lo:hi], k) + step] == b[np.repeat(b_from[lo:hi], k) + step]
            out[lo:hi] &= np.add.reduceat(np.append(~same, False), np.cumsum(k) - k, dtype=np.int64)[: hi - lo] == 0
        lo = hi
    return out


_Q = 0xC2B2AE3D27D4EB4F


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n consecutive word hashes (also across texts: the caller drops those)."""
    out_len = len(h) - n + 1
    if out_len <= 0:
        return np.zeros(0, np.uint64)
    power, span, done, total = h, 1, 0, np.zeros(out_len, np.uint64)
    left = n
    while left:
        if left & 1:
            total += power[done : done + out_len] * np.uint64(pow(_Q, done, 1 << 64))
            done += span
        left >>= 1
        if left:
            power = power[:-span] + power[span:] * np.uint64(pow(_Q, span, 1 << 64))
            span *= 2
    return mix(total)


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of each byte range of ``data``."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    at8 = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    at4 = np.ndarray((len(data) + 1,), "<u4", padded, 0, (1,))
    length = ends - starts
    pos = starts.copy()
    acc = np.full(len(starts), (seed + int(_P5)) % (1 << 64), np.uint64)
    long = np.flatnonzero(length >= 32)
    if len(long):
        p, left = starts[long], length[long]
        lanes = (seed + int(_P1) + int(_P2), seed + int(_P2), seed, seed - int(_P1))
        v = [np.full(len(long), x % (1 << 64), np.uint64) for x in lanes]
        live = np.arange(len(long))
        while len(live):
            for k in range(4):
                v[k][live] = _round(v[k][live], at8[p[live] + 8 * k])
            p[live] += 32
            left[live] -= 32
            live = live[left[live] >= 32]
        a = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for k in range(4):
            a = (a ^ _round(np.zeros(len(long), np.uint64), v[k])) * _P1 + _P4
        acc[long], pos[long] = a, p
    acc += length.astype(np.uint64)
    for _ in range(3):
        m = np.flatnonzero(ends - pos >= 8)
        if not len(m):
            break
        k = _round(np.uint64(0), at8[pos[m]])
        acc[m] = _rotl(acc[m] ^ k, 27) * _P1 + _P4
        pos[m] += 8
    m = np.flatnonzero(ends - pos >= 4)
    acc[m] = _rotl(acc[m] ^ (at4[pos[m]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    pos[m] += 4
    for _ in range(3):
        m = np.flatnonzero(ends > pos)
        if not len(m):
            break
        acc[m] = _rotl(acc[m] ^ (padded[pos[m]].astype(np.uint64) * _P5), 11) * _P1
        pos[m] += 1
    acc ^= acc >> np.uint64(33)
    acc *= _P2
    acc ^= acc >> np.uint64(29)
    acc *= _P3
    acc ^= acc >> np.uint64(32)
    return acc
