"""Token ids of whole texts through the ``tokenizers`` library, each distinct piece of text encoded once.

Both kinds of vocabulary split a text into pre-tokens before any merge, and no merge crosses
a pre-token, so a text's ids are its pre-tokens' ids one after another. The library's model
encodes each distinct chunk (one or a few whole pre-tokens, often with the space before) once
for each Python worker; a compact bounded table holds the ids, and whole batches are looked
up at a time. The table compares the chunks themselves, not just their hashes. Texts with characters whose normalisation or class could depend on context,
and texts that hold a special token's string, go to the library whole.
"""

from __future__ import annotations

import json
from codecs import charmap_decode
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tokenizers

from . import textkernel as K

#: Characters for which the split below is the library's own: each stays as it is under NFC,
#: lower-cases by itself, and is a letter, a digit or punctuation in every Unicode version.
_ODD = regex.compile("[^\n\t\r -~¡-©«-±´-¸»¿-ÖØ-öø-ÿĀ-įĲ-ňŊ-žА-я‐-‧€™]")
#: Slots of a worker's table (a power of two) and the entries after which it starts anew.
SLOTS, ENTRIES = 1 << 22, 1_500_000
_ODD_CHUNK = 0xFFFF  # the length that marks a chunk for the library
_LEAD = 32  # added to a chunk's length where no space comes before it
#: Bytes of long chunks that a worker's table holds before it starts anew.
_LONG_BYTES = 32 << 20
_SPACE, _BLANK, _LETTER, _OTHER, _APOSTROPHE, _DIGIT, _WIDE = range(7)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[9, 10, 11, 12, 13]] = _BLANK
_KIND[32] = _SPACE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[0x27] = _APOSTROPHE
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x80:] = _WIDE
#: Whether no pattern of the libraries' split goes on between two neighbours, by 7 * left + right: at white space, around a
#: digit (in the second table between digits as well), between an ASCII letter and other ASCII characters (a letter after an
#: apostrophe stays with it: "'s"). What holds other characters may be several of the library's.
_ENDS = np.zeros((2, 7, 7), bool)
_ENDS[:, [_SPACE, _BLANK, _DIGIT], :] = _ENDS[:, :, [_SPACE, _BLANK, _DIGIT]] = True
_ENDS[:, _LETTER, [_OTHER, _APOSTROPHE]] = _ENDS[:, _OTHER, _LETTER] = True
_ENDS[0, _DIGIT, _DIGIT] = False
# as tables of bytes.translate(), which is several times faster than indices
_KINDS, _BLANKS, _ENDS = _KIND.tobytes(), (_KIND <= _BLANK).tobytes(), [np.pad(x.ravel(), (0, 207)).tobytes() for x in _ENDS]


def _look_up(data: np.ndarray | bytes, table: bytes, kind: type = np.uint8) -> np.ndarray:
    """Each byte's entry of a table of 256."""
    return np.frombuffer((data if isinstance(data, bytes) else data.tobytes()).translate(table), kind)


def split(data: np.ndarray, off: np.ndarray, digits: bool, blanks: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of chunks that no pre-token crosses, and each text's first one (n + 1): no spaces, other white
    space only if ``blanks`` are chunks; ``digits``: each one alone."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    kind = _look_up(data, _KINDS)
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = _look_up(kind[:-1] * np.uint8(7) + kind[1:], _ENDS[int(digits)], bool)
    cut[off] = True
    at = np.flatnonzero(cut)
    real = np.flatnonzero(kind[at[:-1]] > (_SPACE if blanks else _BLANK))
    starts = at[real]
    return starts, at[real + 1], np.searchsorted(starts, off)


def _byte_letters() -> str:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(rest)) for b in range(256))


class Table:
    """A table from chunks to runs of ids, as flat arrays. A chunk of at most ``K.SHORT`` bytes is its first
    eight and last eight bytes and its length; longer ones are keys of a dictionary. Entries are numbered as they come."""

    def __init__(self, slots: int, entries: int):
        self.mask, self.entries = np.uint64(slots - 1), entries
        self.clear()

    def clear(self) -> None:
        self.slot = np.zeros(int(self.mask) + 1, np.uint32)  # an entry's number and one, or zero
        self.first, self.last, self.length = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.uint8)
        self.at, self.size = np.zeros(1 << 12, np.uint32), np.zeros(1 << 12, np.uint16)
        self.pool, self.used, self.n = np.zeros(1 << 16, np.uint32), 0, 0
        self.long: dict[tuple[bytes, bool], int] = {}
        self.long_bytes = 0

    def full(self) -> bool:
        return self.n > self.entries or self.long_bytes > _LONG_BYTES

    def find(self, h: np.ndarray, first: np.ndarray, last: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Each short chunk's entry, or -1."""
        slot = (h & self.mask).astype(np.int64)
        out = self.slot[slot].astype(np.int64) - 1
        # most are in the first slot looked at (an empty one's number, -1, is some entry's index here)
        other = (self.first[out] != first) | (self.last[out] != last) | (self.length[out] != length)
        live = np.flatnonzero(other & (out >= 0))
        out[live] = -1
        slot[live] = (slot[live] + 1) & int(self.mask)
        while len(live):
            k = self.slot[slot[live]].astype(np.int64) - 1
            live, k = live[k >= 0], k[k >= 0]
            hit = (self.first[k] == first[live]) & (self.last[k] == last[live]) & (self.length[k] == length[live])
            out[live[hit]] = k[hit]
            live = live[~hit]
            slot[live] = (slot[live] + 1) & int(self.mask)
        return out

    def _store(self, ids: list[list[int] | None]) -> np.ndarray:
        """New entries; None marks a chunk for the library."""
        sizes = np.array([_ODD_CHUNK if x is None else len(x) for x in ids], np.uint16)
        flat = np.array([t for x in ids if x is not None for t in x], np.uint32)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        while self.n + len(ids) > len(self.at):
            for name in ("first", "last", "length", "at", "size"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        new = np.arange(self.n, self.n + len(ids))
        lengths = np.where(sizes == _ODD_CHUNK, 0, sizes).astype(np.int64)
        self.at[new], self.size[new] = self.used + np.cumsum(lengths) - lengths, sizes
        self.used += len(flat)
        self.n += len(ids)
        return new

    def add(self, h: np.ndarray, first: np.ndarray, last: np.ndarray, length: np.ndarray, ids: list[list[int] | None]) -> None:
        """Put distinct new short chunks in."""
        new = self._store(ids)
        self.first[new], self.last[new], self.length[new] = first, last, length
        slot = (h & self.mask).astype(np.int64)
        live = np.arange(len(h))
        while len(live):
            free = live[self.slot[slot[live]] == 0]
            self.slot[slot[free]] = new[free] + 1  # of several for one slot, the last stays
            live = live[self.slot[slot[live]] != new[live] + 1]
            slot[live] = (slot[live] + 1) & int(self.mask)

    def add_long(self, keys: list[tuple[bytes, bool]], ids: list[list[int] | None]) -> None:
        self.long.update(zip(keys, self._store(ids).tolist(), strict=True))
        self.long_bytes += sum(len(k) for k, _ in keys)


class Encoder:
    """Ids, or their numbers alone, of the texts of Arrow columns."""

    def __init__(self, path: str):
        self.whole = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        self.special = [t["content"] for t in conf.get("added_tokens", [])]
        self.words = bool(conf["model"].get("end_of_word_suffix"))
        self.known = conf["model"]["type"] == "BPE" and "ByteLevel" in json.dumps(conf.get("pre_tokenizer"))
        if self.words:
            self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        else:
            self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.tokenize = self.whole.model.tokenize
        self.letters = _byte_letters()
        self.pieces: dict[str, list[int]] = {}
        self.table = Table(SLOTS, ENTRIES)

    def library(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _model(self, piece: bytes) -> list[int]:
        """A pre-token's ids by the library's model."""
        return [t.id for t in self.tokenize(charmap_decode(piece, "strict", self.letters)[0])]

    def _piece(self, piece: str) -> list[int]:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self._model(piece.encode())
            if len(self.pieces) >= 20_000:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def _chunk(self, chunk: str, plain: bool) -> list[int] | None:
        if not plain and _ODD.search(chunk):
            return None
        if self.words:
            chunk = chunk.lower()
        if chunk.isascii() and "'" not in chunk and (len(chunk) == 1 or not self.words or not chunk.isdigit()):
            got = self._model(chunk.encode())  # one pre-token
        elif len(pieces := self.pattern.findall(chunk)) == 1:
            got = self._model(pieces[0].encode())
        else:
            got = [t for p in pieces for t in self._piece(p)]
        return got if len(got) < _ODD_CHUNK else None

    def odd(self, chunks: list[str]) -> np.ndarray:
        """Which of some chunks hold a character or a special string that leaves their text to the library."""
        joined = "\n".join(chunks)
        if not _ODD.search(joined) and not any(x in joined for x in self.special):
            return np.zeros(len(chunks), bool)
        return np.array([bool(_ODD.search(c)) or any(x in c for x in self.special) for c in chunks], bool)

    def size(self, chunk: str) -> int:
        """The number of ids of a chunk that isn't odd, by the library's model."""
        ids = self._chunk(chunk, True)
        return len(ids) if ids is not None else sum(len(self._piece(p)) for p in self.pattern.findall(chunk.lower()))

    def _ids(self, chunks: list[bytes]) -> list[list[int] | None]:
        plain = not _ODD.search(b"\n".join(chunks).decode())
        tokenize, letters, words, out = self.tokenize, self.letters, self.words, []
        for x in chunks:
            # most chunks are one pre-token of visible ASCII characters, or of a space before some
            if plain and x.isascii() and x > b" " and b"'" not in x and not (words and x.isdigit() and len(x) > 1):
                got = [t.id for t in tokenize(charmap_decode(x.lower() if words else x, "strict", letters)[0])]
                out.append(got if len(got) < _ODD_CHUNK else None)
            else:
                out.append(self._chunk(x.decode(), plain))
        return out

    def _slots(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of some texts: the entry of each chunk, each text's first chunk (n + 1), and the texts left to the library."""
        n = len(off) - 1
        odd = np.zeros(n, bool)
        raw = data.tobytes()
        if any(x.encode() in raw for x in self.special):
            odd |= np.array([any(x.encode() in raw[a:b] for x in self.special) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)], bool)
        if self.words:
            data = K.LOWER[data]
            raw = data.tobytes()
        s, e, first = split(data, off, self.words, not self.words)
        keys = K.word_keys(data, s, e)
        h = K.key_hashes(data, s, e, keys)
        lead = np.ones(len(s), bool)
        if not self.words and len(s):
            # white space is one space, which goes with what follows, or another blank that stands alone
            blank = _look_up(raw, _BLANKS, bool)
            bad = np.zeros(len(data) + 1, bool)
            bad[1:-1] = blank[1:] & blank[:-1]
            bad[off] = False  # texts side by side
            filled = off[1:] > off[:-1]
            bad[off[:-1][filled]] |= blank[off[:-1][filled]]
            bad[off[1:][filled] - 1] |= blank[off[1:][filled] - 1]
            odd |= np.diff(np.searchsorted(np.flatnonzero(bad), off)) > 0
            lead = (data[np.maximum(s, 1) - 1] != 32) | (s == 0)
            lead[first[:-1][first[1:] > first[:-1]]] = True
        if self.table.full():
            self.table.clear()
        from_ = s - ~lead
        # longer chunks are looked up too, and never found, as none of their length is in
        key = (h, keys[0], keys[1], np.minimum(keys[2], K.SHORT + 1).astype(np.uint8) + np.uint8(_LEAD) * lead)
        slot = self.table.find(*key)
        missing, long = np.flatnonzero((slot < 0) & (keys[2] <= K.SHORT)), np.flatnonzero(keys[2] > K.SHORT)
        while missing.size:  # chunks that share a hash take a turn each
            which = missing[np.unique(key[0][missing], return_index=True)[1]]
            self.table.add(*(k[which] for k in key), self._ids([raw[a:b] for a, b in zip(from_[which].tolist(), e[which].tolist(), strict=True)]))
            slot[missing] = self.table.find(*(k[missing] for k in key))
            missing = missing[slot[missing] < 0]
        if len(long):
            own = [(raw[a:b], x) for a, b, x in zip(s[long].tolist(), e[long].tolist(), lead[long].tolist(), strict=True)]
            new = {x: raw[a:b] for x, a, b in zip(own, from_[long].tolist(), e[long].tolist(), strict=True) if x not in self.table.long}
            self.table.add_long(list(new), self._ids(list(new.values())))
            slot[long] = [self.table.long[x] for x in own]
        odd |= np.add.reduceat(np.append(self.table.size[slot] == _ODD_CHUNK, False), first[:-1], dtype=np.int64) * (first[1:] > first[:-1]) > 0
        return slot, first, odd

    def encode(self, column: pa.Array) -> "tuple[np.ndarray, np.ndarray]":
        """All ids one after another (unsigned 32-bit) and each text's number of ids."""
        return self._run(column, True)

    def counts(self, column: pa.Array) -> np.ndarray:
        """Each text's number of ids: the sums of its chunks' numbers; the ids themselves are never built."""
        return self._run(column, False)[1]

    def _run(self, column: pa.Array, want_ids: bool) -> tuple[np.ndarray, np.ndarray]:
        data, off = K.text_buffer(column)
        parts, numbers = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for lo, hi in K.chunks(off):
            here, at = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
            if not self.known:
                slot, first, odd = np.zeros(0, np.int64), np.zeros(hi - lo + 1, np.int64), np.ones(hi - lo, bool)
            else:
                slot, first, odd = self._slots(here, at)
            size = self.table.size[slot].astype(np.int64)
            size[size == _ODD_CHUNK] = 0
            ends = np.concatenate([[0], np.cumsum(size)])
            number = ends[first[1:]] - ends[first[:-1]]
            own = {}
            for k in np.flatnonzero(odd).tolist():
                own[k] = self.library(bytes(here[at[k] : at[k + 1]]).decode())
                number[k] = len(own[k])
            numbers.append(number)
            if want_ids:
                total = int(ends[-1])
                where = np.repeat(self.table.at[slot].astype(np.int64) - ends[:-1], size) + np.arange(total)
                ids = self.table.pool[where]
                if own:
                    cut = ends[first]
                    ids = np.concatenate([np.array(own[k], np.uint32) if k in own else ids[cut[k] : cut[k + 1]] for k in range(hi - lo)])
                parts.append(ids)
        return np.concatenate(parts), np.concatenate(numbers)


@lru_cache(maxsize=1)
def encoder(name: str) -> Encoder:
    """One encoder for each Python worker: its table lasts across batches and tasks.

    ``name``: an absolute path, or the name of a file that ``public_tokenizers`` knows on the worker's machine.
    """
    if not name.startswith("/"):
        import public_tokenizers

        name = public_tokenizers.path(name)
    return Encoder(name)
