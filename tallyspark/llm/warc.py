"""WARC archives: a writer with payload revisits, and a reader that salvages damaged files.

The reader checks every record: version line, headers, declared length, the two line ends after
the block, the gzip member's own checksum, and the digests. Where a check fails it searches
for the next gzip member or version line (inside a member too) that starts a valid record, goes on there,
and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import filesystem, materialise, only, workspace, write_file

#: Bytes of records after which a writer begins another file: also what a reader holds at a time.
FILE_BYTES = 16 << 20
#: Payloads from this size on are stored once.
REVISIT_BYTES = 1000
#: Tasks that read archives: one for each file, up to so many.
MOST_TASKS = 50_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC = b"\x1f\x8b\x08"
#: How a record begins, and its version line: of any version.
_START = b"WARC/"
_VERSION = re.compile(rb"WARC/[0-9]{1,4}\.[0-9]{1,4}\r?\n")
_NAME = re.compile(r"<urn:x-page:(-?[0-9]+)>")
_LENGTH = re.compile(r"[0-9]{1,18}")


def _digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record's bytes: a response, or a revisit (headers alone) of the page named by ``refers_to``."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{page_id if page_id is not None else 'none'}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: {_digest(payload)}",
        f"WARC-Block-Digest: {_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(pages: DataFrame, uri: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", compressed: bool = True) -> DataFrame:
    """Write a record for every row (a null body is empty) and return the manifest: path, n_records, n_bytes.

    Of records with equal payloads of ``REVISIT_BYTES`` or more, that with the largest id is the response and
    the others revisit it; rows repeated under that id are responses too. Without any id all are responses.
    """
    src = only(pages, page_id=id_col, url=url_col, html=body_col).withColumn("page_id", F.col("page_id").cast("long"))
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    sized = src.select("page_id", "url", "html", F.octet_length(F.coalesce("html", F.lit(""))).alias("size"), F.when(F.octet_length(F.coalesce("html", F.lit(""))) >= REVISIT_BYTES, F.sha1(body)).alias("digest"))
    twice = sized.where("digest is not null").groupBy("digest").agg(F.max("page_id").alias("holder"), F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("d"), "holder")
    twice = materialise(twice, f"{uri}/repeated")  # its size is known from here on, so Spark broadcasts it only if small
    # a key of its own for every row that no other equals, so that they don't all meet in one task
    sized = sized.withColumn("digest", F.coalesce("digest", F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))))
    rows = sized.join(twice, sized.digest == twice.d, "left").select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, parts, size, n, file = TaskContext.get().partitionId(), [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal parts, size, n, file
            raw = b"".join(parts)
            path = write_file(uri, f"pages-{part:06d}-{file:06d}.warc" + ".gz" * compressed, raw)
            out = pa.record_batch([pa.array([path]), pa.array([n], pa.int64()), pa.array([len(raw)], pa.int64())], names=["path", "n_records", "n_bytes"])
            parts, size, n, file = [], 0, 0, file + 1
            return out

        for b in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = record(page_id, url, (html or "").encode(), refers_to)
                if compressed:
                    z = zlib.compressobj(4, zlib.DEFLATED, 31)
                    raw = z.compress(raw) + z.flush()
                parts.append(raw)
                size += len(raw)
                n += 1
                if size >= FILE_BYTES:
                    yield flush()
        if n:
            yield flush()

    return materialise(rows.mapInArrow(run, "path string, n_records long, n_bytes long"), f"{uri}/manifest")


class _Window:
    """Random reads of a file through a buffer of bounded size."""

    def __init__(self, f, size: int, reach: int = 4 << 20):
        self.f, self.size, self.reach, self.lo, self.buf = f, size, reach, 0, b""

    def get(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if at < self.lo or at + n > self.lo + len(self.buf):
            self.f.seek(at)
            self.lo, self.buf = at, self.f.read(max(n, min(self.reach, self.size - at)))
        return self.buf[at - self.lo : at - self.lo + n]


class _Member:
    """Random reads of what the gzip member at ``at`` inflates to, through a buffer of bounded size: what lies
    before the buffer is inflated anew. ``error`` says what is wrong with the member, ``length`` its bytes in the file."""

    def __init__(self, window: _Window, at: int):
        self.window, self.at, self.error, self.length, self.size = window, at, "", 0, 0
        self._restart()
        while self._more():
            self._drop(self.lo + len(self.buf))
        self.size = self.lo + len(self.buf)

    def _restart(self) -> None:
        self.z, self.pos, self.lo, self.buf, self.done = zlib.decompressobj(31), self.at, 0, bytearray(), False

    def _drop(self, at: int) -> None:
        if len(self.buf) > 2 * self.window.reach and (cut := min(at - self.window.reach, self.lo + len(self.buf)) - self.lo) > 0:
            del self.buf[:cut]
            self.lo += cut

    def _more(self) -> bool:
        if self.done:
            return False
        raw = self.z.unconsumed_tail or self.window.get(self.pos, 1 << 16)
        fresh = not self.z.unconsumed_tail
        try:
            self.buf += self.z.decompress(raw, 1 << 20)
        except zlib.error as e:
            self.done, self.error = True, f"gzip: {e}"[:80]
            return False
        self.pos += len(raw) if fresh else 0
        if self.z.eof:
            self.done, self.length = True, self.pos - len(self.z.unused_data) - self.at
        elif not raw:
            self.done, self.error = True, "truncated member"
        return not self.done

    def get(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if at < self.lo:
            self._restart()
        while self.lo + len(self.buf) < at + n and not self.done:
            self._more()
            self._drop(at)
        return bytes(self.buf[at - self.lo : at - self.lo + n])


def _find(src, what: bytes, at: int) -> int:
    """The first place of ``what`` from ``at`` on, read piece by piece; or -1."""
    while raw := src.get(at, 1 << 16):
        if (k := raw.find(what)) >= 0:
            return at + k
        if len(raw) < len(what):
            break
        at += len(raw) - len(what) + 1
    return -1


def _headers(src, at: int) -> tuple[dict[str, str], int] | str:
    """Headers and the place where the block begins; or what is wrong. Headers may be of any length, and folded: a line
    that begins with white space goes on with the header before it, after one space."""
    raw = src.get(at, 1 << 12)
    m = _VERSION.match(raw)
    if not m:
        return "no version line"
    end = raw.find(b"\r\n\r\n", m.end() - 2)
    if end < 0:  # line by line to their real end
        pos = at + m.end()
        while True:
            stop = _find(src, b"\n", pos)
            if stop < 0:
                return "headers don't end"
            if src.get(pos, 2) == b"\r\n":
                break
            if src.get(pos, 1) not in (b" ", b"\t") and b":" not in src.get(pos, min(stop - pos, 1 << 10)):
                return "malformed header"
            pos = stop + 1
        end = pos - 2 - at
        raw = src.get(at, end + 4)
    lines: list[bytes] = []
    for line in raw[m.end() : end].split(b"\r\n"):
        if b"\n" in line or b"\r" in line:
            return "malformed header"
        if line[:1] in (b" ", b"\t") and lines:  # a folded line goes on with the header before it
            lines[-1] += b" " + line.strip()
        else:
            lines.append(line)
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            return "malformed header"
        out[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    if not _LENGTH.fullmatch(out.get("content-length", "")):
        return "no content length"
    if not out.get("warc-type") or not out.get("warc-record-id"):
        return "no type or no record id"
    return out, at + end + 4


def _said(header: str) -> tuple[str, bytes] | None | str:
    """A digest header's algorithm and value (base 32 or hexadecimal, in either case); None if there is none that
    can be checked; or what is wrong."""
    name, colon, value = header.partition(":")
    name = name.lower().replace("-", "")
    if not header or name not in ("md5", "sha1", "sha256", "sha512"):
        return None
    size = hashlib.new(name).digest_size
    try:
        raw = bytes.fromhex(value) if len(value) == 2 * size else base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except ValueError:
        return "malformed digest"
    return (name, raw) if len(raw) == size else "malformed digest"


def _differs(header: str, raw: bytes) -> str:
    """What is wrong with a digest header of some bytes; empty if nothing is."""
    said = _said(header)
    if said is None or isinstance(said, str):
        return said or ""
    return "" if hashlib.new(said[0], raw).digest() == said[1] else "digest"


def _record(src, at: int, trusted: bool = True) -> tuple[dict[str, str], bytes, int] | str:
    """The valid record at ``at``: headers, block, its whole length; or what is wrong. Where the bytes aren't
    ``trusted`` (a damaged member's) only a record whose block has a digest can be valid.

    A block is read only if two line ends follow where it should end, so a damaged length costs no memory."""
    got = _headers(src, at)
    if isinstance(got, str):
        return got
    head, begin = got
    size = int(head["content-length"])
    if src.get(begin + size, 4) != b"\r\n\r\n":
        return "the block doesn't end where declared"
    said = head.get("warc-block-digest", "")
    if not trusted and _said(said) is None:
        return "a damaged member's record without a digest"
    block = src.get(begin, size)
    if wrong := _differs(said, block):
        return f"block {wrong}"
    return head, block, begin + size + 4 - at


class Piece(NamedTuple):
    """A record or a gap: its bytes in the file (the whole member's, where it is in one; of a damaged
    member they aren't known) and in the inflated member."""

    kind: str
    offset: int
    n_bytes: int | None
    inner_offset: int | None
    inner_bytes: int | None
    reason: str | None
    headers: dict[str, str] | None = None
    block: bytes | None = None


def _inside(member: _Member) -> Iterator[Piece]:
    """The records and gaps of an inflated member, in order; a damaged member's last gap is left to the caller."""
    at, bad, why, length = 0, -1, "", None if member.error else member.length
    while at < member.size:
        got = _record(member, at, not member.error)
        if isinstance(got, str):
            bad, why = (at, got) if bad < 0 else (bad, why)
            at = _find(member, _START, at + 1)
            if at < 0:
                break
            continue
        if bad >= 0:
            yield Piece("gap", member.at, length, bad, at - bad, why)
            bad = -1
        yield Piece("record", member.at, length, at, got[2], None, got[0], got[1])
        at += got[2]
    if bad >= 0 and not member.error:
        yield Piece("gap", member.at, length, bad, member.size - bad, why)
    elif not member.size and not member.error:
        yield Piece("gap", member.at, length, 0, 0, "an empty member")


def salvage(f, size: int) -> Iterator[Piece]:
    """All records and gaps of a file, in order: every byte is in a record, in a member or in a gap.

    After a failed check the search goes on for the next gzip member or version line, inside members too. Of a
    member that breaks off or fails its checksum the records before the damage are kept if their digests hold.
    Memory is bounded by a few buffers and the largest valid record.
    """
    window, at, bad, why = _Window(f, size), 0, -1, ""
    while at < size:
        start, pieces, step = window.get(at, 10), [], 0
        if start.startswith(_MAGIC):
            member = _Member(window, at)
            if not member.error:
                if bad >= 0:
                    yield Piece("gap", bad, at - bad, None, None, why)
                    bad = -1
                yield from _inside(member)
                at += member.length
                continue
            pieces, wrong = _inside(member), member.error
        elif start.startswith(_START):
            got = _record(window, at)
            if isinstance(got, str):
                wrong = got
            else:
                wrong, step, pieces = "", got[2], [Piece("record", at, got[2], None, None, None, got[0], got[1])]
        else:
            wrong = "neither a member nor a version line"
        for piece in pieces:
            if step and bad >= 0:
                yield Piece("gap", bad, at - bad, None, None, why)
                bad = -1
            yield piece
        if step:
            at += step
            continue
        bad, why = (at, wrong) if bad < 0 else (bad, why)
        # the next place that could start a record
        at += 1
        while raw := window.get(at, 1 << 16):
            found = [k for k in (raw.find(_MAGIC), raw.find(_START)) if k >= 0]
            if found or len(raw) < 7:
                at = at + min(found) if found else size
                break
            at += len(raw) - 6
    if bad >= 0:
        yield Piece("gap", bad, size - bad, None, None, why)


def payload_of(block: bytes) -> bytes:
    """The HTTP body of a response's block."""
    cut = block.find(b"\r\n\r\n")
    return block[cut + 4 :] if cut >= 0 and block.startswith(b"HTTP/") else block


def _number(name: str) -> int | None:
    """The page's number in a record's name, None for other names; beyond 64 bits it is an error."""
    m = _NAME.fullmatch(name)
    if m and not -(1 << 63) <= int(m[1][:24]) < 1 << 63:
        raise ValueError("a page's number beyond 64 bits")
    return int(m[1]) if m else None


def _fields(piece: Piece) -> list:
    """record_type, page_id, refers_to, url, payload_bytes, payload_digest (hex) and payload of a record."""
    head, said = piece.headers, piece.headers.get("warc-payload-digest", "")
    if head.get("warc-type") == "revisit":
        m = re.search(rb"\r\nContent-Length: ([0-9]{1,18})\r\n", piece.block)
        digest = _said(said)
        if isinstance(digest, str):
            raise ValueError(f"payload: {digest}")
        own = [int(m[1]) if m else None, digest[1].hex() if digest else None, None]
    else:
        payload = payload_of(piece.block)
        if wrong := _differs(said, payload):
            raise ValueError(f"payload {wrong}")
        own = [len(payload), hashlib.sha1(payload).hexdigest(), payload]
    return [head.get("warc-type"), _number(head.get("warc-record-id", "")), _number(head.get("warc-refers-to", "")), head.get("warc-target-uri"), *own]


_SCHEMA = "kind string, path string, offset long, n_bytes long, inner_offset long, inner_bytes long, reason string, record_type string, page_id long, refers_to long, url string, payload_bytes long, payload_digest string, payload binary"


def scan(paths: DataFrame, payloads: bool = True) -> DataFrame:
    """``paths``: a column path. A row for every record and every gap of the files: kind, path, offset, n_bytes,
    inner_offset and inner_bytes (in the inflated member, else null), reason (gaps), record_type, page_id, refers_to,
    url, payload_bytes, payload_digest (hex SHA-1) and, if asked for, payload.

    A response's digest and size are those of the payload as read; a record whose payload digest header disagrees or
    can't be read, or whose number is beyond 64 bits, is a gap. A revisit has no payload: its digest is the
    header's, its size the declared one.
    """
    names, kinds = zip(*(c.split() for c in _SCHEMA.split(", ")), strict=True)
    width = len(names) if payloads else len(names) - 1
    types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[k] for k in kinds]

    def row(path: str, piece: Piece) -> list:
        place = [path, piece.offset, piece.n_bytes, piece.inner_offset, piece.inner_bytes]
        if piece.kind == "gap":
            return ["gap", *place, piece.reason, *[None] * 7][:width]
        try:
            return ["record", *place, None, *_fields(piece)][:width]
        except ValueError as e:
            return ["gap", *place, str(e), *[None] * 7][:width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = lambda rows: pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), types, strict=False)], names=names[:width])
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, inner = filesystem(path)
                rows, size = [], 0
                with fs.open_input_file(inner) as f:
                    for piece in salvage(f, f.size()):
                        rows.append(row(path, piece))
                        size += 200 + len(rows[-1][10] or "") + (len(piece.block or b"") if payloads else 0)
                        if size > 8 << 20:
                            yield make(rows)
                            rows, size = [], 0
                if rows:
                    yield make(rows)

    some = only(paths, path="path")
    some = some.repartition(max(1, min(MOST_TASKS, some.count())))
    return some.mapInArrow(run, ", ".join(_SCHEMA.split(", ")[:width]))


def records(paths: DataFrame, payloads: bool = True) -> DataFrame:
    return scan(paths, payloads).where("kind = 'record'").drop("kind", "reason")


def gaps(paths: DataFrame) -> DataFrame:
    """The quarantined bytes: path, offset, n_bytes, inner_offset, inner_bytes, reason."""
    return scan(paths, False).where("kind = 'gap'").select("path", "offset", "n_bytes", "inner_offset", "inner_bytes", "reason")


def salvage_files(paths: DataFrame, uri: str, payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """Read the files once, below ``uri`` write what they hold, and return the records and the log of gaps."""
    both = materialise(scan(paths, payloads), f"{uri}/pieces")
    log = both.where("kind = 'gap'").select("path", "offset", "n_bytes", "inner_offset", "inner_bytes", "reason")
    return both.where("kind = 'record'").drop("kind", "reason"), materialise(log, f"{uri}/gaps")


def round_trip(pages: DataFrame, compressed: bool = True) -> DataFrame:
    """Write the pages and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A row for each row of ``pages``, whatever its length: null html is empty, null urls and ids stay null, repeated
    rows stay repeated (rows of one id and equal payloads are all responses if it is the largest id), an empty
    table gives no rows, other columns don't matter. An archive with a gap, or with other records than were written, is an error.
    """
    uri = workspace(pages.sparkSession, "warc")
    manifest = write(pages, uri, compressed=compressed)
    rows, lost = salvage_files(manifest, uri, payloads=False)
    written, read, n_gaps = manifest.agg(F.sum("n_records")).first()[0] or 0, rows.count(), lost.count()
    if n_gaps or written != read:
        raise RuntimeError(f"{written} records were written below {uri}, {read} and {n_gaps} gaps were read")
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
