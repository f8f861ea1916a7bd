"""The WARC reader on damaged, unusual and large archives."""

import base64
import gzip
import hashlib
import io
import tracemalloc

import numpy as np
import pytest

from tallyspark.llm import warc

PAGES = "page_id long, url string, html string"


def pack(raw):
    return gzip.compress(raw, 4, mtime=0)


def small(n=4, zipped=False):
    recs = [warc.record(i, f"http://x/{i}", b"body %d " % i * 9, 1 if i == 2 else None) for i in range(n)]
    return [pack(r) for r in recs] if zipped else recs


def found(raw):
    got = list(warc.salvage(io.BytesIO(raw), len(raw)))
    names = [p.headers["warc-record-id"] for p in got if p.kind == "record"]
    return got, [int(x[12:-1]) if x[12:-1].isdigit() else x for x in names]


def covered(got, size):
    at = 0
    for p in got:
        if p.inner_offset in (None, 0) and p.n_bytes is not None:
            assert p.offset == at
            at += p.n_bytes
    assert at == size


def write(tmp_path, files):
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    return [(f"file://{tmp_path}/{name}",) for name in files]


@pytest.mark.parametrize("zipped", [False, True])
def test_damage_between_and_inside_records(zipped):
    recs = small(6, zipped)
    at = np.cumsum([0, *map(len, recs)])
    raw = bytearray(b"".join(recs))
    raw[at[3] + len(recs[3]) - 20] ^= 255
    raw = bytes(raw[: at[4]] + b"junk WARC/1.0 \x1f\x8b\x08 junk" + raw[at[4] : at[6] - 7])
    got, names = found(raw)
    assert names == [0, 1, 2, 4, *[5] * zipped]  # the last member lacks its end alone: the record's digest holds
    assert [p.kind for p in got if p.n_bytes] == ["record"] * 3 + ["gap", "record", "gap"]
    covered(got, len(raw))


@pytest.mark.parametrize("zipped", [False, True])
def test_every_byte_damaged(spark, tmp_path, monkeypatch, zipped):
    """No flipped byte stops the reader or costs another record than its own."""
    monkeypatch.setattr(warc, "MOST_TASKS", 8)
    recs = small(3, zipped)
    raw, at = b"".join(recs), np.cumsum([0, *map(len, recs)])
    files = {}
    for k in range(len(raw)):
        files[f"{k}.warc"] = raw[:k] + bytes([raw[k] ^ (1 << k % 8)]) + raw[k + 1 :]
        for flip in (0xFF, 0x20):
            got, names = found(raw[:k] + bytes([raw[k] ^ flip]) + raw[k + 1 :])
            covered(got, len(raw))
    paths = spark.createDataFrame(write(tmp_path, files), "path string")
    rows = warc.scan(paths).select("kind", "path", "offset", "n_bytes", "page_id", "payload").collect()
    good = {}
    for r in rows:
        if r.kind == "record":
            good.setdefault(r.path, []).append(r)
    for path, in paths.collect():
        k = int(path.split("/")[-1][:-5])
        own = int(np.searchsorted(at, k, side="right")) - 1
        rest = {r.offset: r for r in good.get(path, ()) if r.offset != at[own]}
        assert sorted(rest) == [a for i, a in enumerate(at[:-1].tolist()) if i != own]
        assert all(r.page_id == i and (i == 2 or bytes(r.payload) == b"body %d " % i * 9) for i, r in ((at.tolist().index(a), r) for a, r in rest.items()))


@pytest.mark.parametrize("compressed", [False, True])
def test_long_urls_and_clashing_columns(spark, compressed):
    rows = [(1, "http://x/" + "u" * (2 << 20), "text", "a", 1, 2), (2, "http://y", "other", None, 3, None), (3, "a\r\nb: c\n", "x" * 3_000_000, None, None, None), (4, None, "", None, None, None), (5, " ", None, None, None, None)]
    docs = spark.createDataFrame(rows, PAGES + ", digest string, size long, holder long")
    got = {r.page_id: r for r in warc.round_trip(docs, compressed).collect()}
    assert {i: r.payload_digest for i, r in got.items()} == {r[0]: hashlib.sha1((r[2] or "").encode()).hexdigest() for r in rows}
    uri = warc.workspace(spark, "longurls")
    kept = {r.page_id: r.url for r in warc.records(warc.write(docs, uri, compressed=compressed)).collect()}
    assert kept[1] == rows[0][1] and kept[3] == "a b: c"


def test_several_records_in_a_member(spark, tmp_path):
    recs = small(6)
    whole = pack(b"".join(recs))
    holed = pack(recs[0] + b"WARC/1.0\r\nno such header\r\n\r\n" + recs[1] + recs[2])
    cut = pack(b"".join(small(400)))
    cut = cut[: len(cut) // 2]
    paths = spark.createDataFrame(write(tmp_path, {"whole.gz": whole, "holed.gz": holed, "cut.gz": cut + recs[5]}), "path string")
    records, log = warc.salvage_files(paths, warc.workspace(spark, "salvage"))
    rows = records.collect()
    of = lambda name: sorted((r.inner_offset or 0, r.page_id) for r in rows if r.path.endswith(name))
    assert [i for _, i in of("whole.gz")] == list(range(6)) and [i for _, i in of("holed.gz")] == [0, 1, 2]
    ids = [i for _, i in of("cut.gz")]
    assert 5 in ids and sorted(ids)[:100] == sorted([*range(99), 5])
    gaps = {r.path.split("/")[-1]: r for r in log.collect()}
    assert sorted(gaps) == ["cut.gz", "holed.gz"] and gaps["holed.gz"].inner_offset == len(recs[0]) and gaps["holed.gz"].inner_bytes == 28
    assert sorted(map(tuple, log.collect())) == sorted(map(tuple, warc.gaps(paths).collect()))


def test_digests_of_other_forms(spark, tmp_path):
    rec, raw = warc.record(1, "u", b"payload", None), b"payload"
    b32 = base64.b32encode(hashlib.sha1(raw).digest())
    forms = {"lower": b32.lower(), "hex": hashlib.sha1(raw).hexdigest().encode(), "HEX": hashlib.sha1(raw).hexdigest().upper().encode()}
    files = {k: rec.replace(b"Payload-Digest: sha1:" + b32, b"Payload-Digest: sha1:" + v) for k, v in forms.items()}
    files |= {"md5": rec.replace(b"sha1:" + b32, b"md5:" + hashlib.md5(raw).hexdigest().encode()), "sha256": rec.replace(b"sha1:" + b32, b"SHA-256:" + hashlib.sha256(raw).hexdigest().encode()), "blake": rec.replace(b"sha1:" + b32, b"blake3:zzz")}
    bad = {"short": rec.replace(b32, b32[:-3]), "odd": rec.replace(b32, b"!" * 32), "other": rec.replace(b32, b"A" * 32)}
    bad |= {"huge": rec.replace(b"<urn:x-page:1>", b"<urn:x-page:%s>" % (b"9" * 5000)), "length": rec.replace(b"Content-Length: ", b"Content-Length: %s" % (b"1" * 5000), 1)}
    rows = warc.scan(spark.createDataFrame(write(tmp_path, files | bad), "path string")).collect()
    assert {r.path.split("/")[-1]: r.kind for r in rows} == {k: "record" if k in files else "gap" for k in files | bad}


def test_damaged_lengths_cost_no_memory():
    rec = warc.record(1, "u", b"payload", None)
    wrong = rec.replace(b"Content-Length: ", b"Content-Length: 9999999", 1)
    bomb = pack(b"WARC/1.0\r\nContent-Length: 90000000\r\n\r\n" + bytes(80 << 20)) + pack(rec)
    plain = wrong + bytes(60 << 20) + rec + b"WARC/1.0\r\na:" + b"x" * (40 << 20)
    tracemalloc.start()
    assert found(bomb)[1] == [1] and found(plain)[1] == [1]
    assert tracemalloc.get_traced_memory()[1] < 40 << 20
    tracemalloc.stop()


def test_lost_records_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(warc, "salvage_files", lambda paths, uri, payloads: (warc.records(paths, payloads).limit(1), warc.gaps(paths)))
    with pytest.raises(RuntimeError, match="2 records"):
        warc.round_trip(spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], PAGES))


def other(version, *headers, block=b"HTTP/1.1 200 OK\r\n\r\nsome payload"):
    """A record with extra header lines, as other writers make them."""
    head = [version, b"WARC-Type: response", b"WARC-Record-ID: <urn:x-page:7>", *headers, b"WARC-Payload-Digest: " + warc._digest(warc.payload_of(block)).encode(), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("zipped", [False, True])
@pytest.mark.parametrize("version", [b"WARC/0.17", b"WARC/0.18", b"WARC/1.0", b"WARC/1.1", b"WARC/2.0"])
def test_folded_headers_and_any_version(spark, tmp_path, zipped, version):
    """Through scan(): a target that goes on over two lines, one header over 5000 lines, after damage too."""
    folded = other(version, b"WARC-Target-URI: http://x/", b"\ta b", b"  c", b"Note: a", *[b" " + b"y" * 20] * 5000)
    recs = [other(version), folded, b"junk", other(version, b"WARC-Target-URI: http://y/")]
    raw = b"".join(pack(r) if zipped and r != b"junk" else r for r in recs)
    rows = warc.scan(spark.createDataFrame(write(tmp_path, {"a": raw}), "path string")).orderBy("offset").collect()
    assert [(r.kind, r.url) for r in rows] == [("record", None), ("record", "http://x/ a b c"), ("gap", None), ("record", "http://y/")]
    assert {r.payload_digest for r in rows if r.kind == "record"} == {hashlib.sha1(b"some payload").hexdigest()}


@pytest.mark.parametrize("line", [b" folded from nothing", b": no name", b"no colon"])
def test_headers_that_are_still_malformed(line):
    head, rest = other(b"WARC/1.1").split(b"\r\n", 1)
    got, names = found(head + b"\r\n" + line + b"\r\n" + rest)
    assert [p.kind for p in got] == ["gap"] and got[0].reason == "malformed header"
