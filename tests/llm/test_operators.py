"""The training-data operators against brute force, and on awkward tables."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash

from tallyspark.llm import components, decontam, ftrl, licenses, linedup, packing, quality_rules, queries, repair, shared, simhash, textkernel, tokencount, tokens, warc

KIND = "doc_id long, text string, lang string, source string, n_chars long, fp long, `h1` string, words int"
LONG = "lorem ipsum dolor sit amet consectetur " * 4000
ITEM = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [None, "", "   \n\t", "word", "a b", LONG, "same text here today again", "same text here today again", f"x {ITEM.upper()}! y", "é ü " * 40, "A\x0bB\x0cC", "line\nline\n\nline"]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, extra columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", None, 7, "h", 1) for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[6], (None, "no id at all", None, None, 3, None, None, None)]
    return spark.createDataFrame(rows, KIND).cache()


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, "word"), (3, None), (4, ""), (5, ITEM)], "item_id long, text string")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_xxh64():
    rng = np.random.default_rng(1)
    buf = rng.integers(0, 256, 5000).astype(np.uint8)
    s = rng.integers(0, 4800, 500)
    e = s + rng.integers(0, 120, 500)
    assert [int(x) for x in textkernel.xxh64(buf, s, e)] == [xxhash.xxh64_intdigest(bytes(buf[a:b]), 42) for a, b in zip(s, e, strict=True)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_are_the_librarys(name):
    texts = [*TEXTS, "  a  b ", "don't DON'T", "Σ ΑΣ", "a\x1cb", "x<|endoftext|>y", "日本語 ﬁ é", "  ² ½", "tab\there \n", "привет МИР", "'S'LL!!'s"]
    own = tokens.encoder(name)
    ids, n = own.encode(pa.array(texts, pa.string()))
    assert own.counts(pa.array(texts, pa.string())).tolist() == n.tolist()
    cut = np.concatenate([[0], np.cumsum(n)])
    for k, t in enumerate(texts):
        assert ids[cut[k] : cut[k + 1]].tolist() == own.library(t or ""), repr(t)[:40]


def test_op1_sql(spark, sf):
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    want = sorted(map(str, c.execute(f"select page_id, payload_digest, record_type, refers_to from ({queries._OP1})").fetchall()))
    got = queries.op1_warc_salvage(spark, sf).select("page_id", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_op1_revisits_and_awkward_rows(spark):
    big = "x" * 1500
    rows = [(1, "u", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (5, "u", None), (None, "u", big)]
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {(1, "revisit", 2, 1500), (2, "response", None, 1500), (3, "response", None, 5), (4, "response", None, 5), (5, "response", None, 0), (None, "revisit", 2, 1500)}
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def brute_hits(text, items):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    w, hit, hits = word(text), set(), set()
    for name, item in items:
        v = word(item)
        n = min(10, len(v))
        for i in range(len(v) - n + 1 if v else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == v[i : i + n]:
                    hit |= set(range(p, p + n))
                    hits.add(str(name))
    return len(w), len(hit), len(hits), hashlib.sha256(",".join(sorted(hits)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 10])
def test_op2_brute_force(awkward, bench, block):
    items = [(r.item_id, r.text) for r in bench.collect()]
    text = {r.doc_id: r.text for r in awkward.select("doc_id", "text").collect()}
    got = decontam.report(awkward, bench, block_bytes=block).collect()
    assert len(got) == awkward.count()
    for r in got:
        assert tuple(r)[1:] == brute_hits(text[r.doc_id], items)
    clean = decontam.drop_contaminated(awkward, bench, block_bytes=block)
    assert clean.columns == awkward.columns and clean.count() == sum(not r.contaminated for r in got)


def test_op2_longest_matches(spark, bench):
    docs = spark.createDataFrame([(1, f"zero {ITEM} end"), (2, " ".join(ITEM.split()[1:]))], "doc_id long, text string")
    got = sorted(tuple(r)[:5] for r in decontam.matches(docs, bench).collect())
    assert got == [(1, "1", 1, 0, 12), (1, "5", 1, 0, 12), (2, "1", 0, 1, 11), (2, "5", 0, 1, 11)]
    assert decontam.report(docs, bench.limit(0)).where("contaminated").count() == 0


def test_op3_round_trip(awkward):
    own, at = tokens.encoder("byte_bpe_50k.json"), 0
    rows = sorted(((r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for i, t in rows:
        ids = np.array([*own.library(t or ""), 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(str, map(tuple, repair.round_trip(awkward, shard_tokens=500).collect()))) == sorted(map(str, want))
    assert repair.round_trip(awkward.limit(0)).count() == 0


def test_op3_random_access():
    rng = np.random.default_rng(2)
    ids = np.repeat(rng.integers(0, 50, 9000), rng.integers(1, 4, 9000)).astype(np.uint32)
    seq, rules, base = repair.compress(ids)
    assert len(seq) < len(ids) / 2 and len(rules)
    shard = repair.Shard(repair.serialise(seq, rules, base, np.array([0, 5, len(ids)]), [1, None]))
    for a, n in ((0, len(ids)), (5, 1), (777, 3000), (len(ids) - 1, 1), (3, 0)):
        assert (shard.decode(a, n) == ids[a : a + n]).all()
    assert (shard.document(1) == ids[5:]).all() and shard.doc_ids == [1, None]


def test_op4_sql(spark, sf):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    assert sorted(map(str, map(tuple, queries.op4_line_spread(spark, sf).collect()))) == sorted(str(tuple(r)) for r in c.execute(f"select doc_id, n_lines, n_removed, text_sha256 from ({queries._OP4})").fetchall())


def test_op4_awkward(spark, awkward):
    out = linedup.drop_boilerplate(awkward, min_sites=2)
    got = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == awkward.columns and out.count() == awkward.count()
    assert got[6] == "same text here today again" and got[7] == "" and got[0] is None and got[2] == "   \n\t" and got[11] == "line\nline\n\nline"
    assert linedup.drop_boilerplate(awkward.limit(0)).count() == 0


def brute_fingerprint(text, k=3):
    w = spaced(lowered(text))
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_op5_brute_force(awkward):
    got = simhash.groups(awkward, shingle=3).collect()
    want = {r.doc_id: brute_fingerprint(r.text) for r in awkward.select("doc_id", "text").collect()}
    assert len(got) == awkward.count() and all(r.fp & (2**64 - 1) == want[r.doc_id] for r in got)
    for r in got:
        near = [i for i, f in want.items() if i is not None and bin(f ^ want[r.doc_id]).count("1") <= 3]
        assert r.component_id == min(near, default=None)
    kept = simhash.drop_near_duplicates(awkward, shingle=3)
    assert kept.columns == awkward.columns and kept.where("doc_id = 7").count() == 0 and kept.where("doc_id = 6").count() == 1
    assert simhash.groups(awkward.limit(0)).count() == 0


def test_op5_rows_are_told_apart_by_text(spark):
    rows = [(None, "one text of its own"), (None, "another text that is unlike it"), (None, "another text that is unlike it"), (None, None), (1, "a third"), (1, "a third"), (2, "a third"), (2, "two texts under one id")]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=3)
    assert kept.columns == ["doc_id", "text"]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [rows[0], rows[1], rows[3], rows[4], rows[7]]))


def near_roots(f, bits):
    u = f.view(np.uint64)
    pairs = [(i, j) for i in range(len(u)) for j in i + 1 + np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= bits)]
    a, b = components.forest(f[[i for i, _ in pairs]], f[[j for _, j in pairs]])
    return dict(zip(a.tolist(), b.tolist(), strict=True))


def linked_roots(spark, f, bits):
    got = simhash.links(spark.createDataFrame([(int(x),) for x in f], "fp long"), bits).collect()
    assert all(1 <= bin((r.u ^ r.v) & (2**64 - 1)).count("1") for r in got)
    a, b = components.forest(np.array([r.u for r in got], np.int64), np.array([r.v for r in got], np.int64))
    return dict(zip(a.tolist(), b.tolist(), strict=True))


@pytest.mark.parametrize("rows, part, leaf, hot, bits", [(5, 6, 4, 0, 3), (5, 6, 4, 32, 3), (20, 8000, 8, 0, 5), (20, 8000, 2, 16, 3), (20, 30, 300, 48, 3), (2000, 8000, 10, 40, 8), (9, 50, 4, 0, 0)])
def test_op5_links_lose_nothing_in_any_shard(spark, monkeypatch, rows, part, leaf, hot, bits):
    """Many small shards, parts, and trees inside shards; also where ``hot`` low bits are the same in all fingerprints."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", rows)
    monkeypatch.setattr(simhash, "PART_ROWS", part)
    monkeypatch.setattr(simhash.vptree, "LEAF", leaf)
    rng = np.random.default_rng(hot)
    base = [int(x) for x in rng.integers(0, 2**63, 150)]
    f = base + [x ^ sum(1 << int(b) for b in rng.choice(64 - hot, int(rng.integers(1, bits + 2)), replace=False) + hot) for x in base * 3]
    f = np.unique(np.array([(x >> hot << hot) & (2**63 - 1) for x in f], np.int64))
    assert linked_roots(spark, f, bits) == near_roots(f, bits)


def test_op5_default_trees_prune_and_visit(spark):
    """7000 fingerprints, the constants as they are: shards, boundary visits and pruned branches, and all links of brute force."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 5000)
    some = [int(x) ^ (1 << int(a)) ^ (1 << int(b)) for x, a, b in zip(base[:2000], rng.integers(0, 63, 2000), rng.integers(0, 63, 2000), strict=True)]
    f = np.unique(np.array([*map(int, base), *some], np.int64))
    seen = simhash.traffic(spark.createDataFrame([(int(x),) for x in f], "fp long"))
    assert seen["shards"] == 8 and seen["homes"] == 2 * len(f)
    assert 0 < seen["visits"] < seen["homes"] and seen["pruned"] > seen["homes"] / 4
    want = near_roots(f, 3)
    assert linked_roots(spark, f, 3) == want and len(want) > 1500


def test_op5_a_large_cluster_of_near_fingerprints():
    """5000 fingerprints of one half: no vantage point parts that half, so the whole fingerprints are parted."""
    rng = np.random.default_rng(7)
    high = np.unique(rng.integers(0, 2**31, 5000)).astype(np.uint64)
    fp = (high << np.uint64(32)) | np.uint64(77)
    got = list(simhash.vptree.near_pairs(fp & np.uint64(0xFFFFFFFF), fp, np.zeros(len(fp), bool), 1, 3))
    found = {(min(a, b), max(a, b)) for x, y in got for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
    i, j = np.nonzero(np.triu(near, 1))
    assert found == {(min(a, b), max(a, b)) for a, b in zip(fp[i].tolist(), fp[j].tolist(), strict=True)}


def test_op5_links_lose_nothing(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300)
    f = list(map(int, base))
    for x in map(int, base[:60]):  # chains and dense clusters around some
        for _ in range(60):
            y = x
            for b in rng.integers(0, 63, rng.integers(1, 4)):
                y ^= 1 << int(b)
            f.append(y)
    f = np.unique(np.array(f, np.int64))
    u = f.view(np.uint64)
    pairs = [(i, j) for i in range(len(u)) for j in i + 1 + np.flatnonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= 3)]
    a, b = components.forest(f[[i for i, _ in pairs]], f[[j for _, j in pairs]])
    want = dict(zip(a.tolist(), b.tolist(), strict=True))
    got = {r.node: r.root for r in components.connected_components(simhash.links(spark.createDataFrame([(int(x),) for x in f], "fp long"))).collect()}
    assert got == want


def test_op6_brute_force(spark, awkward):
    rng = np.random.default_rng(4)
    word = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))
    rows, want = [(0, None), (1, ""), (2, word(500))], {0: "", 1: "", 2: ""}
    for i, (name, text) in enumerate(licenses.TEMPLATES.items(), 3):
        rows.append((i, f"{word(int(rng.integers(0, 300)))} {text.upper()} {word(30)}"))
        want[i] = name
    got = {r.doc_id: r.licenses for r in licenses.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(w in got[i].split(",") for i, w in want.items())
    assert {i: got[i] for i in range(3)} == {i: want[i] for i in range(3)}
    assert licenses.report(awkward).where("n_licenses > 0").count() == 0
    assert licenses.matches(awkward.limit(0)).count() == 0


def test_op7_pieces_and_places(awkward):
    own = tokens.encoder("word_bpe_49k.json")
    text = {r.doc_id: r.text for r in awkward.select("doc_id", "text").collect()}
    got = packing.pack_documents(awkward, size=64).toPandas()
    for r in got.itertuples():
        doc = None if r.doc_id != r.doc_id else int(r.doc_id)
        ids = np.array([*own.library(text[doc] or ""), 0], "<u4")
        assert r.length == min(64, len(ids) - r.start) and r.start == 64 * r.piece
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert x.length.sum() <= 64 and (x.length.cumsum() - x.length == x.offset).all()
    assert got.sequence_id.nunique() == -(-got.length.sum() // 64)
    assert packing.pack_documents(awkward.limit(0)).count() == 0


def test_op7_breeding_keeps_every_item():
    rng = np.random.default_rng(5)
    length = rng.integers(300, 1100, 400)
    a, b = (packing.decode(packing.evolve(length, 2048, s, [], 0, 1)[0][0], length, 2048) for s in (1, 2))
    child = packing.crossover(a, b, length.tolist(), 2048, rng)
    assert sorted(i for x in child.bins for i in x) == list(range(400))
    assert all(sum(length[x]) + r == 2048 and r >= 0 for x, r in zip(child.bins, child.room, strict=True))


@pytest.mark.parametrize("head", [tokencount.HEAD_ROWS, 30, 0])
def test_op8_counts(awkward, monkeypatch, head):
    monkeypatch.setattr(tokencount, "HEAD_ROWS", head)
    own = tokens.encoder("word_bpe_49k.json")
    text = {r.doc_id: r.text for r in awkward.select("doc_id", "text").collect()}
    got = tokencount.token_counts(awkward).collect()
    assert len(got) == awkward.count()
    for r in got:
        n = len(own.library(text[r.doc_id] or ""))
        assert tuple(r)[1:] == (len((text[r.doc_id] or "").encode()), n, n > 2048)


def test_op8_whole_table(spark, sf, monkeypatch):
    monkeypatch.setattr(tokencount, "HEAD_ROWS", 500)
    own = tokens.encoder("word_bpe_49k.json")
    text = {r.doc_id: r.text for r in shared.table(spark, sf, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r.n_tokens for r in queries.op8_token_counts(spark, sf).collect()}
    assert got == {i: len(own.library(t or "")) for i, t in text.items()}


def test_op8_any_mix_of_characters():
    rng, own = np.random.default_rng(8), tokens.encoder("word_bpe_49k.json")
    texts = ["".join(rng.choice(list("abstrvelmd'''.,-<|>1 2\n\tASTé’€"), 40)) for _ in range(3000)]
    for _, _, _, _, first, which, distinct in tokencount._blocks(pa.array(texts)):
        assert not own.odd(distinct.to_pylist()).any()
        n = np.array([own.size(x) for x in distinct.to_pylist()])[which]
        assert [int(n[a:b].sum()) for a, b in zip(first, first[1:], strict=False)] == [len(own.library(t)) for t in texts]


def test_op8_edges(spark, awkward):
    own = tokens.encoder("word_bpe_49k.json")
    texts = ["ab" * 200_000, "a<|endoftext|>b c", "\u65e5\u672c\u8a9e", "\x1c", "Don't DON'T 12,5!! x", "''s '.s x''t'll're1's's9 a.b'c,d''e (I'D) O'Neil's--it's", "\u00e9'l l'\u00c9t\u00e9 don\u2019t x\u20ac5 A<|ENDOFTEXT|>B", "'S'Ve''Re'\u00e9'd", "!" * 70_000]
    got = tokencount.token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(own.library(t)) for i, t in enumerate(texts)}
    assert tokencount.token_counts(awkward.limit(0)).count() == 0
    other = tokens.encoder("byte_bpe_50k.json")
    got = tokencount.token_counts(awkward, tokenizer="byte_bpe_50k.json").where("doc_id = 8").first()
    assert got.n_tokens == len(other.library(TEXTS[8]))


def test_op9_held_out(spark, awkward, sf):
    at = "/root/testdata/sf0.01"
    truth = shared.table(spark, at, "labels").select("doc_id", "quality")
    got = queries.op9_ftrl_quality(spark, at).join(truth, "doc_id").toPandas()
    assert all((zlib.crc32(str(i).encode()) % 3 == 1) == h for i, h in zip(got.doc_id, got.held_out, strict=True))
    own = got[got.held_out]
    assert (own.predicted == own.quality).mean() > 0.97 and got.score.between(0, 1).all()
    none = ftrl.fit(awkward, truth.limit(0), ~ftrl.held_out())
    assert ftrl.score(awkward, none).where("score = 0.5").count() == awkward.count()


def brute_rules(text):
    w = spaced(text)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)} if len(tri) < 2000 else set(range(len(w)))
    lines = [x for x in (text or "").split("\n") if spaced(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again), len(w) < 50 or 100 * len(again) > 50 * len(w)


def test_op10_base(awkward):
    text = {r.doc_id: r.text for r in awkward.select("doc_id", "text").collect()}
    got = quality_rules.judge(awkward).collect()
    assert len(got) == awkward.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(text[r.doc_id])
        assert r.kept == (not r.base_failed)
    kept = quality_rules.keep_good(awkward)
    assert kept.columns == awkward.columns and quality_rules.judge(awkward.limit(0)).count() == 0


def test_op10_outliers(spark):
    at = "/root/testdata/sf0.01"
    truth = shared.table(spark, at, "labels").select("doc_id", "quality")
    got = queries.op10_mcd_outliers(spark, at).join(truth, "doc_id").where("not base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.98
    assert (~got[got.quality == 0].kept).mean() > 0.9


def test_op10_salted_joins_find_the_same(spark, sf, monkeypatch):
    want = sorted(map(tuple, queries.op10_mcd_outliers(spark, sf).collect()))
    monkeypatch.setattr(quality_rules, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, queries.op10_mcd_outliers(spark, sf).collect())) == want


def test_pipeline_small(spark, sf):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, sf).toPandas()
    ids = set(out.doc_id)
    kept = {r.doc_id for r in queries.op10_mcd_outliers(spark, sf).where("kept").collect()}
    assert ids and ids <= kept
    dirty = {r.doc_id for r in decontam.report(linedup.drop_boilerplate(shared.table(spark, sf, "documents").where(shared.F.col("doc_id").isin(list(kept)))), shared.table(spark, sf, "benchmark")).where("contaminated").collect()}
    assert not ids & dirty


def thue_morse():
    """Two unlike words of equal ends whose polynomial sums modulo 2 ** 64 are the same for every odd base."""
    t, other = "a", str.maketrans("ab", "ba")
    for _ in range(10):
        t += t.translate(other)
    return "c" * 8 + t + "c" * 8, "c" * 8 + t.translate(other) + "c" * 8


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_of_words_that_share_a_hash(name, monkeypatch):
    own = tokens.Encoder(public_tokenizers.path(name))
    a, b = thue_morse()
    texts = [a, b, "one two", "two one one", f"{b} {a}", "abcdefgh12345678 abcdefgh12345678x"]
    for weak in (False, True):
        if weak:  # every chunk has one of three hashes
            monkeypatch.setattr(textkernel, "key_hashes", lambda data, s, e, keys: (keys[2] % 3).astype(np.uint64))
            own.table.clear()
        ids, n = own.encode(pa.array(texts))
        cut = np.concatenate([[0], np.cumsum(n)])
        assert [ids[x:y].tolist() for x, y in zip(cut, cut[1:], strict=False)] == [own.library(t) for t in texts]


def test_equal_ranges():
    rng = np.random.default_rng(9)
    a = rng.integers(0, 2, 5000).astype(np.uint8)
    s, t, n = rng.integers(0, 2000, 400), rng.integers(0, 2000, 400), rng.integers(1, 12, 400)
    assert textkernel.equal_ranges(a, s, a, t, n).tolist() == [(a[x : x + k] == a[y : y + k]).all() for x, y, k in zip(s, t, n, strict=True)]
    big = np.zeros(3 << 20, np.uint8)
    big[-1] = 1
    assert textkernel.equal_ranges(big, np.array([0, 0]), big, np.array([0, 1]), np.array([len(big), len(big) - 1])).tolist() == [True, False]


def test_op9_one_long_text_doesnt_end_learning(spark):
    """The first text in the order of hashes is longer than all bytes there are: it is left out alone."""
    from pyspark.sql import functions as F

    ids = [r.id for r in spark.range(300).orderBy(F.xxhash64("id"), "id").collect()]
    rows = [(i, ("good clean words here " if i % 2 else "bad ### spam !!! ") * (4000 if i == ids[0] else 3), i % 2) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    fit = lambda d: ftrl.fit(d, d.select("doc_id", "quality"), F.lit(True), size=64 << 10)
    weights = fit(docs)
    assert (weights != 0).sum() > 10 and (weights == fit(docs.where(F.col("doc_id") != ids[0]))).all()
    scored = {r.doc_id: r.score for r in ftrl.score(docs, weights).collect()}
    assert all((scored[i] > 0.5) == bool(i % 2) for i in ids)


def test_op9_null_id_isnt_held_out(spark):
    assert spark.createDataFrame([(None,)], "doc_id long").select(ftrl.held_out()).first()[0] is False


def test_op6_the_band_index_finds_what_comparing_all_finds(spark, monkeypatch):
    """600 templates, some of them equal and some sharing their beginning, by sorted values and one by one."""
    rng = np.random.default_rng(9)
    word = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n))
    some = {f"t{k}": word(int(rng.integers(1, 60))) for k in range(300)}
    some |= {f"u{k}": some[f"t{k}"] if k % 3 else some[f"t{k}"] + " " + word(9) for k in range(300)}
    rows = [(k, f"{word(int(rng.integers(0, 80)))} {some[f't{int(rng.integers(0, 300))}']} {word(20)}") for k in range(60)] + [(60, ""), (61, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, licenses.matches(docs, templates=some).collect()))
    monkeypatch.setattr(licenses, "FEW", 1000)
    assert sorted(map(tuple, licenses.matches(docs, templates=some).collect())) == found and len(found) > 60
