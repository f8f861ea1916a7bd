"""Re-Pair grammars: complete, exact, smaller than a general compressor's output."""

import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import packing, repair, shared, tokens
from test_operators import thue_morse

RNG = np.random.default_rng(1)
CASES = {
    "empty": np.zeros(0, np.uint32),
    "one": np.array([7]),
    "run": np.full(100_001, 3),
    "runs": np.repeat(RNG.integers(0, 4, 5000), RNG.integers(1, 30, 5000)),
    "copies": np.tile(RNG.integers(0, 50_000, 3000), 40),
    "rising copies": np.tile(np.arange(5000), 9),
    "prefixes": np.concatenate([np.arange(n) for n in range(1, 400)]),
    "random": RNG.integers(0, 300, 50_000),
    "wide": RNG.choice(RNG.integers(0, 2**24, 50), 9000),
}


def most_frequent_pair(seq):
    times, i = {}, 0
    last = {}
    for i in range(len(seq) - 1):  # occurrences of a pair don't overlap
        pair = (seq[i], seq[i + 1])
        if last.get(pair) != i - 1 or pair[0] != pair[1]:
            times[pair] = times.get(pair, 0) + 1
            last[pair] = i
    return max(times.values(), default=0)


@pytest.mark.parametrize("name", CASES)
def test_no_pair_is_left_and_every_id_comes_back(name):
    ids = CASES[name].astype(np.uint32)
    began = time.perf_counter()
    seq, rules, base = repair.compress(ids)
    assert time.perf_counter() - began < 10
    assert most_frequent_pair(seq.tolist()) < repair.LEAST
    shard = repair.Shard(repair.serialise(seq, rules, base, np.array([0, len(ids) // 3, len(ids)]), [1, None]))
    assert (shard.decode(0, len(ids)) == ids).all() and (shard.document(1) == ids[len(ids) // 3 :]).all()
    for _ in range(30 if len(ids) else 0):
        a, b = sorted(RNG.integers(0, len(ids) + 1, 2).tolist())
        assert (shard.decode(a, b - a) == ids[a:b]).all()
    assert (shard.lengths == repair.expansion_lengths(rules, base)).all()


def test_bits():
    for width in (0, 1, 7, 17, 31):
        x = RNG.integers(0, 2**width, 70_001)
        raw = np.frombuffer(repair.pack_bits(x, width) + bytes(8), np.uint8)
        assert (repair.unpack_bits(raw, width, 0, len(x)) == x).all() and (repair.unpack_bits(raw, width, 66_000, 66_009) == x[66_000:66_009]).all()


def test_files_are_smaller_than_zlib_of_the_ids(spark):
    docs = shared.table(spark, "/root/testdata/sf0.1", "documents").orderBy("doc_id").limit(4000)
    own = tokens.encoder("byte_bpe_50k.json")
    ids, n = own.encode(docs.select("doc_id", "text").toArrow()["text"].combine_chunks())
    ids = np.insert(ids, np.cumsum(n), 0)[: repair.SHARD_TOKENS]
    seq, rules, base = repair.compress(ids)
    raw = repair.serialise(seq, rules, base, np.array([0, len(ids)]), [1])
    assert len(raw) < len(zlib.compress(ids.astype("<u2").tobytes(), 6))
    assert most_frequent_pair(seq.tolist()) < repair.LEAST


def test_words_that_share_a_polynomial_hash(spark):
    """op3 and op7 keep two words apart whose polynomial hashes are the same."""
    docs = spark.createDataFrame(list(enumerate(thue_morse())), "doc_id long, text string").coalesce(1)
    for name, got in (("byte_bpe_50k.json", repair.round_trip(docs)), ("word_bpe_49k.json", packing.pack_documents(docs))):
        own = tokens.encoder(name)
        assert {r.doc_id: r.ids_crc32 for r in got.collect()} == {i: zlib.crc32(np.array([*own.library(t), 0], "<u4").tobytes()) for i, t in enumerate(thue_morse())}


def test_rows_of_one_id_and_clashing_columns(spark):
    rows = [(5, t, 1, "x") for t in ("b" * 80 + "2", "b" * 80 + "1", None, "a", "a")] + [(None, "z", 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int, start string").repartition(3)
    made = repair.write(docs, shared.workspace(spark, "rp"), shard_tokens=20)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids) for r in repair.read(made).collect())
    own, want, at = tokens.encoder("byte_bpe_50k.json"), [], 0
    for i, t in [(None, "z"), (5, ""), (5, "a"), (5, "a"), (5, "b" * 80 + "1"), (5, "b" * 80 + "2")]:
        ids = [*own.library(t), 0]
        want.append((at, i, len(ids), ids))
        at += len(ids)
    assert got == want


@pytest.mark.parametrize("slice_bytes", [1 << 20, 300])
def test_shards_keep_their_bound(spark, monkeypatch, slice_bytes):
    """Long texts side by side, and one that is longer than a shard: no other shard has over a tenth more than its ids."""
    monkeypatch.setattr(repair, "SLICE_BYTES", slice_bytes)
    rng = np.random.default_rng(8)
    text = lambda n: " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n))
    rows = [(i, text(int(rng.integers(1, 300)))) for i in range(60)] + [(60, text(3000)), (61, None), (62, ""), (63, text(5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    made = repair.write(docs, repair.workspace(spark, "bound"), shard_tokens=1500).orderBy("part", "file")
    files = made.collect()
    assert sum(f.n_docs for f in files) == 64 and len(files) > 5
    assert [f.n_docs for f in files if f.n_tokens > 1650] == [1]
    got = {r.doc_id: r.ids for r in repair.read(made).collect()}
    own = repair.encoder("byte_bpe_50k.json")
    assert all(got[i] == [*own.library(t or ""), 0] for i, t in rows)


def test_places_are_not_sorted_indirectly(monkeypatch):
    """Pairs and places are sorted as plain numbers: sorting indices of all places took most of op3's seconds. Ids too wide for that go the other way."""
    sizes, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *a, **k: sizes.append(len(x)) or sort(x, *a, **k))
    ids = np.minimum(RNG.zipf(1.3, 200_000), 40_000).astype(np.uint32)
    seq, rules, base = repair.compress(ids)
    assert max(sizes) < len(ids) // 8 and most_frequent_pair(seq.tolist()) < repair.LEAST
    ids = np.append(ids, repair.MOST_IDS - 1)  # two symbols of 25 bits and a place of 18
    seq, rules, base = repair.compress(ids)
    assert max(sizes) > len(ids) // 2 and most_frequent_pair(seq.tolist()) < repair.LEAST
    assert (repair.Shard(repair.serialise(seq, rules, base, np.array([0, len(ids)]), [1])).decode(0, len(ids)) == ids).all()


def test_both_ways_of_grouping_agree():
    for top, n in ((9, 500), (2000, 90_000)):
        left, right = RNG.integers(0, top, (2, n)).astype(np.uint32)
        at, out = np.sort(RNG.choice(10 * n, n, replace=False)), np.sort(RNG.choice(n, n // 7, replace=False))
        a = repair._grouped(left, right, at, out, top)
        b = repair._grouped(left, right, at, out, 1 << 30)
        stay = np.delete(np.arange(n), out)
        want = sorted(zip(left[stay].tolist(), right[stay].tolist(), at[stay].tolist(), strict=True))
        for key, place, wide in (a, b):
            assert (key[1:] >= key[:-1]).all()
            got = sorted(zip((key >> np.uint64(wide)).tolist(), (key & np.uint64((1 << wide) - 1)).tolist(), place.tolist(), strict=True))
            assert got == want


@pytest.mark.parametrize("name", CASES)
def test_expansions_are_held_or_taken_apart(name, monkeypatch):
    """Where all expansions fit in the pool none is taken apart; where they don't the ids are the same."""
    ids = CASES[name].astype(np.uint32)
    seq, rules, base = repair.compress(ids)
    raw = repair.serialise(seq, rules, base, np.array([0, len(ids)]), [1])
    if int(repair.expansion_lengths(rules, base).sum()) <= repair._POOL:
        shard = repair.Shard(raw)
        assert shard.whole >= int(shard.lengths.max(initial=0))
        assert (shard.decode(0, len(ids)) == ids).all()
    for pool in (0, 1000):
        monkeypatch.setattr(repair, "_POOL", pool)
        shard = repair.Shard(raw)
        assert len(shard.pool) <= base + max(pool, int(shard.lengths[shard.lengths <= repair._WHOLE].sum()))
        assert (shard.decode(0, len(ids)) == ids).all()


def test_a_task_reads_several_files(spark):
    """A task for each file spent half its time on starting; few files still have a task each."""
    for files, tasks in ((0, 1), (5, 5), (600, 150)):
        manifest = spark.range(files).selectExpr("cast(id as string) AS path", "id AS start")
        assert repair.read(manifest).rdd.getNumPartitions() == tasks


def test_chunks_with_any_letters_are_the_librarys():
    own = tokens.encoder("byte_bpe_50k.json")
    texts = ["", "a", " r\u00e9. \u00fcber-\u00e4hnlich l'\u00e9t\u00e9's", "x\ty\nz", "na\u00efve caf\u00e9\u201c\u201d 12\u00e9 \u00e9" + "\u00e9" * 30, "\u4f60\u597d \u00e9", "q" * 200 + " " + "q" * 17, "it's 12345 $%& <|endoftext|> caf\u00e9"]
    for some in (texts, texts[:1], texts[1:2]):
        ids, n = own.encode(pa.array(some))
        assert ids.tolist() == [t for x in some for t in own.library(x)] and n.tolist() == [len(own.library(x)) for x in some]
