"""Suffix-array decontamination against brute force, and on hard texts."""

import time
import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tallyspark.llm import decontam, queries, textkernel
from test_operators import brute_hits, thue_morse

DOCS, BENCH = "doc_id long, text string", "item_id long, text string"


def few_words(seed, n, longest, letters="ab"):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(list(letters), int(rng.integers(0, longest)))) for _ in range(n)]


def test_suffix_array():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 400):
        seq = np.append(rng.integers(1, 3, n), 0)
        assert decontam.suffix_array(seq).tolist() == sorted(range(n + 1), key=lambda i: seq[i:].tolist())


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 40])
@pytest.mark.parametrize("weak", [False, True])
def test_verdicts_equal_brute_force(spark, monkeypatch, block, weak):
    if weak:  # all words of one length share a hash (in this process; workers are asked through Shard and Block below)
        monkeypatch.setattr(textkernel, "key_hashes", lambda data, s, e, keys: (keys[2] % 2).astype(np.uint64))
    texts, items = few_words(2, 60, 60), [(str(i), t) for i, t in enumerate(few_words(3, 12, 25, "abc"))]
    if weak:
        data, off = textkernel.text_buffer(pa.array(texts))
        shard, own = decontam.Shard(data, off), decontam.Block(items, 10)
        found = shard.search(own)
        dirty = set(shard.text(found.place).tolist())
        assert dirty == {i for i, t in enumerate(texts) if brute_hits(t, items)[4]} and len(dirty) > 5
        return
    got = decontam.report(spark.createDataFrame(list(enumerate(texts)), DOCS), spark.createDataFrame([(int(i), t) for i, t in items], BENCH), block_bytes=block).collect()
    assert sum(r.contaminated for r in got) > 5
    assert {r.doc_id: tuple(r)[1:] for r in got} == {i: brute_hits(t, items) for i, t in enumerate(texts)}


def test_matches_are_the_longest(spark):
    texts, items = few_words(4, 20, 30), few_words(5, 8, 20)
    want = set()
    for d, t in enumerate(texts):
        for i, x in enumerate(items):
            w, v = t.split(), x.split()
            for p in range(len(w)):
                for q in range(len(v)):
                    n = 0
                    while p + n < len(w) and q + n < len(v) and w[p + n] == v[q + n]:
                        n += 1
                    if n >= min(10, len(v)) and not (p and q and w[p - 1] == v[q - 1]):
                        want.add((d, str(i), p, q, n))
    got = decontam.matches(spark.createDataFrame(list(enumerate(texts)), DOCS), spark.createDataFrame(list(enumerate(items)), BENCH)).collect()
    assert want and {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    assert all(texts[r.doc_id].encode()[r.byte_start : r.byte_end].decode().split() == texts[r.doc_id].split()[r.doc_word : r.doc_word + r.n_words] for r in got)


def test_words_that_share_a_polynomial_hash(spark):
    a, b = thue_morse()
    got = decontam.report(spark.createDataFrame([(1, a), (2, b), (3, f"x {b} y")], DOCS), spark.createDataFrame([(7, a)], BENCH)).collect()
    assert {r.doc_id: r.n_hit for r in got} == {1: 1, 2: 0, 3: 0}


@pytest.mark.parametrize("words", [lambda: map(str, np.random.default_rng(6).integers(0, 10**6, 100_000)), lambda: ["a"] * 100_000])
def test_an_item_of_100_000_words(words):
    text = " ".join(words())
    tracemalloc.start()
    began = time.perf_counter()
    data, off = textkernel.text_buffer(pa.array([text, text, "b " + text]))
    shard = decontam.Shard(data, off)
    found = shard.search(decontam.Block([("x", text)], 10))
    assert time.perf_counter() - began < 20
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    assert len(np.unique(found.place)) == 3 * (100_000 - 9)


def test_op2_null_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c"), (None, "a b c"), (2, None), (3, "z")], DOCS)
    bench = spark.createDataFrame([(None, "b c"), (None, "a b"), (10, "a"), (9, "a b c")], BENCH)
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, r["items"]) for r in decontam.verdicts(docs, bench).collect()), key=str)
    assert got == [(0, 3, 3, ["10", "9", None]), (1, 3, 3, ["10", "9", None]), (2, 0, 0, []), (3, 1, 0, [])]
    assert decontam.report(docs.limit(0), bench).count() == 0 and decontam.report(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.drop_contaminated(docs, bench).orderBy("doc_id").collect() == docs.where("doc_id > 1").orderBy("doc_id").collect()
    c = duckdb.connect()
    c.register("documents", docs.toArrow())
    c.register("benchmark", bench.toArrow())
    want = c.execute(f"select doc_id, n_words, n_hit, n_items, items_sha256, contaminated from ({queries._OP2})").fetchall()
    got = [tuple(r) for r in decontam.report(docs, bench).collect()]
    assert sorted(str(r) for r in got if r[0]) == sorted(str(r) for r in want if r[0])
