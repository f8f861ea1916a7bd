"""The grouping genetic search against best fit decreasing, small optima, and on awkward tables."""

import itertools

import numpy as np
import pytest
import zlib

from tallyspark.llm import packing, shared, tokens

SIZE = 2048


def best_fit_decreasing(length):
    one = packing.Packing([], [])
    one.place(np.argsort(-length, kind="stable").tolist(), length.tolist(), SIZE)
    return len(one.bins)


def islands(length, n=2, epochs=packing.EPOCHS, migrate=True):
    best = [None] * n
    for epoch in range(epochs):
        came = [[x[0] for x in [*(best[k] or ()), *((best[k - 1] or ()) if migrate else ())]] for k in range(n)]
        best = [packing.breed(length, SIZE, epoch, k, came[k]) for k in range(n)]
    return min(b[0][1] for b in best)


def valid(length, chromosome, bins):
    fill = np.bincount(chromosome, weights=length)
    return len(chromosome) == len(length) and len(fill) == bins and (fill > 0).all() and (fill <= SIZE).all()


def test_crossover_beats_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for low, high in ((500, 1000), (400, 700), (300, 1100)):
        length = rng.integers(low, high, 1500)
        chromosome, bins, _ = packing.breed(length, SIZE, 0, 0, [])[0]
        assert valid(length, chromosome, bins)
        start = packing.evolve(length, SIZE, 0, [], generations=0)[0][1]
        assert bins < best_fit_decreasing(length) and bins < start


def test_what_comes_to_an_island_is_bred_on():
    """An island never ends with more bins than the best packing that stayed or came, and later epochs gain on the first."""
    rng = np.random.default_rng(7)
    some = [rng.integers(500, 1000, 700) for _ in range(4)]
    for length in some:
        elites = [x[0] for island in (0, 1) for x in packing.breed(length, SIZE, 0, island, [])]
        assert packing.breed(length, SIZE, 1, 0, elites)[0][1] <= min(int(x.max()) + 1 for x in elites)
    assert sum(islands(x, 3, 4) for x in some) < sum(islands(x, 3, 1) for x in some)


def test_never_worse_than_best_fit_decreasing_on_texts(spark):
    docs = shared.table(spark, "/root/testdata/sf0.1", "documents")
    got = packing.pack_documents(docs).toPandas()
    length = got.length.to_numpy()
    dealt = np.array_split(np.random.default_rng(5).permutation(length), -(-len(length) // packing.SHARD_PIECES))
    assert got.sequence_id.nunique() <= sum(map(best_fit_decreasing, dealt))
    assert got.sequence_id.nunique() - -(-length.sum() // SIZE) <= 2
    assert not got.duplicated(["doc_id", "piece"]).any()
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert x.length.sum() <= SIZE and (x.length.cumsum() - x.length == x.offset).all()


def optimum(length):
    """The fewest bins, by trying every partition."""
    best = len(length)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(length):
            best = len(rooms)
            return
        for r in {x: i for i, x in enumerate(rooms)}.values():
            if rooms[r] >= length[k]:
                go(k + 1, [*rooms[:r], rooms[r] - length[k], *rooms[r + 1 :]])
        go(k + 1, [*rooms, SIZE - length[k]])

    go(0, [])
    return best


def test_small_optima():
    rng = np.random.default_rng(3)
    for _ in range(40):
        length = np.sort(rng.integers(200, 1500, 9))[::-1].copy()
        assert islands(length) == optimum(length.tolist())


@pytest.mark.parametrize("length", [[], [1], [2048], [2048, 2048, 1], [1024] * 5])
def test_edges(length):
    chromosome, bins, _ = packing.breed(np.array(length, np.int64), SIZE, 0, 0, [])[0]
    assert valid(np.array(length), chromosome, bins) and bins == -(-sum(length) // SIZE)


def test_shards_leave_no_half_empty_bins(spark):
    """Pieces that a shard can't fill a bin with meet those of others: levels lose and repeat none."""
    rows = [(i, f"h{i % 3}", int(n)) for i, n in enumerate(itertools.chain(np.random.default_rng(4).integers(1, 2049, 400), [2048, 1, 1]))]
    parts = spark.createDataFrame(rows, "doc_id long, row_ string, length long")
    got = packing.pack(parts, shard_pieces=10).toPandas()
    assert sorted(got.doc_id) == list(range(len(rows))) and dict(zip(got.doc_id, got.length, strict=True)) == {r[0]: r[2] for r in rows}
    assert (got.groupby("sequence_id").length.sum() <= SIZE).all()
    alone = packing.pack(parts, shard_pieces=10_000).toPandas()
    assert got.sequence_id.nunique() < 1.12 * alone.sequence_id.nunique()


def test_clashing_columns_and_repeated_rows(spark):
    rows = [(1, "a b", 7, "s", 0), (1, "a b", 7, "s", 0), (None, None, None, None, None), (2, "c " * 3000, 1, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece long, shard string, row long")
    got = packing.pack_documents(docs).orderBy("doc_id", "piece").collect()
    own = tokens.encoder("word_bpe_49k.json")
    want = []
    for i, t in sorted(((r[0], r[1]) for r in rows), key=lambda r: r[0] or 0):
        ids = np.array([*own.library(t or ""), 0], "<u4")
        want += [(i, k // SIZE, k, min(SIZE, len(ids) - k), zlib.crc32(ids[k : k + SIZE].tobytes())) for k in range(0, len(ids), SIZE)]
    assert [tuple(r)[:5] for r in got] == want
