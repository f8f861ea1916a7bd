"""Whole operators, and the whole pipeline, against plain versions."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import brute
import corpus_pipeline
from tallyspark.llm import ftrl, licenses, linedup, packing, quality_rules, shared, textkernel, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long, site string, `h1` string"


def prose(rng, n, letters="abcdefghijklmnop"):
    return ["".join(rng.choice(list(letters), int(rng.integers(2, 9)))) for _ in range(n)]


def corpus(seed=1):
    """Documents of three sources with outliers, copies, shared lines, benchmark passages, nulls and empty texts; the benchmark."""
    rng = np.random.default_rng(seed)
    bench = [" ".join(prose(rng, 14)) for _ in range(5)]
    shared_line = " ".join(prose(rng, 12))
    rows = []
    for i in range(220):
        w = prose(rng, int(rng.integers(70, 260)))
        if i % 10 == 3:
            w = [x.upper() + "#$|" for x in w]  # unlike the rest
        text = " ".join(w)
        if i % 7 == 0:
            text = text[: len(text) // 2] + "\n" + shared_line + "\n" + text[len(text) // 2 :]
        if i % 13 == 0:
            text += " " + bench[i % 5].upper()
        rows.append([i, text, "en" if i % 50 else "xx", f"s{i % 12 if i % 7 == 0 else i % 2}", len(text), None, "h"])
    for i in range(60):  # near copies: some words replaced, some exact
        w = rows[int(rng.integers(0, 220))][1].split(" ")
        for at in rng.integers(0, len(w), int(rng.integers(0, 3))):
            w[at] = "changed"
        rows.append([220 + i, " ".join(w), "en", f"s{i % 2}", 1, "site", None])
    rows += [[300, None, None, None, None, None, None], [301, "", "en", "s1", 0, None, None], [302, "few words", "en", "s1", 9, None, None], [None, rows[5][1], "en", "s1", 3, None, None], [None, " ".join(prose(rng, 90)), "en", "s1", 3, None, None]]
    rows += [rows[8], rows[8]]
    return rows, bench


def test_op10_equals_a_plain_version(spark):
    rows, _ = corpus()
    got = quality_rules.judge(spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], DOCS)).collect()
    want = brute.judge([(r[1], r[2], r[3]) for r in rows])
    assert len(got) == len(rows) and 20 < sum(not w[2] for w in want) < 100
    for r in got:
        b, d, kept = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_upper, r.base_failed) == b
        assert (r.distance is None) == (d is None) and (d is None or abs(r.distance - d) <= 1e-4 * max(1, d))
        assert r.kept == kept


def test_op4_near_the_threshold(spark):
    """Lines on 900 to 1100 sites: sketches alone would err, the exact counts near the threshold don't."""
    rng = np.random.default_rng(2)
    sites = {f"line {k}": int(n) for k, n in enumerate([*rng.integers(930, 1070, 25), 999, 1000, 1001, 700, 1300, 2])}
    rows = [(i, "\n".join(x for x, n in sites.items() if i < n), f"site{i}") for i in range(1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    got = {r.doc_id: r.text for r in linedup.drop_boilerplate(docs, min_sites=1000).collect()}
    assert got[0] == rows[0][1]
    gone = {x for x, n in sites.items() if n >= 1000}
    assert all(got[i] == "\n".join(x for x in t.split("\n") if x not in gone) for i, t, _ in rows[1:])


def test_op4_equals_a_plain_version(spark):
    rows, _ = corpus(3)
    rows += [[None, rows[7][1], "en", "new", 1, None, None], [0, rows[14][1], "en", "other", 1, None, None], [0, None, "en", "other", 1, None, None]]
    docs = spark.createDataFrame(rows, DOCS)
    out = linedup.drop_boilerplate(docs, min_sites=4)
    want = brute.drop_lines([(r[0], r[1], r[3]) for r in rows], 4)
    assert out.columns == docs.columns
    assert sorted(map(str, (tuple(r)[:2] for r in out.collect()))) == sorted(str((r[0], w)) for r, w in zip(rows, want, strict=True))
    assert sum(w != r[1] for r, w in zip(rows, want, strict=True)) > 20


def test_op4_long_text(spark):
    """A text of 200,000 lines of which half are boilerplate takes seconds."""
    text = "\n".join(f"line {k % 50_000} {'x' * (k % 2)}" for k in range(200_000))
    rows = [(i, text if i == 3 else text[:600_000], f"s{i}") for i in range(4)]
    got = {r.doc_id: r.text for r in linedup.drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=4).collect()}
    assert got == dict(zip(range(4), brute.drop_lines(rows, 4), strict=True))


def plain_containment(text, template):
    def grams(t):
        w = brute.item_words(t)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    own = grams(template)
    return len(own & grams(text)) / len(own)


def test_op6_equals_exact_containment(spark):
    """Templates with words put in, left out or changed, between other words: found if and only if a share of 0.8 is there."""
    rng = np.random.default_rng(5)
    rows = [(0, None), (1, ""), (2, " ".join(prose(rng, 400))), (3, "word")]
    for text in licenses.TEMPLATES.values():
        for edits in (0, 1, 2, 3, 5):
            w = text.split()
            for _ in range(edits):
                at, kind = int(rng.integers(0, len(w))), rng.integers(0, 3)
                w[at : at + (kind > 0)] = prose(rng, 1) if kind < 2 else []
            rows.append((len(rows), " ".join([*prose(rng, int(rng.integers(0, 300))), *w, *prose(rng, int(rng.integers(0, 60)))])))
        half = text.split()
        rows.append((len(rows), " ".join([*half[: len(half) // 2], *prose(rng, 12), *half[len(half) // 2 :]])))
    rows += [(len(rows) + k, " ".join([*prose(rng, 40), a, *prose(rng, 3), b])) for k, (a, b) in enumerate(zip(licenses.TEMPLATES.values(), list(licenses.TEMPLATES.values())[1:], strict=False))]
    want = {i: {n: c for n, t in licenses.TEMPLATES.items() if (c := plain_containment(text, t)) >= 0.8} for i, text in rows}
    assert sum(map(len, want.values())) > 80
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.report(docs).collect()}
    assert {i: set(r.licenses.split(",")) - {""} for i, r in got.items()} == {i: set(x) for i, x in want.items()}
    assert all(abs(got[i].containment - max(x.values(), default=0)) < 1e-9 for i, x in want.items())
    for r in licenses.matches(docs).collect():
        inside = rows[r.doc_id][1].encode()[r.byte_start : r.byte_end].decode()
        assert plain_containment(inside, licenses.TEMPLATES[r.license]) >= 0.8
    with pytest.raises(ValueError, match="templates"):
        licenses.report(docs, templates={"x": "a " * licenses.TEMPLATE_BYTES})


def plain_features(text):
    """Strings of a text's tokens, pairs and shapes, as often as they occur."""
    tok = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff\x20\x09-\x0D]+", text or "")
    is_word = [bool(re.match(r"[0-9A-Za-z\x80-\U0010ffff]", t)) for t in tok]

    def shape(i):
        if not is_word[i]:
            return tok[i]
        ups = sum("A" <= c <= "Z" for c in tok[i])
        case = 0 if not ups else 1 if ups == len(tok[i].encode()) and len(tok[i].encode()) > 1 else 2
        again = (i > 0 and tok[i] == tok[i - 1]) + 2 * (i > 1 and tok[i] == tok[i - 2])
        return ("shape", case, again)

    one = [("t", t) for t in tok] + [("p", *tok[i : i + 2]) for i in range(len(tok) - 1)]
    return one + [("s", shape(i), shape(i + 1), shape(i + 2)) for i in range(len(tok) - 2)]


def test_op9_features_are_the_plain_ones():
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice(["Aa", "AB", "b", "c,", "é!", "x1", "..", "b"], int(rng.integers(0, 40)))) for _ in range(200)] + [None, "", " \n"]
    data, off = textkernel.text_buffer(pa.array(texts))
    cells, cut = ftrl.features(data, off)
    name = {}
    for t, a, b in zip(texts, cut, cut[1:], strict=False):
        own, got = plain_features(t), cells[a:b].tolist()
        assert len(own) == len(got)
        times = sorted(np.unique(got, return_counts=True)[1]) if got else []
        if len(set(got)) == len(set(own)):  # no two features share a cell
            assert times == sorted(own.count(x) for x in set(own))
        for x in set(own):
            name.setdefault(x, None)
    assert len(name) > 300


def test_op9_updates_are_ftrl_proximal():
    rng = np.random.default_rng(8)
    rows = [(rng.integers(0, 40, int(rng.integers(0, 30))), int(y)) for y in rng.integers(0, 2, 60)]
    z, n, bias = {}, {}, 1 << ftrl.BITS

    def weight(i):
        if abs(z.get(i, 0.0)) <= ftrl.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * ftrl.L1) / ((ftrl.BETA + n[i] ** 0.5) / ftrl.ALPHA + ftrl.L2)

    def values(cells):
        count = {int(c): int((cells == c).sum()) for c in cells}
        norm = sum(count.values()) ** 0.5
        return {**{c: k**0.5 / norm for c, k in count.items()}, bias: 0.3}

    for _ in range(ftrl.EPOCHS):
        for cells, y in rows:
            x = values(cells)
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - y) * x[i]
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / ftrl.ALPHA * w[i]
                n[i] = old + g * g
    got = ftrl.train(rows)
    assert np.count_nonzero(got) <= 41
    assert max(abs(float(got[i]) - weight(i)) for i in z) < 1e-5


def test_op9_scores_bounds_and_awkward_tables(spark):
    rng = np.random.default_rng(9)
    good, bad = ["alpha beta gamma", "delta beta"], ["#$% ## $$", "%% #$"]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad, 5)), i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "alpha"), (7, "zz"), (500, None), (501, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None), (4, 0)], "doc_id long, quality int")
    weights = ftrl.fit(docs, labels, ~ftrl.held_out())
    got = {r.doc_id: r.score for r in ftrl.score(docs, weights).collect() if r.doc_id != 7}
    assert len(got) == 402 and got[500] == got[501] and all((got[i] > 0.5) == bool(y) for i, _, y in rows if i != 7)
    data, off = textkernel.text_buffer(pa.array([rows[2][1]]))
    cells, _ = ftrl.features(data, off)
    at, count = np.unique(cells, return_counts=True)
    own = float((np.sqrt(count) * weights[at]).sum() / len(cells) ** 0.5 + 0.3 * weights[-1])
    assert abs(got[2] - 1 / (1 + np.exp(-own))) < 1e-6
    held = {i for i in range(400) if zlib.crc32(str(i).encode()) % 3 == 1}
    other = spark.createDataFrame([(r[0], 1 - r[2] if r[0] in held else r[2]) for r in rows] + [(None, 1), (3, None), (4, 0)], "doc_id long, quality int")
    assert (ftrl.fit(docs, other, ~ftrl.held_out()) == weights).all()  # labels of the held-out third change nothing
    assert not (ftrl.fit(docs, labels, ~ftrl.held_out(), size=200) == weights).all()
    assert not ftrl.fit(docs, labels, ~ftrl.held_out(), size=3).any()
    assert ftrl.score(docs.limit(0), weights).count() == 0


def stages(rows, bench, min_sites):
    """The pipeline's stages in plain Python: the rows that each leaves."""
    kept = [r for r, j in zip(rows, brute.judge([(r[1], r[2], r[3]) for r in rows]), strict=True) if j[2]]
    texts = brute.drop_lines([(r[0], r[1], r[3]) for r in kept], min_sites)
    lines = [[r[0], t, *r[2:4], len(t) if t != r[1] else r[4], *r[5:]] for r, t in zip(kept, texts, strict=True)]
    by_id = sorted(lines, key=lambda r: (r[0] is None, r[0] or 0))
    root = brute.components([r[1] for r in by_id])
    one = [r for k, r in enumerate(by_id) if root[k] == k]
    clean = [r for r in one if not brute.hits(r[1], list(enumerate(bench)))[4]]
    return [kept, lines, one, clean]


def test_pipeline_equals_a_plain_version(spark, tmp_path):
    rows, bench = corpus(11)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), ("site", pa.string()), ("h1", pa.string())])
    pq.write_table(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": list(range(len(bench))), "text": bench}), tmp_path / "benchmark.parquet")
    docs, at, sf = shared.table(spark, str(tmp_path), "documents"), shared.workspace(spark, "stages"), str(tmp_path)
    want = stages(rows, bench, linedup.MIN_SITES)
    assert [len(rows), *map(len, want)] == sorted([len(rows), *map(len, want)], reverse=True) and len({len(w) for w in [rows, *want]}) == 4
    key = lambda r: str((r[0], r[1], r[2], r[3], r[4], r[5], r[6]))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        docs = shared.materialise(stage(spark, docs, sf), f"{at}/{k}")
        assert docs.columns == schema.names
        assert sorted(key(tuple(r)) for r in docs.collect()) == sorted(key(r) for r in want[k]), name
    own = tokens.encoder("word_bpe_49k.json")
    pieces = []
    for i, t, *_ in want[-1]:
        ids = np.array([*own.library(t), 0], "<u4")
        pieces += [(i, k // 2048, k, min(2048, len(ids) - k), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    got = corpus_pipeline.run(spark, sf).toPandas()
    assert sorted(map(str, ((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()))) == sorted(map(str, pieces))
    for _, x in got.sort_values("offset").groupby("sequence_id"):
        assert x.length.sum() <= packing.SEQUENCE and (x.length.cumsum() - x.length == x.offset).all()
    assert got.sequence_id.nunique() <= -(-got.length.sum() // packing.SEQUENCE) + 1


def test_pipeline_of_empty_tables(spark, tmp_path):
    rows, bench = corpus(11)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
    pq.write_table(schema.empty_table(), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}), tmp_path / "benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
