"""Operators 11 to 13: fill-in-the-middle, source divergence, language identification."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import regex

from tallyspark.llm import divergence, fillin, langid, queries, textkernel
from tallyspark.llm.shared import table

KIND = "doc_id long, text string, lang string, source string, n_chars long, n long, form string, term string, rank int, lang_pred string, cells binary"
LONG = "Lorem ipsum dolor sit amet, consectetur é \n" * 4000
TEXTS = [None, "", "   \n\t", "word", "a b", LONG, "same text\nhere", "same text\nhere", "with <S> in it\nx", "é ü\r\n\n\n日本語", "12 34 !?", "no end\nat all", "\n", "<<P\n<S\n<M", "€ € €"]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, extra columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, None, 7, "h", "t", 1, "x", b"") for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[6], (None, "no id\nat all", None, None, 3, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, KIND).cache()


# 11 ------------------------------------------------------------------------------------------------------------------


def plain_fim(name, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    made = hashlib.sha256(f"7:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(made[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < 50 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h4 % 100 < 50 else "psm", len(p), len(m), sha(out), sha(text)


def test_op11_brute_force(awkward):
    got = sorted(map(str, map(tuple, fillin.report(awkward).collect())))
    want = [(r.doc_id, *plain_fim("" if r.doc_id is None else r.doc_id, r.text)) for r in awkward.select("doc_id", "text").collect()]
    assert got == sorted(map(str, want))
    assert fillin.report(awkward.limit(0)).count() == 0


def test_op11_whole_table(spark, sf):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_fill_in_middle(spark, sf).collect()}
    want = {r.doc_id: plain_fim(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()}
    assert got == want
    assert {"psm", "spm"} <= {v[1] for v in got.values()}


def test_op11_other_units_rates_and_marks(awkward):
    """Sentences, half of the texts plain, other marks: what comes out goes back, and rewrite() says the same."""
    how = {"unit": r"[^.]*\.", "marks": ("{pre}", "{suf}", "{mid}"), "seed": 3, "rate": 50, "spm_rate": 100}
    rows = fillin.transform(awkward, **how).collect()
    assert {r.form for r in rows} == {"plain", "spm"}
    text = {r.doc_id: r.text or "" for r in awkward.select("doc_id", "text").collect()}
    made = fillin.transform(awkward, **how)
    digests = made.select("doc_id", fillin.digest(made.output).alias("a"), fillin.digest(fillin.restore(made.output, made.form, how["marks"])).alias("b"))
    assert sorted(map(str, digests.collect())) == sorted(str(x).replace("output_sha256", "a").replace("restored_sha256", "b") for x in fillin.report(awkward, **how).select("doc_id", "output_sha256", "restored_sha256").collect())
    for r in rows:
        assert fillin.rebuilt(r.output, r.form, how["marks"]) == text[r.doc_id]
        assert r.n == len(regex.findall(how["unit"], text[r.doc_id]))
    again = fillin.rewrite(awkward, **how)
    assert again.columns == awkward.columns
    made = {r.doc_id: r.output for r in rows}
    assert all(r.text == made[r.doc_id] if text[r.doc_id] else not r.text for r in again.collect())


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "x"), ("abc", "b", "x")])
def test_op11_marks_that_could_be_mistaken(awkward, marks):
    with pytest.raises(ValueError):
        fillin.transform(awkward, marks=marks)


# 12 ------------------------------------------------------------------------------------------------------------------


def plain_audit(rows, min_docs=10, top=10):
    """All terms, all pairs, one at a time."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        own = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
        groups.add((lang, source))
        count[lang, source] += own
        docs[lang].update(own.keys())
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v, others = len(kept), sorted(s for x, s in groups if x == lang)
        total = sum((count[lang, s] for s in others), Counter())

        def shares(c, kept=kept, v=v):
            size = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (size + 2 * v) for t in kept}

        p, q = shares(count[lang, source]), shares(total)
        pairs = [(-sum(f(p[t], o[t]) for t in kept), s.encode(), s) for s in others if s != source for o in [shares(count[lang, s])]]
        terms = [(-f(p[t], q[t]), t.encode(), t) for t in kept if count[lang, source][t] and p[t] > q[t]]
        out += [(lang, source, "pair", s, -x, k) for k, (x, _, s) in enumerate(sorted(pairs), 1)]
        out += [(lang, source, "term", t, -x, k) for k, (x, _, t) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def mixed_rows(n, sources, seed=1):
    rng = np.random.default_rng(seed)
    words = ["The", "of", "Ünd", "ärger", "café", "x", "1st", "日本", "rare"] + [f"w{k}".translate(str.maketrans("0123456789", "abcdefghij")) for k in range(60)]
    rows = []
    for k in range(n):
        weight = 1 / (1 + np.arange(len(words)) + k % 5)
        text = " ".join(rng.choice(words, int(rng.integers(0, 40)), p=weight / weight.sum()))
        rows.append((text if k % 31 else None, ["en", "fr", None][k % 3] if k % 17 else "few", f"é{k % sources}" if k % 13 else None))
    return rows


@pytest.mark.parametrize("block", [divergence.BLOCK, 3])
def test_op12_brute_force(spark, monkeypatch, block):
    """In one block, and in blocks of three groups or postings."""
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = mixed_rows(400, 11)
    rows += [rows[0]] * 12 + [("only here", "xx", "a"), ("nor there", "xx", "b"), ("", "xx", "")]
    docs = spark.createDataFrame([(*r, 5, 6) for r in rows], "text string, lang string, source string, term long, p long")
    assert sorted(map(tuple, divergence.audit(docs).collect())) == plain_audit(rows)


def test_op12_counts_handed_on_early(monkeypatch):
    """A task that may hold few counts gives rows that add up to the same."""
    import pyarrow as pa

    rows = mixed_rows(60, 4)
    batch = pa.record_batch([pa.array([x or "" for x in c]) for c in ([r[1] for r in rows], [r[2] for r in rows])] + [pa.array([(r[0] or "").encode() for r in rows])], names=["lang", "source", "text"])

    def total():
        out = defaultdict(lambda: np.zeros(2, int))
        parts = list(divergence._counted(iter([batch])))
        for p in parts:
            for lang, source, term, n, docs in zip(*(c.to_pylist() for c in p.columns), strict=True):
                out[lang, source, term] += (n, docs)
        return {k: tuple(v) for k, v in out.items()}, len(parts)

    whole, few = total()
    monkeypatch.setattr(divergence, "HELD", 20)
    again, many = total()
    assert whole == again and many > few


def test_op12_awkward_and_empty(spark, awkward):
    rows = [(r.text, r.lang, r.source) for r in awkward.collect()]
    assert sorted(map(tuple, divergence.audit(awkward, min_docs=2).collect())) == plain_audit(rows, 2)
    assert divergence.audit(awkward.limit(0)).count() == 0


def test_op12_sql(spark, sf):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    got = queries.op12_source_divergence(spark, sf)
    names = ", ".join(f'"{x}"' for x in got.columns)
    want = c.execute(f"select {names} from ({queries._OP12})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_op12_counts_beyond_longs(spark):
    """10^9 times a count of 10^12 doesn't fit 64 bits."""
    row = spark.createDataFrame([(10**12, 7 * 10**12 + 13, 9)], "n long, size long, terms long").select(divergence.share("n", "size", "terms").alias("p")).first()
    assert row.p == 1 + 10**9 * (10**12 + 2) // (7 * 10**12 + 13 + 18)


def test_op12_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    for text in (b"aaaa bbbb cccc dddd eeee", b"x" * 50 + b" y", b"", b"a", "éé ÀÀ zz".encode() * 9):
        low = text.lower()
        assert divergence.term_counts(text) == Counter(re.findall(rb"[a-z\x80-\xff]+", low))


# 13 ------------------------------------------------------------------------------------------------------------------


def plain_grams(text):
    """Grams of three and four bytes whose inner bytes are letters."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    out = Counter()
    for word in re.findall(rb"[a-z\x80-\xff]+", low):
        w = b" " + word + b" "
        for size in (3, 4):
            out.update(w[k : k + size] for k in range(len(w) - size + 1))
    return out


def plain_cell(gram):
    return int(textkernel.mix(np.array([int.from_bytes(bytes([len(gram)]) + gram, "big")], np.uint64))[0] >> np.uint64(64 - langid.BITS))


def plain_vector(text, idf):
    cells = Counter()
    for g, n in plain_grams(text).items():
        cells[plain_cell(g)] += n
    v = {c: (1 + math.log(n)) * idf[c] for c, n in cells.items()}
    size = math.sqrt(sum(x * x for x in v.values()))
    return {c: x / size for c, x in v.items()}


SOME = [t for t in TEXTS if t is not LONG] + ["Der schnelle Fuchs", "a", "The end. THE END!", "x1y2z3", "été à Noël"]


def test_op13_vectors(monkeypatch):
    import pyarrow as pa

    idf = 1 + np.arange(1 << langid.BITS) % 7
    for piece in (langid.PIECE, 8):
        monkeypatch.setattr(langid, "PIECE", piece)
        for texts in ([*SOME], *[[t] for t in SOME]):
            if piece == 8 and len(texts) > 1:
                continue
            doc, cell, value = langid.vectors(*textkernel.text_buffer(pa.array(texts, pa.string())), idf)
            for k, t in enumerate(texts):
                if piece == 8 and max(map(len, re.findall(rb"[^ ]+", (t or "").encode())), default=0) > 8:
                    continue  # words longer than a piece are cut
                want = plain_vector(t, idf)
                got = dict(zip(cell[doc == k].tolist(), value[doc == k].tolist(), strict=True))
                assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-5 for c in want), t


def test_op13_brute_force(spark, sf):
    """Frequencies, predictions and scores of a whole table against one text at a time."""
    docs = table(spark, sf, "documents")
    model = langid.fit(docs, langid.learnable())
    rows = docs.select("doc_id", "text", "lang").collect()
    learn = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.text is not None and r.lang is not None]
    df = Counter(c for r in learn for c in {plain_cell(g) for g in plain_grams(r.text)})
    assert np.allclose(model.idf, [math.log((1 + len(learn)) / (1 + df[c])) + 1 for c in range(1 << langid.BITS)])
    centres = [(lang, c) for langs, _, m in langid._blocks(model.files, 5) for lang, c in zip(langs, m.T, strict=True)]
    assert {x for x, _ in centres} == {r.lang for r in learn} and len(centres) <= langid.CLUSTERS * len({r.lang for r in learn})
    got = {r.doc_id: r for r in queries.op13_centroid_language(spark, sf).collect()}
    assert len(got) == len(rows)
    for r in rows:
        v = plain_vector(r.text, model.idf)
        near = sorted((-round(sum(x * float(m[c]) for c, x in v.items()), 4), lang) for lang, m in centres)
        g = got[r.doc_id]
        assert abs(g.score + near[0][0]) < 2e-4
        assert g.lang_pred in {lang for x, lang in near if x < near[0][0] + 3e-4}
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_op13_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    rows = [r for r in queries.op13_centroid_language(spark, sf).collect() if r.held_out]
    assert len(rows) > 200
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.05


def test_op13_blocks_of_centroids_find_the_same(spark, sf, monkeypatch):
    """A model that is too large to hold is gone through in blocks."""
    docs = table(spark, sf, "documents")
    model = langid.fit(docs, langid.learnable())
    whole = sorted(map(tuple, langid.predict(docs, model).collect()))
    monkeypatch.setattr(langid, "MODEL_BYTES", 0)
    monkeypatch.setattr(langid, "BLOCK", 2)
    assert sorted(map(tuple, langid.predict(docs, model).collect())) == whole


@pytest.mark.parametrize("rows", [1, 7, 500, 10_000])
def test_op13_samples_the_lowest_hashes(spark, rows):
    from pyspark.sql import functions as F

    ids = spark.range(3000).select(F.when(F.col("id") % 10 == 0, "few").otherwise("many").alias("lang"), F.xxhash64("id").alias("h"))
    got = sorted(map(tuple, langid.lowest(ids, rows).collect()))
    want = sorted(map(tuple, ids.collect()))
    assert got == sorted(x for lang in ("few", "many") for x in [r for r in want if r[0] == lang][:rows])


def test_op13_awkward_rows(spark, awkward):
    model = langid.fit(awkward, langid.learnable())
    rows = langid.predict(awkward, model).collect()
    text = {r.doc_id: r.text for r in awkward.select("doc_id", "text").collect()}
    assert len(rows) == awkward.count()
    for r in rows:
        lettered = any(c.isalpha() for c in text[r.doc_id] or "")
        assert r.lang_pred == ("en" if lettered else "und") and 0 <= r.score <= 1
        assert lettered or (r.score == 0 and r.rejected)
    far = spark.createDataFrame([(1, "ξένος γλώσσα παντού")], "doc_id long, text string")
    assert langid.predict(far, model).first().rejected
    assert langid.predict(awkward.limit(0), model).count() == 0
    nothing = langid.fit(awkward.limit(0), langid.learnable())
    assert {(r.lang_pred, r.score) for r in langid.predict(awkward, nothing).collect()} == {("und", 0.0)}
    flags = awkward.select("doc_id", langid.held_out().alias("h"), langid.learnable().alias("l")).where("doc_id is null").first()
    assert (flags.h, flags.l) == (False, False)
