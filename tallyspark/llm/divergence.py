"""How far the sources of a language diverge from each other, and which terms set a source apart: exact integers.

A group is a (lang, source), its terms those of its language that ``MIN_DOCS`` of the language's documents hold. A term of
``count`` occurrences has p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)), and two groups differ in it by
f = floor((p - q)^2 / (p + q)).

The sum over all V terms is taken by baseline correction over an inverted index. Every pair starts at V times f of two zero
counts. A posting (term, group, count) changes that for every other group, by an amount that depends on its p alone, so these
corrections are made once for each distinct p of a group; and two postings of one term correct each other once more. Terms
that neither group has are never looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise, only, workspace

#: Documents of its language that hold a term at least; ranks of the term report.
MIN_DOCS, TOP = 10, 10
#: Bytes of text whose terms are looked for at a time, and (group, term) counts that a task holds before it hands them on.
PIECE, HELD = 1 << 22, 200_000
#: Groups of a language, or postings of a term, that are paired within one task with all others.
BLOCK = 512

#: Lower-cased bytes of terms ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")


def pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces that end between two terms."""
    at = 0
    while len(data) - at > PIECE:
        gap = _GAP.search(data, at + PIECE)
        if gap is None:
            break
        yield data[at : gap.start()]
        at = gap.start()
    yield data[at:] if at else data


def term_counts(text: bytes) -> Counter:
    """How often a text holds each term; only A-Z are lower-cased."""
    low, out = text.lower(), Counter()  # of bytes, lower() changes ASCII letters alone
    for piece in pieces(low):
        out.update(_TERM.findall(piece))
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (lang, source, term, n, docs), summed as far as a task holds them; each group also with a null term."""
    held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            names = [None, *terms]
            n, docs = [0, *(x[0] for x in terms.values())], [0, *(x[1] for x in terms.values())]
            term = pa.array(names, pa.binary()).cast(pa.string())
            yield pa.record_batch([pa.array([lang] * len(names)), pa.array([source] * len(names)), term, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for b in batches:
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            own = held.setdefault((lang, source), {})
            before = len(own)
            for term, n in term_counts(text.as_py()).items():
                if (x := own.get(term)) is None:
                    own[term] = [n, 1]
                else:
                    x[0] += n
                    x[1] += 1
            size += len(own) - before
            if size > HELD:
                yield from out()
                size = 0
    yield from out()


def term_table(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents that hold it); every group also once with a null term.
    Nulls count as ''; repeated rows are documents of their own."""
    src = only(docs, text=text_col, lang=lang_col, source=source_col)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    src = src.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], text.alias("text"))
    found = src.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """p, exactly (decimals of 31 digits hold the product), from columns' names or SQL; null without terms."""
    product = f"cast({count} + 2 as decimal(20,0)) * cast(1000000000 as decimal(10,0))"
    return F.expr(f"case when {terms} > 0 then 1L + ({product}) div cast({total} + 2 * {terms} as decimal(20,0)) end")


def gap(p: str, q: str) -> str:
    """f in SQL: p and q are below 2^30, so the square fits a long."""
    return f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))"


def _pairs(rows: DataFrame, keys: list[str], members: str) -> DataFrame:
    """Every two rows of equal ``keys`` with a.source < b.source, as a and b. ``members``: how many rows a key has, by
    which the left rows are dealt into blocks, so that no task pairs more than some BLOCK of them with all the others."""
    blocks = F.ceil(F.col(members) / BLOCK).cast("int")
    row = F.struct(*[c for c in rows.columns if c not in keys])
    left = rows.select(*keys, F.pmod(F.xxhash64("source"), blocks).cast("int").alias("block"), row.alias("a"))
    right = rows.select(*keys, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), row.alias("b"))
    return left.join(right, [*keys, "block"]).where(F.col("a.source") < F.col("b.source")).drop("block")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part ``pair``: every other source of the language by its divergence. Part ``term``: the ``top`` terms that the group has
    more often than the language. Ranks are from 1, by value downwards and then by the item's bytes. Null texts, languages
    and sources are ''; groups without terms have pairs too (0 where the language keeps no term); an empty table gives no rows.
    """
    at = workspace(docs.sparkSession, "divergence")
    counts = materialise(term_table(docs, text_col, lang_col, source_col), f"{at}/counts")
    by_term = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang"), F.count("*").alias("holders"))
    kept = materialise(by_term.where(F.col("docs") >= min_docs).drop("docs"), f"{at}/kept")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("total"))  # a row for each language
    posts = materialise(counts.where("term is not null").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang", "holders"), f"{at}/postings")

    sizes = posts.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    named = counts.where("term is null").select("lang", "source").distinct()
    of_lang = named.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = named.join(of_lang, "lang").join(langs, "lang", "left").join(sizes, ["lang", "source"], "left").fillna(0, ["terms", "total", "size"])
    groups = materialise(groups.withColumn("zero", share("0L", "size", "terms")), f"{at}/groups")
    known = posts.join(groups.select("lang", "source", "size", "terms", "total", "zero"), ["lang", "source"])
    known = known.select("lang", "source", "term", "holders", "zero", share("n", "size", "terms").alias("p"), share("in_lang", "total", "terms").alias("q"))
    known = materialise(known, f"{at}/shares")

    own = known.where("p > q").select("lang", "source", "term", F.expr(gap("p", "q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")  # Spark keeps the first few of each task before they move
    terms = own.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    # how many terms of a group have each p: a group of N occurrences has fewer than sqrt(2 N) of them
    levels = known.groupBy("lang", "source", "p").agg(F.count("*").alias("m")).groupBy("lang", "source").agg(F.collect_list(F.struct("p", "m")).alias("levels"))
    start = _pairs(groups.select("lang", "source", "sources", "terms", "zero"), ["lang"], "sources")
    start = start.select("lang", F.col("a.source").alias("a"), F.col("b.source").alias("b"), F.col("a.terms").alias("terms"), F.col("a.zero").alias("za"), F.col("b.zero").alias("zb"))
    for side, other in (("a", "b"), ("b", "a")):
        of = levels.select("lang", F.col("source").alias(side), F.col("levels").alias(f"levels_{side}"))
        start = start.join(of, ["lang", side], "left")
        change = f"{gap('x.p', f'z{other}')} - {gap('za', 'zb')}"
        start = start.withColumn(f"from_{side}", F.expr(f"coalesce(aggregate(levels_{side}, 0L, (total, x) -> total + x.m * ({change})), 0L)")).drop(f"levels_{side}")
    first = start.select("lang", "a", "b", F.expr(f"case when terms = 0 then 0L else terms * ({gap('za', 'zb')}) + from_a + from_b end").alias("value"))
    both = _pairs(known.select("lang", "term", "source", "holders", "p", "zero"), ["lang", "term"], "holders")
    change = f"{gap('a.p', 'b.p')} - {gap('a.p', 'b.zero')} - {gap('a.zero', 'b.p')} + {gap('a.zero', 'b.zero')}"
    again = both.select("lang", F.col("a.source").alias("a"), F.col("b.source").alias("b"), F.expr(change).alias("value")).where("value <> 0")
    value = materialise(first.unionByName(again).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), f"{at}/pairs")

    ways = [value.select("lang", F.col(x).alias("source"), F.col(y).alias("item"), "value") for x, y in (("a", "b"), ("b", "a"))]
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # a row for each other source
    pairs = ways[0].unionByName(ways[1]).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.unionByName(terms)
