"""The bit-sliced vote matrix, the gram index and the look-up of names against plain versions, and their plans."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import bits, textindex, votes
from tallyspark.operators.naming import held, naming
from tallyspark.operators.textindex import TextIndex


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def some_votes(n, seed=1):
    rng = random.Random(seed)
    states = [f"S{k}" for k in range(9)] + [None]
    rows = [(rng.randrange(-90, 400), rng.choice(states), rng.choice(["Y", "N", "A", ".", "", "x", None])) for _ in range(n)]
    return rows + rows[:50] + [(None, "S1", "Y")]


def plain_pairs(rows):
    one = {}
    for r, s, c in rows:
        if r is not None and s is not None and c in ("Y", "N", "A"):
            one[r, s] = min(c, one.get((r, s), "Z"))
    room = {}
    for (r, s), c in one.items():
        room.setdefault(r, {})[s] = c
    out = {}
    for v in room.values():
        for a, b in itertools.combinations(sorted(v), 2):
            n, m = out.get((a, b), (0, 0))
            out[a, b] = n + 1, m + (v[a] == v[b])
    return sorted((a, b, n, m, round(m * 100 / n, 4)) for (a, b), (n, m) in out.items())


@pytest.mark.parametrize("kind", ["long", "string"])
def test_pairs_from_bits(spark, kind):
    """Several votes of a state on a resolution, unnamed states, negative numbers and null ones; ids of text are numbered first."""
    rows = some_votes(3000)
    df = spark.createDataFrame(rows, "record_id long, state string, code string").withColumn("record_id", F.col("record_id").cast(kind))
    got = sorted((r.state_a, r.state_b, r.shared, r.same, round(r.agreement_pct, 4)) for r in votes.agreement_pairs(df).collect())
    assert got == plain_pairs(rows)
    assert votes.agreement_pairs(df.limit(0)).count() == 0


def test_totals_of_bits(spark):
    rows = [r for r in dict.fromkeys(some_votes(500, 2)) if r[0] is not None and r[1] is not None]
    one = {}
    for r, s, c in rows:
        if c in ("Y", "N", "A"):
            one[r, s] = min(c, one.get((r, s), "Z"))
    want = sorted((s, *[sum(c == x for (_, t), c in one.items() if t == s) for x in "YNA"]) for s in {s for _, s in one})
    got = bits.totals(bits.bit_matrix(spark.createDataFrame(rows, "record_id long, state string, code string"), "record_id"))
    assert sorted(map(tuple, got.collect())) == want


def test_pair_rows_grow_with_words(spark):
    """1000 resolutions of 20 states: 16 words make 16 * 190 rows of pairs, where each resolution made 190."""
    df = spark.range(20_000).select((F.col("id") % 1000).alias("record_id"), F.concat(F.lit("S"), F.floor(F.col("id") / 1000).cast("string")).alias("state"), F.lit("Y").alias("code"))
    made = bits.bit_matrix(df, "record_id")
    assert made.count() == 20 * 16
    assert {(r.shared, r.same) for r in bits.agreement(made).collect()} == {(1000, 1000)}


def plain_chain(rows, k):
    one = {(r, s) for r, s, c in rows if s is not None and r is not None and c in ("Y", "N", "A")}
    count = sorted((-sum(t == s for _, t in one), s) for s in {s for _, s in one})[:k]
    share = {}
    for a, b, n, m, pct in plain_pairs(rows):
        share[a, b] = share[b, a] = pct
    left = [s for _, s in count]
    chain = left[:1]
    left = sorted(left[1:])
    while left:
        left.sort(key=lambda s: (-share.get((chain[-1], s), -1.0), s))
        chain.append(left.pop(0))
    return chain


@pytest.mark.parametrize("k", [1, 4, 30])
def test_chain(spark, k):
    rows = [r for r in some_votes(600, 3) if r[1] is not None and r[0] is not None]
    rows += [(1000 + k, "lonely", "Y") for k in range(400)]  # shares nothing with the others
    df = spark.createDataFrame(rows, "record_id long, state string, code string")
    got = [r.state for r in votes.nearest_chain(df, k).orderBy("place").collect()]
    assert got == plain_chain(rows, k)


WORDS = ["a", "Mac", "machine", "MACHINERY", "É", "straße", "no. 12", "x y", "", "日本", "%_", "aaa", "aaaa"]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 6))), rng.choice([*WORDS, None]), 1) for i in range(600)]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "id int, title string, subject string, folder_ int").repartition(5)
    old = textindex.FOLDER_BITS
    textindex.FOLDER_BITS = 6
    index = TextIndex.build(df, ["title", "subject"], "file://" + str(tmp_path_factory.mktemp("index")))
    yield index, rows
    textindex.FOLDER_BITS = old


@pytest.mark.parametrize("text", ["machine", "MACH", "ach", "a", "É", "é", "no", "12", "aaa", "aaaa", "aaaaa", "日本", "本", "%", " ", "zzz", "z", "zq", "", "x y", "ne no"])
def test_index_finds_what_a_scan_finds(indexed, text):
    index, rows = indexed
    for fields in (["title", "subject"], ["subject"]):
        low = text.lower()
        at = {"title": 1, "subject": 2}
        want = sorted(r[0] for r in rows if any(r[at[f]] is not None and low in r[at[f]].lower() for f in fields))
        assert sorted(r.id for r in index.search(text, fields).collect()) == want


def test_index_reads_only_the_searchs_grams(indexed):
    index, rows = indexed
    found = index.search("machine", ["title"])
    shown = plan(found)
    slots = {s for _, s in index._of_search("machine")}
    assert len(slots) < textindex.SLOTS / 4
    listed = next(line for line in shown.splitlines() if "PartitionFilters" in line and "slot" in line)
    assert {int(x) for x in re.search(r"slot#?\d* IN \(([0-9,]+)\)", listed)[1].split(",")} == slots  # the folders that are opened
    assert re.search(r"PushedFilters: .*In\(gram", shown)
    assert "dynamicpruning" in shown  # of the rows' folders
    assert index.rows().columns == ["id", "title", "subject", "folder_", textindex._ROW, "folder"]
    assert found.columns == ["id", "title", "subject", "folder_"]


def test_index_of_nothing(spark, tmp_path):
    index = TextIndex.build(spark.createDataFrame([], "t string"), ["t"], f"file://{tmp_path}")
    assert index.search("abc", ["t"]).count() == index.search("", ["t"]).count() == 0


NAMES = ["France", "Franc", "FRANCE AND NIGER", "Niger", "Nigeria", "geria is", "is in", "Côte d'Ivoire", "aaaaaa", "aaaaaaa", None, "", "NATION", "Nation 1", "Nation 12"]
TEXTS = ["france", "Franc", "In France and Nigeria is it", "niger", "in Niger", "CÔTE D'IVOIRE now", "aaaaaaaaaa", "nation 123", "", None, "short", "Frances", "nigeria"]


def test_overlapping_names(spark):
    texts = spark.createDataFrame([(t,) for t in [*TEXTS, *TEXTS[:3]]], "text string")
    names = spark.createDataFrame([(n,) for n in [*NAMES, "France"]], "name string")
    known = {n.upper() for n in NAMES if n is not None}
    want = {t for t in TEXTS if t is not None and any(n == t.upper() or (len(n) > 5 and n in t.upper()) for n in known)}
    got = [r.text for r in naming(texts, names).collect()]
    assert sorted(got) == sorted(want)
    upper = texts.select(F.upper("text").alias("text"))
    both = sorted(map(tuple, held(upper, spark.createDataFrame([(n,) for n in known], "name string")).collect()))
    assert both == sorted((t.upper(), n) for t in set(TEXTS) - {None} for n in known if len(n) > 5 and n in t.upper())


def test_a_hundred_thousand_names(spark):
    """No nested loop, and no row for each pair of a text and a name."""
    names = spark.range(100_000).select(F.concat(F.lit("REPUBLIC OF "), F.conv("id", 10, 36)).alias("name"))
    texts = spark.range(2000).select(F.concat(F.lit("In the republic of "), F.conv(F.col("id") * 977, 10, 36), F.lit(" and elsewhere")).alias("text"))
    found = held(texts.select(F.upper("text").alias("text")), names)
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def base36(n):
        out = ""
        while n:
            out, n = digits[n % 36] + out, n // 36
        return out or "0"

    known = {"REPUBLIC OF " + base36(k) for k in range(100_000)}
    want = set()
    for k in range(2000):
        text = f"IN THE REPUBLIC OF {base36(k * 977)} AND ELSEWHERE"
        want |= {(text, text[7:end]) for end in range(8, len(text) + 1) if text[7:end] in known}
    assert {tuple(r) for r in found.collect()} == want and len(want) > 2000
