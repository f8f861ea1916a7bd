"""What one task reads, holds or writes doesn't grow with the whole table."""

import glob
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import textindex
from tallyspark.plans import proxy as P
from tallyspark.plans import registry
from tallyspark.sources import files, marc, pages, parts
from tallyspark.streaming import logstate


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", ["ingested_with_damage", "marc_files", "ingested_twice", "first_in_file_order"])
def test_files_of_records_are_bounded(spark, sf, monkeypatch, name):
    """F1 to F4: a catalogue's files have a number of records at most, however many there are."""
    monkeypatch.setattr(marc, "PER_FILE", 20)
    made, plain = [], marc.write
    monkeypatch.setattr(marc, "write", lambda rows, path, *a: (plain(rows, path, *a), made.append(path)))
    got = registry.queries()[name](spark, sf)
    sizes = [len(re.findall(r"<record>", open(f).read())) for at in made for f in glob.glob(f"{at.removeprefix('file://')}/part-*")]
    assert len(sizes) > 3 and max(sizes) <= 20
    # the one file that is read whole is one of those
    assert got.count() >= sum(sizes) // 4


def test_a_first_part_of_a_table_without_rows(spark, sf):
    """F1 of round 4: parts of the orders' file in which no row group lies make tasks without records, the first one too."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    want = sorted((str(r[0]), f"{r[1]}, {'second' if r[0] % 3 == 1 else 'first'}") for r in P.resolutions(spark, sf, False).select("record_id", "title").collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert not orders.where(F.spark_partition_id() == 0).count()
        got = registry.queries()["first_in_file_order"](spark, sf).select("record_id", "title").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, got)) == want


def test_votes_are_parsed_in_as_many_tasks_as_there_is_data_for(spark, sf):
    """no fixed number of tasks, and no columns that nobody asked for."""
    shown = plan(registry.queries()["marc_votes"](spark, sf))
    assert "REPARTITION_BY_NUM" not in shown
    assert "searchlibrary" not in shown


def test_only_the_named_columns(spark):
    """rows that are sorted by id hold what is used, with the same values."""
    xml = '<record><controlfield tag="001">{}</controlfield><datafield tag="245"><subfield code="a">t{}</subfield></datafield></record>'
    rows = spark.createDataFrame([(xml.format(k // 2, k), k) for k in range(8)], "xml string, k int")
    records = marc.from_text(rows, "xml", F.lit("f"), F.col("k"))
    got = marc.parse(records, "title")
    assert got.columns == ["record_id", "title"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, marc.parse(records).select("record_id", "title").collect())) == [(str(k), f"t{2 * k}") for k in range(4)]


def test_state_is_kept_by_spark(spark, tmp_path, monkeypatch):
    """no symbol passes through a Python processor."""
    monkeypatch.setattr("pyspark.sql.GroupedData.transformWithState", lambda *a, **k: pytest.fail("a Python processor"))
    spark.createDataFrame([("a", "error:x", "")], "symbol string, status string, file string").write.csv(str(tmp_path / "log"))
    logstate.follow(spark, str(tmp_path / "log"), f"file://{tmp_path}/state", f"file://{tmp_path}/checkpoint")
    assert [tuple(r) for r in logstate.current(spark, f"file://{tmp_path}/state").collect()] == [("a", "error:x", "", True)]


@pytest.mark.parametrize("order", [("n",), ()])
def test_an_export_in_several_files(spark, tmp_path, order):
    """the files in the order of their names are the text; a row that begins like a head stays a row."""
    df = spark.range(3000).select(F.concat(F.lit("# Source: "), F.col("id").cast("string")).alias("s"), F.col("id").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        files.write_export(df, str(tmp_path / "e"), "T", "S", order, True)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    made = sorted(glob.glob(str(tmp_path / "e" / "part-*")))
    assert len(made) > 1
    assert "".join(open(f, newline="").read() for f in made) == "﻿# T\n# Source: S\ns,n\n" + "".join(f"# Source: {k},{k}\n" for k in range(3000))
    assert sorted(r.n for r in files.read_export(spark, str(tmp_path / "e"), df.schema).collect()) == list(range(3000))


def test_a_page_is_written_record_by_record(spark, tmp_path):
    """F8: no row holds a page, so no batch holds thousands."""
    rows = spark.range(1000).select(F.concat(F.lit("q"), (F.col("id") % 3).cast("string")).alias("query"), F.floor(F.col("id") / 3).alias("k"), F.concat(F.lit("<record>"), "id", F.lit("</record>")).alias("xml"))
    made = pages.write_pages(rows, f"file://{tmp_path}", 50)
    assert "collect_list" not in plan(made)
    assert sorted(map(tuple, made.collect())) == sorted((f"q{q}", 50 * p + 1, min(50, n - 50 * p)) for q, n in ((0, 334), (1, 333), (2, 333)) for p in range(-(-n // 50)))
    assert re.findall(r"<record>(\d+)<", (tmp_path / "q1" / "51.xml").read_text()) == [str(3 * k + 1) for k in range(50, 100)]


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_parts_joined_by_columns(spark, tmp_path, batch):
    """commas between rows of all kinds, across batches and parts, as a plain loop sets them."""
    kinds = np.random.default_rng(3).integers(0, 3, 400).tolist()
    rows = spark.createDataFrame([(k, "" if i % 9 == 0 else f"é{i}", i) for i, k in enumerate(kinds)], "kind int, value string, i int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        at = f"file://{tmp_path}/p"
        parts.write_manifest(["[", parts.write_section(rows, ["i"], at, 1, 3), "]"], at)
        got = b"".join(parts.read_parts(spark, at)).decode()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, last = "[", None
    for i, k in enumerate(kinds):
        want += "," if last is not None and (k == parts.ITEM or k == parts.INNER and last != parts.ITEM) else ""
        want, last = want + ("" if i % 9 == 0 else f"é{i}"), k
    assert got == want + "]"


def test_grams_by_columns(spark):
    """a batch's grams and bits at once, letters beyond the basic plane and repeated grams among them."""
    texts = ["aaaa", None, "", "b", "日本x", "x\U0001f600\U0010ffff", "Éa\0b"] * 30
    rows = spark.createDataFrame(list(enumerate(texts)), f"{textindex._ROW} long, t string").coalesce(1)
    want = {}
    for n, t in enumerate(texts):
        for k in range(1, textindex.SIZE + 1):
            for i in range(len(t or "") - k + 1):
                gram = t.lower()[i : i + k]
                want[gram, n >> 6] = want.get((gram, n >> 6), 0) | 1 << (n & 63)
    got = textindex.gram_words(rows, ["t"]).groupBy("gram", "word").agg(F.bit_or("bits").alias("bits")).collect()
    assert {(r.gram, r.word): r.bits % (1 << 64) for r in got} == want
