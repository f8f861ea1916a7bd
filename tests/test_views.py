"""Log state, layout, sets of states, exports and fixed tables."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import tables
from tallyspark.operators import exports, geo, payload, sets, votes
from tallyspark.plans import proxy, registry
from tallyspark.sources import files, layout
from tallyspark.sources.folders import workspace
from tallyspark.streaming import ingest, logstate

LINES = [("a", "error:x", ""), ("a", "ok", "a.pdf"), ("a", "missing", ""), ("b", "error:y", ""), ("b", "error:x", ""), ("c", "tiny", "E/c"), ("d", "missing", ""), ("d", "odd", "z"), (None, "ok", "n"), ("e", None, None)]


@pytest.mark.parametrize("seed", range(2))
def test_replayed_and_late_lines_leave_the_batchs_state(spark, tmp_path, seed):
    """The lines in any order over several runs, some of them twice, one run stopped and begun again."""
    lines = LINES + random.Random(seed).choices(LINES, k=5)
    random.Random(seed).shuffle(lines)
    log, at = str(tmp_path / "log"), (f"file://{tmp_path}/state", f"file://{tmp_path}/checkpoint")
    for part in itertools.batched(lines, 5):
        ingest.append_log(spark.createDataFrame(part, ingest.LOG), log)
        logstate.follow(spark, log, *at)
    logstate.follow(spark, log, *at)  # nothing new
    whole = spark.createDataFrame(lines, ingest.LOG)
    want = sorted(map(tuple, logstate.state_of(whole).collect()))
    assert want == [("a", "ok", "a.pdf", False), ("b", "error:x", "", True), ("c", "tiny", "E/c", False), ("d", "missing", "", False), ("e", "", "", False)]
    assert sorted(map(tuple, logstate.current(spark, at[0]).collect())) == want
    todo = spark.createDataFrame([("a",), ("b",), ("new",)], "symbol string")
    open_ = sorted(r.symbol for r in ingest.still_to_do(todo, logstate.current(spark, at[0])).collect())
    assert open_ == sorted(r.symbol for r in ingest.still_to_do(todo, whole).collect()) == ["b", "new"]


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path, monkeypatch):
    """A run whose batch can't be written is repeated by the next one."""
    log, at = str(tmp_path / "log"), (f"file://{tmp_path}/state", f"file://{tmp_path}/checkpoint")
    ingest.append_log(spark.createDataFrame([("a", "error:x", "")], ingest.LOG), log)
    logstate.follow(spark, log, *at)
    ingest.append_log(spark.createDataFrame([("a", "ok", "f"), ("b", "ok", "g")], ingest.LOG), log)
    with monkeypatch.context() as m:
        m.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            logstate.follow(spark, log, *at)
    assert [tuple(r) for r in logstate.current(spark, at[0]).collect()] == [("a", "error:x", "", True)]
    logstate.follow(spark, log, *at)
    assert sorted(map(tuple, logstate.current(spark, at[0]).collect())) == [("a", "ok", "f", False), ("b", "ok", "g", False)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_layout_prunes_years_and_spares_shuffles(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = proxy.votes(spark, sf).where("not am")
        stored = layout.store_votes(plain, workspace(spark, "votes"), buckets=4)
        res = layout.store_resolutions(proxy.resolutions(spark, sf), workspace(spark, "resolutions"), buckets=4)
        some = stored.where("year between 1996 and 1997")
        assert "PartitionFilters: [isnotnull(year" in plan(some) and "1996" in plan(some)
        opened = {re.search(r"year=(\d+)", r.f)[1] for r in some.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
        assert opened == {"1996", "1997"}
        joined = stored.select("record_id", "state", "code").join(res.select("record_id", "title"), "record_id")
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        before, after = plan(votes.outvoted(votes.one_vote(plain))), plan(votes.outvoted(votes.one_vote(stored)))
        shuffles = lambda p: len(re.findall(r"Exchange hashpartitioning", p))
        assert shuffles(after) == 1 < shuffles(before)  # that of the states alone
        assert sorted(map(tuple, votes.outvoted(votes.one_vote(stored)).collect())) == sorted(map(tuple, votes.outvoted(votes.one_vote(plain)).collect()))
        assert joined.count() == stored.count() == plain.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_group_tables(spark):
    rows = tables.groups(spark).collect()
    assert len(rows) == len({r.iso3 for r in rows}) == 198
    assert {g: len(n.split()) for g, n in tables.GROUPS.items()} == {"WEOG": 30, "EEG": 27, "GRULAC": 33, "AFRICAN": 54, "ASIA_PACIFIC": 54}
    assert set(tables.LABELS) == set(tables.GROUPS) | {""}
    grouped = {r.iso3 for r in rows}
    assert {r.iso3 for r in tables.dots(spark).collect()} <= grouped and set(tables.PERMANENT.split()) <= grouped and len(tables.DOTS) == 33


def test_tables_in_their_places(spark):
    """Unassigned states have the empty group, and a small state without a shape gets its dot."""
    cast = spark.createDataFrame([("1", "FRA", "france", "Y", "Y", "1999", 1, 1999, 0), ("1", "PSE", "palestine", "N", "N", "1999", 2, 1999, 0)], "record_id string, iso3 string, country string, vote string, code string, year string, pos long, res_year int, ri long")
    got = {r.iso3: r.group for r in payload.countries(cast, tables.groups(spark)).collect()}
    assert got == {"FRA": "WEOG", "PSE": ""} and tables.LABELS[got["PSE"]] == "Other/Unassigned"
    voters = spark.createDataFrame([("SGP", "Singapore"), ("FRA", "France")], "iso3 string, name string")
    drawn = spark.createDataFrame([("FRA", "France", "M0 0Z")], "iso3 string, name string, path string")
    assert [r.iso3 for r in geo.dots(tables.dots(spark), voters, drawn).collect()] == ["SGP"]


def test_sets_of_states(spark):
    rng = random.Random(6)
    states = ["FRA", "USA", "CHN", "NGA", "KEN", "PSE", "BRA"]
    rows = [(r, s, rng.choice("YNA"), 1990 + r % 5) for r in range(60) for s in states if rng.random() < 0.3 + 0.1 * states.index(s)]
    df = spark.createDataFrame([*rows, (1, None, "Y", 1990)], "record_id long, state string, code string, year int")
    of = lambda name, **k: {r.state for r in sets.members(name, df, tables.groups(spark), **k).collect()}
    assert of("P5+") == {"FRA", "USA", "CHN"} and of("P5+", key_states=("BRA", "XXX")) == {"FRA", "USA", "CHN", "BRA"}
    assert of("AFRICAN") == {"NGA", "KEN"} and of("EEG") == set()
    count = sorted(states, key=lambda s: (-sum(r[1] == s for r in rows), s))
    assert of("most active", k=3) == set(count[:3])
    assert len(of("most agreeing", k=2) | of("most disagreeing", k=2)) == 4
    with pytest.raises(ValueError):
        of("nobody")
    some = sets.within(df, sets.members("AFRICAN", df, tables.groups(spark)), 1991, 1992)
    assert some.count() == sum(r[1] in ("NGA", "KEN") and 1991 <= r[3] <= 1992 for r in rows)
    assert sets.within(df, df.select("state").distinct()).count() == len(rows)


HASHED = [("#1 state", 1), ("plain", 2), ("# Source: me", 3), ('#"q"', None), ("a\n#b", 5), ("", 6), ("x, #y", 7)]


@pytest.mark.parametrize("title", ["Title", '# odd "title", with, commas', ""])
@pytest.mark.parametrize("bom", [False, True])
def test_export_rows_may_begin_with_a_hash(spark, tmp_path, title, bom):
    df = spark.createDataFrame(HASHED, "state string, n int")
    files.write_export(df, str(tmp_path / "e"), title + "\nmore", "So\nme", ("n",), bom)
    back = files.read_export(spark, str(tmp_path / "e"), "state string, n int")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(HASHED, key=str)


def test_exports_of_others_are_read_too(spark, tmp_path):
    """Unquoted rows that begin with #, two files of one folder."""
    for name in "ab":
        (tmp_path / f"{name}.csv").write_text(f"﻿# T {name}\n# Source: s\nstate,n\n#1,1\n{name},x\n", encoding="utf-8")
    rows = sorted(map(tuple, files.read_export(spark, str(tmp_path), "state string, n int").collect()), key=str)
    assert rows == sorted([("#1", 1), ("#1", 1), ("a", None), ("b", None)], key=str)


#: By key: a column that the chart's file must have.
HEADERS = {"ovtl": "year", "ctl": "yes", "cal": "agreement_pct", "ttrend": "avg_yes_share_pct", "bheat": "state", "bmds": "shared_votes", "bcoh": "agreement_index", "biso": "minority_side_pct", "cflips": "delta_pp", "cero": "consensus_share_pct", "cexplorer": "mode"}


def test_every_chart_has_its_header(spark, sf):
    v, res, on = proxy.votes(spark, sf).where("not am"), registry._res(spark, sf), registry._chosen(spark, sf)
    assert list(exports.EXPORTS) == list(HEADERS)
    for key, column in HEADERS.items():
        assert column in exports.rows(key, v, res, on).columns
    assert exports.rows("ctl", v, res, on._replace(state="x' or 'a' = 'a")).count() == 0  # a name is text, not SQL


def test_csv_in_ranges_and_in_one_file(spark, tmp_path):
    df = spark.range(500).select((F.col("id") * 7 % 500).cast("int").alias("n"), F.lit("#x").alias("t"))
    files.write_csv(df, str(tmp_path / "r"), "n")
    files.write_csv(df, str(tmp_path / "o"), "n", one_file=True)
    read = lambda at: [int(line.split(",")[0]) for f in sorted(at.glob("part-*")) for line in f.read_text().splitlines()[1:]]
    assert read(tmp_path / "o") == read(tmp_path / "r") == list(range(500)) and len(list((tmp_path / "o").glob("part-*"))) == 1
    for at in "ro":
        assert sorted(r.n for r in files.read_csv(spark, str(tmp_path / at), df.schema).collect()) == list(range(500))
