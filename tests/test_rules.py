"""The catalogue's rules on hand-made records."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import text_rules as R
from tallyspark.operators import catalog, geo, payload, votes
from tallyspark.sources import files, marc, parts
from tallyspark.streaming import ingest

XML = """<collection xmlns="http://www.loc.gov/MARC21/slim">{}</collection>"""


def field(tag, *subs):
    return f'<datafield tag="{tag}">' + "".join(f'<subfield code="{c}">{v}</subfield>' for c, v in subs) + "</datafield>"


def record(number, *fields):
    return "<record>" + (f'<controlfield tag="001">{number}</controlfield>' if number else "") + "".join(fields) + "</record>"


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("marc")
    first = [
        record("0012", field("245", ("a", "One"), ("b", "two")), field("245", ("a", "Other"), ("b", "x")), field("269", ("a", "")), field("992", ("a", "1999"))),
        record("", field("245", ("a", "no id"))),
        record("2", field("269", ("a", "20050131")), field("500", ("a", "Note")), field("500", ("a", "main sponsor : Cuba")), field("856", ("u", "http://d"), ("y", "Draft resolution")), field("856", ("u", "http://r"), ("y", "Resolution"))),
        record("3", field("269", ("a", "abc")), field("967", ("a", "1"), ("b", "VEN$eVENEZUELA (X)"), ("d", "y")), field("967", ("b", "12345"), ("d", "")), field("967", ("d", "N")), field("996", ("b", "1"), ("c", "0")), field("996", ("b", "9"))),
    ]
    (at / "a.xml").write_text(XML.format("".join(first)))
    (at / "b.xml").write_text(XML.format(record("2", field("245", ("a", "late")))))
    return marc.parse(marc.read(spark, str(at))).cache()


def test_marc_records(parsed):
    got = {r.record_id: r for r in marc.resolutions(parsed).collect()}
    assert sorted(got) == ["0012", "2", "3"]
    assert (got["0012"].title, got["0012"].date, got["0012"].year) == ("One two", "1999", "1999")
    assert (got["2"].title, got["2"].date, got["2"].main_sponsors) == ("", "2005-01-31", "Cuba")
    assert (got["2"].url_draft, got["2"].url_resolution) == ("http://d", "http://r")
    assert (got["3"].date, got["3"].year, got["3"].yes, got["3"].no, got["3"].n_rollcall) == ("abc", "", "1", "0", 3)


def test_marc_votes(parsed):
    got = sorted((r.iso3, r.country, r.vote) for r in marc.votes_long(parsed).collect())
    assert got == [("", "", "N"), ("123", "", ""), ("VEN", "VENEZUELA (X)", "Y")]


@pytest.mark.parametrize(
    "rule, given, want",
    [
        (R.trim_title, "T : draft resolution / x", "T"),
        (R.trim_title, " Plain: title ", "Plain: title"),
        (R.clean_item, "Item - ", "Item"),
        (R.mode_code, "unknown", "O"),
        (R.mode_code, "WITHDRAWN", "WD"),
        (R.body_code, "", "CHR"),
        (R.body_code, "Human Rights Council", "HRC"),
        (R.vote_code, "Z", "-"),
        (R.vote_code, "", "-"),
        (R.number, "12\n", None),
        (R.number, " 5", None),
        (R.number, "12", 12),
        (R.safe_name, "E/CN.4/1 é", "E_CN.4_1__"),
        (R.document_link, '<a HREF="E/CN 4.pdf">', "E/CN 4.pdf"),
    ],
)
def test_scalars(spark, rule, given, want):
    assert spark.range(1).select(rule(F.lit(given))).first()[0] == want


@pytest.mark.parametrize("name", ["COTE D'IVOIRE", "guinea-bissau", "congo (dem. rep. of)", "ÉIRE 2nd", ""])
def test_title_case(spark, name):
    assert spark.range(1).select(R.title_case(F.lit(name))).first()[0] == name.title()


def test_amendment_and_totals(spark):
    row = spark.range(1).select(R.is_amendment(F.lit("x"), F.lit("Amendment to y")), R.is_amendment(F.lit("A : AMENDMENT"), F.lit("")), R.has_totals(F.lit("1"), F.lit(""), F.lit("0")), R.has_totals(F.lit("1"), F.lit("0"), F.lit("0"))).first()
    assert tuple(row) == (True, True, False, True)


def test_blank_type_and_latest_name(spark):
    res = spark.createDataFrame([("", 1), (None, 0), ("RECORDED", 2)], "vt string, n_rollcall int")
    assert {r.type: (r.n, r.has_rollcall) for r in catalog.vote_types(res).collect()} == {"(blank)": (2, 1), "RECORDED": (1, 1)}
    v = spark.createDataFrame([("A", 1990, 1, "old"), ("A", 1990, 2, "new"), ("A", None, 9, "none")], "state string, year int, pos int, name string")
    assert votes.latest_name(v, "name", ["pos"]).first().name == "new"


def test_gap(spark):
    one = spark.createDataFrame([("A", 1990), ("A", 1991), ("A", 1995), ("B", 1990)], "state string, year int")
    assert [tuple(r) for r in votes.membership_gaps(one, "year").collect()] == [("A", 1991, 1995)]


def test_ring(spark):
    ring = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 0.0]]
    path = lambda r: spark.range(1).select(geo.ring_path(F.array(*[F.array(*map(F.lit, p)) for p in r]))).first()[0]
    got = path(ring)
    assert got.startswith("M500.0 ") and got.endswith("Z") and got.count("L") == 3
    assert path([[0.0, 0.0], [0.1, 0.0], [0.1, 0.1]]) == ""
    assert math.isclose(geo.SCALE, 1000 / (2 * 0.8487 * math.pi))


def test_csv_and_payload(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', "", 1), ("x\ny", "z", None)], "s string, t string, n int")
    files.write_csv(df, str(tmp_path / "c"), "s")
    back = files.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    line = df.where("n = 1").select(files.payload(F.struct("s", F.lit(None).cast("int").alias("y")), "DATA").alias("v"))
    assert line.first().v == 'window.DATA = {"s":"a \\"q\\", b","y":null};'
    line.write.text(str(tmp_path / "p"))
    assert files.read_payload(spark, str(tmp_path / "p") + "/part-*", "DATA", "s string, y int").first().data.s == 'a "q", b'
    files.write_export(df.select("s", "n").where("n = 1"), str(tmp_path / "e"), "Title", "Somewhere")
    text = "".join(p.read_text() for p in sorted((tmp_path / "e").glob("part-*")))
    assert text.splitlines()[:3] == ["# Title", "# Source: Somewhere", "s,n"]


def one(number, title):
    return record(number, field("245", ("a", title)))


def damaged(whole):
    return {"between": whole[: whole.rindex("<record>")], "inside": whole[:-40], "empty": "", "malformed": whole.replace("</subfield>", "</wrong>", 1)}


REASONS = {"between": "no collection ends", "inside": "a malformed record", "empty": "empty", "malformed": "a malformed record"}


def test_damaged_files_are_set_aside_alone(spark, tmp_path):
    """Nine good files and four damaged in different ways: the nine come in, the four are logged, and come in once when mended."""
    src, out = tmp_path / "in", f"file://{tmp_path}/out"
    src.mkdir()
    for k in range(9):
        (src / f"{k} é+%.xml").write_text(XML.format(one(str(k), "x") + one(f"1{k}", "y")))
    whole = {cut: XML.format(one(f"{100 + k}", "x") + one(f"{200 + k}", "y")) for k, cut in enumerate(REASONS)}
    for cut in REASONS:
        (src / f"bad {cut}.xml").write_text(damaged(whole[cut])[cut])
    assert ingest.ingest_new(spark, str(src), out) == 1
    ids = lambda: sorted(int(r.record_id) for r in marc.parse(ingest.ingested(spark, out)).collect())
    good = sorted([*range(9), *range(10, 19)])
    assert ids() == good
    aside = {r.path.split("bad%20")[1].removesuffix(".xml"): r for r in ingest.set_aside(spark, out).collect()}
    assert {cut: r.reason for cut, r in aside.items()} == REASONS
    assert {cut for cut, r in aside.items() if r.text is not None} == {"inside", "malformed"}
    assert ingest.ingest_new(spark, str(src), out) == 0  # nothing has changed
    for cut in REASONS:
        (src / f"bad {cut}.xml").write_text(whole[cut])
    (src / "new.xml").write_text(XML.format(one("300", "z")))
    assert ingest.ingest_new(spark, str(src), out) == 1 and ingest.ingest_new(spark, str(src), out) == 0
    assert ids() == [*good, *range(100, 104), *range(200, 204), 300] and ingest.set_aside(spark, out).count() == 0
    tried = ingest.ledger(spark, out).groupBy("path").count().collect()
    assert sum(r["count"] for r in tried) == 18 and max(r["count"] for r in tried) == 2


def test_a_good_file_that_changes(spark, tmp_path):
    """The new reading replaces the old; a damaged new version leaves the old records; runs may be of one file each."""
    src, out = tmp_path / "in", f"file://{tmp_path}/out"
    src.mkdir()
    for k in range(3):
        (src / f"{k}.xml").write_text(XML.format(one(str(k), "old")))
    assert ingest.ingest_new(spark, str(src), out, files=1) == 3
    titles = lambda: sorted((r.record_id, r.title) for r in marc.parse(ingest.ingested(spark, out)).collect())
    (src / "1.xml").write_text(XML.format(one("1", "newer") + one("5", "more")))
    (src / "2.xml").write_text("<collection><record>")
    ingest.ingest_new(spark, str(src), out)
    assert titles() == [("0", "old"), ("1", "newer"), ("2", "old"), ("5", "more")]
    assert [r.path[-5:] for r in ingest.set_aside(spark, out).collect()] == ["2.xml"]


def test_a_run_that_fails_leaves_nothing_that_counts(spark, tmp_path, monkeypatch):
    src, out = tmp_path / "in", f"file://{tmp_path}/out"
    src.mkdir()
    (src / "1.xml").write_text(XML.format(one("1", "x")))
    ingest.ingest_new(spark, str(src), out)
    (src / "2.xml").write_text(XML.format(one("2", "x")))
    # the records and what is aside are written, the ledger isn't
    real, put = ingest.materialise, type(spark.range(1).write).parquet
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lambda self, path, *a, **b: (_ for _ in ()).throw(OSError("lost")) if "/ledger/" in path else put(self, path, *a, **b))
    with pytest.raises(OSError, match="lost"):
        ingest.ingest_new(spark, str(src), out)
    monkeypatch.undo()
    assert ingest.materialise is real and len(list((tmp_path / "out/records").glob("part=2"))) == 1
    assert [r.record_id for r in marc.parse(ingest.ingested(spark, out)).collect()] == ["1"]
    ingest.ingest_new(spark, str(src), out)
    assert sorted(r.record_id for r in marc.parse(ingest.ingested(spark, out)).collect()) == ["1", "2"]


@pytest.mark.parametrize("cut", ["between", "inside", "empty", "malformed"])
def test_a_read_of_a_damaged_file_is_an_error(spark, tmp_path, cut):
    (tmp_path / "1.xml").write_text(XML.format(one("0", "z")))
    (tmp_path / "2 a.xml").write_text(damaged(XML.format(one("1", "x") + one("2", "y")))[cut])
    with pytest.raises(Exception, match="2%20a.xml|2 a.xml|FAILFAST|MALFORMED"):
        marc.read(spark, str(tmp_path)).collect()


def test_only_forced_years_change(spark, tmp_path, monkeypatch):
    at = f"file://{tmp_path}/rows"
    rows = lambda years, v: spark.createDataFrame([(y, k, v) for y in years for k in range(5)], "year string, id int, v string")
    years = ["1999", "2000", "2001", "undated"]
    ingest.store_years(rows(years, "a"), at)
    files = lambda y: {(p.name, p.stat().st_mtime_ns, p.stat().st_ino) for p in (tmp_path / f"rows/year={y}").glob("*.parquet")}
    before = {y: files(y) for y in years}
    names = spark.createDataFrame([(y,) for y in [*years, "2002"]], "name string")
    got = ingest.fetch_again(rows([*years, "2002"], "b"), at, names, forced=("2000", "undated"), page=5)
    assert sorted(r.name for r in got.collect()) == ["2000", "2002", "undated"]
    assert files("1999") == before["1999"] and files("2001") == before["2001"] and not files("2000") & before["2000"]
    versions = lambda: {(r.year, r.v, r["count"]) for r in spark.read.schema("id int, v string, year string").parquet(at).groupBy("year", "v").count().collect()}
    want = {("1999", "a", 5), ("2001", "a", 5), ("2000", "b", 5), ("2002", "b", 5), ("undated", "b", 5)}
    assert versions() == want
    ingest.fetch_again(rows([*years, "2002"], "b"), at, names, forced=("2000", "undated"), page=5)  # repeated
    assert versions() == want
    before = {y: files(y) for y in years}
    broken = rows(years, "c").withColumn("v", F.when(F.col("id") < 4, "c").otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):  # a job that fails on its way
        ingest.store_years(broken, at)
    assert versions() == want and {y: files(y) for y in years} == before
    assert ingest.fetch_again(rows(years, "d"), at, names, forced=("2000",), page=4).count() == 0 and versions() == want


def test_file_order_decides_between_records_of_one_id(spark, tmp_path):
    for name, title in (("b", "second"), ("a", "first")):
        (tmp_path / f"{name}.xml").write_text(XML.format(record("5", field("245", ("a", title))) + record("5", field("245", ("a", "third")))))
    rows = marc.read(spark, str(tmp_path))
    assert [r.title for r in marc.parse(rows).collect()] == ["first"]
    half = marc.merged([marc.read(spark, str(tmp_path / "b.xml")), marc.read(spark, str(tmp_path / "a.xml"))])
    assert [(r.title, r.record_url) for r in marc.parse(half).collect()] == [("first", marc.RECORD_URL + "5")]
    text = spark.read.text(str(tmp_path), wholetext=True)
    assert [r.record_id for r in marc.record_ids(text).collect()] == ["5"] * 4


def test_pages_are_merged_into_one_catalogue(spark, tmp_path):
    """Two pages with a record in common, written as one catalogue and read back."""
    for name, ids in (("1", "12"), ("2", "23")):
        (tmp_path / f"{name}.xml").write_text(XML.format("".join(record(i, field("245", ("a", f"t{i} & é")), field("967", ("b", "AAA"), ("d", "Y"))) for i in ids).replace("&", "&amp;")))
    pages = marc.merged([marc.read(spark, str(tmp_path / f"{k}.xml")) for k in "12"])
    first = pages.groupBy(F.col("record.controlfield")[0]["_VALUE"].alias("id")).agg(F.min_by("record", F.struct("file", "pos")).alias("record"))
    marc.write(first.coalesce(1), str(tmp_path / "all"))
    back = marc.parse(marc.read(spark, str(tmp_path / "all")))
    assert sorted((r.record_id, r.title, r.n_rollcall) for r in back.collect()) == [(i, f"t{i} & é", 1) for i in "123"]


@pytest.mark.parametrize("held", [(), (1,), (0, 2)])
def test_tasks_without_records_leave_whole_files(spark, tmp_path, held):
    """F1 of round 4: every file is a collection, if the first task has no records or none has any."""
    rows = spark.range(0, 30, 1, 3).where((F.col("id") / 10).cast("int").isin(list(held)) if held else F.lit(False))
    xml = F.concat(F.lit('<record><controlfield tag="001">'), F.col("id").cast("string"), F.lit("</controlfield></record>"))
    marc.write(marc.from_text(rows.select(xml.alias("xml")), "xml", F.lit("made"), F.lit(0)), f"file://{tmp_path}/all")
    made = list((tmp_path / "all").glob("part-*"))
    assert made and all(f.read_text().rstrip().endswith("</collection>") for f in made)
    back = marc.parse(marc.read(spark, f"file://{tmp_path}/all"), "title")
    assert sorted(int(r.record_id) for r in back.collect()) == [10 * k + i for k in held for i in range(10)]


def test_what_is_to_be_fetched(spark):
    names = spark.createDataFrame([("1999",), ("2000",), ("2001",), ("2002",)], "name string")
    have = spark.createDataFrame([("1999", 5000, 150), ("2000", 100, 0), ("2001", 9000, 200)], "name string, n_bytes long, n_records long")
    assert sorted(r.name for r in ingest.to_fetch(names, have, forced=("2001",)).collect()) == ["2000", "2001", "2002"]
    years = spark.createDataFrame([("1999",), ("",), (None,), ("199",), ("3000",), ("19x9",), ("2100",)], "year string")
    assert sorted(str(r.year) for r in ingest.undated(years).collect()) == ["", "199", "19x9", "3000", "None"]


def test_log_and_outcomes(spark, tmp_path):
    log = spark.createDataFrame([("a", "ok", "f"), ("b", "error:x", "")], ingest.LOG)
    ingest.append_log(log, str(tmp_path / "log"))
    ingest.append_log(log.where("symbol = 'b'"), str(tmp_path / "log"))
    assert spark.read.csv(str(tmp_path / "log"), schema=ingest.LOG).count() == 3
    got = spark.createDataFrame([("", 0), ("l", 10), ("l", 900)], "link string, size int").select(ingest.outcome(F.col("size"), F.col("link"))).collect()
    assert [r[0] for r in got] == ["missing", "tiny", "ok"]


def plain_ring(ring, least_area=3.0):
    """A ring's path by the published tables, point by point."""
    def place(lon, lat):
        up = abs(lat)
        i = min(int(up / 5), 17)
        f = (up - i * 5) / 5
        long, far = (t[i] + (t[i + 1] - t[i]) * f for t in (geo.LENGTH, geo.DISTANCE))
        return geo.WIDTH / 2 + geo.FX * long * math.radians(lon) * geo.SCALE, geo.HEIGHT / 2 - geo.FY * far * (1 if lat >= 0 else -1) * geo.SCALE

    points = [place(*p) for p in ring]
    xs, ys = zip(*points, strict=True)
    if (max(xs) - min(xs)) * (max(ys) - min(ys)) < least_area:
        return ""
    steps = []
    for x, y in points:
        if (q := (round(x, 1), round(y, 1))) != (steps[-1] if steps else None):
            steps.append(q)
    return "M" + "L".join(f"{x} {y}" for x, y in steps) + "Z" if len(steps) >= 3 else ""


def test_paths_equal_plain_ones(spark):
    rng = random.Random(1)
    shape = lambda: [[rng.uniform(-180, 180), rng.uniform(-90, 90)] for _ in range(rng.randrange(1, 7))]
    small = lambda: [[10 + rng.uniform(0, 1.2), 50 + rng.uniform(0, 1.2)] for _ in range(5)]
    rows = [(i, [[shape(), small()], [small() if i % 2 else shape()]]) for i in range(60)]
    got = {r.i: r.p for r in spark.createDataFrame(rows, "i int, polygons array<array<array<array<double>>>>").select("i", geo.shape_path(F.col("polygons")).alias("p")).collect()}
    assert got == {i: "".join(plain_ring(ring) for polygon in polygons for ring in polygon) for i, polygons in rows}
    assert any("" == plain_ring(ring) for _, ps in rows for p in ps for ring in p)


def test_rounding_is_of_the_binary_value(spark):
    rng = random.Random(2)
    values = [0.15, 0.25, 0.35, 0.45, 0.05, 2.675, -0.15, -0.04, 0.0, 999.95, 1e-9, *[k / 20 for k in range(1, 4000, 7)], *[rng.uniform(-1000, 1000) for _ in range(500)]]
    got = [r.r for r in spark.createDataFrame([(v,) for v in values], "x double").select(geo.rounded(F.col("x")).alias("r")).collect()]
    assert list(map(str, got)) == [str(round(v, 1)) for v in values]


def test_map_of_a_geojson_file(spark, tmp_path):
    square = lambda x, n: [[x, 0], [x + n, 0], [x + n, n], [x, 0]]
    features = [
        {"id": "AAA", "properties": {"name": "A é"}, "geometry": {"type": "Polygon", "coordinates": [square(0, 9), square(1, 7)]}},
        {"properties": {"id": "BBB"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square(20, 9)], [square(40, 9)]]}},
        {"id": "ATA", "properties": {"name": "ice"}, "geometry": {"type": "Polygon", "coordinates": [square(0, 9)]}},
        {"id": "", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [square(0, 9)]}},
        {"id": "CCC", "properties": {"name": "speck"}, "geometry": {"type": "Polygon", "coordinates": [square(0, 0.01)]}},
        {"id": "AAA", "properties": {"name": "again"}, "geometry": {"type": "Polygon", "coordinates": [square(5, 9)]}},
    ]
    (tmp_path / "world.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    drawn = geo.shapes(files.read_geojson(spark, str(tmp_path / "world.json")))
    assert {r.iso3: (r.name, r.path) for r in drawn.collect()} == {"AAA": ("again", plain_ring(square(5, 9))), "BBB": ("BBB", plain_ring(square(20, 9)) + plain_ring(square(40, 9)))}
    voters = spark.createDataFrame([("AAA", "x"), ("CCC", "small"), ("DDD", "gone")], "iso3 string, name string")
    points = spark.createDataFrame([("CCC", 1.0, 2.0), ("AAA", 1.0, 1.0), ("EEE", 0.0, 0.0)], "iso3 string, lon double, lat double")
    dotted = geo.dots(points, voters, drawn)
    assert [r.iso3 for r in dotted.collect()] == ["CCC"] and [r.iso3 for r in geo.undrawn(voters, drawn, dotted).collect()] == ["DDD"]
    line = geo.world(drawn, dotted).select(files.payload(F.col("world"), "WORLD")).first()[0]
    world = json.loads(line.removeprefix("window.WORLD = ").removesuffix(";"))
    assert world["W"] == 1000 and set(world["paths"]) == {"AAA", "BBB"} and world["names"]["CCC"] == "small" and len(world["dots"]["CCC"]) == 2


@pytest.mark.parametrize("ranges", [1, 40])
def test_payload_of_a_small_catalogue(spark, tmp_path, ranges):
    text = "record_id symbol title draft date year body vote_type agenda_subject agenda_item_title main_sponsors meeting url_resolution url_draft yes no abstain".split()
    rows = [
        ("1", "S1", "T : draft resolution / x", "", " 1999 ", "1999", "The Council", "RECORDED", " B ", "I - ", " Cuba ", "m", "u", "d", "1", "1", "0", 2, 0),
        ("2", "S2", "Second", " Amendment", "", "", "x", "odd", "A", "", "", "", "", "", "", "", "", 1, 1),
        ("3", "S3", "Third", "", "", "2001", "x", "", "A", "", "", "", "", "", "5", "0", "0", 0, 2),
        ("4", "S4", 'Quote " é', "", "", "2000", "x", "RECORDED", "A", "", "", "", "", "", "9", "", "1", 1, 3),
    ]
    res = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in text) + ", n_rollcall int, pos long")
    cast = [("1", "VEN", "venezuela (x)", "Y", "1999", 0), ("1", "CUB", "cuba", "N", "1999", 1), ("2", "VEN", "new NAME", "?", "", 2), ("4", "", "none", "Y", "2000", 3), ("3", "VEN", "x", "Y", "2001", 4), ("4", "VEN", "late", "A", "2000", 5)]
    votes_ = spark.createDataFrame(cast, "record_id string, iso3 string, country string, vote string, year string, pos long")
    groups = spark.createDataFrame([("VEN", "GRULAC")], "iso3 string, grp string")
    payload.write(res, votes_, groups, {"GRULAC": "Latin"}, f"file://{tmp_path}/p", ranges)
    n = parts.join_parts(spark, f"file://{tmp_path}/p", f"file://{tmp_path}/data.js")
    raw = (tmp_path / "data.js").read_bytes()
    listed = [r for r in parts.manifest(spark, f"file://{tmp_path}/p").collect()]
    assert raw == b"".join(r.text.encode() + ((tmp_path / "p" / r.file).read_bytes() if r.file else b"") for r in listed)
    assert n == len(raw) == sum(r.n_bytes + len(r.text.encode()) for r in listed)
    assert ranges == 1 or sum(r.section == 5 for r in listed) > 8 and {r.first_kind for r in listed if r.section == 5} == {parts.ITEM, parts.INNER, parts.PLAIN}
    data = json.loads(raw.decode().removeprefix("window.DATA = ").removesuffix(";"))
    for section, name, key in ((1, "res", "id"), (3, "countries", "iso3"), (7, "subjects", "name"), (9, "resAll", "id")):
        got = parts.items(spark, f"file://{tmp_path}/p", section, f"struct<{key} string>").orderBy("place").collect()
        assert [(r.place, r.item[key]) for r in got] == [(k, x[key]) for k, x in enumerate(data[name])]
    assert [r["id"] for r in data["res"]] == ["1", "2", "4"] and list(data) == ["meta", "res", "countries", "votes", "subjects", "resAll"]
    assert data["res"][0] == {"id": "1", "sym": "S1", "title": "T : draft resolution / x", "year": 1999, "date": "1999", "body": "HRC", "subj": "B", "item": "I", "spon": "Cuba", "mtg": "m", "urlR": "u", "urlD": "d", "y": 1, "n": 1, "a": 0}
    assert data["res"][1]["am"] == 1 and data["res"][1]["y"] is None and data["res"][2]["title"] == 'Quote " é'
    assert data["countries"] == [
        {"iso3": "CUB", "name": "Cuba", "group": "", "n": 1, "y": 0, "no": 1, "a": 0, "absent": 0, "blank": 0, "first": 1999, "last": 1999},
        {"iso3": "VEN", "name": "Late", "group": "GRULAC", "n": 3, "y": 1, "no": 0, "a": 1, "absent": 0, "blank": 1, "first": 1999, "last": 2000},
    ]
    assert data["votes"] == {"CUB": {"r": [0], "v": "N"}, "VEN": {"r": [0, 1, 2], "v": "Y-A"}}
    assert data["subjects"] == [{"name": "A", "n": 2, "cs": False}, {"name": "B", "n": 1, "cs": False}]
    assert data["resAll"][0] == {"id": "1", "sym": "S1", "t": "T", "year": 1999, "body": "HRC", "subj": "B", "vt": "V", "y": 1, "n": 1, "a": 0} and data["resAll"][2]["y"] == 5 and "y" not in data["resAll"][3]
    cover = data["meta"]["coverage"]
    assert cover["voteTypes"] == [{"type": "RECORDED", "count": 2, "hasRollcall": 2}, {"type": "odd", "count": 1, "hasRollcall": 1}, {"type": "(blank)", "count": 1, "hasRollcall": 0}]
    assert (cover["totalResolutions"], cover["recordedResolutions"], cover["totalsNoRollcall"], cover["neitherTotalsNorRollcall"], cover["reconciled"], cover["mismatched"]) == (4, 3, 1, 0, 1, 0)
    assert cover["bodyAll"] == {"CHR": 3, "HRC": 1} and cover["decades"] == [{"decade": 1990, "all": 1, "recorded": 1}, {"decade": 2000, "all": 2, "recorded": 1}]
    assert data["meta"] | {"coverage": 0} == {"nResolutions": 3, "nCountries": 2, "yearMin": 1999, "yearMax": 2000, "groupLabels": {"GRULAC": "Latin"}, "coverage": 0}
    payload.write(res.limit(0), votes_.limit(0), groups, {}, f"file://{tmp_path}/e", ranges)
    empty = b"".join(parts.read_parts(spark, f"file://{tmp_path}/e")).decode()
    assert json.loads(empty.removeprefix("window.DATA = ").removesuffix(";"))["res"] == []


@pytest.mark.parametrize("bom", [False, True])
def test_export_comes_back(spark, tmp_path, bom):
    df = spark.createDataFrame([(i, f'x "{i}",\ny') for i in range(50)], "year int, state string").repartition(4)
    files.write_export(df, str(tmp_path / "e"), "Title, with comma", "Somewhere", ("year",), bom)
    part, = (tmp_path / "e").glob("part-*")
    head = part.read_text(encoding="utf-8-sig" if bom else "utf-8").splitlines()
    assert head[:3] == ["# Title, with comma", "# Source: Somewhere", "year,state"] and head[3] == '0,"x ""0"",' and part.read_bytes().startswith(b"\xef\xbb\xbf") == bom
    assert [tuple(r) for r in files.read_export(spark, str(part), df.schema).orderBy("year").collect()] == [(i, f'x "{i}",\ny') for i in range(50)]
