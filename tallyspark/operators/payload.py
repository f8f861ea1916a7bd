"""The payload that a browser reads: its rows, and one script file.

``res``: a catalogue's text columns (as marc.resolutions gives them) and pos, a number that orders its rows. ``votes``: record_id,
iso3, country, vote, year and pos. Ties of counts are in the order in which things are first seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text_rules as R
from ..sources import files, parts
from ..sources.folders import materialise, workspace
from . import catalog
from .naming import naming
from .votes import dense_index, reconciliation

#: Names, besides the states', that make a subject one of a country's situation.
SITUATIONS = [
    "PALESTINE",
    "STATE OF PALESTINE",
    "OCCUPIED ARAB TERRITORIES",
    "OCCUPIED PALESTINIAN TERRITORY",
    "SOUTHERN AFRICA",
    "KOSOVO",
    "WESTERN SAHARA",
    "IRAN",
    "SYRIA",
    "BURMA",
]


def recorded(res: DataFrame) -> DataFrame:
    """Resolutions with a roll-call, and their number ``ri`` from 0 in the catalogue's order."""
    rows = res.where(R.number(F.col("n_rollcall").cast("string")) > 0)
    return rows.join(dense_index(rows.select("record_id", "pos"), "pos"), "record_id")


def _am() -> Column:
    return F.when(R.is_amendment(F.col("title"), F.col("draft")), 1).alias("am")


def _common() -> list[Column]:
    return [R.number(F.col("year")).alias("year"), R.body_code(F.col("body")).alias("body"), R.strip(R.filled(F.col("agenda_subject"))).alias("subj")]


def res_rows(rows: DataFrame) -> DataFrame:
    """A row for each recorded resolution: fifteen fields, ``am`` (1 or null) and its number."""
    text = lambda c, name: R.strip(R.filled(F.col(c))).alias(name)
    return rows.select(
        F.col("record_id").alias("id"), F.col("symbol").alias("sym"), "title", *_common(), text("date", "date"), R.clean_item(F.col("agenda_item_title")).alias("item"),
        text("main_sponsors", "spon"), text("meeting", "mtg"), text("url_resolution", "urlR"), text("url_draft", "urlD"),
        *[R.number(F.col(c)).alias(n) for c, n in (("yes", "y"), ("no", "n"), ("abstain", "a"))], _am(), "ri",
    )


def res_all_rows(res: DataFrame) -> DataFrame:
    """A lean row for every resolution: totals only where there are any."""
    has = R.has_totals(F.col("yes"), F.col("no"), F.col("abstain"))
    totals = [F.when(has, R.number(F.col(c))).alias(n) for c, n in (("yes", "y"), ("no", "n"), ("abstain", "a"))]
    return res.select(
        F.col("record_id").alias("id"),
        F.col("symbol").alias("sym"),
        R.trim_title(F.col("title")).alias("t"),
        *_common(),
        R.mode_code(F.col("vote_type")).alias("vt"),
        _am(),
        *totals,
        "pos",
    )


def vote_rows(votes: DataFrame, rows: DataFrame) -> DataFrame:
    """Votes of recorded resolutions by states with a code: with the resolution's number and year."""
    known = rows.select("record_id", "ri", R.number(F.col("year")).alias("res_year"))
    return votes.where(R.filled(F.col("iso3")) != "").join(known, "record_id").withColumn("code", R.vote_code(R.filled(F.col("vote"))))


def countries(cast: DataFrame, groups: DataFrame) -> DataFrame:
    """``cast``: vote_rows. ``groups``: iso3 and grp, a row for each state. A row for each state that voted; its
    name is that of its last row by year, its group "" if it has none."""
    count = lambda c, name: F.count_if(F.col("code") == c).alias(name)
    year = F.when(F.col("res_year") != 0, F.col("res_year"))
    last = F.struct(F.coalesce(R.number(F.col("year")), F.lit(0)).alias("year"), F.col("pos"))
    made = cast.groupBy("iso3").agg(
        F.max_by(R.title_case(F.col("country")), last).alias("name"), F.count("*").alias("n"), count("Y", "y"), count("N", "no"), count("A", "a"), count(".", "absent"), count("-", "blank"),
        F.min(year).alias("first"), F.max(year).alias("last"),
    )
    return made.join(groups.select("iso3", F.col("grp").alias("group")), "iso3", "left").select(
        "iso3",
        "name",
        F.coalesce("group", F.lit("")).alias("group"),
        "n",
        "y",
        "no",
        "a",
        "absent",
        "blank",
        "first",
        "last",
    )


def matrix(cast: DataFrame) -> DataFrame:
    """For each state its resolutions' numbers ``r`` and its codes ``v``, in the votes' order."""
    rows = cast.groupBy("iso3").agg(F.sort_array(F.collect_list(F.struct("pos", "ri", "code"))).alias("x"))
    return rows.select("iso3", F.transform("x", lambda e: e["ri"]).alias("r"), F.array_join(F.transform("x", lambda e: e["code"]), "").alias("v"))


def subjects(made: DataFrame, names: DataFrame) -> DataFrame:
    """``made``: res_rows; ``names``: name. Subjects with their number of resolutions, the first one's number, and whether
    they name a state or situation: equal to its name, or holding one of over five letters."""
    fixed = names.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, SITUATIONS))).alias("name"))
    t = made.where("subj <> ''").groupBy(F.col("subj").alias("name")).agg(F.count("*").alias("n"), F.min("ri").alias("first_seen"))
    hit = naming(t.select(F.col("name").alias("text")), names.select("name").unionByName(fixed))
    flagged = t.join(hit.select(F.col("text").alias("name"), F.lit(True).alias("cs")), "name", "left").fillna(False, ["cs"])
    return flagged.select("name", "n", "cs", "first_seen")


def _typed(res: DataFrame) -> DataFrame:
    """The catalogue's text columns as the numbers that the statistics of catalog.py take."""
    rolls = F.coalesce(R.number(F.col("n_rollcall").cast("string")), F.lit(0))
    return res.select(R.filled(F.col("vote_type")).alias("vt"), rolls.alias("n_rollcall"), R.number(F.col("year")).alias("year"), "pos")


def vote_types(res: DataFrame) -> DataFrame:
    """type ("(blank)" if blank), count, hasRollcall and first_seen."""
    made = catalog.vote_types(_typed(res), first_seen="pos")
    return made.select("type", F.col("n").alias("count"), F.col("has_rollcall").alias("hasRollcall"), "first_seen")


def coverage(res: DataFrame) -> DataFrame:
    """One row: what the catalogue holds and how much of it has roll-calls."""
    has_rolls = F.coalesce(R.number(F.col("n_rollcall").cast("string")) > 0, F.lit(False))
    has_totals, subject = R.has_totals(F.col("yes"), F.col("no"), F.col("abstain")), F.nullif(R.strip(R.filled(F.col("agenda_subject"))), F.lit(""))
    body = R.body_code(F.col("body"))
    return res.agg(
        F.count("*").alias("totalResolutions"), F.count_if(has_rolls).alias("recordedResolutions"), F.count_if(body == "HRC").alias("hrc"), F.count_if(body == "CHR").alias("chr"),
        F.count_if(~has_rolls & has_totals).alias("totalsNoRollcall"), F.count_if(~has_rolls & ~has_totals).alias("neitherTotalsNorRollcall"),
        F.countDistinct(subject).alias("nSubjectsAll"), F.countDistinct(F.when(has_rolls, subject)).alias("nSubjectsRecorded"),
        F.min(F.when(has_rolls, F.nullif(R.number(F.col("year")), F.lit(0)))).alias("yearMin"), F.max(F.when(has_rolls, F.nullif(R.number(F.col("year")), F.lit(0)))).alias("yearMax"),
    )


def decades(res: DataFrame) -> DataFrame:
    return catalog.decades(_typed(res))


def reconciled(cast: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: recorded resolutions whose roll-call gives all three official totals, and those where it doesn't."""
    totals = rows.select("record_id", *[R.number(F.col(c)).alias(c) for c in ("yes", "no", "abstain")])
    return reconciliation(cast.withColumnRenamed("iso3", "state"), totals)


def meta(res: DataFrame, cast: DataFrame, rows: DataFrame, labels: dict[str, str]) -> DataFrame:
    """The payload's head as one row of one struct ``meta``: counts, years, labels and the catalogue's coverage."""
    listed = lambda df, order, *names: df.agg(F.transform(F.sort_array(F.collect_list(F.struct(*order, F.struct(*names).alias("x")))), lambda e: e["x"]).alias("list"))
    types = listed(vote_types(res), [(-F.col("count")).alias("k"), F.col("first_seen")], "type", "count", "hasRollcall").withColumnRenamed("list", "voteTypes")
    tens = listed(decades(res), [F.col("decade").alias("k")], "decade", "all", "recorded").withColumnRenamed("list", "decades")
    states = cast.agg(F.countDistinct("iso3").alias("nCountries"))
    one = coverage(res).join(types).join(tens).join(states).join(reconciled(cast, rows))  # a row each
    bodies = F.map_filter(F.map_from_arrays(F.array(F.lit("CHR"), F.lit("HRC")), F.array("chr", "hrc")), lambda k, n: n > 0).alias("bodyAll")
    own = F.struct(
        "totalResolutions",
        "recordedResolutions",
        "voteTypes",
        bodies,
        "totalsNoRollcall",
        "neitherTotalsNorRollcall",
        "decades",
        "nSubjectsAll",
        "nSubjectsRecorded",
        "reconciled",
        "mismatched",
    )
    names = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]) if labels else F.create_map().cast("map<string,string>")
    return one.select(F.struct(F.col("recordedResolutions").alias("nResolutions"), "nCountries", "yearMin", "yearMax", names.alias("groupLabels"), own.alias("coverage")).alias("meta"))


def matrix_rows(cast: DataFrame) -> DataFrame:
    """The vote matrix as rows of text, none for a whole state: iso3, step, pos, ri, code, kind and value. One after another in that
    order they are ``"AAA":{"r":[0,1],"v":"YN"},...``: a row for each number and each code, and three for what stands around them."""
    name = F.to_json(F.array("iso3"))
    states = cast.groupBy("iso3").agg(F.count("*").alias("n"))
    frame = lambda step, value, kind: F.struct(F.lit(step).alias("step"), value.alias("value"), F.lit(kind).alias("kind"))
    around = F.array(
        frame(0, F.concat(name.substr(F.lit(2), F.length(name) - 2), F.lit(':{"r":[')), parts.ITEM),
        frame(2, F.lit('],"v":"'), parts.PLAIN),
        frame(4, F.lit('"}'), parts.PLAIN),
    )
    own = F.array(frame(1, F.col("ri").cast("string"), parts.INNER), frame(3, F.col("code"), parts.PLAIN))
    least = F.lit(-(1 << 63)).cast("long")
    a = states.select("iso3", F.explode(around).alias("x"), least.alias("pos"), least.alias("ri"), F.lit("").alias("code"))
    b = cast.select("iso3", F.explode(own).alias("x"), F.col("pos").cast("long").alias("pos"), F.col("ri").cast("long").alias("ri"), "code")
    return a.unionByName(b).select("iso3", "x.step", "pos", "ri", "code", "x.kind", "x.value")


def write(res: DataFrame, votes: DataFrame, groups: DataFrame, labels: dict[str, str], folder: str, ranges: int | None = None) -> None:
    """The script ``window.DATA = {...};`` in parts below ``folder``: parts.join_parts() makes the browser's file of them. Every section
    is evaluated once and written by ranges (some ``ranges``, else as Spark sees fit)."""
    at = workspace(res.sparkSession, "payload")  # several sections read these
    res = materialise(res, f"{at}/res")
    rows = materialise(recorded(res), f"{at}/recorded")
    cast = materialise(vote_rows(votes, rows), f"{at}/votes")
    made = materialise(res_rows(rows), f"{at}/made")
    states = materialise(countries(cast, groups), f"{at}/states")
    json = lambda *c: F.to_json(F.struct(*c), {"ignoreNullFields": "false"})
    required = ["id", "sym", "title", "year", "date", "body", "subj", "item", "spon", "mtg", "urlR", "urlD", "y", "n", "a"]
    lean = ["id", "sym", "t", "year", "body", "subj", "vt"]
    head = meta(res, cast, rows, labels).select(F.to_json("meta", {"ignoreNullFields": "false"})).first()[0]  # counts and labels
    listed = {
        1: (made.withColumn("value", files.optional(F.struct(*required), F.struct("am"))), ["ri"]),
        3: (states.withColumn("value", json(*states.columns)), ["iso3"]),
        5: (matrix_rows(cast), ["iso3", "step", "pos", "ri", "code"]),
        7: (subjects(made, states.select("name")).withColumn("value", json("name", "n", "cs")).withColumn("k", -F.col("n")), ["k", "first_seen"]),
        9: (res_all_rows(res).withColumn("value", files.optional(F.struct(*lean), F.struct("am", "y", "n", "a"))), ["pos"]),
    }
    sections: list = [
        'window.DATA = {"meta":' + head + ',"res":[',
        None,
        '],"countries":[',
        None,
        '],"votes":{',
        None,
        '},"subjects":[',
        None,
        '],"resAll":[',
        None,
        "]};",
    ]
    for k, (df, order) in listed.items():
        kind = F.col("kind") if "kind" in df.columns else F.lit(parts.ITEM).alias("kind")
        sections[k] = parts.write_section(df.select(kind, "value", *order), order, folder, k, ranges)
    parts.write_manifest(sections, folder)
