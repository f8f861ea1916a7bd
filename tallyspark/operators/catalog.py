"""Statistics and search over resolutions: record_id, year, body, vt, subject, am, title, yes, no, abstain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text_rules import any_totals
from .naming import naming


def scoped(res: DataFrame, everything: bool = False) -> DataFrame:
    """Without amendments unless asked for."""
    return res if everything else res.where("not am")


def volume_by_year(res: DataFrame) -> DataFrame:
    return res.groupBy("year", "body").agg(F.count("*").alias("n"))


def _valid(res: DataFrame) -> DataFrame:
    return res.where("yes + no + abstain > 0").withColumn("all", F.col("yes") + F.col("no") + F.col("abstain"))


def margins(res: DataFrame) -> DataFrame:
    return _valid(res).select("record_id", "year", F.round(F.abs(F.col("yes") - F.col("no")) / F.col("all").cast("double"), 6).alias("margin"))


def margin_histogram(res: DataFrame, bins: int = 10) -> DataFrame:
    cell = F.least(F.floor(F.col("margin") * bins), F.lit(bins - 1)).cast("long")
    return margins(res).groupBy(cell.alias("bin")).agg(F.count("*").alias("n"))


def most_divided(res: DataFrame, k: int) -> DataFrame:
    return margins(res).orderBy("margin", "record_id").limit(k).select("record_id", "margin")


def topic_trend(res: DataFrame) -> DataFrame:
    """Mean over resolutions of the share of yes, by subject and year."""
    share = F.col("yes") * F.lit(100.0) / F.col("all")
    return _valid(res).groupBy("subject", "year").agg(F.round(F.avg(share), 4).alias("avg_yes_share_pct"), F.count("*").alias("n"))


def topic_slope(res: DataFrame) -> DataFrame:
    """Percentage points a decade by least squares over resolutions."""
    share = F.col("yes") * F.lit(100.0) / F.col("all")
    return _valid(res).groupBy("subject").agg(F.round(F.regr_slope(share, F.col("year").cast("double")) * 10, 4).alias("slope_pp_decade"))


def consensus_by_year(res: DataFrame) -> DataFrame:
    return res.groupBy("year").agg(F.round(F.count_if(F.col("vt") == "C") * F.lit(100.0) / F.count("*"), 4).alias("consensus_share_pct"), F.count("*").alias("n"))


def mode_stack(res: DataFrame) -> DataFrame:
    by = res.groupBy("year", "vt").agg(F.count("*").alias("n"))
    total = res.groupBy("year").agg(F.count("*").alias("all"))
    return by.join(total, "year").select("year", "vt", "n", F.round(F.col("n") * F.lit(100.0) / F.col("all"), 4).alias("share_pct"))


def consensus_flips(res: DataFrame, split_year: int, least: int = 3) -> DataFrame:
    """Change of the share adopted by consensus from before ``split_year`` to from then on."""
    early, late = F.col("year") < split_year, F.col("year") >= split_year
    hit = F.col("vt") == "C"
    t = res.groupBy("subject").agg(
        F.count_if(early).alias("n_early"),
        F.count_if(late).alias("n_late"),
        F.count_if(early & hit).alias("c_early"),
        F.count_if(late & hit).alias("c_late"),
    )
    t = t.where((F.col("n_early") >= least) & (F.col("n_late") >= least))
    return t.select(
        "subject",
        "n_early",
        "n_late",
        F.round(F.col("c_late") * F.lit(100.0) / F.col("n_late") - F.col("c_early") * F.lit(100.0) / F.col("n_early"), 4).alias("delta_pp"),
    )


def middle_year(res: DataFrame) -> int:
    row = res.agg(F.min("year").alias("a"), F.max("year").alias("b")).first()
    return (row.a + row.b + 1) // 2


def subject_consensus(res: DataFrame, k: int, most: bool) -> DataFrame:
    t = res.groupBy("subject").agg(F.round(F.count_if(F.col("vt") == "C") * F.lit(100.0) / F.count("*"), 4).alias("consensus_pct"), F.count("*").alias("n"))
    return t.orderBy(F.desc("consensus_pct") if most else F.asc("consensus_pct"), "subject").limit(k)


def mode_by_year(res: DataFrame, vt: str) -> DataFrame:
    return res.where(F.col("vt") == vt).groupBy("year").agg(F.count("*").alias("n"))


def vote_types(res: DataFrame, first_seen: str | None = None) -> DataFrame:
    """How often each type occurs and how often with a roll-call; a blank type is "(blank)". With a column of ``first_seen`` also
    its least value."""
    kind = F.when(F.coalesce(F.col("vt"), F.lit("")) == "", "(blank)").otherwise(F.col("vt"))
    seen = [F.min(first_seen).alias("first_seen")] if first_seen else []
    return res.groupBy(kind.alias("type")).agg(F.count("*").alias("n"), F.count_if(F.col("n_rollcall") > 0).alias("has_rollcall"), *seen)


def decades(res: DataFrame) -> DataFrame:
    return res.where("year is not null").groupBy((F.floor(F.col("year") / 10) * 10).cast("long").alias("decade")).agg(
        F.count("*").alias("all"),
        F.count_if(F.col("n_rollcall") > 0).alias("recorded"),
    )


def totals_coverage(res: DataFrame) -> DataFrame:
    rest, has = F.col("n_rollcall") == 0, any_totals(F.col("yes"), F.col("no"), F.col("abstain"))
    return res.agg(
        F.count("*").alias("resolutions"),
        F.count_if(~rest).alias("recorded"),
        F.count_if(rest & has).alias("totals_no_rollcall"),
        F.count_if(rest & ~has).alias("neither"),
    )


def overview(res: DataFrame, states: DataFrame) -> DataFrame:
    """One row: resolutions, years, subjects, and the number of states."""
    one = res.agg(
        F.count("*").alias("n_resolutions"),
        F.min("year").cast("long").alias("year_min"),
        F.max("year").cast("long").alias("year_max"),
        F.countDistinct("subject").alias("n_subjects"),
        F.count_if(F.col("n_rollcall") == 0).alias("no_rollcall"),
    )
    return one.join(states.agg(F.countDistinct("state").alias("n_states")))


def subject_index(res: DataFrame, states: DataFrame) -> DataFrame:
    """Recorded resolutions by subject, and whether it names a state: equal to its name, or holding one of over five letters."""
    t = res.where("n_rollcall > 0 and trim(subject) <> ''").groupBy(F.trim("subject").alias("subject")).agg(F.count("*").alias("n"))
    hit = naming(t.select(F.col("subject").alias("text")), states.select(F.col("state").alias("name")))
    return t.join(hit.select(F.col("text").alias("subject"), F.lit(True).alias("cs")), "subject", "left").fillna(False, ["cs"])


def suggest(res: DataFrame, text: str, k: int) -> DataFrame:
    """Subjects that hold the text (two letters or more), the most frequent first."""
    found = res.where(F.contains(F.lower("subject"), F.lit(text.lower()))) if len(text) >= 2 else res.limit(0)
    return suggested(found, k)


def suggested(found: DataFrame, k: int) -> DataFrame:
    """The subjects of what was found, the most frequent first."""
    return found.groupBy("subject").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "subject").limit(k)


def search(res: DataFrame, text: str) -> DataFrame:
    low = F.lit(text.lower())
    return res.where(F.contains(F.lower("subject"), low) | F.contains(F.lower("title"), low)).select("record_id", "title", "subject")


def related(res: DataFrame, text: str, k: int) -> DataFrame:
    """The subjects of what a search finds, the most frequent first, without those that the text names."""
    found = search(res, text).where(~F.contains(F.lower("subject"), F.lit(text.lower())))
    return suggested(found, k)


def explorer(res: DataFrame) -> DataFrame:
    """A lean row for every resolution: totals only where there are any."""
    has = any_totals(F.col("yes"), F.col("no"), F.col("abstain"))
    return res.select(
        "record_id",
        "title",
        "year",
        "body",
        "subject",
        F.col("vt").alias("mode"),
        "am",
        *[F.when(has, F.col(c)).alias(c) for c in ("yes", "no", "abstain")],
    )


def distinct_first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key by a total order."""
    cols = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order, *[c for c in cols if c not in order])).alias("x")).select(key, "x.*")


def id_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def id_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.distinct().join(b.distinct(), a.columns[0], "left_anti")


def id_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b).agg(F.count("*").alias("n"))
