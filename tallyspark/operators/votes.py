"""Aggregations over roll-calls. ``votes``: record_id, state, grp, code, year, pos; ``res``: one row for each resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bits
from ..functions.text_rules import vote_code
from ..sources.folders import materialise, workspace

VALID = bits.VALID


def one_vote(votes: DataFrame) -> DataFrame:
    """One valid vote for each state and resolution: the least code of several."""
    return votes.where(F.col("code").isin(*VALID)).groupBy("record_id", "state").agg(
        F.min("grp").alias("grp"),
        F.min("code").alias("code"),
        F.min("year").alias("year"),
        F.min("month").alias("month"),
        F.min("subject").alias("subject"),
    )


def agreement_pairs(votes: DataFrame) -> DataFrame:
    """Share of equal votes among the resolutions that both states of a pair voted on (of several votes of a state on one
    the least code counts), from the bit-sliced vote matrix. Ids that aren't whole numbers are numbered first."""
    number = "record_id"
    if not isinstance(votes.schema["record_id"].dataType, T.IntegralType):
        votes, number = votes.join(dense_index(votes), "record_id"), "ri"
    return agreement_of(bits.agreement(bits.bit_matrix(votes, number)))


def agreement_of(counted: DataFrame) -> DataFrame:
    return counted.withColumn("agreement_pct", F.round(F.col("same") * F.lit(100.0) / F.col("shared"), 4))


def both_ways(pairs: DataFrame) -> DataFrame:
    swapped = pairs.select(F.col("state_b").alias("state_a"), F.col("state_a").alias("state_b"), "shared", "same", "agreement_pct")
    return pairs.unionByName(swapped)


def partners(pairs: DataFrame, k: int, closest: bool) -> DataFrame:
    """Each state's k closest or furthest partners; ties by name."""
    order = F.col("agreement_pct").desc() if closest else F.col("agreement_pct").asc()
    w = Window.partitionBy("state_a").orderBy(order, "state_b")
    return both_ways(pairs).withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k).select("state_a", "state_b", "agreement_pct", "rank")


def coincidence_matrix(pairs: DataFrame, states: DataFrame) -> DataFrame:
    """The square of agreements in long form, with 100 on the diagonal."""
    own = states.select(F.col("state").alias("state_a"), F.col("state").alias("state_b"), F.lit(100.0).alias("agreement_pct")).distinct()
    return both_ways(pairs).select("state_a", "state_b", "agreement_pct").unionByName(own)


def pivoted(matrix: DataFrame, states: list[str]) -> DataFrame:
    """One row for each state and a column for each of ``states``."""
    return matrix.groupBy(F.col("state_a").alias("state")).pivot("state_b", states).agg(F.first("agreement_pct"))


def alignment_map(pairs: DataFrame, anchor_x: str, anchor_y: str, least: int = 1) -> DataFrame:
    """Every other state by its agreement with two anchors, and the votes it shares with both."""
    of = both_ways(pairs).where(F.col("state_b").isin(anchor_x, anchor_y) & ~F.col("state_a").isin(anchor_x, anchor_y))
    x, y = (F.max(F.when(F.col("state_b") == a, F.col("agreement_pct"))) for a in (anchor_x, anchor_y))
    return of.groupBy(F.col("state_a").alias("state")).agg(
        x.alias("x"),
        y.alias("y"),
        F.min("shared").alias("shared_votes"),
        F.count("*").alias("k"),
    ).where((F.col("k") == 2) & (F.col("shared_votes") >= least)).drop("k")


def _tally(*keys: str):
    return lambda df: df.groupBy(*keys).agg(*[F.count_if(F.col("code") == c).alias(c.lower()) for c in VALID])


def cohesion(one: DataFrame, least: int = 2) -> DataFrame:
    """Mean agreement index of each group over the resolutions with ``least`` of its votes or more."""
    t = _tally("grp", "record_id")(one).withColumn("all", F.col("y") + F.col("n") + F.col("a")).where(F.col("all") >= least)
    m = F.greatest("y", "n", "a").cast("double")
    return t.groupBy("grp").agg(F.round(F.avg((m - (F.col("all") - m) / 2) / F.col("all")), 6).alias("agreement_index"), F.count("*").alias("resolutions"))


def outvoted(one: DataFrame) -> DataFrame:
    """Share of a state's votes on another side than the chamber's plurality; ties of the chamber don't count."""
    t = _tally("record_id")(one)
    top = F.greatest("y", "n", "a")
    side = F.when((F.col("y") == top), "Y").when(F.col("n") == top, "N").otherwise("A")
    ties = (F.col("y") == top).cast("int") + (F.col("n") == top).cast("int") + (F.col("a") == top).cast("int")
    won = t.where(ties == 1).select("record_id", side.alias("won"))
    return one.join(won, "record_id").groupBy("state").agg(
        F.round(F.count_if(F.col("code") != F.col("won")) * F.lit(100.0) / F.count("*"), 4).alias("minority_side_pct"),
        F.count("*").alias("votes"),
    )


def composition(one: DataFrame) -> DataFrame:
    t = _tally("state", "year")(one)
    return t.select(
        "state",
        "year",
        F.col("y").alias("yes"),
        F.col("n").alias("no"),
        F.col("a").alias("abstain"),
        F.round(F.col("y") * F.lit(100.0) / (F.col("y") + F.col("n") + F.col("a")), 4).alias("yes_pct"),
    )


def membership_gaps(one: DataFrame, period: str) -> DataFrame:
    """Periods (whole numbers) after which a state was away for one or more."""
    seen = one.select("state", F.col(period).cast("long").alias("period")).distinct()
    before = F.lag("period").over(Window.partitionBy("state").orderBy("period"))
    return seen.withColumn("before", before).where(F.col("period") - F.col("before") > 1).select("state", "before", F.col("period").alias("after"))


def by_topic(one: DataFrame, by: str) -> DataFrame:
    """Shares of yes, no and abstain by subject and state or group."""
    t = _tally("subject", by)(one).withColumn("all", F.col("y") + F.col("n") + F.col("a"))
    return t.select(
        "subject",
        by,
        *[F.round(F.col(c) * F.lit(100.0) / F.col("all"), 4).alias(f"{name}_pct") for c, name in (("y", "yes"), ("n", "no"), ("a", "abstain"))],
        F.col("all").alias("votes"),
    )


def tally(votes: DataFrame) -> DataFrame:
    """Votes by code for each resolution; rows without a state don't count."""
    known = votes.where(F.coalesce(F.col("state"), F.lit("")) != "")
    code = F.col("code")
    return known.groupBy("record_id").agg(
        F.count_if(code == "Y").alias("y"),
        F.count_if(code == "N").alias("n"),
        F.count_if(code == "A").alias("a"),
        F.count_if(code == ".").alias("absent"),
        F.count_if(~code.isin("Y", "N", "A", ".")).alias("blank"),
    )


def reconciliation(votes: DataFrame, totals: DataFrame) -> DataFrame:
    """How many roll-calls give the official totals; without all three totals a resolution is in neither count. One without a
    named state's vote has three zeros to compare."""
    given = totals.where("yes is not null and no is not null and abstain is not null")
    both = given.join(tally(votes), "record_id", "left").fillna(0, ["y", "n", "a"])
    same = (F.col("y") == F.col("yes")) & (F.col("n") == F.col("no")) & (F.col("a") == F.col("abstain"))
    return both.agg(F.count_if(same).alias("reconciled"), F.count_if(~same).alias("mismatched"))


def state_statistics(votes: DataFrame) -> DataFrame:
    code = F.col("code")
    kinds = {"yes": code == "Y", "no": code == "N", "abstain": code == "A", "absent": code == ".", "blank": ~code.isin("Y", "N", "A", ".")}
    return votes.groupBy("state").agg(
        F.min("grp").alias("grp"),
        F.count("*").alias("n"),
        *[F.count_if(c).alias(n) for n, c in kinds.items()],
        F.min("year").cast("long").alias("first"),
        F.max("year").cast("long").alias("last"),
    )


def latest_name(votes: DataFrame, name: str, order: list[str]) -> DataFrame:
    """A state's name in its last row by year (none counts as 0) and the order given."""
    key = F.struct(F.coalesce("year", F.lit(0)).alias("year"), *order, name)
    return votes.groupBy("state").agg(F.max_by(name, key).alias("name"))


#: Resolutions of a part of the vote matrix: what one task sorts for one state.
PART = 1 << 16


def vote_parts(votes: DataFrame, index: DataFrame) -> DataFrame:
    """The vote matrix in parts of ``PART`` resolutions: state, part, and r and v of equal length, in order."""
    part = F.floor(F.col("ri") / PART).alias("part")
    rows = votes.join(index, "record_id").groupBy("state", part).agg(F.sort_array(F.collect_list(F.struct("ri", "pos", vote_code(F.col("code")).alias("c")))).alias("x"))
    return rows.select("state", "part", F.transform("x", lambda e: e["ri"]).alias("r"), F.array_join(F.transform("x", lambda e: e["c"]), "").alias("v"))


def vote_matrix(votes: DataFrame, index: DataFrame) -> DataFrame:
    """For each state its resolutions' numbers and its codes, in order: the parts one after another, as a browser reads them."""
    whole = vote_parts(votes, index).groupBy("state").agg(F.sort_array(F.collect_list(F.struct("part", "r", "v"))).alias("x"))
    return whole.select("state", F.flatten(F.transform("x", lambda e: e["r"])).alias("r"), F.array_join(F.transform("x", lambda e: e["v"]), "").alias("v"))


def dense_index(recorded: DataFrame, order: str = "record_id") -> DataFrame:
    """Numbers from 0 in order, without gathering the rows: a number in its range part, after the parts before it. The
    parts are written once, so that both uses see the same ones."""
    spark = recorded.sparkSession
    rows = recorded.select("record_id", F.col(order).alias("by")).distinct().repartitionByRange("by", "record_id").withColumn("part", F.spark_partition_id())
    parts = materialise(rows, workspace(spark, "index"))
    numbered = parts.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy("by", "record_id")))
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))  # a row for each part
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return numbered.join(F.broadcast(before.select("part", "before")), "part").select("record_id", (F.col("before") + F.col("k") - 1).cast("long").alias("ri"))


def rollcall(votes: DataFrame, record_id) -> DataFrame:
    """One roll-call: the states under each code."""
    return votes.where(F.col("record_id") == record_id).groupBy("code").agg(
        F.count("*").alias("n"),
        F.array_join(F.sort_array(F.collect_set("state")), ",").alias("states"),
    )


def vote_table(votes: DataFrame, state: str, by: str = "year", descending: bool = True) -> DataFrame:
    """A state's votes in the order of a column, then by resolution."""
    order = F.col(by).desc() if descending else F.col(by).asc()
    return votes.where(F.col("state") == state).orderBy(order, "record_id", "pos")


def ranked(rows: DataFrame, by: str, *ties: str, descending: bool = True) -> DataFrame:
    """``rows`` (one for each state, or for each subject and state: few) with their place by a column."""
    order = F.col(by).desc() if descending else F.col(by).asc()
    return rows.withColumn("place", F.row_number().over(Window.orderBy(order, *ties)).cast("long"))


def topic_trend_by(one: DataFrame, subject: str, by: str) -> DataFrame:
    """Share of yes among a subject's votes, by year and state or group."""
    t = _tally("year", by)(one.where(F.col("subject") == subject))
    return t.select(
        "year",
        by,
        F.round(F.col("y") * F.lit(100.0) / (F.col("y") + F.col("n") + F.col("a")), 4).alias("yes_pct"),
        (F.col("y") + F.col("n") + F.col("a")).alias("votes"),
    )


def most_active(votes: DataFrame, k: int) -> DataFrame:
    return votes.groupBy("state").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "state").limit(k)


def most_agreeing(pairs: DataFrame, k: int, most: bool = True) -> DataFrame:
    mean = both_ways(pairs).groupBy(F.col("state_a").alias("state")).agg(F.round(F.avg(F.col("same") * F.lit(100.0) / F.col("shared")), 4).alias("mean_agreement"))
    return mean.orderBy(F.desc("mean_agreement") if most else F.asc("mean_agreement"), "state").limit(k)


def nearest_chain(votes: DataFrame, k: int) -> DataFrame:
    """place and state: a greedy order of the ``k`` most active states (a chart's thirty): from the most active on,
    always the one left that agrees most with the last (ties by name). Only votes of these states are paired; their
    agreements are one row's map, and the order is built inside that row."""
    active = votes.where(F.col("code").isin(*VALID)).groupBy("state").agg(F.countDistinct("record_id").alias("n")).orderBy(F.desc("n"), "state").limit(k)
    active = materialise(active, workspace(votes.sparkSession, "active"))
    pairs = both_ways(agreement_pairs(votes.join(F.broadcast(active.select("state")), "state", "left_semi")))  # k states
    share = pairs.agg(F.map_from_entries(F.collect_list(F.struct(F.struct("state_a", "state_b").alias("pair"), "agreement_pct"))).alias("share"))  # k * k numbers
    states = active.agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "state"))).alias("states"))
    one = states.join(share).select(F.transform("states", lambda x: x["state"]).alias("states"), "share")  # a row each

    def step(chain: Column, _) -> Column:
        left = F.filter("states", lambda s: ~F.array_contains(chain, s))
        agrees = lambda s: F.coalesce(F.try_element_at("share", F.struct(F.element_at(chain, -1).alias("state_a"), s.alias("state_b"))), F.lit(-1.0))
        best = F.array_min(F.transform(left, lambda s: F.struct((-agrees(s)).alias("k"), s.alias("state"))))
        return F.concat(chain, F.array(best["state"]))

    turns = F.when(F.size("states") > 1, F.sequence(F.lit(2), F.size("states"))).otherwise(F.array().cast("array<int>"))
    chain = F.aggregate(turns, F.slice("states", 1, 1), step)
    return one.select(F.posexplode(chain).alias("place", "state")).select(F.col("place").cast("long").alias("place"), "state")
