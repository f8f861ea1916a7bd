"""A bit-sliced vote matrix: for each state and 64 resolutions three words of bits, the yes, no and abstain votes.

What two states share is the number of bits in the AND of their words, so a pair of states costs a row for 64
resolutions, and what is shuffled grows with states times words, not with votes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALID = ("Y", "N", "A")


def bit_matrix(votes: DataFrame, number: str) -> DataFrame:
    """state, word, and the bits y, n and a: bit k of a word is the resolution of number 64 * word + k.

    ``number``: any whole number of the resolution; the closer they lie, the fuller the words. Only valid votes by named
    states on numbered resolutions count. Of several votes of a state on one resolution the least code does, which takes no
    grouping by resolution: a bit that is set under a lesser code is cleared under the others.
    """
    bit = F.expr(f"shiftleft(1L, cast(`{number}` & 63 as int))")
    marked = [F.bit_or(F.when(F.col("code") == c, bit).otherwise(F.lit(0).cast("long"))).alias(c.lower()) for c in VALID]
    known = votes.where(F.col("code").isin(*VALID) & F.col("state").isNotNull() & F.col(number).isNotNull())
    rows = known.groupBy("state", F.expr(f"shiftright(cast(`{number}` as bigint), 6)").alias("word")).agg(*marked)
    return rows.selectExpr("state", "word", "y & ~(n | a) as y", "n & ~a as n", "a")


def agreement(bits: DataFrame) -> DataFrame:
    """state_a < state_b, shared and same: resolutions that both voted on, and those with equal votes."""
    # the states of a word are gathered (some two hundred), and pairs are made inside the row
    room = bits.groupBy("word").agg(F.sort_array(F.collect_list(F.struct("state", "y", "n", "a"))).alias("v"))
    a = room.select("v", F.posexplode("v").alias("i", "a"))
    pairs = a.select("a", F.explode(F.slice("v", F.col("i") + 2, F.greatest(F.size("v") - F.col("i") - 1, F.lit(0)))).alias("b"))
    shared, same = "bit_count((a.y | a.n | a.a) & (b.y | b.n | b.a))", "bit_count(a.y & b.y) + bit_count(a.n & b.n) + bit_count(a.a & b.a)"
    counted = pairs.groupBy(F.col("a.state").alias("state_a"), F.col("b.state").alias("state_b")).agg(
        F.sum(F.expr(shared)).alias("shared"),
        F.sum(F.expr(same)).alias("same"),
    )
    return counted.where("shared > 0")


def totals(bits: DataFrame) -> DataFrame:
    """yes, no and abstain of every state."""
    return bits.groupBy("state").agg(*[F.sum(F.bit_count(c.lower()).cast("long")).alias(name) for c, name in zip(VALID, ("yes", "no", "abstain"), strict=True)])
