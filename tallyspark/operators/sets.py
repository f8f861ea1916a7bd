"""Sets of states by name, and votes in a set and a range of years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tables
from . import votes as V

#: States of a set whose size is chosen (a chart's thirty).
SIZE = 30


def names() -> list[str]:
    """The sets that members() knows."""
    return ["most active", "P5+", "most agreeing", "most disagreeing", *[g for g in tables.GROUPS]]


def members(name: str, votes: DataFrame, groups: DataFrame, k: int = SIZE, key_states: tuple[str, ...] = ()) -> DataFrame:
    """state of every member of a set. ``votes``: record_id, state, code; ``groups``: iso3 and grp.

    ``P5+`` are the permanent members and the ``key_states`` a chart names; a group's set are its states; the others are the ``k``
    states with most votes, or with the highest or lowest mean agreement. Only states that voted are in a set."""
    voted = votes.where(F.col("state").isNotNull()).select("state").distinct()
    if name == "P5+":
        return voted.where(F.col("state").isin(*tables.PERMANENT.split(), *key_states))
    if name == "most active":
        return V.most_active(votes.where(F.col("state").isNotNull()), k).select("state")
    if name in ("most agreeing", "most disagreeing"):
        return V.most_agreeing(V.agreement_pairs(votes), k, most=name == "most agreeing").select("state")
    if name not in names():
        raise ValueError(f"no set is named {name!r}; there are {names()}")
    return voted.join(groups.where(F.col("grp") == name).select(F.col("iso3").alias("state")), "state", "left_semi")


def within(votes: DataFrame, members: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """The votes of a set's members in a range of years (both ends in it); the years are a filter on a column, so a table in
    folders of years opens only those."""
    if first is not None:
        votes = votes.where(F.col("year") >= first)
    if last is not None:
        votes = votes.where(F.col("year") <= last)
    return votes.join(members, "state", "left_semi")
