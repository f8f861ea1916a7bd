"""The charts' rows under the keys and headers that their files have."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from ..sources import files
from . import catalog as C
from . import votes as V


class Chosen(NamedTuple):
    """What a view is set to: a state, a subject, the matrix's states, two anchors and the year that parts early from late."""

    state: str
    subject: str
    states: list[str]
    anchors: tuple[str, str]
    split_year: int


class Export(NamedTuple):
    title: str
    order: tuple[str, ...]
    rows: Callable[[DataFrame, DataFrame, Chosen], DataFrame]


def _pairs(votes: DataFrame) -> DataFrame:
    return V.agreement_pairs(votes)


def _agreement(votes: DataFrame, res: DataFrame, on: Chosen) -> DataFrame:
    return V.both_ways(_pairs(votes)).where(f"state_a = {_text(on.state)}").selectExpr("state_b as state", "shared", "same", "agreement_pct")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: By key: title, order and rows, of ``votes`` (record_id, state, grp, code, year, month, subject) and ``res`` (a row for each resolution).
EXPORTS = {
    "ovtl": Export("Resolutions by year and body", ("year", "body"), lambda v, r, on: C.volume_by_year(r)),
    "ctl": Export("A state's votes by year", ("year",), lambda v, r, on: V.composition(V.one_vote(v.where(f"state = {_text(on.state)}")))),
    "cal": Export("Agreement with every other state", ("state",), _agreement),
    "ttrend": Export("Average share of yes on a topic", ("year",), lambda v, r, on: C.topic_trend(r.where(f"subject = {_text(on.subject)}"))),
    "bheat": Export("Voting coincidence", ("state",), lambda v, r, on: V.pivoted(V.coincidence_matrix(_pairs(v), v.select("state")), on.states)),
    "bmds": Export("Agreement with two anchors", ("state",), lambda v, r, on: V.alignment_map(_pairs(v), *on.anchors)),
    "bcoh": Export("Cohesion of regional groups", ("grp",), lambda v, r, on: V.cohesion(V.one_vote(v))),
    "biso": Export("Share of votes on the minority side", ("state",), lambda v, r, on: V.outvoted(V.one_vote(v))),
    "cflips": Export("Change of the share adopted by consensus", ("subject",), lambda v, r, on: C.consensus_flips(r, on.split_year)),
    "cero": Export("Share adopted by consensus", ("year",), lambda v, r, on: C.consensus_by_year(r)),
    "cexplorer": Export("All resolutions", ("record_id",), lambda v, r, on: C.explorer(r)),
}


def rows(key: str, votes: DataFrame, res: DataFrame, chosen: Chosen) -> DataFrame:
    return EXPORTS[key].rows(votes, res, chosen)


def write(key: str, votes: DataFrame, res: DataFrame, chosen: Chosen, folder: str, source: str) -> DataFrame:
    """Write one chart's file below ``folder`` and return the rows it has."""
    made = rows(key, votes, res, chosen)
    files.write_export(made, f"{folder}/{key}", EXPORTS[key].title, source, EXPORTS[key].order)
    return made
