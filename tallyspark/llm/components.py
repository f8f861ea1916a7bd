"""Connected components of an edge table by alternating large-star and small-star rounds.

Labels stay distributed; only a round's edge count and checksum reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialise, remove, workspace


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of some links: each linked value but the least of its group, and that least one."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[ia], label[ib])
        new = label.copy()
        np.minimum.at(new, ia, low)
        np.minimum.at(new, ib, low)
        np.minimum.at(new, label[ia], low)
        np.minimum.at(new, label[ib], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: a node's neighbours (the larger ones, or the smaller ones and itself) move to the least of all."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = both.join(least, both.u == least.w)
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: columns u and v of one orderable integer type. Returns node and root (the group's
    least node) for every node with an edge to another; nulls and loops are ignored."""
    at = workspace(edges.sparkSession, "components")
    now = materialise(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{at}/0")
    seen, k = None, 0
    while True:
        summary = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if summary == seen or summary[0] == 0:
            break
        seen, k = summary, k + 1
        after = materialise(_star(_star(now, True), False), f"{at}/{k}")
        remove(edges.sparkSession, f"{at}/{k - 1}")
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
