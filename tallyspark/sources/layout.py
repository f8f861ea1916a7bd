"""Votes as a table laid out for its queries: folders of years, and in each of them buckets of resolutions.

A range of years opens its folders alone. Whatever is grouped or joined by resolution finds a resolution's votes in one
bucket, so nothing is shuffled for it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

#: Buckets of resolutions; a large table takes so many that a year's votes fill some hundred MB in each.
BUCKETS = 16


def store_votes(votes: DataFrame, at: str, name: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Write ``votes`` (record_id, year, ...) below ``at`` as the table ``name`` (a new one if it is None) and return that table."""
    name = name or f"votes_{uuid.uuid4().hex[:12]}"
    # a year's rows go to as many files as it has buckets, not to one of each for every task
    dealt = votes.repartition(buckets, "record_id")
    dealt.write.mode("overwrite").partitionBy("year").bucketBy(buckets, "record_id").sortBy("record_id").option("path", at).saveAsTable(name)
    return votes.sparkSession.table(name)


def store_resolutions(res: DataFrame, at: str, name: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Resolutions in the same buckets, so that votes meet them without a shuffle."""
    name = name or f"resolutions_{uuid.uuid4().hex[:12]}"
    res.repartition(buckets, "record_id").write.mode("overwrite").bucketBy(buckets, "record_id").sortBy("record_id").option("path", at).saveAsTable(name)
    return res.sparkSession.table(name)
