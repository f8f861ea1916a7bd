"""Which texts are one of many names, or hold one: all by equi-joins, so neither side has to be small.

A text's places are looked up in two steps. The first letters at each place must be those of some name, which tells
the lengths that names with such a beginning have (few, however many the names). Then the letters of each such length are the
key of the second join, whose equality is the match itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.folders import materialise, workspace

#: A text that holds a name of fewer letters doesn't name it.
LEAST = 6


def _places(text: Column, size: int) -> Column:
    """Numbers (from 1) of the places where ``size`` letters begin."""
    return F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))


def held(texts: DataFrame, names: DataFrame, least: int = LEAST) -> DataFrame:
    """``texts``: text; ``names``: name. The distinct pairs (text, name) in which a text holds a name of ``least`` letters or
    more. Nulls on either side are in none; repeated rows count once.

    A place's row has the text's number and as many letters as the longest name, not the whole text."""
    at = workspace(texts.sparkSession, "names")
    own = materialise(names.select("name").where(F.length("name") >= least).distinct(), f"{at}/names")
    longest = own.agg(F.max(F.length("name"))).first()[0] or 0
    begin = own.select(F.substring("name", 1, least).alias("head"), F.length("name").alias("size")).distinct()
    begin = begin.groupBy("head").agg(F.collect_set("size").alias("sizes"))  # as many as there are lengths of names
    known = texts.select("text").where(F.length("text") >= least).distinct().withColumn("n", F.monotonically_increasing_id())
    known = materialise(known, f"{at}/texts")  # written, so the numbers stay
    letters = F.transform(_places(F.col("text"), least), lambda k: F.substr("text", k, F.lit(longest)))
    place = known.select("n", F.explode(letters).alias("rest")).withColumn("head", F.substring("rest", 1, least))
    could = place.join(begin, "head").select("n", "rest", F.explode("sizes").alias("size")).where(F.length("rest") >= F.col("size"))
    found = could.select("n", F.substr("rest", F.lit(1), F.col("size")).alias("name")).distinct().join(own, "name")
    return found.join(known, "n").select("text", "name")


def naming(texts: DataFrame, names: DataFrame, least: int = LEAST) -> DataFrame:
    """The distinct texts that equal a name or hold one of ``least`` letters or more, in any case: column text."""
    upper = texts.select("text").distinct().withColumn("upper", F.upper("text"))
    known = names.select(F.upper("name").alias("name")).where("name is not null").distinct()
    equal = upper.join(known.withColumnRenamed("name", "upper"), "upper", "left_semi").select("upper")
    inside = held(upper.select(F.col("upper").alias("text")), known, least).select(F.col("text").alias("upper"))
    hit = equal.unionByName(inside).distinct()
    return upper.join(hit, "upper", "left_semi").select("text")
