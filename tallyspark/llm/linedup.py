"""Lines that spread over many sites: found by HyperLogLog sketches, decided exactly near the threshold, removed.

A line's key is 128 bits of its hash. Sketches of the sites that hold it are built on the map side and
merged by aggregation; only lines whose estimate lies near the threshold have their distinct sites counted.
Which lines go is told by their numbers, so a text takes time in proportion to its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_rules import SPACES
from .shared import free_name, materialise, workspace

#: Distinct sites from which a line is boilerplate; the sketches' log2 of registers, and the share of the
#: threshold (six standard errors of such a sketch) and the sites around it within which lines are counted exactly.
MIN_SITES, LOG_K, BAND, BAND_SITES = 10, 12, 0.1, 2


def _key(line: Column) -> tuple[Column, Column]:
    return F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2")


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """id, text_key (of the whole text), site, pos and the key of every line with a word; a null site is one of its own."""
    line = F.posexplode(F.split(F.col("text"), "\n")).alias("pos", "line")
    site = F.coalesce(F.concat(F.lit("="), F.col(f"`{site_col}`").cast("string")), F.lit("-"))
    own = docs.select(F.col(f"`{id_col}`").alias("id"), site.alias("site"), F.col(f"`{text_col}`").alias("text"))
    own = own.select("id", "site", F.xxhash64("text").alias("text_key"), line)
    return own.where(F.length(F.translate("line", SPACES, "")) > 0).select("id", "text_key", "site", "pos", *_key(F.col("line")))


def boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """h1, h2 and first_id (the least id that holds it) of every line on ``min_sites`` distinct sites or more."""
    at = workspace(docs.sparkSession, "linedup")
    lines = _lines(docs, id_col, text_col, site_col)
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("sites"), F.min("id").alias("first_id"))
    low, high = min_sites * (1 - BAND) - BAND_SITES, min_sites * (1 + BAND) + BAND_SITES
    spread = materialise(spread.where(F.col("sites") >= low), f"{at}/spread")
    near = spread.where(F.col("sites") <= high).select("h1", "h2", "first_id")
    exact = lines.select("h1", "h2", "site").join(near, ["h1", "h2"]).distinct().groupBy("h1", "h2").agg(F.count("*").alias("sites"), F.min("first_id").alias("first_id"))
    found = spread.where(F.col("sites") > high).select("h1", "h2", "first_id").unionByName(exact.where(F.col("sites") >= min_sites).select("h1", "h2", "first_id"))
    return materialise(found, f"{at}/boilerplate")


def drop_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES, counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with its columns, and boilerplate lines taken out of every text but that of the least id that has them.

    Lines without a word always stay, in that text so do repeats of the line. A text may become empty; no row
    is lost, a null text stays null, an empty table gives no rows. Rows that share an id are told apart by their texts;
    rows without an id lose a line if some id holds it, else all of them keep it. ``counts`` names two more
    columns: lines before, and lines taken out.
    """
    found = boilerplate(docs, id_col, text_col, site_col, min_sites)
    own, key, own_key, gone, lines, kept = (free_name(docs, f"{x}_work") for x in ("id", "key", "own_key", "gone", "lines", "kept"))
    hits = _lines(docs, id_col, text_col, site_col).join(found, ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("first_id")))
    todo = hits.groupBy("id", "text_key").agg(F.collect_set("pos").alias(gone)).select(F.col("id").alias(own), F.col("text_key").alias(own_key), gone)
    out = docs.withColumn(key, F.xxhash64(F.col(f"`{text_col}`")))
    out = out.join(todo, out[f"`{id_col}`"].eqNullSafe(todo[own]) & (out[key] == todo[own_key]), "left")
    out = out.withColumn(lines, F.split(F.col(f"`{text_col}`"), "\n"))
    # the numbers that are left, in order: set operations take time in proportion
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    out = out.withColumn(kept, F.when(F.col(gone).isNotNull(), F.transform(left, lambda k: F.get(F.col(lines), k))))
    text = F.when(F.col(gone).isNull(), F.col(f"`{text_col}`")).otherwise(F.array_join(kept, "\n"))
    before = F.when(F.col(lines).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    more = [before.alias(counts[0]), F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long").alias(counts[1])] if counts else []
    return out.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns], *more)
