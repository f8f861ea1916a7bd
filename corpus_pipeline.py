"""A corpus from ``documents``: quality rules, line dedup, near-dedup, decontamination, packed sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read back
as the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import decontam, linedup, packing, quality_rules, simhash
from tallyspark.llm.shared import materialise, table, workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites go from all texts but the first; n_chars follows the text."""
    out = linedup.drop_boilerplate(docs, counts=("lines_before", "lines_removed"))
    changed = F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more) the document with the least doc_id stays."""
    return simhash.drop_near_duplicates(docs, shingle=5, bits=3, similar=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of what is left, token by token: one for each piece, with its sequence and place there."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-dedup", near_duplicates), ("decontamination", decontaminate), ("packing", pack)]

#: Tokenisation and the genetic packing aren't SQL's; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over all of ``documents``: the packed pieces of what is left.

    Null texts and empty ones fail the quality rules; rows without an id, repeated rows and further columns (whatever their
    names) go through like others; an empty table gives no rows."""
    docs, at = table(spark, sf_dir, "documents"), workspace(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"{at}/{k}")
    return docs
