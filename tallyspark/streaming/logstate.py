"""The mirror's log as state: what became of each symbol, kept by a stream as lines are appended.

A symbol is open while it has errors alone, and closed by its first final status. Lines may come late, in any order and more than
once: of several final ones the best counts, so the state is that of the lines as a set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ingest import LOG

STATE = "symbol string, status string, file string, open boolean"
#: Final statuses, the best first; any other that isn't an error comes after them.
FINAL = ["ok", "tiny", "missing"]
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_of(log: DataFrame) -> DataFrame:
    """symbol, status, file and open of a log, a whole one or a stream of lines. Null statuses and files are ''; lines without a symbol don't
    count."""
    status, file = F.coalesce("status", F.lit("")), F.coalesce("file", F.lit(""))

    def order(c: Column) -> Column:
        known = F.array_position(F.array(*map(F.lit, FINAL)), c)
        return F.when(c.startswith("error"), 9).when(known > 0, known - 1).otherwise(len(FINAL)).cast("int")

    best = F.min(F.struct(order(status).alias("place"), status.alias("status"), file.alias("file"))).alias("x")
    return log.where("symbol is not null").groupBy("symbol").agg(best).select("symbol", "x.status", "x.file", (F.col("x.place") == 9).alias("open"))


def follow(spark: SparkSession, log: str, target: str, checkpoint: str) -> None:
    """Take in the log's new files (CSV lines without a header), and write the state of their symbols below ``target``. A run that ends early goes on
    from its checkpoint; a batch that is repeated writes its folder again."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        changed = state_of(spark.readStream.schema(LOG).csv(log))  # the least line of a symbol is the state that Spark keeps

        def put(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{target}/part={number}")

        changed.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def current(spark: SparkSession, target: str) -> DataFrame:
    """symbol, status, file and open as they stand after the last batch."""
    rows = spark.read.schema(f"{STATE}, batch long").parquet(target)
    return rows.groupBy("symbol").agg(F.max_by(F.struct("status", "file", "open"), "batch").alias("x")).select("symbol", "x.*")
