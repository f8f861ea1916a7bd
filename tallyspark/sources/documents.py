"""Documents as files: a distributed sink of a binary column under safe names, and their source."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text_rules import safe_name
from .folders import materialise, workspace

#: Bytes under which a document is taken for an error page.
TINY = 500
OUTCOME = "symbol string, status string, file string"


def named(rows: DataFrame) -> DataFrame:
    """``rows``: symbol, link and data. status and file of each: ``missing`` without a link or data, ``tiny`` under 500 bytes (file is then the
    link), else ``ok`` with a safe name that ends as the link does
    (after an x if it would begin with _ or a full stop). Where symbols share a safe name, all but the least get a digest added."""
    size, link = F.length("data"), F.coalesce(F.col("link"), F.lit(""))
    status = F.when((link == "") | F.col("data").isNull(), "missing").when(size < TINY, "tiny").otherwise("ok")
    ending = F.lower(F.regexp_extract(link, r"[^/.](\.[^/.]+)\z", 1))
    safe = safe_name(F.coalesce(F.col("symbol"), F.lit("")))
    stem = F.when(safe.rlike(r"\A([_.]|\z)"), F.concat(F.lit("x"), safe)).otherwise(safe)  # Spark's readers pass over names that begin so
    own = rows.withColumn("status", status).withColumn("stem", stem).withColumn("ending", ending)
    clash = own.where("status = 'ok'").groupBy("stem", "ending").agg(F.min("symbol").alias("least"), F.countDistinct("symbol").alias("n")).where("n > 1").drop("n")
    clash = materialise(clash, workspace(rows.sparkSession, "clashes"))  # few, and Spark then knows: the documents don't move for it
    own = own.join(clash, ["stem", "ending"], "left")
    mark = F.when(F.col("least").isNull() | (F.col("symbol") == F.col("least")), "").otherwise(F.concat(F.lit("~"), F.lower(F.hex(F.crc32("symbol")))))
    file = F.when(F.col("status") == "ok", F.concat("stem", mark, "ending")).when(F.col("status") == "tiny", link).otherwise("")
    return own.select("symbol", "status", file.alias("file"), "data")


def write_documents(rows: DataFrame, folder: str) -> DataFrame:
    """Write the documents of ``rows`` (symbol, link, data) into ``folder`` and return the log: symbol, status and file of each.

    A file gets its name only when it is whole, so a lost attempt leaves none, and a repeated one writes the same again. Of rows
    of one symbol one counts, the one with the least data (null last); only these rows are shuffled for it. Documents go from the
    tasks that hold them; none passes through the driver. The log is written before it is returned, so the files are there.
    """
    spark, rows = rows.sparkSession, rows.select("symbol", "link", "data")
    several = rows.groupBy("symbol").count().where("count > 1").select(F.col("symbol").alias("several_"))
    several = materialise(several, workspace(spark, "several"))
    same = F.col("symbol").eqNullSafe(F.col("several_"))
    of = F.struct(F.col("data").isNull().alias("k"), "data", "link")
    least = rows.join(several, same, "left_semi").groupBy("symbol").agg(F.min_by(F.struct("link", "data"), of).alias("x")).select("symbol", "x.*")
    one = rows.join(several, same, "left_anti").unionByName(least)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        for b in batches:
            for status, name, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
                if status == "ok":
                    part = f"{base}/_{uuid.uuid4().hex}"  # Spark's readers pass over such names
                    with fs.open_output_stream(part) as f:
                        f.write(data.as_buffer())
                    fs.move(part, f"{base}/{name}")
            yield b.select([0, 1, 2])

    log = named(one).mapInArrow(put, OUTCOME)
    return materialise(log, workspace(rows.sparkSession, "outcomes"))


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """file, n_bytes, modified and data of a folder's documents; without data no file is opened."""
    rows = spark.read.format("binaryFile").load(folder)
    name = F.regexp_extract("path", r"([^/]+)\z", 1)
    return rows.select(name.alias("file"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified"), F.col("content").alias("data"))
