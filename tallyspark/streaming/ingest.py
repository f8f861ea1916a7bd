"""Resumable ingestion: new and changed files are read once, damaged ones are set aside and tried again when they change.

A ledger has a row for every file that a run tried. A run writes its records and what it set aside into folders of its own
and its ledger rows last; readers go by the ledger. So a run that fails leaves nothing that counts, its folders are written
over by the next one, and the good and the bad of a run come into being together.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import marc
from ..sources.folders import materialise, workspace

LOG = "symbol string, status string, file string"
#: ``reason``: why a file was set aside, null for a good one.
LEDGER = "path string, modified timestamp, n_bytes long, n_records long, reason string, run long"
ASIDE = "path string, reason string, pos struct<block long, row long>, text string, run long"
#: Files of one run: their names pass through the driver.
FILES = 1000


def listing(spark: SparkSession, source: str) -> DataFrame:
    """path, modified and n_bytes of the files of a folder or pattern. Nothing of their content is read. An empty file has no
    time, as Spark plans no read of it."""
    files = spark.read.format("binaryFile").load(source)
    full = files.select(F.col("_metadata.file_path").alias("path"), F.col("modificationTime").alias("modified"), F.col("length").alias("n_bytes"))
    # which Spark's own listing holds already; a local file's URI is written there with an empty host
    names = spark.createDataFrame([(re.sub(r"\Afile:///", "file:/", f),) for f in files.inputFiles()], "path string")
    return names.join(full, "path", "left").select("path", "modified", F.coalesce("n_bytes", F.lit(0).cast("long")).alias("n_bytes"))


def _runs(spark: SparkSession, at: str, schema: str) -> DataFrame:
    """What all runs wrote into a folder, or nothing before the first."""
    where = spark._jvm.org.apache.hadoop.fs.Path(at)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(at)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    return _runs(spark, f"{target}/ledger", LEDGER)


def _latest(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("path").orderBy(F.desc("run"))  # a row for each time a file changed
    return rows.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")


def ingested(spark: SparkSession, target: str) -> DataFrame:
    """file, pos and record of every file's last good reading."""
    schema = f"file string, pos struct<block long, row long>, record {marc.RECORD.simpleString()}, run long"
    good = _latest(ledger(spark, target).where("reason is null")).select(F.col("path").alias("file"), "run")
    return _runs(spark, f"{target}/records", schema).join(good, ["file", "run"], "left_semi").drop("run")


def set_aside(spark: SparkSession, target: str) -> DataFrame:
    """path and reason of the files whose last reading failed, with the place and text of each damaged record found (none
    where a file merely breaks off)."""
    bad = _latest(ledger(spark, target)).where("reason is not null").select("path", "reason", "run")
    found = _runs(spark, f"{target}/aside", ASIDE).select("path", "run", "pos", "text")
    return bad.join(found, ["path", "run"], "left").select("path", "reason", "pos", "text")


def _one_run(spark: SparkSession, files: DataFrame, names: list[str], target: str, run: int) -> None:
    at = workspace(spark, "run")
    rows = materialise(marc.checked(spark, names), f"{at}/rows")
    ends = marc.ends(spark, names)
    found = rows.groupBy("file").agg(F.count_if("damaged").alias("damaged"), F.count_if(~F.col("damaged")).alias("n_records"))
    reason = F.when(F.col("n_bytes") == 0, "empty").when(F.col("damaged") > 0, "a malformed record").when(F.col("whole").isNull(), "no collection ends")
    tried = files.join(found.withColumnRenamed("file", "path"), "path", "left").join(ends.withColumnRenamed("file", "path"), "path", "left")
    tried = tried.select(
        "path",
        "modified",
        "n_bytes",
        F.coalesce("n_records", F.lit(0).cast("long")).alias("n_records"),
        reason.alias("reason"),
        F.lit(run).cast("long").alias("run"),
    )
    tried = materialise(tried, f"{at}/tried")  # FILES rows at most
    own = rows.join(F.broadcast(tried.select(F.col("path").alias("file"), "reason", "run")), "file")
    own.where("reason is null").select("file", "pos", "record", "run").write.mode("overwrite").parquet(f"{target}/records/part={run}")
    own.where("reason is not null and damaged").select(
        F.col("file").alias("path"),
        "reason",
        "pos",
        "text",
        "run",
    ).write.mode("overwrite").parquet(f"{target}/aside/part={run}")
    tried.write.mode("overwrite").parquet(f"{target}/ledger/part={run}")


def ingest_new(spark: SparkSession, source: str, target: str, files: int = FILES) -> int:
    """Read the files of ``source`` that are new, or that have changed (by time or size) since they were last tried, in
    runs of at most ``files``. Returns the number of runs.

    A file is good if all its records are well-formed and a collection ends in it; then its records replace those of an
    earlier reading. Otherwise the whole file is set aside with the reason, its earlier records stay, and the other files go on.
    """
    for runs in range(1 << 30):
        seen = ledger(spark, target)
        same = (F.col("now.path") == F.col("seen.path")) & F.col("now.modified").eqNullSafe(F.col("seen.modified")) & (F.col("now.n_bytes") == F.col("seen.n_bytes"))
        todo = listing(spark, source).alias("now").join(_latest(seen).alias("seen"), same, "left_anti").orderBy("path").limit(files)
        todo = materialise(todo, workspace(spark, "todo"))
        names = [r.path for r in todo.select("path").collect()]
        if not names:
            return runs
        _one_run(spark, todo, names, target, (seen.agg(F.max("run")).first()[0] or 0) + 1)
    return runs


def still_to_do(items: DataFrame, log: DataFrame) -> DataFrame:
    """Symbols without a final status: errors are tried again."""
    final = log.where(~F.col("status").startswith("error")).select("symbol").distinct()
    return items.join(final, "symbol", "left_anti")


def to_fetch(partitions: DataFrame, fetched: DataFrame, least_bytes: int = 200, forced: tuple[str, ...] = (), page: int = 200) -> DataFrame:
    """``partitions``: name. ``fetched``: name, n_bytes, n_records. The names that have to be fetched (again): those
    without a file of more than ``least_bytes``, and of the ``forced`` ones those with no more than one page of records."""
    done = fetched.where(F.col("n_bytes") > least_bytes).where(~(F.col("name").isin(list(forced)) & (F.col("n_records") <= page)))
    return partitions.select("name").distinct().join(done.select("name").distinct(), "name", "left_anti")


def store_years(rows: DataFrame, target: str, year: str = "year") -> None:
    """Write rows below ``target`` with a folder for each year. Only the folders of years that occur in ``rows`` are replaced, all
    of them at the end of the job: a run that fails changes nothing, and one that is repeated gives the same."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(target)


def stored_years(spark: SparkSession, target: str) -> DataFrame:
    """name, n_bytes and n_records of every year's folder; no column but the year is read."""
    name = F.regexp_extract("path", r"/([^/=]+)=([^/]+)/[^/]*$", 2)
    sizes = listing(spark, f"{target}/*/*.parquet").groupBy(name.alias("name")).agg(F.sum("n_bytes").alias("n_bytes"))
    rows = spark.read.parquet(target).groupBy(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/=]+)=([^/]+)/[^/]*$", 2).alias("name")).agg(F.count("*").alias("n_records"))
    return sizes.join(rows, "name", "left").fillna(0, ["n_records"])


def fetch_again(fetched: DataFrame, target: str, years: DataFrame, forced: tuple[str, ...] = (), page: int = 200, least_bytes: int = 200, year: str = "year") -> DataFrame:
    """Replace the years that to_fetch() names by the rows of ``fetched``. ``years``: name, all that there should be. Returns the
    names. A year that ``fetched`` has no rows of stays as it is."""
    spark = fetched.sparkSession
    names = materialise(to_fetch(years, stored_years(spark, target), least_bytes, forced, page), workspace(spark, "forced"))
    own = fetched.join(names.withColumnRenamed("name", "name_"), F.col(year).cast("string") == F.col("name_"), "left_semi")
    store_years(materialise(own, workspace(spark, "fetched")), target, year)
    return names


def undated(rows: DataFrame, year: str = "year") -> DataFrame:
    """The complement of all years: rows whose year isn't a number from 1000 to 2100."""
    text = F.coalesce(F.col(year).cast("string"), F.lit(""))
    return rows.where(~F.coalesce(text.rlike(r"\A[0-9]{4}\z") & text.try_cast("int").between(1000, 2100), F.lit(False)))


def harvest_summary(dated: DataFrame, without_date: DataFrame, pages: DataFrame) -> DataFrame:
    """Each: record_id. One row: rows and distinct ids of the dated harvest, undated ids, ids of both, ids of all
    three, and ids that only the pages have."""
    of = lambda df, name: df.select("record_id", F.lit(name).alias("of"))
    ids = of(dated, "d").unionByName(of(without_date, "u")).unionByName(of(pages, "p")).where("record_id is not null")
    has = lambda name: F.max(F.col("of") == name).alias(name)
    each = ids.groupBy("record_id").agg(F.count_if(F.col("of") == "d").alias("n"), has("d"), has("u"), has("p"))
    return each.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count_if("d").alias("ids"),
        F.count_if("u").alias("undated"),
        F.count_if(F.col("d") | F.col("u")).alias("dated_or_undated"),
        F.count("*").alias("combined"),
        F.count_if(F.col("p") & ~F.col("d") & ~F.col("u")).alias("missed"),
    )


def append_log(rows: DataFrame, path: str) -> None:
    rows.select("symbol", "status", "file").write.mode("append").csv(path)


def outcome(size, link):
    """What became of a fetched document: missing without a link, tiny under 500 bytes, else ok."""
    return F.when(link == "", "missing").when(size < 500, "tiny").otherwise("ok")


def progress(log: DataFrame) -> DataFrame:
    kind = F.when(F.col("status") == "ok", "ok").when(F.col("status").isin("missing", "tiny"), "missing").otherwise("error")
    return log.groupBy(kind.alias("outcome")).agg(F.count("*").alias("n"))
