"""Folders that every executor sees, for tables that are written once and read more often."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The URI of the folder that ``spark.checkpoint.dir`` names; only where none is set and Spark runs on this machine
    alone (tests) a temporary one is made and set."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = at.get() if at.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tallyspark-")
        spark.sparkContext.setCheckpointDir(root)
    return root if urlparse(root).scheme else "file://" + root


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one; it goes when the driver ends in the usual way."""
    at = f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(remove, spark, at)
    return at


def remove(spark: SparkSession, at: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session may be gone; the folder then stays
        pass


def materialise(df: DataFrame, at: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, keeps sizes known."""
    df.write.mode("overwrite").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
