"""Places and tables that every executor sees, and small helpers the operators share.

Intermediate results that are read more than once are written as tables below the
folder named by ``spark.checkpoint.dir``, so losing an executor loses no result.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.folders import materialise, remove, shared_root, workspace  # noqa: F401  for the operators


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store behind a URI and the path in it; also used inside executors."""
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, name: str, data: bytes) -> str:
    """Write a whole file under a name no other attempt uses; a lost attempt leaves an unlisted file."""
    fs, base = filesystem(uri)
    fs.create_dir(base, recursive=True)
    unique = f"{name}-{uuid.uuid4().hex[:10]}"
    with fs.open_output_stream(f"{base}/{unique}") as out:
        out.write(data)
    return f"{uri}/{unique}"


def read_file(uri: str) -> bytes:
    fs, path = filesystem(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


def trim() -> None:
    """Give a worker's freed memory back to the system, where the C library can: large arrays come and go in it."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns alone, under the operators' own names: extra or clashing columns never matter."""
    return df.select(*[F.col(f"`{c}`").alias(own) for own, c in columns.items()])


def text_key(text: Column) -> Column:
    """What tells the texts of one id apart; null for a null text."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def one_of_each(docs: DataFrame, id_col: str, text_col: str, members: DataFrame) -> DataFrame:
    """``members``: doc_id, text_key and root of every row of ``docs``. Of each root one row of ``docs``: the least by id (null
    last) and text_key; of rows that are equal in both one."""
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("text_key").alias("c"))
    row = lambda i, k: F.concat(F.coalesce(k.cast("string"), F.lit("")), F.coalesce(F.concat(F.lit("="), i.cast("string")), F.lit("-")))
    name = free_name(docs, "row_name")  # one name for the join and for what is left, so texts move once
    kept = members.groupBy("root").agg(F.min(order).alias("k")).select(row(F.col("k.b"), F.col("k.c")).alias(name)).distinct()
    own = docs.withColumn(name, row(F.col(f"`{id_col}`"), text_key(F.col(f"`{text_col}`"))))
    return own.join(kept, name, "left_semi").dropDuplicates([name]).select(*[F.col(f"`{c}`") for c in docs.columns])


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` hasn't got."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
