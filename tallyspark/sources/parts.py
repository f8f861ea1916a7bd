"""One ordered text in parts: tasks write ranges of its rows as files, and a manifest says which files make the text, in order.

A file has a name of its own for each attempt, so of a task that ran twice one file counts. No task holds more than its
range, nothing is sorted in one task, and joining the files byte for byte gives the text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .folders import materialise, workspace

#: ``text``: what comes before the file, or in place of one. The kinds are those of the file's first and last row.
MANIFEST = "section int, part int, text string, file string, n_rows long, n_bytes long, first_kind int, last_kind int"
#: Kinds of rows: an item of the section's list, an item of a list inside that item, and anything that takes no comma.
ITEM, INNER, PLAIN = 0, 1, 2


def write_section(rows: DataFrame, order: list[str], folder: str, section: int, parts: int | None = None) -> DataFrame:
    """``rows``: kind, value and the columns of ``order``. Writes the values in that order; returns the section's manifest.

    Commas follow from the kinds: before every ITEM but the section's first, and before every INNER but those that follow an
    ITEM. Those at a part's beginning depend on the part before, and are set in the manifest.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n_rows, n_bytes, first, last = TaskContext.get().partitionId(), 0, 0, None, None
        fs, base = pafs.FileSystem.from_uri(folder)
        name, out = f"{section:02d}-{part:05d}-{uuid.uuid4().hex[:10]}", None
        for b in batches:
            if not b.num_rows:
                continue
            kind, value = b.column(0).to_numpy(), b.column(1)
            if value.null_count:
                raise ValueError("a row without a text")
            before = np.concatenate([[PLAIN if last is None else last], kind[:-1]])
            comma = (kind == ITEM) | (kind == INNER) & (before != ITEM)
            if last is None:
                first, comma[0] = int(kind[0]), False
            last = int(kind[-1])
            joined = pc.binary_join_element_wise(pc.if_else(pa.array(comma), ",", ""), value, "")
            # the texts lie one after another in the column's buffer
            ends = np.frombuffer(joined.buffers()[1], np.int32, len(joined) + 1, joined.offset * 4)
            raw = (joined.buffers()[2] or pa.py_buffer(b"")).slice(int(ends[0]), int(ends[-1] - ends[0]))
            if out is None:
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}")
            out.write(raw)
            n_rows, n_bytes = n_rows + b.num_rows, n_bytes + raw.size
        if out is not None:
            out.close()
            numbers = lambda *x: [pa.array([k], pa.int32()) for k in x]
            one = [*numbers(section, part), pa.array([""]), pa.array([name]), pa.array([n_rows], pa.int64()), pa.array([n_bytes], pa.int64()), *numbers(first, last)]
            yield pa.record_batch(one, names=["section", "part", "text", "file", "n_rows", "n_bytes", "first_kind", "last_kind"])

    ranged = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    made = ranged.sortWithinPartitions(*order).select("kind", "value").mapInArrow(put, MANIFEST)
    return materialise(made, workspace(rows.sparkSession, "manifest"))


def write_manifest(sections: list[DataFrame | str], folder: str) -> None:
    """``sections``: manifests of write_section() and fixed texts between them, in order. The manifest is written last: without it
    the files are nothing."""
    spark = next(s for s in sections if not isinstance(s, str)).sparkSession
    fixed = [(k, 0, s, None, 1, 0, None, None) for k, s in enumerate(sections) if isinstance(s, str)]
    made = spark.createDataFrame(fixed, MANIFEST)
    for s in sections:
        if not isinstance(s, str):
            made = made.unionByName(s)
    before = F.lag("last_kind").over(Window.partitionBy("section").orderBy("part"))  # a row for each file
    comma = (F.col("first_kind") == ITEM) & before.isNotNull() | (F.col("first_kind") == INNER) & (before != ITEM)
    made = made.withColumn("text", F.when(F.col("file").isNotNull() & comma, ",").otherwise(F.col("text")))
    made.coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").orderBy("section", "part")


def items(spark: SparkSession, folder: str, section: int, schema: str) -> DataFrame:
    """The JSON items of a section that is a plain list, read by its parts: place (from 0 in the section) and item."""
    listed = manifest(spark, folder).where((F.col("section") == section) & F.col("file").isNotNull())
    before = F.sum("n_rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each file
    listed = listed.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    names = [f"{folder}/{r.file}" for r in listed.select("file").collect()]
    if not names:
        return spark.createDataFrame([], f"place long, item {schema}")
    text = spark.read.text(names, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.concat(F.lit("["), "value", F.lit("]")).alias("list"))
    each = text.join(listed, "file").select("before", F.posexplode(F.from_json("list", f"array<{schema}>")).alias("k", "item"))
    return each.select((F.col("before") + F.col("k")).alias("place"), "item")


def read_parts(spark: SparkSession, folder: str) -> Iterator[bytes]:
    """The text in pieces of at most a MB, one after another; for whoever sends it on. Only names pass besides."""
    fs, base = pafs.FileSystem.from_uri(folder)
    for row in manifest(spark, folder).toLocalIterator():
        if row.text:
            yield row.text.encode()
        if row.file is None:
            continue
        with fs.open_input_stream(f"{base}/{row.file}") as f:
            while raw := f.read(1 << 20):
                yield raw


def join_parts(spark: SparkSession, folder: str, uri: str) -> int:
    """Write the text as one file, which gets its name when it is whole. Returns its bytes."""
    fs, path = pafs.FileSystem.from_uri(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    n, part = 0, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        for raw in read_parts(spark, folder):
            out.write(raw)
            n += len(raw)
    fs.move(part, path)
    return n
