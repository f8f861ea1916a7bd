"""Harvested pages: a data source whose partitions are the pages of a query, and the records that count among them.

A folder holds for each query (a year, say) its pages of MARCXML, ``<query>/<first>.xml``, where first is the number of a page's
first record: 1, 201, 401, ... A query is read up to its first page that isn't full, or up to a bound past which
something is wrong with it: that is told, not hidden.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .marc import RECORD

#: Records of a full page, and the number of a first record up to which pages are asked for.
PAGE, GUARD = 200, 4000
SCHEMA = "query string, first long, n long, xml string"
_ID = re.compile(rb'<controlfield tag="001">\s*[0-9]+\s*</controlfield>')


class Page(InputPartition):
    def __init__(self, query: str, first: int, path: str):
        super().__init__(None)
        self.query, self.first, self.path = query, first, path


class PageReader(DataSourceReader):
    """Pages of a folder, one to a partition. Only names are listed to plan them."""

    def __init__(self, folder: str, page: int, guard: int):
        self.folder, self.page, self.guard = folder, page, guard

    def partitions(self) -> list[Page]:
        fs, base = pafs.FileSystem.from_uri(self.folder)
        found = []
        for x in fs.get_file_info(pafs.FileSelector(base, recursive=True, allow_not_found=True)):
            m = re.fullmatch(r"([^/]+)/([0-9]{1,18})\.xml", x.path[len(base) :].lstrip("/"))
            if m and x.type == pafs.FileType.File and (int(m[2]) - 1) % self.page == 0 and int(m[2]) <= self.guard:
                found.append(Page(unquote(m[1]), int(m[2]), x.path))
        return sorted(found, key=lambda p: (p.query, p.first)) or [Page("", 0, "")]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = pafs.FileSystem.from_uri(self.folder)
        with fs.open_input_stream(partition.path) as f:
            raw = f.read()
        columns = [pa.array([partition.query]), pa.array([partition.first], pa.int64()), pa.array([len(_ID.findall(raw))], pa.int64()), pa.array([raw.decode()])]
        yield pa.record_batch(columns, names=["query", "first", "n", "xml"])


class Pages(DataSource):
    """``spark.read.format("marc_pages").load(folder)``; options ``page`` and ``guard``."""

    @classmethod
    def name(cls) -> str:
        return "marc_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["path"], int(self.options.get("page", PAGE)), int(self.options.get("guard", GUARD)))


def read_pages(spark: SparkSession, folder: str, page: int = PAGE, guard: int = GUARD) -> DataFrame:
    """query, first, n (records), xml, and capped: pages in order up to the first that is missing or isn't full, of every query.
    capped marks the rows of a query of which even the last page that may be asked for is full."""
    spark.dataSource.register(Pages)
    rows = spark.read.format("marc_pages").option("page", page).option("guard", guard).load(folder)
    # a query has guard / page pages at most
    before = Window.partitionBy("query").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum((F.col("n") >= page).cast("long")).over(before), F.lit(0))
    kept = rows.withColumn("full", full).where(F.col("full") * page == F.col("first") - 1).drop("full")
    whole = Window.partitionBy("query")
    return kept.withColumn("capped", F.sum("n").over(whole) >= -(-guard // page) * page)


def records(pages: DataFrame) -> DataFrame:
    """file (the query), pos (page and place in it) and record of every page's records, as marc.read() gives those of files."""
    body = F.regexp_extract_all("xml", F.lit(r"(?s)(<record\b.*?</record>)"), 1)
    each = pages.select(F.col("query").alias("file"), "first", F.posexplode(body).alias("k", "xml"))
    return each.select(
        "file",
        F.struct(F.col("first").alias("block"), F.col("k").cast("long").alias("row")).alias("pos"),
        F.from_xml("xml", RECORD, {"rowTag": "record"}).alias("record"),
    )


def summary(pages: DataFrame) -> DataFrame:
    """query, pages, records and capped of every query."""
    return pages.groupBy("query").agg(F.count("*").alias("pages"), F.sum("n").alias("records"), F.max("capped").alias("capped"))


def write_pages(rows: DataFrame, folder: str, page: int = PAGE) -> DataFrame:
    """``rows``: query, k (a record's number within its query, from 0) and xml (of one record). Writes them as pages and returns query,
    first and n of each. A page is one task's file; a repeated task writes the same file again."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        at, body = None, []

        def close() -> pa.RecordBatch:
            query, first = at
            own = f"{base}/{quote(query, safe='')}"
            fs.create_dir(own, recursive=True)
            text = '<?xml version="1.0" encoding="UTF-8"?>\n<collection xmlns="http://www.loc.gov/MARC21/slim">\n' + "\n".join(body) + "\n</collection>\n"
            with fs.open_output_stream(f"{own}/.{first}.part") as f:
                f.write(text.encode())
            fs.move(f"{own}/.{first}.part", f"{own}/{first}.xml")
            return pa.record_batch([pa.array([query]), pa.array([first], pa.int64()), pa.array([len(body)], pa.int64())], names=["query", "first", "n"])

        for b in batches:
            for *page_, xml in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if page_ != at:
                    if body:
                        yield close()
                    at, body = page_, []
                body.append(xml)
        if body:
            yield close()

    first = (F.floor(F.col("k") / page) * page + 1).cast("long").alias("first")
    # record by record in order, so a worker holds one page and not a batch of them
    dealt = rows.select("query", first, "k", "xml").repartition("query", "first").sortWithinPartitions("query", "first", "k", "xml")
    return dealt.select("query", "first", "xml").mapInArrow(put, "query string, first long, n long")
