"""MARCXML catalogues as typed tables: a nested read, resolutions and votes; identical records once."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text_rules as R

_SUB = T.StructType([T.StructField("_code", T.StringType()), T.StructField("_VALUE", T.StringType())])
_CONTROL = T.StructType([T.StructField("_tag", T.StringType()), T.StructField("_VALUE", T.StringType())])
_DATA = T.StructType([T.StructField("_tag", T.StringType()), T.StructField("subfield", T.ArrayType(_SUB))])
#: All text: inferred types would turn a record's number into an integer.
RECORD = T.StructType([T.StructField("controlfield", T.ArrayType(_CONTROL)), T.StructField("datafield", T.ArrayType(_DATA))])

#: MARCXML's namespace, and the catalogue's address of a record.
NAMESPACE = "http://www.loc.gov/MARC21/slim"
RECORD_URL = "https://searchlibrary.ohchr.org/record/"


def xml_rows(reader):
    """A (stream) reader of records one by one; a record that breaks off or isn't XML is an error."""
    return reader.format("xml").schema(RECORD).option("rowTag", "record").option("ignoreNamespace", "true").option("mode", "FAILFAST")


def located(rows: DataFrame) -> DataFrame:
    """A reader's rows with the file and the block that each is from."""
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.struct("controlfield", "datafield").alias("record"),
    )


def placed(located: DataFrame) -> DataFrame:
    """file, pos (its order within the file) and record."""
    return located.select("file", F.struct("block", F.monotonically_increasing_id().alias("row")).alias("pos"), "record")


#: Where a record that isn't XML is kept.
_DAMAGED = "damaged_text"


def checked(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, pos, record, damaged and text of every record of some files (as URIs, like ``inputFiles()``): a record that breaks off
    or isn't XML is a row with its text and no record, and ends its file's reading."""
    schema = T.StructType([*RECORD.fields, T.StructField(_DAMAGED, T.StringType())])
    reader = spark.read.format("xml").schema(schema).option("rowTag", "record").option("ignoreNamespace", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _DAMAGED)
    rows = reader.load([unquote(f) for f in files])
    pos = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    bad = F.col(_DAMAGED).isNotNull()
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        pos.alias("pos"),
        F.when(~bad, F.struct("controlfield", "datafield")).alias("record"),
        bad.alias("damaged"),
        F.col(_DAMAGED).alias("text"),
    )


def ends(spark: SparkSession, files: list[str]) -> DataFrame:
    """file and whole (true) of those of some files in which a collection ends."""
    end = F.max(F.col("value").rlike(r"</(?:\w+:)?collection\s*>|<(?:\w+:)?collection\b[^>]*/>"))
    return spark.read.text([unquote(f) for f in files]).groupBy(F.col("_metadata.file_path").alias("file")).agg(end.alias("whole")).where("whole")


def cut_off(spark: SparkSession, files: list[str]) -> list[str]:
    """Of some files (as URIs, like ``inputFiles()``) those, empty ones too, in which no collection ends: a reader of
    records doesn't miss what should come after the last one."""
    if not files:
        return []
    plain = lambda uri: unquote(urlparse(uri).path)
    done = {plain(r.file) for r in ends(spark, files).collect()}  # a name for each file, of which the caller has a list
    return sorted(f for f in files if plain(f) not in done)


def read(spark: SparkSession, path: str, whole: bool = True) -> DataFrame:
    """record, file and pos of every record. A malformed file is an error, and so is one that is cut off between two
    records if it must be ``whole`` (this reads the files' text once more)."""
    rows = xml_rows(spark.read).load(path)
    if whole and (cut := cut_off(spark, rows.inputFiles())):
        raise ValueError(f"no collection ends in {cut}")
    return placed(located(rows))


def from_text(rows: DataFrame, xml: str, file: Column, pos: Column) -> DataFrame:
    """The same shape from a column that holds one record's XML."""
    return rows.select(file.alias("file"), pos.alias("pos"), F.from_xml(F.col(xml), RECORD, {"rowTag": "record"}).alias("record"))


#: The field of a roll-call's votes: many times as many as of all others.
VOTE = "967"


def _fields(tag: str) -> Column:
    return F.col("rolls") if tag == VOTE else F.filter("others", lambda d: d["_tag"] == tag)


def _has(field: Column, code: str) -> Column:
    return F.exists(F.coalesce(field["subfield"], F.array().cast(T.ArrayType(_SUB))), lambda s: s["_code"] == code)


def _value(field: Column, code: str) -> Column:
    """The first value under a code; empty if there's none."""
    found = F.get(F.filter(field["subfield"], lambda s: s["_code"] == code), F.lit(0))
    return R.strip(R.filled(found["_VALUE"]))


def _first(tag: str, code: str) -> Column:
    """From the first field that has the code, even if its value is empty."""
    return R.filled(_value(F.get(F.filter(_fields(tag), lambda d: _has(d, code)), F.lit(0)), code))


def _of_first(tag: str, code: str) -> Column:
    """From the first field alone."""
    return R.filled(_value(F.get(_fields(tag), F.lit(0)), code))


def _link(wanted) -> Column:
    got = F.filter(
        F.transform(_fields("856"), lambda d: F.struct(F.lower(_value(d, "y")).alias("y"), _value(d, "u").alias("u"))),
        lambda x: wanted(x["y"]) & (x["u"] != ""),
    )
    return R.filled(F.get(got, F.lit(0))["u"])


def parse(records: DataFrame, *only: str) -> DataFrame:
    """A wide row for every record with an id; of records with one id the first by (file, pos). With ``only``, just these columns beside
    record_id: Spark can't see which fields of an aggregated row go unused, and would make and sort them all."""
    control = F.filter(F.col("record.controlfield"), lambda c: c["_tag"] == "001")
    wide = records.withColumn("record_id", R.strip(R.filled(F.try_element_at(control, F.lit(-1))["_VALUE"]))).where("record_id <> ''")
    # votes apart from the rest, so that the other columns look through a few fields only
    of = F.coalesce(F.col("record.datafield"), F.array().cast(T.ArrayType(_DATA)))
    wide = wide.select("record_id", "file", "pos", F.filter(of, lambda d: d["_tag"] == VOTE).alias("rolls"), F.filter(of, lambda d: d["_tag"] != VOTE).alias("others"))
    date = R.iso_date(R.first_filled(_first("269", "a"), _first("992", "a")))
    title = F.array_join(F.filter(F.array(_of_first("245", "a"), _of_first("245", "b")), lambda x: x != ""), " ")
    notes = F.transform(F.filter(_fields("500"), lambda d: _has(d, "a")), lambda d: _value(d, "a"))
    has = lambda y, what: y.contains(what)
    columns = {
        "symbol": _first("791", "a"), "title": title, "statement": _of_first("245", "c"), "date": date, "year": R.year_text(date),
        "body": _first("981", "a"), "collection": _first("980", "a"), "vote_type": _first("591", "a"), "meeting": _first("952", "a"), "meeting_type": _first("793", "v"),
        "agenda_item_no": _first("991", "b"), "agenda_item_title": _first("991", "c"), "agenda_symbol": _first("991", "a"), "agenda_subject": _first("991", "d"),
        "main_sponsors": R.sponsors(notes), "draft": R.first_filled(_first("993", "a"), _first("991", "a")),
        "yes": _of_first("996", "b"), "no": _of_first("996", "c"), "abstain": _of_first("996", "d"), "nonvoting": _of_first("996", "e"), "total": _of_first("996", "f"),
        "n_rollcall": F.size(_fields(VOTE)),
        "url_resolution": _link(lambda y: has(y, "resolution") & ~has(y, "draft")), "url_draft": _link(lambda y: has(y, "draft")),
        "record_url": F.concat(F.lit(RECORD_URL), "record_id"),
    }
    votes = F.transform(_fields(VOTE), lambda d: F.struct(_value(d, "a").alias("seq"), _value(d, "b").alias("b"), _value(d, "d").alias("d"), _value(d, "e").alias("e")))
    columns |= {"rollcall": votes, "file": F.col("file"), "pos": F.col("pos")}
    row = F.struct(*[c.alias(n) for n, c in columns.items() if not only or n in only])
    flat = wide.select("record_id", F.struct("file", "pos").alias("place"), row.alias("row"))
    return flat.groupBy("record_id").agg(F.min_by("row", "place").alias("row")).select("record_id", "row.*")


def resolutions(parsed: DataFrame) -> DataFrame:
    return parsed.drop("rollcall", "file", "pos")


def votes_long(parsed: DataFrame) -> DataFrame:
    """A row for every vote of a roll-call, with its record's columns (those of them that ``parsed`` has)."""
    own = [c for c in ("record_id", "symbol", "date", "year", "body", "vote_type") if c in parsed.columns]
    rows = parsed.select(*own, F.explode("rollcall").alias("v"))
    code = F.when(F.col("v.d") == "y", "Y").otherwise(F.col("v.d"))
    return rows.select(
        *own,
        F.col("v.seq").alias("seq"),
        R.repaired_iso(F.col("v.b")).alias("iso3"),
        R.recovered_name(F.col("v.b"), F.col("v.e")).alias("country"),
        code.alias("vote"),
    )


def merged(parts: list[DataFrame]) -> DataFrame:
    """Several reads (pages of one harvest, say) as one: parse() then keeps each record once."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: Records of a file at most: a reader can't divide a file, so these bound what a task reads.
PER_FILE = 50_000


#: A collection of no records, as Spark writes its collections.
_NO_RECORDS = f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<collection xmlns="{NAMESPACE}">\n</collection>\n'


def write(records: DataFrame, path: str, per_file: int | None = None) -> None:
    """The records as collections of MARCXML: each partition makes files of at most ``per_file`` (PER_FILE) records, in the order of their names.
    Every file is a whole collection, and there is one even if there are no records."""
    rows = records.select(F.col("record.controlfield").alias("controlfield"), F.col("record.datafield").alias("datafield"))
    rows.write.mode("overwrite").format("xml").option("maxRecordsPerFile", per_file or PER_FILE).option("rootTag", f'collection xmlns="{NAMESPACE}"').option("rowTag", "record").save(path)
    # a first partition without rows (a part of a file that no row group lies in, say) leaves a file of no bytes; others leave none
    spark = records.sparkSession
    first = spark._jvm.org.apache.hadoop.fs.Path(path, "part-00000-*")
    files = first.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(first) or []:
        if found.getLen() == 0:
            out = files.create(found.getPath(), True)
            out.write(_NO_RECORDS.encode())
            out.close()


def record_ids(text: DataFrame, column: str = "value") -> DataFrame:
    """Ids straight from the XML's text, without parsing it."""
    pattern = r'<controlfield tag="001">\s*([0-9]+)\s*</controlfield>'
    return text.select(F.explode(F.regexp_extract_all(F.col(column), F.lit(pattern), 1)).alias("record_id"))
