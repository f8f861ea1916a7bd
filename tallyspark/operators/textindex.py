"""An index of letter grams for searches inside texts: only the files of a search's own grams, and of its hits, are read.

Every row gets a number. For each field, gram (of one, two and three letters, lower-cased) and 64 rows there is one word of bits, the rows that hold
the gram. A search ANDs the words of its text's grams, which leaves the rows that may hold it, and asks these alone for the text
itself. Texts of one and two letters have a gram of their own size, so they need no scan either.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters of the longest grams.
SIZE = 3
#: Folders that grams are dealt to; bits of a row's number within a folder of rows.
SLOTS, FOLDER_BITS = 64, 20
_ROW = "row_number_"


def _grams(text: Column, size: int) -> Column:
    n = F.length(text) - size + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda k: F.substr(text, k, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def search_grams(text: Column) -> Column:
    """Those that a search needs: of SIZE letters, or the text itself if it is shorter."""
    return F.when(F.length(text) >= SIZE, F.array_distinct(_grams(text, SIZE))).when(text != "", F.array(text)).otherwise(F.array().cast("array<string>"))


def _held(texts: list[str], rows: np.ndarray, size: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The grams of one size in some rows' texts: the distinct ones, and of each gram and word of 64 rows the gram's place among
    them, the word and the rows' bits."""
    lengths = np.array([len(t) for t in texts], np.int64)
    letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    row, left = np.repeat(rows, lengths), np.repeat(np.cumsum(lengths), lengths) - np.arange(len(letters))
    at = np.flatnonzero(left >= size)
    code = np.zeros(len(at), np.int64)
    for k in range(size):
        code = code << 21 | letters[at + k]  # 21 bits a letter: SIZE of them fill a long
    codes, place = np.unique(code, return_inverse=True)
    words, word = np.unique(row[at] >> 6, return_inverse=True)
    key = place * len(words) + word
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    bits = np.left_shift(np.uint64(1), (row[at][order] & 63).astype(np.uint64))
    bits = np.bitwise_or.reduceat(bits, starts) if len(key) else bits
    grams = ["".join(chr(c >> 21 * k & 0x1FFFFF) for k in reversed(range(size))) for c in codes.tolist()]
    return grams, key[starts] // len(words) if len(key) else starts, words[key[starts] % len(words)] if len(key) else starts, bits.view(np.int64)


def gram_words(rows: DataFrame, fields: list[str]) -> DataFrame:
    """field, gram, word and bits of ``rows``' lower-cased texts, of each batch of rows by itself: several rows may have a word's bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number = b.column(0).to_numpy()
            for k, field in enumerate(fields, 1):
                texts = b.column(k).to_pylist()
                some = np.array([bool(t) for t in texts], bool)
                if not some.any():
                    continue
                texts = [t for t in texts if t]
                for size in range(1, SIZE + 1):
                    grams, place, word, bits = _held(texts, number[some], size)
                    if len(place):
                        own = pa.array(grams, pa.string()).take(pa.array(place))
                        yield pa.record_batch([pa.repeat(field, len(place)), own, pa.array(word, pa.int64()), pa.array(bits, pa.int64())], names=["field", "gram", "word", "bits"])

    lower = [F.lower(F.col(f"`{f}`")).alias(f"text_{k}") for k, f in enumerate(fields)]
    return rows.select(_ROW, *lower).mapInArrow(run, "field string, gram string, word long, bits long")


def _slot(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SLOTS)).cast("int")


class TextIndex:
    """An index that is written below a folder ``at`` (a URI that all executors see)."""

    def __init__(self, spark: SparkSession, at: str):
        self.spark, self.at = spark, at
        #: That of the rows, kept beside them as an index of no rows has no files to tell it.
        self.schema = T.StructType.fromJson(json.loads(spark.read.text(f"{at}/schema").first()[0]))

    @classmethod
    def build(cls, rows: DataFrame, fields: list[str], at: str) -> TextIndex:
        """Index the text columns ``fields`` of ``rows``. Null and empty texts have no grams; repeated rows stay rows of
        their own, and all columns are kept."""
        spark = rows.sparkSession
        number = F.monotonically_increasing_id()  # written at once, so it stays
        numbered = rows.withColumn(_ROW, number).withColumn("folder", F.shiftright(_ROW, FOLDER_BITS))
        numbered.write.mode("overwrite").partitionBy("folder").parquet(f"{at}/rows")
        spark.createDataFrame([(numbered.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{at}/schema")
        kept = spark.read.schema(numbered.schema).parquet(f"{at}/rows")
        words = gram_words(kept, fields).groupBy("field", "gram", "word").agg(F.bit_or("bits").alias("bits")).withColumn("slot", _slot(F.col("gram")))
        # by ranges, so a frequent gram's words spread over several tasks and files
        words.repartitionByRange("slot", "gram", "field", "word").sortWithinPartitions("slot", "gram", "field", "word").write.mode("overwrite").partitionBy("slot").parquet(f"{at}/words")
        return cls(spark, at)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.at}/rows")

    def words(self) -> DataFrame:
        return self.spark.read.schema("field string, gram string, word long, bits long, slot int").parquet(f"{self.at}/words")

    def _of_search(self, text: str) -> list[tuple[str, int]]:
        """The grams of a search (as many as it has letters, at most) and their slots."""
        lower = F.lower(F.lit(text))
        row = self.spark.range(1).select(F.transform(search_grams(lower), lambda g: F.struct(g.alias("gram"), _slot(g).alias("slot"))).alias("x")).first()
        return [(x.gram, x.slot) for x in row.x]

    def candidates(self, text: str, fields: list[str]) -> DataFrame:
        """row number and folder of the rows of which a field has all grams of the text."""
        grams = self._of_search(text)
        read = self.words().where(F.col("slot").isin(sorted({s for _, s in grams})) & F.col("gram").isin([g for g, _ in grams]) & F.col("field").isin(fields))
        both = read.groupBy("field", "word").agg(F.bit_and("bits").alias("bits"), F.count("*").alias("n")).where((F.col("n") == len(grams)) & (F.col("bits") != 0))
        some = both.groupBy("word").agg(F.bit_or("bits").alias("bits"))
        places = F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: F.getbit("bits", k) == 1), lambda k: F.shiftleft("word", 6) + k)
        return some.select(F.explode(places).alias(_ROW)).withColumn("folder", F.shiftright(_ROW, FOLDER_BITS))

    def search(self, text: str, fields: list[str]) -> DataFrame:
        """The rows of which one of ``fields`` holds the text, in any case. An empty text is held by every row with a text."""
        low, rows = F.lower(F.lit(text)), self.rows()
        holds = None
        for f in fields:
            one = F.coalesce(F.contains(F.lower(F.col(f"`{f}`")), low), F.lit(False))
            holds = one if holds is None else holds | one
        if text:
            rows = rows.join(self.candidates(text, fields), ["folder", _ROW], "left_semi")
        return rows.where(holds).drop(_ROW, "folder")
