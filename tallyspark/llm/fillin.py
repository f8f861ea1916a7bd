"""Fill-in-the-middle: every text cut into units (lines, say) and told again as prefix, suffix and middle.

Arrow-batched pandas UDFs: the regex library's ``finditer`` gives the units' end offsets, kept in one compact array
for each text, two look-ups in it slice the text, and hashlib makes the seeds (from the row's id alone, so every run
and every partitioning gives the same cuts) and the digests. No row meets another: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from array import array

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name, only

#: A line with its end, or a last line without one.
LINES = r"[^\n]*\n|[^\n]+"
#: Marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Seed, texts of a hundred that are told again, and of these the number that begin with the suffix.
SEED, RATE, SPM_RATE = 7, 100, 50

CUT = "n long, form string, prefix_chars long, middle_chars long, output string"


def _check(marks: tuple[str, str, str]) -> None:
    """Marks that could run into each other would make an output ambiguous."""
    for a in marks:
        for b in marks:
            if not a or (a in b and a != b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"marks may neither be empty nor overlap: {marks}")
    if len(set(marks)) < 3:
        raise ValueError(f"three different marks are needed: {marks}")


def unit_ends(text: str, unit: regex.Pattern) -> array:
    """End offsets (in code points) of the units, from left to right: eight bytes each, whatever the unit holds."""
    return array("q", (m.end() for m in unit.finditer(text)))


def draws(seed: int, name: str) -> tuple[int, int, int, int]:
    """Four numbers below 2 ** 32 from the seed and a row's name."""
    made = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return int(made[:8], 16), int(made[8:16], 16), int(made[16:24], 16), int(made[24:32], 16)


def told(text: str, name: str, unit: regex.Pattern, marks: tuple[str, str, str], seed: int, rate: int, spm_rate: int) -> tuple:
    """n, form, prefix_chars, middle_chars and output of one text."""
    ends = unit_ends(text, unit)
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, name)
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends[low - 1] if low else 0, ends[high - 1] if high else 0
    p, s, m = marks
    if h4 % 100 < spm_rate:
        return n, "spm", a, b - a, "".join((s, text[b:], p, text[:a], m, text[a:b]))
    return n, "psm", a, b - a, "".join((p, text[:a], s, text[b:], m, text[a:b]))


def rebuilt(output: str, form: str, marks: tuple[str, str, str] = MARKS) -> str:
    """The text that an output was made from."""
    if form == "plain":
        return output
    p, s, m = marks
    first, second = (s, p) if form == "spm" else (p, s)
    if not output.startswith(first):
        raise ValueError(f"an output of form {form} begins with {first}")
    one, mark, rest = output[len(first) :].partition(second)
    two, end, middle = rest.partition(m)
    if not mark or not end:
        raise ValueError(f"an output of form {form} has all of {marks}")
    return "".join((two, middle, one) if form == "spm" else (one, middle, two))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = LINES, marks: tuple[str, str, str] = MARKS, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (code points; null if plain) and output of every row.

    A null text counts as empty, and an empty text stays plain. A text that holds a mark stays plain, so every output can be
    taken apart again. A null id draws as the empty name; repeated rows get the same cuts and stay rows of their own; an
    empty table gives no rows; further columns don't matter. A text is worked on whole, however long.
    """
    _check(marks)
    regex.compile(unit)  # a wrong pattern is an error here, not in a task

    @F.pandas_udf(CUT)
    def cut(names: pd.Series, texts: pd.Series) -> pd.DataFrame:
        own = regex.compile(unit)
        rows = [told(t, x, own, marks, seed, rate, spm_rate) for x, t in zip(names, texts, strict=True)]
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    made = only(docs, doc_id=id_col, text=text_col).select("doc_id", cut(name, F.coalesce("text", F.lit(""))).alias("cut"))
    return made.select("doc_id", "cut.*")


def restore(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The texts again, from outputs and forms."""

    @F.pandas_udf("string")
    def back(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([rebuilt(o, f, marks) for o, f in zip(outputs, forms, strict=True)], dtype=object)

    return back(output, form)


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, in lower-case hexadecimal."""

    @F.pandas_udf("string")
    def sha(texts: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(t.encode()).hexdigest() for t in texts], dtype=object)

    return sha(text)


def rewrite(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the outputs in place of its texts (null texts stay null) and all its columns, for training."""
    _check(how.get("marks", MARKS))
    unit, marks, seed, rate, spm = (how.get(k, d) for k, d in (("unit", LINES), ("marks", MARKS), ("seed", SEED), ("rate", RATE), ("spm_rate", SPM_RATE)))

    @F.pandas_udf("string")
    def again(names: pd.Series, texts: pd.Series) -> pd.Series:
        own = regex.compile(unit)
        return pd.Series([told(t, x, own, marks, seed, rate, spm)[4] for x, t in zip(names, texts, strict=True)], dtype=object)

    made, text = free_name(docs, "told"), F.col(f"`{text_col}`")
    own = docs.withColumn(made, again(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.coalesce(text, F.lit(""))))
    return own.select(*[F.when(text.isNotNull(), F.col(f"`{made}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = LINES, marks: tuple[str, str, str] = MARKS, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """transform() with digests of every output and of the text rebuilt from it, in place of the outputs: they are made and taken
    apart again where they are, so no output travels."""
    _check(marks)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
    def cut(names: pd.Series, texts: pd.Series) -> pd.DataFrame:
        own, rows = regex.compile(unit), []
        for name, text in zip(names, texts, strict=True):
            n, form, prefix, middle, output = told(text, name, own, marks, seed, rate, spm_rate)
            rows.append((n, form, prefix, middle, sha(output), sha(rebuilt(output, form, marks))))
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])
        return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    made = only(docs, doc_id=id_col, text=text_col).select("doc_id", cut(name, F.coalesce("text", F.lit(""))).alias("cut"))
    return made.select("doc_id", "cut.*")
