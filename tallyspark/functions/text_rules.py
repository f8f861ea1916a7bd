"""Scalar rules of the catalogue as column expressions. Missing values are empty strings, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How a resolution was adopted, and its short code.
MODE_CODES = {
    "ADOPTED WITHOUT VOTE": "C",
    "RECORDED": "V",
    "NON-RECORDED": "NR",
    "NON-RECORDED, adopted unanimously": "NRU",
    "WITHDRAWN": "WD",
    "NOT CONSIDERED": "NC",
    "NON-RECORDED, no voting information available": "NRX",
    "RECORDED, adopted at a closed meeting": "VC",
}


def filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def first_filled(*columns: Column) -> Column:
    """The first that isn't empty, or empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def is_number(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\A[0-9]+\z"), F.lit(False))


def number(c: Column) -> Column:
    """The integer of a string of digits, else null."""
    return F.when(is_number(c), c.try_cast("int"))


def iso_date(c: Column) -> Column:
    """Eight digits become year-month-day; anything else only loses white space at its ends."""
    return F.regexp_replace(strip(filled(c)), r"\A([0-9]{4})([0-9]{2})([0-9]{2})\z", "$1-$2-$3")


def year_text(date: Column) -> Column:
    return F.when(F.length(date) >= 4, F.substring(date, 1, 4)).otherwise("")


def body_code(c: Column) -> Column:
    return F.when(filled(c).contains("Council"), "HRC").otherwise("CHR")


def mode_code(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in MODE_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, filled(c)), F.lit("O"))


def trim_title(c: Column) -> Column:
    return strip(F.regexp_replace(strip(filled(c)), r"(?i)\s*:\s*(?:draft\s+)?(?:resolution|decision|amendment)s?\s*/[^\n]*\z", ""))


def is_amendment(title: Column, draft: Column) -> Column:
    return filled(title).rlike(r"(?i):\s*amendment") | filled(draft).rlike(r"(?i)\A\s*amendment")


def clean_item(c: Column) -> Column:
    return strip(F.regexp_replace(strip(filled(c)), r"[ -]+\z", ""))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def any_totals(yes: Column, no: Column, abstain: Column) -> Column:
    """Three numbers that aren't all zero; one that is missing means none."""
    return F.coalesce(yes + no + abstain > 0, F.lit(False))


def has_totals(yes: Column, no: Column, abstain: Column) -> Column:
    """Three numbers that aren't all zero; a number missing beside a numeric ``yes`` means no totals."""
    return any_totals(number(yes), number(no), number(abstain))


def vote_code(c: Column) -> Column:
    return F.when(c.isin("Y", "N", "A", "."), c).otherwise("-")


def title_case(c: Column) -> Column:
    """Every letter after a non-letter upper-case, every other lower-case."""
    runs = F.regexp_extract_all(F.lower(filled(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30))), "")


def repaired_iso(code: Column) -> Column:
    lead = F.regexp_extract(code, r"\A([A-Za-z]{2,3})", 1)
    broken = code.contains("$") | (F.length(code) > 3)
    return F.when(broken, F.when(lead != "", F.upper(lead)).otherwise(F.substring(code, 1, 3))).otherwise(code)


def recovered_name(code: Column, name: Column) -> Column:
    inside = F.regexp_extract(code, r"\$e(.+)\z", 1)
    return F.when((name == "") & (inside != ""), inside).otherwise(name)


def sponsors(notes: Column) -> Column:
    """What follows the label in the first note that has it."""
    label = r"(?i)\A\s*Main sponsors?\s*:\s*([^\n]+)"
    return filled(F.get(F.transform(F.filter(notes, lambda n: n.rlike(label)), lambda n: strip(F.regexp_extract(n, label, 1))), F.lit(0)))


def mirror_scope(symbol: Column, year: Column) -> Column:
    session = F.regexp_extract(symbol, r"\AA/HRC/(?:RES|DEC)/([0-9]+)/", 1)
    return (symbol.startswith("E/CN.4/") & F.coalesce(number(year).between(1993, 2005), F.lit(False))) | F.coalesce(number(session) <= 11, F.lit(False))


def safe_name(symbol: Column) -> Column:
    return F.regexp_replace(symbol, r"[^A-Za-z0-9._-]", "_")


def document_link(page: Column) -> Column:
    return F.regexp_extract(page, r'(?i)href="(E/[^"]+\.(?:doc|pdf))"', 1)
