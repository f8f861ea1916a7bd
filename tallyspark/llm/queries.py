"""The operators' queries over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, divergence, fillin, ftrl, langid, licenses, linedup, packing, quality_rules, repair, simhash, tokencount, warc
from .shared import table


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.round_trip(table(spark, sf_dir, "documents"))


def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document: lines, lines taken out, and the digest of the text that is left."""
    out = linedup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), counts=("n_lines", "n_removed"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("text_sha256"))


def op5_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), shingle=3, bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op7_grouping_ga(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


def op9_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = ftrl.fit(docs, table(spark, sf_dir, "labels"), ~ftrl.held_out())
    scored = ftrl.score(docs, weights)
    return scored.select("doc_id", ftrl.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fillin.report(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs, langid.learnable()))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def queries() -> dict:
    made = (op1_warc_salvage, op2_suffix_decontamination, op3_repair_ids, op4_line_spread, op5_simhash_vptree, op6_license_scan, op7_grouping_ga, op8_token_counts, op9_ftrl_quality, op10_mcd_outliers, op11_fill_in_middle, op12_source_divergence, op13_centroid_language)
    return {f.__name__: f for f in made}


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest FROM p),
h AS (SELECT payload_digest, max(page_id) AS holder FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN holder IS NOT NULL AND holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM d LEFT JOIN h USING (payload_digest)
"""

_OP2 = f"""
WITH b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS key FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
sizes AS (SELECT DISTINCT n FROM windows),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS key FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
found AS (SELECT doc_id, item_id, g.n, i FROM grams g JOIN windows USING (n, key)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP4 = f"""
WITH l AS (SELECT doc_id, coalesce('=' || source, '-') AS site, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
b AS (SELECT line, min(doc_id) AS first_id FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY line HAVING count(DISTINCT site) >= {linedup.MIN_SITES}),
k AS (SELECT doc_id, pos, l.line, b.line IS NULL OR doc_id = first_id AS stays FROM l LEFT JOIN b USING (line)),
t AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_removed, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays) AS kept FROM k GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS text_sha256
FROM documents LEFT JOIN t USING (doc_id)
"""

_TERMS = _WORDS.replace(r"\x2F\x3A-\x60", r"\x40\x5B-\x60")
_OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= {divergence.MIN_DOCS}),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n, kept.n AS in_lang FROM g JOIN kept ON g.lang = kept.lang
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
s AS (SELECT lang, source, sum(n) AS size FROM c GROUP BY lang, source),
p AS (SELECT c.lang, c.source, c.term, c.n, 1 + 1000000000::HUGEINT * (c.n + 2) // (size + 2 * v)::HUGEINT AS p, 1 + 1000000000::HUGEINT * (in_lang + 2) // (total + 2 * v)::HUGEINT AS q
      FROM c JOIN s ON c.lang = s.lang AND c.source = s.source JOIN l ON c.lang = l.lang),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= {divergence.TOP}
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_warc_salvage": _OP1, "op2_suffix_decontamination": _OP2, "op4_line_spread": _OP4, "op12_source_divergence": _OP12}
