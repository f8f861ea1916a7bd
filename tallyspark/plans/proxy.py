"""The order tables seen as a voting record: orders are resolutions, line items votes, suppliers' nations states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code():
    flag = F.col("l_returnflag")
    return F.when(F.col("l_quantity") == 50, ".").when(F.col("l_quantity") == 49, "").when(flag == "R", "Y").otherwise(flag)


def resolutions(spark: SparkSession, sf_dir: str, totals: bool = True) -> DataFrame:
    year = F.year("o_orderdate").cast("long")
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    vt = F.when(F.col("o_orderstatus") == "F", "V").when(F.col("o_orderstatus") == "O", "C").otherwise("WD")
    subject = F.concat("o_orderpriority", F.lit(" "), "c_mktsegment")
    res = o.select(
        F.col("o_orderkey").alias("record_id"),
        year.alias("year"),
        (year * 12 + F.month("o_orderdate")).alias("month"),
        F.when(year < 2000, "CHR").otherwise("HRC").alias("body"),
        vt.alias("vt"),
        subject.alias("subject"),
        (F.col("o_orderkey") % 4 == 0).alias("am"),
        F.concat(F.lit("Order of "), F.lower("c_mktsegment"), F.lit(" no. "), F.col("o_orderkey").cast("string")).alias("title"),
    )
    if not totals:
        return res
    flag = F.col("l_returnflag")
    t = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("record_id")).agg(
        F.count_if(flag == "R").alias("yes"),
        F.count_if(flag == "N").alias("no"),
        F.count_if(flag == "A").alias("abstain"),
        F.count("*").alias("n"),
    )
    recorded = F.col("vt") == "V"
    out = res.join(t, "record_id", "left")
    return out.select(
        *res.columns,
        *[F.when(recorded, F.col(c)).alias(c) for c in ("yes", "no", "abstain")],
        F.coalesce(F.when(recorded, F.col("n")), F.lit(0)).alias("n_rollcall"),
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.join(
        table(spark, sf_dir, "region"),
        F.col("n_regionkey") == F.col("r_regionkey"),
    ).select("s_suppkey", F.col("n_name").alias("state"), F.col("r_name").alias("grp"))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = resolutions(spark, sf_dir, False).where("vt = 'V'").select("record_id", "year", "month", "subject", "am")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("record_id"),
        "l_suppkey",
        F.col("l_linenumber").alias("pos"),
        F.col("l_partkey").alias("part"),
        _code().alias("code"),
    )
    return lines.join(res, "record_id").join(states(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")).drop("l_suppkey", "s_suppkey")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resolutions as text columns, with the gaps and endings that a catalogue has; pos is their order."""
    r, key = resolutions(spark, sf_dir), F.col("record_id")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    ending = F.when(key % 4 == 0, " : draft resolution / adopted by").when(key % 5 == 0, " : Amendment / x").otherwise("")
    kind = F.when(key % 17 == 0, "").when(F.col("vt") == "C", "ADOPTED WITHOUT VOTE").when(F.col("vt") == "V", "RECORDED").otherwise("WITHDRAWN")
    return r.select(
        key.cast("string").alias("record_id"), F.concat(F.lit("S/"), key.cast("string")).alias("symbol"), F.concat("title", ending).alias("title"),
        F.when(key % 6 == 0, " amendment to").otherwise("").alias("draft"), F.concat(text("year"), F.lit("-01-02 ")).alias("date"), F.when(key % 13 == 0, "").otherwise(text("year")).alias("year"),
        F.when(F.col("body") == "HRC", "The Council").otherwise("Commission").alias("body"), kind.alias("vote_type"), F.concat(F.lit(" "), "subject").alias("agenda_subject"),
        F.concat("subject", F.lit(" - ")).alias("agenda_item_title"), F.concat(F.lit("by "), F.col("month").cast("string"), F.lit(" ")).alias("main_sponsors"), F.lit("m").alias("meeting"),
        F.concat(F.lit("u/"), key.cast("string")).alias("url_resolution"), F.lit("").alias("url_draft"), text("yes").alias("yes"), text("no").alias("no"), F.when(key % 19 == 0, "").otherwise(text("abstain")).alias("abstain"),
        "n_rollcall", key.alias("pos"),
    )


def votes_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The votes as text columns: states by code and name; some without a code."""
    v, line = votes(spark, sf_dir), F.col("pos")
    code = F.when(line % 6 == 0, "").otherwise(F.col("state"))
    order = F.col("record_id") * 100_000_000 + line * 1_000_000 + F.col("part")
    return v.select(
        F.col("record_id").cast("string").alias("record_id"),
        code.alias("iso3"),
        F.concat(F.col("grp"), F.lit(" of "), F.col("state")).alias("country"),
        F.col("code").alias("vote"),
        F.col("year").cast("string").alias("year"),
        order.alias("pos"),
    )


#: The same views for the SQL versions.
SQL = """WITH res0 AS (
  SELECT o_orderkey AS record_id, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS month,
         CASE WHEN year(o_orderdate) < 2000 THEN 'CHR' ELSE 'HRC' END AS body,
         CASE o_orderstatus WHEN 'F' THEN 'V' WHEN 'O' THEN 'C' ELSE 'WD' END AS vt,
         o_orderpriority || ' ' || c_mktsegment AS subject, o_orderkey % 4 = 0 AS am,
         'Order of ' || lower(c_mktsegment) || ' no. ' || CAST(o_orderkey AS VARCHAR) AS title
  FROM orders JOIN customer ON o_custkey = c_custkey),
tot AS (SELECT l_orderkey AS record_id, count(*) FILTER (WHERE l_returnflag = 'R') AS yes, count(*) FILTER (WHERE l_returnflag = 'N') AS no,
         count(*) FILTER (WHERE l_returnflag = 'A') AS abstain, count(*) AS n FROM lineitem GROUP BY 1),
res AS (SELECT r.*, CASE WHEN vt = 'V' THEN yes END AS yes, CASE WHEN vt = 'V' THEN no END AS no, CASE WHEN vt = 'V' THEN abstain END AS abstain,
         coalesce(CASE WHEN vt = 'V' THEN n END, 0) AS n_rollcall FROM res0 r LEFT JOIN tot USING (record_id)),
states AS (SELECT s_suppkey, n_name AS state, r_name AS grp FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
votes AS (SELECT l_orderkey AS record_id, l_linenumber AS pos, l_partkey AS part, state, grp, year, month, subject, am,
         CASE WHEN l_quantity = 50 THEN '.' WHEN l_quantity = 49 THEN '' WHEN l_returnflag = 'R' THEN 'Y' ELSE l_returnflag END AS code
  FROM lineitem JOIN res0 ON l_orderkey = record_id AND vt = 'V' JOIN states ON l_suppkey = s_suppkey),
one AS (SELECT record_id, state, min(grp) AS grp, min(code) AS code, min(year) AS year, min(month) AS month, min(subject) AS subject
  FROM votes WHERE code IN ('Y', 'N', 'A') AND NOT am GROUP BY 1, 2),
pairs AS (SELECT a.state AS state_a, b.state AS state_b, count(*) AS shared, count(*) FILTER (WHERE a.code = b.code) AS same,
         round(count(*) FILTER (WHERE a.code = b.code) * 100.0::DOUBLE / count(*), 4) AS agreement_pct
  FROM one a JOIN one b ON a.record_id = b.record_id AND a.state < b.state GROUP BY 1, 2),
sym AS (SELECT state_a, state_b, shared, same, agreement_pct FROM pairs UNION ALL SELECT state_b, state_a, shared, same, agreement_pct FROM pairs),
tally AS (SELECT record_id, count(*) FILTER (WHERE code = 'Y') AS y, count(*) FILTER (WHERE code = 'N') AS n, count(*) FILTER (WHERE code = 'A') AS a FROM one GROUP BY 1),
cat AS (SELECT CAST(record_id AS VARCHAR) AS record_id, 'S/' || record_id AS symbol, title || CASE WHEN record_id % 4 = 0 THEN ' : draft resolution / adopted by' WHEN record_id % 5 = 0 THEN ' : Amendment / x' ELSE '' END AS title,
         CASE WHEN record_id % 6 = 0 THEN ' amendment to' ELSE '' END AS draft, year || '-01-02 ' AS date, CASE WHEN record_id % 13 = 0 THEN '' ELSE CAST(year AS VARCHAR) END AS year,
         CASE body WHEN 'HRC' THEN 'The Council' ELSE 'Commission' END AS body,
         CASE WHEN record_id % 17 = 0 THEN '' WHEN vt = 'C' THEN 'ADOPTED WITHOUT VOTE' WHEN vt = 'V' THEN 'RECORDED' ELSE 'WITHDRAWN' END AS vote_type, ' ' || subject AS agenda_subject,
         subject || ' - ' AS agenda_item_title, 'by ' || month || ' ' AS main_sponsors, 'm' AS meeting, 'u/' || record_id AS url_resolution, '' AS url_draft,
         coalesce(CAST(yes AS VARCHAR), '') AS yes, coalesce(CAST(no AS VARCHAR), '') AS no, CASE WHEN record_id % 19 = 0 THEN '' ELSE coalesce(CAST(abstain AS VARCHAR), '') END AS abstain, n_rollcall, record_id AS pos FROM res),
rec AS (SELECT *, CAST(row_number() OVER (ORDER BY pos) - 1 AS BIGINT) AS ri FROM cat WHERE n_rollcall > 0),
vl AS (SELECT CAST(record_id AS VARCHAR) AS record_id, CASE WHEN pos % 6 = 0 THEN '' ELSE state END AS iso3, grp || ' of ' || state AS country, code AS vote, CAST(year AS VARCHAR) AS year,
         record_id * 100000000 + pos * 1000000 + part AS pos FROM votes),
cast_ AS (SELECT vl.*, ri, TRY_CAST(nullif(rec.year, '') AS INT) AS res_year, CASE WHEN vote IN ('Y', 'N', 'A', '.') THEN vote ELSE '-' END AS code FROM vl JOIN rec USING (record_id) WHERE iso3 <> ''),
made AS (SELECT record_id AS id, symbol AS sym, title, TRY_CAST(nullif(year, '') AS INT) AS year, CASE WHEN contains(body, 'Council') THEN 'HRC' ELSE 'CHR' END AS body, trim(agenda_subject) AS subj, trim(date) AS date,
         rtrim(trim(agenda_item_title), ' -') AS item, trim(main_sponsors) AS spon, trim(meeting) AS mtg, trim(url_resolution) AS "urlR", trim(url_draft) AS "urlD",
         TRY_CAST(nullif(yes, '') AS INT) AS y, TRY_CAST(nullif(no, '') AS INT) AS n, TRY_CAST(nullif(abstain, '') AS INT) AS a,
         CASE WHEN regexp_matches(title, ':\\s*amendment', 'i') OR regexp_matches(draft, '^\\s*amendment', 'i') THEN 1 END AS am, ri FROM rec),
land AS (SELECT iso3, arg_max(country, (CAST(year AS INT), pos)) AS name, count(*) AS n, count(*) FILTER (WHERE code = 'Y') AS y, count(*) FILTER (WHERE code = 'N') AS no, count(*) FILTER (WHERE code = 'A') AS a,
         count(*) FILTER (WHERE code = '.') AS absent, count(*) FILTER (WHERE code = '-') AS blank, min(res_year) AS first, max(res_year) AS last FROM cast_ GROUP BY 1)
"""
