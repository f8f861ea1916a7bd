"""All queries of the library by name, and their SQL over the same tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text_rules as R
from ..operators import bits, exports, geo, sets
from ..operators import catalog as C
from ..operators import payload as PL
from ..operators import votes as V
from ..operators.naming import held
from ..operators.textindex import TextIndex
from ..sources import documents, files, layout, marc, pages, parts
from ..sources.folders import workspace
from ..streaming import ingest, logstate
from . import proxy as P

_Q: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None, prelude: bool = True):
    def put(f):
        _Q[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = (P.SQL if prelude else "") + sql
        return f

    return put


def _one(s: SparkSession, d: str) -> DataFrame:
    return V.one_vote(P.votes(s, d).where("not am"))


def _chamber(s: SparkSession, d: str) -> DataFrame:
    return P.votes(s, d).where("not am")


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return V.agreement_pairs(_chamber(s, d))


def _states_voting(s: SparkSession, d: str) -> DataFrame:
    return _chamber(s, d).where(F.col("code").isin(*V.VALID)).select("state")


def _res(s: SparkSession, d: str) -> DataFrame:
    return C.scoped(P.resolutions(s, d))


@_query("SELECT * FROM pairs")
def agreement_pairs(s, d):
    return _pairs(s, d)


@_query("""
SELECT state_a, state_b, agreement_pct, rank
FROM (SELECT *,
       CAST(row_number() OVER (PARTITION BY state_a
ORDER BY agreement_pct DESC, state_b) AS BIGINT) AS rank
FROM sym)
WHERE rank <= 5
""")
def partners_closest(s, d):
    return V.partners(_pairs(s, d), 5, True)


@_query("""
SELECT state_a, state_b, agreement_pct, rank
FROM (SELECT *,
       CAST(row_number() OVER (PARTITION BY state_a
ORDER BY agreement_pct, state_b) AS BIGINT) AS rank
FROM sym)
WHERE rank <= 5
""")
def partners_furthest(s, d):
    return V.partners(_pairs(s, d), 5, False)


@_query("SELECT state_a, state_b, agreement_pct FROM sym UNION ALL SELECT DISTINCT state, state, 100.0::DOUBLE FROM one")
def coincidence_matrix(s, d):
    return V.coincidence_matrix(_pairs(s, d), _states_voting(s, d))


@_query("""
SELECT state_a AS state,
       max(agreement_pct) FILTER (WHERE state_b = 'NATION_1') AS x,
       max(agreement_pct) FILTER (WHERE state_b = 'NATION_2') AS y,
       min(shared) AS shared_votes
FROM sym
WHERE state_b IN ('NATION_1', 'NATION_2') AND state_a NOT IN ('NATION_1', 'NATION_2')
GROUP BY 1
HAVING count(*) = 2
""")
def alignment_map(s, d):
    return V.alignment_map(_pairs(s, d), "NATION_1", "NATION_2")


@_query("""
SELECT grp,
       round(avg((m - (t - m) / 2) / t), 6) AS agreement_index,
       count(*) AS resolutions
FROM (SELECT grp, record_id,
       CAST(greatest(y, n, a) AS DOUBLE) AS m, y + n + a AS t
FROM (SELECT grp, record_id,
       count(*) FILTER (WHERE code = 'Y') AS y,
       count(*) FILTER (WHERE code = 'N') AS n,
       count(*) FILTER (WHERE code = 'A') AS a
FROM one
GROUP BY 1, 2))
WHERE t >= 2
GROUP BY 1
""")
def cohesion_ai(s, d):
    return V.cohesion(_one(s, d))


@_query("""
SELECT state,
       round(count(*) FILTER (WHERE code <> won) * 100.0::DOUBLE / count(*), 4) AS minority_side_pct,
       count(*) AS votes
FROM one
JOIN (SELECT record_id,
       CASE WHEN y > n AND y > a THEN 'Y' WHEN n > y AND n > a THEN 'N' WHEN a > y AND a > n THEN 'A' END AS won
FROM tally) USING (record_id)
WHERE won IS NOT NULL
GROUP BY 1
""")
def outvoted(s, d):
    return V.outvoted(_one(s, d))


@_query("""
SELECT state, year,
       count(*) FILTER (WHERE code = 'Y') AS yes,
       count(*) FILTER (WHERE code = 'N') AS no,
       count(*) FILTER (WHERE code = 'A') AS abstain,
       round(count(*) FILTER (WHERE code = 'Y') * 100.0::DOUBLE / count(*), 4) AS yes_pct
FROM one
GROUP BY 1, 2
""")
def composition_by_year(s, d):
    return V.composition(_one(s, d))


@_query("""
SELECT state, before, period AS after
FROM (SELECT state, period, lag(period) OVER (PARTITION BY state
ORDER BY period) AS before
FROM (SELECT DISTINCT state, month AS period
FROM one))
WHERE period - before > 1
""")
def membership_gaps(s, d):
    return V.membership_gaps(_one(s, d), "month")


@_query("SELECT year, body, count(*) AS n FROM res WHERE NOT am GROUP BY 1, 2")
def volume_by_year(s, d):
    return C.volume_by_year(_res(s, d))


_MARGIN = "(SELECT record_id, round(abs(yes - no) / CAST(yes + no + abstain AS DOUBLE), 6) AS margin FROM res WHERE NOT am AND yes + no + abstain > 0)"


@_query(f"SELECT CAST(least(floor(margin * 10), 9) AS BIGINT) AS bin, count(*) AS n FROM {_MARGIN} GROUP BY 1")
def margin_hist(s, d):
    return C.margin_histogram(_res(s, d))


@_query(f"SELECT record_id, margin FROM {_MARGIN} ORDER BY margin, record_id LIMIT 20")
def most_divided(s, d):
    return C.most_divided(_res(s, d), 20)


@_query("""
SELECT subject, year,
       round(avg(yes * 100.0::DOUBLE / (yes + no + abstain)), 4) AS avg_yes_share_pct,
       count(*) AS n
FROM res
WHERE NOT am AND yes + no + abstain > 0
GROUP BY 1, 2
""")
def topic_trend(s, d):
    return C.topic_trend(_res(s, d))


@_query("""
SELECT subject,
       round(regr_slope(yes * 100.0::DOUBLE / (yes + no + abstain),
       CAST(year AS DOUBLE)) * 10, 4) AS slope_pp_decade
FROM res
WHERE NOT am AND yes + no + abstain > 0
GROUP BY 1
""")
def topic_slope(s, d):
    return C.topic_slope(_res(s, d))


_SHARE = "round(count(*) FILTER (WHERE code = '{}') * 100.0::DOUBLE / count(*), 4) AS {}_pct"
_SHARES = ", ".join(_SHARE.format(c, name) for c, name in (("Y", "yes"), ("N", "no"), ("A", "abstain"))) + ", count(*) AS votes"


@_query(f"SELECT subject, state, {_SHARES} FROM one GROUP BY 1, 2")
def topic_by_state(s, d):
    return V.by_topic(_one(s, d), "state")


@_query(f"SELECT subject, grp, {_SHARES} FROM one GROUP BY 1, 2")
def topic_by_group(s, d):
    return V.by_topic(_one(s, d), "grp")


@_query("""
SELECT year,
       round(count(*) FILTER (WHERE vt = 'C') * 100.0::DOUBLE / count(*), 4) AS consensus_share_pct,
       count(*) AS n
FROM res0
WHERE NOT am
GROUP BY 1
""")
def consensus_by_year(s, d):
    return C.consensus_by_year(C.scoped(P.resolutions(s, d, False)))


@_query("""
SELECT year, vt,
       count(*) AS n,
       round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY year), 4) AS share_pct
FROM res0
WHERE NOT am
GROUP BY 1, 2
""")
def mode_stack(s, d):
    return C.mode_stack(C.scoped(P.resolutions(s, d, False)))


@_query("""
, m AS (SELECT (min(year) + max(year) + 1) // 2 AS y
FROM res0
WHERE NOT am) SELECT subject, n_early, n_late,
       round(c_late * 100.0::DOUBLE / n_late - c_early * 100.0::DOUBLE / n_early, 4) AS delta_pp
FROM (SELECT subject,
       count(*) FILTER (WHERE year < y) AS n_early,
       count(*) FILTER (WHERE year >= y) AS n_late,
       count(*) FILTER (WHERE year < y AND vt = 'C') AS c_early,
       count(*) FILTER (WHERE year >= y AND vt = 'C') AS c_late
FROM res0, m
WHERE NOT am
GROUP BY 1)
WHERE n_early >= 3 AND n_late >= 3
""")
def consensus_flips(s, d):
    res = C.scoped(P.resolutions(s, d, False))
    return C.consensus_flips(res, C.middle_year(res))


_CONSENSUS = "SELECT subject, round(count(*) FILTER (WHERE vt = 'C') * 100.0::DOUBLE / count(*), 4) AS consensus_pct, count(*) AS n FROM res0 WHERE NOT am GROUP BY 1 ORDER BY consensus_pct {}, subject LIMIT 10"


@_query(_CONSENSUS.format("DESC"))
def subjects_most_consensual(s, d):
    return C.subject_consensus(C.scoped(P.resolutions(s, d, False)), 10, True)


@_query(_CONSENSUS.format("ASC"))
def subjects_least_consensual(s, d):
    return C.subject_consensus(C.scoped(P.resolutions(s, d, False)), 10, False)


@_query("SELECT year, count(*) AS n FROM res0 WHERE NOT am AND vt = 'WD' GROUP BY 1")
def withdrawn_by_year(s, d):
    return C.mode_by_year(C.scoped(P.resolutions(s, d, False)), "WD")


@_query("""
SELECT record_id, title, year, body, subject, vt AS mode, am,
       CASE WHEN yes + no + abstain > 0 THEN yes END AS yes,
       CASE WHEN yes + no + abstain > 0 THEN no END AS no,
       CASE WHEN yes + no + abstain > 0 THEN abstain END AS abstain
FROM res
""")
def catalogue_explorer(s, d):
    return C.explorer(P.resolutions(s, d))


@_query("SELECT record_id, title, year, body, subject, yes, no, abstain, am FROM res WHERE n_rollcall > 0")
def recorded_resolutions(s, d):
    return P.resolutions(s, d).where("n_rollcall > 0").select("record_id", "title", "year", "body", "subject", "yes", "no", "abstain", "am")


@_query("SELECT vt AS type, count(*) AS n, count(*) FILTER (WHERE n_rollcall > 0) AS has_rollcall FROM res GROUP BY 1")
def vote_type_coverage(s, d):
    return C.vote_types(P.resolutions(s, d))


@_query("SELECT body, count(*) AS n FROM res0 GROUP BY 1")
def body_counts(s, d):
    return P.resolutions(s, d, False).groupBy("body").agg(F.count("*").alias("n"))


@_query("SELECT CAST(year // 10 * 10 AS BIGINT) AS decade, count(*) AS \"all\", count(*) FILTER (WHERE n_rollcall > 0) AS recorded FROM res GROUP BY 1")
def decade_coverage(s, d):
    return C.decades(P.resolutions(s, d))


@_query("""
SELECT count(*) AS resolutions,
       count(*) FILTER (WHERE n_rollcall > 0) AS recorded,
       count(*) FILTER (WHERE n_rollcall = 0 AND coalesce(yes + no + abstain > 0, false)) AS totals_no_rollcall,
       count(*) FILTER (WHERE n_rollcall = 0 AND NOT coalesce(yes + no + abstain > 0, false)) AS neither
FROM res
""")
def totals_coverage(s, d):
    return C.totals_coverage(P.resolutions(s, d))


@_query("""
SELECT count(*) AS n_resolutions,
       min(year) AS year_min,
       max(year) AS year_max,
       count(DISTINCT subject) AS n_subjects,
       count(*) FILTER (WHERE n_rollcall = 0) AS no_rollcall, (SELECT count(DISTINCT state)
FROM states) AS n_states
FROM res
""")
def overview(s, d):
    return C.overview(P.resolutions(s, d), P.states(s, d))


@_query("""
, t AS (SELECT record_id,
       count(*) FILTER (WHERE code = 'Y') AS y,
       count(*) FILTER (WHERE code = 'N') AS n,
       count(*) FILTER (WHERE code = 'A') AS a
FROM votes
GROUP BY 1) SELECT count(*) FILTER (WHERE y = yes AND t.n = no AND a = abstain) AS reconciled,
       count(*) FILTER (WHERE NOT (y = yes AND t.n = no AND a = abstain)) AS mismatched
FROM t
JOIN res USING (record_id)
""")
def reconciliation(s, d):
    return V.reconciliation(P.votes(s, d), P.resolutions(s, d).where("n_rollcall > 0").select("record_id", "yes", "no", "abstain"))


@_query("""
SELECT state,
       min(grp) AS grp,
       count(*) AS n,
       count(*) FILTER (WHERE code = 'Y') AS yes,
       count(*) FILTER (WHERE code = 'N') AS no,
       count(*) FILTER (WHERE code = 'A') AS abstain,
       count(*) FILTER (WHERE code = '.') AS absent,
       count(*) FILTER (WHERE code = '') AS blank,
       min(year) AS first,
       max(year) AS last
FROM votes
GROUP BY 1
""")
def country_stats(s, d):
    return V.state_statistics(P.votes(s, d))


@_query("SELECT state, arg_max(name, (year, record_id, pos, name)) AS name FROM (SELECT *, grp || ' #' || CAST(part AS VARCHAR) AS name FROM votes) GROUP BY 1")
def latest_name(s, d):
    return V.latest_name(P.votes(s, d).withColumn("name", F.concat("grp", F.lit(" #"), F.col("part").cast("string"))), "name", ["record_id", "pos"])


@_query("""
SELECT subject,
       count(*) AS n,
       bool_or(EXISTS (SELECT 1
FROM states
WHERE upper(state) = upper(subject) OR (length(state) > 5 AND contains(upper(subject), upper(state))))) AS cs
FROM (SELECT CASE WHEN record_id % 7 = 0 THEN subject || ' in NATION_' || CAST(record_id % 30 AS VARCHAR) ELSE subject END AS subject
FROM res
WHERE n_rollcall > 0)
GROUP BY 1
""")
def subject_index(s, d):
    res = P.resolutions(s, d)
    named = F.when(F.col("record_id") % 7 == 0, F.concat("subject", F.lit(" in NATION_"), (F.col("record_id") % 30).cast("string"))).otherwise(F.col("subject"))
    return C.subject_index(res.withColumn("subject", named), P.states(s, d))


@_query("SELECT subject, count(*) AS n FROM res0 WHERE contains(lower(subject), 'mach') GROUP BY 1 ORDER BY n DESC, subject LIMIT 5")
def suggest_subjects(s, d):
    return C.suggest(P.resolutions(s, d, False), "mach", 5)


@_query("SELECT record_id, title, subject FROM res0 WHERE contains(lower(subject), 'furniture') OR contains(lower(title), 'furniture')")
def search_titles(s, d):
    return C.search(P.resolutions(s, d, False), "Furniture")


@_query("""
SELECT 'state' AS kind, state AS name
FROM (SELECT DISTINCT state
FROM states)
WHERE contains(lower(state), 'n_1')
UNION ALL SELECT 'subject', subject
FROM (SELECT DISTINCT subject
FROM res0)
WHERE contains(lower(subject), 'n_1') OR contains(lower(subject), 'build')
""")
def palette_search(s, d):
    hit = lambda c, *t: F.lit(False) if not t else F.col(c).isNotNull() & sum_or([F.contains(F.lower(c), F.lit(x)) for x in t])
    a = P.states(s, d).select(F.lit("state").alias("kind"), F.col("state").alias("name")).distinct().where(hit("name", "n_1"))
    b = P.resolutions(s, d, False).select(F.lit("subject").alias("kind"), F.col("subject").alias("name")).distinct().where(hit("name", "n_1", "build"))
    return a.unionByName(b)


def sum_or(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


@_query("""
SELECT b.subject,
       count(*) AS n
FROM res0 a
JOIN res0 b ON a.year = b.year AND a.month = b.month AND a.subject <> b.subject
WHERE a.subject = '1-URGENT MACHINERY'
GROUP BY 1
ORDER BY n DESC, 1 LIMIT 10
""")
def related_tags(s, d):
    res = P.resolutions(s, d, False)
    months = res.where("subject = '1-URGENT MACHINERY'").groupBy("month").agg(F.count("*").alias("k"))
    return res.where("subject <> '1-URGENT MACHINERY'").join(months, "month").groupBy("subject").agg(F.sum("k").alias("n")).orderBy(F.desc("n"), "subject").limit(10)


@_query("""
SELECT code,
       count(*) AS n,
       string_agg(DISTINCT state, ','
ORDER BY state) AS states
FROM votes
WHERE record_id = (SELECT min(record_id)
FROM votes)
GROUP BY 1
""")
def rollcall_detail(s, d):
    votes = P.votes(s, d)
    return V.rollcall(votes, votes.agg(F.min("record_id")).first()[0])


@_query("SELECT record_id, year, title, code FROM votes JOIN (SELECT record_id, title FROM res0) USING (record_id) WHERE state = 'NATION_3'")
def state_resolutions(s, d):
    return P.votes(s, d).where("state = 'NATION_3'").join(
        P.resolutions(s, d, False).select("record_id", "title"),
        "record_id",
    ).select("record_id", "year", "title", "code")


@_query("SELECT state, count(*) AS n FROM votes GROUP BY 1 ORDER BY n DESC, state LIMIT 10")
def states_most_active(s, d):
    return V.most_active(P.votes(s, d), 10)


@_query("SELECT state_a AS state, round(avg(same * 100.0::DOUBLE / shared), 4) AS mean_agreement FROM sym GROUP BY 1 ORDER BY mean_agreement DESC, 1 LIMIT 10")
def states_most_agreeing(s, d):
    return V.most_agreeing(_pairs(s, d), 10)


@_query("""
SELECT state, code,
       count(*) AS n
FROM votes
WHERE year BETWEEN 1996 AND 1998 AND state IN (SELECT state
FROM states
WHERE grp = (SELECT min(grp)
FROM states))
GROUP BY 1, 2
""")
def set_and_years(s, d):
    votes, states = P.votes(s, d), P.states(s, d)
    chosen = states.join(states.agg(F.min("grp").alias("grp")), "grp").select("state").distinct()
    return votes.where("year between 1996 and 1998").join(chosen, "state", "left_semi").groupBy("state", "code").agg(F.count("*").alias("n"))


_IDS = ("SELECT record_id FROM res0 WHERE year <= 1997", "SELECT record_id FROM res0 WHERE month % 2 = 0")


def _ids(s, d):
    res = P.resolutions(s, d, False)
    return res.where("year <= 1997").select("record_id"), res.where("month % 2 = 0").select("record_id")


@_query(f"{_IDS[0]} UNION {_IDS[1]}")
def id_union(s, d):
    return C.id_union(*_ids(s, d))


@_query(f"{_IDS[0]} EXCEPT {_IDS[1]}")
def id_difference(s, d):
    return C.id_difference(*_ids(s, d))


@_query(f"SELECT count(*) AS n FROM ({_IDS[0]} INTERSECT {_IDS[1]})")
def id_overlap(s, d):
    return C.id_overlap(*_ids(s, d))


@_query("""
SELECT record_id, pos, state, code, part
FROM (SELECT *, row_number() OVER (PARTITION BY record_id
ORDER BY pos, state, code, part) AS k
FROM votes)
WHERE k = 1
""")
def dedupe_first(s, d):
    return C.distinct_first(P.votes(s, d).select("record_id", "pos", "state", "code", "part"), "record_id", "pos", "state", "code", "part")


@_query("""
, i AS (SELECT record_id, row_number() OVER (ORDER BY record_id) - 1 AS ri
FROM (SELECT DISTINCT record_id
FROM votes)),
m AS (SELECT state, ri, pos,
       CASE WHEN code = '' THEN '-' ELSE code END AS c
FROM votes
JOIN i USING (record_id)) SELECT state,
       string_agg(CAST(ri AS VARCHAR), ','
ORDER BY ri, pos, c) AS r,
       string_agg(c, ''
ORDER BY ri, pos, c) AS v
FROM m
GROUP BY 1
""")
def vote_matrix(s, d):
    votes = P.votes(s, d)
    out = V.vote_matrix(votes, V.dense_index(votes.select("record_id").distinct()))
    return out.select("state", F.array_join(F.transform("r", lambda x: x.cast("string")), ",").alias("r"), "v")


@_query("""
SELECT state,
       coalesce(g.grp, '') AS grp
FROM (SELECT DISTINCT state
FROM states)
LEFT
JOIN (SELECT DISTINCT state, grp
FROM states
WHERE grp <> 'ASIA') g USING (state)
WHERE coalesce(g.grp, '') = ''
""")
def states_unassigned(s, d):
    states = P.states(s, d)
    groups = states.where("grp <> 'ASIA'").select("state", "grp").distinct()
    return states.select("state").distinct().join(groups, "state", "left").select("state", F.coalesce("grp", F.lit("")).alias("grp")).where("grp = ''")


_XML = "<record><controlfield tag=\"001\">", "</controlfield><datafield tag=\"245\"><subfield code=\"a\">", "</subfield></datafield><datafield tag=\"269\"><subfield code=\"a\">", "</subfield></datafield><datafield tag=\"991\"><subfield code=\"d\">", "</subfield></datafield>", "</record>"


@_query("""
, v AS (SELECT record_id,
       count(*) AS n_rollcall,
       count(*) FILTER (WHERE code = 'Y') AS y
FROM votes
GROUP BY 1) SELECT CAST(record_id AS VARCHAR) AS record_id, title,
       CAST(year AS VARCHAR) || '-0' || CAST(month % 9 + 1 AS VARCHAR) || '-15' AS date,
       CAST(year AS VARCHAR) AS year, subject AS agenda_subject, n_rollcall, y
FROM v
JOIN res0 USING (record_id)
""")
def marc_roundtrip(s, d):
    """Records written as MARCXML and parsed back."""
    one = lambda tag, *subs: F.concat(F.lit(f'<datafield tag="{tag}">'), *[x for code, c in subs for x in (F.lit(f'<subfield code="{code}">'), c, F.lit("</subfield>"))], F.lit("</datafield>"))
    vote = one("967", ("b", F.col("state")), ("d", F.col("code")))
    rolls = P.votes(s, d).groupBy("record_id").agg(F.array_join(F.collect_list(vote), "").alias("rolls"))
    date = F.concat(F.col("year").cast("string"), F.lit("0"), (F.col("month") % 9 + 1).cast("string"), F.lit("15"))
    text = F.concat(
        F.lit(_XML[0]),
        F.col("record_id").cast("string"),
        F.lit(_XML[1]),
        "title",
        F.lit(_XML[2]),
        date,
        F.lit(_XML[3]),
        "subject",
        F.lit(_XML[4]),
        "rolls",
        F.lit(_XML[5]),
    )
    made = P.resolutions(s, d, False).join(rolls, "record_id").select(text.alias("xml"))
    parsed = marc.parse(marc.from_text(made, "xml", F.lit("made"), F.lit(0)), "title", "date", "year", "agenda_subject", "n_rollcall", "rollcall")
    yes = F.size(F.filter("rollcall", lambda v: v["d"] == "Y")).cast("long")
    return parsed.select("record_id", "title", "date", "year", "agenda_subject", F.col("n_rollcall").cast("long").alias("n_rollcall"), yes.alias("y"))


@_query(r"""
SELECT record_id,
       trim(regexp_replace(trim(long), '\s*:\s*(draft\s+)?(resolution|decision|amendment)s?\s*/[^\n]*$', '', 'i')) AS trimmed, regexp_matches(long, ':\s*amendment', 'i') OR regexp_matches(draft, '^\s*amendment', 'i') AS amendment,
       CASE kind WHEN 'ADOPTED WITHOUT VOTE' THEN 'C' WHEN 'RECORDED' THEN 'V' ELSE 'O' END AS mode,
       CAST(year // 10 * 10 AS INT) AS decade,
       array_to_string(list_transform(regexp_extract_all(lower(title), '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), '') AS cased,
       CASE WHEN strlen(item) = 0 THEN '' ELSE rtrim(trim(item), ' -') END AS item
FROM (SELECT *, title || CASE WHEN record_id % 4 = 0 THEN ' : draft resolution / adopted by' WHEN record_id % 5 = 0 THEN ' : amendment / x' ELSE '' END AS long,
       CASE WHEN record_id % 5 = 0 THEN ' Amendment to' ELSE '' END AS draft,
       CASE WHEN record_id % 3 = 0 THEN 'ADOPTED WITHOUT VOTE' WHEN record_id % 3 = 1 THEN 'RECORDED' ELSE 'else' END AS kind,
       CASE WHEN record_id % 2 = 0 THEN subject || ' -- ' ELSE '' END AS item
FROM res0)
""")
def scalar_rules(s, d):
    res, key = P.resolutions(s, d, False), F.col("record_id")
    title = F.concat("title", F.when(key % 4 == 0, F.lit(" : draft resolution / adopted by")).when(key % 5 == 0, F.lit(" : amendment / x")).otherwise(F.lit("")))
    draft = F.when(key % 5 == 0, F.lit(" Amendment to")).otherwise(F.lit(""))
    kind = F.when(key % 3 == 0, "ADOPTED WITHOUT VOTE").when(key % 3 == 1, "RECORDED").otherwise("else")
    return res.select(
        "record_id",
        R.trim_title(title).alias("trimmed"),
        R.is_amendment(title, draft).alias("amendment"),
        R.mode_code(kind).alias("mode"),
        R.decade(F.col("year")).alias("decade"),
        R.title_case(F.col("title")).alias("cased"),
        R.clean_item(F.when(key % 2 == 0, F.concat("subject", F.lit(" -- "))).otherwise(F.lit(""))).alias("item"),
    )


@_query("SELECT record_id FROM res0 WHERE year BETWEEN 1993 AND 1998 AND record_id % 2 = 0 OR record_id % 2 = 1 AND record_id % 20 <= 11")
def mirror_scope(s, d):
    key = F.col("record_id")
    symbol = F.when(key % 2 == 0, F.concat(F.lit("E/CN.4/"), key.cast("string"))).otherwise(F.concat(F.lit("A/HRC/RES/"), (key % 20).cast("string"), F.lit("/1")))
    year = F.when(F.col("year") <= 1998, F.col("year").cast("string")).otherwise(F.lit(""))
    return P.resolutions(s, d, False).where(R.mirror_scope(symbol, year)).select("record_id")


@_query("SELECT CAST(record_id AS VARCHAR) AS symbol FROM res0 WHERE NOT (record_id % 3 = 0 AND record_id % 9 <> 0)")
def still_to_do(s, d):
    res = P.resolutions(s, d, False).select(F.col("record_id").cast("string").alias("symbol"), "record_id")
    log = res.where("record_id % 3 = 0").select(
        "symbol",
        F.when(F.col("record_id") % 9 == 0, "error:TimeoutError").otherwise("ok").alias("status"),
        F.lit("").alias("file"),
    )
    return ingest.still_to_do(res, log).select("symbol")


@_query("SELECT CASE WHEN record_id % 5 = 0 THEN 'error' WHEN record_id % 5 < 3 THEN 'missing' ELSE 'ok' END AS outcome, count(*) AS n FROM res0 GROUP BY 1")
def mirror_progress(s, d):
    status = F.when(F.col("record_id") % 5 == 0, "error:x").when(F.col("record_id") % 5 == 1, "tiny").when(F.col("record_id") % 5 == 2, "missing").otherwise("ok")
    return ingest.progress(P.resolutions(s, d, False).select(status.alias("status")))


@_query("""
SELECT count(*) AS total,
       count(DISTINCT record_id) AS ids,
       count(*) FILTER (WHERE year IS NULL) AS undated
FROM (SELECT record_id,
       CASE WHEN record_id % 11 <> 0 THEN year END AS year
FROM votes)
""")
def harvest_coverage(s, d):
    return P.votes(s, d).select("record_id", F.when(F.col("record_id") % 11 != 0, F.col("year")).alias("year")).agg(
        F.count("*").alias("total"),
        F.countDistinct("record_id").alias("ids"),
        F.count_if(F.col("year").isNull()).alias("undated"),
    )


_ROB = "[" + ", ".join(map(str, geo.LENGTH)) + "]::DOUBLE[]", "[" + ", ".join(map(str, geo.DISTANCE)) + "]::DOUBLE[]"


@_query(f"""
SELECT event_id,
       round({geo.WIDTH / 2} + {geo.FX} * (l[i + 1] + (l[i + 2] - l[i + 1]) * f) * radians(lon) * {geo.SCALE}, 6) AS x,
       round({geo.HEIGHT / 2} - {geo.FY} * (t[i + 1] + (t[i + 2] - t[i + 1]) * f) * CASE WHEN lat >= 0 THEN 1 ELSE -1 END * {geo.SCALE}, 6) AS y
FROM (SELECT *, (abs(lat) - i * 5) / 5 AS f, {_ROB[0]} AS l, {_ROB[1]} AS t
FROM (SELECT *,
       CAST(least(floor(abs(lat) / 5), 17) AS INT) AS i
FROM (SELECT event_id,
       CAST(event_id % 361 AS DOUBLE) - 180 AS lon,
       CAST(event_id % 181 AS DOUBLE) - 90 AS lat
FROM events)))
""", prelude=False)
def robinson_points(s, d):
    e = P.table(s, d, "events").select(
        "event_id",
        (F.col("event_id") % 361 - 180).cast("double").alias("lon"),
        (F.col("event_id") % 181 - 90).cast("double").alias("lat"),
    )
    x, y = geo.project(F.col("lon"), F.col("lat"))
    return e.select("event_id", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


_CHAIN = """, top AS (SELECT state, count(*) AS n FROM one GROUP BY 1 ORDER BY n DESC, state LIMIT 30),
chain AS (SELECT 0 AS place, state, [state] AS seen FROM (SELECT state FROM top ORDER BY n DESC, state LIMIT 1)
  UNION ALL SELECT place + 1, arg_min(t.state, (-coalesce(agreement_pct, -1), t.state)), list_append(any_value(seen), arg_min(t.state, (-coalesce(agreement_pct, -1), t.state)))
  FROM chain c JOIN top t ON NOT list_contains(c.seen, t.state) LEFT JOIN sym ON state_a = c.state AND state_b = t.state GROUP BY place)
SELECT CAST(place AS BIGINT) AS place, state FROM chain"""


@_query(P.SQL.replace("WITH", "WITH RECURSIVE", 1) + _CHAIN, prelude=False)
def nearest_chain_order(s, d):
    """A greedy order of the most active states (a chart's set, thirty at most) by agreement."""
    return V.nearest_chain(_chamber(s, d), 30)


@_query("""
SELECT state, minority_side_pct, votes,
       CAST(row_number() OVER (ORDER BY minority_side_pct DESC, state) AS BIGINT) AS place
FROM (SELECT state,
       round(count(*) FILTER (WHERE code <> won) * 100.0::DOUBLE / count(*), 4) AS minority_side_pct,
       count(*) AS votes
FROM one
JOIN (SELECT record_id,
       CASE WHEN y > n AND y > a THEN 'Y' WHEN n > y AND n > a THEN 'N' WHEN a > y AND a > n THEN 'A' END AS won
FROM tally) USING (record_id)
WHERE won IS NOT NULL
GROUP BY 1)
""")
def outvoted_ranked(s, d):
    return V.ranked(V.outvoted(_one(s, d)), "minority_side_pct", "state")


@_query(f"""
SELECT state, yes_pct, votes,
       CAST(row_number() OVER (ORDER BY yes_pct DESC, state) AS BIGINT) AS place
FROM (SELECT subject, state, {_SHARES}
FROM one
WHERE subject = '1-URGENT MACHINERY'
GROUP BY 1, 2)
""")
def support_ranked(s, d):
    """States by their support of one subject."""
    return V.ranked(V.by_topic(_one(s, d).where("subject = '1-URGENT MACHINERY'"), "state").select("state", "yes_pct", "votes"), "yes_pct", "state")


@_query("""
SELECT year, grp,
       round(count(*) FILTER (WHERE code = 'Y') * 100.0::DOUBLE / count(*), 4) AS yes_pct,
       count(*) AS votes
FROM one
WHERE subject = '1-URGENT MACHINERY'
GROUP BY 1, 2
""")
def topic_trend_by_group(s, d):
    return V.topic_trend_by(_one(s, d), "1-URGENT MACHINERY", "grp")


@_query("""
SELECT state_a AS state,
       max(agreement_pct) FILTER (WHERE state_b = 'NATION_1') AS "NATION_1",
       max(agreement_pct) FILTER (WHERE state_b = 'NATION_2') AS "NATION_2",
       max(agreement_pct) FILTER (WHERE state_b = 'NATION_3') AS "NATION_3"
FROM (SELECT state_a, state_b, agreement_pct
FROM sym
UNION ALL SELECT DISTINCT state, state, 100.0::DOUBLE
FROM one)
GROUP BY 1
""")
def coincidence_pivot(s, d):
    return V.pivoted(V.coincidence_matrix(_pairs(s, d), _states_voting(s, d)), ["NATION_1", "NATION_2", "NATION_3"])


@_query("SELECT record_id, year, code, pos FROM votes WHERE state = 'NATION_3' ORDER BY year DESC, record_id, pos")
def state_vote_table(s, d):
    return V.vote_table(P.votes(s, d), "NATION_3").select("record_id", "year", "code", "pos")


@_query("SELECT state_a AS state, round(avg(same * 100.0::DOUBLE / shared), 4) AS mean_agreement FROM sym GROUP BY 1 ORDER BY mean_agreement, 1 LIMIT 10")
def states_most_disagreeing(s, d):
    return V.most_agreeing(_pairs(s, d), 10, most=False)


@_query("""
SELECT subject,
       count(*) AS n
FROM res0
WHERE contains(title, 'no. 1') AND NOT contains(lower(subject), 'no. 1')
GROUP BY 1
ORDER BY n DESC, 1 LIMIT 10
""")
def related_by_match(s, d):
    """Subjects of the resolutions that a search finds, besides those that it names."""
    return C.related(P.resolutions(s, d, False), "no. 1", 10)


@_query("SELECT year, body, count(*) AS n FROM res GROUP BY 1, 2")
def volume_by_year_all(s, d):
    return C.volume_by_year(C.scoped(P.resolutions(s, d), everything=True))


@_query('SELECT id, sym, title, year, body, subj, date, item, spon, mtg, "urlR", "urlD", y, n, a, am, ri FROM made')
def payload_res(s, d):
    return PL.res_rows(PL.recorded(P.catalogue(s, d)))


@_query(r"""
SELECT record_id AS id, symbol AS sym,
       trim(regexp_replace(trim(title), '\s*:\s*(draft\s+)?(resolution|decision|amendment)s?\s*/[^\n]*$', '', 'i')) AS t,
       TRY_CAST(nullif(year, '') AS INT) AS year,
       CASE WHEN contains(body, 'Council') THEN 'HRC' ELSE 'CHR' END AS body,
       trim(agenda_subject) AS subj,
       CASE vote_type WHEN 'ADOPTED WITHOUT VOTE' THEN 'C' WHEN 'RECORDED' THEN 'V' WHEN 'WITHDRAWN' THEN 'WD' ELSE 'O' END AS vt,
       CASE WHEN regexp_matches(title, ':\s*amendment', 'i') OR regexp_matches(draft, '^\s*amendment', 'i') THEN 1 END AS am,
       CASE WHEN has THEN CAST(yes AS INT) END AS y,
       CASE WHEN has THEN CAST(no AS INT) END AS n,
       CASE WHEN has THEN CAST(abstain AS INT) END AS a, pos
FROM (SELECT *,
       coalesce(TRY_CAST(nullif(yes, '') AS INT) + TRY_CAST(nullif(no, '') AS INT) + TRY_CAST(nullif(abstain, '') AS INT) > 0, false) AS has
FROM cat)
""")
def payload_res_all(s, d):
    return PL.res_all_rows(P.catalogue(s, d))


def _cast(s: SparkSession, d: str) -> DataFrame:
    return PL.vote_rows(P.votes_long(s, d), PL.recorded(P.catalogue(s, d)))


def _groups(s: SparkSession, d: str) -> DataFrame:
    return P.states(s, d).where("grp <> 'ASIA'").select(F.col("state").alias("iso3"), "grp").distinct()


@_query("""
SELECT iso3,
       array_to_string(list_transform(regexp_extract_all(lower(name), '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), '') AS name,
       coalesce(grp, '') AS "group", n, y, no, a, absent, blank, first, last
FROM land
LEFT
JOIN (SELECT DISTINCT state, grp
FROM states
WHERE grp <> 'ASIA') g ON iso3 = state
""")
def payload_countries(s, d):
    return PL.countries(_cast(s, d), _groups(s, d))


@_query("SELECT iso3, string_agg(CAST(ri AS VARCHAR), ',' ORDER BY pos, ri, code) AS r, string_agg(code, '' ORDER BY pos, ri, code) AS v FROM cast_ GROUP BY 1")
def payload_votes(s, d):
    return PL.matrix(_cast(s, d)).select("iso3", F.array_join(F.transform("r", lambda x: x.cast("string")), ",").alias("r"), "v")


@_query("SELECT subj AS name, count(*) AS n, min(ri) AS first_seen, bool_or(contains(upper(subj), 'MACHINERY')) AS cs FROM made WHERE subj <> '' GROUP BY 1")
def payload_subjects(s, d):
    names = s.createDataFrame([("Machinery",), ("A",)], "name string")
    return PL.subjects(PL.res_rows(PL.recorded(P.catalogue(s, d))), names)


@_query("""
SELECT CASE vote_type WHEN '' THEN '(blank)' ELSE vote_type END AS type,
       count(*) AS count,
       count(*) FILTER (WHERE n_rollcall > 0) AS "hasRollcall",
       min(pos) AS first_seen
FROM cat
GROUP BY 1
""")
def payload_vote_types(s, d):
    return PL.vote_types(P.catalogue(s, d))


@_query("""
, t AS (SELECT record_id,
       count(*) FILTER (WHERE code = 'Y') AS ty,
       count(*) FILTER (WHERE code = 'N') AS tn,
       count(*) FILTER (WHERE code = 'A') AS ta
FROM cast_
GROUP BY 1),
q AS (SELECT coalesce(ty, 0) = CAST(yes AS INT) AND coalesce(tn, 0) = CAST(no AS INT) AND coalesce(ta, 0) = CAST(abstain AS INT) AS same
FROM rec
LEFT
JOIN t USING (record_id)
WHERE yes <> '' AND no <> '' AND abstain <> ''),
c AS (SELECT count(*) AS total,
       count(*) FILTER (WHERE n_rollcall > 0) AS recorded,
       count(*) FILTER (WHERE body = 'The Council') AS hrc,
       count(*) FILTER (WHERE n_rollcall = 0 AND coalesce(TRY_CAST(nullif(yes, '') AS INT) + TRY_CAST(nullif(no, '') AS INT) + TRY_CAST(nullif(abstain, '') AS INT) > 0, false)) AS totals,
       count(DISTINCT trim(agenda_subject)) AS subjects
FROM cat) SELECT recorded AS n_resolutions, (SELECT count(DISTINCT iso3)
FROM cast_) AS n_countries, (SELECT min(year)
FROM made) AS year_min, (SELECT max(year)
FROM made) AS year_max, total, hrc, totals, total - recorded - totals AS neither, subjects, (SELECT count(DISTINCT subj)
FROM made) AS subjects_recorded, (SELECT count(*) FILTER (WHERE same)
FROM q) AS reconciled, (SELECT count(*) FILTER (WHERE NOT same)
FROM q) AS mismatched, (SELECT count(DISTINCT CAST(year AS INT) // 10)
FROM cat
WHERE year <> '') AS n_decades
FROM c
""")
def payload_meta(s, d):
    rows = PL.recorded(P.catalogue(s, d))
    c = "meta.coverage."
    return PL.meta(P.catalogue(s, d), PL.vote_rows(P.votes_long(s, d), rows), rows, {"A": "a"}).selectExpr(
        "meta.nResolutions n_resolutions",
        "meta.nCountries n_countries",
        "meta.yearMin year_min",
        "meta.yearMax year_max",
        f"{c}totalResolutions total",
        f"{c}bodyAll['HRC'] hrc",
        f"{c}totalsNoRollcall totals",
        f"{c}neitherTotalsNorRollcall neither",
        f"{c}nSubjectsAll subjects",
        f"{c}nSubjectsRecorded subjects_recorded",
        f"{c}reconciled",
        f"{c}mismatched",
        f"cast(size({c}decades) as long) n_decades",
    )


@_query(r"""
SELECT 'res' AS section, ri AS place, id AS key, CAST(y AS BIGINT) AS number, CAST(am AS BIGINT) AS flag, title AS text
FROM made
UNION ALL SELECT 'countries', CAST(row_number() OVER (ORDER BY iso3) - 1 AS BIGINT), iso3, n, NULL,
       array_to_string(list_transform(regexp_extract_all(lower(name), '[a-z]+|[^a-z]+'), lambda x: upper(x[1]) || x[2:]), '')
FROM land
UNION ALL SELECT 'subjects', CAST(row_number() OVER (ORDER BY n DESC, first_seen) - 1 AS BIGINT), subj, n, 0, ''
FROM (SELECT subj, count(*) AS n, min(ri) AS first_seen FROM made WHERE subj <> '' GROUP BY 1)
UNION ALL SELECT 'resAll', CAST(row_number() OVER (ORDER BY pos) - 1 AS BIGINT), record_id,
       CASE WHEN has THEN CAST(yes AS BIGINT) END,
       CASE WHEN regexp_matches(title, ':\s*amendment', 'i') OR regexp_matches(draft, '^\s*amendment', 'i') THEN 1 END,
       trim(regexp_replace(trim(title), '\s*:\s*(draft\s+)?(resolution|decision|amendment)s?\s*/[^\n]*$', '', 'i'))
FROM (SELECT *,
       coalesce(TRY_CAST(nullif(yes, '') AS INT) + TRY_CAST(nullif(no, '') AS INT) + TRY_CAST(nullif(abstain, '') AS INT) > 0, false) AS has
FROM cat)
""")
def payload_file(s, d):
    """Every item of the payload's lists, as its parts have them, in order."""
    at, out = workspace(s, "payload"), None
    PL.write(P.catalogue(s, d), P.votes_long(s, d), _groups(s, d), {"A": "a"}, at)
    none = F.lit(None).cast("long")
    sections = {
        "res": (1, "struct<id string, y long, am long, title string>", "item.id", F.col("item.y"), F.col("item.am"), F.col("item.title")),
        "countries": (3, "struct<iso3 string, n long, name string>", "item.iso3", F.col("item.n"), none, F.col("item.name")),
        "subjects": (7, "struct<name string, n long, cs boolean>", "item.name", F.col("item.n"), F.col("item.cs").cast("long"), F.lit("")),
        "resAll": (9, "struct<id string, y long, am long, t string>", "item.id", F.col("item.y"), F.col("item.am"), F.col("item.t")),
    }
    for name, (k, schema, key, number, flag, text) in sections.items():
        own = parts.items(s, at, k, schema).select(
            F.lit(name).alias("section"), "place", F.col(key).alias("key"), number.alias("number"), flag.alias("flag"), text.alias("text")
        )
        out = own if out is None else out.unionByName(own)
    return out


def _features(s: SparkSession, d: str) -> DataFrame:
    """A square for most nations, a speck for some, and features that the map leaves out."""
    n = P.table(s, d, "nation")
    key = F.col("n_nationkey").cast("double")
    side = F.when(F.col("n_nationkey") % 5 == 0, 0.01).otherwise(9.0)
    west, south = key * 7 - 87.3, key * 3 - 41.7
    ring = F.array(F.array(west, south), F.array(west + side, south), F.array(west + side, south + side), F.array(west, south))
    named = F.when(F.col("n_nationkey") == 7, "ATA").when(F.col("n_nationkey") == 8, "").otherwise(F.col("n_name"))
    return n.select(named.alias("id"), F.col("n_name").alias("name"), F.array(F.array(ring)).alias("polygons"), F.col("n_nationkey").alias("pos"))


def _voters(s: SparkSession, d: str) -> DataFrame:
    return P.states(s, d).select(F.col("state").alias("iso3"), F.concat("grp", F.lit("/"), "state").alias("name")).distinct()


def _points(s: SparkSession, d: str) -> DataFrame:
    key = F.col("n_nationkey")
    return P.table(s, d, "nation").where(key % 10 == 0).select(F.col("n_name").alias("iso3"), (key * 7 - 87.3).alias("lon"), (key * 3 - 41.7).alias("lat"))


def _plane(lon: str, lat: str) -> str:
    """SQL for map x and y of degrees, to one decimal place."""
    x = f"round({geo.WIDTH / 2} + {geo.FX} * (ll[i + 1] + (ll[i + 2] - ll[i + 1]) * f) * radians(lon) * {geo.SCALE}, 1)"
    y = f"round({geo.HEIGHT / 2} - {geo.FY} * (dd[i + 1] + (dd[i + 2] - dd[i + 1]) * f) * CASE WHEN lat >= 0 THEN 1 ELSE -1 END * {geo.SCALE}, 1)"
    return f"SELECT *, {x} AS x, {y} AS y FROM (SELECT *, (abs(lat) - i * 5) / 5 AS f, {_ROB[0]} AS ll, {_ROB[1]} AS dd FROM (SELECT *, CAST(least(floor(abs(lat) / 5), 17) AS INT) AS i FROM (SELECT *, {lon} AS lon, {lat} AS lat FROM {{}})))"


_CORNERS = _plane("n_nationkey * 7 - 87.3::DOUBLE + 9 * dx", "n_nationkey * 3 - 41.7::DOUBLE + 9 * dy").format(
    "(SELECT * FROM nation, (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 0)) c(k, dx, dy) WHERE n_nationkey % 5 <> 0 AND n_nationkey NOT IN (7, 8))"
)
_PLACES = _plane("n_nationkey * 7 - 87.3::DOUBLE", "n_nationkey * 3 - 41.7::DOUBLE").format(
    "(SELECT nation.*, v.name FROM nation JOIN (SELECT DISTINCT state, grp || '/' || state AS name FROM states) v ON n_name = state WHERE n_nationkey % 10 = 0)"
)
_SHAPES = f""", shp AS (SELECT n_name AS iso3, n_name AS name, 'M' || string_agg(CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR), 'L' ORDER BY k) || 'Z' AS path
FROM ({_CORNERS})
GROUP BY 1),
dot AS (SELECT n_name AS iso3, name, x, y
FROM ({_PLACES}))"""


@_query(_SHAPES + " SELECT * FROM shp")
def map_shapes(s, d):
    return geo.shapes(_features(s, d))


@_query(_SHAPES + " SELECT * FROM dot")
def map_dots(s, d):
    return geo.dots(_points(s, d), _voters(s, d), geo.shapes(_features(s, d)))


@_query(_SHAPES + " SELECT DISTINCT state AS iso3 FROM states WHERE state NOT IN (SELECT iso3 FROM shp) AND state NOT IN (SELECT iso3 FROM dot)")
def map_undrawn(s, d):
    drawn = geo.shapes(_features(s, d))
    return geo.undrawn(_voters(s, d), drawn, geo.dots(_points(s, d), _voters(s, d), drawn))


@_query(_SHAPES + """
 SELECT iso3, kind, agreement_pct
FROM (SELECT iso3, 'shape' AS kind
FROM shp
UNION ALL SELECT iso3, 'dot'
FROM dot)
LEFT
JOIN (SELECT state_a AS iso3, agreement_pct
FROM sym
WHERE state_b = 'NATION_1') USING (iso3)
""")
def agreement_map(s, d):
    """Agreement with one state on the map: shapes and dots, those without common votes too."""
    drawn = geo.shapes(_features(s, d))
    values = V.both_ways(_pairs(s, d)).where("state_b = 'NATION_1'").select(F.col("state_a").alias("iso3"), "agreement_pct")
    return geo.choropleth(values, drawn, geo.dots(_points(s, d), _voters(s, d), drawn))


@_query(_SHAPES + """
SELECT iso3, name, path, NULL::DOUBLE AS x, NULL::DOUBLE AS y FROM shp
UNION ALL SELECT iso3, name, NULL, x, y FROM dot
""")
def map_file(s, d):
    """The map's script written and read back: every shape and dot with its name."""
    drawn, at = geo.shapes(_features(s, d)), workspace(s, "map")
    made = geo.world(drawn, geo.dots(_points(s, d), _voters(s, d), drawn))
    made.select(files.payload(F.col("world"), "WORLD").alias("value")).coalesce(1).write.text(at)  # some two hundred states
    kind = "W int, H int, paths map<string, string>, dots map<string, array<double>>, names map<string, string>"
    data = files.read_payload(s, f"{at}/part-*", "WORLD", kind).select("data.*")
    each = data.select("paths", "dots", F.explode("names").alias("iso3", "name"))
    dot = F.try_element_at("dots", "iso3")
    return each.select("iso3", "name", F.try_element_at("paths", "iso3").alias("path"), F.get(dot, F.lit(0)).alias("x"), F.get(dot, F.lit(1)).alias("y"))


_PAGES = "SELECT record_id FROM res0 WHERE record_id % 8 < 5"


@_query(f"""
, dated AS (SELECT record_id
FROM votes
WHERE record_id % 11 <> 0),
und AS (SELECT DISTINCT record_id
FROM votes
WHERE record_id % 11 = 0 AND record_id % 2 = 0),
pages AS ({_PAGES}) SELECT (SELECT count(*)
FROM dated) AS total, (SELECT count(DISTINCT record_id)
FROM dated) AS ids, (SELECT count(*)
FROM und) AS undated, (SELECT count(*)
FROM (SELECT record_id
FROM dated UNION SELECT record_id
FROM und)) AS dated_or_undated, (SELECT count(*)
FROM (SELECT record_id
FROM dated UNION SELECT record_id
FROM und UNION SELECT record_id
FROM pages)) AS combined, (SELECT count(*)
FROM (SELECT record_id
FROM pages EXCEPT (SELECT record_id
FROM dated UNION SELECT record_id
FROM und))) AS missed
""")
def harvest_sets(s, d):
    votes = P.votes(s, d).select("record_id")
    return ingest.harvest_summary(
        votes.where("record_id % 11 <> 0"),
        votes.where("record_id % 11 = 0 and record_id % 2 = 0"),
        P.resolutions(s, d, False).where("record_id % 8 < 5"),
    )


@_query("SELECT record_id FROM cat WHERE NOT regexp_matches(year, '^[0-9]{4}$')")
def undated_resolutions(s, d):
    return ingest.undated(P.catalogue(s, d)).select("record_id")


@_query("""
SELECT CAST(year AS VARCHAR) AS name
FROM (SELECT DISTINCT year
FROM res0)
WHERE year NOT IN (SELECT year
FROM res0
GROUP BY 1
HAVING count(*) * 10 > 200 AND NOT (year IN (1995, 1998) AND count(*) <= 2000))
""")
def partitions_to_fetch(s, d):
    res = P.resolutions(s, d, False).withColumn("name", F.col("year").cast("string"))
    have = res.groupBy("name").agg((F.count("*") * 10).alias("n_bytes"), F.count("*").alias("n_records"))
    return ingest.to_fetch(res.select("name"), have, forced=("1995", "1998"), page=2000)


@_query(r"""SELECT record_id, CASE WHEN record_id % 3 = 0 THEN 'Cuba, ' || state ELSE '' END AS sponsors, CASE WHEN record_id % 2 = 0 THEN 'HRC' ELSE 'CHR' END AS body,
  CASE WHEN regexp_matches(iso, '\$') OR length(iso) > 3 THEN CASE WHEN regexp_extract(iso, '^([A-Za-z]{2,3})', 1) <> '' THEN upper(regexp_extract(iso, '^([A-Za-z]{2,3})', 1)) ELSE iso[1:3] END ELSE iso END AS iso3,
  coalesce(nullif(CASE WHEN contains(iso, '$e') THEN regexp_extract(iso, '\$e(.+)$', 1) ELSE '' END, ''), '') AS country, regexp_replace(symbol, '[^A-Za-z0-9._-]', '_', 'g') AS file,
  regexp_extract(page, '(?i)href="(E/[^"]+\.(?:doc|pdf))"', 1) AS link, TRY_CAST(CASE WHEN regexp_matches(digits, '^[0-9]+$') THEN digits END AS INT) AS number, coalesce(TRY_CAST(CASE WHEN regexp_matches(digits, '^[0-9]+$') THEN digits END AS INT) + 0 + 1 > 0, false) AS totals,
  CASE code WHEN 'Y' THEN 'Y' WHEN 'N' THEN 'N' WHEN 'A' THEN 'A' WHEN '.' THEN '.' ELSE '-' END AS code, CASE WHEN length(day) = 8 THEN day[1:4] || '-' || day[5:6] || '-' || day[7:8] ELSE day END AS date, CASE WHEN length(day) >= 4 THEN day[1:4] ELSE '' END AS year
  FROM (SELECT record_id, pos, state, code, CASE record_id % 4 WHEN 0 THEN 'ven$eVENEZUELA ' || pos WHEN 1 THEN '12345' WHEN 2 THEN 'ab' ELSE 'FRA' END AS iso, 'E/CN.4/' || record_id || ' (' || pos || ')' AS symbol,
    '<a HREF="' || CASE WHEN record_id % 2 = 0 THEN 'E' ELSE 'F' END || '/CN 4-' || record_id || '.pdf">' AS page, CASE WHEN record_id % 5 = 0 THEN ' 7' WHEN record_id % 5 = 1 THEN '' ELSE CAST(record_id AS VARCHAR) END AS digits, CASE record_id % 3 WHEN 0 THEN '20010203' WHEN 1 THEN '1999' ELSE 'n' END AS day FROM votes)""")
def text_rules(s, d):
    """The rules on texts that have every form they know."""
    key, pos = F.col("record_id"), F.col("pos").cast("string")
    text = key.cast("string")
    v = P.votes(s, d).select(
        "record_id", "code", F.when(key % 3 == 0, F.array(F.lit("Note"), F.concat(F.lit(" main sponsor :Cuba, "), "state"))).otherwise(F.array(F.lit("Other"))).alias("notes"),
        F.when(key % 2 == 0, "The Council").otherwise("Commission").alias("body"),
        F.when(key % 4 == 0, F.concat(F.lit("ven$eVENEZUELA "), pos)).when(key % 4 == 1, "12345").when(key % 4 == 2, "ab").otherwise("FRA").alias("iso"),
        F.concat(F.lit("E/CN.4/"), text, F.lit(" ("), pos, F.lit(")")).alias("symbol"),
        F.concat(F.lit('<a HREF="'), F.when(key % 2 == 0, "E").otherwise("F"), F.lit("/CN 4-"), text, F.lit('.pdf">')).alias("page"),
        F.when(key % 5 == 0, " 7").when(key % 5 == 1, "").otherwise(text).alias("digits"),
        F.when(key % 3 == 0, "20010203").when(key % 3 == 1, "1999").otherwise("n").alias("day"),
    )
    date = R.iso_date(F.col("day"))
    return v.select(
        "record_id", R.sponsors(F.col("notes")).alias("sponsors"), R.body_code(F.col("body")).alias("body"), R.repaired_iso(F.col("iso")).alias("iso3"), R.recovered_name(F.col("iso"), F.lit("")).alias("country"),
        R.safe_name(F.col("symbol")).alias("file"), R.document_link(F.col("page")).alias("link"), R.number(F.col("digits")).alias("number"), R.has_totals(F.col("digits"), F.lit("0"), F.lit("1")).alias("totals"),
        R.vote_code(F.col("code")).alias("code"), date.alias("date"), R.year_text(F.col("day")).alias("year"),
    )


def _records(s: SparkSession, d: str) -> DataFrame:
    """Records as a catalogue has them: control number, titles, dates, notes, links and votes."""
    one = lambda tag, *subs: F.concat(F.lit(f'<datafield tag="{tag}">'), *[x for code, c in subs for x in (F.lit(f'<subfield code="{code}">'), c, F.lit("</subfield>"))], F.lit("</datafield>"))
    code = F.when((F.col("code") == "Y") & (F.col("pos") % 2 == 0), "y").otherwise(F.col("code"))
    state = F.when(F.col("pos") % 3 == 0, F.concat(F.lit("VEN$e"), "state")).otherwise(F.substring("state", 1, 3))
    vote = F.struct(
        "pos",
        "part",
        one("967", ("a", F.col("pos").cast("string")), ("b", state), ("d", code), ("e", F.when(F.col("pos") % 3 == 0, "").otherwise(F.col("grp")))).alias("x"),
    )
    rolls = P.votes(s, d).groupBy("record_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(vote)), lambda v: v["x"]), "").alias("rolls"))
    key = F.col("record_id").cast("string")
    fields = [
        one("245", ("a", F.col("title")), ("b", F.lit("b"))),
        one("269", ("a", F.concat(F.col("year").cast("string"), F.lit("0215")))),
        one("500", ("a", F.concat(F.lit("Main sponsors: "), "subject"))),
        one("856", ("u", F.concat(F.lit("d/"), key)), ("y", F.lit("Draft resolution"))),
        one("856", ("u", F.concat(F.lit("r/"), key)), ("y", F.lit("Resolution"))),
        one("996", ("b", F.lit("3"))),
    ]
    text = F.concat(F.lit("<record>"), F.concat(F.lit('<controlfield tag="001"> '), key, F.lit("</controlfield>")), *fields, "rolls", F.lit("</record>"))
    made = P.resolutions(s, d, False).join(rolls, "record_id").select("record_id", text.alias("xml"))
    return marc.from_text(made, "xml", F.lit("made"), F.lit(0))


@_query("""
SELECT CAST(record_id AS VARCHAR) AS record_id, title || ' b' AS title, year || '-02-15' AS date, subject AS main_sponsors, 'r/' || record_id AS url_resolution, 'd/' || record_id AS url_draft, '3' AS yes, n AS n_rollcall, 'https://searchlibrary.ohchr.org/record/' || record_id AS record_url
FROM res0
JOIN (SELECT record_id,
       CAST(count(*) AS INT) AS n
FROM votes
GROUP BY 1) USING (record_id)
""")
def marc_files(s, d):
    """A catalogue written to files, read back record by record and parsed."""
    at = workspace(s, "catalogue")
    marc.write(_records(s, d), at)
    return marc.parse(marc.read(s, at), "title", "date", "main_sponsors", "url_resolution", "url_draft", "yes", "n_rollcall", "record_url")


@_query("""
SELECT CAST(record_id AS VARCHAR) AS record_id,
       CAST(year AS VARCHAR) AS year,
       CAST(pos AS VARCHAR) AS seq,
       CASE WHEN pos % 3 = 0 THEN 'VEN' ELSE state[1:3] END AS iso3,
       CASE WHEN pos % 3 = 0 THEN state ELSE grp END AS country, code AS vote
FROM votes
""")
def marc_votes(s, d):
    """A row for each vote, with its record's columns."""
    return marc.votes_long(marc.parse(_records(s, d), "year", "rollcall")).select("record_id", "year", "seq", "iso3", "country", "vote")


@_query("SELECT CAST(record_id AS VARCHAR) AS record_id, count(*) AS n FROM votes GROUP BY 1")
def ingested_twice(s, d):
    """Files ingested by two runs, some of them there only for the second: every record once, and nothing else."""
    source, out = workspace(s, "harvest"), workspace(s, "ingested")
    records = _records(s, d)
    odd = F.crc32(F.col("record.controlfield")[0]["_VALUE"].cast("binary")) % 2 == 1
    marc.write(records.where(odd), f"{source}/a")
    ingest.ingest_new(s, f"{source}/*/*.xml", out)
    marc.write(records.where(~odd), f"{source}/b")
    for _ in range(2):
        ingest.ingest_new(s, f"{source}/*/*.xml", out)
    parsed = marc.parse(ingest.ingested(s, out), "n_rollcall")
    return parsed.groupBy("record_id").agg(F.sum("n_rollcall").alias("n"))


@_query("SELECT record_id, symbol, title, draft, date, year, body, vote_type, agenda_subject, agenda_item_title, yes, no, abstain, n_rollcall FROM cat")
def csv_files(s, d):
    """The catalogue as CSV and back."""
    at, rows = workspace(s, "csv"), P.catalogue(s, d).select(
        "record_id",
        "symbol",
        "title",
        "draft",
        "date",
        "year",
        "body",
        "vote_type",
        "agenda_subject",
        "agenda_item_title",
        "yes",
        "no",
        "abstain",
        "n_rollcall",
    )
    files.write_csv(rows, at, "record_id")
    return files.read_csv(s, at, rows.schema)


@_query("""
SELECT state, year,
       count(*) FILTER (WHERE code = 'Y') AS yes,
       count(*) FILTER (WHERE code = 'N') AS no,
       count(*) FILTER (WHERE code = 'A') AS abstain,
       round(count(*) FILTER (WHERE code = 'Y') * 100.0::DOUBLE / count(*), 4) AS yes_pct
FROM one
GROUP BY 1, 2
""")
def exported_composition(s, d):
    """A chart's rows exported under their title and source, and read back."""
    at, rows = workspace(s, "export"), V.composition(_one(s, d))
    files.write_export(rows, at, "Votes, by year", "Somewhere", ("state", "year"), bom=True)
    return files.read_export(s, at, rows.schema)


@_query(_SHAPES + " SELECT * FROM shp")
def geojson_shapes(s, d):
    """The map's features written as GeoJSON, read back and drawn."""
    at = workspace(s, "geojson")
    feature = F.struct(
        "id",
        F.struct("name").alias("properties"),
        F.struct(
            F.when(F.col("pos") % 2 == 0, "MultiPolygon").otherwise("Polygon").alias("type"),
            F.when(F.col("pos") % 2 == 0, F.to_json("polygons")).otherwise(F.to_json(F.col("polygons")[0])).alias("coordinates"),
        ).alias("geometry"),
    )
    rows = _features(s, d).select("pos", F.regexp_replace(F.replace(F.to_json(feature), F.lit('\\"'), F.lit('"')), r'"(\[.*\])"', "$1").alias("f"))
    text = rows.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "f"))), lambda x: x["f"]), ",").alias("f")).select(F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value"))
    text.coalesce(1).write.text(at)
    return geo.shapes(files.read_geojson(s, f"{at}/part-*"))


@_query("""
SELECT CAST(record_id AS VARCHAR) AS symbol,
       CASE WHEN record_id % 7 = 0 THEN 'missing' WHEN record_id % 11 < 5 THEN 'tiny' ELSE 'ok' END AS status
FROM res0
WHERE record_id % 3 <> 0
""")
def mirror_log(s, d):
    """What became of documents, appended to a log in two turns."""
    at = workspace(s, "mirrorlog")
    key = F.col("record_id")
    rows = P.resolutions(s, d, False).where("record_id % 3 <> 0").select(
        key.cast("string").alias("symbol"),
        ingest.outcome(key % 11 * 100, F.when(key % 7 == 0, "").otherwise("link")).alias("status"),
        F.lit("f").alias("file"),
    )
    for turn in (1, 2):
        ingest.append_log(rows.where(F.col("symbol").cast("long") % 3 == turn), at)
    return s.read.csv(at, schema=ingest.LOG).select("symbol", "status")


@_query("""
SELECT CAST(year AS VARCHAR) AS year, 'again' AS version, count(*) AS n FROM res0 r
WHERE year = 1995 OR (year = 1998 AND (SELECT count(*) FROM res0 WHERE year = 1998 AND record_id % 3 <> 0) <= 200) GROUP BY year
UNION ALL SELECT CAST(year AS VARCHAR), 'first', count(*) FROM res0
WHERE record_id % 3 <> 0 AND NOT (year = 1995 OR (year = 1998 AND (SELECT count(*) FROM res0 WHERE year = 1998 AND record_id % 3 <> 0) <= 200)) GROUP BY year
""")
def forced_years(s, d):
    """A harvest that misses records; one year is fetched again whatever it holds, another if it has a page of records at most."""
    at = workspace(s, "years") + "/rows"
    res = P.resolutions(s, d, False).select("record_id", F.col("year").cast("string").alias("year"), "title")
    ingest.store_years(res.where("record_id % 3 <> 0").withColumn("version", F.lit("first")), at)
    again, years = res.withColumn("version", F.lit("again")), res.select(F.col("year").alias("name"))
    ingest.fetch_again(again, at, years, forced=("1995",), page=1 << 40)
    ingest.fetch_again(again, at, years, forced=("1998",))
    return s.read.parquet(at).groupBy(F.col("year").cast("string").alias("year"), "version").agg(F.count("*").alias("n"))


#: Files of a run: the whole catalogue's (some hundred at 6 GB).
_IN_ONE_RUN = 20_000


@_query("""
SELECT CAST(record_id AS VARCHAR) AS record_id, CAST(1 AS BIGINT) AS times, CAST(0 AS BIGINT) AS aside FROM (SELECT DISTINCT record_id FROM votes)
UNION ALL SELECT '', 2, 1
""")
def ingested_with_damage(s, d):
    """A run that meets a file which breaks off, and one after it was mended: every record once, and the files that each run tried."""
    source, out = workspace(s, "harvest"), workspace(s, "ingested")
    marc.write(_records(s, d), f"{source}/a")
    # one file's records, so bounded like every file; names alone are listed for it
    name = ingest.listing(s, f"{source}/a/*.xml").agg(F.min_by("path", F.struct("n_bytes", "path"))).first()[0]
    whole = s.read.text(name, wholetext=True)
    cut = whole.select(F.expr("substring(value, 1, length(value) - 40)").alias("value"))
    cut.write.text(f"{source}/b")
    ingest.ingest_new(s, f"{source}/*/part-*", out, _IN_ONE_RUN)
    aside = ingest.set_aside(s, out).count()
    whole.write.mode("overwrite").text(f"{source}/b")
    ingest.ingest_new(s, f"{source}/*/part-*", out, _IN_ONE_RUN)
    good = marc.parse(ingest.ingested(s, out), "n_rollcall").select("record_id", F.lit(1).cast("long").alias("times"), F.lit(0).cast("long").alias("aside"))
    runs = ingest.ledger(s, out).agg(F.lit("").alias("record_id"), F.countDistinct("run").alias("times"), F.count_if(F.col("reason").isNotNull()).alias("aside"))
    return good.unionByName(runs.where(F.lit(aside >= 1)))


def _paged(s: SparkSession, d: str) -> str:
    """The catalogue's records as pages of 200 below a new folder: a query for each year, and one of a single subject."""
    at, key = workspace(s, "paged"), F.col("record_id").cast("string")
    res = P.resolutions(s, d, False).select("record_id", "subject", F.col("year").cast("string").alias("query"))
    res = res.unionByName(res.where("subject = '1-URGENT MACHINERY'").withColumn("query", F.lit("urgent: x/y")))
    xml = F.concat(
        F.lit('<record><controlfield tag="001">'),
        key,
        F.lit('</controlfield><datafield tag="991"><subfield code="d">'),
        "subject",
        F.lit("</subfield></datafield></record>"),
    )
    place = F.row_number().over(Window.partitionBy("query").orderBy("record_id")) - 1  # a year's records
    pages.write_pages(res.select("query", place.alias("k"), xml.alias("xml")), at).write.format("noop").mode("overwrite").save()
    return at


_PAGED = """
, q AS (SELECT CAST(year AS VARCHAR) AS query, record_id, subject FROM res0 UNION ALL SELECT 'urgent: x/y', record_id, subject FROM res0 WHERE subject = '1-URGENT MACHINERY'),
got AS (SELECT query, record_id, subject FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY record_id) AS k FROM q) WHERE k <= 4000)
"""


@_query(_PAGED + """
SELECT query, CAST(least(20, count(*) // 200 + 1) AS BIGINT) AS pages, count(*) AS records, count(*) >= 4000 AS capped
FROM got g WHERE true GROUP BY query HAVING count(*) % 200 <> 0 OR count(*) >= 4000
UNION ALL SELECT query, CAST(count(*) // 200 AS BIGINT), count(*), false FROM got GROUP BY query HAVING count(*) % 200 = 0 AND count(*) < 4000
""")
def harvest_pages(s, d):
    """Pages, records and whether the bound was met, of every query."""
    return pages.summary(pages.read_pages(s, _paged(s, d)))


@_query(_PAGED + "SELECT query, CAST(record_id AS VARCHAR) AS record_id, subject FROM got")
def harvested_records(s, d):
    """The records of all pages that count, parsed."""
    rows = pages.records(pages.read_pages(s, _paged(s, d)))
    control, field = F.col("record.controlfield")[0]["_VALUE"], F.col("record.datafield")[0]["subfield"][0]["_VALUE"]
    return rows.select(F.col("file").alias("query"), control.alias("record_id"), field.alias("subject"))


@_query("""
SELECT 'A/' || page_id AS symbol,
       CASE WHEN page_id % 7 = 0 OR html IS NULL THEN 'missing' WHEN strlen(html) < 500 THEN 'tiny' ELSE 'ok' END AS status,
       CASE WHEN page_id % 7 = 0 OR html IS NULL THEN '' WHEN strlen(html) < 500 THEN 'E/' || page_id || '.PDF' ELSE 'A_' || page_id || '.pdf' END AS file,
       CASE WHEN page_id % 7 <> 0 AND strlen(html) >= 500 THEN CAST(strlen(html) AS BIGINT) END AS n_bytes,
       CASE WHEN page_id % 7 <> 0 AND strlen(html) >= 500 THEN sha256(html) END AS sha256
FROM pages
""", prelude=False)
def mirrored_documents(s, d):
    """Every page written as a document of its own, logged, and read back byte for byte."""
    at, key = workspace(s, "documents"), F.col("page_id").cast("string")
    made = P.table(s, d, "pages").select(
        F.concat(F.lit("A/"), key).alias("symbol"),
        F.when(F.col("page_id") % 7 != 0, F.concat(F.lit("E/"), key, F.lit(".PDF"))).alias("link"),
        F.col("html").cast("binary").alias("data"),
    )
    log = documents.write_documents(made, at)
    back = documents.read_documents(s, at).select("file", "n_bytes", F.sha2("data", 256).alias("sha256"))
    return log.join(back, "file", "left").select("symbol", "status", "file", "n_bytes", "sha256")


@_query("SELECT CAST(record_id AS VARCHAR) AS record_id FROM votes", prelude=True)
def record_ids_in_text(s, d):
    """Ids straight from the text of files, in the order of files and of places in them."""
    at = workspace(s, "text")
    made = P.votes(s, d).select(F.concat(F.lit('<record><controlfield tag="001"> '), F.col("record_id").cast("string"), F.lit("</controlfield></record>")).alias("value"))
    made.write.text(at)
    return marc.record_ids(s.read.text(at))


@_query("""
, n AS (SELECT (SELECT count(*) FROM made) AS res, (SELECT count(*) FROM land) AS countries, (SELECT 2 * count(*) + 3 * count(DISTINCT iso3) FROM cast_) AS votes, (SELECT count(DISTINCT subj) FROM made WHERE subj <> '') AS subjects, (SELECT count(*) FROM cat) AS all_)
SELECT 1 AS section, CAST(res AS BIGINT) AS n_rows FROM n UNION ALL SELECT 3, CAST(countries AS BIGINT) FROM n UNION ALL SELECT 5, CAST(votes AS BIGINT) FROM n
UNION ALL SELECT 7, CAST(subjects AS BIGINT) FROM n UNION ALL SELECT 9, CAST(all_ AS BIGINT) FROM n
""")
def payload_manifest(s, d):
    """Rows of each section of the payload, from its manifest."""
    at = workspace(s, "payload")
    PL.write(P.catalogue(s, d), P.votes_long(s, d), _groups(s, d), {"A": "a"}, at)
    return parts.manifest(s, at).where("file is not null").groupBy("section").agg(F.sum("n_rows").alias("n_rows"))


def _chosen(s: SparkSession, d: str) -> exports.Chosen:
    return exports.Chosen(
        "NATION_1",
        "1-URGENT MACHINERY",
        ["NATION_1", "NATION_2", "NATION_3"],
        ("NATION_1", "NATION_2"),
        C.middle_year(C.scoped(P.resolutions(s, d, False))),
    )


@_query("""
, m AS (SELECT (min(year) + max(year) + 1) // 2 AS y FROM res0 WHERE NOT am), mu AS (SELECT * FROM res WHERE NOT am),
fl AS (SELECT subject FROM mu, m GROUP BY subject HAVING count(*) FILTER (WHERE year < y) >= 3 AND count(*) FILTER (WHERE year >= y) >= 3)
SELECT 'ovtl' AS key, (SELECT count(*) FROM (SELECT DISTINCT year, body FROM mu)) AS n, 'year,body,n' AS header
UNION ALL SELECT 'ctl', (SELECT count(DISTINCT year) FROM one WHERE state = 'NATION_1'), 'state,year,yes,no,abstain,yes_pct'
UNION ALL SELECT 'cal', (SELECT count(*) FROM sym WHERE state_a = 'NATION_1'), 'state,shared,same,agreement_pct'
UNION ALL SELECT 'ttrend', (SELECT count(DISTINCT year) FROM mu WHERE subject = '1-URGENT MACHINERY' AND yes + no + abstain > 0), 'subject,year,avg_yes_share_pct,n'
UNION ALL SELECT 'bheat', (SELECT count(DISTINCT state) FROM votes WHERE NOT am), 'state,NATION_1,NATION_2,NATION_3'
UNION ALL SELECT 'bmds', (SELECT count(*) FROM (SELECT state_a FROM sym WHERE state_b IN ('NATION_1', 'NATION_2') AND state_a NOT IN ('NATION_1', 'NATION_2') GROUP BY 1 HAVING count(*) = 2)), 'state,x,y,shared_votes'
UNION ALL SELECT 'bcoh', (SELECT count(DISTINCT grp) FROM (SELECT grp, record_id FROM one GROUP BY 1, 2 HAVING count(*) >= 2)), 'grp,agreement_index,resolutions'
UNION ALL SELECT 'biso', (SELECT count(DISTINCT state) FROM one JOIN tally USING (record_id) WHERE (y > n AND y > a) OR (n > y AND n > a) OR (a > y AND a > n)), 'state,minority_side_pct,votes'
UNION ALL SELECT 'cflips', (SELECT count(*) FROM fl), 'subject,n_early,n_late,delta_pp'
UNION ALL SELECT 'cero', (SELECT count(DISTINCT year) FROM mu), 'year,consensus_share_pct,n'
UNION ALL SELECT 'cexplorer', (SELECT count(*) FROM mu), 'record_id,title,year,body,subject,mode,am,yes,no,abstain'
""")
def exported_charts(s, d):
    """Every chart's file, written and read back: its rows, and the header line it has."""
    at, votes, res, on, out = workspace(s, "charts"), _chamber(s, d), _res(s, d), _chosen(s, d), None
    for key in exports.EXPORTS:
        made = exports.write(key, votes, res, on, at, "Somewhere")
        back = files.read_export(s, f"{at}/{key}", made.schema).agg(F.count("*").alias("n"))
        line = s.read.text(f"{at}/{key}").where(F.col("value") == ",".join(made.columns)).limit(1).select(F.col("value").alias("header"))
        one = back.join(line).select(F.lit(key).alias("key"), "n", "header")  # a row each
        out = one if out is None else out.unionByName(one)
    return out


@_query("""
, act AS (SELECT state FROM (SELECT state, count(*) AS n FROM votes WHERE NOT am GROUP BY 1 ORDER BY n DESC, state LIMIT 5)),
agr AS (SELECT state_a AS state, round(avg(same * 100.0::DOUBLE / shared), 4) AS m FROM sym GROUP BY 1),
sets AS (SELECT 'most active' AS name, state FROM act
  UNION ALL SELECT 'most agreeing', state FROM (SELECT state FROM agr ORDER BY m DESC, state LIMIT 5) UNION ALL SELECT 'most disagreeing', state FROM (SELECT state FROM agr ORDER BY m, state LIMIT 5)
  UNION ALL SELECT 'P5+', state FROM (SELECT DISTINCT state FROM votes WHERE NOT am) WHERE state IN ('NATION_4', 'NATION_5')
  UNION ALL SELECT 'AFRICAN', state FROM (SELECT DISTINCT state FROM votes WHERE NOT am AND grp = 'AFRICA'))
SELECT name, state, count(record_id) AS votes FROM sets LEFT JOIN (SELECT * FROM votes WHERE NOT am AND year BETWEEN 1996 AND 1998) USING (state) GROUP BY 1, 2 HAVING count(record_id) > 0
""")
def named_sets(s, d):
    """Votes from 1996 to 1998 in each named set."""
    votes, out = _chamber(s, d), None
    groups = P.states(s, d).select(F.col("state").alias("iso3"), F.when(F.col("grp") == "AFRICA", "AFRICAN").otherwise(F.col("grp")).alias("grp")).distinct()
    for name in ("most active", "most agreeing", "most disagreeing", "P5+", "AFRICAN"):
        own = sets.within(votes, sets.members(name, votes, groups, 5, ("NATION_4", "NATION_5")), 1996, 1998)
        one = own.groupBy("state").agg(F.count("*").alias("votes")).select(F.lit(name).alias("name"), "state", "votes")
        out = one if out is None else out.unionByName(one)
    return out


@_query("""
SELECT CAST(record_id AS VARCHAR) AS symbol, CASE WHEN record_id % 5 = 0 AND record_id % 2 = 0 THEN 'error:Timeout' WHEN record_id % 7 = 0 THEN 'missing' ELSE 'ok' END AS status,
       record_id % 5 = 0 AND record_id % 2 = 0 AS open FROM res0
""")
def mirror_state(s, d):
    """The log as a stream's state: errors first, then what came of another turn, then the first lines once more."""
    at, key = workspace(s, "logstate"), F.col("record_id")
    rows = P.resolutions(s, d, False).select(key.cast("string").alias("symbol"), "record_id")
    final = F.when(key % 7 == 0, "missing").otherwise("ok")
    first = rows.select("symbol", F.when(key % 5 == 0, "error:Timeout").otherwise(final).alias("status"), F.lit("f").alias("file"))
    second = rows.where("record_id % 5 = 0 and record_id % 2 = 1").select("symbol", final.alias("status"), F.lit("f").alias("file"))
    for lines in (first, second, first):
        ingest.append_log(lines, f"{at}/log")
        logstate.follow(s, f"{at}/log", f"{at}/state", f"{at}/checkpoint")
    return logstate.current(s, f"{at}/state").select("symbol", "status", "open")


@_query("""
SELECT state,
       round(count(*) FILTER (WHERE code <> won) * 100.0::DOUBLE / count(*), 4) AS minority_side_pct,
       count(*) AS votes
FROM one
JOIN (SELECT record_id,
       CASE WHEN y > n AND y > a THEN 'Y' WHEN n > y AND n > a THEN 'N' WHEN a > y AND a > n THEN 'A' END AS won
FROM tally) USING (record_id)
WHERE won IS NOT NULL AND year BETWEEN 1996 AND 1998
GROUP BY state
""")
def outvoted_in_years(s, d):
    """Some years' outvoted states, from a table in folders of years and buckets of resolutions."""
    stored = layout.store_votes(_chamber(s, d), workspace(s, "layout"))
    return V.outvoted(V.one_vote(stored.where("year between 1996 and 1998")))


@_query("""
SELECT CAST(record_id AS VARCHAR) AS record_id,
       CASE WHEN record_id % 3 = 0 THEN title || ', first' WHEN record_id % 3 = 1 THEN title || ', second' ELSE title || ', first' END AS title
FROM res0
""")
def first_in_file_order(s, d):
    """Records that several files have: the first file by name counts, and in it the first place."""
    at, res = workspace(s, "ordered"), P.resolutions(s, d, False).select("record_id", "title")
    third, key = F.col("record_id") % 3, F.col("record_id").cast("string")

    def put(folder: str, rows: DataFrame, note: str) -> None:
        begin = F.concat(F.lit('<record><controlfield tag="001">'), key, F.lit('</controlfield><datafield tag="245"><subfield code="a">'))
        xml = F.concat(begin, "title", F.lit(f", {note}</subfield></datafield></record>"))
        marc.write(marc.from_text(rows.select(xml.alias("xml")), "xml", F.lit("made"), F.lit(0)), f"{at}/{folder}")

    put("c", res, "third")
    put("a", res.where(third == 0), "first")
    put("b", res.where(third != 2), "second")
    put("aa", res.where(third == 2), "first")
    return marc.parse(marc.read(s, f"{at}/*"), "title")


def _indexed(s: SparkSession, d: str) -> TextIndex:
    return TextIndex.build(P.resolutions(s, d, False).select("record_id", "title", "subject"), ["title", "subject"], workspace(s, "index"))


@_query("""
SELECT 'furniture' AS text, record_id, title, subject FROM res0 WHERE contains(lower(subject), 'furniture') OR contains(lower(title), 'furniture')
UNION ALL SELECT 'no. 12', record_id, title, subject FROM res0 WHERE contains(lower(subject), 'no. 12') OR contains(lower(title), 'no. 12')
UNION ALL SELECT '77', record_id, title, subject FROM res0 WHERE contains(lower(subject), '77') OR contains(lower(title), '77')
UNION ALL SELECT 'y', record_id, title, subject FROM res0 WHERE contains(lower(subject), 'y') OR contains(lower(title), 'y')
""")
def indexed_search(s, d):
    """Searches in titles and subjects by the index, of three letters and more, of two and of one."""
    index, out = _indexed(s, d), None
    for text in ("Furniture", "No. 12", "77", "Y"):
        found = index.search(text, ["title", "subject"]).select(F.lit(text.lower()).alias("text"), "record_id", "title", "subject")
        out = found if out is None else out.unionByName(found)
    return out


@_query("""
SELECT subject, count(*) AS n FROM res0 WHERE contains(lower(subject), 'mach') GROUP BY 1 ORDER BY n DESC, subject LIMIT 5
""")
def indexed_suggestions(s, d):
    return C.suggested(_indexed(s, d).search("mach", ["subject"]), 5)


@_query("""
SELECT 'state' AS kind, state AS name FROM (SELECT DISTINCT state FROM states) WHERE contains(lower(state), 'n_1') OR contains(lower(state), 'build')
UNION ALL SELECT 'subject', subject FROM (SELECT DISTINCT subject FROM res0) WHERE contains(lower(subject), 'n_1') OR contains(lower(subject), 'build')
""")
def indexed_palette(s, d):
    """States and subjects of one palette, found by either of two texts."""
    names = P.states(s, d).select(F.lit("state").alias("kind"), F.col("state").alias("name"))
    names = names.unionByName(P.resolutions(s, d, False).select(F.lit("subject").alias("kind"), F.col("subject").alias("name"))).distinct()
    index = TextIndex.build(names, ["name"], workspace(s, "palette"))
    return index.search("n_1", ["name"]).unionByName(index.search("build", ["name"])).distinct()


@_query("""
SELECT record_id // 64 AS word, state, count(*) FILTER (WHERE code = 'Y') AS yes FROM one GROUP BY 1, 2
""")
def bit_words(s, d):
    """How many votes of yes each word of the bit-sliced matrix holds."""
    return bits.bit_matrix(_chamber(s, d), "record_id").select("word", "state", F.bit_count("y").cast("long").alias("yes"))


@_query("""
, texts AS (SELECT DISTINCT upper(title) AS text FROM res0),
names AS (SELECT DISTINCT 'NO. ' || CAST(record_id AS VARCHAR) AS name FROM res0 WHERE record_id % 50 = 0)
SELECT text, name FROM texts, names WHERE length(name) >= 6 AND contains(text, name)
""")
def names_in_titles(s, d):
    """Many names that lie in one another looked for in every title."""
    res = P.resolutions(s, d, False)
    names = res.where("record_id % 50 = 0").select(F.concat(F.lit("NO. "), F.col("record_id").cast("string")).alias("name"))
    return held(res.select(F.upper("title").alias("text")), names)


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
