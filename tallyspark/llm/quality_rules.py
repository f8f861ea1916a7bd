"""Quality rules in DataFrame operations alone: base statistics of whole texts, and rejection of
multivariate outliers by minimum-covariance-determinant (MCD) estimates per language and source.

Statistics are arrays' functions inside a row: texts are never exploded. The estimates come from
concentration steps: distances under the present estimate, the share ``SUBSET`` of a group's rows
that lie nearest (by a histogram of distances, so no group is sorted or gathered), and their mean
and covariance as the next estimate; of two starts that with the least determinant stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_name, materialise, workspace

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Transformed statistics and the standard deviation added to each: what a group of like texts may differ by.
VECTOR = {"x0": 0.35, "x1": 0.35, "x2": 0.045, "x3": 0.05, "x4": 0.12}
#: Share of a group's rows that an estimate rests on, steps, rows a group needs (smaller ones are put together).
SUBSET, STEPS, GROUP_ROWS = 0.7, 4, 60
#: Squared distances (scaled so that half of a normal group lies below the median of chi-square with five
#: degrees of freedom) beyond which a row is rejected: its upper 1e-5 quantile.
CUTOFF, MEDIAN = 30.9, 4.351
#: Rows (of under 400 bytes) up to which a table of estimates is broadcast. Beyond, the vectors meet it in a join
#: whose key is salted so many ways, as no group's vectors may meet in one task.
BROADCAST_ROWS, SALTS = 10_000, 64
VERDICTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "base_failed", "distance", "kept"]
_PER_E = 40  # buckets of the distances' histogram for each factor of e


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(windows: Column) -> Column:
    """Words in the windows (three words each) that are found twice or more."""

    def repeated(s: Column) -> Column:
        again = F.filter(s, lambda e, j: (e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]))
        at = F.sort_array(F.transform(again, lambda e: e["i"]))
        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total"))
        step = lambda acc, i: F.struct(i.alias("last"), (acc["total"] + F.least(F.lit(3), i - acc["last"])).alias("total"))
        return F.aggregate(at, zero, step, lambda acc: acc["total"])

    return _let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)


def base_statistics(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper and base_failed
    (names after ``prefix``); a null text has no words."""
    text, w, h, n = (free_name(docs, f"{x}_work") for x in ("text", "words", "windows", "lines"))
    out = docs.withColumn(text, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    out = out.withColumns({w: F.filter(F.split(F.col(text), r"[ \t-\r]+"), lambda x: x != ""), n: F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(r"[^ \t-\r]"))})
    # each word is hashed once, and each window of three hashes
    third = lambda words: F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)))
    hashed = F.transform(F.col(w), lambda x: F.xxhash64(x))
    out = out.withColumn(h, F.when(F.size(w) >= 3, _let(hashed, third)).otherwise(F.array().cast("array<bigint>")))
    out = out.withColumns({
        f"{prefix}n_words": F.size(w).cast("long"),
        f"{prefix}word_chars": F.length(F.array_join(w, "")).cast("long"),
        f"{prefix}n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        f"{prefix}n_dup_lines": (F.size(n) - F.size(F.array_distinct(n))).cast("long"),
        f"{prefix}n_repeat_words": F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(F.col(h))).cast("long"),
        f"{prefix}n_upper": F.regexp_count(text, F.lit("[A-ZÀÂÄÇÈÉÊËÎÏÔÖÙÛÜÑÁÍÓÚ]")).cast("long"),
    }).drop(text, w, h, n)
    words, again = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return out.withColumn(f"{prefix}base_failed", (words < 50) | (100 * again > 50 * words))


def _vector(p: str) -> dict[str, Column]:
    chars = F.greatest(F.col(f"{p}word_chars"), F.lit(1)).cast("double")
    words = F.greatest(F.col(f"{p}n_words"), F.lit(1)).cast("double")
    return {
        "x0": F.log1p(F.col(f"{p}n_words").cast("double")),
        "x1": F.log(F.col(f"{p}word_chars") / words + 1) * 3,
        "x2": F.sqrt(F.col(f"{p}n_symbols") / chars),
        "x3": F.sqrt(F.col(f"{p}n_upper") / chars),
        "x4": F.sqrt(F.col(f"{p}n_repeat_words") / words),
    }


_X = list(VECTOR)
_PAIRS = [(i, j) for i in range(len(_X)) for j in range(i + 1)]


def _sized(params: DataFrame, few: bool) -> DataFrame:
    """A written table, marked for broadcast if its rows are known to be few."""
    return F.broadcast(params) if few else params


def _meet(stats: DataFrame, params: DataFrame, few: bool, *keys: str) -> DataFrame:
    """``stats`` (with a column salt) joined to ``params``, a written table of a row for each value of ``keys``."""
    if few:
        return stats.join(F.broadcast(params), [*keys])
    salted = params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return stats.join(salted.hint("merge"), [*keys, "salt"])


def _distance(rows: DataFrame) -> DataFrame:
    """The squared Mahalanobis distance d2 under the columns m<i> and l<i><j> (a Cholesky factor), by forward substitution."""
    for i, x in enumerate(_X):
        rest = reduce(lambda a, b: a - b, [F.col(f"l{i}{j}") * F.col(f"z{j}") for j in range(i)], F.col(x) - F.col(f"m{i}"))
        rows = rows.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, len(_X))), F.col("z0") * F.col("z0"))).drop(*[f"z{i}" for i in range(len(_X))])


def _factor(params: DataFrame) -> DataFrame:
    """From m<i> and c<i><j>: the Cholesky factor l<i><j> of the covariance with VECTOR's spread added, and log_det."""
    for i, j in _PAIRS:
        done = [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)]
        rest = reduce(lambda a, b: a - b, done, F.col(f"c{i}{j}") + (VECTOR[_X[i]] ** 2 if i == j else 0.0))
        params = params.withColumn(f"l{i}{j}", F.round(F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}{j}"), 9))
    return params.withColumn("log_det", sum((F.log(f"l{i}{i}") for i in range(1, len(_X))), F.log("l00"))).drop(*[f"c{i}{j}" for i, j in _PAIRS])


def _moments(rows: DataFrame, *keys: str) -> DataFrame:
    mean = [F.round(F.avg(x), 9).alias(f"m{i}") for i, x in enumerate(_X)]
    cross = [F.round(F.covar_pop(_X[i], _X[j]), 9).alias(f"c{i}{j}") for i, j in _PAIRS]
    return _factor(rows.groupBy(*keys).agg(*mean, *cross))


def _bucket(d2: Column) -> Column:
    return F.floor(F.log(d2 + 1e-6) * _PER_E).cast("int")


def _shares(rows: DataFrame, share: float, *keys: str) -> DataFrame:
    """The bucket of d2 up to which at least ``share`` of each key's rows lie: column cut."""
    counts = rows.groupBy(*keys, _bucket(F.col("d2")).alias("b")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)  # over a few hundred buckets for each key, not over rows
    done = counts.withColumn("below", F.sum("n").over(w.orderBy("b"))).withColumn("all", F.sum("n").over(w))
    return done.where(F.col("below") >= F.col("all") * share).groupBy(*keys).agg(F.min("b").alias("cut"))


def outlier_bounds(stats: DataFrame, at: str, few: bool) -> DataFrame:
    """``stats``: group, x0.. and salt (a number below SALTS) of the rows to learn from; ``few``: whether twice the groups are at
    most BROADCAST_ROWS. Returns for each group m<i>, l<i><j> and ``scale``."""
    middle = [F.round(F.percentile_approx(x, 0.5, 10000), 2).alias(f"m{i}") for i, x in enumerate(_X)]
    near = materialise(stats.groupBy("grp").agg(*middle), f"{at}/middle")
    off = _meet(stats, near, few, "grp").groupBy("grp").agg(*[F.round(1.4826 * F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 10000), 2).alias(f"s{i}") for i, x in enumerate(_X)])
    robust = near.join(off, "grp").select("grp", *[f"m{i}" for i in range(len(_X))], *[(F.col(f"s{i}") * F.col(f"s{i}") if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _PAIRS])
    starts = _factor(robust).withColumn("start", F.lit(0)).unionByName(_moments(stats, "grp").withColumn("start", F.lit(1)))
    params = materialise(starts, f"{at}/params0")
    for step in range(STEPS):
        far = _distance(_meet(stats, params, few, "grp"))
        cuts = materialise(_shares(far, SUBSET, "grp", "start"), f"{at}/cuts{step}")
        core = _meet(far, cuts, few, "grp", "start").where(_bucket(F.col("d2")) <= F.col("cut"))
        params = materialise(_moments(core, "grp", "start"), f"{at}/params{step + 1}")
    best = Window.partitionBy("grp").orderBy("log_det", "start")  # two rows for each group
    params = params.withColumn("k", F.row_number().over(best)).where("k = 1").drop("k", "start", "log_det")
    params = materialise(params, f"{at}/best")
    half = _shares(_distance(_meet(stats, params, few, "grp")), 0.5, "grp").select("grp", (F.lit(MEDIAN) / F.exp((F.col("cut") + 0.5) / _PER_E)).alias("scale"))
    return materialise(params.join(half, "grp").withColumn("scale", F.least("scale", F.lit(1.0))), f"{at}/bounds")


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with the base statistics, ``distance`` and ``kept``. A carried column of one of their names
    (in any case) gives way to them.

    Null and empty texts have no words and fail the base rules, as do very short ones; their distance is that from their group, if it
    has an estimate, else null. A text of any length is judged whole. An empty table gives no rows.

    A row is kept if it passes the base rules and isn't an outlier among the rows of its language and source
    that pass. Groups of under GROUP_ROWS rows (a null language or source is one of its own) are judged with
    the other small ones of their language, then with all small ones; too few of these are judged by an estimate
    over all rows of the table that pass, however many.
    Repeated rows count each time.
    """
    at = workspace(docs.sparkSession, "quality")
    taken = {x.lower() for x in VERDICTS}
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in taken]
    own = [f"carried{i}" for i in range(len(carry))]
    src = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(carry, own, strict=True)], F.col(f"`{text_col}`").alias("text"), F.coalesce(F.concat(F.lit("="), f"`{lang_col}`"), F.lit("-")).alias("lang"), F.coalesce(F.concat(F.lit("="), f"`{source_col}`"), F.lit("-")).alias("source"))
    held = base_statistics(src, "text").drop("text")
    held = materialise(held.withColumns(_vector("")), f"{at}/statistics")
    passed = held.where("not base_failed").select("lang", "source", *_X)
    sizes = passed.groupBy("lang", "source").agg(F.count("*").alias("n"))
    rest = sizes.where(F.col("n") < GROUP_ROWS).groupBy("lang").agg(F.sum("n").alias("in_lang"))
    named = sizes.join(rest, "lang", "left").select("lang", "source", "n", F.when(F.col("n") >= GROUP_ROWS, F.concat_ws("\x01", F.lit("1"), "lang", "source")).when(F.col("in_lang") >= GROUP_ROWS, F.concat_ws("\x01", F.lit("2"), "lang")).otherwise(F.lit("3")).alias("grp"))
    named = materialise(named, f"{at}/groups")
    few = 2 * named.count() <= BROADCAST_ROWS  # no table of estimates has more rows: two starts for each group
    passed = passed.withColumn("salt", (F.rand() * SALTS).cast("int"))
    stats = _meet(passed, named, few, "lang", "source").select("grp", *_X, "salt")
    few = named.where("grp = '3'").agg(F.sum("n")).first()[0] or 0
    if 0 < few < GROUP_ROWS:  # the last pool is too small to learn from: it is judged by the whole table
        stats = stats.where("grp <> '3'").unionByName(passed.select(F.lit("3").alias("grp"), *_X, "salt"))
    stats = materialise(stats, f"{at}/vectors")
    bounds = outlier_bounds(stats, at, few)
    # no aggregation follows these: adaptive execution splits a hot group where they are shuffled
    far = _distance(held.join(_sized(named, few).drop("n"), ["lang", "source"], "left").join(_sized(bounds, few), "grp", "left"))
    far = far.withColumn("distance", F.round(F.col("d2") * F.col("scale"), 6))
    far = far.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF))
    return far.select(*[F.col(o).alias(c) for o, c in zip(own, carry, strict=True)], *VERDICTS)


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that judge() keeps, with its own columns."""
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    name = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    good = judge(numbered, name[text_col], name[lang_col], name[source_col]).where("kept")
    return good.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
