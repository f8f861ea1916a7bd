"""Map geometry as column expressions: Robinson projection and simplified ring paths."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the Robinson projection: parallels' lengths and distances from the equator, every five degrees.
LENGTH = [1.0000, 0.9986, 0.9954, 0.9900, 0.9822, 0.9730, 0.9600, 0.9427, 0.9216, 0.8962, 0.8679, 0.8350, 0.7986, 0.7597, 0.7186, 0.6732, 0.6213, 0.5722, 0.5322]
DISTANCE = [0.0000, 0.0620, 0.1240, 0.1860, 0.2480, 0.3100, 0.3720, 0.4340, 0.4958, 0.5571, 0.6176, 0.6769, 0.7346, 0.7903, 0.8435, 0.8936, 0.9394, 0.9761, 1.0000]
FX, FY = 0.8487, 1.3523
WIDTH = 1000
SCALE = WIDTH / (2 * FX * math.pi)
HEIGHT = int(2 * FY * SCALE) + 2


def project(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Map x and y of degrees, by linear interpolation between parallels."""
    up = F.abs(lat)
    i = F.least(F.floor(up / 5), F.lit(17)).cast("int")
    f = (up - i * 5) / 5

    def between(table: list[float]) -> Column:
        t = F.array(*[F.lit(v) for v in table])
        return F.get(t, i) + (F.get(t, i + 1) - F.get(t, i)) * f

    x = F.lit(FX) * between(LENGTH) * F.radians(lon)
    y = F.lit(FY) * between(DISTANCE) * F.when(lat >= 0, 1.0).otherwise(-1.0)
    return F.lit(WIDTH / 2) + x * SCALE, F.lit(HEIGHT / 2) - y * SCALE


def rounded(x: Column) -> Column:
    """``x`` to one decimal place as its exact binary value lies, ties to the even digit. (A product of two parts tells
    on which side of the middle between two tenths a number is; decimal text would round 0.15 up.)"""
    tenth = F.floor(x * 10).cast("double")
    high = x * F.lit(134217729.0) - (x * F.lit(134217729.0) - x)  # the upper half of the digits
    twenty = x * 20.0
    side = (twenty - (tenth * 2.0 + 1.0)) + ((high * 20.0 - twenty) + (x - high) * 20.0)
    n = tenth + F.when((side > 0) | ((side == 0) & (tenth % 2 != 0)), 1.0).otherwise(0.0)
    return F.when((n == 0) & (x < 0), F.lit(-0.0)).otherwise(n / 10.0)


def ring_path(ring: Column, least_area: float = 3.0) -> Column:
    """The path of a ring (an array of lon, lat arrays): empty for specks and for fewer than three distinct steps."""

    def point(p: Column) -> Column:
        x, y = project(p[0], p[1])
        return F.struct(x.alias("x"), y.alias("y"))

    def spread(pts: Column, k: str) -> Column:
        return F.array_max(F.transform(pts, lambda p: p[k])) - F.array_min(F.transform(pts, lambda p: p[k]))

    def path(pts: Column) -> Column:
        short = F.transform(pts, lambda p: F.struct(rounded(p["x"]).alias("x"), rounded(p["y"]).alias("y")))
        return F.get(F.transform(F.array(short), lambda s: joined(F.filter(s, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(s, i - 1))))), F.lit(0))

    def joined(steps: Column) -> Column:
        text = F.array_join(F.transform(steps, lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))), "L")
        return F.when(F.size(steps) >= 3, F.concat(F.lit("M"), text, F.lit("Z"))).otherwise("")

    made = F.transform(F.array(F.transform(ring, point)), lambda pts: F.when(spread(pts, "x") * spread(pts, "y") < least_area, "").otherwise(path(pts)))
    return F.get(made, F.lit(0))


def shape_path(polygons: Column) -> Column:
    """All rings of all polygons, one path after another."""
    return F.array_join(F.transform(F.flatten(polygons), lambda ring: ring_path(ring)), "")


def shapes(features: DataFrame) -> DataFrame:
    """``features``: id, name, polygons and pos. iso3, name and path of every state that has a path; of several features
    of one state the last. Features without an id, and Antarctica, are left out."""
    own = features.where("id is not null and id <> '' and id <> 'ATA'").select(
        "id",
        F.coalesce("name", "id").alias("name"),
        shape_path(F.col("polygons")).alias("path"),
        "pos",
    ).where("path <> ''")
    last = own.groupBy("id").agg(F.max_by(F.struct("name", "path"), "pos").alias("x"))
    return last.select(F.col("id").alias("iso3"), "x.name", "x.path")


def dots(points: DataFrame, voters: DataFrame, drawn: DataFrame) -> DataFrame:
    """``points``: iso3, lon and lat; ``voters``: iso3 and name; ``drawn``: iso3. A dot for every voter without a shape."""
    x, y = project(F.col("lon"), F.col("lat"))
    some = points.join(voters.select("iso3", "name"), "iso3").join(drawn.select("iso3"), "iso3", "left_anti")
    return some.select("iso3", "name", rounded(x).alias("x"), rounded(y).alias("y"))


def undrawn(voters: DataFrame, *drawn: DataFrame) -> DataFrame:
    """Voters with neither a shape nor a dot."""
    out = voters.select("iso3").distinct()
    for some in drawn:
        out = out.join(some.select("iso3"), "iso3", "left_anti")
    return out


def choropleth(values: DataFrame, drawn: DataFrame, dotted: DataFrame) -> DataFrame:
    """``values``: iso3 and a value. Every shape and dot with its value (null: no votes in common): kind, iso3, value."""
    own = drawn.select("iso3", F.lit("shape").alias("kind")).unionByName(dotted.select("iso3", F.lit("dot").alias("kind")))
    return own.join(values, "iso3", "left")


def world(drawn: DataFrame, dotted: DataFrame) -> DataFrame:
    """The map's script: one row (a few hundred states) of one struct ``world``."""
    pairs = lambda df, value: df.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("iso3", value)))).alias("m"))
    names = drawn.select("iso3", "name").unionByName(dotted.select("iso3", "name"))
    one = pairs(drawn, F.col("path").alias("v")).select(F.col("m").alias("paths")).join(pairs(dotted, F.array("x", "y").alias("v")).select(F.col("m").alias("dots"))).join(pairs(names, F.col("name").alias("v")).select(F.col("m").alias("names")))
    return one.select(F.struct(F.lit(WIDTH).alias("W"), F.lit(HEIGHT).alias("H"), "paths", "dots", "names").alias("world"))
