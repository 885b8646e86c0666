"""Points in polygons: a grid-cell equi-join, a box test, then ray casting in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.constants import CELL, EDGE_MARGIN
from placeforge.functions.columns import cell


def ring_contains(xs: Column, ys: Column, lng: Column, lat: Column) -> Column:
    """Half-open crossing test of one closed ring."""
    n = F.size(xs)

    def cross(acc: Column, i: Column) -> Column:
        x1, y1 = F.get(xs, i), F.get(ys, i)
        x2, y2 = F.get(xs, i + 1), F.get(ys, i + 1)
        hit = ((y1 > lat) != (y2 > lat)) & (lng < (x2 - x1) * (lat - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1)
        return acc != F.coalesce(hit, F.lit(False))

    return F.aggregate(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), F.lit(False), cross)


def depth(rings: Column, lng: Column, lat: Column) -> Column:
    """Outer rings around a point less holes around it."""
    return F.aggregate(
        rings, F.lit(0), lambda acc, r: acc + F.when(ring_contains(r["xs"], r["ys"], lng, lat), F.when(r["hole"], -1).otherwise(1)).otherwise(0)
    )


def with_cells(polygons: DataFrame, size: float = CELL) -> DataFrame:
    """polygons, once for each grid cell that their box touches."""
    span = lambda a, b: F.explode(F.sequence(cell(F.col(a), size), cell(F.col(b), size)))
    return polygons.withColumn("cx", span("west", "east")).withColumn("cy", span("south", "north"))


def locate(points: DataFrame, polygons: DataFrame, key: str = "id") -> DataFrame:
    """key, code: the first polygon (in file order) around each point (key, lat, lng); points outside are left out.

    Polygons are far fewer than points; whether they are broadcast follows from their size.
    """
    p = points.select(key, "lat", "lng", cell(F.col("lng")).alias("cx"), cell(F.col("lat")).alias("cy"))
    j = p.join(with_cells(polygons), ["cx", "cy"])
    j = j.filter(F.col("lng").between(F.col("west"), F.col("east")) & F.col("lat").between(F.col("south"), F.col("north")))
    j = j.filter(depth(F.col("rings"), F.col("lng"), F.col("lat")) > 0)
    return j.groupBy(key).agg(F.min_by("code", "slot").alias("code"))


def well_inside(points: DataFrame, polygons: DataFrame, margin: float = EDGE_MARGIN) -> DataFrame:
    """The rows of points (id, lat, lng, code) whose cross of five points all lie in `code`."""
    arms = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0.0, 0.0), (margin, 0.0), (-margin, 0.0), (0.0, margin), (0.0, -margin))])
    cross = points.select("id", F.col("code").alias("own"), F.posexplode(arms).alias("arm", "d"), "lat", "lng")
    cross = cross.select("own", F.struct("id", "arm").alias("k"), (F.col("lat") + F.col("d.a")).alias("lat"), (F.col("lng") + F.col("d.b")).alias("lng"))
    at = locate(cross, polygons, "k").select(F.col("k.id").alias("id"), "code")
    good = at.groupBy("id", "code").agg(F.count(F.lit(1)).alias("n")).filter("n = 5").select("id", "code")
    return points.join(good, ["id", "code"], "left_semi")
