"""Tables of polygons with holes and several parts: points inside them, and their pixels.

A polygon is a row with ``rings``, arrays of corners ``struct<x, y>``, the last one joined to the first. A place lies inside if a ray from
it crosses the edges of all rings an odd number of times, so that holes and parts need no marks of their own. Edges are rows, dealt to
horizontal bands of their polygon; a polygon has as many bands as a fourth of its edges, and a place meets those of its band alone. No ring
stands in a plan, and no task holds a polygon.

Defined cases: rings of fewer than three corners and polygons without rings hold nothing; null corners are left out; a place on a left or lower
edge is inside, on a right or upper one it isn't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.operators.joins import points_in_boxes

BOX = ("__w", "__s", "__e", "__n")


def edges(polygons: DataFrame, poly: str, rings: str = "rings") -> DataFrame:
    """``poly, x1, y1, x2, y2`` of every edge that isn't horizontal."""
    ring = polygons.select(poly, F.explode(rings).alias("r")).select(poly, F.filter("r", lambda p: p["x"].isNotNull() & p["y"].isNotNull()).alias("r")).where(F.size("r") >= 3)
    side = F.transform("r", lambda p, i: F.struct(p.alias("p"), F.get("r", (i + 1) % F.size("r")).alias("q")))
    e = ring.select(poly, F.explode(side).alias("e"))
    out = e.select(poly, *[F.col(f"e.{c}.{a}").cast("double").alias(f"{a}{k}") for k, c in ((1, "p"), (2, "q")) for a in "xy"])
    return out.where("y1 <> y2")


def banded(found: DataFrame, poly: str) -> tuple[DataFrame, DataFrame]:
    """Boxes of polygons with the number of their bands, and edges with the bands they touch."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    boxes = found.groupBy(poly).agg(
        F.min(F.least("x1", "x2")).alias("__w"), F.min(low).alias("__s"), F.max(F.greatest("x1", "x2")).alias("__e"), F.max(high).alias("__n"), F.ceil(F.count(F.lit(1)) / 4).alias("__bands")
    )
    known = found.join(boxes.select(poly, "__s", "__n", "__bands"), poly)
    dealt = known.withColumn("__band", F.explode(F.sequence(band(low), band(high)))).drop("__s", "__n", "__bands")
    return boxes, dealt


def band(y: Column) -> Column:
    """The band of its polygon that ``y`` lies in."""
    return F.least(F.floor((y - F.col("__s")) / (F.col("__n") - F.col("__s")) * F.col("__bands")), F.col("__bands") - 1).cast("long")


def crossed_at(y: Column) -> Column:
    """Where an edge meets the horizontal line at ``y``."""
    return (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0)) + F.col("x1")


def points_in(points: DataFrame, polygons: DataFrame, unique: str, x: str, y: str, poly: str, cell: float, rings: str = "rings", split: int | None = None) -> DataFrame:
    """``unique`` and ``poly`` of each point inside a polygon: an aggregate of the edges crossed to the right of it."""
    boxes, dealt = banded(edges(polygons, poly, rings), poly)
    near = points_in_boxes(points.select(unique, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")), boxes, "__x", "__y", BOX, cell, closed=True, split=split)
    placed = near.select(unique, poly, "__x", "__y", band(F.col("__y")).alias("__band"))
    crosses = ((F.col("y1") > F.col("__y")) != (F.col("y2") > F.col("__y"))) & (F.col("__x") < crossed_at(F.col("__y")))
    n = placed.join(dealt, [poly, "__band"]).where(crosses).groupBy(unique, poly).agg(F.count(F.lit(1)).alias("n"))
    return n.where("n % 2 = 1").select(unique, poly)


def masked(points: DataFrame, polygons: DataFrame, unique: str, x: str, y: str, poly: str, cell: float, rings: str = "rings", complement: bool = False) -> DataFrame:
    """Points inside any of the polygons, or with ``complement`` those in none."""
    inside = points_in(points, polygons, unique, x, y, poly, cell, rings).select(unique)
    return points.join(inside, unique, "left_anti" if complement else "left_semi")


def rasterised(polygons: DataFrame, poly: str, value: str, rank: str, west: float, north: float, step: float, rings: str = "rings") -> DataFrame:
    """``row, col, value`` of the pixels whose centres lie in polygons, on one grid from (``west``, ``north``); the highest ``rank`` covers others, of equal ranks the highest ``poly``.

    Each row of pixels that an edge crosses has a crossing; a polygon's crossings of a row, in order, are the ends of its spans.
    """
    e = edges(polygons, poly, rings)
    centre = lambda r: F.lit(north) - (r + 0.5) * step
    first, last = F.floor((F.lit(north) - F.greatest("y1", "y2")) / step - 0.5), F.ceil((F.lit(north) - F.least("y1", "y2")) / step - 0.5)
    rows = e.withColumn("row", F.explode(F.sequence(first, last))).withColumn("__y", centre(F.col("row")))
    crossings = rows.where((F.col("y1") > F.col("__y")) != (F.col("y2") > F.col("__y"))).select(poly, "row", crossed_at(F.col("__y")).alias("__x"))
    order = Window.partitionBy(poly, "row").orderBy("__x")
    spans = crossings.withColumns({"__k": F.row_number().over(order), "__to": F.lead("__x").over(order)}).where("__k % 2 = 1 AND __to > __x")
    at = lambda c: (F.col(c) - west) / step - 0.5
    middle = F.lit(west) + (F.col("col") + 0.5) * step
    pixels = spans.withColumn("col", F.explode(F.sequence(F.floor(at("__x")), F.ceil(at("__to"))))).where((middle >= F.col("__x")) & (middle < F.col("__to")))
    named = pixels.join(polygons.select(poly, value, rank), poly)
    top = F.max_by(value, F.struct(rank, poly)).alias("value")
    return named.groupBy("row", "col").agg(top)
