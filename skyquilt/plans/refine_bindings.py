"""Polygons, refinement, lines, registration and draws, bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyquilt.operators import aggregates as A
from skyquilt.operators import iterative as I
from skyquilt.operators import joins as J
from skyquilt.operators import lines as L
from skyquilt.operators import polygons as G
from skyquilt.operators import rasters as R
from skyquilt.operators import refine as RF
from skyquilt.plans.bindings import _RASTER, _pixels, query, r6, raster, t

# ---------------------------------------------------------------- polygons

#: A diamond with a square hole and, away from it, a second part for each supplier; customers are points.
_POLYS = """polys AS (SELECT s_suppkey AS poly, s_nationkey AS value, s_suppkey * 100.0 AS cx, (s_suppkey * 7919) % 1000 * 1.0 AS cy, 150.0 + s_suppkey % 200 AS r FROM supplier),
    edges AS (
        SELECT poly, value, cx + ax * r AS x1, cy + ay * r AS y1, cx + bx * r AS x2, cy + by_ * r AS y2 FROM polys,
            (VALUES (1.0, 0.0, 0.0, 1.0), (0.0, 1.0, -1.0, 0.0), (-1.0, 0.0, 0.0, -1.0), (0.0, -1.0, 1.0, 0.0),
                    (-0.25, -0.25, 0.25, -0.25), (0.25, -0.25, 0.25, 0.25), (0.25, 0.25, -0.25, 0.25), (-0.25, 0.25, -0.25, -0.25),
                    (1.5, 0.5, 2.0, 1.5), (2.0, 1.5, 1.25, 1.25), (1.25, 1.25, 1.5, 0.5)) AS v(ax, ay, bx, by_))"""
_PLACES = "places AS (SELECT c_custkey, (c_custkey * 6.5)::DOUBLE AS x, ((c_custkey * 613) % 1000 + 0.25)::DOUBLE AS y FROM customer)"
_RINGS = [
    [(1.0, 0.0), (0.0, 1.0), (-1.0, 0.0), (0.0, -1.0)],
    [(-0.25, -0.25), (0.25, -0.25), (0.25, 0.25), (-0.25, 0.25)],
    [(1.5, 0.5), (2.0, 1.5), (1.25, 1.25)],
]


def _polygons(s, d):
    k = F.col("s_suppkey")
    p = t(s, d, "supplier").select(k.alias("poly"), F.col("s_nationkey").alias("value"), (k * 100.0).alias("cx"), ((k * 7919) % 1000 * 1.0).alias("cy"), (150.0 + k % 200).alias("r"))
    corner = lambda ax, ay: F.struct((F.col("cx") + F.lit(ax) * F.col("r")).alias("x"), (F.col("cy") + F.lit(ay) * F.col("r")).alias("y"))
    return p.select("poly", "value", F.array(*[F.array(*[corner(*c) for c in ring]) for ring in _RINGS]).alias("rings"))


def _places(s, d):
    k = F.col("c_custkey")
    return t(s, d, "customer").select("c_custkey", (k * 6.5).alias("x"), ((k * 613) % 1000 + 0.25).alias("y"))


_CROSSED = "(y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1"


@query(f"WITH {_POLYS}, {_PLACES} SELECT c_custkey, poly FROM places JOIN edges ON {_CROSSED} GROUP BY 1, 2 HAVING count(*) % 2 = 1")
def places_in_polygons(s, d):
    """F-7, J-4: points in a table of polygons with holes and several parts."""
    return G.points_in(_places(s, d), _polygons(s, d), "c_custkey", "x", "y", "poly", 256.0)


@query(f"WITH {_POLYS}, {_PLACES}, i AS (SELECT c_custkey, poly FROM places JOIN edges ON {_CROSSED} GROUP BY 1, 2 HAVING count(*) % 2 = 1) SELECT c_custkey, x, y FROM places WHERE c_custkey NOT IN (SELECT c_custkey FROM i)")
def places_outside(s, d):
    """F-7: the complement, places in no polygon."""
    return G.masked(_places(s, d), _polygons(s, d), "c_custkey", "x", "y", "poly", 256.0, complement=True).select("c_custkey", "x", "y")


@query(
    f"""WITH {_POLYS}, boxes AS (SELECT poly, value, min(least(x1, x2)) AS w, max(greatest(x1, x2)) AS e, min(least(y1, y2)) AS s, max(greatest(y1, y2)) AS n FROM edges GROUP BY 1, 2),
    rows_ AS (SELECT poly, value, w, e, unnest(range(CAST(floor((2000 - n) / 20) AS BIGINT) - 1, CAST(floor((2000 - s) / 20) AS BIGINT) + 2)) AS row FROM boxes),
    px AS (SELECT poly, value, row, unnest(range(CAST(floor(w / 20) AS BIGINT) - 1, CAST(floor(e / 20) AS BIGINT) + 2)) AS col FROM rows_),
    c AS (SELECT px.poly, px.value, row, col FROM (SELECT *, (col + 0.5) * 20.0 AS x, 2000.0 - (row + 0.5) * 20.0 AS y FROM px) AS px JOIN edges ON px.poly = edges.poly AND {_CROSSED} GROUP BY ALL HAVING count(*) % 2 = 1)
    SELECT row, col, arg_max(value, (value % 5, poly)) AS value FROM c GROUP BY 1, 2"""
)
def rasterised_polygons(s, d):
    """K-8: all polygons as pixels of one grid, of all rows and columns that they reach; the highest rank covers others."""
    p = _polygons(s, d).withColumn("rank", F.col("value") % 5)
    return G.rasterised(p, "poly", "value", "rank", 0.0, 2000.0, 20.0)


@query(
    """WITH a AS (SELECT s_suppkey, s_suppkey * 100.0 AS w, s_suppkey * 7.0 AS s, s_suppkey * 100.0 + CASE WHEN s_suppkey % 50 = 0 THEN 100000 ELSE 40 + s_suppkey % 9 END AS e, s_suppkey * 7.0 + 60 AS n FROM supplier),
    b AS (SELECT p_partkey, p_partkey * 5.0 AS w2, (p_partkey * 3) % 7000 * 1.0 AS s2, p_partkey * 5.0 + CASE WHEN p_partkey % 500 = 0 THEN 20000 ELSE p_size END AS e2, (p_partkey * 3) % 7000 + 50.0 + p_size AS n2 FROM part)
    SELECT s_suppkey, p_partkey FROM a JOIN b ON NOT (e2 < w OR w2 > e OR n2 < s OR s2 > n)"""
)
def boxes_of_any_size(s, d):
    """J-4, J-5: boxes from a few units to a hundred thousand wide; each is dealt to a handful of cells."""
    k, p = F.col("s_suppkey"), F.col("p_partkey")
    a = t(s, d, "supplier").select(k, (k * 100.0).alias("w"), (k * 7.0).alias("s"), (k * 100.0 + F.when(k % 50 == 0, 100000).otherwise(40 + k % 9)).alias("e"), (k * 7.0 + 60).alias("n"))
    y = (p * 3) % 7000
    b = t(s, d, "part").select(p, (p * 5.0).alias("w2"), (y * 1.0).alias("s2"), (p * 5.0 + F.when(p % 500 == 0, 20000).otherwise(F.col("p_size"))).alias("e2"), (y + 50.0 + F.col("p_size")).alias("n2"))
    return J.overlapping_boxes(a, b, ("w", "s", "e", "n"), ("w2", "s2", "e2", "n2"), 50.0, split=10_000).select("s_suppkey", "p_partkey")


# ---------------------------------------------------------------- refinement

#: Orders as pixels with a guide (mean price) and shares of two priorities.
_BANDS = """px AS (SELECT c_nationkey::VARCHAR AS tile, (o_custkey // 100)::BIGINT AS row, (dayofyear(o_orderdate) // 7)::BIGINT AS col, round(avg(o_totalprice) / 500000, 4) AS g,
    round(avg((o_orderpriority IN ('1-URGENT', '2-HIGH'))::INT), 4) AS p0, round(avg((o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED'))::INT), 4) AS p1 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)"""


def _bands(s, d):
    o = t(s, d, "orders").join(t(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    share = lambda *names: F.round(F.avg(F.col("o_orderpriority").isin(*names).cast("int")), 4)
    return o.groupBy(F.col("c_nationkey").cast("string").alias("tile"), F.floor(F.col("o_custkey") / 100).alias("row"), F.floor(F.dayofyear("o_orderdate") / 7).cast("long").alias("col")).agg(
        F.round(F.avg("o_totalprice") / 500000, 4).alias("g"), share("1-URGENT", "2-HIGH").alias("p0"), share("3-MEDIUM", "4-NOT SPECIFIED").alias("p1")
    )


_NEAR = "a.tile = b.tile AND abs(a.row - b.row) <= k AND abs(a.col - b.col) <= k"
_GUIDED = f"""radii AS (SELECT unnest([1, 4]) AS k),
    m AS (SELECT k, a.tile, a.row, a.col, avg(b.g) AS i, avg(b.g * b.g) - avg(b.g) * avg(b.g) AS v, avg(b.p0) AS m0, avg(b.g * b.p0) - avg(b.g) * avg(b.p0) AS c0, avg(b.p1) AS m1, avg(b.g * b.p1) - avg(b.g) * avg(b.p1) AS c1
        FROM px a JOIN px b ON a.tile = b.tile JOIN radii ON {_NEAR} GROUP BY ALL),
    l AS (SELECT k, tile, row, col, c0 / (v + 0.01) AS a0, m0 - c0 / (v + 0.01) * i AS b0, c1 / (v + 0.01) AS a1, m1 - c1 / (v + 0.01) * i AS b1 FROM m)
    SELECT k AS radius, a.tile, a.row, a.col, round(avg(b.a0) * a.g + avg(b.b0), 5) + 0.0 AS p0, round(avg(b.a1) * a.g + avg(b.b1), 5) + 0.0 AS p1 FROM px a JOIN l b ON {_NEAR} GROUP BY k, a.tile, a.row, a.col, a.g"""


@query(f"WITH {_BANDS}, {_GUIDED}")
def guided_refinement(s, d):
    """K-12: shares smoothed within two radii, but not across edges of the guide."""
    b = I._saved(_bands(s, d))
    out = [RF.guided_filter(b, ["g"], ["p0", "p1"], k, 0.01).withColumn("radius", F.lit(k)) for k in (1, 4)]
    r5 = lambda c: (F.round(c, 5) + 0.0).alias(c)
    return out[0].unionByName(out[1]).select("radius", "tile", "row", "col", r5("p0"), r5("p1"))


@query(f"WITH {_RASTER}, radii AS (SELECT unnest([2, 9]) AS k) SELECT k AS radius, a.tile, a.row, a.col, round(avg(b.v), 6) + 0.0 AS v FROM px a JOIN px b ON a.tile = b.tile JOIN radii ON {_NEAR} GROUP BY ALL")
def box_smoothed(s, d):
    """K-19, K-20: means of squares of two radii, by cumulative sums."""
    p = I._saved(raster(s, d))
    out = [RF.box_means(p, "v", k).withColumn("radius", F.lit(k)) for k in (2, 9)]
    return out[0].unionByName(out[1]).select("radius", "tile", "row", "col", r6(F.col("v"), "v"))


_ROUND = """n{k} AS (SELECT tile, label, avg(row) AS y, avg(col) AS x, avg(v) AS w FROM l{k} GROUP BY ALL),
    l{j} AS (SELECT p.tile, p.row, p.col, p.v, coalesce(arg_min(c.label, ((p.v - c.w) * (p.v - c.w) + ((p.row - c.y) * (p.row - c.y) + (p.col - c.x) * (p.col - c.x)) * 0.0625, c.label)), p.label) AS label
        FROM l{k} p LEFT JOIN n{k} c ON p.tile = c.tile AND abs(floor(p.row / 4) - floor(c.y / 4)) <= 1 AND abs(floor(p.col / 4) - floor(c.x / 4)) <= 1 GROUP BY p.tile, p.row, p.col, p.v, p.label)"""


@query(f"WITH {_RASTER}, l0 AS (SELECT tile, row, col, v::DOUBLE AS v, (row // 4) * 1048576 + col // 4 AS label FROM px), {', '.join(_ROUND.format(k=k, j=k + 1) for k in (0, 1))} SELECT tile, row, col, label FROM l2")
def superpixel_labels(s, d):
    """K-12: two rounds of local k-means over pixels and places."""
    return RF.superpixels(raster(s, d), ["v"], 4, 1.0, 2).select("tile", "row", "col", "label")


@query()
def superpixel_classes(s, d):
    """K-12, A-45: connected superpixels, and their classes by mean, by vote and by weighted mean."""
    b = I._saved(_bands(s, d))
    seg = RF.segments(b.drop("p0", "p1"), ["g"], 4, 0.5, 3, 5).select("tile", "row", "col", "segment")
    px = I._saved(seg.join(b, ["tile", "row", "col"]).select("segment", "p0", "p1"))
    long = px.select("segment", F.explode(F.array(*[F.struct(F.lit(k).alias("cls"), p.alias("p")) for k, p in enumerate((F.col("p0"), F.col("p1"), 1 - F.col("p0") - F.col("p1")))])).alias("c"))
    votes = A.segment_votes(long.select("segment", "c.cls", "c.p"), "segment", "cls", "p", ["mean_prob", "majority_vote", "weighted_mean"])
    return px.groupBy("segment").agg(F.count("*").alias("pixels")).join(votes, "segment")


@query(
    """WITH x AS (SELECT l_suppkey AS seg, l_linenumber AS cls, l_discount * 10 AS p FROM lineitem), a AS (SELECT seg, cls, round(sum(p * p) / nullif(sum(p), 0), 9) AS w, round(avg(p), 9) AS m FROM x GROUP BY 1, 2)
    SELECT seg, (SELECT cls FROM a b WHERE b.seg = a.seg ORDER BY w DESC, cls LIMIT 1) AS weighted, (SELECT cls FROM a b WHERE b.seg = a.seg ORDER BY m DESC, cls LIMIT 1) AS mean FROM a GROUP BY seg"""
)
def segment_means(s, d):
    """A-45: the class of the highest mean, and of the highest mean weighted by confidence, in each segment."""
    x = t(s, d, "lineitem").select(F.col("l_suppkey").alias("seg"), F.col("l_linenumber").alias("cls"), (F.col("l_discount") * 10).alias("p"))
    w = A.segment_vote(x, "seg", "cls", "p", "weighted_mean").withColumnRenamed("cls", "weighted")
    return w.join(A.segment_vote(x, "seg", "cls", "p", "mean_prob").withColumnRenamed("cls", "mean"), "seg")


# ---------------------------------------------------------------- lines


@query()
def price_contours(s, d):
    """K-13: contours of mean prices as ordered lines, closed and open."""
    got = L.contours(_bands(s, d), "g", 0.3)
    return got.select("tile", "line", "seq", r6(F.col("y"), "y"), r6(F.col("x"), "x"), "closed")


_SQUARES = """sq AS (SELECT a.tile, a.row, a.col, a.g AS tl, b.g AS tr, c.g AS br, e.g AS bl FROM px a JOIN px b ON b.tile = a.tile AND b.row = a.row AND b.col = a.col + 1
    JOIN px c ON c.tile = a.tile AND c.row = a.row + 1 AND c.col = a.col + 1 JOIN px e ON e.tile = a.tile AND e.row = a.row + 1 AND e.col = a.col)"""


@query(
    f"""WITH {_BANDS}, {_SQUARES}, e AS (
        SELECT tile, 'h' AS kind, row AS r, col AS c, row + 0.0 AS y, col + (0.3 - tl) / (tr - tl) AS x FROM sq WHERE (tl > 0.3) <> (tr > 0.3) UNION SELECT tile, 'h', row + 1, col, row + 1.0, col + (0.3 - bl) / (br - bl) FROM sq WHERE (bl > 0.3) <> (br > 0.3)
        UNION SELECT tile, 'v', row, col, row + (0.3 - tl) / (bl - tl), col + 0.0 FROM sq WHERE (tl > 0.3) <> (bl > 0.3) UNION SELECT tile, 'v', row, col + 1, row + (0.3 - tr) / (br - tr), col + 1.0 FROM sq WHERE (tr > 0.3) <> (br > 0.3))
    SELECT tile, count(*) AS vertices, round(sum(y), 4) AS y, round(sum(x), 4) AS x FROM e GROUP BY 1"""
)
def contour_vertices(s, d):
    """K-13: how many vertices the contours of a tile have, and where they lie together."""
    return L.contours(_bands(s, d), "g", 0.3).groupBy("tile").agg(F.count("*").alias("vertices"), F.round(F.sum("y"), 4).alias("y"), F.round(F.sum("x"), 4).alias("x"))


@query()
def water_skeleton(s, d):
    """K-13: skeletons of the set pixels."""
    return L.skeleton(_pixels(s, d).where("mask = 1"))


# ---------------------------------------------------------------- registration

_SHIFTS = [(1, -1), (-2, 1), (0, 0)]


@query(
    """WITH px AS (SELECT c_mktsegment AS tile, max(o_custkey // 5) + 1 AS h, max(dayofyear(o_orderdate) // 6) + 1 AS w FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    SELECT tile, slot::INT AS slot, dy::DOUBLE AS dy, dx::DOUBLE AS dx, (h * w)::BIGINT AS pixels, true AS alike FROM px, (VALUES (0, 0, 0), (1, -1, 1), (2, 2, -1), (3, 0, 0)) AS v(slot, dy, dx)"""
)
def registered_frames(s, d):
    """K-2, K-3, K-5: smooth frames moved by whole pixels are laid on the first again: shifts within 0.05 of those planted, values as in the anchor."""
    o = t(s, d, "orders").join(t(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("tile")), "o_custkey")
    b = o.groupBy("tile", F.floor(F.col("o_custkey") / 5).alias("row"), F.floor(F.dayofyear("o_orderdate") / 6).cast("long").alias("col")).agg(F.sum("o_totalprice").alias("g"))
    lines = I._saved(RF.line_means(b, "g", 3))
    top = I._saved(lines.groupBy("tile").agg(F.max(F.array_max("line")).alias("top")))
    wide = lines.join(top, "tile").withColumn("g", F.transform("line", lambda v: v / F.col("top")))
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("slot"), F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for k, (dy, dx) in enumerate([(0, 0), *_SHIFTS])])).alias("s")
    turned = lambda v, w, k: F.concat(F.slice(v, w - k + 1, k), F.slice(v, F.lit(1), w - k))
    frames = wide.select("*", at).select("tile", "s.slot", F.pmod(F.col("row") + F.col("s.dy"), F.col("h")).alias("row"), turned(F.col("g"), F.col("w"), F.pmod(F.col("s.dx"), F.col("w"))).alias("g"))
    got = R.coregistered_lines(frames, "g", 0)
    apart = F.array_max(F.transform(F.arrays_zip("line", "fixed"), lambda x: F.abs(x["line"] - x["fixed"])))
    near = lambda c: F.when(F.abs(F.col(c) - F.round(c)) < 0.05, F.round(c) + 0.0).otherwise(F.col(c)).alias(c)
    return got.groupBy("tile", "slot", near("dy"), near("dx")).agg(F.sum(F.size("line").cast("long")).alias("pixels"), (F.max(apart) < 0.05).alias("alike"))
