"""Lines from pixel tables: contours of a level in order, and skeletons one pixel wide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyquilt.operators.iterative import _table

#: A vertex lies on the edge between two pixels; its key is the doubled row and column, in one number.
_STRIDE = 1 << 31
_OPEN = -(1 << 62)


def _squares(df: DataFrame, value: str) -> DataFrame:
    """``tl tr br bl``: the values of each 2 x 2 square of pixels that are all there, at its upper left pixel."""
    places = {"tl": (0, 0), "tr": (0, 1), "br": (1, 1), "bl": (1, 0)}
    o = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("i"), F.lit(j).alias("j")) for k, (i, j) in places.items()]))
    sent = df.where(F.col(value).isNotNull()).withColumn("o", o)
    sent = sent.select("tile", (F.col("row").cast("long") - F.col("o.i")).alias("row"), (F.col("col").cast("long") - F.col("o.j")).alias("col"), F.col("o.k").alias("k"), F.col(value).cast("double").alias("v"))
    whole = sent.groupBy("tile", "row", "col").agg(*[F.max(F.when(F.col("k") == k, F.col("v"))).alias(k) for k in places])
    return whole.where(" AND ".join(f"{k} IS NOT NULL" for k in places))


def contour_segments(df: DataFrame, value: str, level: float) -> DataFrame:
    """Directed pieces of the contour, ``tile, a, b`` (keys of vertices) and their places ``ay ax by bx``, by marching squares.

    Around a square, pieces run from where values fall below the level to where they rise above it; so the squares on both sides of a vertex agree on its direction. Where two opposite corners are high, each has a piece of its own.
    """
    r, c = F.col("row"), F.col("col")
    share = lambda p, q: (F.lit(float(level)) - F.col(p)) / F.nullif(F.col(q) - F.col(p), F.lit(0.0))  # noqa: E731  equal values have no crossing
    high = lambda k: F.col(k) > level
    edge = lambda a, b, y2, x2, y, x: F.struct(
        (high(a) & ~high(b)).alias("falls"), (~high(a) & high(b)).alias("rises"), (y2 * _STRIDE + x2).alias("k"), y.alias("y"), x.alias("x")
    )
    d = lambda x: x.cast("double")
    around = F.array(  # clockwise; places by the pixel of the lower row or column first, so that neighbours compute the same
        edge("tl", "tr", 2 * r, 2 * c + 1, d(r), c + share("tl", "tr")),
        edge("tr", "br", 2 * r + 1, 2 * c + 2, r + share("tr", "br"), d(c + 1)),
        edge("br", "bl", 2 * r + 2, 2 * c + 1, d(r + 1), c + share("bl", "br")),
        edge("bl", "tl", 2 * r + 1, 2 * c, r + share("tl", "bl"), d(c)),
    )
    s = _squares(df, value).withColumn("e", around)
    s = s.withColumn("i", F.explode(F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: F.get("e", i)["falls"])))
    before = F.get("e", (F.col("i") + 3) % 4)
    to = F.when(before["rises"], before).otherwise(F.get(F.filter("e", lambda x: x["rises"]), F.lit(0)))
    s = s.select("tile", F.get("e", F.col("i")).alias("p"), to.alias("q"))
    return s.select("tile", F.col("p.k").alias("a"), F.col("q.k").alias("b"), F.col("p.y").alias("ay"), F.col("p.x").alias("ax"), F.col("q.y").alias("by"), F.col("q.x").alias("bx"))


def _ranked(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tile, k, p: the one before, its own key at a start) with ``head`` and ``seq``, the steps from there: each round doubles how far a node looks."""
    state = _table(nodes.select("tile", "k", "p", (F.col("p") != F.col("k")).cast("long").alias("seq")))
    while True:
        far = state.select("tile", F.col("k").alias("p"), F.col("p").alias("__p"), F.col("seq").alias("__d"))
        after = _table(state.join(far, ["tile", "p"]).select("tile", "k", F.col("p").alias("old"), F.col("__p").alias("p"), (F.col("seq") + F.col("__d")).alias("seq")))
        if after.where("old <> p").isEmpty():
            return after.select("tile", "k", F.col("p").alias("head"), "seq")
        state = after.drop("old")


def ordered_lines(segments: DataFrame) -> DataFrame:
    """``tile, line, seq, y, x, closed``: the vertices of each line in order, from a start, or in a ring from the vertex of the lowest key.

    List ranking by pointer doubling: as many rounds as the logarithm of the longest line, each one join of the vertices with themselves. Rings are those lines that never see a start;
    they are cut at their lowest key and ranked like the others.
    """
    ends = segments.select("tile", F.explode(F.array(*[F.struct(F.col(k).alias("k"), F.col(f"{k}y").alias("y"), F.col(f"{k}x").alias("x"), p.alias("p")) for k, p in (("a", F.lit(None).cast("long")), ("b", F.col("a")))])).alias("v"))
    vertices = _table(ends.groupBy("tile", F.col("v.k").alias("k")).agg(F.max("v.p").alias("p"), F.min("v.y").alias("y"), F.min("v.x").alias("x")))
    state = _table(vertices.select("tile", "k", F.coalesce("p", "k").alias("p"), F.when(F.col("p").isNull(), F.lit(_OPEN)).otherwise(F.col("k")).alias("low")))
    while True:  # what is the lowest key behind each vertex; starts count as lower than all
        far = state.select("tile", F.col("k").alias("p"), F.col("p").alias("__p"), F.col("low").alias("__low"))
        after = _table(state.join(far, ["tile", "p"]).select("tile", "k", F.col("__p").alias("p"), F.col("low").alias("old"), F.least("low", "__low").alias("low")))
        if after.where("old <> low").isEmpty():
            break
        state = after.drop("old")
    known = vertices.join(after.select("tile", "k", (F.col("low") != _OPEN).alias("closed"), "low"), ["tile", "k"])
    start = F.col("p").isNull() | (F.col("closed") & (F.col("k") == F.col("low")))
    ranks = _ranked(known.select("tile", "k", F.when(start, F.col("k")).otherwise(F.col("p")).alias("p")))
    return known.select("tile", "k", "y", "x", "closed").join(ranks, ["tile", "k"]).select("tile", F.col("head").alias("line"), "seq", "y", "x", "closed")


def contours(df: DataFrame, value: str, level: float) -> DataFrame:
    """Contours of ``value`` at ``level`` as ordered lines; those that end at the tile's edge or at a missing pixel are open."""
    return ordered_lines(_table(contour_segments(df, value, level)))


#: The eight pixels around one, clockwise from above; bit k of a pixel's code says whether the k-th is set.
AROUND = [(-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1)]


def removable(code: int, second: bool) -> bool:
    """Whether thinning may remove a pixel with these neighbours: two to six are set, in one run, and not all three of the sides that the pass looks at."""
    bit = [code >> k & 1 for k in range(8)]
    n, e, s, w = bit[0], bit[2], bit[4], bit[6]
    rises = sum(not bit[k] and bit[(k + 1) % 8] for k in range(8))
    sides = n * e * w == 0 and n * s * w == 0 if second else n * e * s == 0 and e * s * w == 0
    return 2 <= sum(bit) <= 6 and rises == 1 and sides


def _codes(on: DataFrame) -> DataFrame:
    """``code`` of each set pixel: each sends its bit to those around it."""
    o = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(b).alias("b")) for i, j, b in [(0, 0, 0), *[(-i, -j, 1 << k) for k, (i, j) in enumerate(AROUND)]]]))
    sent = on.withColumn("o", o).select("tile", (F.col("row") + F.col("o.i")).alias("row"), (F.col("col") + F.col("o.j")).alias("col"), F.col("o.b").alias("b"))
    return sent.groupBy("tile", "row", "col").agg(F.sum("b").cast("int").alias("code"), F.max(F.col("b") == 0).alias("own")).where("own").drop("own")


def _table_of(second: bool) -> Column:
    return F.split(F.lit(",".join(str(int(removable(k, second))) for k in range(256))), ",")


def skeleton(pixels: DataFrame) -> DataFrame:
    """The set pixels that are left when borders have been peeled off, from the lower right and the upper left in turn, until nothing goes; lines stay connected."""
    on = _table(pixels.select("tile", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col")).distinct())
    while True:
        peeled = on
        for second in (False, True):
            peeled = _codes(peeled).where(F.get(_table_of(second), F.col("code")) == "0").select("tile", "row", "col")
        peeled = _table(peeled)
        if peeled.count() == on.count():
            return peeled
        on = peeled
