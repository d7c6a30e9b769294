"""Joins on ranges, nearest values, lookups, zones and key differences, all as equi-joins that Spark can shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.functions.spectral import col

#: Tables of at most this many rows are broadcast by the helpers here; they count before they do.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows; a count of ``rows`` + 1 at most decides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _level(width: Column, cell: float) -> Column:
    """The least level whose cells, ``cell * 2 ** level`` wide, are no narrower than ``width``."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(width, F.lit(float(cell))) / cell))).cast("int")


def _levels(df: DataFrame) -> list[int]:
    """The levels that a table's boxes have: one more at most for each doubling of their width."""
    return sorted(r["__l"] for r in df.where("__l IS NOT NULL").select("__l").distinct().collect())


def _dealt(df: DataFrame, box: tuple[str, ...], cell: float) -> DataFrame:
    """Boxes in the cells of level ``__l`` that they touch: three a side at most, as no cell is narrower than its boxes."""
    size = F.pow(F.lit(2.0), F.col("__l")) * cell
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / size).cast("long"), F.floor(F.col(hi) / size).cast("long"))
    w, s, e, n = box
    return df.withColumn("__cx", F.explode(span(w, e))).withColumn("__cy", F.explode(span(s, n)))


def _salted(left: DataFrame, right: DataFrame, keys: list[str], rows: int) -> tuple[DataFrame, DataFrame]:
    """Keys of more than ``rows`` left rows are dealt over parts, left rows by hash, right rows once a part; fewer than left rows / ``rows`` keys are such."""
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows).select(*keys, F.ceil(F.col("__n") / rows).cast("int").alias("__parts"))
    parts = F.coalesce("__parts", F.lit(1))
    part = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), parts).cast("int")
    dealt = left.join(hot, keys, "left").withColumn("__part", part).drop("__parts")
    copied = right.join(hot, keys, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return dealt, copied


def points_in_boxes(
    points: DataFrame, boxes: DataFrame, x: str, y: str, box: tuple[str, str, str, str], cell: float, on: tuple[str, ...] = (), closed: bool = False, split: int | None = None
) -> DataFrame:
    """Points with the half-open boxes [west, east) x (south, north] that hold them, or with ``closed`` boxes.

    A box is dealt to the cells it touches in the grid of its own size: cells of ``cell``, doubled until they are as wide as the box.
    A point is looked up once for each size of grid that boxes use, in one cell, so that no pair comes twice; then the exact test runs.
    ``on``: further columns that must agree. ``split``: cells with more points than this are dealt over several tasks.
    """
    w, s, e, n = (F.col(c) for c in box)
    sized = boxes.withColumn("__l", _level(F.greatest(e - w, n - s), cell))
    levels = F.array(*map(F.lit, _levels(sized) or [0]))
    size = F.pow(F.lit(2.0), F.col("__l")) * cell
    placed = points.withColumn("__l", F.explode(levels)).withColumns({"__cx": F.floor(F.col(x) / size).cast("long"), "__cy": F.floor(F.col(y) / size).cast("long")})
    inside = (F.col(x) >= w) & (F.col(x) <= e) & (F.col(y) >= s) & (F.col(y) <= n) if closed else (F.col(x) >= w) & (F.col(x) < e) & (F.col(y) > s) & (F.col(y) <= n)
    keys, dealt = ["__l", "__cx", "__cy", *on], _dealt(sized, box, cell)
    if split:
        placed, dealt = _salted(placed, dealt, keys, split)
        return placed.join(dealt, [*keys, "__part"]).where(inside).drop("__l", "__cx", "__cy", "__part")
    return placed.join(dealt, keys).where(inside).drop("__l", "__cx", "__cy")


def pixel_of(x, y, west, north, step: float = 10, size: int | None = None) -> Column:
    """Row and column of a point in a tile, rows from the north; null outside of ``size``."""
    row, column = F.floor((col(north) - col(y)) / step).cast("int"), F.floor((col(x) - col(west)) / step).cast("int")
    out = F.struct(row.alias("row"), column.alias("col"))
    return out if size is None else F.when((row >= 0) & (row < size) & (column >= 0) & (column < size), out)


def overlapping_boxes(left: DataFrame, right: DataFrame, a: tuple[str, ...], b: tuple[str, ...], cell: float, split: int | None = None) -> DataFrame:
    """Pairs of boxes (west, south, east, north) that touch or overlap.

    Each box has a level, that of the narrowest grid (cells of ``cell``, doubled level by level) as wide as itself. A pair meets at the higher
    of its two levels, so that a box is dealt to a few cells of its own level and of those above it that the other table uses, however
    wide boxes are; and it is kept in the one cell that holds the south-west corner of its intersection, so that none
    comes twice and no distinct is needed. ``split``: cells with more left rows than this are dealt over several tasks.
    """
    aw, as_, ae, an = (F.col(c) for c in a)
    bw, bs, be, bn = (F.col(c) for c in b)
    left = left.withColumn("__l", _level(F.greatest(ae - aw, an - as_), cell))
    right = right.withColumn("__l", _level(F.greatest(be - bw, bn - bs), cell))
    a_levels, b_levels = _levels(left), _levels(right)

    def raised(df: DataFrame, own: str, others: list[int]) -> DataFrame:
        above = F.filter(F.array(*map(F.lit, others or [0])), lambda k: k > F.col(own))
        return df.withColumnRenamed("__l", own).withColumn("__l", F.explode(F.array_append(above, F.col(own))))

    keys = ["__l", "__cx", "__cy"]
    l, r = _dealt(raised(left, "__la", b_levels), a, cell), _dealt(raised(right, "__lb", a_levels), b, cell)  # noqa: E741
    if split:  # by a given number of partitions, as the pairs may be many more than the boxes, by whose bytes Spark would join parts
        l, r = _salted(l, r, keys, split)  # noqa: E741
        r = r.repartition(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "__part")
    size = F.pow(F.lit(2.0), F.col("__l")) * cell
    meet = ~((be < aw) | (bw > ae) | (bn < as_) | (bs > an)) & (F.col("__l") == F.greatest("__la", "__lb"))
    corner = (F.floor(F.greatest(aw, bw) / size) == F.col("__cx")) & (F.floor(F.greatest(as_, bs) / size) == F.col("__cy"))
    return l.join(r, [*keys, *(["__part"] if split else [])]).where(meet & corner).drop(*keys, "__la", "__lb", "__part")


def range_join(left: DataFrame, right: DataFrame, low: str, high: str, low2: str, high2: str, width: float, split: int | None = None) -> DataFrame:
    """Pairs of intervals [low, high] that share a point; as boxes in one dimension. ``split``: cells with more left rows than this are dealt over several tasks."""
    flat = lambda df, lo, hi, p: df.withColumns({f"__{p}0": F.lit(0.0), f"__{p}1": F.lit(0.0)})
    out = overlapping_boxes(flat(left, low, high, "a"), flat(right, low2, high2, "b"), (low, "__a0", high, "__a1"), (low2, "__b0", high2, "__b1"), width, split)
    return out.drop("__a0", "__a1", "__b0", "__b1")


def nearest_in_time(left: DataFrame, right: DataFrame, left_day: str, right_day: str, within: int, id_cols: list[str], tie: list[Column], on: tuple[str, ...] = ()) -> DataFrame:
    """Each left row (by ``id_cols``) with the right row nearest in days, ``within`` days at most; ``tie`` orders equal ones.

    Days fall into spans of ``within`` days; a left row looks in its span and both neighbours.
    """
    span = lambda c: F.floor(F.unix_date(F.col(c)) / F.lit(within + 1)).cast("long")
    l = left.withColumn("__s", F.explode(F.array(span(left_day) - 1, span(left_day), span(left_day) + 1)))  # noqa: E741
    gap = F.abs(F.datediff(F.col(right_day), F.col(left_day)))
    pairs = l.join(right.withColumn("__s", span(right_day)), ["__s", *on]).where(gap <= within).drop("__s")
    order = Window.partitionBy(*id_cols).orderBy(gap, *tie)
    return pairs.withColumn("gap_days", gap).withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


def lookup_join(df: DataFrame, table: DataFrame, key: str, default: dict | None = None) -> DataFrame:
    """Left join with a code table; values missing there take ``default``."""
    out = df.join(small(table), key, "left")
    return out.fillna(default) if default else out


def priority_merge(base: DataFrame, layers: list[tuple[DataFrame, str]], keys: list[str], column: str) -> DataFrame:
    """``column`` of the first layer that has it for a row, else of ``base``: labels of several sources in one."""
    out, names = base, []
    for k, (layer, name) in enumerate(layers):
        names.append(f"__{k}")
        out = out.join(layer.select(*keys, F.col(name).alias(names[-1])), keys, "left")
    return out.withColumn(column, F.coalesce(*[F.col(n) for n in names], F.col(column))).drop(*names)


def only_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left_anti")


def also_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left_semi")


def coverage(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """Each key with the sorted names of the sets that hold it; one shuffle for all sets."""
    tagged = None
    for name, df in sets.items():
        part = df.select(key).distinct().withColumn("set", F.lit(name))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key).agg(F.array_join(F.sort_array(F.collect_set("set")), ",").alias("sets"))


def zonal(df: DataFrame, zones: DataFrame, keys: list[str], zone: str, aggregates: list[Column]) -> DataFrame:
    """Aggregates of a measured table by the zones of another, pixel by pixel."""
    return df.join(zones.select(*keys, zone), keys).groupBy(zone).agg(*aggregates)


def paired_delta(df: DataFrame, name: str, suffix: str, value: str) -> DataFrame:
    """Rows named ``x`` beside those named ``x`` + ``suffix``, and the difference of their values in percent points."""
    base = F.regexp_replace(F.col(name), f"{suffix}$", "")
    return (
        df.groupBy(base.alias("name"))
        .agg(F.max(F.when(F.col(name).endswith(suffix), F.col(value))).alias("inside"), F.max(F.when(~F.col(name).endswith(suffix), F.col(value))).alias("outside"))
        .withColumn("delta_pp", (F.col("inside") - F.col("outside")) * 100)
    )


def nearest_key(df: DataFrame, key: str, choices: list[int], out: str) -> DataFrame:
    """The choice nearest to ``key``, the lower of two equally near ones. Choices are few and come as a literal."""
    best = F.array_min(F.transform(F.array(*map(F.lit, choices)), lambda c: F.struct(F.abs(c - F.col(key)).alias("d"), c.alias("c"))))
    return df.withColumn(out, best["c"])


def best_overlap(requests: DataFrame, items: DataFrame, request_id: str, a: tuple, b: tuple, item_id: str, cell: float, digits: int = 4, rounds: int = 3, split: int = 20_000) -> DataFrame:
    """For each request the item whose box overlaps it most; the lower item id of equal ones. Areas are compared at ``digits`` places, below which they are the noise of their bounds.

    Requests of about the same size and place are a tile, and items meet tiles first. No request of a tile is wider than its hull or narrower than its core, so
    an item goes from a tile if it overlaps the hull by less than another surely overlaps the core, or if a lower item's part of the hull holds its own.
    Each round cuts tiles into quarters of their sides, which only take what their tile has kept; requests then meet the few items of their last tile.
    ``split``: cells with more items than this are dealt over several tasks.
    """
    from skyquilt.functions.scalars import overlap_area
    from skyquilt.operators.iterative import _saved

    (aw, as_, ae, an), (bw, bs, be, bn), i = map(F.col, a), map(F.col, b), -F.col(item_id)
    keys, hull, core = ["__lx", "__ly", "__tx", "__ty"], ["__w0", "__s0", "__e0", "__n0"], ["__w1", "__s1", "__e1", "__n1"]
    level = lambda lo, hi: F.ceil(F.log2(F.greatest(hi - lo, F.lit(cell / 16)) / cell)).cast("int")
    side = lambda lo, of: F.floor(lo / (F.pow(F.lit(2.0), F.col(of)) * cell) * 4**rounds).cast("long")
    placed = requests.select(request_id, *a).where(aw.isNotNull() & as_.isNotNull() & ae.isNotNull() & an.isNotNull()).withColumns({"__lx": level(aw, ae), "__ly": level(as_, an)})
    placed = placed.withColumns({"__tx": side(aw, "__lx"), "__ty": side(as_, "__ly")})
    ends = [F.min(F.least(aw, ae)), F.min(F.least(as_, an)), F.max(F.greatest(aw, ae)), F.max(F.greatest(as_, an)), F.max(aw), F.max(as_), F.min(ae), F.min(an)]
    finest = _saved(placed.groupBy(*keys).agg(*[x.alias(c) for x, c in zip(ends, hull + core, strict=True)]))

    def tiles(k: int) -> DataFrame:
        """Those ``k`` rounds before the last."""
        up = finest.withColumns({c: F.shiftright(c, 2 * k) for c in ("__tx", "__ty")})
        return up.groupBy(*keys).agg(*[(F.min(c) if c in (*hull[:2], *core[2:]) else F.max(c)).alias(c) for c in hull + core])

    def kept(pairs: DataFrame) -> DataFrame:
        clip = [F.greatest(bw, "__w0"), F.greatest(bs, "__s0"), F.least(be, "__e0"), F.least(bn, "__n0")]
        sure = (be >= F.col("__w1")) & (bn >= F.col("__s1")) & (bw <= F.col("__e1")) & (bs <= F.col("__n1"))
        x = pairs.withColumns({"__most": F.round(overlap_area(hull, list(b)), digits), "__least": F.round(overlap_area(core, list(b)), digits), **{f"__c{k}": c for k, c in enumerate(clip)}})
        tile = Window.partitionBy(*keys)
        x = x.withColumns({"__sure": F.max(F.when(sure, F.struct("__least", i.alias("i")))).over(tile), "__wide": F.max(F.struct("__most", i.alias("i"), *[f"__c{k}" for k in range(4)])).over(tile)})
        less = (F.col("__most") < F.col("__sure.__least")) | ((F.col("__most") == F.col("__sure.__least")) & (i < F.col("__sure.i")))
        held = (i < F.col("__wide.i")) & F.expr("__c0 >= __wide.__c0 AND __c1 >= __wide.__c1 AND __c2 <= __wide.__c2 AND __c3 <= __wide.__c3")
        return x.where(~F.coalesce(less, F.lit(False)) & ~F.coalesce(held, F.lit(False))).select(*keys, item_id, *b)

    def meet(box) -> Column:
        w, s, e, n = map(F.col, box)
        return (be >= w) & (bw <= e) & (bn >= s) & (bs <= n)

    pairs = kept(overlapping_boxes(items.select(item_id, *b), tiles(rounds), b, tuple(hull), cell, split))
    for k in range(rounds - 1, -1, -1):
        within = tiles(k).withColumns({c.replace("t", "p"): F.shiftright(c, 2) for c in ("__tx", "__ty")})
        pairs = kept(within.join(pairs.withColumnsRenamed({"__tx": "__px", "__ty": "__py"}), ["__lx", "__ly", "__px", "__py"]).where(meet(hull)))
    pairs = placed.join(pairs, keys).where(meet(a)).withColumn("area", F.round(overlap_area(list(a), list(b)), digits))
    best = F.max_by(F.struct(item_id, "area"), F.struct(F.col("area"), i))
    return pairs.groupBy(request_id).agg(best.alias("best")).select(request_id, "best.*")


def missing_pairs(needed: DataFrame, held: DataFrame, keys: list[str], part: str, parts: int) -> DataFrame:
    """Distinct needed key pairs, without those of which ``held`` has all ``parts`` values of ``part``."""
    complete = held.groupBy(*keys).agg(F.count_distinct(part).alias("n")).where(F.col("n") >= parts).select(*keys)
    return needed.select(*keys).distinct().join(complete, keys, "left_anti")


def without_near(new: DataFrame, old: DataFrame, x: str, y: str, cell: float, reach: int = 2) -> DataFrame:
    """Points with no old point within ``reach`` cells of their own, in either direction."""
    cx, cy = (F.floor(F.col(c) / cell).cast("long") for c in (x, y))
    around = F.sequence(F.lit(-reach), F.lit(reach))
    taken = old.select(cx.alias("__x"), cy.alias("__y")).distinct().withColumn("__dx", F.explode(around)).withColumn("__dy", F.explode(around))
    taken = taken.select((F.col("__x") + F.col("__dx")).alias("__x"), (F.col("__y") + F.col("__dy")).alias("__y")).distinct()
    return new.withColumns({"__x": cx, "__y": cy}).join(taken, ["__x", "__y"], "left_anti").drop("__x", "__y")


def within_distance(points: DataFrame, others: DataFrame, xy: tuple[str, str], xy2: tuple[str, str], distance: float, keep: list[str]) -> DataFrame:
    """Points with one of the others at ``distance`` or less, by cells of that size and the eight around them."""
    cell = lambda c: F.floor(F.col(c) / distance).cast("long")
    near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    dealt = others.withColumn("__n", near).select(*xy2, (cell(xy2[0]) + F.col("__n.i")).alias("__x"), (cell(xy2[1]) + F.col("__n.j")).alias("__y"))
    close = (F.col(xy[0]) - F.col(xy2[0])) ** 2 + (F.col(xy[1]) - F.col(xy2[1])) ** 2 <= distance * distance
    a = points.withColumns({"__x": cell(xy[0]), "__y": cell(xy[1])}).alias("a")
    b = dealt.alias("b")
    return a.join(b, (F.col("a.__x") == F.col("b.__x")) & (F.col("a.__y") == F.col("b.__y")) & close, "left_semi").select(*keep)


def class_beneath(points: DataFrame, raster: DataFrame, row: str, column: str, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """Points with what the raster (row, col) has beneath them; those beyond its edge are moved to the edge."""
    clamp = lambda c, r: F.least(F.greatest(F.col(c), F.lit(r[0])), F.lit(r[1]))
    return points.withColumns({"row": clamp(row, rows).cast("long"), "col": clamp(column, cols).cast("long")}).join(raster, ["row", "col"])


def resolve_boxes(tiles: DataFrame, manifest: DataFrame, size_px: int, step: float = 10) -> DataFrame:
    """``resolved``, a tile's box of the size asked for, around the first centre that is known: its easting and northing, those in its name, its
    stored box's, the manifest's (``name``, ``known``: west, south, east, north); and its ``source`` (null without any)."""
    from skyquilt.functions.scalars import centred_box, name_coordinates

    j = tiles.join(manifest, "name", "left")
    middle = lambda b: F.when(F.col(b).isNotNull(), F.struct(F.floor((F.get(b, F.lit(0)) + F.get(b, F.lit(2))) / 2).alias("easting"), F.floor((F.get(b, F.lit(1)) + F.get(b, F.lit(3))) / 2).alias("northing")))
    keys = F.when(F.col("easting").isNotNull() & F.col("northing").isNotNull(), F.struct(F.col("easting").cast("long").alias("easting"), F.col("northing").cast("long").alias("northing")))
    named = [("keys", keys), ("name", name_coordinates("name")), ("box", middle("box")), ("manifest", middle("known"))]
    j = j.withColumn("__c", F.coalesce(*[c for _, c in named]))
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in named])
    return j.withColumn("source", source).withColumn("resolved", F.when(F.col("__c").isNotNull(), centred_box("__c.easting", "__c.northing", size_px, step))).drop("__c", "known")


def copy_forward(tiles: DataFrame, originals: DataFrame, key: str, value: str) -> DataFrame:
    """Tiles without a value take that of the original with their key; ``how``: kept, copied or missing."""
    j = tiles.join(originals.select(key, F.col(value).alias("__v")), key, "left")
    how = F.when(F.col(value).isNotNull(), "kept").when(F.col("__v").isNotNull(), "copied").otherwise("missing")
    return j.withColumn("how", how).withColumn(value, F.coalesce(value, "__v")).drop("__v")
