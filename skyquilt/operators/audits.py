"""Audits of tiles: frames, labels, dates, axes, keys. Issues name their slot, and ask for the work that would mend them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.functions.spectral import col

SLOTS = 4
#: The vintages of parcel data; extents of eastings and northings.
VINTAGES = [2018, 2019, 2022, 2023, 2024]
EASTINGS, NORTHINGS = (200_000, 1_000_000), (6_000_000, 7_800_000)


def _slots(condition, issue: str, need: str | None = None, first: int = 0) -> Column:
    """``issue:slot_i`` and the need of every slot for which ``condition(i)`` holds, as structs."""
    all_ = F.sequence(F.lit(first), F.lit(SLOTS - 1))
    name = lambda i, x: F.concat(F.lit(f"{x}_"), i.cast("string"))
    hit = F.filter(all_, lambda i: F.coalesce(condition(i), F.lit(False)))
    return F.transform(hit, lambda i: F.struct(F.concat(F.lit(f"{issue}:"), name(i, "slot")).alias("issue"), (name(i, need) if need else F.lit(None).cast("string")).alias("need")))


def _one(condition: Column, issue: str, need: str | None = None) -> Column:
    found = F.struct(F.lit(issue).alias("issue"), F.lit(need).cast("string").alias("need"))
    return F.filter(F.array(found), lambda x: F.coalesce(condition, F.lit(False)))


def frame_audit(tiles: DataFrame, cap_day: int = 244, summer_from: int = 200, values: int = SLOTS) -> DataFrame:
    """``tiles`` with ``issues`` and ``needs`` (sorted, distinct): twelve checks in one pass over arrays of four slots.

    Columns: ``n_values`` (frames held), ``content`` (whether a frame has data), ``mask``, ``dates`` (strings, '' for none), ``days`` (of the
    year), ``tile_year``, ``nir_dates`` and ``edge_dates`` (of layers fetched apart; null where there are none).
    """
    at = lambda c, i: F.get(F.col(c), i)
    day = lambda c, i: F.try_to_date(F.nullif(at(c, i), F.lit("")))
    dated = lambda i: F.coalesce(at("dates", i), F.lit("")) != ""
    on = lambda i: at("mask", i) == 1
    first_year = F.year(day("dates", F.lit(0)))
    drift = lambda c: lambda i: dated(i) & (F.coalesce(at(c, i), F.lit("")) != "") & (at(c, i) != at("dates", i))
    order = F.filter(
        F.transform(F.filter(F.sequence(F.lit(0), F.lit(SLOTS - 2)), lambda i: day("dates", i).isNotNull()), lambda i: F.struct(i.alias("i"), F.try_element_at(F.filter(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda j: (j > i) & day("dates", j).isNotNull()), F.lit(1)).alias("j"))),
        lambda p: p["j"].isNotNull() & (day("dates", p["j"]) <= day("dates", p["i"])),
    )
    order = F.transform(order, lambda p: F.struct(F.concat(F.lit("monotonic_calendar:slot_"), p["i"].cast("string")).alias("issue"), F.concat(F.lit("refetch_slot_"), p["j"].cast("string")).alias("need")))
    missing = lambda i: F.coalesce(at("mask", i), F.lit(0)) == 0
    known = F.col("tile_year").isNotNull() & on(F.lit(0)) & dated(F.lit(0))
    found = F.concat(
        _one(F.col("n_values") != values, "spectral_shape", "rebuild_tile"),
        _slots(lambda i: on(i) != at("content", i), "tmask_consistency", "refetch_slot"),
        _slots(lambda i: dated(i) & day("dates", i).isNull(), "date_parseable", "refetch_slot"),
        _slots(lambda i: F.dayofyear(day("dates", i)) != at("days", i), "doy_matches_date"),
        order,
        _slots(missing, "all_4_slots_filled", "refetch_slot"),
        _slots(lambda i: on(i) & (F.year(day("dates", i)) == F.col("tile_year")) & (at("days", i) > cap_day), "late_autumn_bug", "refetch_slot", 1),
        _one(known & (first_year == F.col("tile_year")), "wrong_layout", "refetch_slot_0"),
        _one(known & (first_year != F.col("tile_year") - 1), "year_consistency"),
        _one(on(F.lit(3)) & (at("days", F.lit(3)) > 0) & (at("days", F.lit(3)) < summer_from), "slot_3_too_early", "refetch_slot_3"),
        _slots(drift("nir_dates"), "b08_date_drift", "enrich_b08_slot"),
        _slots(drift("edge_dates"), "rededge_date_drift", "enrich_rededge_slot"),
    )
    out = tiles.withColumn("__f", found)
    needs = F.array_sort(F.array_distinct(F.filter(F.transform("__f", lambda x: x["need"]), lambda n: n.isNotNull())))
    return out.withColumns({"issues": F.array_sort(F.transform("__f", lambda x: x["issue"])), "needs": needs}).drop("__f")


def date_class(dates) -> Column:
    """How the years of four dates lie: ``ok`` (the first a year before the others), ``same_year``, ``inconsistent``, ``bad``, ``bad_count``."""
    years = F.transform(col(dates), lambda d: F.when(d.rlike("^[0-9]{4}"), F.substring(d, 1, 4).cast("int")))
    y = lambda i: F.get(years, F.lit(i))
    even = (y(1) == y(2)) & (y(2) == y(3))
    return (
        F.when(F.exists(years, lambda x: x.isNull()), "bad").when(F.size(years) != 4, "bad_count").when(even & (y(0) == y(1) - 1), "ok").when(even & (y(0) == y(1)), "same_year").otherwise("inconsistent")
    )


def nearest_vintage(year, choices: list[int] = VINTAGES) -> Column:
    """The nearest of the years there are data of; the older of equally near ones."""
    return F.array_min(F.transform(F.array(*[F.lit(c) for c in choices]), lambda c: F.struct(F.abs(c - col(year)).alias("d"), c.alias("y"))))["y"]


def axes_sane(west, south, east, north) -> Column:
    """Whether a box reads as eastings and northings in that order."""
    inside = lambda x, r: (col(x) > r[0]) & (col(x) < r[1])
    return inside(west, EASTINGS) & inside(east, EASTINGS) & inside(south, NORTHINGS) & inside(north, NORTHINGS)


def displaced(windows, days, years, mask, tile_year, cap_day: int = 244) -> Column:
    """Whether a frame of the growing season (slots 1 to 3) lies in none of its windows, cut at ``cap_day``, or in another year; false where fewer than three windows are left."""
    cut = F.filter(F.transform(windows, lambda w: F.struct(w["first"].alias("a"), F.least(w["last"], F.lit(cap_day)).alias("b"))), lambda w: w["a"] <= w["b"])
    out = lambda i: (F.get(col(mask), i) == 1) & ~F.coalesce((F.get(col(years), i) == col(tile_year)) & F.exists(cut, lambda w: F.get(col(days), i).between(w["a"], w["b"])), F.lit(False))
    return (F.size(cut) >= 3) & F.coalesce(F.exists(F.sequence(F.lit(1), F.lit(3)), out), F.lit(False))


def cloud_check(frames: DataFrame, tile: str, frame: str, cloud: str, most: float) -> DataFrame:
    """``ok`` of every frame, and for those that fail the tile's clearest other frame that passes (null: none)."""
    passing = F.when(F.col(cloud) <= most, F.struct(F.col(cloud).alias("c"), F.col(frame).alias("f")))
    best = F.min(passing).over(Window.partitionBy(tile))
    return frames.withColumn("ok", F.col(cloud) <= most).withColumn("replacement", F.when(F.col(cloud) > most, best["f"]))


def strip_keys(keys, unwanted: list[str]) -> Column:
    """A map without the keys named."""
    return F.map_filter(col(keys), lambda k, _: ~k.isin(*unwanted))


def only_changed(before, after, allowed: list[str]) -> Column:
    """Whether two maps differ in no other keys than those allowed."""
    rest = lambda m: F.array_sort(F.map_entries(strip_keys(m, allowed)))
    return rest(before) == rest(after)


def small_regions_cleaned(pixels: DataFrame, cls: str, least: int, background: int = 0) -> DataFrame:
    """Regions of 4-connected pixels of one class with fewer than ``least`` pixels take the most frequent other class on their border (the lowest of
    equally frequent ones); the background, and regions without another class beside them, stay. ``pixels``: tile, row, col and the class.
    """
    from skyquilt.operators.iterative import components

    p = pixels.select("tile", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col(cls).alias("v"))
    name = F.concat_ws("/", "tile", F.format_string("%012d", "row"), F.format_string("%012d", "col"))
    p = p.withColumn("id", name)
    pairs = []
    for dy, dx in ((0, 1), (1, 0)):
        moved = p.select("tile", (F.col("row") - dy).alias("row"), (F.col("col") - dx).alias("col"), F.col("v").alias("w"), F.col("id").alias("other"))
        pairs.append(p.join(moved, ["tile", "row", "col"]).select("id", "v", "other", "w"))
    beside = pairs[0].unionByName(pairs[1])
    found = components(beside.where("v = w").select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = p.join(found, "id", "left").withColumn("region", F.coalesce("component", "id")).drop("component")
    size = named.groupBy("region").agg(F.count("*").alias("n"))
    small = named.where(F.col("v") != background).join(size.where(F.col("n") < least), "region").select("id", "region")
    edge = beside.where("v <> w")
    both = edge.select("id", "other", "w").unionByName(edge.select(F.col("other").alias("id"), F.col("id").alias("other"), F.col("v").alias("w")))
    # a border pixel counts once, however many of the region's pixels it touches
    border = both.join(small, "id").select("region", "other", "w").distinct().groupBy("region", "w").agg(F.count("*").alias("n"))
    new = border.groupBy("region").agg(F.max_by("w", F.struct(F.col("n"), -F.col("w"))).alias("new"))
    replaced = small.join(new, "region").select("id", "new")
    return p.join(replaced, "id", "left").select("tile", "row", "col", F.coalesce("new", "v").alias(cls))


def overlap_windows(pixels: DataFrame, size: int, overlap: float, height: int, width: int) -> DataFrame:
    """Each pixel once for every window of ``size`` that covers it, windows ``size * (1 - overlap)`` apart: with ``y0`` and ``x0``, the window's corner.

    The grid of windows reaches as far as it must to cover the image.
    """
    step = max(1, int(size * (1 - overlap)))
    last = lambda n: 0 if n <= size else -(-(n - size) // step) * step
    starts = lambda x, n: F.explode(
        F.sequence(F.greatest(F.lit(0), F.ceil((F.col(x) - size + 1) / step) * step).cast("int"), F.least(F.lit(last(n)), F.floor(F.col(x) / step) * step).cast("int"), F.lit(step))
    )
    return pixels.withColumn("y0", starts("row", height)).withColumn("x0", starts("col", width))


def centre_crop(pixels: DataFrame, rows: int, cols: int, to_rows: int, to_cols: int) -> DataFrame:
    """The middle of a tile's pixels, counted from its own corner; a larger target leaves the pixels where they come to lie, without padding rows."""
    top, left = (rows - to_rows) // 2, (cols - to_cols) // 2
    inside = F.col("row").between(top, top + to_rows - 1) & F.col("col").between(left, left + to_cols - 1)
    return pixels.where(inside).withColumns({"row": F.col("row") - top, "col": F.col("col") - left})


def resized(pixels: DataFrame, value: str, rows: int, cols: int, to_rows: int, to_cols: int, fill: float = 0) -> DataFrame:
    """Tiles of another size around the same middle: what lies beyond is cut off, and what is missing has a pixel of ``fill``."""
    kept = centre_crop(pixels.select("tile", "row", "col", value), rows, cols, to_rows, to_cols)
    whole = pixels.select("tile").distinct().withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(to_rows - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(to_cols - 1))))
    return whole.join(kept, ["tile", "row", "col"], "left").withColumn(value, F.coalesce(F.col(value), F.lit(fill)))


def interpolated(pixels: DataFrame, lut: DataFrame, key: list[str], x: str, at: str, value: str) -> DataFrame:
    """``pixels`` with ``value`` interpolated between the table's entries around ``x`` (``at`` ascending); the outer entries hold beyond.

    The table's entries become spans, and pixels meet them by key; a table has a few entries a key.
    """
    w = Window.partitionBy(*key).orderBy(at)
    spans = lut.select(*key, F.col(at).alias("__a"), F.lead(at).over(w).alias("__b"), F.col(value).alias("__u"), F.lead(value).over(w).alias("__v"), F.row_number().over(w).alias("__k"))
    joined = pixels.join(spans, key)
    low, high = F.col(x) >= F.col("__a"), F.col("__b").isNull() | (F.col(x) < F.col("__b"))
    hit = joined.where((low | (F.col("__k") == 1)) & high)
    share = F.greatest(F.lit(0.0), (F.col(x) - F.col("__a")) / (F.col("__b") - F.col("__a")))
    out = F.when(F.col("__b").isNull(), F.col("__u")).otherwise(F.col("__u") + share * (F.col("__v") - F.col("__u")))
    return hit.withColumn(value, out).drop("__a", "__b", "__u", "__v", "__k")


def _count_upto(axis: str, v: Column) -> Column:
    """How many of an ascending array's entries are ``v`` at most, by halving steps."""
    widths = F.array(*[F.lit(1 << k) for k in range(20, -1, -1)])
    return F.aggregate(widths, F.lit(0), lambda found, w: F.when(F.get(axis, found + w - 1) <= v, found + w).otherwise(found))


def interpolated_grid(pixels: DataFrame, lut: DataFrame, key: list[str], y: str, x: str, at_y: str, at_x: str, value: str) -> DataFrame:
    """``pixels`` with ``value`` interpolated between the four entries of the table's grid around them; places beyond the grid count as on its edge.

    The table has an entry for each of a key's lines and columns. Its cells become rows with their four corners; a pixel finds its cell's number in the two axes of its key,
    and meets that one row. An axis of one entry is constant; a missing entry makes its cells null.
    """
    from skyquilt.operators.joins import small

    axes = lut.groupBy(*key).agg(F.sort_array(F.collect_set(F.col(at_y).cast("double"))).alias("__ys"), F.sort_array(F.collect_set(F.col(at_x).cast("double"))).alias("__xs"))
    nodes = lut.join(axes, key).withColumns({"__i": F.array_position("__ys", F.col(at_y).cast("double")) - 1, "__j": F.array_position("__xs", F.col(at_x).cast("double")) - 1})
    corners = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)]))
    sent = nodes.withColumn("__o", corners).select(*key, (F.col("__i") - F.col("__o.a")).cast("int").alias("__ci"), (F.col("__j") - F.col("__o.b")).cast("int").alias("__cj"), "__o", F.col(value).cast("double").alias("__v"))
    corner = lambda a, b: F.max(F.when((F.col("__o.a") == a) & (F.col("__o.b") == b), F.col("__v"))).alias(f"__v{a}{b}")
    cells = sent.groupBy(*key, "__ci", "__cj").agg(*[corner(a, b) for a in (0, 1) for b in (0, 1)])

    def placed(axis: str, v: str) -> tuple[Column, Column]:
        n = F.size(axis)
        inside = F.greatest(F.least(F.col(v).cast("double"), F.get(axis, n - 1)), F.get(axis, F.lit(0)))
        k = F.greatest(F.lit(0), F.least(_count_upto(axis, inside) - 1, n - 2))
        low, high = F.get(axis, k), F.get(axis, k + 1)
        return k, F.coalesce((inside - low) / (high - low), F.lit(0.0))

    (ci, fy), (cj, fx) = placed("__ys", y), placed("__xs", x)
    found = pixels.join(small(axes), key).withColumns({"__ci": ci, "__cj": cj, "__fy": fy, "__fx": fx, "__ny": F.size("__ys"), "__nx": F.size("__xs")}).drop("__ys", "__xs")
    j = found.join(cells, [*key, "__ci", "__cj"])
    v = lambda a, b: F.when((F.lit(a) == 1) & (F.col("__ny") == 1), F.col(f"__v0{b}") if b == 0 else F.when(F.col("__nx") == 1, F.col("__v00")).otherwise(F.col("__v01"))).when((F.lit(b) == 1) & (F.col("__nx") == 1), F.col(f"__v{a}0")).otherwise(F.col(f"__v{a}{b}"))
    fy, fx = F.col("__fy"), F.col("__fx")
    out = (1 - fy) * ((1 - fx) * v(0, 0) + fx * v(0, 1)) + fy * ((1 - fx) * v(1, 0) + fx * v(1, 1))
    return j.withColumn(value, out).drop("__ci", "__cj", "__fy", "__fx", "__ny", "__nx", *[f"__v{a}{b}" for a in (0, 1) for b in (0, 1)])
