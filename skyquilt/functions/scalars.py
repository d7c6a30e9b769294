"""Scalar functions on names, dates, coordinates, arrays and maps, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyquilt.functions.spectral import col

# -- strings


def cohort(name) -> Column:
    """What a tile was chosen for, by its name's prefix."""
    n = col(name)
    return (
        F.when(n.startswith("tile_"), "lulc").when(n.startswith("crop_"), "crop").when(n.startswith("urban_"), "urban").when(n.rlike("^[0-9]"), "numeric").otherwise("other")
    )


def name_coordinates(name) -> Column:
    """Easting and northing in a name, ``..._E_N``; null where there are none."""
    e, n = (F.regexp_extract(col(name), r"_(\d{5,7})_(\d{6,8})", k) for k in (1, 2))
    return F.when(e != "", F.struct(e.try_cast("long").alias("easting"), n.try_cast("long").alias("northing")))


def expected_class(name, classes: dict[str, int]) -> Column:
    """The class that a ``crop_<kind>_...`` name stands for."""
    kind = F.regexp_extract(col(name), r"^crop_([a-z]+)", 1)
    return F.element_at(F.create_map(*[F.lit(x) for kv in classes.items() for x in kv]), kind)


def grid_square(product_name) -> Column:
    """Zone, band and square in a product name, ``_T33VXF_``."""
    part = lambda k: F.nullif(F.regexp_extract(col(product_name), r"_T(\d{2})([A-Z])([A-Z]{2})", k), F.lit(""))
    return F.struct(part(1).cast("int").alias("zone"), part(2).alias("band"), part(3).alias("square"))


def phenology_file(name) -> Column:
    """Year, tile, version and quantity in the name of a phenology product, ``VPP_2019_S2_T33VXF-010m_V101_s1_SOSD.tif``."""
    part = lambda k: F.nullif(F.regexp_extract(col(name), r"^VPP_(\d{4})_S2_(T\d{2}[A-Z]{3})-\d+m_V(\d+)_s(\d)_([A-Z]+)", k), F.lit(""))
    return F.struct(part(1).cast("int").alias("year"), part(2).alias("tile"), part(3).alias("version"), part(4).cast("int").alias("season"), part(5).alias("quantity"))


def month_windows(text) -> Column:
    """``"4-5,6-7"`` as an array of first and last months."""
    return F.transform(F.split(col(text), ","), lambda w: F.struct(F.split(w, "-")[0].cast("int").alias("first"), F.split(w, "-")[1].cast("int").alias("last")))


def year_list(text) -> Column:
    """``"2018-2021"`` or ``"2018,2020"`` as an array of years."""
    t = col(text)
    return F.when(t.contains("-"), F.sequence(F.split(t, "-")[0].cast("int"), F.element_at(F.split(t, "-"), -1).cast("int"))).otherwise(
        F.transform(F.split(t, ","), lambda y: F.trim(y).try_cast("int"))
    )


def epsg_of(uri) -> Column:
    return F.nullif(F.regexp_extract(col(uri), r"(\d+)$", 1), F.lit("")).cast("int")


def area_key(west, south, east, north) -> Column:
    """A short stable key of a bounding box, to four places."""
    return F.substring(F.sha1(F.format_string("%.4f_%.4f_%.4f_%.4f", *[col(x).cast("double") for x in (west, south, east, north)])), 1, 16)


def retry_after(message) -> Column:
    """Seconds that a throttle message asks to wait."""
    return F.nullif(F.regexp_extract(F.lower(col(message)), r"retry[- ]after[:= ]+(\d+)", 1), F.lit("")).cast("int")


def is_throttle(message) -> Column:
    return F.lower(col(message)).rlike(r"\b429\b|too many requests|rate limit|throttl")


def is_transient(message) -> Column:
    return F.lower(col(message)).rlike(r"\b(408|500|502|503|504)\b|timed? ?out|temporarily|connection reset")


# -- dates


def day_of_year(text) -> Column:
    """0 where the text is no date."""
    return F.coalesce(F.dayofyear(F.try_to_date(col(text).cast("string"))), F.lit(0))


def date_of_day(year, day) -> Column:
    return F.date_add(F.make_date(col(year), F.lit(1), F.lit(1)), (col(day) - 1).cast("int"))


def packed_day(value) -> Column:
    """Day of the year in a packed year-and-day number."""
    return F.pmod(col(value), F.lit(1000)).cast("int")


def season_range(year, first_month, last_month) -> Column:
    return F.struct(F.make_date(col(year), col(first_month), F.lit(1)).alias("start"), F.last_day(F.make_date(col(year), col(last_month), F.lit(1))).alias("end"))


def slot_year(tile_year, slot, background: int = 2016) -> Column:
    """Slot 0 is the autumn before, slot 4 the background year."""
    return F.when(col(slot) == 0, col(tile_year) - 1).when(col(slot) == 4, F.lit(background)).otherwise(col(tile_year))


def midpoint(start, end) -> Column:
    return F.date_add(col(start), F.floor(F.datediff(col(end), col(start)) / 2).cast("int"))


def modal_year(dates, tie: str = "latest") -> Column:
    """The year that most dates of an array fall in; ties go to the latest or the oldest."""
    years = F.filter(F.transform(col(dates), lambda d: F.year(F.try_to_date(d.cast("string")))), lambda y: y.isNotNull())
    sign = 1 if tie == "latest" else -1
    scored = F.transform(F.array_distinct(years), lambda y: F.struct(F.size(F.filter(years, lambda z: z == y)).alias("n"), (y * sign).alias("y")))
    return F.array_max(scored)["y"] * sign


def first_year(dates, late_day: int | None = None) -> Column:
    """Year of the first date; from ``late_day`` on it counts for the next year."""
    d = F.try_to_date(F.get(F.filter(col(dates), lambda x: x != ""), F.lit(0)))
    year = F.year(d)
    return year if late_day is None else F.when(F.dayofyear(d) >= late_day, year + 1).otherwise(year)


def tile_year(*choices) -> Column:
    """The first year that is known, in the order given: the seven ways to date a tile differ in that order."""
    return F.coalesce(*[col(c) for c in choices])


def chunk_starts(start, end, days: int) -> Column:
    """First days of the chunks of ``days`` days that cover a period."""
    return F.sequence(col(start), col(end), F.expr(f"interval {days} days"))


def balanced_chunks(start, end, most_days: int) -> Column:
    """The period in as few chunks as ``most_days`` allows, as even as can be."""
    n = F.datediff(col(end), col(start)) + 1
    k = F.ceil(n / F.lit(most_days)).cast("int")
    edge = lambda i: F.floor(i * n / k).cast("int")
    return F.transform(
        F.sequence(F.lit(0), k - 1), lambda i: F.struct(F.date_add(col(start), edge(i)).alias("start"), F.date_add(col(start), edge(i + 1) - 1).alias("end"))
    )


# -- coordinates


def utm_zone(lon) -> Column:
    return (F.floor((col(lon) + 180) / 6) + 1).cast("int")


def zone_distance(zone, other: int) -> Column:
    """How many zones lie between two, the shorter way round."""
    apart = F.abs(col(zone) - other)
    return F.least(apart, 60 - apart)


#: GRS 80 and the Swedish national grid.
_AXIS, _FLATTENING = 6378137.0, 1 / 298.257222101
_MERIDIAN, _SCALE, _FALSE_E, _FALSE_N = 15.0, 0.9996, 500000.0, 0.0


def _series():
    f = _FLATTENING
    e2, n = f * (2 - f), f / (2 - f)
    a_roof = _AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    forward = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]
    back = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]
    to = [e2, (5 * e2**2 - e2**3) / 6, (104 * e2**3 - 45 * e2**4) / 120, 1237 * e2**4 / 1260]
    star = [e2 + e2**2 + e2**3 + e2**4, -(7 * e2**2 + 17 * e2**3 + 30 * e2**4) / 6, (224 * e2**3 + 889 * e2**4) / 120, -(4279 * e2**4) / 1260]
    return a_roof, forward, back, to, star


def to_grid(lat, lon) -> Column:
    """Latitude and longitude to easting and northing (Gauss-Krüger series)."""
    a_roof, forward, _, to, _ = _series()
    phi, dl = F.radians(col(lat)), F.radians(col(lon) - _MERIDIAN)
    s = F.sin(phi)
    conformal = phi - s * F.cos(phi) * (to[0] + to[1] * s**2 + to[2] * s**4 + to[3] * s**6)
    xi, eta = F.atan(F.tan(conformal) / F.cos(dl)), F.atanh(F.cos(conformal) * F.sin(dl))
    north, east = xi, eta
    for k, b in enumerate(forward, 1):
        north = north + b * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        east = east + b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    return F.struct((_SCALE * a_roof * east + _FALSE_E).alias("easting"), (_SCALE * a_roof * north + _FALSE_N).alias("northing"))


def from_grid(easting, northing) -> Column:
    """Easting and northing to latitude and longitude."""
    a_roof, _, back, _, star = _series()
    xi0, eta0 = (col(northing) - _FALSE_N) / (_SCALE * a_roof), (col(easting) - _FALSE_E) / (_SCALE * a_roof)
    xi, eta = xi0, eta0
    for k, d in enumerate(back, 1):
        xi = xi - d * F.sin(2 * k * xi0) * F.cosh(2 * k * eta0)
        eta = eta - d * F.cos(2 * k * xi0) * F.sinh(2 * k * eta0)
    conformal = F.asin(F.sin(xi) / F.cosh(eta))
    s = F.sin(conformal)
    lat = conformal + s * F.cos(conformal) * (star[0] + star[1] * s**2 + star[2] * s**4 + star[3] * s**6)
    return F.struct(F.degrees(lat).alias("lat"), (F.degrees(F.atan(F.sinh(eta) / F.cos(xi))) + _MERIDIAN).alias("lon"))


def snap_out(west, south, east, north, step: float = 10) -> Column:
    """A box widened to the lattice: west and south down, east and north up."""
    low, high = (lambda x: F.floor(col(x) / step) * step), (lambda x: F.ceil(col(x) / step) * step)
    return F.struct(low(west).alias("west"), low(south).alias("south"), high(east).alias("east"), high(north).alias("north"))


def map_box(x_min, y_min, x_max, y_max, west: float, north: float, step: float = 10) -> Column:
    """A box in pixels, rows from the north, as a box on the map."""
    e, n = (lambda x: F.lit(west) + col(x) * step), (lambda y: F.lit(north) - col(y) * step)
    return F.struct(e(x_min).alias("west"), n(y_max).alias("south"), e(x_max).alias("east"), n(y_min).alias("north"))


def box_ring(west, south, east, north, digits: int | None = None) -> Column:
    """A box of the grid as a closed ring of latitudes and longitudes, from the south-west corner counter-clockwise; rounded here, not by a function of the array, within which Spark would evaluate all of it uncompiled."""
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    ring = [from_grid(e, n) for e, n in corners]
    return F.array(*(ring if digits is None else [F.struct(*[F.round(c[k], digits).alias(k) for k in ("lat", "lon")]) for c in ring]))


def centred_box(easting, northing, size_px: int, step: float = 10) -> Column:
    half = size_px * step / 2
    e, n = col(easting), col(northing)
    return F.struct((e - half).alias("west"), (n - half).alias("south"), (e + half).alias("east"), (n + half).alias("north"))


def overlap_area(a: list, b: list) -> Column:
    """Of two boxes, each west, south, east, north."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(col(a[hi]), col(b[hi])) - F.greatest(col(a[lo]), col(b[lo])))
    return side(0, 2) * side(1, 3)


def weather_cell(x, step: float = 0.25) -> Column:
    """Nearest cell centre; halves go to the even cell."""
    return F.bround(col(x) / step, 0) * step


def zone_of(value, bounds: list[float], names: list[str]) -> Column:
    """Which of ``len(bounds) + 1`` bands a value lies in; a bound belongs to the band above it."""
    out = F.when(col(value) < bounds[0], names[0])
    for b, n in zip(bounds[1:], names[1:-1], strict=True):
        out = out.when(col(value) < b, n)
    return out.otherwise(names[-1])


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    h = F.sin((p2 - p1) / 2) ** 2 + F.cos(p1) * F.cos(p2) * F.sin(F.radians(col(lon2) - col(lon1)) / 2) ** 2
    return F.lit(2 * 6371.0088) * F.asin(F.sqrt(h))


# -- arrays and maps


def arg_max(values) -> Column:
    """Index from 0 of the largest element; the lowest index wins a tie."""
    return (F.array_position(col(values), F.array_max(col(values))) - 1).cast("int")


def nearest_filled(frames, filled, preference: list[int]) -> Column:
    """For each frame the index of a filled one: itself, else the nearest, by preference where equally near."""
    order = F.array(*[F.lit(x) for x in preference])
    candidates = F.filter(F.sequence(F.lit(0), F.size(col(frames)) - 1), lambda i: F.get(col(filled), i))
    pick = lambda i: F.array_min(F.transform(candidates, lambda j: F.struct(F.abs(i - j).alias("d"), F.array_position(order, j).alias("p"), j.alias("j"))))["j"]
    return F.transform(F.sequence(F.lit(0), F.size(col(frames)) - 1), pick)


def season_windows(start_day, end_day, k: int, cap: int) -> Column:
    """A season cut in ``k`` equal windows, the last one up to ``cap`` at least."""
    width = (col(end_day) - col(start_day)) / k
    edge = lambda i: (col(start_day) + i * width).cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: F.struct(edge(i).alias("first"), F.when(i == k - 1, F.greatest(col(end_day).cast("int"), F.lit(cap))).otherwise(edge(i + 1) - 1).alias("last")),
    )


def lookup(code, table: dict, default=None) -> Column:
    """A literal map with a default; for tables of many entries join instead (``operators.joins.lookup_join``)."""
    found = F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), col(code))
    return found if default is None else F.coalesce(found, F.lit(default))


def forest_class(pine, spruce, contorta, birch, other, dominance: float = 0.7) -> Column:
    """Forest type by shares of volume: pine and contorta, spruce, broadleaved, else mixed; null without volume."""
    parts = [F.coalesce(col(x).cast("double"), F.lit(0.0)) for x in (pine, contorta, spruce, birch, other)]
    total = F.nullif(parts[0] + parts[1] + parts[2] + parts[3] + parts[4], F.lit(0.0))
    p, s, b = (parts[0] + parts[1]) / total, parts[2] / total, (parts[3] + parts[4]) / total
    return F.when(total.isNull(), None).when(p >= dominance, "pine").when(s >= dominance, "spruce").when(b >= dominance, "broadleaved").otherwise("mixed")

