"""Band arithmetic as column expressions: indices, reflectance, severity, normalisation, gates. No UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: keeps ratios of dark pixels defined.
EPSILON = 1e-10
#: Burn severity by least dNBR, highest first; below the last nothing is assigned.
SEVERITY = [(0.66, "high"), (0.44, "moderate_high"), (0.27, "moderate_low"), (0.1, "low"), (-0.1, "unburned")]


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalized_difference(a, b) -> Column:
    """(a - b) / (a + b), kept from zero division by a small constant."""
    a, b = col(a).cast("double"), col(b).cast("double")
    return (a - b) / (a + b + F.lit(EPSILON))


def ndvi(nir, red) -> Column:
    return normalized_difference(nir, red)


def ndwi(green, nir) -> Column:
    return normalized_difference(green, nir)


def ndbi(swir, nir) -> Column:
    return normalized_difference(F.coalesce(col(swir), F.lit(0.1)), nir)


def nbr(nir, swir2) -> Column:
    return normalized_difference(nir, F.coalesce(col(swir2), F.lit(0.1)))


def mndwi(green, swir) -> Column:
    return normalized_difference(green, swir)


def ndci(red_edge, red) -> Column:
    return normalized_difference(red_edge, red)


def evi(nir, red, blue) -> Column:
    n, r, b = (col(x).cast("double") for x in (nir, red, blue))
    return F.lit(2.5) * (n - r) / (n + 6.0 * r - 7.5 * b + 1.0 + F.lit(EPSILON))


def mci(red_edge1, red_edge2, red, k: float = 0.389) -> Column:
    """Peak of the first red edge above the line from red to the second."""
    e1, e2, r = (col(x).cast("double") for x in (red_edge1, red_edge2, red))
    return e1 - (r + F.lit(k) * (e2 - r))


def with_indices(df: DataFrame, blue="B02", green="B03", red="B04", nir="B08", swir="B11", swir2="B12") -> DataFrame:
    """The five standard indices; near infra-red is the mean of the visible bands, and short waves 0.1, where they are missing."""
    have = set(df.columns)
    n = F.col(nir) if nir in have else (F.col(red) + F.col(green) + F.col(blue)) / 3
    s1 = F.col(swir) if swir in have else F.lit(0.1)
    s2 = F.col(swir2) if swir2 in have else F.lit(0.1)
    return df.withColumns({"ndvi": ndvi(n, red), "ndwi": ndwi(green, n), "ndbi": ndbi(s1, n), "nbr": nbr(n, s2), "evi": evi(n, red, blue)})


def reflectance(dn, offset, scale, clip: bool = True) -> Column:
    """Digital numbers to reflectance: (dn - offset) / scale, in [0, 1] where clipped."""
    out = (col(dn).cast("double") - col(offset)) / col(scale)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), out)) if clip else out


def lower_to_upper_bands(df: DataFrame) -> DataFrame:
    """Band columns b02, b8a, ... renamed to B02, B8A, ..."""
    import re

    return df.withColumnsRenamed({c: c.upper() for c in df.columns if re.fullmatch(r"b\d[\da-z]", c)})


def band_distance(pairs: list[tuple]) -> Column:
    """Euclidean distance of two band vectors."""
    total = F.lit(0.0)
    for a, b in pairs:
        d = col(a).cast("double") - col(b).cast("double")
        total = total + d * d
    return F.sqrt(total)


def severity(dnbr) -> Column:
    out = F.when(col(dnbr) >= SEVERITY[0][0], SEVERITY[0][1])
    for least, name in SEVERITY[1:]:
        out = out.when(col(dnbr) >= least, name)
    return out


def cloud_thickness(cot, thick: float = 0.025, thin: float = 0.015) -> Column:
    return F.when(col(cot) >= thick, "thick").when(col(cot) >= thin, "thin").otherwise("clear")


def aux_day(value, mean) -> Column:
    """Packed year-and-day values to the day of the year; without data the mean."""
    return F.when(col(value) > 0, F.pmod(col(value), F.lit(1000)).cast("double")).otherwise(col(mean))


def log_scaled(x) -> Column:
    return F.log1p(F.greatest(col(x).cast("double"), F.lit(0.0)))


def rounded(x, places: int) -> Column:
    """Rounded as DuckDB does: the nearest whole number of ``x * 10 ** places``, halves away from zero. Spark's ``round`` takes the halves of the
    decimals that a double is written with, which are others."""
    v, scale = col(x).cast("double"), F.lit(10.0**places)
    scaled = v * scale
    even, away = F.rint(scaled), F.signum(scaled) / 2
    out = F.when(scaled - even == away, even + away * 2).otherwise(even) / scale
    return F.when(F.isnan(out) | (F.abs(out) == float("inf")), v).otherwise(out)


def z_score(x, mean, std) -> Column:
    return (col(x) - col(mean)) / F.greatest(col(std), F.lit(1e-6))


def min_max(x, low, high) -> Column:
    """To [0, 1]; 0 where the range is empty."""
    width = col(high) - col(low)
    return F.coalesce((col(x) - col(low)) / F.nullif(width, F.lit(0.0)), F.lit(0.0))


def sigma0(dn, lut) -> Column:
    v = col(dn).cast("double") / F.nullif(col(lut).cast("double"), F.lit(0.0))
    return v * v


def decibel(x, finite: bool = True) -> Column:
    """10 log10 x; what isn't finite becomes 0, or without ``finite`` stays: minus infinity of 0, NaN below, null of null."""
    v = col(x).cast("double")
    out = F.when(v > 0, F.lit(10.0) * F.log10(v))
    return out.otherwise(0.0) if finite else out.when(v == 0, float("-inf")).when(v.isNotNull(), float("nan"))


def stretch(df: DataFrame, bands: list[str], low: float = 0.02, high: float = 0.98, exclude: Column | None = None) -> DataFrame:
    """Each band scaled to [0, 1] between two of its percentiles; ``exclude``: rows that don't count for those."""
    kept = df if exclude is None else df.where(~F.coalesce(exclude, F.lit(False)))
    from skyquilt.operators.aggregates import exact_percentiles

    out = df
    for b in bands:  # one row each
        out = out.join(F.broadcast(exact_percentiles(kept, b, [low, high]).select(F.col("p").alias(f"__{b}"))), F.lit(True))
    for b in bands:
        lo, hi = F.col(f"__{b}")[0], F.col(f"__{b}")[1]
        out = out.withColumn(b, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col(b) - lo) / F.greatest(hi - lo, F.lit(1e-6)))))
    return out.drop(*[f"__{b}" for b in bands])


def parcel_weight(area_ha, smallest: float = 0.25, most: float = 4.0) -> Column:
    """Small parcels weigh more: 1 / sqrt(area) between 1 and ``most``."""
    a = col(area_ha).cast("double")
    return F.when(a == 0, 1.0).when(a < smallest, most).otherwise(F.greatest(F.lit(1.0), F.least(F.lit(most), 1.0 / F.sqrt(F.nullif(a, F.lit(0.0))))))


def cloud_gate(overpass_pct, autumn=None) -> Column:
    """How much cloud to accept in a scene, given the forecast's cloud cover: wider in autumn. Products come before quotients, as in SQL from left to right."""
    f = F.least(F.greatest(col(overpass_pct).cast("double"), F.lit(0.0)), F.lit(50.0))
    wide = F.lit(False) if autumn is None else col(autumn)
    return F.when(wide, 0.30 + 0.25 * f / 50.0).otherwise(0.20 + 0.10 * f / 50.0)


def coastal_class(water_index, vegetation_index, water: float = 0.0, vegetation: float = 0.3, wet: float = -0.1) -> Column:
    """Water, vegetation, wet ground or bare ground, by thresholds that may be columns."""
    w, v = col(water_index), col(vegetation_index)
    return F.when(w > water, "water").when(v > vegetation, "vegetation").when(w > wet, "wet").otherwise("bare")


def phase_displacement(phase_change, wavelength_m: float) -> Column:
    """Millimetres along the line of sight from a phase change, wrapped to (-pi, pi]."""
    wrapped = F.atan2(F.sin(col(phase_change)), F.cos(col(phase_change)))
    return wrapped * F.lit(wavelength_m) / F.lit(4 * 3.141592653589793) * 1000


def magnitude(vector) -> Column:
    """L2 norm of an array column."""
    return F.sqrt(F.aggregate(col(vector), F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def water_mask(scl, water_index, water_class: int = 6) -> Column:
    """The scene class where it is known, else a water index above 0."""
    return F.coalesce(col(scl) == water_class, col(water_index) > 0)


def spread_of_two(a, b) -> Column:
    """Population deviation of two estimates: of one valid estimate 0, of none NaN."""
    ok = lambda x: col(x).isNotNull() & ~F.isnan(col(x))
    return F.when(ok(a) & ok(b), F.abs(col(a) - col(b)) / 2).when(ok(a) | ok(b), 0.0).otherwise(F.lit(float("nan")))


def vegetation_class(index, low: float = 0.2, high: float = 0.5) -> Column:
    """Three classes by two thresholds."""
    return F.when(col(index) >= high, "dense").when(col(index) >= low, "sparse").otherwise("bare")


def gated(value, code, allowed: list[int], empty=0) -> Column:
    """A value only where a code allows it: harvest in forest, crops on farmland."""
    return F.when(col(code).isin(*allowed), col(value)).otherwise(F.lit(empty))
