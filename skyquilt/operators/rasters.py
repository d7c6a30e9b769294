"""Work that needs a pixel's neighbours: on pixel tables by joins, on whole tiles by numpy kernels."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyquilt.operators.iterative import _saved

KEYS = ("tile", "row", "col")


def shifted(df: DataFrame, dy: int, dx: int) -> DataFrame:
    """A pixel table moved by whole pixels."""
    return df.withColumns({"row": F.col("row") + dy, "col": F.col("col") + dx})


def aligned(a: DataFrame, b: DataFrame, dy: int, dx: int) -> DataFrame:
    """Two pixel tables on the first one's grid, where both have data."""
    return a.join(shifted(b, dy, dx), list(KEYS))


def with_neighbours(df: DataFrame, value: str, offsets: list[tuple[int, int]]) -> DataFrame:
    """``near``: the values at the given offsets, for each pixel. Each pixel is sent to those that see it, and one shuffle gathers them."""
    o = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in [(0, 0), *offsets]]))
    sent = df.select("tile", "row", "col", value, o.alias("o")).select(
        "tile", (F.col("row") - F.col("o.dy")).alias("row"), (F.col("col") - F.col("o.dx")).alias("col"), F.col(value).alias("v"), ((F.col("o.dy") == 0) & (F.col("o.dx") == 0)).alias("own")
    )
    near = F.array_compact(F.collect_list(F.when(~F.col("own"), F.col("v"))))
    return sent.groupBy("tile", "row", "col").agg(F.max(F.when(F.col("own"), F.col("v"))).alias(value), near.alias("near")).where(F.col(value).isNotNull())


CROSS = [(-1, 0), (1, 0), (0, -1), (0, 1)]


def dilate(df: DataFrame, mask: str) -> DataFrame:
    """Set where the pixel or a 4-neighbour is; ``mask`` is 0 or 1."""
    return with_neighbours(df, mask, CROSS).select("tile", "row", "col", F.greatest(F.col(mask), F.coalesce(F.array_max("near"), F.lit(0))).alias(mask))


def erode(df: DataFrame, mask: str) -> DataFrame:
    """Set where the pixel and its four neighbours are; beyond the tile nothing is set."""
    n = with_neighbours(df, mask, CROSS)
    return n.select("tile", "row", "col", F.when((F.size("near") == 4) & (F.array_min("near") == 1) & (F.col(mask) == 1), 1).otherwise(0).alias(mask))


def open_close(df: DataFrame, mask: str) -> DataFrame:
    return erode(dilate(dilate(erode(df, mask), mask), mask), mask)


def boundary(df: DataFrame, cls: str, width: int = 1) -> DataFrame:
    """Pixels with another class within ``width`` steps."""
    reach = [(dy, dx) for dy in range(-width, width + 1) for dx in range(-width, width + 1) if 0 < abs(dy) + abs(dx) <= width]
    n = with_neighbours(df, cls, reach)
    return n.select("tile", "row", "col", F.exists("near", lambda x: x != F.col(cls)).alias("boundary"))


def resampled(df: DataFrame, rows: int, cols: int, to_rows: int, to_cols: int, value: str) -> DataFrame:
    """Nearest pixel of a grid of another size."""
    spark = df.sparkSession
    grid = spark.range(to_rows * to_cols).select(F.floor(F.col("id") / to_cols).alias("row"), (F.col("id") % to_cols).alias("col"))
    grid = grid.withColumns({"__r": F.floor((F.col("row") + 0.5) * rows / to_rows).cast("int"), "__c": F.floor((F.col("col") + 0.5) * cols / to_cols).cast("int")})
    src = df.select("tile", F.col("row").cast("int").alias("__r"), F.col("col").cast("int").alias("__c"), value)
    return src.join(F.broadcast(grid) if to_rows * to_cols <= 1 << 20 else grid, ["__r", "__c"]).select("tile", "row", "col", value)


def snapped_to_grid(df: DataFrame, value: str, origins: DataFrame, step: float, lattice: float) -> DataFrame:
    """Tiles laid on the lattice of a target grid (corners at multiples of ``lattice``): each target pixel whose centre lies in a tile takes the pixel beneath it.

    ``origins``: tile, west, north (of the upper left corner of pixel 0, 0). Gives ``tile row col`` and the value, rows from the north in lattice steps, columns from the west.
    """
    j = df.join(origins.select("tile", "west", "north"), "tile")
    low, high = F.col("west") + F.col("col") * step, F.col("west") + (F.col("col") + 1) * step
    top, bottom = F.col("north") - F.col("row") * step, F.col("north") - (F.col("row") + 1) * step
    span = lambda a, b: F.sequence(F.floor(a / lattice - 0.5).cast("long"), F.ceil(b / lattice - 0.5).cast("long"))
    cells = j.withColumns({"__a": low, "__b": high, "__t": top, "__u": bottom}).withColumn("__c", F.explode(span(low, high))).withColumn("__r", F.explode(span(-top, -bottom)))
    x, y = (F.col("__c") + 0.5) * lattice, -(F.col("__r") + 0.5) * lattice
    return cells.where((x >= F.col("__a")) & (x < F.col("__b")) & (y <= F.col("__t")) & (y > F.col("__u"))).select("tile", F.col("__r").alias("row"), F.col("__c").alias("col"), value)


def patches(df: DataFrame, points: DataFrame, value: str, reach: int) -> DataFrame:
    """For each point (tile, row, col) the values of the square around it, row by row; null outside the tile."""
    around = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    want = points.select("tile", F.col("row").alias("r0"), F.col("col").alias("c0")).withColumn("dy", around).withColumn("dx", around)
    want = want.withColumns({"row": F.col("r0") + F.col("dy"), "col": F.col("c0") + F.col("dx")})
    got = want.join(df.select(*KEYS, value), list(KEYS), "left")
    return got.groupBy("tile", F.col("r0").alias("row"), F.col("c0").alias("col")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("dy", "dx", F.col(value).alias("v")))), lambda x: x["v"]).alias("patch")
    )


def frame_cube(df: DataFrame, slots: list[int], value: str) -> DataFrame:
    """Slots of a tile's pixels side by side, ``slot_k`` each."""
    wide = df.groupBy(*KEYS).pivot("slot", slots).agg(F.first(value))
    return wide.withColumnsRenamed({str(k): f"slot_{k}" for k in slots})


def window_means(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Predictions of overlapping windows averaged pixel by pixel."""
    return df.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


def chips(width, height, size: int, overlap: float) -> Column:
    """Offsets of square chips that cover an image, the last ones flush with its edges."""
    step = max(1, int(size * (1 - overlap)))
    starts = lambda n: F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)), lambda x: F.greatest(F.lit(0), F.least(x, n - size))))
    return F.flatten(F.transform(starts(height), lambda y: F.transform(starts(width), lambda x: F.struct(y.cast("int").alias("y"), x.cast("int").alias("x")))))


def _sent(df: DataFrame, value: str, kernel: list[tuple[int, int, float]]) -> DataFrame:
    """Each pixel's value with a weight to every pixel that the kernel reaches, where there is one."""
    o = F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"), F.lit(w).alias("w")) for dy, dx, w in kernel]))
    sent = df.select("tile", "row", "col", value, o.alias("o")).select(
        "tile", (F.col("row") + F.col("o.dy")).alias("row"), (F.col("col") + F.col("o.dx")).alias("col"), F.col(value).alias("v"), F.col("o.w").alias("w"), ((F.col("o.dy") == 0) & (F.col("o.dx") == 0)).alias("own")
    )
    return sent


def smoothed(df: DataFrame, value: str, sigma: float, reach: int) -> DataFrame:
    """Gaussian means over the pixels there are within ``reach`` rows and columns: a pass along columns, then one along rows, so that a pixel is sent 2 * reach + 1 times in each and not to the whole square."""
    kernel = [(k, math.exp(-k * k / (2 * sigma * sigma))) for k in range(-reach, reach + 1)]
    sums = df.select("tile", "row", "col", F.col(value).cast("double").alias("v"), F.lit(1.0).alias("w"), F.lit(True).alias("own"))
    for axis in ("row", "col"):
        o = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(g).alias("g")) for k, g in kernel]))
        sent = sums.withColumn("o", o).withColumns({"v": F.col("v") * F.col("o.g"), "w": F.col("w") * F.col("o.g"), "own": F.col("own") & (F.col("o.k") == 0), axis: F.col(axis) + F.col("o.k")})
        sums = sent.groupBy("tile", "row", "col").agg(F.sum("v").alias("v"), F.sum("w").alias("w"), F.max("own").alias("own"))
    return sums.where("own").select("tile", "row", "col", (F.col("v") / F.col("w")).alias(value))


def local_contrast(df: DataFrame, value: str, reach: int) -> DataFrame:
    """How far a pixel stands out of the mean around it, as a share of that mean; null without neighbours or with a mean of 0."""
    kernel = [(y, x, 1.0) for y in range(-reach, reach + 1) for x in range(-reach, reach + 1)]
    around = F.avg(F.when(~F.col("own"), F.col("v")))
    g = _sent(df, value, kernel).groupBy("tile", "row", "col").agg(F.max(F.when(F.col("own"), F.col("v"))).alias("v"), around.alias("m"))
    return g.where("v IS NOT NULL").select("tile", "row", "col", ((F.col("v") - F.col("m")) / F.nullif(F.col("m"), F.lit(0.0))).alias("contrast"))


# -- kernels on whole arrays


def _turned(waves: np.ndarray, shape: tuple[int, int], dy: float, dx: float) -> np.ndarray:
    fy, fx = np.fft.fftfreq(shape[0])[:, None], np.fft.rfftfreq(shape[1])[None, :]
    return np.fft.irfft2(waves * (np.exp(-2j * np.pi * dy * fy) * np.exp(-2j * np.pi * dx * fx)), s=shape)


def shift_image(image: np.ndarray, dy: float, dx: float) -> np.ndarray:
    """A sub-pixel shift by the shift theorem, the edges wrapped."""
    return _turned(np.fft.rfft2(image), image.shape, dy, dx)


def _peak(a: float, b: float, c: float) -> float:
    """Offset of a parabola's vertex through three values at -1, 0 and 1."""
    bend = a - 2 * b + c
    return 0.0 if bend == 0 else 0.5 * (a - c) / bend


def phase_offset(reference: np.ndarray, moving: np.ndarray) -> tuple[float, float]:
    """How far ``moving`` must be shifted to lie on ``reference``, from the phase correlation's peak."""
    window = np.outer(np.hanning(reference.shape[0]), np.hanning(reference.shape[1]))
    cross = np.fft.fft2((reference - reference.mean()) * window) * np.conj(np.fft.fft2((moving - moving.mean()) * window))
    surface = np.fft.ifft2(cross / np.maximum(np.abs(cross), 1e-12)).real
    y, x = np.unravel_index(np.argmax(surface), surface.shape)
    h, w = surface.shape
    dy = y + _peak(surface[y - 1, x], surface[y, x], surface[(y + 1) % h, x])
    dx = x + _peak(surface[y, x - 1], surface[y, x], surface[y, (x + 1) % w])
    return (dy - h if dy > h / 2 else dy), (dx - w if dx > w / 2 else dx)


def image_information(a: np.ndarray, b: np.ndarray, bins: int = 48) -> float:
    """Mutual information of two images in nats."""
    joint = np.histogram2d(a.ravel(), b.ravel(), bins)[0] / a.size
    outer = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
    on = joint > 0
    return float((joint[on] * np.log(joint[on] / outer[on])).sum())


def information_offset(reference: np.ndarray, moving: np.ndarray, search: float = 3.0, margin: int = 4) -> tuple[float, float]:
    """The shift of the greatest mutual information, by grids that grow finer around the best; (0, 0) where nothing is gained
    or the best lies at the limit of the search."""
    inner = np.s_[margin:-margin, margin:-margin]
    score = lambda y, x: image_information(reference[inner], shift_image(moving, y, x)[inner])
    best, at, step = score(0.0, 0.0), (0.0, 0.0), search / 2
    start = best
    while step > 0.02:
        centre = at
        for dy in (-step, 0.0, step):
            for dx in (-step, 0.0, step):
                y, x = centre[0] + dy, centre[1] + dx
                if (dy or dx) and max(abs(y), abs(x)) <= search and (value := score(y, x)) > best:
                    best, at = value, (y, x)
        if at == centre:
            step /= 2
    return (0.0, 0.0) if best <= start or max(map(abs, at)) >= 0.95 * search else at


def inside_polygon(x: np.ndarray, y: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Even-odd test of points against a closed ring of corners."""
    out = np.zeros(np.broadcast(x, y).shape, bool)
    for (x1, y1), (x2, y2) in zip(ring, np.roll(ring, -1, axis=0), strict=True):
        if y1 != y2:
            out ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return out


def rasterize(polygons: list[tuple[np.ndarray, int]], west: float, north: float, size: int, step: float = 10, empty: int = 0) -> np.ndarray:
    """Values of polygons at pixel centres; a later polygon covers an earlier one."""
    out = np.full((size, size), empty)
    x, y = west + (np.arange(size) + 0.5) * step, north - (np.arange(size) + 0.5) * step
    for ring, value in polygons:
        out[inside_polygon(x[None, :], y[:, None], np.asarray(ring, float))] = value
    return out


def smooth(image: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing, edges reflected."""
    reach = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    k /= k.sum()
    for axis in (0, 1):
        padded = np.pad(image, [(reach, reach) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
        image = np.apply_along_axis(np.convolve, axis, padded, k, "valid")
    return image


def to_image(pdf: pd.DataFrame, value: str) -> np.ndarray:
    out = np.zeros((int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1))
    out[pdf["row"], pdf["col"]] = pdf[value]
    return out


def _with_anchors(df: DataFrame, value: str, anchor: int | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Frames other than their tile's anchor, and for each of them a copy of the anchor. ``anchor``: a slot, or a table of ``tile, slot``."""
    p = df.select("tile", F.col("slot").cast("int").alias("slot"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(value).cast("double").alias("v"))
    chosen = p.select("tile").distinct().withColumn("__anchor", F.lit(anchor)) if isinstance(anchor, int) else anchor.select("tile", F.col("slot").cast("int").alias("__anchor"))
    known = p.join(chosen, "tile", "left")
    own = F.coalesce(F.col("slot") == F.col("__anchor"), F.lit(False))
    moving = known.where(~own).drop("__anchor")
    copies = known.where(own).drop("slot", "__anchor").join(moving.select("tile", "slot").distinct(), "tile")
    return moving, copies


def coregistered(df: DataFrame, value: str, anchor: int | DataFrame, method: str = "information", search: float = 3.0, least: float = 0.05) -> DataFrame:
    """Frames laid on their tile's anchor, pixel by pixel: ``tile slot row col`` with the resampled ``value`` and the shift ``dy dx`` that was applied.

    A task has one frame and its anchor, however many frames a tile has. A shift is found by mutual information or by phase correlation, refused if it
    gains nothing or lies at the limit of the search, and left out below ``least`` pixels, where the frame stays as it is; frames of another shape than the anchor, or without one, stay too.
    Anchors come through untouched. Missing pixels count as 0, and have no row in the result either.
    """
    moving, copies = _with_anchors(df, value, anchor)

    def kernel(frame: pd.DataFrame, reference: pd.DataFrame) -> pd.DataFrame:
        if frame.empty:
            return pd.DataFrame(columns=["tile", "slot", "row", "col", value, "dy", "dx"])
        image, dy, dx = to_image(frame, "v"), 0.0, 0.0
        fixed = to_image(reference, "v") if len(reference) else None
        if fixed is not None and fixed.shape == image.shape and min(image.shape) >= 12:
            dy, dx = information_offset(fixed, image, search) if method == "information" else phase_offset(fixed, image)
            if max(abs(dy), abs(dx)) < least or max(abs(dy), abs(dx)) > search:
                dy, dx = 0.0, 0.0
        if dy or dx:
            image = shift_image(image, dy, dx)
        out = frame[["tile", "slot", "row", "col"]].copy()
        out[value], out["dy"], out["dx"] = image[frame["row"], frame["col"]], float(dy), float(dx)
        return out

    kind = dict(df.dtypes)["tile"]
    copies = copies.select(*[F.col(c).alias(f"{c}_" if c in ("tile", "slot") else c) for c in copies.columns])
    laid = moving.groupBy("tile", "slot").cogroup(copies.groupBy("tile_", "slot_")).applyInPandas(kernel, f"tile {kind}, slot int, row int, col int, {value} double, dy double, dx double")
    chosen = (F.col("slot") == anchor) if isinstance(anchor, int) else None
    p = df.select("tile", F.col("slot").cast("int").alias("slot"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col(value).cast("double").alias(value))
    fixed = p.where(chosen) if chosen is not None else p.join(anchor.select("tile", F.col("slot").cast("int").alias("slot")), ["tile", "slot"], "left_semi").select(*p.columns)
    return laid.unionByName(fixed.withColumns({"dy": F.lit(0.0), "dx": F.lit(0.0)}))


def register_frames(df: DataFrame, value: str, anchor: int | DataFrame, method: str = "information") -> DataFrame:
    """For each tile and slot the shift that lays its frame on the anchor's: ``tile slot dy dx``."""
    return coregistered(df, value, anchor, method).groupBy("tile", "slot").agg(F.first("dy").alias("dy"), F.first("dx").alias("dx"))


#: Pixels of a strip of a long frame, and the rows of its neighbours that it has above and below.
STRIP, HALO, BINS = 1 << 18, 32, 48


def _strips(df: DataFrame, parts: int) -> DataFrame:
    """Lines dealt to the ``n`` strips of their frame, of ``h`` rows: ``tile slot strip n h`` and ``line``, all lines of the strip in order, with ``HALO`` rows from beyond its ends, the frame's ends wrapped. A frame that is one strip has no more than its own lines."""
    low = lambda k: F.floor(F.col("h") * k / F.col("n"))
    own = F.floor(((F.col("row") + 1) * F.col("n") - 1) / F.col("h"))
    d = df.withColumn("k", own).withColumns({"lo": low(F.col("k")), "hi": low(F.col("k") + 1)})
    up, down = F.pmod(F.col("k") - 1, F.col("n")), F.pmod(F.col("k") + 1, F.col("n"))
    at = lambda k, place: F.struct(k.cast("int").alias("strip"), place.cast("long").alias("at"))
    several = F.col("n") > 1
    to = F.array(
        at(F.col("k"), F.col("row") - F.col("lo") + HALO),
        F.when(several & (F.col("row") - F.col("lo") < HALO), at(up, F.col("row") - F.col("lo") + HALO + low(up + 1) - low(up))),
        F.when(several & (F.col("hi") - F.col("row") <= HALO), at(down, F.col("row") - F.col("hi") + HALO)),
    )
    sent = d.withColumn("to", F.explode(F.array_compact(to))).select("tile", "slot", "n", "h", "to.strip", "to.at", "line")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("at", "line"))), lambda x: x["line"])
    return sent.repartition(parts, "tile", "strip").groupBy("tile", "strip", "slot", "n", "h").agg(F.flatten(lines).alias("line"))


def _binned(a: np.ndarray, low: float, high: float) -> np.ndarray:
    return np.clip(((a - low) * (BINS / ((high - low) or 1.0))).astype(np.int64), 0, BINS - 1)


def _joint_counts(asked: dict[tuple, list[tuple[float, float]]], margin: int):
    """Counts of joint bins of a strip and its shifted frame, for each shift asked for, added up over a task's strips; rows and columns at the frame's edges aren't counted."""

    def run(parts):
        held: dict[tuple, np.ndarray] = {}
        for pdf in parts:
            for r in pdf.itertuples():
                shape = (-1, r.w)
                moving, fixed = np.asarray(r.line, float).reshape(shape), np.asarray(r.fixed, float).reshape(shape)
                lo, hi = r.h * r.strip // r.n, r.h * (r.strip + 1) // r.n
                inner = np.s_[HALO + max(0, margin - lo) : HALO + min(hi, r.h - margin) - lo, margin:-margin]
                a = _binned(fixed[inner], r.low, r.high) * BINS
                waves = np.fft.rfft2(moving)
                for k, shift in enumerate(asked[r.tile, r.slot]):
                    n = np.bincount((a + _binned(_turned(waves, moving.shape, *shift)[inner], r.low2, r.high2)).ravel(), minlength=BINS * BINS)
                    held[r.tile, r.slot, k] = held.get((r.tile, r.slot, k), 0) + n
        if held:
            yield pd.DataFrame([(*key, n) for key, n in held.items()], columns=["tile", "slot", "k", "counts"])

    return run


def _information(counts: np.ndarray) -> float:
    joint = counts.reshape(BINS, BINS) / counts.sum()
    outer = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
    on = joint > 0
    return float((joint[on] * np.log(joint[on] / outer[on])).sum())


def _long_offsets(pairs: DataFrame, kind: str, search: float, margin: int = 4) -> dict[tuple, tuple[float, float]]:
    """``information_offset`` of frames of several strips: each round counts the joint bins of all strips for the shifts asked for; bins span the values of whole frames before they are shifted. One row a frame and shift reaches the driver."""
    frames = [(r["tile"], r["slot"]) for r in pairs.select("tile", "slot").distinct().collect()]

    def scores(asked: dict[tuple, list[tuple[float, float]]]) -> dict[tuple, list[float]]:
        here = pairs.where(F.struct("tile", "slot").isin([F.struct(F.lit(a), F.lit(b)) for a, b in asked])) if len(asked) < len(frames) else pairs
        counts = here.mapInPandas(_joint_counts(asked, margin), f"tile {kind}, slot int, k int, counts array<bigint>")
        total = lambda key, pdf: pd.DataFrame([(*key, _information(np.sum(pdf["counts"].tolist(), axis=0)))])
        out = {key: [0.0] * len(v) for key, v in asked.items()}
        for r in counts.groupBy("tile", "slot", "k").applyInPandas(total, f"tile {kind}, slot int, k int, value double").collect():
            out[r["tile"], r["slot"]][r["k"]] = r["value"]
        return out

    start = {k: v[0] for k, v in scores({f: [(0.0, 0.0)] for f in frames}).items()} if frames else {}
    state = {f: (start[f], (0.0, 0.0), search / 2) for f in frames}  # best, where, step
    while asked := {f: [(y, x) for dy in (-s, 0.0, s) for dx in (-s, 0.0, s) if (dy or dx) and max(abs(y := at[0] + dy), abs(x := at[1] + dx)) <= search] for f, (_, at, s) in state.items() if s > 0.02}:
        for f, values in scores(asked).items():
            best, at, step = state[f]
            top = int(np.argmax(values)) if values else 0
            state[f] = (values[top], asked[f][top], step) if values and values[top] > best else (best, at, step / 2)
    return {f: (0.0, 0.0) if best <= start[f] or max(map(abs, at)) >= 0.95 * search else at for f, (best, at, _) in state.items()}


def coregistered_lines(df: DataFrame, value: str, anchor: int, search: float = 3.0, least: float = 0.05, strip: int = STRIP) -> DataFrame:
    """``coregistered`` of frames that come as lines, ``tile slot row`` and an array of a line's values from column 0: ``tile slot strip``, ``line`` and ``fixed`` (the strip's and
    the anchor's values, row by row), ``dy dx``.

    Frames have all their lines. A task has one strip of a frame, of about ``strip`` pixels, and that of its anchor, however long frames are; shifts are found by mutual information over all strips. A strip is shifted with
    ``HALO`` rows of its neighbours. Frames of another shape than the anchor, or without one, stay, and have no ``fixed``.
    """
    kind = dict(df.dtypes)["tile"]
    p = df.select("tile", F.col("slot").cast("int").alias("slot"), F.col("row").cast("long").alias("row"), F.col(value).alias("line"))
    shapes = _saved(p.groupBy("tile", "slot").agg((F.max("row") + 1).alias("h"), F.max(F.size("line")).alias("w"), F.min(F.array_min("line")).alias("low"), F.max(F.array_max("line")).alias("high")))
    n = lambda: F.greatest(F.lit(1), F.floor(F.col("h") / F.greatest(F.lit(2 * HALO), F.floor(strip / F.col("w"))))).cast("int")
    pixels = shapes.agg(F.sum(F.col("h") * F.col("w"))).first()[0] or 0
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), pixels // (8 * STRIP))  # by number: the rows are few, and the work behind them isn't
    s = _strips(p.join(shapes, ["tile", "slot"]).withColumn("n", n()), parts)
    ranges = shapes.select("tile", "slot", "w", F.col("low").alias("low2"), F.col("high").alias("high2"))
    fixed = s.where(F.col("slot") == anchor).join(shapes.where(F.col("slot") == anchor).select("tile", "w", "low", "high"), "tile")
    fixed = fixed.select("tile", "strip", F.col("h").alias("fh"), F.col("w").alias("fw"), "low", "high", F.col("line").alias("fixed"))
    pairs = s.where(F.col("slot") != anchor).join(ranges, ["tile", "slot"]).join(fixed, ["tile", "strip"], "left")
    alike = F.coalesce((F.col("fh") == F.col("h")) & (F.col("fw") == F.col("w")), F.lit(False))
    pairs = _saved(pairs.withColumn("fixed", F.when(alike, F.col("fixed"))).drop("fh", "fw"))
    found = _long_offsets(pairs.where("n > 1 AND w >= 12 AND fixed IS NOT NULL"), kind, search)

    def lay(parts):
        for pdf in parts:
            out = []
            for r in pdf.itertuples():
                image, dy, dx = np.asarray(r.line, float).reshape(-1, r.w), 0.0, 0.0
                own = np.s_[HALO : HALO + r.h * (r.strip + 1) // r.n - r.h * r.strip // r.n] if r.n > 1 else np.s_[:]
                there = None if r.fixed is None else np.asarray(r.fixed, float).reshape(-1, r.w)
                if there is not None and min(r.h, r.w) >= 12:
                    dy, dx = found.get((r.tile, r.slot), (0.0, 0.0)) if r.n > 1 else information_offset(there, image, search)
                    if max(abs(dy), abs(dx)) < least or max(abs(dy), abs(dx)) > search:
                        dy, dx = 0.0, 0.0
                if dy or dx:
                    image = shift_image(image, dy, dx)
                out.append((r.tile, r.slot, r.strip, image[own].ravel(), None if there is None else there[own].ravel(), float(dy), float(dx)))
            yield pd.DataFrame(out, columns=["tile", "slot", "strip", "line", "fixed", "dy", "dx"])

    laid = pairs.mapInPandas(lay, f"tile {kind}, slot int, strip int, line array<double>, fixed array<double>, dy double, dx double")
    zero = F.lit(0.0)
    own = p.where(F.col("slot") == anchor).select("tile", "slot", F.col("row").cast("int").alias("strip"), "line", F.col("line").alias("fixed"), zero.alias("dy"), zero.alias("dx"))  # lines as they came
    return laid.unionByName(own)


def rasterize_tiles(tiles: DataFrame, polygons: DataFrame, size: int, step: float = 10) -> DataFrame:
    """Class of every pixel of each tile from the polygons that overlap it, in order of ``rank``: ``tile row col value``.

    ``tiles``: tile, west, south, east, north; ``polygons``: ring (array of array of double), value, rank, and their box.
    """
    from skyquilt.operators.joins import overlapping_boxes

    t = tiles.select("tile", "west", "south", "east", "north")
    p = polygons.select("ring", "value", "rank", *[F.col(c).alias(f"p_{c}") for c in ("west", "south", "east", "north")])
    box = lambda pre: tuple(f"{pre}{c}" for c in ("west", "south", "east", "north"))
    pairs = overlapping_boxes(t, p, box(""), box("p_"), size * step)

    def kernel(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        rings = [(np.array([list(c) for c in r]), int(v)) for r, v in zip(pdf["ring"], pdf["value"], strict=True)]
        image = rasterize(rings, float(pdf["west"].iloc[0]), float(pdf["north"].iloc[0]), size, step)
        r, c = np.nonzero(image)
        return pd.DataFrame({"tile": pdf["tile"].iloc[0], "row": r, "col": c, "value": image[r, c]})

    return pairs.groupBy("tile").applyInPandas(kernel, "tile string, row int, col int, value int")


def points_in_polygons(points: DataFrame, ring: list[tuple[float, float]], x: str, y: str) -> Column:
    """Whether points lie in one polygon, as an expression over its edges."""
    out = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y1 != y2:
            crosses = ((F.lit(y1) > F.col(y)) != (F.lit(y2) > F.col(y))) & (F.col(x) < (x2 - x1) * (F.col(y) - y1) / (y2 - y1) + x1)
            out = out + crosses.cast("int")
    return out % 2 == 1
