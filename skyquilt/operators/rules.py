"""Data-quality rules: each a condition with a reason; verdicts and tallies come from any list of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyquilt.functions.spectral import col


@dataclass(frozen=True)
class Rule:
    """``broken`` holds for rows that break the rule; null counts as not broken."""

    reason: str
    broken: Column
    action: str = "none"


def audit(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``reasons``, ``needs`` (actions) and ``verdict`` of every row, in one pass."""
    found = F.filter(F.array(*[F.when(F.coalesce(r.broken, F.lit(False)), F.lit(r.reason)) for r in rules]), lambda x: x.isNotNull())
    needs = F.array_distinct(F.filter(F.array(*[F.when(F.coalesce(r.broken, F.lit(False)) & F.lit(r.action != "none"), F.lit(r.action)) for r in rules]), lambda x: x.isNotNull()))
    return df.withColumns({"reasons": found, "needs": needs}).withColumn("verdict", F.when(F.size("reasons") > 0, "fail").otherwise("pass"))


def tally(audited: DataFrame, tile: str) -> DataFrame:
    """Tiles for each reason, up to its colon."""
    return audited.select(tile, F.explode("reasons").alias("r")).groupBy(F.split("r", ":")[0].alias("reason")).agg(F.count_distinct(tile).alias("tiles"))


def frame_rules(autumn_from: int = 244, summer_until: int = 200) -> list[Rule]:
    """Checks of a tile's frames: columns n_frames, mask and days (arrays of int), dates (array of date)."""
    days, mask, dates = F.col("days"), F.col("mask"), F.col("dates")
    on = F.filter(F.transform(dates, lambda d, i: F.when(F.get(mask, i) == 1, d)), lambda d: d.isNotNull())
    return [
        Rule("shape: frame count", F.col("n_frames") != F.size(mask)),
        Rule("mask: no valid frame", ~F.exists(mask, lambda m: m == 1), "refetch"),
        Rule("date: missing on a valid frame", F.exists(F.arrays_zip(mask.alias("m"), dates.alias("d")), lambda x: (x["m"] == 1) & x["d"].isNull()), "refetch"),
        Rule("day: differs from date", F.exists(F.arrays_zip(days.alias("n"), dates.alias("d")), lambda x: F.dayofyear(x["d"]) != x["n"]), "recompute"),
        Rule("order: dates don't ascend", F.exists(F.transform(on, lambda d, i: d <= F.get(on, i - 1)), lambda x: x), "reorder"),
        Rule("autumn: first slot too early", F.get(days, F.lit(0)) < autumn_from),
        Rule("summer: last slot too early", F.get(days, F.lit(3)) < summer_until),
    ]


def label_rules(n_classes: int, least_crop: float = 0.05, most_uniform: float = 0.95) -> list[Rule]:
    """Checks of a tile's labels: columns min_label, max_label, background, top_share, expected, expected_share."""
    return [
        Rule("range: label outside the classes", (F.col("min_label") < 0) | (F.col("max_label") >= n_classes), "relabel"),
        Rule("background: nothing else", F.col("background") >= 1.0, "relabel"),
        Rule("uniform: one class nearly everywhere", F.col("top_share") >= most_uniform),
        Rule("expected: class absent", F.col("expected").isNotNull() & (F.col("expected_share") == 0), "refetch"),
        Rule("expected: class below its share", F.col("expected").isNotNull() & (F.col("expected_share") > 0) & (F.col("expected_share") < least_crop)),
    ]


def tile_rules(n_classes: int, size: Column, codes: tuple[int, ...], least_crop: float = 0.05, most_uniform: float = 0.95) -> list[Rule]:
    """All checks of a tile's labels: those of ``label_rules`` (of which the share of an expected class counts only where another one is more frequent), its shape, and for tiles of crops their codes, parcels and year.

    Columns: those of ``label_rules``, ``pixels``, ``is_crop``, ``found`` (array of codes), ``parcels``, ``parcel_year``, ``first_year``, ``top``.
    """
    crop = F.col("is_crop")
    unknown = F.exists("found", lambda c: ~c.isin(*codes))
    labels = [r for r in label_rules(n_classes, least_crop, most_uniform) if not r.reason.endswith("below its share")]
    return [
        *labels,
        Rule("expected: class below its share", crop & (F.col("expected_share") > 0) & (F.col("expected_share") < least_crop) & (F.col("top") != F.col("expected"))),
        Rule("shape: number of pixels", F.col("pixels") != size, "rebuild"),
        Rule("codes: unknown", crop & unknown),
        Rule("parcels: none on a tile of crops", crop & (F.col("parcels") == 0), "rebuild"),
        Rule("year: parcels of another year", crop & (F.col("parcel_year") != F.col("first_year")), "refetch"),
    ]


def key_parity(staging: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, and which: none where both were written alike."""
    both = staging.select(key).distinct().withColumn("s", F.lit(1)).withColumn("l", F.lit(0)).unionByName(live.select(key).distinct().withColumn("s", F.lit(0)).withColumn("l", F.lit(1)))
    sides = both.groupBy(key).agg(F.max("s").alias("s"), F.max("l").alias("l"))
    return sides.where("s <> l").select(key, F.when(F.col("s") == 1, "staging").otherwise("live").alias("only_in"))


def postprocess_verdict(frames: DataFrame, tile: str, most_missing: float = 0.05, least_frames: int = 3) -> DataFrame:
    """What becomes of each tile after processing: removed for missing data in a frame that is there, or for too few frames, else kept; with its number of frames.

    ``frames``: tile, mask (1 where the frame is there), missing (share of pixels without data).
    """
    on = F.col("mask") == 1
    a = frames.groupBy(tile).agg(F.count_if(on).alias("frames"), F.bool_or(on & (F.col("missing") > most_missing)).alias("__gap"))
    return a.select(tile, "frames", F.when(F.col("__gap"), "missing_data").when(F.col("frames") < least_frames, "few_frames").otherwise("kept").alias("verdict"))


def alignment(df: DataFrame, tile: str, forest: Column, aux: Column, least_phi: float = 0.15, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Whether a forestry layer lies where the forest is: their correlation; tiles nearly all or hardly forest are skipped."""
    from skyquilt.operators.aggregates import phi

    a = df.groupBy(tile).agg(F.avg(forest.cast("double")).alias("forest_share"), phi(forest, aux).alias("phi"))
    return a.withColumn("verdict", F.when(~F.col("forest_share").between(low, high), "skip").when(F.col("phi") >= least_phi, "pass").otherwise("fail"))


def demotion(frames: DataFrame, tile: str, least_valid: float = 0.9, least_good: int = 3) -> DataFrame:
    """Frames without enough data are switched off where enough good ones stay: action clean, demote or refetch, and the new masks.

    ``frames``: tile, slot, valid_frac, mask.
    """
    bad = (F.col("mask") == 1) & (F.col("valid_frac") < least_valid)
    per = F.sort_array(F.collect_list(F.struct("slot", bad.alias("bad"), F.when(bad, 0).otherwise(F.col("mask")).alias("mask"))))
    a = frames.groupBy(tile).agg(F.count_if((F.col("mask") == 1) & ~bad).alias("n_good"), per.alias("f"))
    bad_slots = F.transform(F.filter("f", lambda x: x["bad"]), lambda x: x["slot"])
    action = F.when(F.size(bad_slots) == 0, "clean").when(F.col("n_good") >= least_good, "demote").otherwise("refetch")
    return a.select(tile, "n_good", bad_slots.alias("bad_slots"), F.transform("f", lambda x: x["mask"]).alias("new_mask"), action.alias("action"))


def season_complete(mask) -> Column:
    """Whether the three frames after the first are there."""
    return F.forall(F.slice(mask, 2, 3), lambda x: x == 1)


def coverage_verdict(valid, least: float = 0.9) -> Column:
    return F.when(col(valid) >= least, "pass").otherwise("fail")


def present_but_empty(flags: list[tuple[str, Column]]) -> list[Rule]:
    """A flag says that a layer is there, and there is nothing in it."""
    return [Rule(f"{flag}: set without data", (F.col(flag) == 1) & ~F.coalesce(has, F.lit(False)), "redo") for flag, has in flags]


def box_matches(west, east, size_px, step: float = 10) -> Column:
    return F.abs((col(east) - col(west)) - col(size_px) * step) < 1e-6


def merge_allowed(staging: DataFrame, live: DataFrame, key: str) -> DataFrame:
    """One row: keys in both, and whether the merge may go on (none are)."""
    both = staging.select(key).distinct().join(live.select(key), key, "left_semi").agg(F.count("*").alias("collisions"))
    return both.withColumn("allowed", F.col("collisions") == 0)


def is_stale(reference, last, lookback_from=None) -> Column:
    """Newer than what was fetched last; with ``lookback_from`` also whatever is newer than that."""
    out = col(reference) > F.coalesce(col(last), F.lit(0))
    return out if lookback_from is None else out | (col(reference) > col(lookback_from))
