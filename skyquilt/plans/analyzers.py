"""Analyzers of scenes over pixel tables, in the order they run, chosen and set by a file.

A pixel has ``tile``, ``row``, ``col``, a class ``cls``, bands ``green``, ``red``, ``edge`` and ``nir`` and those of an earlier scene (``red0``, ``nir0``). Every analyzer gives rows of
``measure`` and ``value``; ``nmd`` takes what ``change_detection`` found before it.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyquilt.functions import spectral as P
from skyquilt.operators import iterative as I
from skyquilt.operators import lines as L
from skyquilt.plans.registry import Registry

SCENES = Registry()
SETTINGS = os.path.join(os.path.dirname(__file__), "scene_analyzers.json")


def load_settings(path: str) -> dict[str, dict] | None:
    """Settings by analyzer from a JSON file, or a YAML one where that library is installed; an analyzer with nothing but its name is on. Without a file all run."""
    if not os.path.exists(path):
        return None
    with open(path) as f:
        if path.endswith(".json"):
            read = json.load(f)
        else:
            import yaml

            read = yaml.safe_load(f)
    return {name: {"enabled": True, **(given or {})} for name, given in (read or {}).items()}


def _measures(df: DataFrame, **values: Column) -> DataFrame:
    one = df.agg(*[v.cast("double").alias(k) for k, v in values.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), F.col(k).alias("value")) for k in values])).alias("m")).select("m.*")


def _share(condition: Column) -> Column:
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def changed(df: DataFrame, threshold: float) -> Column:
    return P.band_distance([("red", "red0"), ("nir", "nir0")]) > threshold


@SCENES.add("change_detection")
def change_detection(df: DataFrame, threshold: float = 0.15, min_region_pixels: int = 50) -> DataFrame:
    """Pixels whose bands have moved farther than the threshold, and their regions that are large enough."""
    regions = I.pixel_components(df.where(changed(df, threshold)), "tile", "row", "col", min_region_pixels)
    found = _measures(df, changed=_share(changed(df, threshold)))
    return found.unionByName(_measures(regions, regions=F.count("*"), region_pixels=F.coalesce(F.sum("pixels"), F.lit(0))))


@SCENES.add("spectral")
def spectral(df: DataFrame, ndvi_threshold: float = 0.3, ndwi_threshold: float = 0.3) -> DataFrame:
    """Shares of vegetation and water by their indices."""
    return _measures(df, vegetation=_share(P.ndvi("nir", "red") > ndvi_threshold), water=_share(P.ndwi("green", "nir") > ndwi_threshold))


@SCENES.add("nmd")
def nmd(df: DataFrame, previous: dict[str, DataFrame]) -> DataFrame:
    """Mean vegetation index of each land-cover class, and the share of changed pixels that an earlier analyzer found."""
    per = df.groupBy("cls").agg(F.avg(P.ndvi("nir", "red")).alias("value")).select(F.concat(F.lit("ndvi_class_"), F.col("cls").cast("string")).alias("measure"), "value")
    return per.unionByName(previous["change_detection"].where("measure = 'changed'").select(F.lit("changed_before").alias("measure"), "value"))


@SCENES.add("cot")
def cot(df: DataFrame, thick: float = 0.025, thin: float = 0.015) -> DataFrame:
    """Shares of thick and thin cloud by optical thickness."""
    kind = P.cloud_thickness("cot", thick, thin)
    return _measures(df, thick=_share(kind == "thick"), thin=_share(kind == "thin"))


@SCENES.add("vegetation_edge")
def vegetation_edge(df: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Edges of vegetation as lines: how many vertices they have."""
    lines = L.contours(df.select("tile", "row", "col", P.ndvi("nir", "red").alias("v")), "v", threshold)
    return _measures(lines, edge_vertices=F.count("*"))


@SCENES.add("water_quality")
def water_quality(df: DataFrame, k: float = 0.389) -> DataFrame:
    """Means of both chlorophyll indices."""
    return _measures(df, ndci=F.avg(P.ndci("edge", "red")), mci=F.avg(P.mci("edge", "nir", "red", k)))


def analyze(df: DataFrame, settings: dict[str, dict] | None) -> DataFrame:
    """``analyzer, state, measure, value``: the measures of analyzers that ran, and a row without a measure for those that are off or failed."""
    out = None
    for r in SCENES.run(df, settings):
        name = F.lit(r.analyzer).alias("analyzer")
        if r.output is None:
            state = "off" if r.skipped else "failed"
            part = df.sparkSession.createDataFrame([(r.analyzer, state, None, None)], "analyzer string, state string, measure string, value double")
        else:
            part = r.output.select(name, F.lit("done").alias("state"), "measure", "value")
        out = part if out is None else out.unionByName(part)
    return out
