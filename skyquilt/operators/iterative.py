"""Greedy and iterative algorithms: set cover, suppression by distance, spacing, grids, components, stages."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyquilt.operators.joins import small


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local session without the setting has one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = folder or "file:///tmp/checkpoints/skyquilt"
    return (folder if ":" in folder else f"file://{folder}").rstrip("/")


def _table(df: DataFrame) -> DataFrame:
    """Written to the checkpoint folder: each round starts from files, not from all rounds before."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def _saved(df: DataFrame) -> DataFrame:
    """Written to the shared folder as compressed Parquet and read again, so that Spark knows its size when it joins."""
    path = f"{shared_folder(df.sparkSession)}/saved-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_cover(pairs: DataFrame, item: str, candidate: str, cost: str | None = None, penalty: float = 0.001) -> DataFrame:
    """Greedy cover of all items: in each round the candidate with the highest (newly covered - penalty * cost), the least of equals.

    A row of ``pairs`` says that a candidate covers an item. Items stay distributed; one row a round reaches the driver.
    """
    spark, left, out = pairs.sparkSession, pairs.select(item, candidate, *([cost] if cost else [])).distinct(), []
    left = _table(left)
    while True:
        score = F.count_distinct(item) - (penalty * F.coalesce(F.min(cost), F.lit(0.0)) if cost else F.lit(0.0))
        best = left.groupBy(candidate).agg(F.count_distinct(item).alias("covered"), score.alias("score")).orderBy(F.desc("score"), candidate).first()
        if best is None:
            break
        out.append((len(out) + 1, best[candidate], best["covered"]))
        covered = left.where(F.col(candidate) == F.lit(best[candidate])).select(item).distinct()
        left = _table(left.join(covered, item, "left_anti"))
    kind = dict(pairs.dtypes)[candidate]
    return spark.createDataFrame(out, f"round int, {candidate} {kind}, covered bigint")


def suppress_near(df: DataFrame, image: str, x: str, y: str, score: str, unique: str, distance: float) -> DataFrame:
    """In each image, best score first, detections nearer than ``distance`` to one that is kept go.

    Cells are so small that two detections of one are always near each other: only the best undecided one of a cell, its candidate, can be
    kept next. A candidate is kept once no better undecided detection is near it, and those near a kept one go. Detections meet the
    candidates of the 25 cells around them, which are as many as the area holds, and not each other; so no pairs are written, and no image is gathered in one task.
    """
    side = 0.7 * distance  # the diagonal is 0.99 distances, and two cells on is as far as a distance reaches
    cell = lambda c: F.floor(F.col(c) / side).cast("long")
    d = df.select(image, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), F.col(score).cast("double").alias("s"), F.col(unique).alias("u"))
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3)]))
    close = (F.col("x") - F.col("x2")) ** 2 + (F.col("y") - F.col("y2")) ** 2 < distance * distance
    better = (F.col("s") > F.col("t")) | ((F.col("s") == F.col("t")) & (F.col("u") < F.col("v")))

    def sent(points: DataFrame) -> DataFrame:
        """Points to the cells around them, as ``v t x2 y2``."""
        out = points.withColumn("n", around).select(image, (F.col("cx") + F.col("n.i")).alias("cx"), (F.col("cy") + F.col("n.j")).alias("cy"), F.col("u").alias("v"), F.col("s").alias("t"), F.col("x").alias("x2"), F.col("y").alias("y2"))
        return small(out)

    placed = F.col("s").isNotNull() & (F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))
    alone = ~F.coalesce(placed, F.lit(False))  # near nothing, or better than nothing
    kept, open_ = d.where(alone).select(image, "u"), _table(d.where(~alone).withColumns({"cx": cell("x"), "cy": cell("y")}))
    while not open_.isEmpty():
        first = F.min_by(F.struct("s", "u", "x", "y"), F.struct(~F.isnan("s"), -F.col("s"), "u")).alias("b")  # not a number is above all numbers
        best = _table(open_.groupBy(image, "cx", "cy").agg(first).select(image, "cx", "cy", "b.*"))
        blocked = open_.join(sent(best), [image, "cx", "cy"]).where(better & close).select(image, F.col("v").alias("u")).distinct()
        free = _table(best.join(blocked, [image, "u"], "left_anti"))
        kept = kept.unionByName(free.select(image, "u"))
        taken = sent(free).alias("f")
        same = [F.col(f"o.{c}") == F.col(f"f.{c}") for c in (image, "cx", "cy")]
        open_ = _table(open_.alias("o").join(taken, [*same, close], "left_anti"))
    return df.join(kept.withColumnRenamed("u", unique), [image, unique], "left_semi")


def spaced_points(df: DataFrame, region: str, x: str, y: str, order: str, distance: float) -> DataFrame:
    """Points in order, each kept unless a kept one is within ``distance``: suppression with the order as the score."""
    return suppress_near(df.withColumn("__s", -F.col(order)), region, x, y, "__s", order, distance).drop("__s")


def grid(spark: SparkSession, west: float, south: float, east: float, north: float, step: float) -> DataFrame:
    """Centres of a regular grid."""
    nx, ny = int((east - west) // step), int((north - south) // step)
    return spark.range(nx * ny).select(
        (F.col("id") % nx).alias("i"), F.floor(F.col("id") / nx).alias("j"), (west + (F.col("id") % nx + 0.5) * step).alias("x"), (south + (F.floor(F.col("id") / nx) + 0.5) * step).alias("y")
    )


def _united(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``u`` and ``l``, the least vertex of its component, of the edges of one task."""
    parent = {}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for part in parts:
        for u, v in zip(part["u"], part["v"], strict=True):
            a, b = sorted((find(parent.setdefault(u, u)), find(parent.setdefault(v, v))))
            parent[b] = a
    yield pd.DataFrame({"u": list(parent), "l": [find(x) for x in parent]})


def components(edges: DataFrame, a: str = "a", b: str = "b", alone: int = 0) -> DataFrame:
    """``id`` and ``component`` (its least id), by contraction.

    In each round a vertex goes to the first of its neighbourhood in an order drawn by hash, and edges then join where their ends went; so in expectation a
    share of the vertices is left whatever the order of ids, and all rounds together move little more than the first ones. Once at most ``alone`` edges are
    left, one task unites their ends. Where vertices go is kept as Parquet: with
    checkpoints alone the planning of each round took longer than that of the one before, without end after about ten.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e, moves, least, number = _table(e.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()), [], None, 0
    while (left := e.limit(alone + 1).count()) > alone:
        drawn = lambda c: F.xxhash64(F.lit(number), F.col(c))  # noqa: B023, E731
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = both.groupBy("u").agg(F.min_by("v", drawn("v")).alias("v"), F.min(drawn("v")).alias("h"))
        step = _saved(first.select("u", F.when(drawn("u") <= F.col("h"), F.col("u")).otherwise(F.col("v")).alias("r")))
        name = step.withColumn("l", F.col("u")) if least is None else step.join(least.withColumnRenamed("r", "u"), "u")
        # a vertex that nothing goes on from keeps its name: the least id of all that went to it
        least = _table(name.groupBy("r").agg(F.min("l").alias("l")))
        to = lambda c: step.select(F.col("u").alias(c), F.col("r").alias(f"{c}2"))  # noqa: B023, E731
        e = e.join(to("u"), "u").join(to("v"), "v").where("u2 <> v2")
        e = _table(e.select(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v")).distinct())
        moves.append((step, least))
        number += 1
    labels = None
    if left or not moves:
        kind = dict(e.dtypes)["u"]
        labels = _table(e.coalesce(1).mapInPandas(_united, f"u {kind}, l {kind}"))
        if least is not None:  # the least vertex by its name, which is the least of all that went to it
            named = labels.join(least.withColumnRenamed("l", "m"), labels["u"] == least["r"]).select("u", labels["l"], "m")
            lowest = named.groupBy("l").agg(F.min("m").alias("m"))
            labels = _table(named.select("u", "l").join(lowest, "l").select("u", F.col("m").alias("l")))
    for k in range(len(moves) - 1, -1, -1):
        step, here = moves[k]
        ends = here if labels is None else here.join(labels.withColumnRenamed("u", "r").withColumnRenamed("l", "m"), "r", "left").select("r", F.coalesce("m", "l").alias("l"))
        labels = _table(step.join(ends, "r").select("u", "l")) if k else step.join(ends, "r").select("u", "l")
    return labels.select(F.col("u").alias("id"), F.col("l").alias("component"))


def components_by_key(links: DataFrame, node: str, key: str, alone: int = 20_000) -> DataFrame:
    """As components(), of nodes that share keys; no id is both. The nodes of a key are linked to its least one, so that keys, of which most may have one node
    only, aren't contracted; they follow that node.
    """
    of_key = Window.partitionBy("b").orderBy("a")
    x = links.select(F.col(node).alias("a"), F.col(key).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    x = _saved(x.select("a", "b", F.first("a").over(of_key).alias("r"), (F.row_number().over(of_key) == 1).alias("one")))
    found = components(x.where("a <> r"), "a", "r", alone).withColumnRenamed("id", "r")
    members = x.where("one").select(F.col("b").alias("id"), "r").unionByName(x.select(F.col("a").alias("id"), F.col("a").alias("r")).distinct())
    members = _saved(members.join(found, "r", "left").select("id", F.coalesce("component", "r").alias("c")))
    return members.join(members.groupBy("c").agg(F.min("id").alias("component")), "c").select("id", "component")


def pixel_components(pixels: DataFrame, tile: str, row: str, column: str, least: int = 1) -> DataFrame:
    """Regions of 4-connected pixels of each tile with their boxes; ``pixels`` holds the set ones.

    A tile's runs of pixels in a row are found by windows; runs that touch in neighbouring rows are edges.
    """
    p = pixels.select(F.col(tile).alias("tile"), F.col(row).cast("long").alias("r"), F.col(column).cast("long").alias("c")).distinct()
    island = F.col("c") - F.row_number().over(Window.partitionBy("tile", "r").orderBy("c"))
    runs = p.withColumn("i", island).groupBy("tile", "r", "i").agg(F.min("c").alias("c0"), F.max("c").alias("c1"))
    runs = _table(runs.select(F.concat_ws("/", F.col("tile").cast("string"), F.format_string("%010d", "r"), F.format_string("%010d", "c0")).alias("run"), "tile", "r", "c0", "c1"))
    below = runs.select("tile", (F.col("r") - 1).alias("r"), F.col("run").alias("run2"), F.col("c0").alias("d0"), F.col("c1").alias("d1"))
    touching = runs.join(below, ["tile", "r"]).where("d0 <= c1 AND d1 >= c0").select(F.col("run").alias("a"), F.col("run2").alias("b"))
    found = components(touching)
    named = runs.join(found.withColumnRenamed("id", "run"), "run", "left").withColumn("component", F.coalesce("component", "run"))
    size = named.groupBy("tile", "component").agg(
        F.sum(F.col("c1") - F.col("c0") + 1).alias("pixels"), F.min("r").alias("y_min"), F.max("r").alias("y_max"), F.min("c0").alias("x_min"), F.max("c1").alias("x_max")
    )
    return size.where(F.col("pixels") >= least)


def advance(stages: list[tuple[str, Callable[[], str]]], state: dict[str, str]) -> dict[str, str]:
    """Run the first stage that isn't done and return the new state; a failed gate halts all later ones."""
    if any(v == "halted" for v in state.values()):
        return state
    for name, run in stages:
        if state.get(name) != "done":
            return {**state, name: "done" if run() == "pass" else "halted"}
    return state


def per_group(df: DataFrame, keys: list[str], kernel: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A numpy kernel on each tile's rows, which fit a task by construction (a tile has a fixed size)."""
    return df.groupBy(*keys).applyInPandas(kernel, schema)


def batches(df: DataFrame, kernel: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield kernel(p)

    return df.mapInPandas(run, schema)

