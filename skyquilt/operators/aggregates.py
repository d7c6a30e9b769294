"""Aggregations: shares and histograms, robust statistics, thresholds from histograms, weights, progress, funnels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.functions.spectral import col


def share_where(condition: Column) -> Column:
    """Share of rows for which ``condition`` holds; of no rows 0."""
    return F.coalesce(F.avg(F.coalesce(condition, F.lit(False)).cast("double")), F.lit(0.0))


def share_inside(condition: Column, mask: Column, empty: float = 1.0) -> Column:
    """Share among the rows inside the mask; ``empty`` if none are."""
    return F.coalesce(F.avg(F.when(mask, condition.cast("double"))), F.lit(empty))


def class_histogram(df: DataFrame, level: Column, name: Column) -> DataFrame:
    """Counts and shares of classes at a level; shares are of all rows at that level, to four places."""
    counts = df.groupBy(level.alias("level"), name.alias("class")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("level"))
    return counts.withColumn("fraction", F.round(F.col("n") / total, 4))


def two_level_histogram(df: DataFrame, first: str, second: str) -> DataFrame:
    """Class histograms of two columns in one pass over the rows."""
    counts = df.groupingSets([[first], [second]], first, second).agg(F.grouping(first).alias("g"), F.count("*").alias("n"))
    level = F.when(F.col("g") == 0, "l1").otherwise("l2")
    total = F.sum("n").over(Window.partitionBy("g"))
    return counts.select(level.alias("level"), F.when(F.col("g") == 0, F.col(first)).otherwise(F.col(second)).alias("class"), "n", F.round(F.col("n") / total, 4).alias("fraction"))


def best_per(df: DataFrame, keys: list[str], value: str, missing: float | None = None) -> DataFrame:
    """The least value of each key; a null counts as ``missing``, or not at all."""
    v = F.col(value) if missing is None else F.coalesce(F.col(value), F.lit(missing))
    return df.groupBy(*keys).agg(F.min(v).alias(value))


def _place_among(v: Column, cuts: list[float]) -> Column:
    """How many of the ascending cuts lie below ``v``: a tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(v > cuts[middle], tree(middle + 1, high)).otherwise(tree(low, middle))

    return tree(0, len(cuts))


def _percentiles_of_all(values: DataFrame, shares: list[float], buckets: int) -> DataFrame:
    """``p`` and ``n`` of a column ``__v`` without nulls.

    Approximate cuts and one count a range reach the driver; of the values, only the ranges that hold the ranks asked for are shuffled and sorted.
    """
    cuts = sorted(set(values.agg(F.percentile_approx("__v", [k / buckets for k in range(1, buckets)], 1000).alias("c")).first()["c"] or []))
    ranged = values.withColumn("__r", _place_among(F.col("__v"), cuts))
    sizes = {r["__r"]: r["n"] for r in ranged.groupBy("__r").agg(F.count("*").alias("n")).collect()}
    total, offset, starts = sum(sizes.values()), 0, {}
    for r in sorted(sizes):
        starts[r] = offset
        offset += sizes[r]
    if not total:
        return values.sparkSession.createDataFrame([([None] * len(shares), None)], "p array<double>, n bigint")
    place = [q * (total - 1) for q in shares]
    ranks = sorted({int(f(x)) for x in place for f in (math.floor, math.ceil)})
    wanted = sorted({max(r for r in starts if starts[r] <= k) for k in ranks})
    base = F.element_at(F.create_map(*[F.lit(x) for r in wanted for x in (r, starts[r])]), F.col("__r"))
    run = Window.partitionBy("__r").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    counts = ranged.where(F.col("__r").isin(wanted)).groupBy("__r", "__v").agg(F.count("*").alias("__n"))
    c = counts.withColumn("__to", base + F.sum("__n").over(run)).withColumn("__from", F.col("__to") - F.col("__n"))
    at = c.agg(*[F.max(F.when((F.col("__from") <= k) & (k < F.col("__to")), F.col("__v"))).alias(f"__{k}") for k in ranks])

    def between(x: float) -> Column:
        a, b = F.col(f"__{math.floor(x)}"), F.col(f"__{math.ceil(x)}")
        return F.when(a == b, a).otherwise((math.ceil(x) - x) * a + (x - math.floor(x)) * b)

    return at.select(F.array(*map(between, place)).alias("p"), F.lit(total).cast("bigint").alias("n"))


def exact_percentiles(df: DataFrame, value: str, shares: list[float], keys: list[str] = (), buckets: int = 64) -> DataFrame:
    """``p``, the exact percentiles (interpolated) of the values that aren't null, and ``n``, their number, for each key.

    The input is read three times: for approximate cuts, for one count a range, and for the ranges that hold the percentiles, the only ones that are
    shuffled and sorted. Neither a task nor a buffer holds all values of a key.
    """
    if not keys:
        return _percentiles_of_all(df.select(F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL"), shares, buckets)
    keys, at = list(keys), [f"__h{i}" for i in range(len(shares))]
    known = df.select(*keys, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL")
    cuts = known.groupBy(*keys).agg(F.array_distinct(F.percentile_approx("__v", [k / buckets for k in range(1, buckets)], 1000)).alias("__cuts"))
    steps = F.array(*[F.lit(1 << k) for k in range(buckets.bit_length() - 1, -1, -1)])
    below = F.aggregate(steps, F.lit(0), lambda found, width: F.when(F.get("__cuts", found + width - 1) < F.col("__v"), found + width).otherwise(found))  # how many cuts, by halving steps
    ranged = known.join(cuts, keys).withColumn("__r", below).drop("__cuts")
    w = Window.partitionBy(*keys)  # at most ``buckets`` rows a key
    sums = ranged.groupBy(*keys, "__r").agg(F.count("*").alias("__s"))
    sums = sums.select(*keys, "__r", "__s", (F.sum("__s").over(w.orderBy("__r")) - F.col("__s")).alias("__o"), F.sum("__s").over(w).alias("__all"))
    ranks = F.array(*[f(F.lit(float(q)) * (F.col("__all") - 1)) for q in shares for f in (F.floor, F.ceil)])
    wanted = sums.where(F.exists(ranks, lambda k: (F.col("__o") <= k) & (k < F.col("__o") + F.col("__s")))).drop("__s")
    counts = ranged.join(wanted, [*keys, "__r"]).groupBy(*keys, "__r", "__v", "__o", "__all").agg(F.count("*").alias("__n"))
    run = Window.partitionBy(*keys, "__r").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    c = counts.withColumn("__to", F.col("__o") + F.sum("__n").over(run)).withColumn("__from", F.col("__to") - F.col("__n"))
    c = c.withColumns({h: F.lit(float(q)) * (F.col("__all") - 1) for h, q in zip(at, shares, strict=True)})
    value_at = lambda k: F.max(F.when((F.col("__from") <= k) & (k < F.col("__to")), F.col("__v")))
    ends = [x.alias(f"{h}{side}") for h in at for side, x in (("a", value_at(F.floor(h))), ("b", value_at(F.ceil(h))))]
    g = c.groupBy(*keys).agg(F.max("__all").alias("n"), *ends)

    def between(h: str, q: float) -> Column:
        place = F.lit(float(q)) * (F.col("n") - 1)
        a, b = F.col(f"{h}a"), F.col(f"{h}b")
        return F.when(a == b, a).otherwise((F.ceil(place) - place) * a + (place - F.floor(place)) * b)

    return g.select(*keys, F.array(*[between(h, q) for h, q in zip(at, shares, strict=True)]).alias("p"), "n")


def robust_stats(df: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """Count, mean, median, 95th percentile and greatest of the finite values."""
    keys, v = list(keys), F.col(value).cast("double")
    ok = F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
    finite = df.select(*keys, ok.alias("__ok"))
    a = finite.groupBy(*keys).agg(F.count("__ok").alias("n"), F.avg("__ok").alias("mean"), F.max("__ok").alias("max"))
    p = exact_percentiles(finite, "__ok", [0.5, 0.95], keys).drop("n")
    joined = a.join(p, keys, "left") if keys else a.join(F.broadcast(p), F.lit(True), "left")
    return joined.select(*keys, "n", "mean", F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"), "max")


def hour_means(df: DataFrame, ts: str, value: str, hours: list[int]) -> DataFrame:
    """Daily means of the values at the given hours."""
    return df.where(F.hour(ts).isin(*hours)).groupBy(F.to_date(ts).alias("day")).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def channel_moments(df: DataFrame, group: str, channels: list[str]) -> DataFrame:
    """Mean, deviation, extremes and number of groups of the positive values of each channel."""
    long = df.select(group, F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).cast("double").alias("v")) for c in channels])).alias("x")).select(group, "x.*").where("v > 0")
    return long.groupBy("channel").agg(
        F.count("*").alias("n"), F.avg("v").alias("mean"), F.greatest(F.stddev_pop("v"), F.lit(1e-6)).alias("std"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.count_distinct(group).alias("groups"),
    )


def modal_class(df: DataFrame, keys: list[str], value: str, tie: str = "lowest") -> DataFrame:
    """The most frequent value of each key; the lowest or the highest of equally frequent ones."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    order = F.col(value) if tie == "highest" else -F.col(value)
    return n.groupBy(*keys).agg(F.max_by(value, F.struct(F.col("n"), order)).alias(value), F.max("n").alias("n"))


def ledger_groups(df: DataFrame, group: str, cohort: str) -> DataFrame:
    """Rows and cohorts of each group, the cohorts' names (a few a group), and whether it has several."""
    n = df.groupBy(group, cohort).agg(F.count("*").alias("n"))
    g = n.groupBy(group).agg(F.sum("n").alias("n"), F.count("*").alias("cohorts"), F.array_join(F.array_sort(F.collect_list(cohort)), ",").alias("held"))
    return g.withColumn("several", F.col("cohorts") > 1)


def histogram(df: DataFrame, value: str, bins: int, low: float = 0.01, high: float = 0.99, keys: list[str] = ()) -> DataFrame:
    """Counts of ``bins`` equal bins between two percentiles; values beyond fall into the outer bins. Columns lo, hi, bin, n."""
    limits = exact_percentiles(df, value, [low, high], keys).withColumnRenamed("p", "__p").drop("n")
    joined = df.join(limits, list(keys)) if keys else df.join(F.broadcast(limits), F.lit(True))
    lo, hi = F.col("__p")[0], F.col("__p")[1]
    at = F.floor((F.col(value) - lo) / F.greatest(hi - lo, F.lit(1e-12)) * (bins - 1))
    at = F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)).cast("int")
    return joined.groupBy(*keys, lo.alias("lo"), hi.alias("hi"), at.alias("bin")).agg(F.count("*").alias("n"))


def otsu(df: DataFrame, value: str, bins: int = 256, keys: list[str] = ()) -> DataFrame:
    """The threshold that parts a histogram into two classes of the greatest variance between them."""
    h = histogram(df, value, bins, keys=keys)
    up = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # bins of a key: few rows
    every = Window.partitionBy(*keys)
    w0, s0 = F.sum("n").over(up), F.sum(F.col("n") * F.col("bin")).over(up)
    w, s = F.sum("n").over(every), F.sum(F.col("n") * F.col("bin")).over(every)
    parted = h.select(*keys, "lo", "hi", "bin", w0.alias("w0"), s0.alias("s0"), w.alias("w"), s.alias("s"))
    w1, s1 = F.col("w") - F.col("w0"), F.col("s") - F.col("s0")
    gap = F.col("s0") / F.col("w0") - F.coalesce(s1 / F.nullif(w1, F.lit(0)), F.col("s0") / F.col("w0"))
    between = F.col("w0").cast("double") * w1 * gap * gap
    best = F.max_by(F.struct("bin", "lo", "hi"), F.struct(F.round(between, 3), -F.col("bin"))).alias("b")
    return parted.groupBy(*keys).agg(best).select(*keys, (F.col("b.lo") + (F.col("b.hi") - F.col("b.lo")) * F.col("b.bin") / (bins - 1)).alias("threshold"))


def weighted_peaks(df: DataFrame, value: str, bins: int = 256, sigma: float = 3.0, high_share: float = 0.2, least_rows: int = 100, fallback: float = 0.3) -> DataFrame:
    """A threshold between the two highest peaks of a smoothed histogram, ``high_share`` of the way from the lower-placed one.

    With fewer than ``least_rows`` rows ``fallback``; with one peak Otsu's threshold. The smoothing is a join of the
    histogram's bins with their neighbours, ``bins`` rows whatever the input.
    """
    h = histogram(df, value, bins)
    spark = df.sparkSession
    reach = int(4 * sigma)
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin")).join(F.broadcast(h.select("lo", "hi").distinct()), F.lit(True))
    full = grid.join(h.select("bin", "n"), "bin", "left").fillna({"n": 0})
    kernel = [(d, 2.718281828459045 ** (-(d * d) / (2 * sigma * sigma))) for d in range(-reach, reach + 1)]
    total = sum(k for _, k in kernel)
    order = Window.orderBy("bin")
    smooth = F.lit(0.0)
    for d, k in kernel:
        near = F.col("n") if d == 0 else F.lead("n", d).over(order) if d > 0 else F.lag("n", -d).over(order)
        smooth = smooth + F.coalesce(near, F.lit(0)) * (k / total)
    s = full.select("bin", "lo", "hi", F.round(smooth, 9).alias("v"))
    peaks = s.withColumns({"a": F.lag("v").over(order), "b": F.lead("v").over(order)}).where("v > coalesce(a, -1) AND v >= coalesce(b, -1) AND v > 0")
    first = F.max(F.struct("v", (-F.col("bin")).alias("m")))
    top = peaks.agg(first.alias("p")).select((-F.col("p.m")).alias("p1"))
    second = peaks.join(F.broadcast(top), F.lit(True)).where(F.abs(F.col("bin") - F.col("p1")) >= bins / 8)
    both = second.groupBy("p1").agg((-F.max(F.struct("v", (-F.col("bin")).alias("m")))["m"]).alias("p2"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    place = lambda c: F.col("lo") + (F.col("hi") - F.col("lo")) * c / (bins - 1)
    found = both.select((high_share * place(F.greatest("p1", "p2")) + (1 - high_share) * place(F.least("p1", "p2"))).alias("t"))
    n = df.agg(F.count(value).alias("n"))
    return (
        n.join(found, F.lit(True), "left").join(otsu(df, value, bins), F.lit(True), "left")
        .select(F.when(F.col("n") < least_rows, F.lit(fallback)).otherwise(F.coalesce("t", "threshold", F.lit(fallback))).alias("threshold"))
    )


def mutual_information(df: DataFrame, a: str, b: str, bins: int = 48) -> DataFrame:
    """Of two columns in nats, from their joint histogram on equal bins between the extremes."""
    limits = df.agg(*[f(c).alias(f"__{f.__name__}_{c}") for c in (a, b) for f in (F.min, F.max)])

    def at(c: str) -> Column:
        lo, hi = F.col(f"__min_{c}"), F.col(f"__max_{c}")
        return F.least(F.floor((F.col(c) - lo) / F.greatest(hi - lo, F.lit(1e-12)) * bins), F.lit(bins - 1)).cast("int")

    joint = df.join(F.broadcast(limits), F.lit(True)).groupBy(at(a).alias("i"), at(b).alias("j")).agg(F.count("*").alias("n"))
    n = joint.select("n", F.sum("n").over(Window.partitionBy("i")).alias("ni"), F.sum("n").over(Window.partitionBy("j")).alias("nj"))
    total = F.broadcast(joint.agg(F.sum("n").alias("all")))
    p = F.col("n") / F.col("all")
    return n.join(total, F.lit(True)).agg(F.sum(p * F.log(F.col("n").cast("double") * F.col("all") / (F.col("ni").cast("double") * F.col("nj")))).alias("mutual_information"))


def class_weights(counts: DataFrame, classes: int, most: float = 10.0, ignore: int = 0, beta: float = 0.999) -> DataFrame:
    """Weights of classes 0 .. ``classes`` - 1 from ``class`` and ``n``, by three rules; missing classes count once, ``ignore`` weighs 0."""
    every = counts.sparkSession.range(classes).select(F.col("id").cast("int").alias("class"))
    n = every.join(counts, "class", "left").select("class", F.greatest(F.coalesce(F.col("n"), F.lit(0)).cast("double"), F.lit(1.0)).alias("n"))
    whole = Window.partitionBy()  # ``classes`` rows
    raw = F.sum("n").over(whole) / (F.lit(classes) * F.col("n"))
    effective = F.lit(1 - beta) / (1 - F.pow(F.lit(beta), F.col("n")))
    out = n.select("class", raw.alias("inverse"), F.sqrt(raw).alias("sqrt"), effective.alias("e")).withColumn("effective_number", F.col("e") / F.avg("e").over(whole))
    limit = lambda c: F.when(F.col("class") == ignore, 0.0).otherwise(F.least(F.col(c), F.lit(most))).alias(c)
    return out.select("class", limit("inverse"), limit("sqrt"), limit("effective_number"))


def rare_classes(counts: DataFrame, share: float) -> DataFrame:
    """Classes with less than ``share`` of all rows."""
    return counts.withColumn("fraction", F.col("n") / F.sum("n").over(Window.partitionBy())).where(F.col("fraction") < share)


def tile_weights(pixels: DataFrame, rare: DataFrame, tile: str, cls: str, most: float) -> DataFrame:
    """1 + (most - 1) * share of rare classes in a tile, to three places."""
    flag = pixels.join(rare.select(cls).distinct().withColumn("__r", F.lit(1.0)), cls, "left")  # broadcast by Spark if it is small
    return flag.groupBy(tile).agg(F.round(1 + (most - 1) * F.avg(F.coalesce("__r", F.lit(0.0))), 3).alias("weight"))


def tile_rarity(pixels: DataFrame, tile: str, cls: str, most: float) -> DataFrame:
    """The rarity of a tile's rarest class: tiles / tiles that have it, up to ``most``."""
    has = pixels.select(tile, cls).distinct()
    n = has.groupBy(cls).agg(F.count("*").alias("n"))
    total = F.broadcast(pixels.agg(F.count_distinct(tile).alias("all")))
    return has.join(n, cls).join(total, F.lit(True)).groupBy(tile).agg(F.least(F.max(F.col("all") / F.col("n")), F.lit(most)).alias("rarity"))


def funnel(df: DataFrame, stages: list[tuple[str, Column]]) -> DataFrame:
    """How many rows pass each stage and all before it, in one pass."""
    passed, cols = F.lit(True), [F.count("*").alias("all")]
    for name, condition in stages:
        passed = passed & F.coalesce(condition, F.lit(False))
        cols.append(F.count_if(passed).alias(name))
    return df.agg(*cols)


def progress(df: DataFrame, done_at: str, total: int, now: Column, recent_minutes: int = 30, surplus: bool = False) -> DataFrame:
    """Done, percent, rates an hour over all time and lately, and hours left at the latter if there is one. With ``surplus`` what is done beyond ``total`` counts below 0, else as nothing left."""
    t = F.unix_micros(F.col(done_at).cast("timestamp")) / 1e6
    n = F.unix_micros(now.cast("timestamp")) / 1e6
    a = df.agg(F.count("*").alias("done"), F.min(t).alias("first"), F.max(t).alias("last"), F.count_if(t > n - recent_minutes * 60).alias("recent"))
    hours = F.nullif((n - F.col("first")) / 3600, F.lit(0.0))
    recent = F.col("recent") * (60.0 / recent_minutes)
    overall = F.col("done") / hours
    rate = F.when(F.col("recent") > 0, recent).otherwise(overall)
    left = F.lit(total) - F.col("done")
    left = left if surplus else F.greatest(left, F.lit(0))
    return a.select("done", (100.0 * F.col("done") / total).alias("percent"), left.alias("remaining"), overall.alias("rate_overall"), recent.alias("rate_recent"), (left / F.nullif(rate, F.lit(0.0))).alias("eta_hours"))


def weather_features(df: DataFrame, keys: list[str], kelvin: str, rain_m: str, joule: str, base: float = 5.0, days: int = 30) -> DataFrame:
    """Of monthly means: mean temperature, growing degree days above ``base``, rain in millimetres and radiation in megajoules."""
    celsius = F.col(kelvin) - 273.15
    return df.groupBy(*keys).agg(
        F.avg(celsius).alias("mean_celsius"), (F.sum(F.greatest(celsius - base, F.lit(0.0))) * days).alias("degree_days"), (F.sum(rain_m) * 1000).alias("rain_mm"), (F.sum(joule) / 1e6).alias("radiation_mj")
    )


def source_stats(df: DataFrame, source: str, ok: Column, seconds: str) -> DataFrame:
    """Completed, failed, mean time of completed ones and success rate of each source."""
    return df.groupBy(source).agg(
        F.count("*").alias("submitted"), F.count_if(ok).alias("completed"), F.count_if(~ok).alias("failed"), F.avg(F.when(ok, F.col(seconds))).alias("mean_seconds"),
        F.avg(ok.cast("double")).alias("success_rate"),
    )


def slot_report(df: DataFrame, slot: str, failed: Column) -> DataFrame:
    return df.groupBy(slot).agg(F.count("*").alias("present"), F.count_if(failed).alias("failed"), F.avg(failed.cast("double")).alias("fail_rate"))


def latency_buckets(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Counts up to each edge, and of all, as a cumulative histogram."""
    cols = [F.count_if(F.col(value) <= e).alias(f"le_{e:g}".replace(".", "_")) for e in edges]
    return df.agg(*cols, F.count(value).alias("le_inf"))


def patch_anomalies(pixels: DataFrame, row: str, column: str, value: str, size: int, k: float, rows: int, cols: int) -> DataFrame:
    """Whole patches of ``size`` whose variance is above mean + ``k`` deviations of all patches' variances."""
    whole = pixels.where((F.col(row) < rows // size * size) & (F.col(column) < cols // size * size))
    v = whole.groupBy(F.floor(F.col(row) / size).alias("pr"), F.floor(F.col(column) / size).alias("pc")).agg(F.var_pop(value).alias("variance"))
    limit = F.broadcast(v.agg((F.avg("variance") + k * F.stddev_pop("variance")).alias("limit")))
    return v.join(limit, F.lit(True)).where("variance > limit").select("pr", "pc", "variance")


def growing_season(pixels: DataFrame, tile: str, start: str, end: str, least: int = 10, least_share: float = 0.05) -> DataFrame:
    """Median first and last day of the growing season of each tile, where enough pixels have them and they make sense."""
    s, e = (F.pmod(F.col(c), F.lit(1000)) for c in (start, end))
    ok = (F.col(start) > 0) & (F.col(end) > 0)
    a = pixels.groupBy(tile).agg(F.count("*").alias("all"), F.count_if(ok).alias("n"), F.percentile(F.when(ok, s), F.lit(0.5)).cast("int").alias("first_day"), F.percentile(F.when(ok, e), F.lit(0.5)).cast("int").alias("last_day"))
    return a.where((F.col("n") >= F.greatest(F.lit(float(least)), least_share * F.col("all"))) & (F.col("first_day") < F.col("last_day"))).select(tile, "n", "first_day", "last_day")


def segment_vote(df: DataFrame, segment: str, cls: str, p: str, mode: str = "mean_prob", digits: int = 9) -> DataFrame:
    """A class for each segment from rows of class probabilities; the lowest class wins a tie. Scores are compared at ``digits`` places, as the order of their sums is open."""
    return segment_votes(df, segment, cls, p, [mode], digits).withColumnRenamed(mode, cls)


def segment_votes(df: DataFrame, segment: str, cls: str, p: str, modes: list[str], digits: int = 9) -> DataFrame:
    """``segment_vote`` by several modes in one pass: a column for each."""
    scores = {"mean_prob": F.avg(p), "weighted_mean": F.sum(F.col(p) * F.col(p)) / F.nullif(F.sum(p), F.lit(0.0)), "majority_vote": F.count_if(F.col(p) >= 0.5)}
    s = df.groupBy(segment, cls).agg(*[F.round(scores[m].cast("double"), digits).alias(f"__{m}") for m in modes])
    return s.groupBy(segment).agg(*[F.max_by(cls, F.struct(f"__{m}", -F.col(cls))).alias(m) for m in modes])


def gate(df: DataFrame, verdict: str, least: int = 50, most_failed: float = 0.01) -> DataFrame:
    """Whether enough rows were judged and few enough failed; errors and skips don't count."""
    n, bad = F.count_if(F.col(verdict).isin("pass", "fail")), F.count_if(F.col(verdict) == "fail")
    a = df.agg(n.alias("evaluated"), bad.alias("failed"))
    return a.withColumn("ok", (F.col("evaluated") >= least) & (F.col("failed") <= most_failed * F.col("evaluated")))


def pearson(a, b) -> Column:
    """Correlation over rows where both are there and not 0."""
    ok = (col(a) != 0) & (col(b) != 0)
    return F.corr(F.when(ok, col(a).cast("double")), F.when(ok, col(b).cast("double")))


def phi(a: Column, b: Column) -> Column:
    """Correlation of two booleans; 0 where either is constant."""
    n = lambda x, y: F.count_if((a == x) & (b == y)).cast("double")
    tt, tf, ft, ff = n(True, True), n(True, False), n(False, True), n(False, False)
    return F.coalesce((tt * ff - tf * ft) / F.nullif(F.sqrt((tt + tf) * (tt + ft) * (ff + tf) * (ff + ft)), F.lit(0.0)), F.lit(0.0))


def valid_fraction(bands, threshold: float = 1e-6) -> Column:
    """Share of rows with any band of an array that isn't zero."""
    return F.avg(F.exists(col(bands), lambda x: F.abs(x) > threshold).cast("double"))


def bright_fraction(band, bright: float) -> Column:
    """Share of bright rows among those with data; with none 1."""
    return share_inside(col(band) > bright, col(band) > 0, 1.0)


def mean_image(scenes: DataFrame, place: list[str], values: list[str]) -> DataFrame:
    """Sums and numbers of what is known at each place over all scenes, and their means: partial sums of many scenes add up in any order."""
    return scenes.groupBy(*place).agg(*[F.count(v).alias(f"n_{v}") for v in values], *[F.avg(v).alias(v) for v in values])


def class_tiles(pixels: DataFrame, tile: str, cls: str, crops: list[int]) -> DataFrame:
    """For each class its pixels, the tiles where it is the most frequent (the lowest of equals), and whether it is a crop."""
    n = pixels.groupBy(tile, cls).agg(F.count("*").alias("__n"))
    top = modal_top(n, tile, cls)
    return n.join(top, [tile, cls], "left").groupBy(cls).agg(F.sum("__n").alias("pixels"), F.count("__top").alias("dominant_tiles")).withColumn("is_crop", F.col(cls).isin(crops))


def modal_top(n: DataFrame, tile: str, cls: str) -> DataFrame:
    best = n.groupBy(tile).agg(F.max_by(cls, F.struct(F.col("__n"), -F.col(cls))).alias(cls))
    return best.withColumn("__top", F.lit(1))


def principal_components(df: DataFrame, vector: str, k: int) -> DataFrame:
    """``df`` with ``components``, the first ``k`` principal components of a column of arrays; each points to where its largest loading is positive."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    known = df.withColumn("__v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    model = PCA(k=k, inputCol="__v", outputCol="__c").fit(known)
    loadings = model.pc.toArray()  # as many rows as a vector is long
    signs = [1.0 if max(column, key=abs) > 0 else -1.0 for column in loadings.T.tolist()]
    turned = F.zip_with(vector_to_array("__c"), F.array(*map(F.lit, signs)), lambda a, b: a * b)
    return model.transform(known).withColumn("components", turned).drop("__v", "__c")
