"""Filters, rankings, top-k and sets for choosing dates, scenes and tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.functions.spectral import col
from skyquilt.operators.iterative import _saved

#: Scene classes that hide the ground (shadow, two clouds, cirrus).
CLOUD_CLASSES = (3, 8, 9, 10)


def is_cloud(scl, classes: tuple[int, ...] = CLOUD_CLASSES) -> Column:
    return col(scl).isin(*classes)


def previous_days(df: DataFrame, day: str, value: str, days: int, out: str, keys: list[str] = ()) -> DataFrame:
    """Sum over the ``days`` calendar days before each row's; missing days count 0."""
    w = Window.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-days, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0.0)))


def clear_days(df: DataFrame, day: str, rain: str, warmth: str, cloud: str | None, keys: list[str] = (), today: float = 0.5, before: float = 3.0, least_warmth: float = 0.0, most_cloud: float = 50.0) -> DataFrame:
    """Days with little rain on the day and the two before, warm enough, and not known to be cloudy.

    The window runs within ``keys`` (a weather cell), so that cells are spread over tasks.
    """
    w = previous_days(df, day, rain, 2, "__before", keys)
    ok = (F.col(rain) <= today) & (F.col("__before") <= before) & (F.col(warmth) >= least_warmth)
    if cloud:
        ok = ok & (F.col(cloud).isNull() | (F.col(cloud) <= most_cloud))
    return w.where(ok).drop("__before")


def scene_gate(cloud, snow, seen, most_cloud: float = 0.1, most_snow: float = 0.05, least_seen: float = 0.6) -> Column:
    """Cloud must be low; snow and coverage must be right where they are known."""
    return (col(cloud) <= most_cloud) & (col(snow).isNull() | (col(snow) <= most_snow)) & (col(seen).isNull() | (col(seen) >= least_seen))


def choose_dates(mode: str, weather: DataFrame, catalogue: DataFrame, screened: DataFrame, key: list[str]) -> DataFrame:
    """Dates that all sources of a mode agree on. Each source is a table of ``key`` columns."""
    sources = {
        "catalogue": [catalogue], "weather": [weather, catalogue], "screen": [screened], "catalogue_then_screen": [catalogue, screened],
        "weather_then_screen": [weather, screened], "weather_then_catalogue": [weather, catalogue],
    }
    if mode not in sources:
        raise ValueError(f"unknown mode {mode!r}")
    first, *rest = sources[mode]
    out = first.select(*key).distinct()
    for s in rest:
        out = out.join(s.select(*key).distinct(), key, "left_semi")
    return out


def ranked_candidates(catalogue: DataFrame, weather: DataFrame, key: list[str], cloud: str) -> DataFrame:
    """Catalogue dates with the weather's cloud; dates without it come last."""
    return catalogue.join(weather.select(*key, cloud), key, "left").orderBy(F.col(cloud).asc_nulls_last(), *key)


def first_per(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key; ``order`` must end in something unique."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__r") <= n).drop("__r")


def nearest_to(df: DataFrame, keys: list[str], day: str, target: Column, tie: Column) -> DataFrame:
    """Of each key the row whose day is nearest to ``target``."""
    return first_per(df, keys, [F.abs(F.datediff(F.col(day), target)), tie])


def slot_dates(dates: DataFrame, slots: DataFrame, tile: str, strict_cloud: float = 0.10, relaxed_cloud: float = 0.40) -> DataFrame:
    """A date for each slot of a tile: strict (clear and weather agreed), else relaxed (less clear); nearest to mid-window.

    ``dates``: tile, date, cloud, snow, seen, weather_ok; ``slots``: tile, slot, start, end. Snow and coverage never relax.
    A tile that lacks a date for any of slots 1 to 3 is left out.
    """
    from skyquilt.functions.scalars import midpoint

    hard = scene_gate(F.lit(0.0), "snow", "seen")
    pairs = slots.join(dates, tile).where(F.col("date").between(F.col("start"), F.col("end")) & hard)
    tier = F.when(F.col("weather_ok") & (F.col("cloud") <= strict_cloud), 0).when(F.col("cloud") <= relaxed_cloud, 1)
    best = first_per(pairs.withColumn("tier", tier).where("tier IS NOT NULL"), [tile, "slot"], [F.col("tier"), F.abs(F.datediff("date", midpoint("start", "end"))), F.col("date")])
    whole = best.where("slot BETWEEN 1 AND 3").groupBy(tile).agg(F.count("*").alias("n")).where("n = 3").select(tile)
    return best.join(whole, tile, "left_semi").select(tile, "slot", "date", "tier")


def absent_or(paths: list[str], json: str, wanted: list[str]) -> Column:
    """Whether the first of the properties that a row has is one of those wanted, or it has none."""
    found = F.coalesce(*[F.get_json_object(json, p) for p in paths], F.lit(""))
    return (found == "") | found.isin(*wanted)


def rescore(df: DataFrame, first: list[str], n: int, better: Column, order: list[str]) -> DataFrame:
    """The ``n`` best rows by one order with a better measure, which is taken of them alone, and their ``rank`` by it. Other columns go."""
    best = df.orderBy(*first).limit(n).select(first[-1], better)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # n rows


def diverse(df: DataFrame, cls: str, score: str, unique: str, n: int) -> DataFrame:
    """``n`` rows: the best of every class in order of score, then the best of the rest: of each class its best row, found by
    an aggregate, and the ``n`` best of the others, found task by task."""
    order = F.struct(F.col(score), -F.col(unique))
    heads = df.groupBy(cls).agg(F.max_by(F.struct(*df.columns), order).alias("r")).select("r.*", F.lit(0).alias("__k"))
    more = df.join(heads.select(unique), unique, "left_anti").orderBy(F.desc(score), F.col(unique)).limit(n).withColumn("__k", F.lit(1))
    return heads.unionByName(more).orderBy("__k", F.desc(score), F.col(unique)).limit(n).drop("__k")


def every_nth(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """``n`` rows at an even stride over the sorted rows, by exact ranks computed range by range."""
    from skyquilt.operators.sampling import with_rank

    ranked = with_rank(df, order)
    total = F.broadcast(df.agg(F.count("*").alias("__n")))
    step = F.greatest(F.floor(F.col("__n") / n), F.lit(1))
    return ranked.join(total, F.lit(True)).where((F.col("rank") % step == 0) & (F.floor(F.col("rank") / step) < n)).drop("rank", "__n")


def monotone(df: DataFrame, keys: list[str], slot: str, day: str) -> DataFrame:
    """Whether the days that are known ascend with the slots."""
    w = Window.partitionBy(*keys).orderBy(slot)
    steps = df.where(F.col(day).isNotNull()).withColumn("__p", F.lag(day).over(w))
    return steps.groupBy(*keys).agg(F.bool_and(F.coalesce(F.col(day) > F.col("__p"), F.lit(True))).alias("monotone"))


def success_streak(df: DataFrame, keys: list[str], order: list[str], ok: Column) -> DataFrame:
    """Length of the run of successes that ends at each row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    island = df.withColumn("__ok", ok).withColumn("__i", F.sum((~F.col("__ok")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*keys, "__i").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return island.withColumn("streak", F.sum(F.col("__ok").cast("int")).over(run)).drop("__ok", "__i")


def sliding_latency(df: DataFrame, keys: list[str], order: list[str], value: str, failed: Column, n: int) -> DataFrame:
    """Nearest-rank 90th percentile and error rate of each row and the ``n`` - 1 before it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-(n - 1), 0)
    last = F.sort_array(F.collect_list(value).over(w))
    at = F.least(F.floor(F.size(last) * 0.9).cast("int"), F.size(last) - 1)
    return df.withColumns({"p90": F.get(last, at), "error_rate": F.avg(failed.cast("double")).over(w)})


def union_tagged(parts: dict[str, DataFrame]) -> DataFrame:
    """All rows of all parts with the part's name as ``source``; missing columns are null."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn("source", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def first_wins(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows by key from the first part that has the key."""
    out = None
    for k, df in enumerate(parts):
        tagged = df.withColumn("__k", F.lit(k))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    least = F.min("__k").over(Window.partitionBy(*keys))
    return out.withColumn("__m", least).where("__k = __m").drop("__k", "__m")


def unknown_codes(df: DataFrame, code: str, known: DataFrame) -> DataFrame:
    return df.select(code).distinct().join(known.select(code), code, "left_anti")


def pinned_or_best(df: DataFrame, keys: list[str], pinned: Column, order: list[Column]) -> DataFrame:
    """Of each key the pinned row, if it has one, else the first by ``order``."""
    return first_per(df, keys, [pinned.cast("int").desc(), *order])


def clearest(df: DataFrame, keys: list[str], frame: str, valid: str, sharp: str) -> DataFrame:
    """Of each key the frame with most valid data; of equal ones the sharpest, then the first."""
    return df.groupBy(*keys).agg(F.max_by(frame, F.struct(F.col(valid), F.col(sharp), -F.col(frame))).alias(frame))


def prior_autumn(dates: DataFrame, tile: str, day: str, year: Column, cloud: str, most_cloud: float = 0.4) -> DataFrame:
    """A date for slot 0: from mid-August to the end of October of the year before, clear enough; the nearest to the middle, the earlier of equals."""
    start, end = F.make_date(year - 1, F.lit(8), F.lit(15)), F.make_date(year - 1, F.lit(10), F.lit(31))
    within = dates.where(F.col(day).between(start, end) & (F.col(cloud) <= most_cloud))
    middle = F.date_add(start, 38)
    return first_per(within, [tile], [F.abs(F.datediff(F.col(day), middle)), F.col(day)]).select(tile, day)


def background_date(dates: DataFrame, tile: str, day: str, weather_ok: str, years: tuple[int, ...] = (2016, 2015)) -> DataFrame:
    """A date for slot 4: of the first of the years that has one, from June to mid-August in good weather; the nearest to the middle, the earlier of equals."""
    near, year = [], F.year(day)
    for k, y in enumerate(years):
        start, end = F.make_date(F.lit(y), F.lit(6), F.lit(1)), F.make_date(F.lit(y), F.lit(8), F.lit(16))
        near.append(F.when((year == y) & F.col(day).between(start, end), F.struct(F.lit(k).alias("k"), F.abs(F.datediff(F.col(day), F.date_add(start, 38))).alias("gap"))))
    return first_per(dates.where(F.col(weather_ok)).withColumn("__n", F.coalesce(*near)).where("__n IS NOT NULL"), [tile], [F.col("__n"), F.col(day)]).select(tile, day)


#: Rows of a task that chooses dates.
TASK = 1 << 18


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows by key over as many tasks as their number asks for, never fewer than Spark's own number; work by the key, and by more columns with it, needs no further shuffle. Pass a written table: its rows are counted."""
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // TASK), key)


def slot_plan(dates: DataFrame, slots: DataFrame, tile: str, tile_year: int, years: tuple[int, ...] = (2016, 2015), strict_cloud: float = 0.10, relaxed_cloud: float = 0.40) -> DataFrame:
    """``tile, slot, date`` of all five slots: 1 to 3 by ``slot_dates``; and only of tiles that have all three, the autumn before as slot 0 and a summer of the background years as slot 4, if they have one."""
    dates = dealt(_saved(dates), tile)
    grown = _saved(slot_dates(dates, slots, tile, strict_cloud, relaxed_cloud).where("slot BETWEEN 1 AND 3").select(tile, F.col("slot").cast("int").alias("slot"), "date"))
    going_on = dates.join(grown.select(tile).distinct(), tile, "left_semi")
    autumn = prior_autumn(going_on, tile, "date", F.lit(tile_year), "cloud", relaxed_cloud).select(tile, F.lit(0).alias("slot"), "date")
    summer = background_date(going_on, tile, "date", "weather_ok", years).select(tile, F.lit(4).alias("slot"), "date")
    return grown.unionByName(autumn).unionByName(summer)
