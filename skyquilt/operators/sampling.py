"""Splits and samples that depend on nothing but the rows: by hash, by place, by weight."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.functions.spectral import col


def digest_uniform(seed: int, *keys) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5 of the keys, which other engines have too."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def uniform(seed: int, *keys) -> Column:
    """A number in (0, 1) from hashed keys."""
    return digest_uniform(seed, *keys) + 0.5 / (1 << 52)


def md5_percent(name) -> Column:
    """The md5 of a name, as a number, modulo 100."""
    digest = F.md5(col(name).cast("string").cast("binary"))
    half = lambda a: F.conv(F.substring(digest, a, 16), 16, 10).cast("decimal(20,0)") % 100
    return ((half(1) * 16 + half(17)) % 100).cast("int")  # 2 ** 64 is 16 modulo 100


def md5_split(name, held_out: int = 10) -> Column:
    return F.when(md5_percent(name) < held_out, "val").otherwise("train")


def zone_split(df: DataFrame, zone: str, order: list[str], val: float, test: float, least_val: int) -> DataFrame:
    """Within each zone, by place: the first rows are for testing, a block amid the rest for validation, the others for training.

    Places in a zone come from ranks over all rows, zone by zone, less the rows of the zones before.
    """
    before = Window.orderBy(zone).rowsBetween(Window.unboundedPreceding, -1)  # one row a zone
    zones = df.groupBy(zone).agg(F.count("*").alias("__n")).withColumn("__o", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    out = with_rank(df, [zone, *order]).join(zones, zone).withColumn("__k", F.col("rank") - F.col("__o")).drop("rank", "__o")
    n_test = F.when(F.col("__n") >= 5, F.greatest(F.lit(1), F.floor(F.col("__n") * test))).otherwise(0)
    n_val = F.greatest(F.lit(0), F.least(F.greatest(F.lit(least_val), F.floor(F.col("__n") * val)), F.col("__n") - n_test - 1))
    rest = F.col("__n") - n_test
    start = F.greatest(F.lit(0), F.floor(rest / 2) - F.floor(n_val / 2))
    end = F.least(start + n_val, rest)
    start = F.when(start + n_val > rest, F.greatest(F.lit(0), end - n_val)).otherwise(start)
    at = F.col("__k") - n_test
    split = F.when(F.col("__k") < n_test, "test").when((at >= start) & (at < end), "val").otherwise("train")
    return out.withColumn("split", split).drop("__n", "__k")


def stratified_split(df: DataFrame, strata: list[str], name: str, seed: int = 42, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """In each stratum, in hash order: the floor of each share, and what is left for testing.

    A stratum is cut into 256 parts by the first byte of the hash, which are ranked apart.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(name).cast("string")))
    d = df.withColumn("__d", digest).withColumn("__b", F.substring("__d", 1, 2))
    w = Window.partitionBy(*strata)
    parts = d.groupBy(*strata, "__b").agg(F.count("*").alias("__c"))
    parts = parts.select(*strata, "__b", (F.sum("__c").over(w.orderBy("__b")) - F.col("__c")).alias("__o"), F.sum("__c").over(w).alias("__n"))
    k = F.col("__o") + F.row_number().over(Window.partitionBy(*strata, "__b").orderBy("__d", name)) - 1
    same = F.lit(True)
    for c in [*strata, "__b"]:
        same = same & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    ranked = d.alias("x").join(parts.alias("y"), same).select("x.*", F.col("__o"), F.col("__n")).withColumn("__k", k)
    a, b = F.floor(F.col("__n") * train), F.floor(F.col("__n") * val)
    return ranked.withColumn("split", F.when(F.col("__k") < a, "train").when(F.col("__k") < a + b, "val").otherwise("test")).drop("__d", "__b", "__o", "__n", "__k")


def latitude_split(lat, test_below: float, val_below: float) -> Column:
    return F.when(col(lat) < test_below, "test").when(col(lat) < val_below, "val").otherwise("train")


def temporal_split(year, last_train: int, last_val: int) -> Column:
    return F.when(col(year) <= last_train, "train").when(col(year) <= last_val, "val").otherwise("test")


def leave_one_year_out(year, held: int) -> Column:
    return F.when(col(year) == held, "test").otherwise("train")


def leave_sensor_out(sensor, held: list[str]) -> Column:
    return F.when(col(sensor).isin(*held), "test").otherwise("train")


def geographic_split(zone, test_zones: list[str], val_zones: list[str]) -> Column:
    return F.when(col(zone).isin(*test_zones), "test").when(col(zone).isin(*val_zones), "val").otherwise("train")


def frame_dropout(mask, seed: int, share: float, *keys) -> Column:
    """A frame mask with a share of its frames off, the same ones each time."""
    return F.transform(col(mask), lambda m, i: F.when(uniform(seed, *keys, i) < share, F.lit(0)).otherwise(m))


def phenology_split(day, early: int, late: int) -> Column:
    return F.when(col(day) < early, "early").when(col(day) > late, "late").otherwise("peak")


def weighted_sample(df: DataFrame, keys: list[str], weight, k: int, seed: int, *unique: str) -> DataFrame:
    """``k`` rows of each key without replacement, chosen in proportion to weight (exponential keys)."""
    draw = -F.log(uniform(seed, *unique)) / F.nullif(col(weight).cast("double"), F.lit(0.0))
    order = Window.partitionBy(*keys).orderBy(F.col("__d"), *unique)
    return df.withColumn("__d", draw).where("__d IS NOT NULL").withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= k).drop("__d", "__r")


def hash_sample(df: DataFrame, keys: list[str], k: int, seed: int, *unique: str) -> DataFrame:
    """``k`` rows of each key, in hash order: what a reservoir gives, and the same each time."""
    return weighted_sample(df, keys, F.lit(1.0), k, seed, *unique)


def with_rank(df: DataFrame, order: list[str], buckets: int = 64) -> DataFrame:
    """``rank`` from 0 of every row in total order, columns of any type: ranks within ranges of the whole order, and the ranges' offsets.

    Spark deals the rows to ranges, which are written, so that sizes and ranks are of the same ranges.
    """
    from skyquilt.operators.iterative import _table

    ranged = _table(df.repartitionByRange(buckets, *order).withColumn("__b", F.spark_partition_id()))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = ranged.groupBy("__b").agg(F.count("*").alias("__n")).select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    inside = F.row_number().over(Window.partitionBy("__b").orderBy(*order)) - 1
    return ranged.withColumn("__k", inside).join(F.broadcast(offsets), "__b").withColumn("rank", F.col("__o") + F.col("__k")).drop("__b", "__k", "__o")


def with_replacement(df: DataFrame, weight: str, unique: str, draws: int, seed: int, buckets: int = 64) -> DataFrame:
    """Rows with ``draws``, how often each is drawn in so many independent draws in proportion to weight; rows without a weight above 0 never are.

    Rows are dealt to ranges of ``unique`` with the sums of their weights. A draw is a place on the line of all weights: it goes to the range that
    holds it, and there to the row, by one sort of the range's rows and draws. A range sum each reaches the driver.
    """
    from skyquilt.operators.aggregates import _place_among
    from skyquilt.operators.iterative import _table

    w = F.col(weight).cast("double")
    ranged = _table(df.where(w > 0).repartitionByRange(buckets, unique).withColumn("__b", F.spark_partition_id()))
    sums = sorted((r["__b"], r["s"]) for r in ranged.groupBy("__b").agg(F.sum(w).alias("s")).collect())
    ends = [0.0]
    for _, x in sums:
        ends.append(ends[-1] + x)
    if not sums:
        return df.withColumn("draws", F.lit(0).cast("bigint")).limit(0)
    number = F.element_at(F.create_map(*[F.lit(x) for k, (b, _) in enumerate(sums) for x in (b, k)]), F.col("__b"))
    start = F.element_at(F.create_map(*[F.lit(x) for k in range(len(sums)) for x in (k, ends[k])]), F.col("k"))
    running = F.sum(w).over(Window.partitionBy("k").orderBy(unique).rowsBetween(Window.unboundedPreceding, -1))
    rows = ranged.withColumn("k", number).select("k", (start + F.coalesce(running, F.lit(0.0))).alias("at"), F.col(unique).alias("u"), F.lit(0).alias("drawn"))
    place = digest_uniform(seed, "id") * ends[-1]
    bounds = [math.nextafter(x, 0.0) for x in ends[1:-1]]  # a draw at a range's end belongs to the next one
    asked = df.sparkSession.range(draws).select(_place_among(place, bounds).alias("k"), place.alias("at"), F.lit(None).cast(dict(df.dtypes)[unique]).alias("u"), F.lit(1).alias("drawn"))
    upto = Window.partitionBy("k").orderBy("at", "drawn").rowsBetween(Window.unboundedPreceding, 0)
    hit = rows.unionByName(asked).withColumn("u", F.last("u", ignorenulls=True).over(upto)).where("drawn = 1")
    return df.join(hit.groupBy(F.col("u").alias(unique)).agg(F.count("*").alias("draws")), unique)
