"""Stateful and incremental behaviour as Structured Streaming; each has a batch form that gives the same rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, schema, files_a_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else r).parquet(path)


def window_counts(df: DataFrame, ts: str, width: str, slide: str | None, keys: list[str], value: str, late: str = "1 hour") -> DataFrame:
    """Counts and sums of event-time windows, tumbling or sliding; rows later than ``late`` are dropped by a stream."""
    source = df.withWatermark(ts, late) if df.isStreaming else df
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return source.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def running_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, sum and mean of each key so far (output mode complete or update)."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))


def sessions(df: DataFrame, ts: str, keys: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """Runs of events with no gap as long as ``gap``: a claim that isn't renewed ends."""
    source = df.withWatermark(ts, late) if df.isStreaming else df
    return source.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(df: DataFrame, ts: str, keys: list[str], late: str = "6 hours") -> DataFrame:
    """The first row of each key; a stream forgets a key after ``late``."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)


def adapt(limit: int, ok: bool, run: int, up_after: int, least: int, most: int) -> tuple[int, int]:
    """A concurrency limit after one outcome: halved by a failure, one more after ``up_after`` successes in a row."""
    if not ok:
        return max(least, limit // 2), 0
    return (min(most, limit + 1), 0) if run + 1 >= up_after else (limit, run + 1)


def adaptive_limits(df: DataFrame, key: str, order: str, ok: str, start: int = 4, up_after: int = 5, least: int = 1, most: int = 32) -> DataFrame:
    """The limit of each source after each micro-batch, kept as state across them."""

    def update(group, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        limit, run = state.get if state.exists else (start, 0)
        n = 0
        for row in pd.concat(list(parts)).sort_values(order).itertuples():
            limit, run = adapt(limit, bool(getattr(row, ok)), run, up_after, least, most)
            n += 1
        state.update((limit, run))
        yield pd.DataFrame({key: [group[0]], "limit": [limit], "events": [n]})

    kind = dict(df.dtypes)[key]
    return df.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, limit int, events int", "limit int, run int", "update", "NoTimeout")


def run_once(df: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """All that is there now, into a memory table."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
