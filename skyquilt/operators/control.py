"""Control tables of repeated work: claims, jobs, retries, what may be skipped, and which sources are down. Batch forms over event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyquilt.functions.spectral import col


def job_states(events: DataFrame, job: str, order: list[str], kind: str) -> DataFrame:
    """The state of every job after its last event: queued, running, success or failed; what ends a job counts only once it runs.

    ``kind``: submit, start, done or error. An event that its job's state doesn't allow changes nothing.
    """
    started = F.min(F.when(F.col(kind) == "start", F.struct(*order)))
    first = events.groupBy(job).agg(started.alias("__s"))
    e = events.join(first, job)
    ended = F.min_by(kind, F.when(F.col(kind).isin("done", "error") & (F.struct(*order) > F.col("__s")), F.struct(*order)))
    out = e.groupBy(job).agg(F.first("__s").alias("__s"), ended.alias("__e"), F.count("*").alias("events"))
    state = F.when(F.col("__e") == "done", "SUCCESS").when(F.col("__e") == "error", "FAILED").when(F.col("__s").isNotNull(), "RUNNING").otherwise("QUEUED")
    return out.select(job, state.alias("state"), "events")


def open_claims(events: DataFrame, key: str, ts: str, kind: str, now: Column, stale_hours: float = 6) -> DataFrame:
    """Claims that weren't released after their last renewal: ``held``, or ``stale`` once older than ``stale_hours``."""
    last = events.groupBy(key).agg(F.max(F.when(F.col(kind) == "claim", F.col(ts))).alias("claimed"), F.max(F.when(F.col(kind) == "release", F.col(ts))).alias("released"))
    open_ = last.where(F.col("claimed").isNotNull() & (F.col("released").isNull() | (F.col("released") < F.col("claimed"))))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("claimed").cast("timestamp"))) / 3.6e9
    return open_.select(key, "claimed", F.when(age > stale_hours, "stale").otherwise("held").alias("state"))


def retry_delays(attempt, base: float, most: float, *keys) -> Column:
    """Seconds to wait before an attempt (from 1): doubled each time up to ``most``, and up to a quarter more by the hash of the keys."""
    from skyquilt.operators.sampling import uniform

    plain = F.least(F.lit(float(most)), F.lit(float(base)) * F.pow(F.lit(2.0), col(attempt) - 1))
    return plain * (1 + 0.25 * uniform(17, *keys, col(attempt)))


def backoff(attempt, base: float, most: float) -> Column:
    """The delay without jitter."""
    return F.least(F.lit(float(most)), F.lit(float(base)) * F.pow(F.lit(2.0), col(attempt) - 1))


def not_yet_done(work: DataFrame, index: DataFrame, keys: list[str], audit: str) -> DataFrame:
    """Work that the skip index of this audit doesn't list; entries of other audits don't count."""
    return work.join(index.where(F.col("audit") == audit).select(*keys).distinct(), keys, "left_anti")


def complete_only(parts: DataFrame, keys: list[str], ok: Column, expected: Column) -> DataFrame:
    """Keys whose parts are all there and all fine: what may be cached."""
    a = parts.groupBy(*keys).agg(F.count("*").alias("parts"), F.count_if(ok).alias("fine"), F.max(expected).alias("expected"))
    return a.where((F.col("fine") == F.col("expected")) & (F.col("parts") == F.col("expected"))).select(*keys, "parts")


def circuit(events: DataFrame, source: str, order: list[str], failed: Column, most: int) -> DataFrame:
    """Sources whose last ``most`` events all failed are ``dead``, and the others ``alive``; with the length of the run of failures at the end.

    The last success of each source is a maximum, and the failures after it are counted: nothing is sorted.
    """
    e = events.select(source, F.struct(*order).alias("__t"), F.coalesce(failed, F.lit(False)).alias("__f"))
    last = e.groupBy(source).agg(F.max(F.when(~F.col("__f"), F.col("__t"))).alias("__good"))
    after = F.col("__f") & (F.col("__good").isNull() | (F.col("__t") > F.col("__good")))
    runs = e.join(last, source).groupBy(source).agg(F.count_if(after).alias("failures"))
    return runs.withColumn("state", F.when(F.col("failures") >= most, "dead").otherwise("alive"))


def job_report(events: DataFrame, source: str, ts: str, unique: str, ok: Column, total: int, last: int = 5) -> DataFrame:
    """For each source its jobs, those that went well, the ``last`` failures (newest first), completed ones an hour, and hours to go to ``total``."""
    e = events.select(source, ts, unique, ok.alias("__ok"))
    seconds = (F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))) / 1e6
    a = e.groupBy(source).agg(F.count("*").alias("submitted"), F.count_if("__ok").alias("completed"), (seconds / 3600).alias("__h"))
    newest = Window.partitionBy(source).orderBy(F.desc(ts), F.desc(unique))  # Spark keeps the first rows of each task before it shuffles them
    f = e.where("NOT __ok").withColumn("__r", F.row_number().over(newest)).where(F.col("__r") <= last)
    f = f.groupBy(source).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__r", unique))), lambda x: x[unique].cast("string")), ",").alias("last_failures"))
    rate = F.col("completed") / F.col("__h")
    return a.join(f, source, "left").select(source, "submitted", "completed", "last_failures", rate.alias("per_hour"), ((total - F.col("completed")) / rate).alias("eta_hours"))


def by_phase(results: DataFrame, phase: str, name: str, score: str) -> DataFrame:
    """Results of each phase: how many, their mean, and the best one, the least name of equals."""
    return results.groupBy(phase).agg(F.count("*").alias("n"), F.avg(score).alias("mean"), F.max_by(name, F.struct(F.col(score), -F.col(name))).alias("best"))
