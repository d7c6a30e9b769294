"""Claims, limits and jobs as streams with state of their own: value states, event-time timers and a time to live.

Events of a key are taken in order of time within a micro-batch, and batches in order; so the rows that come out don't depend on how the
input was cut into batches, and a query that starts again from its checkpoint goes on where it stopped. What is kept of a
key is one small row, whatever its events number. A state holds the rows of a bucket of keys, as calls of Python and of the store
for each key took most of the time; the number of buckets is fixed when a query first starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skyquilt.streaming.streams import adapt

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_states(spark: SparkSession):
    """Queries that start inside keep their state in the store that these operators need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def _micros(times: pd.Series) -> list[int]:
    return times.astype("datetime64[us]").astype("int64").tolist()


def _in_order(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(order)


#: Buckets that keys are dealt to; null keys have one of their own.
BUCKETS = 1024


def _bucket(key: str, buckets: int) -> Column:
    return F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets))).cast("int")


class _Bucket(StatefulProcessor):
    """State: a table of a bucket's keys and their rows, as one Arrow message."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("bucket", "rows binary")

    def _held(self) -> dict:
        if not self.state.exists():
            return {}
        keys, *values = (c.to_pylist() for c in pa.ipc.open_stream(self.state.get()[0]).read_all().columns)
        return dict(zip(keys, zip(*values, strict=True), strict=True))

    def _hold(self, held: dict) -> None:
        if not held:
            self.state.clear()
            return
        columns = [list(held), *map(list, zip(*held.values(), strict=True))]
        table, sink = pa.table({str(k): c for k, c in enumerate(columns)}), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.state.update((sink.getvalue().to_pybytes(),))

    def _rows(self, bucket: tuple, rows: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple]:
        """Keys and further columns of the rows, in order of time."""
        frame = _in_order(rows, ["ts", "event"])
        keys = [None] * len(frame) if bucket[0] == -1 else frame[self.key].tolist()
        return zip(keys, *[_micros(frame[c]) if c == "ts" else frame[c].tolist() for c in columns], strict=True)

    def close(self) -> None:
        pass


class _Claims(_Bucket):
    """Of a key: holder, since, seen. A claim that nobody renews goes stale ``stale`` microseconds after it was last seen; a bucket has one timer, for the first that may."""

    def __init__(self, key: str, stale: int):
        super().__init__(key)
        self.stale = stale

    def _closed(self, found: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(dict(zip((self.key, "holder", "since_us", "until_us", "how"), zip(*found, strict=True), strict=True)))

    def _due(self, seen: int) -> int:
        return -(-(seen + self.stale) // 1000)

    def _first(self, held: dict) -> int | None:
        return self._due(min(x[2] for x in held.values())) if held else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, out = self._held(), []
        before = self._first(held)
        for k, ts, who, action in self._rows(key, rows, ["ts", "who", "action"]):
            now = held.get(k)
            if now is not None and ts - now[2] >= self.stale:
                out.append((k, now[0], now[1], now[2] + self.stale, "stale"))
                now = None
            if action == "claim" and (now is None or now[0] == who):
                now = (who, now[1] if now else ts, ts)
            elif action == "claim":
                out.append((k, who, ts, ts, "denied"))
            elif action == "release" and now is not None and now[0] == who:
                out.append((k, now[0], now[1], ts, "released"))
                now = None
            if now is not None:
                held[k] = now
            else:
                held.pop(k, None)
        self._hold(held)
        after = self._first(held)
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)
        if out:
            yield self._closed(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, expired, mark = self._held(), expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        gone = [k for k, x in held.items() if self._due(x[2]) <= expired or self._due(x[2]) < mark]
        out = [(k, holder, since, seen + self.stale, "stale") for k in gone for holder, since, seen in (held.pop(k),)]
        self._hold(held)
        if held:
            self.handle.registerTimer(self._first(held))
        if out:
            yield self._closed(out)


def closed_claims(events: DataFrame, key: str, stale_hours: float = 6, late: str = "1 second", buckets: int = BUCKETS) -> DataFrame:
    """Claims as they end: ``key, holder, since_us, until_us, how`` (released, stale, or denied to one who came while another held it).

    ``events``: a stream of the key, ``ts``, ``event`` (orders equal times), ``who`` and ``action`` (claim, which also renews, or release). A timer frees a
    claim that no event follows once the watermark has passed its end; rows later than ``late`` are dropped (with no delay at all, so would be those of the last time of the batch before).
    """
    source = events.select(key, F.col("ts").cast("timestamp").alias("ts"), "event", F.col("who").cast("string").alias("who"), "action").withWatermark("ts", late)
    kind = dict(events.dtypes)[key]
    return source.withColumn("bucket", _bucket(key, buckets)).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_Claims(key, int(stale_hours * 3_600_000_000)), outputStructType=f"{key} {kind}, holder string, since_us bigint, until_us bigint, how string", outputMode="Append", timeMode="EventTime"
    )


class _Limits(_Bucket):
    """Of a key: limit, run of successes, events."""

    def __init__(self, key: str, start: int, up_after: int, least: int, most: int):
        super().__init__(key)
        self.start, self.rule = start, (up_after, least, most)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, seen = self._held(), {}
        for k, ok in self._rows(key, rows, ["ok"]):
            limit, run, n = held.get(k, (self.start, 0, 0))
            held[k] = seen[k] = (*adapt(limit, bool(ok), run, *self.rule), n + 1)
        self._hold(held)
        yield pd.DataFrame({self.key: list(seen), "limit": [x[0] for x in seen.values()], "events": [x[2] for x in seen.values()]})


def concurrency_limits(events: DataFrame, key: str, start: int = 4, up_after: int = 5, least: int = 1, most: int = 32, buckets: int = BUCKETS) -> DataFrame:
    """The limit of each source after each micro-batch, and how many events it has had: halved by a failure, one more after ``up_after`` successes in a row.

    ``events``: a stream of the key, ``ts``, ``event`` and ``ok``.
    """
    kind = dict(events.dtypes)[key]
    return events.select(key, "ts", "event", "ok", _bucket(key, buckets).alias("bucket")).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=_Limits(key, start, up_after, least, most), outputStructType=f"{key} {kind}, limit int, events bigint", outputMode="Append", timeMode="None"
    )


def _moved(state: str, kind: str) -> str:
    if state == "QUEUED" and kind == "start":
        return "RUNNING"
    return {"done": "SUCCESS", "error": "FAILED"}.get(kind, state) if state == "RUNNING" else state


class _Jobs(_Bucket):
    """Of a key: state, events."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, seen = self._held(), {}
        for k, kind in self._rows(key, rows, ["kind"]):
            state, n = held.get(k, ("QUEUED", 0))
            held[k] = seen[k] = (_moved(state, kind), n + 1)
        self._hold(held)
        yield pd.DataFrame({self.key: list(seen), "state": [x[0] for x in seen.values()], "events": [x[1] for x in seen.values()]})


class _ForgottenJobs(StatefulProcessor):
    """A state a key, as the store forgets whole states."""

    def __init__(self, key: str, ttl_days: int):
        self.key, self.ttl = key, ttl_days * 86_400_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("job", "state string, events bigint", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state, n = self.state.get() if self.state.exists() else ("QUEUED", 0)
        kinds = _in_order(rows, ["ts", "event"])["kind"].tolist()
        for kind in kinds:
            state = _moved(state, kind)
        n += len(kinds)
        self.state.update((state, n))
        yield pd.DataFrame({self.key: [key[0]], "state": [state], "events": [n]})

    def close(self) -> None:
        pass


def job_states(events: DataFrame, key: str, ttl_days: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Each job's state after each micro-batch with events of it, as the batch form in ``control`` has it; a job that nothing is heard of for ``ttl_days`` of processing time is forgotten.

    With ``ttl_days`` the query needs a trigger that goes on: Spark then asks for batches without data for as long as it runs.

    ``events``: a stream of the key, ``ts``, ``event`` and ``kind`` (submit, start, done or error).
    """
    kind = dict(events.dtypes)[key]
    rows, schema = events.select(key, "ts", "event", "kind"), f"{key} {kind}, state string, events bigint"
    if ttl_days is not None:
        return rows.groupBy(key).transformWithStateInPandas(statefulProcessor=_ForgottenJobs(key, ttl_days), outputStructType=schema, outputMode="Append", timeMode="ProcessingTime")
    return rows.withColumn("bucket", _bucket(key, buckets)).groupBy("bucket").transformWithStateInPandas(statefulProcessor=_Jobs(key), outputStructType=schema, outputMode="Append", timeMode="None")


def run_available(df: DataFrame, path: str, checkpoint: str) -> None:
    """All that is there now, appended to Parquet; run again with the same checkpoint, it goes on with what has come since."""
    with keyed_states(df.sparkSession):
        q = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
