"""Streams with state, an incremental source, draws and calibration, bound to the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyquilt.operators import audits as U
from skyquilt.operators import iterative as I
from skyquilt.operators import sampling as SP
from skyquilt.plans.bindings import query, r6, t
from skyquilt.sources import tables as T
from skyquilt.streaming import stateful
from skyquilt.streaming import streams as ST

#: Periods that a stream's input comes in, in order of time; each is a run of the query, which goes on from its checkpoint.
PERIODS = 3


def _in_periods(s, events, name: str, operator):
    """What the operator gives for the events of one period after another."""
    root = f"{I.shared_folder(s)}/{name}-{uuid.uuid4().hex}"
    cuts = events.agg(F.percentile_approx(F.unix_micros("ts"), [k / PERIODS for k in range(1, PERIODS)], 1000).alias("c")).first()["c"] or []
    period = F.lit(0)
    for c in cuts:
        period = period + (F.unix_micros("ts") > c).cast("int")
    for k in range(PERIODS):
        events.where(period == k).write.mode("append").parquet(f"{root}/in")
        stateful.run_available(operator(ST.file_stream(s, f"{root}/in", events.schema)), f"{root}/out", f"{root}/state")
    return s.read.parquet(f"{root}/out")


def _events(s, d):
    return t(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumnRenamed("event_id", "event")


_CLAIMS = """e AS (SELECT user_id, epoch_us(ts) AS t, (event_id % 2)::VARCHAR AS who, CASE WHEN event_type = 'purchase' THEN 'release' ELSE 'claim' END AS action, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
    st AS (
      SELECT DISTINCT user_id, 0::BIGINT AS r, NULL::VARCHAR AS holder, NULL::BIGINT AS since, NULL::BIGINT AS seen, []::STRUCT(holder VARCHAR, since_us BIGINT, until_us BIGINT, how VARCHAR)[] AS out FROM e
      UNION ALL
      SELECT user_id, r, CASE WHEN action = 'claim' THEN coalesce(h, who) WHEN h = who THEN NULL ELSE h END, CASE WHEN action = 'claim' THEN CASE WHEN h IS NULL THEN t ELSE since END WHEN h = who THEN NULL ELSE since END,
        CASE WHEN action = 'claim' AND coalesce(h, who) = who THEN t ELSE seen END,
        list_filter([CASE WHEN stale THEN {'holder': holder, 'since_us': since, 'until_us': seen + 21600000000, 'how': 'stale'} END, CASE WHEN action = 'claim' AND h <> who THEN {'holder': who, 'since_us': t, 'until_us': t, 'how': 'denied'} END,
          CASE WHEN action = 'release' AND h = who THEN {'holder': h, 'since_us': since, 'until_us': t, 'how': 'released'} END], lambda x: x IS NOT NULL)
      FROM (SELECT e.*, holder, since, seen, coalesce(t - seen >= 21600000000, false) AND holder IS NOT NULL AS stale, CASE WHEN coalesce(t - seen >= 21600000000, false) THEN NULL ELSE holder END AS h FROM st JOIN e ON e.user_id = st.user_id AND e.r = st.r + 1))"""


@query(
    f"""WITH RECURSIVE {_CLAIMS}, z AS (SELECT user_id, unnest(out) AS o FROM st), last_ AS (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY r DESC) = 1)
    SELECT user_id, o.holder AS holder, o.since_us AS since_us, o.until_us AS until_us, o.how AS how FROM z
    UNION ALL SELECT user_id, holder, since, seen + 21600000000, 'stale' FROM last_ WHERE holder IS NOT NULL AND seen + 21600000000 < (SELECT max(t) - 1000000 FROM e)"""
)
def claims_stream(s, d):
    """ST-6: claims on users' work as a stream: renewed, denied, released, and swept by a timer six hours after they were last seen."""
    e = _events(s, d)
    x = e.select("user_id", "ts", "event", (F.col("event") % 2).cast("string").alias("who"), F.when(F.col("event_type") == "purchase", "release").otherwise("claim").alias("action"))
    return _in_periods(s, x, "claims", lambda e: stateful.closed_claims(e, "user_id"))


@query(
    """WITH RECURSIVE e AS (SELECT user_id, event_type <> 'error' AS ok, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
    st AS (SELECT DISTINCT user_id, 0::BIGINT AS r, 4 AS lim, 0 AS run FROM e UNION ALL
      SELECT e.user_id, e.r, CASE WHEN NOT ok THEN greatest(1, lim // 2) WHEN run + 1 >= 5 THEN least(32, lim + 1) ELSE lim END, CASE WHEN ok AND run + 1 < 5 THEN run + 1 ELSE 0 END FROM st JOIN e ON e.user_id = st.user_id AND e.r = st.r + 1)
    SELECT user_id, max_by(lim, r)::INT AS "limit", max(r) AS events FROM st GROUP BY 1"""
)
def limits_stream(s, d):
    """ST-4: each source's limit after all its outcomes, kept as state between micro-batches."""
    x = _events(s, d).select("user_id", "ts", "event", (F.col("event_type") != "error").alias("ok"))
    return _in_periods(s, x, "limits", lambda e: stateful.concurrency_limits(e, "user_id")).groupBy("user_id").agg(F.max_by("limit", "events").alias("limit"), F.max("events").alias("events"))


@query(
    """WITH e AS (SELECT event_id // 3 AS job, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'error' WHEN 'click' THEN 'start' ELSE 'submit' END AS k, ts, event_id FROM events), f AS (SELECT job, min((ts, event_id)) FILTER (WHERE k = 'start') AS s, count(*) AS n FROM e GROUP BY 1),
    z AS (SELECT e.job, min_by(k, (ts, event_id)) AS k FROM e JOIN f ON e.job = f.job AND (ts, event_id) > s AND k IN ('done', 'error') GROUP BY 1)
    SELECT f.job, CASE k WHEN 'done' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE CASE WHEN s IS NULL THEN 'QUEUED' ELSE 'RUNNING' END END AS state, n AS events FROM f LEFT JOIN z USING (job)"""
)
def job_states_stream(s, d):
    """ST-12: the last state of each job that the stream has given."""
    kind = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "error").when(F.col("event_type") == "click", "start").otherwise("submit")
    x = _events(s, d).select(F.floor(F.col("event") / 3).alias("job"), "ts", "event", kind.alias("kind"))
    return _in_periods(s, x, "jobs", lambda e: stateful.job_states(e, "job")).groupBy("job").agg(F.max_by("state", "events").alias("state"), F.max("events").alias("events"))


@query("SELECT o_orderkey::VARCHAR AS scene_id, strftime(o_orderdate, '%Y-%m-%d') AS date, CASE WHEN o_orderkey % 7 > 0 THEN o_totalprice END AS cloud FROM orders")
def catalogue_scenes(s, d):
    """IO-14, ST-1: scenes of a catalogue whose pages link to each other, read by a stream in two runs; between them more pages were linked."""
    root = f"{I.shared_folder(s)}/catalogue-{uuid.uuid4().hex}"
    o = SP.with_rank(t(s, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_totalprice")).alias("cloud")), ["o_orderkey"])
    s.dataSource.register(T.CatalogueSource)
    for last in (3, None):
        T.write_catalogue(o, "rank", "o_orderkey", "day", "cloud", f"{root}/pages", 1000, last)
        stateful.run_available(s.readStream.format("catalogue").option("path", f"{root}/pages").load(), f"{root}/out", f"{root}/state")
    return s.read.parquet(f"{root}/out")


@query(
    """WITH w AS (SELECT p_partkey, p_size::DOUBLE AS w, sum(p_size::DOUBLE) OVER (ORDER BY p_partkey) AS e FROM part), n AS (SELECT count(*) AS n, max(e) AS total FROM w),
    u AS (SELECT i, ('0x' || substr(md5('42:' || i), 1, 13))::BIGINT / 4503599627370496.0 * (SELECT total FROM n) AS u FROM range(0, (SELECT n FROM n)) r(i)), x AS (SELECT p_partkey, e - w AS a FROM w)
    SELECT p_partkey, count(*) AS draws FROM u ASOF JOIN x ON u.u >= x.a GROUP BY 1"""
)
def weighted_draws(s, d):
    """SP-7: as many independent draws as there are parts, in proportion to size."""
    p = t(s, d, "part").select("p_partkey", "p_size")
    return SP.with_replacement(p, "p_size", "p_partkey", p.count(), 42).select("p_partkey", "draws")


@query(
    """WITH lut AS (SELECT p_partkey % 3 AS key, (p_size % 4) * 1500.0 AS line, (p_partkey % 8) * 25.0 AS pixel, round(avg(p_retailprice), 4) AS gain FROM part GROUP BY 1, 2, 3),
    ys AS (SELECT key, line, lead(line) OVER w AS line2, min(line) OVER v AS a, max(line) OVER v AS b FROM (SELECT DISTINCT key, line FROM lut) WINDOW w AS (PARTITION BY key ORDER BY line), v AS (PARTITION BY key)),
    xs AS (SELECT key, pixel, lead(pixel) OVER w AS pixel2, min(pixel) OVER v AS a, max(pixel) OVER v AS b FROM (SELECT DISTINCT key, pixel FROM lut) WINDOW w AS (PARTITION BY key ORDER BY pixel), v AS (PARTITION BY key)),
    p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey % 3 AS key, l_quantity * 100.0 - 300 AS y, (l_suppkey % 230) - 10.0 AS x FROM lineitem),
    c AS (SELECT p.*, line, line2, (greatest(least(y, ys.b), ys.a) - line) / (line2 - line) AS fy, pixel, pixel2, (greatest(least(x, xs.b), xs.a) - pixel) / (pixel2 - pixel) AS fx FROM p JOIN ys ON ys.key = p.key JOIN xs ON xs.key = p.key
      WHERE line2 IS NOT NULL AND pixel2 IS NOT NULL AND (greatest(least(y, ys.b), ys.a) >= line AND (greatest(least(y, ys.b), ys.a) < line2 OR line2 = ys.b)) AND (greatest(least(x, xs.b), xs.a) >= pixel AND (greatest(least(x, xs.b), xs.a) < pixel2 OR pixel2 = xs.b)))
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((1 - fy) * ((1 - fx) * a.gain + fx * b.gain) + fy * ((1 - fx) * e.gain + fx * f.gain), 6) + 0.0 AS gain FROM c
    LEFT JOIN lut a ON a.key = c.key AND a.line = c.line AND a.pixel = c.pixel LEFT JOIN lut b ON b.key = c.key AND b.line = c.line AND b.pixel = c.pixel2
    LEFT JOIN lut e ON e.key = c.key AND e.line = c.line2 AND e.pixel = c.pixel LEFT JOIN lut f ON f.key = c.key AND f.line = c.line2 AND f.pixel = c.pixel2"""
)
def calibrated_grid(s, d):
    """K-18: gains interpolated along both axes of a product's table."""
    lut = t(s, d, "part").groupBy((F.col("p_partkey") % 3).alias("key"), ((F.col("p_size") % 4) * 1500.0).alias("line"), ((F.col("p_partkey") % 8) * 25.0).alias("pixel")).agg(F.round(F.avg("p_retailprice"), 4).alias("gain"))
    p = t(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_partkey") % 3).alias("key"), (F.col("l_quantity") * 100.0 - 300).alias("y"), ((F.col("l_suppkey") % 230) - 10.0).alias("x"))
    g = U.interpolated_grid(p, lut, ["key"], "y", "x", "line", "pixel", "gain")
    return g.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", r6(F.col("gain"), "gain"))
