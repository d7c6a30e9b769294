"""Further operators bound to the driver's tables: gates and masks, indices, frames of a tile, scenes for slots, rasters."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyquilt.functions import scalars as S
from skyquilt.functions import spectral as P
from skyquilt.operators import aggregates as A
from skyquilt.operators import joins as J
from skyquilt.operators import metrics as M
from skyquilt.operators import rasters as R
from skyquilt.operators import rules as Q
from skyquilt.operators import selection as W
from skyquilt.plans.bindings import _PIXELS, _pixels, query, r6, t

# ---------------------------------------------------------------- gates and masks


@query("SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE n_chars <= 2000 AND (toxic IS NULL OR toxic <= 0) AND (quality IS NULL OR quality >= 1)")
def scene_gate(s, d):
    """F-3: what isn't known passes."""
    x = t(s, d, "documents").select("doc_id", "n_chars").join(t(s, d, "labels"), "doc_id", "left")
    return x.where(W.scene_gate("n_chars", "toxic", "quality", 2000, 0, 1)).select("doc_id")


_RING = [(5.0, 950.0), (45.0, 1000.0), (30.0, 1800.0), (10.0, 1500.0)]
_EDGES = " + ".join(
    f"(({y1} > p_retailprice) <> ({y2} > p_retailprice) AND p_size < ({x2 - x1}) * (p_retailprice - {y1}) / ({y2 - y1}) + {x1})::INT" for (x1, y1), (x2, y2) in zip(_RING, _RING[1:] + _RING[:1], strict=True)
)


@query(f"SELECT p_partkey, ({_EDGES}) % 2 = 1 AS inside FROM part")
def points_in_polygon(s, d):
    """F-7: land cells and, by the flag's other value, sea cells."""
    return t(s, d, "part").select("p_partkey", R.points_in_polygons(None, _RING, "p_size", "p_retailprice").alias("inside"))


@query("SELECT doc_id, coalesce(quality = 1, (n_chars - 1000.0) / (n_chars + 1000.0 + 1e-10) > 0) AS water FROM documents LEFT JOIN labels USING (doc_id)")
def water_mask(s, d):
    """F-10: the scene class where there is one, else the water index."""
    x = t(s, d, "documents").select("doc_id", "n_chars").join(t(s, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return x.select("doc_id", P.water_mask("quality", P.normalized_difference("n_chars", F.lit(1000.0)), 1).alias("water"))


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -900)")
def members_only(s, d):
    """F-11, J-7: rows whose code is in another table."""
    codes = t(s, d, "customer").where("c_acctbal < -900").select(F.col("c_nationkey").alias("s_nationkey"))
    return J.also_in(t(s, d, "supplier").select("s_suppkey", "s_nationkey"), codes, ["s_nationkey"]).select("s_suppkey")


@query("SELECT l_orderkey, count(DISTINCT l_linenumber) FILTER (WHERE l_linenumber BETWEEN 2 AND 4) = 3 AS complete FROM lineitem GROUP BY 1")
def season_complete(s, d):
    """F-14: the three frames of the growing season are there."""
    have = t(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_linenumber").alias("have"))
    mask = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.array_contains("have", i).cast("int"))
    return have.select("l_orderkey", Q.season_complete(mask).alias("complete"))


@query("SELECT c_custkey FROM (SELECT c_custkey, floor((c_acctbal / 60 + 180) / 6)::INT + 1 AS z FROM customer) WHERE least(abs(z - 2), 60 - abs(z - 2)) <= 29")
def zone_filter(s, d):
    """F-16, S-19: zones around one, across the antimeridian."""
    return t(s, d, "customer").where(S.zone_distance(S.utm_zone(F.col("c_acctbal") / 60), 2) <= 29).select("c_custkey")


# ---------------------------------------------------------------- indices and features


@query(
    """WITH b AS (SELECT l_returnflag, l_tax + 0.0 AS b2, l_discount + 0.0 AS b3, l_quantity / 100 AS b4, l_extendedprice / 100000 AS b8 FROM lineitem)
    SELECT l_returnflag, round(avg((b8 - b4) / (b8 + b4 + 1e-10)), 6) + 0.0 AS ndvi, round(avg((b3 - b8) / (b3 + b8 + 1e-10)), 6) + 0.0 AS ndwi, round(avg((0.1 - b8) / (0.1 + b8 + 1e-10)), 6) + 0.0 AS ndbi,
    round(avg((b8 - 0.1) / (b8 + 0.1 + 1e-10)), 6) + 0.0 AS nbr, round(avg(2.5 * (b8 - b4) / (b8 + 6 * b4 - 7.5 * b2 + 1 + 1e-10)), 6) + 0.0 AS evi FROM b GROUP BY 1"""
)
def index_means(s, d):
    """P-2, P-3, P-4, P-7, A-4: five indices by class; short waves that are missing count 0.1."""
    li = t(s, d, "lineitem").select("l_returnflag", F.col("l_tax").alias("b02"), F.col("l_discount").alias("b03"), (F.col("l_quantity") / 100).alias("b04"), (F.col("l_extendedprice") / 100000).alias("b08"))
    x = P.with_indices(P.lower_to_upper_bands(li))
    return x.groupBy("l_returnflag").agg(*[r6(F.avg(c), c) for c in ("ndvi", "ndwi", "ndbi", "nbr", "evi")])


@query(
    """SELECT l_returnflag, count(*) AS n, round(avg(sqrt((l_quantity - l_linenumber) * (l_quantity - l_linenumber) + (l_tax - l_discount) * (l_tax - l_discount))), 6) AS distance,
    round(avg(CASE WHEN l_discount > 0 THEN 10 * log10((l_discount / l_linenumber) * (l_discount / l_linenumber)) ELSE 0 END), 6) AS decibel FROM lineitem GROUP BY 1"""
)
def distance_and_backscatter(s, d):
    """P-8, P-13: distance of two bands' vectors; calibrated backscatter in dB."""
    x = t(s, d, "lineitem").select("l_returnflag", P.band_distance([("l_quantity", "l_linenumber"), ("l_tax", "l_discount")]).alias("a"), P.decibel(P.sigma0("l_discount", "l_linenumber")).alias("b"))
    return x.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.avg("a"), 6).alias("distance"), F.round(F.avg("b"), 6).alias("decibel"))


@query(
    """SELECT l_linestatus, CASE WHEN l_tax - l_discount > 0 THEN 'water' WHEN l_quantity > 30 THEN 'vegetation' WHEN l_tax - l_discount > -0.05 THEN 'wet' ELSE 'bare' END AS kind, count(*) AS n FROM lineitem GROUP BY 1, 2"""
)
def coastal_classes(s, d):
    """P-17: four classes by thresholds."""
    kind = P.coastal_class(F.col("l_tax") - F.col("l_discount"), "l_quantity", 0.0, 30.0, -0.05)
    return t(s, d, "lineitem").select("l_linestatus", kind.alias("kind")).groupBy("l_linestatus", "kind").agg(F.count("*").alias("n"))


@query(
    """SELECT user_id, round(avg(value / 10), 4) AS mean_celsius, round(sum(greatest(value / 10 - 5, 0)) * 30, 3) AS degree_days, round(sum(value), 3) AS rain_mm, round(sum(value) / 1e6, 6) AS radiation_mj FROM events GROUP BY 1"""
)
def weather_features(s, d):
    """P-18: monthly weather to features."""
    e = t(s, d, "events").select("user_id", (F.col("value") / 10 + 273.15).alias("kelvin"), (F.col("value") / 1000).alias("rain_m"), F.col("value").alias("joule"))
    f = A.weather_features(e, ["user_id"], "kelvin", "rain_m", "joule")
    return f.select("user_id", F.round("mean_celsius", 4).alias("mean_celsius"), F.round("degree_days", 3).alias("degree_days"), F.round("rain_mm", 3).alias("rain_mm"), F.round("radiation_mj", 6).alias("radiation_mj"))


@query("SELECT doc_id, CASE WHEN quality IS NULL OR toxic IS NULL THEN -1.0 ELSE abs(quality - toxic) / 2.0 END AS spread FROM documents LEFT JOIN labels USING (doc_id)")
def spread_of_methods(s, d):
    """P-20: deviation of two estimates; -1 stands for none."""
    x = t(s, d, "documents").select("doc_id").join(t(s, d, "labels"), "doc_id", "left")
    return x.select("doc_id", F.nanvl(P.spread_of_two(F.col("quality").cast("double"), F.col("toxic").cast("double")), F.lit(-1.0)).alias("spread"))


@query(
    """WITH m AS (SELECT p_brand, min(p_retailprice) AS lo, max(p_retailprice) AS hi, avg(p_size) AS mu, stddev_pop(p_size) AS sd FROM part GROUP BY 1)
    SELECT p_partkey, round(coalesce((p_retailprice - lo) / nullif(hi - lo, 0), 0), 6) AS scaled, round((p_size - mu) / greatest(sd, 1e-6), 6) + 0.0 AS z FROM part JOIN m USING (p_brand)"""
)
def normalised(s, d):
    """P-11, P-12: to the range, and to z scores, by group."""
    p = t(s, d, "part").select("p_partkey", "p_brand", "p_retailprice", "p_size")
    m = p.groupBy("p_brand").agg(F.min("p_retailprice").alias("lo"), F.max("p_retailprice").alias("hi"), F.avg("p_size").alias("mu"), F.stddev_pop("p_size").alias("sd"))
    return p.join(m, "p_brand").select("p_partkey", F.round(P.min_max("p_retailprice", "lo", "hi"), 6).alias("scaled"), r6(P.z_score("p_size", "mu", "sd"), "z"))


@query("SELECT event_id, round(atan2(sin(value / 10), cos(value / 10)) * 0.056 / (4 * pi()) * 1000, 6) + 0.0 AS mm FROM events")
def phase_displacement(s, d):
    """K-21."""
    return t(s, d, "events").select("event_id", r6(P.phase_displacement(F.col("value") / 10, 0.056), "mm"))


# ---------------------------------------------------------------- aggregations


@query(
    """WITH cm AS (SELECT l_linenumber AS t, (l_quantity::BIGINT % 7 + 1)::INT AS p, count(*) AS n FROM lineitem WHERE l_linenumber <> 1 GROUP BY 1, 2), c AS (SELECT DISTINCT t AS class FROM cm UNION SELECT p FROM cm)
    SELECT class, sum(CASE WHEN t = class AND p = class THEN n ELSE 0 END)::BIGINT AS tp, sum(CASE WHEN t <> class AND p = class THEN n ELSE 0 END)::BIGINT AS fp,
    sum(CASE WHEN t = class AND p <> class THEN n ELSE 0 END)::BIGINT AS fn FROM cm, c GROUP BY 1"""
)
def per_class_counts(s, d):
    """A-12, A-18: the ignored class leaves before anything is counted."""
    li = t(s, d, "lineitem").select("l_linenumber", (F.col("l_quantity").cast("long") % 7 + 1).cast("int").alias("p"))
    return M.per_class(M.confusion(li, "l_linenumber", "p"), 1, True).select("class", "tp", "fp", "fn")


@query("SELECT source, lang, count(*) AS n, count(l.doc_id) AS labelled, count(DISTINCT quality) AS kinds FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1, 2")
def ledger_summary(s, d):
    """A-32, A-37, A-40: counts by set and cohort."""
    x = t(s, d, "documents").select("doc_id", "source", "lang").join(t(s, d, "labels").select("doc_id", "quality", F.lit(1).alias("l")), "doc_id", "left")
    return x.groupBy("source", "lang").agg(F.count("*").alias("n"), F.count("l").alias("labelled"), F.count_distinct("quality").alias("kinds"))


@query("SELECT source, lang, round(count(*) / sum(count(*)) OVER (PARTITION BY source), 6) AS share FROM documents GROUP BY 1, 2")
def class_shares(s, d):
    """A-38, A-39, W-16: shares of classes within each source."""
    n = t(s, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return n.select("source", "lang", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("source")), 6).alias("share"))


@query("WITH c AS (SELECT year(o_orderdate)::INT AS year, o_custkey, count(*) AS n FROM orders GROUP BY 1, 2) SELECT year, count(*) AS tiles, max(n) AS most, round(avg(n), 6) AS mean FROM c GROUP BY 1")
def coverage_by_year(s, d):
    """A-41."""
    n = t(s, d, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_custkey").agg(F.count("*").alias("n"))
    return n.groupBy("year").agg(F.count("*").alias("tiles"), F.max("n").alias("most"), F.round(F.avg("n"), 6).alias("mean"))


@query("SELECT floor(value / 50)::BIGINT AS cy, hour(ts)::INT AS cx, count(*) AS n FROM events GROUP BY 1, 2")
def detection_heatmap(s, d):
    """A-44: detections by cell."""
    return t(s, d, "events").groupBy(F.floor(F.col("value") / 50).alias("cy"), F.hour("ts").alias("cx")).agg(F.count("*").alias("n"))


@query("SELECT l_suppkey, l_linenumber, round(avg(l_discount), 6) AS p0, round(avg(l_tax), 6) AS p1 FROM lineitem GROUP BY 1, 2")
def window_average(s, d):
    """A-46, A-53: overlapping predictions averaged by pixel."""
    x = R.window_means(t(s, d, "lineitem"), ["l_suppkey", "l_linenumber"], ["l_discount", "l_tax"])
    return x.select("l_suppkey", "l_linenumber", F.round("l_discount", 6).alias("p0"), F.round("l_tax", 6).alias("p1"))


@query("SELECT c_nationkey, round(coalesce(avg(CASE WHEN c_acctbal > 0 THEN (c_acctbal > 5000)::INT END), 1.0), 6) AS bright FROM customer GROUP BY 1")
def bright_fraction(s, d):
    """A-49: of the pixels with data."""
    return t(s, d, "customer").groupBy("c_nationkey").agg(F.round(A.bright_fraction("c_acctbal", 5000), 6).alias("bright"))


@query(
    """SELECT CASE WHEN n_chars < 50 THEN 'nodata' WHEN doc_id IS NULL OR l IS NULL THEN 'unlabelled' WHEN quality = 0 THEN 'rejected' ELSE 'kept' END AS verdict, count(*) AS n
    FROM documents LEFT JOIN (SELECT doc_id, quality, 1 AS l FROM labels) USING (doc_id) GROUP BY 1"""
)
def postprocess_verdicts(s, d):
    """A-56: kept, or removed by the first cause."""
    x = t(s, d, "documents").select("doc_id", "n_chars").join(t(s, d, "labels").select("doc_id", "quality", F.lit(1).alias("l")), "doc_id", "left")
    verdict = F.when(F.col("n_chars") < 50, "nodata").when(F.col("l").isNull(), "unlabelled").when(F.col("quality") == 0, "rejected").otherwise("kept")
    return x.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- windows and choices


@query("SELECT user_id, event_id, (r - 1)::INT AS fallback FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS r FROM events) WHERE r > 1")
def fallback_scenes(s, d):
    """W-9: all scenes of a tile but the clearest, in order."""
    r = F.row_number().over(Window.partitionBy("user_id").orderBy("value", "event_id"))
    return t(s, d, "events").select("user_id", "event_id", (r - 1).alias("fallback")).where("fallback > 0")


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events WHERE event_type = 'error') WHERE r <= 5")
def last_failures(s, d):
    """W-10."""
    return W.first_per(t(s, d, "events").where("event_type = 'error'").select("user_id", "event_id", "ts"), ["user_id"], [F.desc("ts"), F.col("event_id")], 5).select("user_id", "event_id")


@query(
    """WITH f AS (SELECT DISTINCT l_orderkey AS o, least(l_linenumber, 4) - 1 AS j FROM lineitem)
    SELECT o AS l_orderkey, i::INT AS frame, (arg_min(j, abs(i - j) * 10 + CASE j WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 0 THEN 3 ELSE 4 END))::INT AS filled_from FROM f, range(0, 4) r(i) GROUP BY 1, 2"""
)
def fill_frames(s, d):
    """W-13: empty frames take the nearest one, summer first."""
    have = t(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.least("l_linenumber", F.lit(4))).alias("have"))
    x = have.select("l_orderkey", F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: F.array_contains("have", i)).alias("filled"))
    return x.select("l_orderkey", F.posexplode(S.nearest_filled("filled", "filled", [1, 2, 0, 3])).alias("frame", "filled_from"))


@query(
    """WITH x AS (SELECT o_orderkey, dayofyear(o_orderdate) AS a, dayofyear(o_orderdate) + 61 AS b FROM orders)
    SELECT o_orderkey, i::INT AS k, (floor(a + i * (b - a) / 3))::INT AS first, CASE WHEN i = 2 THEN greatest(b, 300) ELSE floor(a + (i + 1) * (b - a) / 3) - 1 END::INT AS last FROM x, range(0, 3) r(i)"""
)
def season_windows(s, d):
    """W-14: three equal windows of a season."""
    a = F.dayofyear("o_orderdate")
    x = t(s, d, "orders").select("o_orderkey", F.posexplode(S.season_windows(a, a + 61, 3, 300)).alias("k", "w"))
    return x.select("o_orderkey", "k", F.col("w.first").alias("first"), F.col("w.last").cast("int").alias("last"))


@query(
    """WITH dt AS (SELECT user_id, ts::DATE AS date, min(value) / 600 AS cloud, bool_or(event_type = 'view') AS ok FROM events GROUP BY 1, 2),
    sl AS (SELECT user_id, k::INT AS slot, DATE '2024-01-01' + ((k - 1) * 10)::INT AS a, DATE '2024-01-01' + (k * 10 - 1)::INT AS b FROM (SELECT DISTINCT user_id FROM events), range(1, 4) r(k)),
    p AS (SELECT user_id, slot, date, CASE WHEN ok AND cloud <= 0.1 THEN 0 WHEN cloud <= 0.4 THEN 1 END AS tier, abs(date_diff('day', a + 4, date)) AS gap FROM sl JOIN dt USING (user_id) WHERE date BETWEEN a AND b),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, slot ORDER BY tier, gap, date) AS r FROM p WHERE tier IS NOT NULL) WHERE r = 1)
    SELECT user_id, slot, date, tier FROM best WHERE user_id IN (SELECT user_id FROM best GROUP BY 1 HAVING count(*) = 3)"""
)
def slot_dates(s, d):
    """T-1, T-4: a date for each slot, strict before relaxed; tiles that lack one are left out."""
    e = t(s, d, "events")
    unknown = F.lit(None).cast("double")
    dates = e.groupBy("user_id", F.to_date("ts").alias("date")).agg((F.min("value") / 600).alias("cloud"), F.bool_or(F.col("event_type") == "view").alias("weather_ok")).withColumns({"snow": unknown, "seen": unknown})
    k = F.explode(F.sequence(F.lit(1), F.lit(3)))
    first = F.lit("2024-01-01").cast("date")
    slots = e.select("user_id").distinct().withColumn("slot", k).withColumns({"start": F.date_add(first, (F.col("slot") - 1) * 10), "end": F.date_add(first, F.col("slot") * 10 - 1)})
    return W.slot_dates(dates, slots, "user_id")


@query("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY abs(date_diff('day', make_date(year(o_orderdate), 7, 14), o_orderdate::DATE)), o_orderkey) AS r FROM orders) WHERE r = 1")
def nearest_to_midsummer(s, d):
    """T-3, T-10, T-11, T-12: of each tile the frame nearest to a day of the year."""
    o = t(s, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return W.nearest_to(o, ["o_custkey"], "day", F.make_date(F.year("day"), F.lit(7), F.lit(14)), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@query("SELECT user_id, arg_min(event_type, m) AS choice FROM (SELECT user_id, event_type, (round(avg(value), 6), event_type) AS m FROM events GROUP BY 1, 2) GROUP BY 1")
def fastest_source(s, d):
    """T-14, T-6: the source with the least mean latency, the first by name of equal ones."""
    m = t(s, d, "events").groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("m"))
    return m.groupBy("user_id").agg(F.min_by("event_type", F.struct("m", "event_type")).alias("choice"))


# ---------------------------------------------------------------- scalars

_NAME = "CASE WHEN c_nationkey < 6 THEN 'tile_' WHEN c_nationkey < 12 THEN 'crop_wheat_' WHEN c_nationkey < 18 THEN 'urban_' ELSE '' END || c_custkey::{}"


@query(
    f"""SELECT c_custkey, CASE WHEN n LIKE 'tile\\_%' ESCAPE '\\' THEN 'lulc' WHEN n LIKE 'crop\\_%' ESCAPE '\\' THEN 'crop' WHEN n LIKE 'urban\\_%' ESCAPE '\\' THEN 'urban' ELSE 'numeric' END AS cohort,
    CASE WHEN n LIKE 'crop\\_%' ESCAPE '\\' THEN 12 END AS expected FROM (SELECT c_custkey, {_NAME.format("VARCHAR")} AS n FROM customer)"""
)
def cohorts(s, d):
    """S-1, S-3: what a name says of its tile."""
    x = t(s, d, "customer").select("c_custkey", F.expr(_NAME.format("STRING")).alias("n"))
    return x.select("c_custkey", S.cohort("n").alias("cohort"), S.expected_class("n", {"wheat": 12, "barley": 13}).alias("expected"))


@query(
    """WITH x AS (SELECT o_orderkey, o_orderdate::DATE AS a, greatest(max(l_shipdate::DATE), o_orderdate::DATE) AS b FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderdate),
    k AS (SELECT *, date_diff('day', a, b) + 1 AS n, ceil((date_diff('day', a, b) + 1) / 19)::INT AS k FROM x), c AS (SELECT *, unnest(range(0, k)) AS i FROM k)
    SELECT o_orderkey, a + floor(i * n / k)::INT AS start, a + (floor((i + 1) * n / k)::INT - 1) AS "end" FROM c"""
)
def balanced_chunks(s, d):
    """S-18, ST-2: a period in as few even chunks as fit."""
    last = t(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.to_date("l_shipdate")).alias("b"))
    x = t(s, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a")).join(last, "o_orderkey")
    return x.select("o_orderkey", F.explode(S.balanced_chunks("a", F.greatest("a", "b"), 19)).alias("c")).select("o_orderkey", "c.start", "c.end")


@query(
    """WITH b AS (SELECT c_custkey, c_acctbal AS w, c_nationkey * 10.0 AS s, c_acctbal + 200 AS e, c_nationkey * 10.0 + 8 AS n FROM customer), i AS (SELECT s_suppkey, s_acctbal AS w2, s_nationkey * 10.0 + 3 AS s2, s_acctbal + 300 AS e2, s_nationkey * 10.0 + 13.5 AS n2 FROM supplier),
    p AS (SELECT c_custkey, s_suppkey, round(greatest(0, least(e, e2) - greatest(w, w2)) * greatest(0, least(n, n2) - greatest(s, s2)), 4) AS area FROM b JOIN i ON NOT (e2 < w OR w2 > e OR n2 < s OR s2 > n))
    SELECT c_custkey, s_suppkey, area FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY area DESC, s_suppkey) AS r FROM p) WHERE r = 1"""
)
def best_overlap(s, d):
    """J-17, S-23: the item that covers most of a request."""
    nat = lambda c: F.col(c) * 10.0
    b = t(s, d, "customer").select("c_custkey", F.col("c_acctbal").alias("w"), nat("c_nationkey").alias("s"), (F.col("c_acctbal") + 200).alias("e"), (nat("c_nationkey") + 8).alias("n"))
    i = t(s, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("w2"), (nat("s_nationkey") + 3).alias("s2"), (F.col("s_acctbal") + 300).alias("e2"), (nat("s_nationkey") + 13.5).alias("n2"))
    return J.best_overlap(b, i, "c_custkey", ("w", "s", "e", "n"), ("w2", "s2", "e2", "n2"), "s_suppkey", 100)


@query("SELECT round_even(c_acctbal / 250, 0) * 250 + 0.0 AS cell, count(*) AS n, count(DISTINCT c_nationkey) AS nations FROM customer GROUP BY 1")
def weather_cells(s, d):
    """J-18: many tiles share a weather cell."""
    return t(s, d, "customer").groupBy((S.weather_cell("c_acctbal", 250) + 0.0).alias("cell")).agg(F.count("*").alias("n"), F.count_distinct("c_nationkey").alias("nations"))


@query(
    """WITH v AS (SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS pine, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS spruce, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS birch FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CASE WHEN pine / (pine + spruce + birch) >= 0.7 THEN 'pine' WHEN spruce / (pine + spruce + birch) >= 0.7 THEN 'spruce' WHEN birch / (pine + spruce + birch) >= 0.7 THEN 'broadleaved' ELSE 'mixed' END AS kind FROM v"""
)
def forest_classes(s, d):
    """S-29: the species that dominates a plot."""
    v = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0))
    x = t(s, d, "lineitem").groupBy("l_orderkey").agg(v("A").alias("pine"), v("N").alias("spruce"), v("R").alias("birch"))
    return x.select("l_orderkey", S.forest_class("pine", "spruce", F.lit(0.0), "birch", F.lit(0.0)).alias("kind"))


# ---------------------------------------------------------------- rasters


@query(
    """SELECT l_returnflag AS tile, l_suppkey AS row, l_linestatus AS col, """ + ", ".join(f"nullif(count(*) FILTER (WHERE l_linenumber = {k}), 0) AS slot_{k}" for k in range(1, 8)) + " FROM lineitem GROUP BY 1, 2, 3"
)
def frame_cube(s, d):
    """K-17: the frames of a tile side by side."""
    n = t(s, d, "lineitem").groupBy(F.col("l_returnflag").alias("tile"), F.col("l_suppkey").alias("row"), F.col("l_linestatus").alias("col"), F.col("l_linenumber").alias("slot")).agg(F.count("*").alias("n"))
    return R.frame_cube(n, list(range(1, 8)), "n")


@query(f"WITH {_PIXELS} SELECT a.tile, a.row, a.col, a.mask, b.mask AS moved FROM px a JOIN px b ON a.tile = b.tile AND a.row = b.row + 1 AND a.col = b.col + 2")
def aligned_grids(s, d):
    """K-1: one grid moved onto another, where both have data."""
    p = _pixels(s, d)
    return R.aligned(p, p.withColumnRenamed("mask", "moved"), 1, 2).select("tile", "row", "col", "mask", "moved")


@query(
    f"""WITH {_PIXELS}, w AS (SELECT p.tile, p.row, p.col, dy, dx, q.mask AS v FROM (SELECT * FROM px WHERE mask = 1) p, range(-1, 2) a(dy), range(-1, 2) b(dx) LEFT JOIN px q ON q.tile = p.tile AND q.row = p.row + dy AND q.col = p.col + dx)
    SELECT tile, row, col, string_agg(coalesce(v::VARCHAR, '-'), '' ORDER BY dy, dx) AS patch FROM w GROUP BY 1, 2, 3"""
)
def context_patches(s, d):
    """K-15: the square around each set pixel, as text; - lies outside."""
    p = _pixels(s, d)
    got = R.patches(p, p.where("mask = 1"), "mask", 1)
    return got.select("tile", "row", "col", F.array_join(F.transform("patch", lambda v: v.cast("string")), "", "-").alias("patch"))
