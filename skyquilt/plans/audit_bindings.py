"""Audits, control tables, names and dates, pixel work and round trips through files, bound to the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyquilt.functions import scalars as S
from skyquilt.operators import aggregates as A
from skyquilt.operators import audits as U
from skyquilt.operators import control as C
from skyquilt.operators import iterative as I
from skyquilt.operators import joins as J
from skyquilt.operators import metrics as M
from skyquilt.operators import rasters as R
from skyquilt.operators import rules as Q
from skyquilt.operators import selection as W
from skyquilt.plans.bindings import _RASTER, query, r6, raster, t
from skyquilt.sources import committed
from skyquilt.sources import tables as T
from skyquilt.streaming import streams as ST

# ---------------------------------------------------------------- tiles: an order is a tile, its lines are frames

_FRAMES = """g AS (SELECT l_orderkey AS tile, least(l_linenumber, 4) - 1 AS slot, strftime(min(l_shipdate), '%Y-%m-%d') AS d0, dayofyear(min(l_shipdate))::INT AS doy, max(l_quantity) AS q, min(l_discount) AS dis, max(l_tax) AS tax
    FROM lineitem GROUP BY 1, 2),
  tile AS (SELECT o_orderkey AS tile, year(o_orderdate)::INT AS y FROM orders WHERE o_orderkey IN (SELECT tile FROM g)),
  grid AS (SELECT tile, y, i::INT AS slot FROM tile, range(0, 4) r(i)),
  s AS (SELECT grid.tile, y, grid.slot, CASE WHEN q > 49 THEN 'unknown' ELSE coalesce(d0, '') END AS date, coalesce(doy + CASE WHEN q BETWEEN 40 AND 45 THEN 1 ELSE 0 END, 0)::INT AS day, CASE WHEN d0 IS NULL THEN 0 ELSE 1 END AS mask,
    coalesce(dis > 0.005, false) AS content, CASE WHEN d0 IS NULL THEN '' WHEN tax > 0.075 THEN '2000-01-01' WHEN q > 49 THEN 'unknown' ELSE d0 END AS nir,
    CASE WHEN d0 IS NULL THEN '' WHEN dis BETWEEN 0.055 AND 0.065 THEN '2001-01-01' WHEN q > 49 THEN 'unknown' ELSE d0 END AS edge
    FROM grid LEFT JOIN g ON g.tile = grid.tile AND g.slot = grid.slot)"""


def _frames(s, d):
    """Orders as tiles of four slots, with everything that may be wrong with them: columns as ``audits.frame_audit`` takes them."""
    g = t(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("tile"), (F.least("l_linenumber", F.lit(4)) - 1).alias("slot")).agg(
        F.min("l_shipdate").alias("d"), F.max("l_quantity").alias("q"), F.min("l_discount").alias("dis"), F.max("l_tax").alias("tax")
    )
    q, day = F.col("q"), F.date_format("d", "yyyy-MM-dd")
    x = g.select(
        "tile", "slot", F.when(q > 49, "unknown").otherwise(day).alias("date"), (F.dayofyear("d") + q.between(40, 45).cast("int")).alias("day"), (F.col("dis") > 0.005).alias("content"),
        F.when(F.col("tax") > 0.075, "2000-01-01").when(q > 49, "unknown").otherwise(day).alias("nir"), F.when(F.col("dis").between(0.055, 0.065), "2001-01-01").when(q > 49, "unknown").otherwise(day).alias("edge"),
    )
    m = x.groupBy("tile").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.struct("date", "day", "content", "nir", "edge")))).alias("m"))
    of = lambda f, empty: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.coalesce(F.try_element_at("m", i)[f], F.lit(empty)))
    m = m.join(t(s, d, "orders").select(F.col("o_orderkey").alias("tile"), F.year("o_orderdate").alias("tile_year")), "tile")
    mask = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.map_contains_key("m", i).cast("int"))
    return m.select("tile", "tile_year", F.when(F.col("tile") % 50 == 0, 3).otherwise(4).alias("n_values"), mask.alias("mask"), of("content", False).alias("content"), of("date", "").alias("dates"), of("day", 0).alias("days"), of("nir", "").alias("nir_dates"), of("edge", "").alias("edge_dates"))


@query(
    f"""WITH {_FRAMES}, v AS (SELECT *, try_cast(nullif(date, '') AS DATE) AS dt FROM s),
    nx AS (SELECT tile, slot, dt, lead(slot) OVER w AS slot2, lead(dt) OVER w AS dt2 FROM v WHERE dt IS NOT NULL WINDOW w AS (PARTITION BY tile ORDER BY slot)),
    f AS (SELECT tile, y, dt, date, mask FROM v WHERE slot = 0),
    e AS (
      SELECT DISTINCT tile, 'spectral_shape' AS issue, 'rebuild_tile' AS need FROM s WHERE tile % 50 = 0
      UNION ALL SELECT tile, 'tmask_consistency:slot_' || slot, 'refetch_slot_' || slot FROM s WHERE (mask = 1) <> content
      UNION ALL SELECT tile, 'date_parseable:slot_' || slot, 'refetch_slot_' || slot FROM v WHERE date <> '' AND dt IS NULL
      UNION ALL SELECT tile, 'doy_matches_date:slot_' || slot, NULL FROM v WHERE dayofyear(dt) <> day
      UNION ALL SELECT tile, 'monotonic_calendar:slot_' || slot, 'refetch_slot_' || slot2 FROM nx WHERE dt2 <= dt
      UNION ALL SELECT tile, 'all_4_slots_filled:slot_' || slot, 'refetch_slot_' || slot FROM s WHERE mask = 0
      UNION ALL SELECT tile, 'late_autumn_bug:slot_' || slot, 'refetch_slot_' || slot FROM v WHERE slot > 0 AND mask = 1 AND year(dt) = y AND day > 244
      UNION ALL SELECT tile, 'wrong_layout', 'refetch_slot_0' FROM f WHERE mask = 1 AND date <> '' AND year(dt) = y
      UNION ALL SELECT tile, 'year_consistency', NULL FROM f WHERE mask = 1 AND date <> '' AND year(dt) <> y - 1
      UNION ALL SELECT tile, 'slot_3_too_early', 'refetch_slot_3' FROM s WHERE slot = 3 AND mask = 1 AND day > 0 AND day < 200
      UNION ALL SELECT tile, 'b08_date_drift:slot_' || slot, 'enrich_b08_slot_' || slot FROM s WHERE date <> '' AND nir <> '' AND nir <> date
      UNION ALL SELECT tile, 'rededge_date_drift:slot_' || slot, 'enrich_rededge_slot_' || slot FROM s WHERE date <> '' AND edge <> '' AND edge <> date)
    SELECT t.tile, coalesce(string_agg(e.issue, ',' ORDER BY e.issue), '') AS issues, coalesce(string_agg(DISTINCT e.need, ',' ORDER BY e.need), '') AS needs FROM tile t LEFT JOIN e USING (tile) GROUP BY 1"""
)
def frame_audit(s, d):
    """Q-1: the twelve checks of a tile's frames."""
    x = U.frame_audit(_frames(s, d))
    return x.select("tile", F.array_join("issues", ",").alias("issues"), F.array_join("needs", ",").alias("needs"))


@query(
    f"""WITH {_FRAMES}, a AS (SELECT tile, list(date ORDER BY slot) AS l FROM s GROUP BY 1), y AS (SELECT tile, list_transform(l, lambda x: CASE WHEN regexp_matches(x, '^[0-9]{{4}}') THEN x[1:4]::INT END) AS y FROM a)
    SELECT tile, CASE WHEN list_contains(list_transform(y, lambda x: x IS NULL), true) THEN 'bad' WHEN y[2] = y[3] AND y[3] = y[4] AND y[1] = y[2] - 1 THEN 'ok' WHEN y[2] = y[3] AND y[3] = y[4] AND y[1] = y[2] THEN 'same_year' ELSE 'inconsistent' END AS kind FROM y"""
)
def date_issue_class(s, d):
    """Q-9: how the years of a tile's dates lie."""
    return _frames(s, d).select("tile", U.date_class("dates").alias("kind"))


@query("SELECT o_orderkey, (SELECT min_by(v, abs(v - (year(o_orderdate) + o_orderkey % 31)) * 10000 + v) FROM (VALUES (2018), (2019), (2022), (2023), (2024)) c(v))::INT AS vintage FROM orders")
def order_vintage(s, d):
    """Q-9, J-23: the nearest year there are data of."""
    return t(s, d, "orders").select("o_orderkey", U.nearest_vintage(F.year("o_orderdate") + F.col("o_orderkey") % 31).alias("vintage"))


@query(
    """WITH a AS (SELECT l_suppkey, min(l_linenumber) - 1 AS lo, max(l_linenumber) AS hi, avg(CASE WHEN l_linenumber = 1 THEN 1.0 ELSE 0 END) AS bg, max(n * 1.0) / sum(n) AS top, sum(n) FILTER (WHERE l_linenumber = 3) * 1.0 / sum(n) AS e
      FROM (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1),
    b AS (SELECT l_suppkey, avg(CASE WHEN l_linenumber = 1 THEN 1.0 ELSE 0 END) AS bg FROM lineitem GROUP BY 1)
    SELECT l_suppkey, array_to_string(list_filter([CASE WHEN lo < 0 OR hi >= 7 THEN 'range: label outside the classes' END, CASE WHEN b.bg >= 1.0 THEN 'background: nothing else' END, CASE WHEN top >= 0.18 THEN 'uniform: one class nearly everywhere' END,
      CASE WHEN l_suppkey % 3 = 0 AND coalesce(e, 0) = 0 THEN 'expected: class absent' END, CASE WHEN l_suppkey % 3 = 0 AND e > 0 AND e < 0.14 THEN 'expected: class below its share' END], lambda x: x IS NOT NULL), ',') AS reasons FROM a JOIN b USING (l_suppkey)"""
)
def label_validation(s, d):
    """Q-2, Q-13: ranges, backgrounds, uniformity and expected classes of a tile's labels (suppliers as tiles, line numbers as classes)."""
    n = t(s, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("n"))
    c, total = F.col("l_linenumber"), F.sum("n")
    of = lambda k: F.coalesce(F.sum(F.when(c == k, F.col("n"))), F.lit(0)) / total
    a = n.groupBy("l_suppkey").agg((F.min(c) - 1).alias("min_label"), F.max(c).alias("max_label"), of(1).alias("background"), (F.max("n") / total).alias("top_share"), of(3).alias("expected_share"))
    a = a.withColumn("expected", F.when(F.col("l_suppkey") % 3 == 0, 3))
    return Q.audit(a, Q.label_rules(7, 0.14, 0.18)).select("l_suppkey", F.array_join("reasons", ",").alias("reasons"))


@query(
    """WITH a AS (SELECT l_orderkey AS tile, max(CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END) AS a, max(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS b, sum(CASE WHEN l_linenumber = 2 THEN round(l_discount * 100) ELSE 0 END) AS sa, sum(CASE WHEN l_linenumber = 3 THEN round(l_tax * 100) ELSE 0 END) AS sb FROM lineitem GROUP BY 1)
    SELECT tile, array_to_string(list_filter([CASE WHEN a = 1 AND sa = 0 THEN 'has_a: set without data' END, CASE WHEN b = 1 AND sb = 0 THEN 'has_b: set without data' END], lambda x: x IS NOT NULL), ',') AS reasons FROM a"""
)
def flags_without_data(s, d):
    """Q-3: a flag says that a layer is there, and there is nothing in it."""
    n, of = F.col("l_linenumber"), lambda k, c: F.sum(F.when(F.col("l_linenumber") == k, F.round(F.col(c) * 100)).otherwise(0))
    a = t(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("tile")).agg(F.max((n == 2).cast("int")).alias("has_a"), F.max((n == 3).cast("int")).alias("has_b"), of(2, "l_discount").alias("sa"), of(3, "l_tax").alias("sb"))
    return Q.audit(a, Q.present_but_empty([("has_a", F.col("sa") > 0), ("has_b", F.col("sb") > 0)])).select("tile", F.array_join("reasons", ",").alias("reasons"))


@query(
    """WITH f AS (SELECT l_suppkey, l_linenumber, round(avg(CASE WHEN l_discount > 0.055 THEN 1.0 ELSE 0 END), 6) AS cloud FROM lineitem GROUP BY 1, 2),
    b AS (SELECT l_suppkey, first(l_linenumber ORDER BY cloud, l_linenumber) AS best FROM f WHERE cloud <= 0.4 GROUP BY 1)
    SELECT l_suppkey, l_linenumber, cloud, cloud <= 0.4 AS ok, CASE WHEN cloud > 0.4 THEN best END AS replacement FROM f LEFT JOIN b USING (l_suppkey)"""
)
def cloud_check(s, d):
    """Q-6: frames with too much cloud, and what takes their place."""
    f = t(s, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(r6(F.avg((F.col("l_discount") > 0.055).cast("double")), "cloud"))
    return U.cloud_check(f, "l_suppkey", "l_linenumber", "cloud", 0.4)


@query(
    """WITH w AS (SELECT o_orderkey AS k, 60 + o_orderkey % 40 AS a, 220 + o_orderkey % 60 AS b, year(o_orderdate) AS y0 FROM orders), z AS (SELECT k, i::INT AS i, (a + i * (b - a) / 3.0)::DECIMAL(20,9) AS lo, (a + (i + 1) * (b - a) / 3.0)::DECIMAL(20,9) AS hi, b FROM w, range(0, 3) r(i)),
    c AS (SELECT k, floor(lo)::INT AS lo, least(CASE WHEN i = 2 THEN greatest(b, 240) ELSE floor(hi)::INT - 1 END, 244) AS hi FROM z), n AS (SELECT k FROM c WHERE lo <= hi GROUP BY 1 HAVING count(*) >= 3),
    f AS (SELECT l_orderkey AS k, least(l_linenumber, 4) - 1 AS slot, dayofyear(min(l_shipdate)) AS day, year(min(l_shipdate)) AS y FROM lineitem GROUP BY 1, 2),
    o AS (SELECT DISTINCT f.k FROM f JOIN w ON w.k = f.k WHERE slot > 0 AND NOT (y = y0 AND EXISTS (SELECT 1 FROM c WHERE c.k = f.k AND day BETWEEN lo AND hi)))
    SELECT w.k AS o_orderkey, n.k IS NOT NULL AND o.k IS NOT NULL AS displaced FROM w LEFT JOIN n ON n.k = w.k LEFT JOIN o ON o.k = w.k"""
)
def window_displacement(s, d):
    """Q-8: frames of the growing season outside its windows (orders as tiles, their lines as frames)."""
    li = t(s, d, "lineitem").groupBy("l_orderkey", (F.least("l_linenumber", F.lit(4)) - 1).alias("k")).agg(F.min("l_shipdate").alias("d"))
    m = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.map_from_entries(F.collect_list(F.struct("k", "d"))).alias("m"))
    x = t(s, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y0")).join(m, "o_orderkey", "left").withColumn("m", F.coalesce("m", F.create_map().cast("map<int,timestamp_ntz>")))
    of = lambda f: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: f(F.try_element_at("m", i)))
    windows = S.season_windows(60 + F.col("o_orderkey") % 40, 220 + F.col("o_orderkey") % 60, 3, 240)
    x = x.select("o_orderkey", "y0", windows.alias("w"), of(F.dayofyear).alias("days"), of(F.year).alias("years"), of(lambda v: v.isNotNull().cast("int")).alias("mask"))
    return x.select("o_orderkey", U.displaced(F.col("w"), "days", "years", "mask", F.col("y0")).alias("displaced"))


@query(
    "SELECT c_custkey, a > 200000 AND a < 1000000 AND c > 200000 AND c < 1000000 AND b > 6000000 AND b < 7800000 AND d > 6000000 AND d < 7800000 AS ok FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 6500000 + c_custkey ELSE 300000 + c_custkey * 10 END AS a, CASE WHEN c_custkey % 7 = 0 THEN 300000 ELSE 6100000 + c_nationkey * 80000 END AS b, a + 2560 AS c, b + 2560 AS d FROM customer)"
)
def axes_check(s, d):
    """Q-11: boxes whose axes are swapped or out of range."""
    k, swapped = F.col("c_custkey"), F.col("c_custkey") % 7 == 0
    x = t(s, d, "customer").select("c_custkey", F.when(swapped, 6500000 + k).otherwise(300000 + k * 10).alias("w"), F.when(swapped, 300000).otherwise(6100000 + F.col("c_nationkey") * 80000).alias("s"))
    return x.select("c_custkey", U.axes_sane("w", "s", F.col("w") + 2560, F.col("s") + 2560).alias("ok"))


@query("SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'brand,name' ELSE 'brand,name,size' END AS keys, p_size % 7 <> 0 AS untouched FROM part")
def key_repair(s, d):
    """Q-12: unwanted keys go, and nothing else may have changed."""
    size = F.col("p_size").cast("string")
    x = t(s, d, "part").select("p_partkey", "p_size", F.when(F.col("p_size") % 5 == 0, F.create_map(F.lit("name"), "p_name", F.lit("brand"), "p_brand", F.lit("old_a"), size)).otherwise(F.create_map(F.lit("name"), "p_name", F.lit("brand"), "p_brand", F.lit("size"), size)).alias("m"))
    after = U.strip_keys("m", ["old_a", "old_b"])
    damaged = F.when(F.col("p_size") % 7 == 0, F.map_concat(F.map_filter(after, lambda k, _: k != "name"), F.create_map(F.lit("name"), F.lit("?")))).otherwise(after)
    return x.withColumn("after", damaged).select("p_partkey", F.array_join(F.array_sort(F.map_keys("after")), ",").alias("keys"), U.only_changed("m", "after", ["old_a", "old_b"]).alias("untouched"))


@query(
    """WITH a AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity >= 45), b AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F'), c AS (SELECT count(*) AS n FROM a JOIN b USING (k))
    SELECT c.n AS collisions, c.n = 0 AS allowed, (SELECT count(*) FROM a) AS staging, (SELECT count(*) FROM b) AS live, (SELECT count(*) FROM (SELECT k FROM a UNION SELECT k FROM b)) AS after FROM c"""
)
def merge_counts(s, d):
    """J-16, Q-10: keys in staging and live, and the count after a merge."""
    a, b = t(s, d, "lineitem").where("l_quantity >= 45").select(F.col("l_orderkey").alias("k")).distinct(), t(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    counts = a.select("k", F.lit(1).alias("s"), F.lit(0).alias("l")).unionByName(b.select("k", F.lit(0).alias("s"), F.lit(1).alias("l"))).groupBy("k").agg(F.max("s").alias("s"), F.max("l").alias("l"))
    return Q.merge_allowed(a, b, "k").crossJoin(counts.agg(F.sum("s").alias("staging"), F.sum("l").alias("live"), F.count("*").alias("after")))


# ---------------------------------------------------------------- years and names


@query("SELECT o_custkey, max_by(y, n * 10000 + y) AS y, max(n) AS n FROM (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1")
def modal_year_latest(s, d):
    """A-42: the most frequent year, ties to the latest."""
    return A.modal_class(t(s, d, "orders").select("o_custkey", F.year("o_orderdate").cast("long").alias("y")), ["o_custkey"], "y", "highest")


@query(
    f"""WITH {_FRAMES}, v AS (SELECT tile, y, slot, year(try_cast(nullif(date, '') AS DATE)) AS dy, dayofyear(try_cast(nullif(date, '') AS DATE)) AS doy, date FROM s),
    c AS (SELECT tile, dy, count(*) AS n FROM v WHERE dy IS NOT NULL GROUP BY 1, 2), m AS (SELECT tile, max_by(dy, n * 10000 + dy) AS latest, max_by(dy, n * 10000 - dy) AS oldest FROM c GROUP BY 1),
    f AS (SELECT tile, min_by(dy, slot) AS fy, min_by(CASE WHEN doy >= 228 THEN dy + 1 ELSE dy END, slot) AS late FROM (SELECT * FROM v WHERE date <> '' QUALIFY row_number() OVER (PARTITION BY tile ORDER BY slot) = 1) GROUP BY 1),
    k AS (SELECT tile, CASE WHEN tile % 3 = 0 THEN y END AS own, CASE WHEN tile % 5 = 0 THEN y + 1 END AS parcel, CASE WHEN tile % 7 = 0 THEN y + 2 END AS model FROM tile)
    SELECT k.tile, coalesce(own, parcel, latest)::INT AS a, coalesce(own, parcel, latest, 2022)::INT AS b, coalesce(model, parcel, own, fy)::INT AS c, coalesce(model, parcel, own, late)::INT AS d, coalesce(model, parcel, own)::INT AS e, coalesce(own, fy)::INT AS f, oldest::INT AS g FROM k LEFT JOIN m USING (tile) LEFT JOIN f USING (tile)"""
)
def tile_years(s, d):
    """S-17: the seven ways to date a tile, which differ in the order of their sources."""
    x = _frames(s, d).select("tile", "dates", *[F.when(F.col("tile") % n == 0, F.col("tile_year") + k).alias(c) for n, k, c in ((3, 0, "own"), (5, 1, "parcel"), (7, 2, "model"))])
    x = x.withColumns({"latest": S.modal_year("dates"), "oldest": S.modal_year("dates", "oldest"), "first": S.first_year("dates"), "late": S.first_year("dates", 228)})
    ways = {"a": ("own", "parcel", "latest"), "b": ("own", "parcel", "latest", F.lit(2022)), "c": ("model", "parcel", "own", "first"), "d": ("model", "parcel", "own", "late"), "e": ("model", "parcel", "own"), "f": ("own", "first"), "g": ("oldest",)}
    return x.select("tile", *[S.tile_year(*v).cast("int").alias(k) for k, v in ways.items()])


@query(
    """SELECT p_partkey, split_part(n, '_', 6)[2:3]::INT AS zone, split_part(n, '_', 6)[4:4] AS band, split_part(n, '_', 6)[5:6] AS square, 300000 + p_partkey AS easting, 6500000 + p_size * 10 AS northing,
    CASE p_size % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS expected, CASE WHEN p_partkey % 2 = 0 THEN 'SOSD' ELSE 'EOSD' END AS quantity, 2018 + (p_size % 5) AS year, 'T' || (30 + p_partkey % 8) || 'VXF' AS tile FROM (SELECT *, 'S2A_MSIL1C_2018_N0206_R108_T' || (30 + p_size % 8) || chr(65 + p_size % 20) || chr((65 + p_partkey % 20)::INT) || 'F_x.SAFE' AS n FROM part)"""
)
def product_names(s, d):
    """S-2, S-3, S-4, S-5: what names of tiles, products and files say."""
    size, band = F.col("p_size"), F.char(65 + F.col("p_size") % 20)
    x = t(s, d, "part").select(
        "p_partkey", F.concat(F.lit("S2A_MSIL1C_2018_N0206_R108_T"), 30 + size % 8, band, F.char(65 + F.col("p_partkey") % 20), F.lit("F_x.SAFE")).alias("product"), F.concat(F.lit("tile_"), 300000 + F.col("p_partkey"), F.lit("_"), 6500000 + size * 10).alias("name"),
        F.concat(F.lit("crop_"), F.when(size % 3 == 0, "wheat").when(size % 3 == 1, "barley").otherwise("clover"), F.lit("_1")).alias("crop"), F.concat(F.lit("VPP_"), 2018 + size % 5, F.lit("_S2_T"), 30 + F.col("p_partkey") % 8, F.lit("VXF-010m_V101_s1_"), F.when(F.col("p_partkey") % 2 == 0, "SOSD").otherwise("EOSD"), F.lit(".tif")).alias("file"),
    )
    grid, at, file = S.grid_square("product"), S.name_coordinates("name"), S.phenology_file("file")
    return x.select("p_partkey", grid["zone"].alias("zone"), grid["band"].alias("band"), grid["square"].alias("square"), at["easting"].alias("easting"), at["northing"].alias("northing"), S.expected_class("crop", {"wheat": 1, "barley": 2}).alias("expected"), file["quantity"].alias("quantity"), file["year"].alias("year"), file["tile"].alias("tile"))


@query(
    """SELECT s_suppkey, (1 + s_suppkey % 5)::INT AS first_month, (2 + s_suppkey % 7)::INT AS last_month, CASE WHEN s_suppkey % 2 = 0 THEN 4 ELSE 2 END AS n_years, (2018 + s_suppkey % 3)::INT AS first_year, (3000 + s_suppkey)::INT AS epsg, CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey * 10 END AS wait,
    s_suppkey % 4 = 0 AS throttled, s_suppkey % 4 = 1 AS transient, substr(sha1(printf('%.4f_%.4f_%.4f_%.4f', s_suppkey * 1.0, s_suppkey * 2.0, s_suppkey * 3.0, s_suppkey * 4.0)), 1, 16) AS area FROM supplier"""
)
def configuration_strings(s, d):
    """S-6 to S-10: month windows, year lists, CRS names, area keys, what an error message asks for."""
    n = F.col("s_suppkey")
    years = F.when(n % 2 == 0, F.concat(2018 + n % 3, F.lit("-"), 2021 + n % 3)).otherwise(F.concat(2018 + n % 3, F.lit(", 2024")))
    message = F.when(n % 4 == 0, F.concat(F.lit("HTTP 429 Too Many Requests; Retry-After: "), n * 10)).when(n % 4 == 1, "503 Service temporarily unavailable").otherwise("404 not found")
    x = t(s, d, "supplier").select("s_suppkey", F.concat(1 + n % 5, F.lit("-"), 2 + n % 7, F.lit(",9-10")).alias("w"), years.alias("y"), F.concat(F.lit("http://www.opengis.net/def/crs/EPSG/0/"), 3000 + n).alias("crs"), message.alias("m"), *[(n * k).alias(f"b{k}") for k in (1, 2, 3, 4)])
    first = S.month_windows("w")[0]
    return x.select(
        "s_suppkey", first["first"].alias("first_month"), first["last"].alias("last_month"), F.size(S.year_list("y")).alias("n_years"), S.year_list("y")[0].alias("first_year"), S.epsg_of("crs").alias("epsg"), S.retry_after("m").alias("wait"),
        S.is_throttle("m").alias("throttled"), S.is_transient("m").alias("transient"), S.area_key("b1", "b2", "b3", "b4").alias("area"),
    )


@query(
    """SELECT s_suppkey, a AS first_day, last_day(make_date(2018, m + 2, 1)) AS last_day, a + (date_diff('day', a, last_day(make_date(2018, m + 2, 1))) // 2)::INT AS middle, (CASE i WHEN 0 THEN 2017 WHEN 4 THEN 2016 ELSE 2018 END)::INT AS slot_year, a + (s_suppkey * 3)::INT AS day
    FROM (SELECT s_suppkey, 1 + s_suppkey % 10 AS m, make_date(2018, 1 + s_suppkey % 10, 1) AS a, s_suppkey % 5 AS i FROM supplier)"""
)
def season_dates(s, d):
    """S-12, S-13, S-15, S-16: seasons as periods, their middles, slots' years, days as dates."""
    n = F.col("s_suppkey")
    x = t(s, d, "supplier").select("s_suppkey", S.season_range(F.lit(2018), 1 + n % 10, 3 + n % 10).alias("r"), (n % 5).alias("i"))
    return x.select("s_suppkey", F.col("r.start").alias("first_day"), F.col("r.end").alias("last_day"), S.midpoint("r.start", "r.end").alias("middle"), S.slot_year(F.lit(2018), "i").alias("slot_year"), S.date_of_day(F.year("r.start"), F.dayofyear("r.start") + n * 3).alias("day"))


# ---------------------------------------------------------------- filters and joins


@query("SELECT event_id FROM events WHERE coalesce(props->>'$.mode', props->>'$.k', '') IN ('', '39', '75')")
def product_filter(s, d):
    """F-9: rows of one product; a row that doesn't say passes."""
    return t(s, d, "events").where(W.absent_or(["$.mode", "$.k"], "props", ["39", "75"])).select("event_id")


@query(
    """WITH c AS (SELECT c_custkey AS k, (c_custkey * 37 % 1000) * 1.0 AS x, (c_custkey * 91 % 1000) * 1.0 AS y FROM customer), z AS (SELECT s_suppkey AS j, (s_suppkey * 53 % 1000) * 1.0 AS x, (s_suppkey * 29 % 1000) * 1.0 AS y FROM supplier)
    SELECT k AS c_custkey FROM c WHERE x BETWEEN 100 AND 900 AND EXISTS (SELECT 1 FROM z WHERE power(c.x - z.x, 2) + power(c.y - z.y, 2) <= 900)"""
)
def sea_cells(s, d):
    """F-8: cells within a distance of the coast's points, and inside the territorial box."""
    c = t(s, d, "customer").select("c_custkey", (F.col("c_custkey") * 37 % 1000).cast("double").alias("x"), (F.col("c_custkey") * 91 % 1000).cast("double").alias("y")).where("x BETWEEN 100 AND 900")
    z = t(s, d, "supplier").select((F.col("s_suppkey") * 53 % 1000).cast("double").alias("x2"), (F.col("s_suppkey") * 29 % 1000).cast("double").alias("y2"))
    return J.within_distance(c, z, ("x", "y"), ("x2", "y2"), 30.0, ["c_custkey"])


@query(
    """WITH r AS (SELECT o_custkey AS y, dayofyear(o_orderdate)::INT AS x, max_by(o_orderpriority, o_orderkey) AS cls FROM orders GROUP BY 1, 2), e AS (SELECT event_id, (user_id % 4000 - 50) AS cy, (hour(ts) * 20 + 1)::INT AS cx FROM events)
    SELECT cls, count(*) AS n, min(event_id) AS first_event FROM e JOIN r ON y = least(greatest(cy, 1), (SELECT max(o_custkey) FROM orders)) AND x = least(greatest(cx, 1), 365) GROUP BY 1"""
)
def detections_by_class(s, d):
    """J-12: the class beneath the centre of each detection, centres beyond the raster moved to its edge."""
    o = t(s, d, "orders")
    r = o.groupBy(F.col("o_custkey").alias("row"), F.dayofyear("o_orderdate").alias("col")).agg(F.max_by("o_orderpriority", "o_orderkey").alias("cls"))
    top = o.agg(F.max("o_custkey")).first()[0]
    e = t(s, d, "events").select("event_id", (F.col("user_id") % 4000 - 50).alias("cy"), (F.hour("ts") * 20 + 1).alias("cx"))
    return J.class_beneath(e, r, "cy", "cx", (1, top), (1, 365)).groupBy("cls").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query(
    """WITH m AS (SELECT s_suppkey AS k, s_nationkey * 1000 AS w, s_nationkey * 2000 AS s FROM supplier), c AS (SELECT c_custkey AS k, c_nationkey AS n, CASE WHEN c_custkey % 4 = 0 THEN 400000 + c_custkey END AS e1, CASE WHEN c_custkey % 4 = 1 THEN 500000 + c_custkey END AS e2, CASE WHEN c_custkey % 4 = 2 THEN 600000 END AS e3 FROM customer)
    SELECT c.k AS c_custkey, coalesce(e1, e2, e3 + 1280, w + 1280) - 1280 AS west, coalesce(CASE WHEN e1 IS NOT NULL THEN 6400000 + n END, CASE WHEN e2 IS NOT NULL THEN 6500000 + n END, CASE WHEN e3 IS NOT NULL THEN 6600000 + 1280 END, s + 1280) - 1280 AS south,
    CASE WHEN e1 IS NOT NULL THEN 'keys' WHEN e2 IS NOT NULL THEN 'name' WHEN e3 IS NOT NULL THEN 'box' WHEN w IS NOT NULL THEN 'manifest' END AS source FROM c LEFT JOIN m ON m.k = c.k"""
)
def box_chain(s, d):
    """J-20: a tile's box by its keys, else its name, its stored box, the manifest."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    none = F.lit(None).cast("long")
    c = t(s, d, "customer").select(
        k, F.when(k % 4 == 0, 400000 + k).otherwise(none).alias("easting"), F.when(k % 4 == 0, 6400000 + n).otherwise(none).alias("northing"), F.when(k % 4 == 1, F.concat(F.lit("tile_"), 500000 + k, F.lit("_"), 6500000 + n)).otherwise(k.cast("string")).alias("name"),
        F.when(k % 4 == 2, F.array(F.lit(600000), F.lit(6600000), F.lit(602560), F.lit(6602560))).alias("box"),
    )
    m = t(s, d, "supplier").select(F.col("s_suppkey").cast("string").alias("name"), F.array(F.col("s_nationkey") * 1000, F.col("s_nationkey") * 2000, F.col("s_nationkey") * 1000 + 2560, F.col("s_nationkey") * 2000 + 2560).alias("known"))
    x = J.resolve_boxes(c, m, 256)
    return x.select("c_custkey", F.col("resolved.west").cast("long").alias("west"), F.col("resolved.south").cast("long").alias("south"), "source")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size ELSE n END AS label, CASE WHEN p_size % 2 = 0 THEN 'kept' WHEN n IS NOT NULL THEN 'copied' ELSE 'missing' END AS how FROM part LEFT JOIN (SELECT l_partkey, nullif(count(*) FILTER (WHERE l_quantity > 45), 0) AS n FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_quantity > 45) > 0) ON l_partkey = p_partkey")
def copied_labels(s, d):
    """J-21: labels copied forward to tiles that have none."""
    a = t(s, d, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_size")).cast("long").alias("label"))
    b = t(s, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count_if(F.col("l_quantity") > 45).alias("label")).where("label > 0")
    return J.copy_forward(a, b, "p_partkey", "label")


@query(
    """WITH o AS (SELECT o_orderkey, o_totalprice, round(abs(sin(o_orderkey)), 6) AS cot FROM orders), c AS (SELECT * FROM o ORDER BY o_totalprice, o_orderkey LIMIT 30) SELECT o_orderkey, cot, row_number() OVER (ORDER BY cot, o_orderkey) AS rank FROM c"""
)
def rescored_candidates(s, d):
    """T-6: the best candidates by one measure, put in order by a better one."""
    o = t(s, d, "orders").select("o_orderkey", "o_totalprice")
    return W.rescore(o, ["o_totalprice", "o_orderkey"], 30, r6(F.abs(F.sin("o_orderkey")), "cot"), ["cot", "o_orderkey"])


# ---------------------------------------------------------------- measures


@query(
    """WITH p AS (SELECT l_linenumber AS cls, (round(l_discount * 100) + l_suppkey % 7)::INT AS score, l_quantity > 25 + l_linenumber AS pos FROM lineitem),
    h AS (SELECT cls, score, count(*) FILTER (WHERE pos) AS a, count(*) FILTER (WHERE NOT pos) AS b FROM p GROUP BY 1, 2), c AS (SELECT *, sum(b) OVER (PARTITION BY cls ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below FROM h)
    SELECT cls, round(sum(a * (coalesce(below, 0) + b / 2.0)) / (sum(a) * sum(b)), 6) AS auroc, sum(a + b)::BIGINT AS plots FROM c GROUP BY 1"""
)
def plot_scores(s, d):
    """A-23: AUROC of each class over plots, by counts of its distinct scores."""
    p = t(s, d, "lineitem").select(F.col("l_linenumber").alias("cls"), (F.round(F.col("l_discount") * 100) + F.col("l_suppkey") % 7).cast("int").alias("score"), (F.col("l_quantity") > 25 + F.col("l_linenumber")).alias("pos"))
    return M.auroc_by_class(p, "cls", "score", F.col("pos")).withColumn("auroc", F.round("auroc", 6))


@query(
    """WITH a AS (SELECT l_orderkey, avg(CASE WHEN l_linenumber = (l_quantity::BIGINT % 7 + 1) THEN 1.0 ELSE 0 END) AS acc FROM lineitem GROUP BY 1)
    SELECT round(quantile_cont(acc, 0.1), 6) AS p10, round(quantile_cont(acc, 0.5), 6) AS p50, round(quantile_cont(acc, 0.9), 6) AS p90, count(*) AS tiles FROM a"""
)
def accuracy_by_tile(s, d):
    """A-19: percentiles of the tiles' accuracies."""
    a = t(s, d, "lineitem").groupBy("l_orderkey").agg(F.avg((F.col("l_linenumber") == F.col("l_quantity").cast("long") % 7 + 1).cast("double")).alias("acc"))
    x = A.exact_percentiles(a, "acc", [0.1, 0.5, 0.9])
    return x.select(r6(F.col("p")[0], "p10"), r6(F.col("p")[1], "p50"), r6(F.col("p")[2], "p90"), F.col("n").alias("tiles"))


@query("SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean, max_by(o_orderkey, o_totalprice * 100000000 - o_orderkey) AS best FROM orders GROUP BY 1")
def results_by_phase(s, d):
    """A-51."""
    return C.by_phase(t(s, d, "orders"), "o_orderstatus", "o_orderkey", "o_totalprice").withColumn("mean", F.round("mean", 4))


@query(
    """WITH d AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) SELECT o_custkey, sum(n)::BIGINT AS n, count(*) AS cohorts, string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) AS held, count(*) > 1 AS several FROM d GROUP BY 1"""
)
def ledger_groups(s, d):
    """A-32, A-37, A-40: counts by customer, what each holds, and which hold several."""
    return A.ledger_groups(t(s, d, "orders"), "o_custkey", "o_orderpriority")


@query(
    """WITH e AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r, sum(CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS f FROM events), x AS (SELECT event_type, count(*) AS submitted, count(*) FILTER (WHERE user_id % 4 <> 0) AS completed, (epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9 AS h FROM e GROUP BY 1)
    SELECT event_type, submitted, completed, string_agg(event_id, ',' ORDER BY f) FILTER (WHERE user_id % 4 = 0 AND f <= 5) AS last_failures, round(max(completed / h), 6) AS per_hour, round(max((1000000 - completed) / (completed / h)), 4) AS eta_hours FROM x JOIN e USING (event_type) GROUP BY 1, 2, 3"""
)
def job_report(s, d):
    """A-35: submitted and completed jobs, the last five failures, rate and time to go."""
    x = C.job_report(t(s, d, "events"), "event_type", "ts", "event_id", F.col("user_id") % 4 != 0, 1_000_000)
    return x.withColumns({"per_hour": F.round("per_hour", 6), "eta_hours": F.round("eta_hours", 4)})


# ---------------------------------------------------------------- control


@query(
    """WITH e AS (SELECT event_id // 3 AS job, CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'error' WHEN 'click' THEN 'start' ELSE 'submit' END AS k, ts, event_id FROM events), f AS (SELECT job, min((ts, event_id)) FILTER (WHERE k = 'start') AS s, count(*) AS n FROM e GROUP BY 1),
    z AS (SELECT job, k FROM e JOIN f USING (job) WHERE k IN ('done', 'error') AND (ts, event_id) > s QUALIFY row_number() OVER (PARTITION BY job ORDER BY ts, event_id) = 1)
    SELECT job, CASE k WHEN 'done' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE CASE WHEN s IS NULL THEN 'QUEUED' ELSE 'RUNNING' END END AS state, n AS events FROM f LEFT JOIN z USING (job)"""
)
def job_states(s, d):
    """ST-12: the state of each job."""
    k = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "error").when(F.col("event_type") == "click", "start").otherwise("submit")
    return C.job_states(t(s, d, "events").withColumns({"k": k, "job": F.floor(F.col("event_id") / 3)}), "job", ["ts", "event_id"], "k")


@query(
    """WITH a AS (SELECT user_id, max(ts) FILTER (WHERE event_type = 'click') AS c, max(ts) FILTER (WHERE event_type = 'purchase') AS r FROM events GROUP BY 1)
    SELECT user_id, c AS claimed, CASE WHEN c < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 6 HOURS THEN 'stale' ELSE 'held' END AS state FROM a WHERE c IS NOT NULL AND (r IS NULL OR r < c)"""
)
def open_claims(s, d):
    """ST-6: claims that are held, and those to sweep."""
    e = t(s, d, "events").withColumn("k", F.when(F.col("event_type") == "click", "claim").when(F.col("event_type") == "purchase", "release"))
    return C.open_claims(e, "user_id", "ts", "k", F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))


@query("SELECT l_linenumber, least(30.0, 1.5 * power(2, l_linenumber - 1)) AS delay, count(*) AS n, true AS bounded FROM lineitem GROUP BY 1")
def retry_delays(s, d):
    """ST-7: delays doubled up to a limit; with jitter at most a quarter more, the same for the same keys."""
    x = t(s, d, "lineitem").select("l_linenumber", C.backoff("l_linenumber", 1.5, 30).alias("delay"), C.retry_delays("l_linenumber", 1.5, 30, "l_orderkey").alias("jittered"))
    return x.groupBy("l_linenumber", "delay").agg(F.count("*").alias("n"), F.bool_and(F.col("jittered").between(F.col("delay"), F.col("delay") * 1.25)).alias("bounded"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')")
def work_left(s, d):
    """ST-10: what the skip index of this audit doesn't list."""
    index = t(s, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("audit"))
    return C.not_yet_done(t(s, d, "orders").select("o_orderkey"), index, ["o_orderkey"], "A")


@query("SELECT l_orderkey, count(*) AS parts FROM lineitem GROUP BY 1 HAVING count(*) = max(l_linenumber) AND bool_and(l_discount < 0.095)")
def complete_results(s, d):
    """ST-8: only what is complete is kept."""
    return C.complete_only(t(s, d, "lineitem"), ["l_orderkey"], F.col("l_discount") < 0.095, F.col("l_linenumber"))


@query(
    """WITH e AS (SELECT user_id, event_type IN ('error', 'view') AS f, sum(CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS good FROM events), a AS (SELECT user_id, count(*) FILTER (WHERE f AND good = 0) AS failures FROM e GROUP BY 1)
    SELECT user_id, failures, CASE WHEN failures >= 3 THEN 'dead' ELSE 'alive' END AS state FROM a"""
)
def dead_sources(s, d):
    """ST-13: sources whose last events all failed."""
    return C.circuit(t(s, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type").isin("error", "view"), 3)


# ---------------------------------------------------------------- pixels

@query(
    f"""WITH RECURSIVE {_RASTER}, p AS (SELECT tile, row, col, v, row_number() OVER (ORDER BY tile, row, col) AS id FROM px), b AS (SELECT a.id AS u, a.v AS uv, c.id AS w, c.v AS wv FROM p a JOIN p c ON a.tile = c.tile AND abs(a.row - c.row) + abs(a.col - c.col) = 1),
    r AS (SELECT id AS u, id AS l FROM p UNION SELECT b.w, r.l FROM r JOIN b ON r.u = b.u AND b.uv = b.wv), g AS (SELECT u, min(l) AS region FROM r GROUP BY 1), n AS (SELECT region, count(*) AS n FROM g GROUP BY 1),
    e AS (SELECT DISTINCT g.region, b.w, b.wv FROM b JOIN g ON b.u = g.u JOIN n USING (region) WHERE n.n < 3 AND b.uv <> b.wv AND b.uv <> 0), k AS (SELECT region, wv, count(*) AS n FROM e GROUP BY 1, 2), new AS (SELECT region, max_by(wv, n * 10 - wv) AS v FROM k GROUP BY 1)
    SELECT tile, row, col, coalesce(new.v, p.v)::INT AS v FROM p JOIN g ON g.u = p.id LEFT JOIN new USING (region)"""
)
def small_regions(s, d):
    """K-11: small regions take the class around them."""
    return U.small_regions_cleaned(raster(s, d), "v", 3).withColumn("v", F.col("v").cast("int"))


@query(
    f"""WITH {_RASTER}, w AS (SELECT tile, row, col, v, y0, x0 FROM px, range(0, 100000, 4) a(y0), range(0, 49, 4) b(x0) WHERE row BETWEEN y0 AND y0 + 7 AND col BETWEEN x0 AND x0 + 7 AND y0 <= (SELECT max(row) FROM px))
    SELECT tile, row, col, count(*) AS windows, round(avg(v + (y0 % 3) / 10.0 + (x0 % 5) / 100.0), 6) AS mean FROM w GROUP BY 1, 2, 3"""
)
def window_predictions(s, d):
    """A-46, A-53: what overlapping windows predict for a pixel, averaged."""
    p = raster(s, d)
    height = p.agg(F.max("row")).first()[0] + 8
    w = U.overlap_windows(p, 8, 0.5, height, 53).withColumn("p", F.col("v") + (F.col("y0") % 3) / 10 + (F.col("x0") % 5) / 100)
    return w.groupBy("tile", "row", "col").agg(F.count("*").alias("windows"), r6(F.avg("p"), "mean"))


@query(f"WITH {_RASTER} SELECT tile, row, col - 11 AS col, v FROM px WHERE col BETWEEN 11 AND 41")
def cropped(s, d):
    """S-25: the middle of a tile."""
    p = raster(s, d)
    rows = p.agg(F.max("row")).first()[0] + 1
    return U.centre_crop(p, rows, 53, rows, 31)


_ON = f"{_RASTER}, m AS (SELECT tile, row, col, (v > 0)::INT AS m FROM px)"


def _morph(name: str, src: str, kind: str) -> str:
    inside = f"SELECT a.tile, a.row, a.col, CASE WHEN a.m = 1 AND count(b.m) = 4 AND min(b.m) = 1 THEN 1 ELSE 0 END AS m FROM {src} a LEFT JOIN {src} b ON a.tile = b.tile AND abs(a.row - b.row) + abs(a.col - b.col) = 1 GROUP BY a.tile, a.row, a.col, a.m"
    around = f"SELECT a.tile, a.row, a.col, greatest(a.m, coalesce(max(b.m), 0)) AS m FROM {src} a LEFT JOIN {src} b ON a.tile = b.tile AND abs(a.row - b.row) + abs(a.col - b.col) = 1 GROUP BY a.tile, a.row, a.col, a.m"
    return f"{name} AS MATERIALIZED ({inside if kind == 'erode' else around})"


@query(f"WITH {_ON}, {_morph('e', 'm', 'erode')}, {_morph('o', 'e', 'dilate')}, {_morph('c', 'o', 'dilate')}, {_morph('z', 'c', 'erode')} SELECT tile, row, col, m FROM z")
def opened_closed(s, d):
    """K-9: opening, then closing."""
    p = raster(s, d).select("tile", "row", "col", (F.col("v") > 0).cast("int").alias("m"))
    return R.open_close(p, "m")


@query(
    f"""WITH {_RASTER}, h AS (SELECT max(row) + 1 AS n, (max(row) + 1) * 13 // 20 + 1 AS m FROM px), r AS (SELECT i::BIGINT AS i, floor((i + 0.5) * n / m)::BIGINT AS s FROM h, range(0, (SELECT m FROM h)) x(i)),
    c AS (SELECT j::BIGINT AS j, floor((j + 0.5) * 53 / 30)::BIGINT AS s FROM range(0, 30) x(j)) SELECT p.tile, r.i AS row, c.j AS col, v FROM px p JOIN r ON p.row = r.s JOIN c ON p.col = c.s"""
)
def resampled(s, d):
    """K-7: the nearest pixel on a grid of another size, for rasters of any height."""
    p = raster(s, d)
    rows = p.agg(F.max("row") + 1).first()[0] or 1
    return R.resampled(p, rows, 53, rows * 13 // 20 + 1, 30, "v").select("tile", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "v")


@query(
    f"""WITH {_RASTER}, l AS (SELECT n_nationkey::VARCHAR AS tile, k * 13.0 AS a, n_nationkey + k * k * 1.0 AS u FROM nation, range(0, 5) r(k)), s AS (SELECT *, lead(a) OVER w AS b, lead(u) OVER w AS u2 FROM l WINDOW w AS (PARTITION BY tile ORDER BY a))
    SELECT px.tile, row, col, round(CASE WHEN b IS NULL THEN u ELSE u + (col - a) / (b - a) * (u2 - u) END, 6) AS gain FROM px JOIN s ON s.tile = px.tile AND col >= a AND (b IS NULL OR col < b)"""
)
def calibrated(s, d):
    """K-18: a calibration table interpolated at every pixel."""
    k = F.explode(F.sequence(F.lit(0), F.lit(4)))
    lut = t(s, d, "nation").select(F.col("n_nationkey").cast("string").alias("tile"), "n_nationkey", k.alias("k")).select("tile", (F.col("k") * 13.0).alias("at"), (F.col("n_nationkey") + F.col("k") * F.col("k") * 1.0).alias("gain"))
    return U.interpolated(raster(s, d), lut, ["tile"], "col", "at", "gain").select("tile", "row", "col", r6(F.col("gain"), "gain"))


@query("SELECT c_custkey, floor(c_acctbal / 10) * 10 AS west, floor(c_nationkey * 33.3 / 10) * 10 AS south, ceil((c_acctbal + 95.5) / 10) * 10 AS east, ceil((c_nationkey * 33.3 + 95.5) / 10) * 10 AS north FROM customer")
def snapped_boxes(s, d):
    """K-6, S-21: boxes widened to the lattice of the target grid."""
    y = F.col("c_nationkey") * 33.3
    x = t(s, d, "customer").select("c_custkey", S.snap_out("c_acctbal", y, F.col("c_acctbal") + 95.5, y + 95.5).alias("b"))
    return x.select("c_custkey", *[F.col(f"b.{c}").cast("double").alias(c) for c in ("west", "south", "east", "north")])


@query("SELECT p_partkey, (300000 + p_partkey * 10)::DOUBLE AS x0, (6500000 - p_size * 10)::DOUBLE AS y0, (300000 + (p_partkey + 5) * 10)::DOUBLE AS x1, (6500000 - (p_size + 3) * 10)::DOUBLE AS y1 FROM part")
def pixel_boxes(s, d):
    """S-28: boxes in pixels as boxes on the map."""
    x = t(s, d, "part").select("p_partkey", S.map_box("p_partkey", "p_size", F.col("p_partkey") + 5, F.col("p_size") + 3, 300000.0, 6500000.0).alias("b"))
    return x.select("p_partkey", F.col("b.west").alias("x0"), F.col("b.north").alias("y0"), F.col("b.east").alias("x1"), F.col("b.south").alias("y1"))


# ---------------------------------------------------------------- files: written to a new folder, read back


def _folder(s, name: str) -> str:
    return f"{I.shared_folder(s)}/{name}-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def ledger_round_trip(s, d):
    """IO-7: a ledger of JSON lines."""
    path = _folder(s, "ledger")
    t(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).write.json(path)
    return s.read.schema("o_orderkey bigint, o_orderstatus string, o_totalprice double, day string").json(path)


@query("SELECT l_shipdate::DATE AS day, l_linenumber AS band, count(*) AS n, round(sum(l_quantity), 2) AS total FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY 1, 2")
def band_cache(s, d):
    """IO-2, IO-13: values kept by year, of which a reader opens the years it asks for; writing again replaces a year."""
    path = _folder(s, "bands")
    li = t(s, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    committed.replace_parts(li, path, "year")
    committed.replace_parts(li.where("year = 1997"), path, "year")
    return committed.read_parts(s, path, lambda year: int(year) >= 1997).groupBy(F.to_date("l_shipdate").alias("day"), F.col("l_linenumber").alias("band")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("total"))


@query("SELECT c_custkey FROM (SELECT c_custkey, (c_custkey * 37 % 1000) * 1000.0 AS w, (c_custkey * 91 % 1000) * 1000.0 AS s FROM customer) WHERE w <= 400000 AND w + 5000 >= 200000 AND s <= 700000 AND s + 5000 >= 300000")
def footprints(s, d):
    """IO-3, IO-4, IO-26: footprints clustered by place, of which those that meet a box are read."""
    path, k = _folder(s, "footprints"), F.col("c_custkey")
    w, y = (k * 37 % 1000) * 1000.0, (k * 91 % 1000) * 1000.0
    T.write_clustered(t(s, d, "customer").select("c_custkey", *[v.alias(c) for v, c in zip((w, y, w + 5000, y + 5000), T.BOX, strict=True)]), path)
    return T.read_box(s, path, 200_000, 300_000, 400_000, 700_000).select("c_custkey")


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def summary_files(s, d):
    """IO-11: a summary as JSON, read back."""
    path = _folder(s, "summary")
    t(s, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), r6(F.avg("value"), "mean")).coalesce(1).write.json(path)
    return s.read.schema("event_type string, n bigint, mean double").json(path)


@query(
    "SELECT CASE WHEN o_orderkey % 10 < 8 THEN 'train' ELSE 'val' END AS split, o_orderkey FROM orders"
)
def split_files(s, d):
    """IO-25: names of each split in files of their own."""
    path = _folder(s, "splits")
    o = t(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 < 8, "train").otherwise("val").alias("split"))
    T.write_splits(o, "split", "o_orderkey", path)
    return s.read.schema("name string").text(path).select("split", F.col("name").cast("long").alias("o_orderkey"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def stream_running(s, d):
    """ST-1, ST-5, ST-9: a file stream over all there is now, with its running statistics kept by an upsert; not one row is counted twice."""
    root = _folder(s, "stream")
    t(s, d, "events").select("event_id", "event_type", "value").repartition(4).write.parquet(f"{root}/in")
    stream = ST.file_stream(s, f"{root}/in", "event_id bigint, event_type string, value double", 1)
    q = stream.writeStream.foreachBatch(committed.upsert_into(f"{root}/table", ["event_id"], F.col("value"))).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return ST.running_stats(committed.read_parts(s, f"{root}/table"), ["event_type"], "value").select("event_type", "n", F.round("total", 4).alias("total"))


# ---------------------------------------------------------------- plug-ins


@query(
    """SELECT 'brightness' AS analyzer, true AS success, false AS skipped, (SELECT count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem)) AS n UNION ALL SELECT 'change', true, false, (SELECT count(*) FROM (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING avg(l_discount) > 0.05)) UNION ALL SELECT 'vegetation', true, true, NULL UNION ALL SELECT 'water', false, false, NULL"""
)
def analyzers(s, d):
    """UD-1, UD-2, UD-3: registered analyzers run by a configuration: one depends on an earlier one's result, one is off, one fails by itself."""
    from skyquilt.plans.registry import ANALYZERS

    li = t(s, d, "lineitem").select("l_suppkey", F.col("l_discount").alias("value"), (1 - F.col("l_tax")).alias("nir"), F.col("l_tax").alias("red"))
    results = ANALYZERS.run(li, {"brightness": {"key": "l_suppkey"}, "change": {"above": 0.05}, "vegetation": {"enabled": False}, "water": {"band": "missing"}})
    rows = [s.range(1).select(F.lit(r.analyzer).alias("analyzer"), F.lit(r.success).alias("success"), F.lit(r.skipped).alias("skipped"), F.lit(None).cast("long").alias("n")) if r.output is None else r.output.agg(F.count("*").alias("n")).select(F.lit(r.analyzer).alias("analyzer"), F.lit(r.success).alias("success"), F.lit(r.skipped).alias("skipped"), "n") for r in results]
    out = rows[0]
    for x in rows[1:]:
        out = out.unionByName(x)
    return out

