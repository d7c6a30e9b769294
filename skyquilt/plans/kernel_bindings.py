"""Pixel kernels, choices of dates, classes and further files, bound to the test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyquilt.functions import scalars as S
from skyquilt.functions import spectral as P
from skyquilt.operators import aggregates as A
from skyquilt.operators import iterative as I
from skyquilt.operators import rasters as R
from skyquilt.operators import sampling as SP
from skyquilt.operators import selection as W
from skyquilt.plans.bindings import _PIXELS, _RASTER, _pixels, query, r6, raster, t
from skyquilt.sources import tables as T
from skyquilt.streaming import streams as ST


@query(
    f"""WITH {_RASTER} SELECT a.tile, a.row, a.col, round(sum(b.v * exp(-(power(a.row - b.row, 2) + power(a.col - b.col, 2)) / 2.0)) / sum(exp(-(power(a.row - b.row, 2) + power(a.col - b.col, 2)) / 2.0)), 6) AS v
    FROM px a JOIN px b ON a.tile = b.tile AND abs(a.row - b.row) <= 2 AND abs(a.col - b.col) <= 2 GROUP BY 1, 2, 3"""
)
def smoothed_raster(s, d):
    """K-19, A-44: Gaussian means over neighbours."""
    return R.smoothed(raster(s, d), "v", 1.0, 2).select("tile", "row", "col", r6(F.col("v"), "v"))


@query(
    f"""WITH {_RASTER} SELECT a.tile, a.row, a.col, round((a.v - avg(b.v)) / nullif(avg(b.v), 0), 6) + 0.0 AS contrast FROM px a LEFT JOIN px b ON a.tile = b.tile AND abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 AND (a.row <> b.row OR a.col <> b.col) GROUP BY a.tile, a.row, a.col, a.v"""
)
def contrast(s, d):
    """K-20: what stands out of its surroundings."""
    return R.local_contrast(raster(s, d), "v", 1).select("tile", "row", "col", r6(F.col("contrast"), "contrast"))


@query(
    """WITH y AS (SELECT DISTINCT p_partkey, greatest(0, least(i, 10 + p_size - 16))::INT AS y FROM part, range(0, 200, 12) r(i) WHERE i <= 9 + p_size), x AS (SELECT DISTINCT p_partkey, greatest(0, least(i, 30 - 16))::INT AS x FROM part, range(0, 30, 12) r(i)) SELECT p_partkey, y, x FROM y JOIN x USING (p_partkey)"""
)
def chip_grid(s, d):
    """K-20: overlapping chips that cover an image."""
    return t(s, d, "part").select("p_partkey", F.explode(R.chips(F.lit(30), 10 + F.col("p_size"), 16, 0.25)).alias("c")).select("p_partkey", "c.y", "c.x")


@query(
    """WITH x AS (SELECT l_suppkey AS seg, l_linenumber AS cls, l_discount * 10 AS p FROM lineitem), a AS (SELECT seg, cls, round(sum(p * p) / nullif(sum(p), 0), 9) AS w, count(*) FILTER (WHERE p >= 0.5) AS m FROM x GROUP BY 1, 2)
    SELECT seg, (SELECT cls FROM a b WHERE b.seg = a.seg ORDER BY m DESC, cls LIMIT 1) AS majority FROM a GROUP BY seg"""
)
def segment_majority(s, d):
    """A-45: the class with most confident pixels in a segment, the lowest of equals."""
    x = t(s, d, "lineitem").select(F.col("l_suppkey").alias("seg"), F.col("l_linenumber").alias("cls"), (F.col("l_discount") * 10).alias("p"))
    return A.segment_vote(x, "seg", "cls", "p", "majority_vote").withColumnRenamed("cls", "majority")


@query("SELECT l_returnflag, CASE WHEN l_discount * 10 >= 0.7 THEN 'dense' WHEN l_discount * 10 >= 0.25 THEN 'sparse' ELSE 'bare' END AS kind, count(*) AS n FROM lineitem GROUP BY 1, 2")
def vegetation_classes(s, d):
    """P-17: three classes by thresholds."""
    return t(s, d, "lineitem").select("l_returnflag", P.vegetation_class(F.col("l_discount") * 10, 0.25, 0.7).alias("kind")).groupBy("l_returnflag", "kind").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN p_size IN (1, 2, 3, 4, 5) THEN p_partkey % 9 ELSE 0 END AS harvest, CASE WHEN p_size IN (10, 20, 30) THEN p_partkey % 7 ELSE 0 END AS crop FROM part")
def gated_labels(s, d):
    """F-15: harvest only in forest, crops only on farmland."""
    k = F.col("p_partkey")
    return t(s, d, "part").select("p_partkey", P.gated(k % 9, "p_size", [1, 2, 3, 4, 5]).alias("harvest"), P.gated(k % 7, "p_size", [10, 20, 30]).alias("crop"))


@query(
    f"""WITH RECURSIVE {_PIXELS}, on_ AS (SELECT tile, row, col, row_number() OVER (ORDER BY tile, row, col) AS id FROM px WHERE mask = 1), n AS (SELECT a.id AS u, b.id AS v FROM on_ a JOIN on_ b ON a.tile = b.tile AND abs(a.row - b.row) + abs(a.col - b.col) = 1),
    r AS (SELECT id AS u, id AS l FROM on_ UNION SELECT n.v, r.l FROM r JOIN n ON r.u = n.u), c AS (SELECT u, min(l) AS l FROM r GROUP BY 1), g AS (SELECT tile, l, count(*) AS n FROM c JOIN on_ ON u = id GROUP BY 1, 2)
    SELECT tile, count(*) AS regions, round(sum(n)::DOUBLE * 0.01, 6) AS hectares, round(max(n)::DOUBLE * 0.01, 6) AS largest FROM g GROUP BY 1"""
)
def region_hectares(s, d):
    """A-55: areas of connected regions."""
    g = I.pixel_components(_pixels(s, d).where("mask = 1"), "tile", "row", "col")
    return g.groupBy("tile").agg(F.count("*").alias("regions"), F.round(F.sum("pixels") * 0.01, 6).alias("hectares"), F.round(F.max("pixels") * 0.01, 6).alias("largest"))


@query("SELECT CASE WHEN year(o_orderdate) >= 1999 THEN 'rtk' ELSE 'gps' END AS tier, count(*) AS plots, count(DISTINCT o_custkey) AS tiles FROM orders GROUP BY 1")
def coverage_tiers(s, d):
    """A-41: plots before and after positions became exact."""
    tier = F.when(F.year("o_orderdate") >= 1999, "rtk").otherwise("gps")
    return t(s, d, "orders").groupBy(tier.alias("tier")).agg(F.count("*").alias("plots"), F.count_distinct("o_custkey").alias("tiles"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'test' WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'val' ELSE 'train' END AS split FROM customer")
def geographic_splits(s, d):
    """SP-5: splits by place."""
    return t(s, d, "customer").select("c_custkey", SP.geographic_split("c_mktsegment", ["BUILDING"], ["MACHINERY", "FURNITURE"]).alias("split"))


@query(
    """WITH w AS (SELECT o_custkey, o_orderdate::DATE AS day FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1997-08-15' AND DATE '1997-10-31' AND o_totalprice / 1000000 <= 0.4)
    SELECT o_custkey, day FROM w QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY abs(date_diff('day', DATE '1997-09-22', day)), day) = 1"""
)
def autumn_dates(s, d):
    """T-4: slot 0, the autumn before."""
    o = t(s, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), (F.col("o_totalprice") / 1000000).alias("cloud"))
    return W.prior_autumn(o, "o_custkey", "day", F.lit(1998), "cloud")


@query(
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 1 END, abs(dayofyear(o_orderdate) - 195), o_orderkey) AS r FROM orders) WHERE r = 1"""
)
def pinned_dates(s, d):
    """T-10: a pinned date wins, else the best."""
    o = t(s, d, "orders")
    return W.pinned_or_best(o, ["o_custkey"], F.col("o_orderkey") % 11 == 0, [F.abs(F.dayofyear("o_orderdate") - 195), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT l_suppkey, l_linenumber AS anchor FROM (SELECT l_suppkey, l_linenumber, count(*) AS n, max(l_extendedprice) AS sharp FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, sharp DESC, l_linenumber) = 1")
def clearest_anchor(s, d):
    """T-12: the frame with most data, the sharpest of equals."""
    f = t(s, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("n"), F.max("l_extendedprice").alias("sharp"))
    return W.clearest(f, ["l_suppkey"], "l_linenumber", "n", "sharp").withColumnRenamed("l_linenumber", "anchor")


@query(
    """WITH w AS (SELECT round_even(s_acctbal / 250, 0) * 250 AS cell, round(avg(s_nationkey), 6) AS rain FROM supplier GROUP BY 1) SELECT c_custkey, rain FROM customer JOIN w ON round_even(c_acctbal / 250, 0) * 250 = cell"""
)
def weather_of_tiles(s, d):
    """J-18: tiles meet the weather of their cell."""
    w = t(s, d, "supplier").groupBy(S.weather_cell("s_acctbal", 250).alias("cell")).agg(r6(F.avg("s_nationkey"), "rain"))
    return t(s, d, "customer").withColumn("cell", S.weather_cell("c_acctbal", 250)).join(w, "cell").select("c_custkey", "rain")


@query(
    """WITH b AS (SELECT s_suppkey AS rank, (s_suppkey * 13 % 180) * 10.0 + 3 + 2000 * (s_suppkey // 100) AS w, (s_suppkey * 29 % 180) * 10.0 + 3 AS s FROM supplier),
    px AS (SELECT rank, w, s, unnest(range((w // 10)::BIGINT, (w // 10)::BIGINT + 17)) AS x, y FROM b, range(0, 200) r(y) WHERE y * 10 + 5 > s AND y * 10 + 5 < s + 100)
    SELECT (y // 100) || '_' || (x // 100) AS tile, (99 - y % 100)::INT AS row, (x % 100)::INT AS col, max_by(rank % 5 + 1, rank)::INT AS value FROM px WHERE x * 10 + 5 > w AND x * 10 + 5 < w + 150 GROUP BY 1, 2, 3"""
)
def rasterised(s, d):
    """K-8: polygons drawn into tiles, the last one on top; the row of tiles is as long as the polygons need."""
    k = F.col("s_suppkey")
    w, y = (k * 13 % 180) * 10.0 + 3 + 2000 * F.floor(k / 100), (k * 29 % 180) * 10.0 + 3
    b = t(s, d, "supplier").select(k.alias("rank"), (k % 5 + 1).alias("value"), w.alias("west"), y.alias("south"), (w + 150).alias("east"), (y + 100).alias("north"))
    ring = F.array(*[F.array(F.col(a), F.col(c)) for a, c in (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))])
    wide = int((b.agg(F.max("east")).first()[0] or 0) // 1000) + 1
    i = s.range(2 * wide).select((F.col("id") % wide).alias("x"), F.floor(F.col("id") / wide).alias("y"))
    tiles = i.select(F.concat_ws("_", "y", "x").alias("tile"), (F.col("x") * 1000.0).alias("west"), (F.col("y") * 1000.0).alias("south"), (F.col("x") * 1000.0 + 1000).alias("east"), (F.col("y") * 1000.0 + 1000).alias("north"))
    return R.rasterize_tiles(tiles, b.withColumn("ring", ring), 100)


@query("SELECT time_bucket(INTERVAL 15 MINUTES, ts + to_minutes(15 * k::INT), TIMESTAMP '1970-01-01') - INTERVAL 45 MINUTES AS start, event_type, count(*) AS n FROM events, range(0, 4) r(k) GROUP BY 1, 2")
def hourly_rates(s, d):
    """ST-9, ST-3: requests in every hour, a quarter of an hour apart."""
    e = t(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ST.window_counts(e, "ts", "1 hour", "15 minutes", ["event_type"], "value").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


# ---------------------------------------------------------------- files


def _folder(s, name: str) -> str:
    return f"{I.shared_folder(s)}/{name}-{uuid.uuid4().hex}"


@query("SELECT c_name AS name, c_acctbal AS west, (c_nationkey * 2)::DOUBLE AS south, c_acctbal + 10 AS east, (c_nationkey * 2 + 5)::DOUBLE AS north FROM customer")
def feature_round_trip(s, d):
    """IO-8, IO-10: boxes as GeoJSON features, and back."""
    path = _folder(s, "features")
    x = t(s, d, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("west"), (F.col("c_nationkey") * 2.0).alias("south"), (F.col("c_acctbal") + 10).alias("east"), (F.col("c_nationkey") * 2.0 + 5).alias("north"))
    T.write_features(x, ("west", "south", "east", "north"), ["name"], path)
    return T.feature_boxes(s, path, ["name"])


@query(
    """WITH r AS (SELECT (p_partkey // 2)::VARCHAR AS point_id, p_retailprice AS lat, p_size::DOUBLE AS lon, p_brand AS code, (2015 + p_partkey % 8)::INT AS year, CASE WHEN p_size % 4 = 0 THEN 'DE' ELSE 'SE' END AS country FROM part)
    SELECT point_id, lat, lon, code, year FROM r WHERE country = 'SE' AND year >= 2016 AND (code LIKE 'Brand#1%' OR code LIKE 'Brand#2%' OR code LIKE 'Brand#3%') QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY year DESC, code) = 1"""
)
def survey_round_trip(s, d):
    """IO-6, W-6: a survey from CSV files of two headers and date formats: the crops asked for, the latest year of each point."""
    path, k = _folder(s, "survey"), F.col("p_partkey")
    year = 2015 + k % 8
    columns = {"POINT_ID": F.floor(k / 2), "lat": F.col("p_retailprice"), "lon": F.col("p_size"), "crop": F.col("p_brand"), "year": F.when(k % 2 == 0, F.concat(F.lit("15/06/"), year)).otherwise(year.cast("string")), "NUTS0": F.when(F.col("p_size") % 4 == 0, "DE").otherwise("SE")}
    headers = [{"lat": "GPS_LAT", "lon": "GPS_LONG", "crop": "LC1", "year": "SURVEY_YEAR"}, {"lat": "TH_LAT", "lon": "TH_LONG", "crop": "lc1", "year": "Year"}]
    p = t(s, d, "part")
    for n, header in enumerate(headers):
        p.where(F.pmod(F.floor(k / 3), F.lit(2)) == n).select(*[c.alias(header.get(name, name)) for name, c in columns.items()]).write.option("header", True).csv(f"{path}/{n}")
    names = {"point_id": ["point_id"], "lat": ["th_lat", "gps_lat"], "lon": ["th_long", "gps_long"], "code": ["lc1"], "country": ["nuts0"], "year": ["survey_year", "year"]}
    return T.survey_points(s, [f"{path}/0", f"{path}/1"], names, "SE", 2016, ["Brand#1", "Brand#2", "Brand#3"]).select("point_id", "lat", "lon", "code", "year")


_SET = """WITH f AS (SELECT s_name || chr(10) AS c FROM supplier), h AS (SELECT sha256(c) AS h, strlen(c) AS n FROM f), p AS (SELECT substr(h, 1, 3) AS p, count(*) AS n, sum(n) AS b, sha256(string_agg(h, chr(10) ORDER BY h)) AS d FROM h GROUP BY 1),
    m AS (SELECT sum(n)::BIGINT AS files, sum(b)::BIGINT AS bytes, sha256(string_agg(p || d, chr(10) ORDER BY p || d)) AS set_sha256 FROM p)"""


def _inputs(s, d):
    path = _folder(s, "inputs")
    T.write_files(t(s, d, "supplier"), "s_suppkey", "s_name", path)
    return T.file_digests(s, path)


@query(f"{_SET} SELECT * FROM m")
def input_manifest(s, d):
    """IO-12: digests of files and of the whole set, whatever its order."""
    return T.manifest(_inputs(s, d))


@query(f"""{_SET} SELECT m.*, '0a1b2c' AS revision, sha256('{{"bands":["B04","B08"],"size":256}}') AS config_sha256 FROM m""")
def provenance(s, d):
    """IO-12: where a result comes from: its inputs, the code's revision, the settings."""
    return T.provenance(_inputs(s, d), "0a1b2c", {"size": 256, "bands": ["B04", "B08"]})


@query("SELECT l_linenumber AS epoch, round(avg(l_discount), 4) AS loss FROM lineitem GROUP BY 1")
def training_log(s, d):
    """IO-27: epochs and losses from a log's lines."""
    path = _folder(s, "log")
    n = t(s, d, "lineitem").groupBy("l_linenumber").agg(F.round(F.avg("l_discount"), 4).alias("loss"))
    n.select(F.explode(F.array(F.format_string("INFO Epoch: %d lr 0.1 train Loss: %.4f", "l_linenumber", "loss"), F.lit("noise"))).alias("value")).write.text(path)
    return T.log_rows(s.read.text(path)).select("epoch", "loss")
