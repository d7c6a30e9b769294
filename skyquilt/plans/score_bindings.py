"""Scores of plots, plans of dates, complete validation of tiles, sizes and grids, bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyquilt.functions import scalars as S
from skyquilt.functions import spectral as P
from skyquilt.operators import aggregates as A
from skyquilt.operators import audits as U
from skyquilt.operators import metrics as M
from skyquilt.operators import rasters as R
from skyquilt.operators import rules as Q
from skyquilt.operators import selection as W
from skyquilt.plans.bindings import _RASTER, query, r6, raster, t

# ---------------------------------------------------------------- plots

#: Lines as plots: a class from 0 (none) to 4, a prediction, and scores in tenths.
_PLOTS = """plots AS (SELECT (l_linenumber - 1) % 5 AS truth, CASE WHEN l_quantity < 30 THEN (l_linenumber - 1) % 5 ELSE l_partkey % 5 END AS pred,
    list_transform(range(0, 5), lambda c: ((round(l_discount * 100)::BIGINT + l_suppkey * (c + 1)) % 11 + CASE WHEN (l_linenumber - 1) % 5 = c THEN 4 ELSE 0 END) / 10.0) AS scores FROM lineitem)"""


def _plots(s, d):
    truth = (F.col("l_linenumber") - 1) % 5
    score = lambda c: ((F.round(F.col("l_discount") * 100).cast("long") + F.col("l_suppkey") * (c + 1)) % 11 + F.when(truth == c, 4).otherwise(0)) / 10
    return t(s, d, "lineitem").select(truth.alias("truth"), F.when(F.col("l_quantity") < 30, truth).otherwise(F.col("l_partkey") % 5).alias("pred"), F.array(*map(score, range(5))).alias("scores"))


@query(
    f"""WITH {_PLOTS}, l AS (SELECT truth = c AS pos, c, scores[c + 1] AS s FROM plots, range(1, 5) r(c)), h AS (SELECT c, s, count(*) FILTER (WHERE pos) * 1.0 AS a, count(*) FILTER (WHERE NOT pos) * 1.0 AS b FROM l GROUP BY 1, 2),
    u AS (SELECT c, s, sum(a) OVER w AS tp, sum(b) OVER w AS fp, sum(a) OVER (PARTITION BY c) AS np, sum(b) OVER (PARTITION BY c) AS nn FROM h WINDOW w AS (PARTITION BY c ORDER BY s DESC)),
    k AS (SELECT *, tp / np AS r, tp / (tp + fp) AS p, fp / nn AS f FROM u), z AS (SELECT c, (f - lag(f, 1, 0) OVER w) * (r + lag(r, 1, 0) OVER w) / 2 AS roc, (r - lag(r, 1, 0) OVER w) * (p + coalesce(lag(p) OVER w, p)) / 2 AS pr FROM k WINDOW w AS (PARTITION BY c ORDER BY s DESC)),
    area AS (SELECT c, sum(roc) AS auroc, sum(pr) AS aupr FROM z GROUP BY 1), n AS (SELECT truth AS c, count(*) AS plots, count(*) FILTER (WHERE pred = truth) AS hit FROM plots WHERE truth >= 1 GROUP BY 1)
    SELECT c::INT AS class, plots, hit AS "right", round(auroc, 6) AS auroc, round(aupr, 6) AS aupr, (SELECT count(*) FROM plots WHERE truth >= 1) AS n_known, (SELECT round(avg((pred = truth)::INT), 6) FROM plots WHERE truth >= 1) AS accuracy FROM n JOIN area USING (c)"""
)
def plot_report(s, d):
    """A-23: plots, hits and both areas of each class, and the accuracy over all plots of a known class."""
    x = M.plot_report(_plots(s, d), "truth", "pred", "scores", [1, 2, 3, 4])
    return x.withColumns({c: F.round(c, 6) for c in ("auroc", "aupr", "accuracy")})


@query(f"WITH {_PLOTS} SELECT truth AS true_c, pred AS pred_c, count(*) AS n FROM plots WHERE truth >= 1 GROUP BY 1, 2")
def plot_confusion(s, d):
    """A-23: what the plots of a known class were predicted as."""
    return M.confusion(_plots(s, d).where("truth >= 1"), "truth", "pred")


# ---------------------------------------------------------------- dates


@query(
    """WITH dt AS (SELECT o_custkey // 10 AS tile, o_orderdate::DATE AS date, min(o_totalprice) / 500000 AS cloud, bool_or(o_orderpriority IN ('1-URGENT', '2-HIGH')) AS ok FROM orders GROUP BY 1, 2),
    sl AS (SELECT tile, k::INT AS slot, make_date(1998, 3 * k::INT, 1) AS a, make_date(1998, 3 * k::INT + 2, 28) AS b FROM (SELECT DISTINCT tile FROM dt), range(1, 4) r(k)),
    p AS (SELECT tile, slot, date, CASE WHEN ok AND cloud <= 0.1 THEN 0 WHEN cloud <= 0.4 THEN 1 END AS tier, abs(date_diff('day', a + (date_diff('day', a, b) // 2)::INT, date)) AS gap FROM sl JOIN dt USING (tile) WHERE date BETWEEN a AND b),
    best AS (SELECT * FROM p WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tile, slot ORDER BY tier, gap, date) = 1), whole AS (SELECT tile FROM best GROUP BY 1 HAVING count(*) = 3),
    w AS (SELECT * FROM dt WHERE tile IN (SELECT tile FROM whole)),
    zero AS (SELECT tile, date FROM w WHERE date BETWEEN DATE '1997-08-15' AND DATE '1997-10-31' AND cloud <= 0.4 QUALIFY row_number() OVER (PARTITION BY tile ORDER BY abs(date_diff('day', DATE '1997-09-22', date)), date) = 1),
    four AS (SELECT tile, date FROM (SELECT *, CASE WHEN date BETWEEN DATE '1996-06-01' AND DATE '1996-08-16' THEN 0 WHEN date BETWEEN DATE '1995-06-01' AND DATE '1995-08-16' THEN 1 END AS k FROM w WHERE ok) WHERE k IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY tile ORDER BY k, abs(date_diff('day', make_date(1996 - k, 7, 9), date)), date) = 1)
    SELECT tile, slot, date FROM best WHERE tile IN (SELECT tile FROM whole) UNION ALL SELECT tile, 0, date FROM zero UNION ALL SELECT tile, 4, date FROM four"""
)
def slot_plan(s, d):
    """T-4: dates of all five slots; a tile that lacks one of the season gets none at all, and slot 4 is of 1996 or else 1995."""
    o = W.dealt(t(s, d, "orders").select(F.floor(F.col("o_custkey") / 10).alias("tile"), "o_orderdate", "o_totalprice", "o_orderpriority"), "tile")
    unknown = F.lit(None).cast("double")
    dates = o.groupBy("tile", F.to_date("o_orderdate").alias("date")).agg((F.min("o_totalprice") / 500000).alias("cloud"), F.bool_or(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("weather_ok")).withColumns({"snow": unknown, "seen": unknown})
    k = F.col("slot") * 3
    slots = t(s, d, "orders").select(F.floor(F.col("o_custkey") / 10).alias("tile")).distinct().withColumn("slot", F.explode(F.sequence(F.lit(1), F.lit(3)))).withColumns({"start": F.make_date(F.lit(1998), k, F.lit(1)), "end": F.make_date(F.lit(1998), k + 2, F.lit(28))})
    return W.slot_plan(dates, slots, "tile", 1998, (1996, 1995))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 183.25 ELSE dayofyear(o_orderdate) END::DOUBLE AS day FROM orders")
def packed_days(s, d):
    """P-11: years and days packed into one number, as days of the year; without data the mean."""
    value = F.when(F.col("o_orderkey") % 10 == 0, 0).otherwise((F.year("o_orderdate") % 100) * 1000 + F.dayofyear("o_orderdate"))
    return t(s, d, "orders").select("o_orderkey", P.aux_day(value, F.lit(183.25)).alias("day"))


# ---------------------------------------------------------------- validation


@query(
    """WITH c AS (SELECT o_custkey AS tile, (o_orderkey % 13)::INT AS cls, count(*) AS n FROM orders GROUP BY 1, 2), w AS (SELECT tile, sum(n) AS pixels, min(cls) AS lo, max(cls) AS hi, sum(n) FILTER (WHERE cls = 0) AS bg, max(n) AS top_n, sum(n) FILTER (WHERE cls > 0) AS fg, sum(n) FILTER (WHERE cls = 3) AS e FROM c GROUP BY 1),
    tp AS (SELECT tile, max_by(cls, n * 100 - cls) AS top FROM c WHERE cls > 0 GROUP BY 1), o AS (SELECT o_custkey AS tile, max(o_orderkey % 41) AS code, count(*) FILTER (WHERE o_totalprice > 400000) AS parcels, max(year(o_orderdate)) AS py, min(year(o_orderdate)) AS fy FROM orders GROUP BY 1),
    x AS (SELECT w.tile, lo, hi, pixels, coalesce(bg, 0) * 1.0 / pixels AS background, top_n * 1.0 / pixels AS top_share, w.tile % 3 = 0 AS crop, coalesce(e, 0) * 1.0 / greatest(coalesce(fg, 0), 1) AS share, top, code, parcels, py, fy FROM w LEFT JOIN tp ON tp.tile = w.tile JOIN o ON o.tile = w.tile)
    SELECT tile, array_to_string(list_filter([CASE WHEN hi >= 12 THEN 'range: label outside the classes' END, CASE WHEN background >= 1 THEN 'background: nothing else' END, CASE WHEN top_share >= 0.95 THEN 'uniform: one class nearly everywhere' END, CASE WHEN crop AND share = 0 THEN 'expected: class absent' END,
      CASE WHEN crop AND share > 0 AND share < 0.05 AND top <> 3 THEN 'expected: class below its share' END, CASE WHEN pixels <> 10 + tile % 3 THEN 'shape: number of pixels' END, CASE WHEN crop AND code >= 40 THEN 'codes: unknown' END, CASE WHEN crop AND parcels = 0 THEN 'parcels: none on a tile of crops' END,
      CASE WHEN crop AND py <> fy THEN 'year: parcels of another year' END], lambda v: v IS NOT NULL), ',') AS reasons FROM x"""
)
def tile_validation(s, d):
    """Q-2, Q-13: all rules of a tile's labels, with the thresholds they are used with (customers as tiles, orders as pixels)."""
    o = t(s, d, "orders").select(F.col("o_custkey").alias("tile"), (F.col("o_orderkey") % 13).cast("int").alias("cls"), (F.col("o_orderkey") % 41).cast("int").alias("code"), "o_totalprice", F.year("o_orderdate").alias("y"))
    n = o.groupBy("tile", "cls").agg(F.count("*").alias("n"))
    of = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    total = F.sum("n")
    labels = n.groupBy("tile").agg(
        total.alias("pixels"), F.min("cls").alias("min_label"), F.max("cls").alias("max_label"), (of(F.col("cls") == 0) / total).alias("background"), (F.max("n") / total).alias("top_share"),
        (of(F.col("cls") == 3) / F.greatest(of(F.col("cls") > 0), F.lit(1))).alias("expected_share"), F.max_by("cls", F.when(F.col("cls") > 0, F.struct(F.col("n"), -F.col("cls")))).alias("top"),
    )
    more = o.groupBy("tile").agg(F.collect_set("code").alias("found"), F.count_if(F.col("o_totalprice") > 400000).alias("parcels"), F.max("y").alias("parcel_year"), F.min("y").alias("first_year"))
    crop = F.col("tile") % 3 == 0
    x = labels.join(more, "tile").withColumns({"is_crop": crop, "expected": F.when(crop, 3)})
    return Q.audit(x, Q.tile_rules(12, 10 + F.col("tile") % 3, tuple(range(40)))).select("tile", F.array_join("reasons", ",").alias("reasons"))


@query("SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'R') THEN 'staging' ELSE 'live' END AS only_in FROM lineitem WHERE l_returnflag IN ('R', 'N') GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1")
def merge_parity(s, d):
    """Q-10: keys that only one of staging and live has."""
    li = t(s, d, "lineitem")
    return Q.key_parity(li.where("l_returnflag = 'R'"), li.where("l_returnflag = 'N'"), "l_orderkey")


@query(
    """WITH f AS (SELECT l_suppkey, l_linenumber, avg((l_discount > 0.01)::INT) AS v FROM lineitem GROUP BY 1, 2), n AS (SELECT count(*) AS evaluated, count(*) FILTER (WHERE v < 0.9) AS failed FROM f), c AS (SELECT source, avg((n_chars > 1500)::INT) AS x FROM documents GROUP BY 1)
    SELECT 'frames' AS fleet, evaluated, failed, evaluated >= 50 AND failed <= 0.01 * evaluated AS ok FROM n UNION ALL SELECT 'frames, lenient', evaluated, failed, evaluated >= 50 AND failed <= 0.9 * evaluated FROM n"""
)
def coverage_gates(s, d):
    """Q-14: the fleet of frames through two gates on coverage."""
    f = t(s, d, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.avg((F.col("l_discount") > 0.01).cast("double")).alias("v")).withColumn("verdict", Q.coverage_verdict("v", 0.9))
    strict, lenient = A.gate(f, "verdict").withColumn("fleet", F.lit("frames")), A.gate(f, "verdict", 50, 0.9).withColumn("fleet", F.lit("frames, lenient"))
    return strict.unionByName(lenient).select("fleet", "evaluated", "failed", "ok")


@query(
    """WITH f AS (SELECT l_orderkey AS tile, l_linenumber, max((l_quantity > 3)::INT) AS mask, max(l_tax) AS missing FROM lineitem GROUP BY 1, 2), v AS (SELECT tile, count(*) FILTER (WHERE mask = 1) AS frames, coalesce(bool_or(mask = 1 AND missing > 0.075), false) AS gap FROM f GROUP BY 1),
    k AS (SELECT tile, frames, CASE WHEN gap THEN 'missing_data' WHEN frames < 3 THEN 'few_frames' ELSE 'kept' END AS verdict FROM v) SELECT verdict, count(*) AS tiles, sum(frames)::BIGINT AS frames FROM k GROUP BY 1"""
)
def postprocess_report(s, d):
    """A-56: tiles kept, and removed by cause."""
    f = t(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("tile"), "l_linenumber").agg(F.max((F.col("l_quantity") > 3).cast("int")).alias("mask"), F.max("l_tax").alias("missing"))
    return Q.postprocess_verdict(f, "tile", 0.075).groupBy("verdict").agg(F.count("*").alias("tiles"), F.sum("frames").alias("frames"))


@query(
    """WITH n AS (SELECT l_suppkey, l_linenumber AS cls, count(*) AS n FROM lineitem GROUP BY 1, 2), t AS (SELECT l_suppkey, max_by(cls, n * 100 - cls) AS cls FROM n GROUP BY 1)
    SELECT cls, sum(n)::BIGINT AS pixels, (SELECT count(*) FROM t WHERE t.cls = n.cls) AS dominant_tiles, cls IN (3, 5) AS is_crop FROM n GROUP BY 1"""
)
def class_tiles(s, d):
    """A-56, A-38: pixels of each class, and the tiles where it is the most frequent."""
    return A.class_tiles(t(s, d, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("cls")), "l_suppkey", "cls", [3, 5])


# ---------------------------------------------------------------- images


@query(f"WITH {_RASTER} SELECT row, col, count(v) AS n_v, round(avg(v), 6) + 0.0 AS v FROM px GROUP BY 1, 2")
def scene_means(s, d):
    """A-53: the mean image over all scenes."""
    return A.mean_image(raster(s, d), ["row", "col"], ["v"]).withColumn("v", r6(F.col("v"), "v"))


@query(
    f"""WITH {_RASTER}, h AS (SELECT max(row) + 1 AS n FROM px), g AS (SELECT tile, r::INT AS row, c::INT AS col FROM (SELECT DISTINCT tile FROM px), range(0, (SELECT n + 6 FROM h)) a(r), range(0, 40) b(c))
    SELECT g.tile, g.row, g.col, coalesce(v, -1)::INT AS v FROM g LEFT JOIN px ON px.tile = g.tile AND px.row = g.row - 3 AND px.col = g.col + 6"""
)
def resized_tiles(s, d):
    """S-25: tiles padded above and below, and cut on both sides."""
    p = raster(s, d)
    rows = p.agg(F.max("row") + 1).first()[0] or 1
    return U.resized(p, "v", rows, 53, rows + 6, 40, -1).select("tile", F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col("v").cast("int").alias("v"))


@query(
    f"""WITH {_RASTER}, q AS (SELECT tile, row, col, v, tile::INT * 7.0 + col * 10 AS a, 5000.0 - tile::INT * 3 - row * 10 AS t FROM px), c AS (SELECT tile, v, a, t, unnest(range((a // 15)::BIGINT - 1, (a // 15)::BIGINT + 3)) AS c FROM q),
    r AS (SELECT tile, v, a, t, c, unnest(range((-t // 15)::BIGINT - 2, (-t // 15)::BIGINT + 4)) AS r FROM c)
    SELECT tile, r AS row, c AS col, v FROM r WHERE (c + 0.5) * 15 >= a AND (c + 0.5) * 15 < a + 10 AND -(r + 0.5) * 15 <= t AND -(r + 0.5) * 15 > t - 10"""
)
def snapped_rasters(s, d):
    """K-6: rasters whose corners lie anywhere, laid on the lattice of a coarser grid."""
    p = raster(s, d)
    n = F.col("tile").cast("int")
    origins = p.select("tile").distinct().select("tile", (n * 7.0).alias("west"), (5000.0 - n * 3).alias("north"))
    return R.snapped_to_grid(p, "v", origins, 10.0, 15.0)


@query()
def pixel_rings(s, d):
    """S-28: boxes in pixels as rings of latitude and longitude; checked in tests by the way back."""
    b = S.map_box("p_size", "p_size", F.col("p_size") + 5, F.col("p_size") + 3, 300000.0, 6500000.0)
    x = t(s, d, "part").select("p_partkey", b.alias("b"))
    return x.select("p_partkey", S.box_ring("b.west", "b.south", "b.east", "b.north", 7).alias("ring"))


@query()
def embedding_colours(s, d):
    """P-19: three principal components of the embeddings, each from 0 to 1; checked in tests against numpy."""
    x = A.principal_components(t(s, d, "embeddings").select("vec_id", "embedding"), "embedding", 3)
    x = x.select("vec_id", *[F.col("components")[k].alias(c) for k, c in enumerate("rgb")])
    ends = F.broadcast(x.agg(*[f(c).alias(f"{c}{n}") for c in "rgb" for n, f in (("0", F.min), ("1", F.max))]))
    j = x.join(ends, F.lit(True))
    return j.select("vec_id", *[r6(P.min_max(F.col(c), F.col(f"{c}0"), F.col(f"{c}1")), c) for c in "rgb"])


# ---------------------------------------------------------------- analyzers

_SCENE = """px AS (SELECT c_nationkey::VARCHAR AS tile, (o_custkey // 100)::BIGINT AS row, (dayofyear(o_orderdate) // 7)::BIGINT AS col, (min(o_orderkey) % 3)::INT AS cls, round(avg(o_totalprice) / 500000, 4) AS nir, round(max(o_totalprice) / 600000, 4) AS nir0,
    round(min(o_totalprice) / 600000, 4) AS red, round(avg(o_totalprice) / 700000, 4) AS red0, round(avg(o_orderkey % 10) / 10, 4) AS green, round(avg(o_orderkey % 7) / 7, 4) AS edge FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)"""
_INDEX = "(nir - red) / (nir + red + 1e-10)"


@query(
    f"""WITH RECURSIVE {_SCENE}, ch AS (SELECT *, sqrt(power(red - red0, 2) + power(nir - nir0, 2)) > 0.15 AS hit, {_INDEX} AS ndvi FROM px), on_ AS (SELECT tile, row, col, row_number() OVER (ORDER BY tile, row, col) AS id FROM ch WHERE hit),
    n AS (SELECT a.id AS u, b.id AS v FROM on_ a JOIN on_ b ON a.tile = b.tile AND abs(a.row - b.row) + abs(a.col - b.col) = 1), r AS (SELECT id AS u, id AS l FROM on_ UNION SELECT n.v, r.l FROM r JOIN n ON r.u = n.u), g AS (SELECT l, count(*) AS n FROM (SELECT u, min(l) AS l FROM r GROUP BY 1) GROUP BY 1 HAVING count(*) >= 3),
    sq AS (SELECT a.tile, a.row, a.col, a.ndvi > 0.25 AS tl, b.ndvi > 0.25 AS tr, c.ndvi > 0.25 AS br, e.ndvi > 0.25 AS bl FROM ch a JOIN ch b ON b.tile = a.tile AND b.row = a.row AND b.col = a.col + 1 JOIN ch c ON c.tile = a.tile AND c.row = a.row + 1 AND c.col = a.col + 1 JOIN ch e ON e.tile = a.tile AND e.row = a.row + 1 AND e.col = a.col),
    ed AS (SELECT tile, 'h' AS k, row, col FROM sq WHERE tl <> tr UNION SELECT tile, 'h', row + 1, col FROM sq WHERE bl <> br UNION SELECT tile, 'v', row, col FROM sq WHERE tl <> bl UNION SELECT tile, 'v', row, col + 1 FROM sq WHERE tr <> br),
    m AS (SELECT 'change_detection' AS analyzer, 'changed' AS measure, avg(hit::INT) AS value FROM ch UNION ALL SELECT 'change_detection', 'regions', count(*) FROM g UNION ALL SELECT 'change_detection', 'region_pixels', coalesce(sum(n), 0) FROM g
      UNION ALL SELECT 'spectral', 'vegetation', avg((ndvi > 0.3)::INT) FROM ch UNION ALL SELECT 'spectral', 'water', avg(((green - nir) / (green + nir + 1e-10) > -0.2)::INT) FROM ch UNION ALL SELECT 'nmd', 'ndvi_class_' || cls, avg(ndvi) FROM ch GROUP BY cls UNION ALL SELECT 'nmd', 'changed_before', avg(hit::INT) FROM ch
      UNION ALL SELECT 'vegetation_edge', 'edge_vertices', count(*) FROM ed UNION ALL SELECT 'water_quality', 'ndci', avg((edge - red) / (edge + red + 1e-10)) FROM ch UNION ALL SELECT 'water_quality', 'mci', avg(edge - (red + 0.5 * (nir - red))) FROM ch)
    SELECT analyzer, 'done' AS state, measure, round(value::DOUBLE, 6) + 0.0 AS value FROM m UNION ALL SELECT 'cot', 'off', NULL, NULL"""
)
def scene_analyzers(s, d):
    """UD-1, UD-2, UD-3: the library's analyzers of scenes, chosen and set by a file; one uses what another found, one is off."""
    from skyquilt.plans.analyzers import SETTINGS, analyze, load_settings

    o = t(s, d, "orders").join(t(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    p, k = F.col("o_totalprice"), F.col("o_orderkey")
    px = o.groupBy(F.col("c_nationkey").cast("string").alias("tile"), F.floor(F.col("o_custkey") / 100).alias("row"), F.floor(F.dayofyear("o_orderdate") / 7).cast("long").alias("col")).agg(
        (F.min(k) % 3).cast("int").alias("cls"), F.round(F.avg(p) / 500000, 4).alias("nir"), F.round(F.max(p) / 600000, 4).alias("nir0"), F.round(F.min(p) / 600000, 4).alias("red"), F.round(F.avg(p) / 700000, 4).alias("red0"),
        F.round(F.avg(k % 10) / 10, 4).alias("green"), F.round(F.avg(k % 7) / 7, 4).alias("edge"),
    )
    return analyze(px, load_settings(SETTINGS)).withColumn("value", r6(F.col("value"), "value"))
