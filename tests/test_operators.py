"""Known answers for operators, and brute force for those that SQL can't express."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyquilt.functions import scalars as S
from skyquilt.functions import spectral as P
from skyquilt.operators import aggregates as A
from skyquilt.operators import iterative as I
from skyquilt.operators import joins as J
from skyquilt.operators import metrics as M
from skyquilt.operators import rasters as R
from skyquilt.operators import rules as Q
from skyquilt.operators import sampling as SP
from skyquilt.operators import selection as W
from skyquilt.plans.registry import Registry

DATA = "/root/testdata/sf0.001"


def one(df):
    return df.collect()[0]


def test_indices(spark):
    df = spark.createDataFrame([(0.05, 0.1, 0.1, 0.8, 0.2, 0.1)], "B02 double, B03 double, B04 double, B08 double, B11 double, B12 double")
    r = one(P.with_indices(df))
    assert r.ndvi == pytest.approx(0.7777778, abs=1e-6) and r.ndwi == pytest.approx(-0.7777778, abs=1e-6)
    r = one(P.with_indices(df.drop("B11", "B12", "B08")))
    assert r.nbr == pytest.approx((0.25 / 3 - 0.1) / (0.25 / 3 + 0.1), abs=1e-6)


def test_expression_edges(spark):
    x = spark.createDataFrame([(0.0, -5.0), (0.1, 25.0), (4.0, 80.0), (100.0, 50.0)], "a double, p double")
    got = x.select(P.parcel_weight("a").alias("w"), P.cloud_gate("p").alias("g"), P.cloud_gate("p", F.lit(True)).alias("h"), P.severity(F.col("a")).alias("s"), P.decibel("a").alias("d")).collect()
    assert [r.w for r in got] == [1.0, 4.0, 1.0, 1.0]
    assert [round(r.g, 6) for r in got] == [0.2, 0.25, 0.3, 0.3] and [round(r.h, 6) for r in got] == [0.3, 0.425, 0.55, 0.55]
    assert got[0].s == "unburned" and got[1].s == "low" and got[0].d == 0.0
    assert one(spark.range(1).select(P.phase_displacement(F.lit(3 * math.pi), 0.0556).alias("d"))).d == pytest.approx(0.0556 / 4 * 1000, rel=1e-9)


def test_scalars(spark):
    names = spark.createDataFrame([("tile_500000_6500000",), ("crop_wheat_3",), ("urban_1",), ("42",)], "n string")
    assert [r.c for r in names.select(S.cohort("n").alias("c")).collect()] == ["lulc", "crop", "urban", "numeric"]
    assert one(names.select(S.name_coordinates("n").alias("x"))).x.asDict() == {"easting": 500000, "northing": 6500000}
    r = one(spark.range(1).select(S.month_windows(F.lit("4-5,6-7")).alias("m"), S.year_list(F.lit("2018-2020")).alias("y"), S.year_list(F.lit("2018,2021")).alias("z"), S.grid_square(F.lit("S2A_T33VXF_x")).alias("g"), S.day_of_year(F.lit("bad")).alias("d"), S.epsg_of(F.lit("http://x/EPSG/0/3006")).alias("e")))
    assert [tuple(x) for x in r.m] == [(4, 5), (6, 7)] and r.y == [2018, 2019, 2020] and r.z == [2018, 2021] and tuple(r.g) == (33, "V", "XF") and r.d == 0 and r.e == 3006
    r = one(spark.range(1).select(S.to_grid(F.lit(59.3293), F.lit(18.0686)).alias("g")).select("g", S.from_grid("g.easting", "g.northing").alias("b")))
    assert r.g.easting == pytest.approx(674571, abs=60) and r.g.northing == pytest.approx(6580740, abs=200)
    assert r.b.lat == pytest.approx(59.3293, abs=1e-8) and r.b.lon == pytest.approx(18.0686, abs=1e-8)
    c = one(spark.range(1).select(S.balanced_chunks(F.lit("2022-01-01").cast("date"), F.lit("2022-02-10").cast("date"), 19).alias("c"))).c
    assert len(c) == 3 and c[0].start == dt.date(2022, 1, 1) and c[-1].end == dt.date(2022, 2, 10) and all((b.start - a.end).days == 1 for a, b in zip(c, c[1:], strict=False))
    d = spark.createDataFrame([(["2021-05-01", "2022-06-01", "2022-07-01", ""],), (["2021-05-01", "2022-06-01"],), ([""],)], "d array<string>")
    assert [r.y for r in d.select(S.modal_year("d").alias("y")).collect()] == [2022, 2022, None]
    assert one(spark.range(1).select(S.nearest_filled(F.array(*map(F.lit, "abcd")), F.array(F.lit(False), F.lit(True), F.lit(False), F.lit(True)), [1, 2, 0, 3]).alias("n"))).n == [1, 1, 1, 3]


def test_ranking_anchors(spark):
    area = lambda rows: one(M.roc_pr(spark.createDataFrame(rows, "s double, y int"), "s", F.col("y") == 1))
    assert area([(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)]).auroc == 1.0
    assert area([(0.1, 1), (0.9, 0)]).auroc == 0.0
    assert area([(0.5, 1), (0.5, 0), (0.5, 1), (0.5, 0)]).auroc == 0.5
    assert area([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)]).auroc == 0.75
    assert math.isnan(area([(0.9, 1)]).auroc)
    rng = np.random.default_rng(0)
    s, y = rng.normal(size=300).round(1), rng.integers(0, 2, 300)
    pairs = [(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]]
    assert area(list(zip(s.tolist(), y.tolist(), strict=True))).auroc == pytest.approx(float(np.mean(pairs)))


def test_weights_and_calibration(spark):
    w = {r["class"]: r for r in A.class_weights(spark.createDataFrame([(1, 100), (2, 10)], "class int, n long"), 4).collect()}
    assert w[0].inverse == 0 and w[1].inverse == pytest.approx(112 / 400) and w[3].inverse == 10.0 and w[2].sqrt == pytest.approx(math.sqrt(112 / 40))
    e = one(M.expected_calibration_error(spark.createDataFrame([(0.95, 1), (0.95, 0), (1.0, 1)], "c double, y int"), "c", F.col("y") == 1))
    assert e.ece == pytest.approx(abs(2 / 3 - 2.9 / 3))


def test_iou_conventions(spark):
    cm = M.confusion(spark.createDataFrame([(1, 1), (1, 2), (0, 1), (2, 2)], "t int, p int"), "t", "p")
    a = {r["class"]: r.iou for r in M.per_class(cm).collect()}
    b = {r["class"]: r.iou for r in M.per_class(cm, drop_ignored_first=True).collect()}
    assert a[1] == round(1 / 3, 4) and b[1] == 0.5 and a[2] == b[2] == 0.5


def test_weighted_peaks_against_numpy(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(0.1, 0.03, 3000), rng.normal(0.7, 0.05, 2000)])
    got = one(A.weighted_peaks(spark.createDataFrame(pd.DataFrame({"v": v})), "v")).threshold
    assert got == pytest.approx(0.2 * 0.7 + 0.8 * 0.1, abs=0.03)
    assert one(A.weighted_peaks(spark.createDataFrame([(0.1,)], "v double"), "v")).threshold == 0.3


def test_nearest_and_ties(spark):
    d = lambda x: dt.date(2022, 6, x)
    left = spark.createDataFrame([(1, d(10)), (2, d(28))], "k int, day date")
    right = spark.createDataFrame([(d(8), 20.0), (d(12), 10.0), (d(20), 0.0)], "other date, cloud double")
    got = J.nearest_in_time(left, right, "day", "other", 7, ["k"], [F.col("cloud")]).collect()
    assert [(r.k, r.other, r.gap_days) for r in got] == [(1, d(12), 2)]


def test_points_half_open(spark):
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 10.0, 10.0)], "b string, w double, s double, e double, n double")
    pts = spark.createDataFrame([(0.0, 10.0), (10.0, 5.0), (5.0, 0.0), (9.9, 0.1)], "x double, y double")
    got = J.points_in_boxes(pts, boxes, "x", "y", ("w", "s", "e", "n"), 3).select("x", J.pixel_of("x", "y", "w", "n", 1, 10).alias("p")).orderBy("x").collect()
    assert [(r.x, tuple(r.p)) for r in got] == [(0.0, (0, 0)), (9.9, (9, 9))]


def test_set_cover_against_a_loop(spark):
    rng = np.random.default_rng(3)
    pairs = sorted({(int(i), int(c)) for i, c in zip(rng.integers(0, 30, 120), rng.integers(0, 15, 120), strict=True)})
    got = [(r.c, r.covered) for r in I.set_cover(spark.createDataFrame(pairs, "i int, c int"), "i", "c").orderBy("round").collect()]
    left, want = {i for i, _ in pairs}, []
    while left:
        best = max(sorted({c for _, c in pairs}), key=lambda c: (len(left & {i for i, k in pairs if k == c}), -c))
        hit = left & {i for i, k in pairs if k == best}
        want.append((best, len(hit)))
        left -= hit
    assert got == want


def test_suppression_against_a_loop(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 2, float(x), float(y), float(s), i) for i, (x, y, s) in enumerate(zip(rng.uniform(0, 60, 80), rng.uniform(0, 60, 80), rng.integers(0, 9, 80), strict=True))]
    got = {r.u for r in I.suppress_near(spark.createDataFrame(rows, "g int, x double, y double, s double, u int"), "g", "x", "y", "s", "u", 15).collect()}
    want = []
    for g, x, y, _, u in sorted(rows, key=lambda r: (-r[3], r[4])):
        if all(g != h or (x - a) ** 2 + (y - b) ** 2 >= 225 for h, a, b, _ in want):
            want.append((g, x, y, u))
    assert got == {w[3] for w in want}


def test_raster_kernels(spark):
    rng = np.random.default_rng(5)
    base = R.smooth(rng.normal(size=(48, 48)), 2)
    moved = R.shift_image(base, 1.5, -0.75)
    for find in (R.phase_offset, R.information_offset):
        dy, dx = find(base, moved)
        assert dy == pytest.approx(-1.5, abs=0.3) and dx == pytest.approx(0.75, abs=0.3)
    rows = [("t", s, r, c, float(v)) for s, im in ((0, base), (1, moved)) for (r, c), v in np.ndenumerate(im)]
    got = {r.slot: (r.dy, r.dx) for r in R.register_frames(spark.createDataFrame(rows, "tile string, slot int, row int, col int, v double"), "v", 0, "phase").collect()}
    assert got[0] == (0.0, 0.0) and got[1][0] == pytest.approx(-1.5, abs=0.3)
    square = R.rasterize([(np.array([(0, 0), (40, 0), (40, 40), (0, 40)]), 7), (np.array([(0, 0), (20, 0), (20, 20), (0, 20)]), 9)], 0, 60, 6)
    assert (square == 7).sum() == 12 and (square == 9).sum() == 4 and square[0].sum() == 0


def test_raster_tables(spark):
    rows = [("t", r, c, int(2 <= r <= 4 and 2 <= c <= 4)) for r in range(7) for c in range(7)]
    df = spark.createDataFrame(rows, "tile string, row int, col int, mask int")
    total = lambda x: one(x.agg(F.sum("mask").alias("n"))).n
    assert total(R.erode(df, "mask")) == 1 and total(R.dilate(df, "mask")) == 21 and total(R.open_close(df, "mask")) == 5
    p = one(R.patches(df, spark.createDataFrame([("t", 0, 0)], "tile string, row int, col int"), "mask", 1)).patch
    assert p == [None, None, None, None, 0, 0, None, 0, 0]
    assert R.resampled(df, 7, 7, 14, 14, "mask").where("mask = 1").count() == 36
    assert len(one(spark.range(1).select(R.chips(F.lit(250), F.lit(100), 100, 0.2).alias("c"))).c) == 3
    assert {r["sum(mask)"] for r in R.aligned(df, df.withColumnRenamed("mask", "m2"), 1, 0).agg(F.sum("mask")).collect()} == {9}


def test_polygon_tables(spark):
    tiles = spark.createDataFrame([("t", 0.0, 0.0, 60.0, 60.0)], "tile string, west double, south double, east double, north double")
    ring = [[0.0, 0.0], [40.0, 0.0], [40.0, 40.0], [0.0, 40.0]]
    polys = spark.createDataFrame([(ring, 7, 1, 0.0, 0.0, 40.0, 40.0)], "ring array<array<double>>, value int, rank int, west double, south double, east double, north double")
    assert R.rasterize_tiles(tiles, polys, 6).count() == 16
    pts = spark.createDataFrame([(10.0, 10.0), (50.0, 10.0)], "x double, y double")
    assert [r.i for r in pts.select(R.points_in_polygons(pts, [tuple(p) for p in ring], "x", "y").alias("i")).collect()] == [True, False]


def test_splits_and_samples(spark):
    names = spark.createDataFrame([(f"tile_{i}.npz",) for i in range(50)], "n string")
    import hashlib

    assert {r.n: r.p for r in names.select("n", SP.md5_percent("n").alias("p")).collect()} == {f"tile_{i}.npz": int(hashlib.md5(f"tile_{i}.npz".encode()).hexdigest(), 16) % 100 for i in range(50)}
    w = spark.range(2000).select(F.lit(1).alias("g"), F.col("id"), F.when(F.col("id") < 200, 20.0).otherwise(1.0).alias("w"))
    s = SP.weighted_sample(w, ["g"], "w", 300, 1, "id")
    assert s.count() == 300 and s.where("id < 200").count() > 120 and s.where("id < 200").count() == SP.weighted_sample(w, ["g"], "w", 300, 1, "id").where("id < 200").count()
    assert one(SP.with_replacement(w, "w", "id", 1000, 3).agg(F.sum("draws").alias("n"))).n == pytest.approx(1000, abs=60)
    r = SP.with_rank(spark.createDataFrame([(1.0, 3), (None, 1), (1.0, 2), (0.5, 9)], "a double, b int"), ["a", "b"]).orderBy("rank").collect()
    assert [(x.a, x.b, x["rank"]) for x in r] == [(None, 1, 0), (0.5, 9, 1), (1.0, 2, 2), (1.0, 3, 3)]


def test_slot_selection(spark):
    d = lambda m, x: dt.date(2022, m, x)
    slots = spark.createDataFrame([("t", k, d(3 + k, 1), d(3 + k, 30)) for k in (1, 2, 3)], "tile string, slot int, start date, end date")
    rows = [("t", d(4, 2), 0.05, None, 0.9, True), ("t", d(4, 14), 0.3, 0.0, 0.9, True), ("t", d(5, 20), 0.35, 0.0, None, False), ("t", d(6, 15), 0.0, 0.2, 0.9, True), ("t", d(6, 20), 0.1, 0.01, 0.9, True)]
    dates = spark.createDataFrame(rows, "tile string, date date, cloud double, snow double, seen double, weather_ok boolean")
    got = [(r.slot, r.date, r.tier) for r in W.slot_dates(dates, slots, "tile").orderBy("slot").collect()]
    assert got == [(1, d(4, 2), 0), (2, d(5, 20), 1), (3, d(6, 20), 0)]
    assert W.slot_dates(dates.where("date <> '2022-05-20'"), slots, "tile").count() == 0


def test_unknown_values_pass(spark):
    df = spark.createDataFrame([(0.05, None, None), (0.05, 0.2, 0.9), (0.05, 0.0, 0.5), (0.5, 0.0, 0.9)], "c double, s double, k double")
    assert [r.g for r in df.select(W.scene_gate("c", "s", "k").alias("g")).collect()] == [True, False, False, False]


def test_demotion(spark):
    f = spark.createDataFrame([("a", k, v, 1) for k, v in enumerate((1.0, 0.5, 1.0, 1.0))] + [("b", k, 1.0, 1) for k in range(4)] + [("c", k, 0.1, 1) for k in range(4)], "tile string, slot int, valid_frac double, mask int")
    got = {r.tile: (r.action, r.bad_slots, r.n_good, r.new_mask) for r in Q.demotion(f, "tile").collect()}
    assert got == {"a": ("demote", [1], 3, [1, 0, 1, 1]), "b": ("clean", [], 4, [1, 1, 1, 1]), "c": ("refetch", [0, 1, 2, 3], 0, [0, 0, 0, 0])}


def test_frame_rules(spark):
    d = lambda y, m, x: dt.date(y, m, x)
    good = ([1, 1, 1, 1], [258, 121, 182, 213], [d(2021, 9, 15), d(2022, 5, 1), d(2022, 7, 1), d(2022, 8, 1)], 4)
    bad = ([1, 1, 1, 1], [258, 121, 182, 100], [d(2021, 9, 15), d(2022, 5, 1), d(2022, 4, 1), None], 5)
    df = spark.createDataFrame([good, bad], "mask array<int>, days array<int>, dates array<date>, n_frames int")
    a, b = (r.reasons for r in Q.audit(df, Q.frame_rules()).collect())
    assert a == [] and {x.split(":")[0] for x in b} == {"shape", "date", "day", "order", "summer"}


def test_progress(spark):
    now = dt.datetime(2024, 1, 1, 12)
    rows = [(now - dt.timedelta(minutes=i / 2 + 0.1),) for i in range(60)]
    r = one(A.progress(spark.createDataFrame(rows, "t timestamp"), "t", 120, F.lit(now)))
    assert r.done == 60 and r.rate_recent == 120.0 and r.eta_hours == pytest.approx(0.5)


def test_registry(spark):
    reg = Registry()
    reg.add("one")(lambda df, k=1: df.limit(k))
    reg.add("broken")(lambda df: df.select("missing"))
    reg.add("two")(lambda df, previous: previous["one"].select(F.lit(2).alias("x")))
    res = reg.run(spark.range(5), {"one": {"k": 3}, "broken": {}, "two": {"enabled": True}})
    assert [r.success for r in res] == [True, False, True] and res[2].output.count() == 3 and "missing" in res[1].error
    assert reg.run(spark.range(5), {"one": {"enabled": False}})[0].skipped


def test_stages():
    stages = [("a", lambda: "pass"), ("b", lambda: "fail"), ("c", lambda: "pass")]
    s1 = I.advance(stages, {})
    s2 = I.advance(stages, s1)
    assert s1 == {"a": "done"} and s2 == {"a": "done", "b": "halted"} and I.advance(stages, s2) == s2


def test_best_overlap_of_equal_areas(spark):
    """Of areas that are equal but for the noise of their bounds the lower item wins."""
    a = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 10.0)], "r long, w double, s double, e double, n double")
    i = spark.createDataFrame([(5, 0.0, 0.0, 0.3, 10.0), (7, 0.0, 0.0, 0.1 + 0.2, 10.0)], "i long, w2 double, s2 double, e2 double, n2 double")
    assert 0.1 + 0.2 > 0.3
    got = J.best_overlap(a, i, "r", ("w", "s", "e", "n"), ("w2", "s2", "e2", "n2"), "i", 1.0).collect()
    assert [tuple(r) for r in got] == [(1, 5, 3.0)]


def _boxes(rng, n, sizes, span, whole):
    x, y = rng.uniform(-span, span, n), rng.uniform(-span, span, n)
    w, h = rng.choice(sizes, n), rng.choice(sizes, n)
    out = [[float(v) for v in box] for box in zip(x, y, x + w, y + h, strict=True)]
    return [[float(round(v)) for v in box] for box in out] if whole else out


@pytest.mark.parametrize("whole", [True, False])
def test_best_overlap_by_brute_force(spark, whole):
    """Boxes of many sizes, points, copies, boxes that only touch, and ones without a bound."""
    import numpy as np

    rng = np.random.default_rng(3)
    requests = [(k, *b) for k, b in enumerate(_boxes(rng, 300, [0.0, 3.0, 10.0, 60.0], 60, whole) + _boxes(rng, 300, [10.0], 15, whole))] + [(1000, None, 0.0, 1.0, 1.0), (1001, 900.0, 900.0, 901.0, 901.0)]
    boxes = _boxes(rng, 250, [0.0, 4.0, 15.0, 200.0], 70, whole) + _boxes(rng, 250, [9.0, 16.0], 20, whole)
    items = [(k, *b) for k, b in zip(rng.permutation(1000), boxes + boxes[::7], strict=False)] + [(2000, 0.0, None, 1.0, 1.0)]
    items = [(int(k), *b) for k, *b in items]
    want = {}
    for k, *r in requests:
        for i, *b in items:
            if None not in (*r, *b) and not (b[2] < r[0] or b[0] > r[2] or b[3] < r[1] or b[1] > r[3]):
                area = round(max(0.0, min(r[2], b[2]) - max(r[0], b[0])) * max(0.0, min(r[3], b[3]) - max(r[1], b[1])), 4)
                want[k] = max(want.get(k, (-1.0, 0)), (area, -i))
    a = spark.createDataFrame(requests, "r long, w double, s double, e double, n double")
    i = spark.createDataFrame(items, "i long, w2 double, s2 double, e2 double, n2 double")
    for cell in (1.0, 20.0):
        got = {x.r: (x.area, -x.i) for x in J.best_overlap(a, i, "r", ("w", "s", "e", "n"), ("w2", "s2", "e2", "n2"), "i", cell, split=50).collect()}
        assert got == want and 300 < len(got) < len(requests)


def test_best_overlap_does_not_pair_all(spark, monkeypatch):
    """Of requests and items that nearly all overlap not all pairs are made."""
    paired, plain = [], J.overlapping_boxes
    monkeypatch.setattr(J, "overlapping_boxes", lambda *args: paired.append(plain(*args)) or paired[-1])
    a = spark.range(3000).selectExpr("id AS r", "id * 37 % 100 + 0.01 AS w", "0.0 AS s", "id * 37 % 100 + 200.01 AS e", "8.0 AS n")
    i = spark.range(2000).selectExpr("id * 7 % 2000 AS i", "id * 91 % 100 - 50.0 AS w2", "3.0 AS s2", "id * 91 % 100 + 250.0 AS e2", "13.5 AS n2")
    got = J.best_overlap(a, i, "r", ("w", "s", "e", "n"), ("w2", "s2", "e2", "n2"), "i", 100.0)
    assert got.count() == 3000 and paired[0].count() < 100_000


def test_decibel_of_zero(spark):
    """A logarithm of zero is minus infinity where a query asks for it as it is."""
    x = spark.createDataFrame([(0.0,), (100.0,), (-1.0,), (None,)], "a double")
    got = [r.d for r in x.select(P.decibel("a", finite=False).alias("d")).collect()]
    assert got[:2] == [-math.inf, 20.0] and math.isnan(got[2]) and got[3] is None
    assert [r.d for r in x.select(P.decibel("a").alias("d")).collect()] == [0.0, 20.0, 0.0, 0.0]


def test_event_expressions_of_zero(spark, tmp_path):
    from skyquilt.plans import bindings

    spark.createDataFrame([(1, "view", 0.0), (2, "error", 10.0)], "event_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    got = {r.event_id: r.db for r in bindings.QUERIES["event_expressions"](spark, str(tmp_path)).collect()}
    assert got == {1: -math.inf, 2: 10.0}


def test_event_expressions_of_halves(spark, tmp_path):
    """A gate whose seventh place is a half is rounded as in the SQL, which has 0.307407 for 0.3074065."""
    import duckdb

    from skyquilt.plans import bindings

    values = [1.4813, 1.8311, 4.8283, 8.1753, -1.0, 0.0, float("inf"), float("nan"), None, *[k / 10000 for k in range(1, 500_000, 97)]]
    df = spark.createDataFrame([(k, "error" if k % 5 else "view", v) for k, v in enumerate(values)], "event_id long, event_type string, value double")
    df.write.parquet(str(tmp_path / "events.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = {r[0]: repr(r) for r in db.sql(bindings.ORACLE_SQL["event_expressions"]).fetchall()}
    got = {r.event_id: repr(tuple(r)) for r in bindings.QUERIES["event_expressions"](spark, str(tmp_path)).collect()}
    assert got == want


def test_progress_beyond_the_total(spark):
    now = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(now - dt.timedelta(minutes=i / 2 + 0.1),) for i in range(60)], "t timestamp")
    r = one(A.progress(df, "t", 45, F.lit(now), surplus=True))
    assert r.remaining == -15 and r.eta_hours == pytest.approx(-0.125)
    r = one(A.progress(df, "t", 45, F.lit(now)))
    assert r.remaining == 0 and r.eta_hours == 0


def test_segment_vote_of_equal_scores(spark):
    """Means that are equal but for the order of their sums are a tie."""
    assert (0.1 + 0.2) / 2 > 0.3 / 2
    df = spark.createDataFrame([(0, 1, 0.3), (0, 1, 0.0), (0, 2, 0.1), (0, 2, 0.2)], "seg long, cls int, p double").coalesce(1)
    assert A.segment_vote(df, "seg", "cls", "p").collect()[0].cls == 1


def test_suppression_writes_no_pairs(spark, tmp_path, monkeypatch):
    """Many detections in one place: what a round writes follows them, not their pairs; those without a place or score stay."""
    rows = [(0, float(i % 7), float(i % 5), float(i % 11), i) for i in range(2000)] + [(0, None, 1.0, 5.0, 3000), (0, float("nan"), 1.0, 5.0, 3001), (0, 1.0, 1.0, None, 3002), (0, 200.0, 1.0, float("nan"), 3003), (0, 201.0, 1.0, 99.0, 3004)]
    written, table = [], I._table

    def counted(df):
        out = table(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(I, "_table", counted)
    df = spark.createDataFrame(rows, "g int, x double, y double, s double, u int")
    got = {r.u for r in I.suppress_near(df, "g", "x", "y", "s", "u", 15.0).collect()}
    assert got == {10, 3000, 3001, 3002, 3003} and max(written) <= len(rows)


def test_components_shrink(spark, monkeypatch):
    """What a round writes shrinks from round to round, even along a path of ascending ids."""
    written, table = [], I._table

    def counted(df):
        out = table(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(I, "_table", counted)
    path = spark.range(300).selectExpr("id AS a", "id + 1 AS b").unionByName(spark.range(1000, 1100).selectExpr("id AS a", "id + 1 AS b"))
    got = {r.id: r.component for r in I.components(path).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1101)}
    assert min(n for n in written if n) < 100


def test_range_join_deals_a_dense_cell(spark):
    """Pairs of one cell come from several tasks, each pair once."""
    a = spark.range(300).selectExpr("id AS i", "10.0D + id * 1e-3 AS lo", "20.0D AS hi")
    b = spark.range(300).selectExpr("id AS j", "11.0D + id * 1e-3 AS lo2", "19.0D AS hi2")
    got = J.range_join(a, b, "lo", "hi", "lo2", "hi2", 100, split=20).select("i", "j", F.spark_partition_id().alias("p")).collect()
    assert len(got) == len({(r.i, r.j) for r in got}) == 90_000
    assert max(sum(r.p == p for r in got) for p in {r.p for r in got}) < 60_000


def test_rings_are_compiled(spark):
    """No function of an array holds the series, as Spark evaluates what is in one uncompiled; the ring closes."""
    from skyquilt.plans import score_bindings  # noqa: F401
    from skyquilt.plans.bindings import QUERIES

    got = QUERIES["pixel_rings"](spark, "/root/testdata/sf0.001")
    assert "transform(" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert all(len(r.ring) == 5 and r.ring[0] == r.ring[4] for r in got.limit(5).collect())


def test_dealt(spark, tmp_path, monkeypatch):
    """A task that chooses dates has as many rows however many there are; choices by key and slot need no further shuffle."""
    monkeypatch.setattr(W, "TASK", 100)
    spark.range(3000).selectExpr("id % 600 AS tile", "id AS slot").write.parquet(str(tmp_path / "t"))
    d = W.dealt(spark.read.parquet(str(tmp_path / "t")), "tile")
    sizes = [r["count"] for r in d.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert d.rdd.getNumPartitions() == 30 and sum(sizes) == 3000 and max(sizes) <= 300
    assert W.dealt(spark.read.parquet(str(tmp_path / "t")).limit(5), "tile").rdd.getNumPartitions() == 4
    first = W.first_per(d, ["tile", "slot"], [F.col("slot")])
    assert first._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
