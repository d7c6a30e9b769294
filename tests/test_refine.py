"""Polygons, box sums, superpixels, lines, registration, draws and grids against loops over small tables."""

import bisect
import datetime as dt
import hashlib
import importlib.util
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquilt.functions import scalars as S
from skyquilt.operators import aggregates as A
from skyquilt.operators import audits as Q
from skyquilt.operators import control as C
from skyquilt.operators import joins as J
from skyquilt.operators import lines as L
from skyquilt.operators import metrics as M
from skyquilt.operators import polygons as G
from skyquilt.operators import rasters as R
from skyquilt.operators import refine as RF
from skyquilt.operators import sampling as SP
from skyquilt.operators import selection as W

PIXELS = "tile string, row int, col int, v double"


def tiles(spark, images):
    return spark.createDataFrame([(t, int(r), int(c), float(a[r, c])) for t, a in images.items() for r, c in np.ndindex(*a.shape) if not np.isnan(a[r, c])], PIXELS)


def image(rows, shape, value):
    out = np.full(shape, np.nan)
    for r in rows:
        out[r["row"], r["col"]] = r[value]
    return out


# -- joins of boxes


@pytest.mark.parametrize("split", [None, 5])
def test_boxes_of_any_size(spark, split):
    """Boxes of a few units, of thousands, and without any width; nothing explodes, and no pair is lost or comes twice."""
    rng = random.Random(4)
    box = lambda: (lambda x, y, w: (x, y, x + w, y + w * rng.random()))(rng.uniform(-5000, 5000), rng.uniform(-5000, 5000), rng.choice([0.0, 3.0, 50.0, 900.0, 100_000.0]))
    a, b = [(i, *box()) for i in range(120)], [(i, *box()) for i in range(150)]
    da = spark.createDataFrame(a, "i int, w double, s double, e double, n double")
    db = spark.createDataFrame(b, "j int, w2 double, s2 double, e2 double, n2 double")
    got = Counter((r.i, r.j) for r in J.overlapping_boxes(da, db, ("w", "s", "e", "n"), ("w2", "s2", "e2", "n2"), 10.0, split=split).collect())
    want = {(i, j) for i, w, s, e, n in a for j, w2, s2, e2, n2 in b if not (e2 < w or w2 > e or n2 < s or s2 > n)}
    assert set(got) == want and max(got.values()) == 1 and len(want) > 500
    points = [(k, rng.uniform(-5000, 5000), rng.uniform(-5000, 5000)) for k in range(200)]
    dp = spark.createDataFrame(points, "k int, x double, y double")
    got = Counter((r.k, r.j) for r in J.points_in_boxes(dp, db, "x", "y", ("w2", "s2", "e2", "n2"), 10.0, split=split).collect())
    assert set(got) == {(k, j) for k, x, y in points for j, w, s, e, n in b if w <= x < e and s < y <= n} and max(got.values()) == 1
    dealt = J._dealt(db.withColumn("__l", J._level(F.greatest(F.col("e2") - F.col("w2"), F.col("n2") - F.col("s2")), 10.0)), ("w2", "s2", "e2", "n2"), 10.0)
    assert dealt.count() <= 9 * len(b)
    assert J.overlapping_boxes(da.limit(0), db, ("w", "s", "e", "n"), ("w2", "s2", "e2", "n2"), 10.0).count() == 0


# -- polygons


def inside(rings, x, y):
    n = 0
    for ring in rings:
        ring = [p for p in ring if None not in p]
        if len(ring) >= 3:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
                n += (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return n % 2 == 1


def shapes():
    rng = random.Random(11)
    star = lambda x, y, r, n: [(x + r * (1 if k % 2 else 0.45) * math.cos(math.tau * k / n), y + r * (1 if k % 2 else 0.45) * math.sin(math.tau * k / n)) for k in range(n)]
    out = [(k, [star(rng.uniform(0, 300), rng.uniform(0, 300), rng.choice([4, 30, 120]), rng.choice([6, 10, 40]))]) for k in range(25)]
    out[3] = (3, [[(10.0, 10.0), (200.0, 10.0), (200.0, 200.0), (10.0, 200.0), (10.0, 10.0)], [(50.0, 50.0), (150.0, 50.0), (150.0, 150.0), (50.0, 150.0)], [(220.0, 0.0), (260.0, 0.0), (260.0, 40.0)]])
    return [*out, (30, [[(1.0, 1.0), (2.0, 2.0)]]), (31, []), (32, [[(5.0, 5.0), (None, 7.0), (90.0, 5.0), (90.0, 90.0)]])]


def test_points_in_polygons(spark):
    polys = shapes()
    df = spark.createDataFrame(polys, "poly int, rings array<array<struct<x:double,y:double>>>")
    rng = random.Random(12)
    points = [(i, rng.uniform(-20, 320), rng.uniform(-20, 320)) for i in range(500)] + [(1000, 10.0, 10.0), (1001, 200.0, 100.0), (1002, 100.0, 50.0), (1003, 50.0, 150.0)]
    dp = spark.createDataFrame(points, "id int, x double, y double")
    want = {(i, k) for i, x, y in points for k, rings in polys if inside(rings, x, y)}
    assert {(r.id, r.poly) for r in G.points_in(dp, df, "id", "x", "y", "poly", 20.0).collect()} == want
    assert {(r.id, r.poly) for r in G.points_in(dp, df, "id", "x", "y", "poly", 20.0, split=20).collect()} == want
    hit = {i for i, _ in want}
    assert {r.id for r in G.masked(dp, df, "id", "x", "y", "poly", 20.0, complement=True).collect()} == {i for i, _, _ in points} - hit
    assert G.points_in(dp, df.limit(0), "id", "x", "y", "poly", 20.0).count() == 0


def test_rasterised_polygons(spark):
    polys = shapes()
    df = spark.createDataFrame([(k, rings, k * 10, k % 4) for k, rings in polys], "poly int, rings array<array<struct<x:double,y:double>>>, value int, rank int")
    got = {(r.row, r.col): r.value for r in G.rasterised(df, "poly", "value", "rank", -20.0, 330.0, 7.0).collect()}
    want = {}
    for row in range(-20, 80):
        for c in range(-20, 80):
            x, y = -20.0 + (c + 0.5) * 7, 330.0 - (row + 0.5) * 7
            hit = [(k % 4, k) for k, rings in polys if inside(rings, x, y)]
            if hit:
                want[row, c] = max(hit)[1] * 10
    assert got == want and len(want) > 400


# -- refinement


def box(a, radius):
    """Means over the pixels that are there."""
    out = np.full(a.shape, np.nan)
    for r, c in np.ndindex(*a.shape):
        out[r, c] = np.nanmean(a[max(0, r - radius) : r + radius + 1, max(0, c - radius) : c + radius + 1])
    return out


def holed(rng, shape=(14, 17)):
    a = rng.random(shape)
    a[2, 3] = a[7, 0:3] = a[13, 16] = np.nan
    return a


@pytest.mark.parametrize("radius", [1, 5, 30])
def test_box_means(spark, radius):
    rng = np.random.Generator(np.random.PCG64(1))
    a, b = holed(rng), rng.random((3, 4))
    rows = RF.box_means(tiles(spark, {"a": a, "b": b}), "v", radius).collect()
    for t, x in (("a", a), ("b", b)):
        got = image([r for r in rows if r.tile == t], x.shape, "v")
        assert np.allclose(got, np.where(np.isnan(x), np.nan, box(x, radius)), equal_nan=True)


@pytest.mark.parametrize("bands", [1, 3])
def test_guided_filter(spark, bands):
    """Against windows one by one; with one band and with three."""
    rng = np.random.Generator(np.random.PCG64(2))
    shape, radius, eps = (9, 11), 2, 0.01
    there = ~np.isnan(holed(rng, (14, 17))[: shape[0], : shape[1]])
    guide, p = rng.random((bands, *shape)), rng.random((2, *shape))
    rows = [("t", r, c, *map(float, guide[:, r, c]), *map(float, p[:, r, c])) for r, c in np.ndindex(*shape) if there[r, c]]
    names = [f"g{k}" for k in range(bands)]
    df = spark.createDataFrame(rows, f"tile string, row int, col int, {', '.join(f'{n} double' for n in names)}, p0 double, p1 double")
    got = RF.guided_filter(df, names, ["p0", "p1"], radius, eps).collect()
    around = lambda r, c: [(y, x) for y in range(max(0, r - radius), min(shape[0], r + radius + 1)) for x in range(max(0, c - radius), min(shape[1], c + radius + 1)) if there[y, x]]
    line = {}
    for r, c in np.ndindex(*shape):
        if there[r, c]:
            at = tuple(np.array(around(r, c)).T)
            i, q = guide[:, at[0], at[1]], p[:, at[0], at[1]]
            cov = np.cov(i, bias=True).reshape(bands, bands) + eps * np.eye(bands)
            a = [np.linalg.solve(cov, (i * q[k]).mean(axis=1) - i.mean(axis=1) * q[k].mean()) for k in (0, 1)]
            line[r, c] = [(a[k], q[k].mean() - a[k] @ i.mean(axis=1)) for k in (0, 1)]
    for row in got:
        near = around(row.row, row.col)
        for k in (0, 1):
            a, b = (np.mean([line[x][k][j] for x in near], axis=0) for j in (0, 1))
            assert math.isclose(row[f"p{k}"], float(a @ guide[:, row.row, row.col] + b), rel_tol=1e-8, abs_tol=1e-8)
    assert len(got) == there.sum()


def brute_superpixels(a, step, compactness, rounds):
    there = [(r, c) for r, c in np.ndindex(*a.shape) if not np.isnan(a[r, c])]
    label = {(r, c): (r // step) * (1 << 20) + c // step for r, c in there}
    for _ in range(rounds):
        members = defaultdict(list)
        for p in there:
            members[label[p]].append(p)
        centres = {k: (np.mean([p[0] for p in m]), np.mean([p[1] for p in m]), np.mean([a[p] for p in m])) for k, m in members.items()}
        new = {}
        for r, c in there:
            near = [((a[r, c] - v) ** 2 + ((r - y) ** 2 + (c - x) ** 2) * (compactness / step) ** 2, k) for k, (y, x, v) in centres.items() if abs(r // step - y // step) <= 1 and abs(c // step - x // step) <= 1]
            new[r, c] = min(near)[1] if near else label[r, c]
        label = new
    return label


def test_superpixels(spark):
    rng = np.random.Generator(np.random.PCG64(5))
    a = np.kron(rng.integers(0, 4, (5, 6)), np.ones((5, 4))) + 0.2 * rng.random((25, 24))
    a[3, 4] = a[10, 10] = np.nan
    df = tiles(spark, {"a": a})
    got = {(r.row, r.col): r.label for r in RF.superpixels(df, ["v"], 6, 1.5, 4).collect()}
    assert got == brute_superpixels(a, 6, 1.5, 4)
    rows = RF.segments(df, ["v"], 6, 1.5, 4, 8).collect()
    by = defaultdict(set)
    for r in rows:
        by[r.segment].add((r.row, r.col))
    assert len(rows) == (~np.isnan(a)).sum() and len(by) > 8

    def connected(s):
        s, todo = set(s), [next(iter(s))]
        s.discard(todo[0])
        while todo:
            r, c = todo.pop()
            for p in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if p in s:
                    s.discard(p)
                    todo.append(p)
        return not s

    assert all(connected(s) for s in by.values())
    votes = df.select("tile", "row", "col", F.explode(F.array(F.struct(F.lit(0).alias("cls"), (F.col("v") / 4).alias("p")), F.struct(F.lit(1).alias("cls"), (1 - F.col("v") / 4).alias("p")))).alias("c"))
    joined = spark.createDataFrame([(r.row, r.col, r.segment) for r in rows], "row int, col int, segment string").join(votes.select("row", "col", "c.cls", "c.p"), ["row", "col"])
    for mode, f in (("mean_prob", lambda p: p.mean()), ("majority_vote", lambda p: (p >= 0.5).sum()), ("weighted_mean", lambda p: (p * p).sum() / p.sum())):
        vote = {r.segment: r.cls for r in A.segment_vote(joined, "segment", "cls", "p", mode).collect()}
        for s, pixels in by.items():
            v = np.array([a[p] for p in pixels])
            assert vote[s] == (0 if f(v / 4) >= f(1 - v / 4) else 1)


# -- lines


def chains(pieces):
    """Lines of directed pieces by walking: sorted tuples of vertices."""
    after, before = {a: b for a, b in pieces}, {b: a for a, b in pieces}
    lines, seen = [], set()
    for start in sorted(after, key=lambda v: (v in before, v)):
        if start in seen:
            continue
        line, v = [], start
        while v is not None and v not in seen:
            seen.add(v)
            line.append(v)
            v = after.get(v)
        lines.append((tuple(line), start in before))
    return sorted(lines)


def test_ordered_lines(spark):
    """Open lines, rings, and lines of one piece, in any order of keys; tiles don't mix."""
    rng = random.Random(6)
    pieces, key = [], iter(rng.sample(range(10_000), 2000))
    for n, ring in ((1, False), (37, False), (100, True), (4, True), (63, True), (250, False)):
        v = [next(key) for _ in range(n + 1)]
        pieces += list(zip(v, v[1:], strict=False)) + ([(v[-1], v[0])] if ring else [])
    rng.shuffle(pieces)
    rows = [(t, a, b, a / 10, a / 7, b / 10, b / 7) for t in ("x", "y") for a, b in pieces]
    got = L.ordered_lines(spark.createDataFrame(rows, "tile string, a long, b long, ay double, ax double, by double, bx double")).collect()
    for tile in ("x", "y"):
        by = defaultdict(list)
        for r in got:
            if r.tile == tile:
                assert math.isclose(r.y * 10, r.x * 7)
                by[r.line, r.closed].append((r.seq, round(r.y * 10)))
        found = sorted((tuple(v for _, v in sorted(line)), closed) for (_, closed), line in by.items())
        assert found == chains(pieces) and all([s for s, _ in sorted(line)] == list(range(len(line))) for line in by.values())


def test_contours(spark):
    """A hill gives a ring, a ramp an open line, and a saddle two pieces; places are interpolated, and steps join neighbouring edges."""
    y, x = np.mgrid[0:12, 0:15]
    hill = 10 - np.hypot(y - 5.3, x - 6.2)
    ramp = x + 0.25 * y
    saddle = np.array([[9.0, 1.0], [1.0, 9.0]])
    rng = np.random.Generator(np.random.PCG64(8))
    noise = rng.random((20, 20)) * 10
    noise[4, 4] = np.nan
    got = defaultdict(list)
    for r in L.contours(tiles(spark, {"hill": hill, "ramp": ramp, "saddle": saddle, "noise": noise}), "v", 6.0).collect():
        got[r.tile, r.line].append((r.seq, r.y, r.x, r.closed))
    lines = {k: sorted(v) for k, v in got.items()}
    of = lambda t: [v for (tile, _), v in lines.items() if tile == t]
    (ring,), (open_,) = of("hill"), of("ramp")
    assert ring[0][3] and all(abs(math.hypot(a - 5.3, b - 6.2) - 4) < 0.1 for _, a, b, _ in ring) and len(ring) > 20
    assert not open_[0][3] and all(math.isclose(b + 0.25 * a, 6.0) for _, a, b, _ in open_) and {open_[0][1], open_[-1][1]} == {0.0, 11.0}
    assert len(of("saddle")) == 2 and all(len(v) == 2 for v in of("saddle"))
    vertices = Counter((a, b) for v in of("noise") for _, a, b, _ in v)
    want = {(float(r), c + (6 - noise[r, c]) / (noise[r, c + 1] - noise[r, c])) for r in range(20) for c in range(19) if (noise[r, c] > 6) != (noise[r, c + 1] > 6)}
    want |= {(r + (6 - noise[r, c]) / (noise[r + 1, c] - noise[r, c]), float(c)) for r in range(19) for c in range(20) if (noise[r, c] > 6) != (noise[r + 1, c] > 6)}
    want = {p for p in want if not math.isnan(p[0] + p[1]) and not (abs(p[0] - 4) < 1 and p[1] == 4.0) and not (p[0] == 4.0 and abs(p[1] - 4) < 1)}
    assert max(vertices.values()) == 1 and set(vertices) == want
    for v in of("noise"):
        steps = list(zip(v, v[1:], strict=False)) + ([(v[-1], v[0])] if v[0][3] else [])
        assert all(abs(a[1] - b[1]) <= 1 and abs(a[2] - b[2]) <= 1 for a, b in steps)
    assert L.contours(tiles(spark, {"flat": np.ones((3, 3))}), "v", 6.0).count() == 0


def brute_skeleton(on):
    on = set(on)
    while True:
        before = len(on)
        for second in (False, True):
            gone = [p for p in on if L.removable(sum(((p[0] + i, p[1] + j) in on) << k for k, (i, j) in enumerate(L.AROUND)), second)]
            on -= set(gone)
        if len(on) == before:
            return on


def pieces_of(on):
    on, n = set(on), 0
    while on:
        n, todo = n + 1, [on.pop()]
        while todo:
            r, c = todo.pop()
            near = {(r + i, c + j) for i, j in L.AROUND} & on
            on -= near
            todo += near
    return n


def test_skeleton(spark):
    y, x = np.mgrid[0:30, 0:34]
    mask = (np.abs(y - 8) < 3) | (np.abs(x - 10) < 4) | (np.abs(np.hypot(y - 20, x - 24) - 7) < 2)
    on = [(int(r), int(c)) for r, c in zip(*np.nonzero(mask), strict=True)]
    got = {(r.row, r.col) for r in L.skeleton(spark.createDataFrame([("t", *p) for p in on], "tile string, row int, col int")).collect()}
    assert got == brute_skeleton(on) and len(got) < len(on) / 3 and pieces_of(got) == pieces_of(on)
    assert not any({(r + i, c + j) for i in (0, 1) for j in (0, 1)} <= got and (r, c) in got and all((r + i, c + j) in got for i in (-1, 0, 1) for j in (-1, 0, 1)) for r, c in got)
    assert L.skeleton(spark.createDataFrame([], "tile string, row int, col int")).count() == 0


# -- registration


def test_box_tasks(spark, monkeypatch):
    """The pixels of a task stay as many when tiles grow: lines are dealt over tasks before their pixels are made, and sums along both axes have as many tasks."""
    monkeypatch.setattr(RF, "TASK", 500)
    df = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 299, 49, 2.0)], PIXELS)
    tasks = RF._tasks(RF._extent(df))
    assert tasks == 30 and RF._tasks(RF._extent(df.limit(0))) == 4
    for made in (RF.dense(df, ["v"]), RF.box_sums(RF.dense(df, ["v"]), ["v"], 2, tasks)):
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 15_000 and len(sizes) >= 15 and max(sizes) <= 3000
    assert RF.box_means(df, "v", 2).count() == 2


def test_coregistered(spark):
    """Sub-pixel shifts planted in smooth images are found and undone; a frame without an anchor, or of another shape, stays."""
    rng = np.random.Generator(np.random.PCG64(3))
    base = R.smooth(rng.random((48, 48)), 1.5)
    base = (base - base.min()) / (base.max() - base.min())
    planted = {1: (0.6, -1.3), 2: (-1.75, 0.5), 3: (0.0, 0.02)}
    frames = {("a", 0): base, ("b", 0): base, ("a", 9): rng.random((20, 20)), ("lone", 4): base} | {(t, s): R.shift_image(base, *d) for t in "ab" for s, d in planted.items()}
    frames["a", 1] = 1 - frames["a", 1] ** 2  # another season: values differ, places don't
    rows = [(t, s, int(r), int(c), float(a[r, c])) for (t, s), a in frames.items() for r, c in np.ndindex(*a.shape)]
    df = spark.createDataFrame(rows, "tile string, slot int, row int, col int, v double")
    got = R.coregistered(df, "v", 0).collect()
    assert len(got) == len(rows)
    shift, pixels = {}, {k: np.zeros(a.shape) for k, a in frames.items()}
    for r in got:
        shift[r.tile, r.slot] = (r.dy, r.dx)
        pixels[r.tile, r.slot][r.row, r.col] = r.v
    for (t, s), a in frames.items():
        if s in (1, 2):
            assert max(abs(shift[t, s][k] + planted[s][k]) for k in (0, 1)) <= 0.05
            assert np.allclose(pixels[t, s], R.shift_image(a, *shift[t, s]))
            if (t, s) != ("a", 1):
                assert np.abs(pixels[t, s] - base)[6:-6, 6:-6].max() < 0.05
        else:
            assert shift[t, s] == (0.0, 0.0) and (pixels[t, s] == a).all()
    chosen = spark.createDataFrame([("a", 2), ("b", 2)], "tile string, slot int")
    by = {(r.tile, r.slot): (r.dy, r.dx) for r in R.register_frames(df.where("slot < 3"), "v", chosen).collect()}
    assert by["b", 2] == (0.0, 0.0) and abs(by["b", 0][0] + 1.75) <= 0.05 and abs(by["b", 0][1] - 0.5) <= 0.05


def test_coregistered_lines(spark):
    """Frames in strips: the shift is that of the whole frame, and no task has more of a frame than its strip."""
    rng = np.random.Generator(np.random.PCG64(5))
    base = R.smooth(rng.random((400, 24)), 1.5)
    base = (base - base.min()) / (base.max() - base.min())
    frames = {("a", 0): base, ("a", 1): R.shift_image(base, 0.7, -1.25), ("a", 2): base[:300], ("b", 1): base} | {("a", 3): np.roll(base, (2, -1), (0, 1))}
    df = spark.createDataFrame([(t, s, r, a[r].tolist()) for (t, s), a in frames.items() for r in range(len(a))], "tile string, slot int, row int, v array<double>")
    got = [r for r in R.coregistered_lines(df, "v", 0, strip=3000).collect()]
    for (t, s), a in frames.items():
        mine = sorted((r for r in got if (r.tile, r.slot) == (t, s)), key=lambda r: r.strip)
        assert np.concatenate([r.line for r in mine]).shape == (a.size,) and len({(r.dy, r.dx) for r in mine}) == 1
        if s in (1, 3) and t == "a":
            assert len(mine) == 3 and max(len(r.line) for r in mine) < 3500
            want = {1: (-0.7, 1.25), 3: (-2, 1)}[s]
            assert max(abs(mine[0].dy - want[0]), abs(mine[0].dx - want[1])) <= 0.05
            assert np.abs(np.concatenate([r.line for r in mine]) - base.ravel()).max() < 0.05
            assert (np.concatenate([r.fixed for r in mine]) == base.ravel()).all()
        else:
            assert (mine[0].dy, mine[0].dx) == (0.0, 0.0) and (np.concatenate([r.line for r in mine]) == a.ravel()).all()
            assert s == 0 or all(r.fixed is None for r in mine)


@pytest.mark.parametrize("strip", [1 << 18, 40])
def test_line_means(spark, monkeypatch, strip):
    monkeypatch.setattr(RF, "STRIP", strip)
    rng = np.random.Generator(np.random.PCG64(6))
    a = {"a": rng.random((37, 9)), "b": rng.random((3, 5))}
    sparse = {k: np.where(rng.random(v.shape) < 0.2, v, np.nan) for k, v in a.items()}
    for v in sparse.values():
        v[-1, -1] = 0.5
        v[8:20] = np.nan
    got = {(r.tile, r.row): r for r in RF.line_means(tiles(spark, sparse), "v", 3).collect()}
    assert len(got) == 40
    for (t, row), r in got.items():
        full = np.nan_to_num(sparse[t])
        assert (r.h, r.w) == full.shape and np.allclose(r.line, [full[max(0, row - 3) : row + 4, max(0, c - 3) : c + 4].mean() for c in range(r.w)])


def test_smoothed(spark):
    rng = np.random.Generator(np.random.PCG64(4))
    a = holed(rng, (14, 17))
    got = image(R.smoothed(tiles(spark, {"a": a}), "v", 1.2, 3).collect(), a.shape, "v")
    for r, c in np.ndindex(*a.shape):
        near = [(math.exp(-((r - y) ** 2 + (c - x) ** 2) / 2.88), a[y, x]) for y in range(max(0, r - 3), min(14, r + 4)) for x in range(max(0, c - 3), min(17, c + 4)) if not np.isnan(a[y, x])]
        assert np.isnan(a[r, c]) == np.isnan(got[r, c]) and (np.isnan(a[r, c]) or math.isclose(got[r, c], sum(w * v for w, v in near) / sum(w for w, _ in near)))


# -- draws, grids, percentiles, runs


def test_draws(spark):
    """As many draws as asked for, each at the row whose span on the line of weights it falls in."""
    rows = [(i, float(w)) for i, w in enumerate(random.Random(3).choices([0, 1, 2, 7, 100], k=300))] + [(900, None), (901, -3.0)]
    got = {r.id: r.draws for r in SP.with_replacement(spark.createDataFrame(rows, "id int, w double"), "w", "id", 5000, 42, buckets=9).collect()}
    live = [(i, w) for i, w in rows if w and w > 0]
    ends = np.cumsum([w for _, w in live]).tolist()
    want = Counter(live[bisect.bisect_right(ends, int(hashlib.md5(f"42:{k}".encode()).hexdigest()[:13], 16) / 2**52 * ends[-1])][0] for k in range(5000))
    assert got == dict(want) and sum(got.values()) == 5000
    assert SP.with_replacement(spark.createDataFrame(rows, "id int, w double").limit(0), "w", "id", 10, 1).count() == 0


def test_interpolated_grid(spark):
    """Inside, on nodes, beyond the edges, and with an axis of one entry."""
    rng = np.random.Generator(np.random.PCG64(7))
    grids = {"a": (np.array([0.0, 10, 25, 40]), np.array([3.0, 9, 11, 30, 31])), "line": (np.array([5.0]), np.array([0.0, 10, 20])), "point": (np.array([1.0]), np.array([2.0]))}
    values = {k: rng.random((len(ys), len(xs))) for k, (ys, xs) in grids.items()}
    lut = spark.createDataFrame([(k, float(y), float(x), float(values[k][i, j])) for k, (ys, xs) in grids.items() for i, y in enumerate(ys) for j, x in enumerate(xs)], "key string, line double, pixel double, gain double")
    places = [(k, n, float(y), float(x)) for k in grids for n, (y, x) in enumerate([*rng.uniform(-5, 50, (60, 2)), (0, 3), (10, 9), (40, 31), (25, 30), (-9, 99)])]
    got = Q.interpolated_grid(spark.createDataFrame(places, "key string, n int, r double, c double"), lut, ["key"], "r", "c", "line", "pixel", "gain").collect()
    assert len(got) == len(places)
    for r in got:
        ys, xs = grids[r.key]
        along = [np.interp(r.c, xs, row) for row in values[r.key]]
        assert math.isclose(r.gain, np.interp(r.r, ys, along), rel_tol=1e-12)


@pytest.mark.parametrize("n", [1, 2, 500, 5000])
def test_percentiles_of_all(spark, n):
    rng = np.random.Generator(np.random.PCG64(n))
    v = np.where(rng.random(n) < 0.4, 3.0, rng.lognormal(0, 3, n))
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    shares = [0.0, 0.01, 0.37, 0.5, 0.99, 1.0]
    r = A.exact_percentiles(df, "v", shares).first()
    assert r.n == n and np.allclose(r.p, np.quantile(v, shares), rtol=1e-12)
    empty = A.exact_percentiles(df.where("v IS NULL"), "v", [0.5]).first()
    assert empty.n is None and empty.p == [None]


def test_circuit(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(6), t // 2, t, rng.random() < 0.6) for t in range(120)] + [(7, 1, 1, True), (7, 2, 2, True), (8, 1, 1, False), (9, 3, 3, None)]
    got = {r.s: (r.failures, r.state) for r in C.circuit(spark.createDataFrame(rows, "s int, t int, e int, bad boolean"), "s", ["t", "e"], F.col("bad"), 2).collect()}
    for s in {r[0] for r in rows}:
        run = 0
        for r in sorted((r for r in rows if r[0] == s), key=lambda r: (r[1], r[2]), reverse=True):
            if not r[3]:
                break
            run += 1
        assert got[s] == (run, "dead" if run >= 2 else "alive")


# -- scores, components, rings


def test_plot_report(spark):
    """Accuracy, hits and both areas against a loop over thresholds; a class of one kind gives NaN."""
    rng = random.Random(8)
    rows = [(rng.choice([None, 0, 1, 2, 2]), rng.choice([0, 1, 2]), [rng.randrange(6) / 5 for _ in range(4)]) for _ in range(300)]
    got = {r["class"]: r for r in M.plot_report(spark.createDataFrame(rows, "t int, p int, s array<double>"), "t", "p", "s", [1, 2, 3]).collect()}
    known = [r for r in rows if (r[0] or 0) >= 1]
    assert set(got) == {1, 2}
    for c, r in got.items():
        pos, neg = [x[2][c] for x in rows if x[0] == c], [x[2][c] for x in rows if x[0] != c]
        pairs = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
        curve = [(sum(a >= k for a in pos) / len(pos), sum(a >= k for a in pos) / sum(a >= k for a in pos + neg)) for k in sorted(set(pos + neg), reverse=True)]
        curve = [(0.0, curve[0][1]), *curve]
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:], strict=False))
        assert math.isclose(r.auroc, pairs) and math.isclose(r.aupr, area)
        assert (r.plots, r.right) == (len(pos), sum(x[0] == c == x[1] for x in rows))
        assert r.n_known == len(known) and math.isclose(r.accuracy, sum(a == b for a, b, _ in known) / len(known))
    one = M.curves_by_class(spark.createDataFrame([(1, 0.5), (1, 0.7)], "c int, s double"), "c", "s", F.col("s") > 0).first()
    assert math.isnan(one.auroc) and math.isnan(one.aupr)


def test_principal_components(spark):
    rng = np.random.Generator(np.random.PCG64(6))
    x = rng.standard_normal((200, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.1]) @ np.linalg.qr(rng.standard_normal((6, 6)))[0]
    got = A.principal_components(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, v array<double>"), "v", 3).orderBy("i").collect()
    _, _, axes = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    axes = axes[:3] * np.sign([a[np.argmax(np.abs(a))] for a in axes[:3]])[:, None]
    assert np.allclose([r.components for r in got], x @ axes.T)


def test_rings_go_back(spark):
    df = spark.createDataFrame([(300000.0, 6500000.0), (612345.0, 7123456.0)], "e double, n double")
    ring = df.select(F.explode(S.box_ring("e", "n", F.col("e") + 2560, F.col("n") + 1280)).alias("c"), "e", "n").select("e", "n", S.to_grid("c.lat", "c.lon").alias("g"), "c.*").collect()
    for k in (0, 5):
        corners = [(r.g.easting - r.e, r.g.northing - r.n) for r in ring[k : k + 5]]
        assert np.allclose(corners, [(0, 0), (2560, 0), (2560, 1280), (0, 1280), (0, 0)], atol=1e-3) and all(55 < r.lat < 70 and 8 < r.lon < 25 for r in ring)


def test_background_date(spark):
    day = lambda t: dt.date.fromisoformat(t)
    rows = [("a", day("2016-06-02"), True), ("a", day("2016-07-05"), False), ("a", day("2015-07-09"), True), ("b", day("2015-06-01"), True), ("b", day("2015-08-16"), True), ("b", day("2016-08-17"), True), ("c", day("2017-07-01"), True), ("d", day("2016-07-08"), True), ("d", day("2016-07-10"), True)]
    got = W.background_date(spark.createDataFrame(rows, "t string, day date, ok boolean"), "t", "day", "ok").collect()
    assert {r.t: str(r.day) for r in got} == {"a": "2016-06-02", "b": "2015-06-01", "d": "2016-07-08"}


def test_analyzers_from_a_file(spark, tmp_path):
    """Settings from JSON as from YAML; what lacks a band fails by itself, and what needs the failed one's result fails too."""
    from skyquilt.plans import analyzers

    assert analyzers.load_settings(analyzers.SETTINGS)["cot"]["enabled"] is False and analyzers.load_settings(str(tmp_path / "none.json")) is None
    (tmp_path / "s.yaml").write_text("cot:\n  enabled: false\n  thin: 0.02\nnmd:\n")
    if importlib.util.find_spec("yaml"):
        assert analyzers.load_settings(str(tmp_path / "s.yaml")) == {"cot": {"enabled": False, "thin": 0.02}, "nmd": {"enabled": True}}
    path = tmp_path / "s.json"
    path.write_text('{"change_detection": {"min_region_pixels": 1}, "nmd": null, "water_quality": {"k": 1.0}, "spectral": {"enabled": false}}')
    rows = [("t", r, c, 1, 0.2, 0.3, 0.4 + 0.1 * c, 0.5, 0.3) for r in range(3) for c in range(3)]
    df = spark.createDataFrame(rows, "tile string, row long, col long, cls int, green double, red double, edge double, nir double, nir0 double")
    got = {(r.analyzer, r.state): r.value for r in analyzers.analyze(df, analyzers.load_settings(str(path))).where("measure IS NULL OR measure = 'mci'").collect()}
    assert set(got) == {("change_detection", "failed"), ("spectral", "off"), ("nmd", "failed"), ("cot", "off"), ("vegetation_edge", "off"), ("water_quality", "done")}
    assert math.isclose(got["water_quality", "done"], 0.0, abs_tol=1e-12)
    whole = analyzers.analyze(df.withColumn("red0", F.col("red") + F.col("col") * 0.2), analyzers.load_settings(str(path))).collect()
    assert {r.measure: r.value for r in whole if r.analyzer == "change_detection"} == {"changed": 1.0, "regions": 1.0, "region_pixels": 9.0}


def test_change_at_the_limit(spark):
    """A mean at the limit isn't above it, in whatever order its values are added."""
    from skyquilt.plans.registry import ANALYZERS

    orders = [[0.1, 0.05, 0.0], [0.0, 0.05, 0.1], [0.05, 0.0, 0.1]]
    assert sum(orders[0]) / 3 > 0.05
    df = spark.createDataFrame([(k, v) for k, order in enumerate(orders) for v in order] + [(99, 0.051)], "key int, value double").coalesce(1)
    results = ANALYZERS.run(df, {"brightness": {"key": "key"}, "change": {"above": 0.05}})
    assert [r["key"] for r in results[1].output.collect()] == [99]


def test_superpixels_keep_pixels_single(spark, monkeypatch):
    """A pixel stays one row when it meets the centres around it; the classes by all votes come from one pass."""
    written, table = [], RF._table
    monkeypatch.setattr(RF, "_table", lambda df: (written.append(df._jdf.queryExecution().optimizedPlan().toString()), table(df))[1])
    df = spark.createDataFrame([("t", i, j, float((i * 7 + j) % 5)) for i in range(12) for j in range(12)], "tile string, row long, col long, v double")
    got = RF.superpixels(df, ["v"], 4, 1.0, 2)
    assert got.count() == 144 and len(written) == 3
    assert not any(line.lstrip(" :+-").startswith("Aggregate [tile#") and " row#" in line.split("]")[0] for plan in written for line in plan.splitlines())
    p = spark.createDataFrame([(k % 3, k % 4, (k * 37 % 100) / 100) for k in range(200)], "segment long, cls int, p double")
    modes = ["mean_prob", "majority_vote", "weighted_mean"]
    at_once = {r.segment: tuple(r[m] for m in modes) for r in A.segment_votes(p, "segment", "cls", "p", modes).collect()}
    single = [{r.segment: r.cls for r in A.segment_vote(p, "segment", "cls", "p", m).collect()} for m in modes]
    assert at_once == {s: tuple(x[s] for x in single) for s in range(3)}
