"""Every query with an oracle against DuckDB on the smallest tables, and plan checks."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from skyquilt.operators import iterative as I
from skyquilt.operators import joins as J
from skyquilt.plans import audit_bindings, bindings, kernel_bindings, refine_bindings, scene_bindings, score_bindings, stream_bindings  # noqa: F401  the others add their queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v + 0.0:.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return str(v)


@pytest.mark.parametrize("name", sorted(bindings.ORACLE_SQL))
def test_oracle(spark, name):
    df = bindings.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    rel = con.sql(bindings.ORACLE_SQL[name])
    at = [rel.columns.index(c) for c in cols]
    assert len(rel.columns) == len(cols)
    assert got == sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(bindings.QUERIES) - set(bindings.ORACLE_SQL)))
def test_runs(spark, name):
    assert bindings.QUERIES[name](spark, DATA).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_joins_have_no_nested_loop(spark):
    for name in ("plot_in_tile", "interval_overlap", "nearest_scene"):
        assert "NestedLoop" not in plan(bindings.QUERIES[name](spark, DATA)) and "Cartesian" not in plan(bindings.QUERIES[name](spark, DATA))


def test_filters_reach_the_scan(spark, tmp_path):
    from skyquilt.sources import tables as T

    boxes = spark.range(2000).select(*[(F.col("id") * 1000.0 + k).alias(c) for c, k in zip(T.BOX, (0, 0, 500, 500), strict=True)])
    T.write_clustered(boxes, str(tmp_path / "boxes"), partitions=4)
    got = T.read_box(spark, str(tmp_path / "boxes"), 10_000, 10_000, 20_000, 20_000)
    assert got.count() == 11
    assert all(f"GreaterThanOrEqual({T.BOX[k]}" in plan(got) for k in (2, 3)) and "LessThanOrEqual" in plan(got)


def test_boxes_pair_once(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0, 250.0, 250.0)], "i int, w double, s double, e double, n double")
    b = spark.createDataFrame([(2, 50.0, 50.0, 300.0, 300.0), (3, 250.0, 0.0, 260.0, 10.0), (4, 251.0, 0.0, 260.0, 10.0)], "j int, w2 double, s2 double, e2 double, n2 double")
    got = J.overlapping_boxes(a, b, ("w", "s", "e", "n"), ("w2", "s2", "e2", "n2"), 100).select("i", "j").collect()
    assert sorted(tuple(r) for r in got) == [(1, 2), (1, 3)]


def test_components_of_all_links(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/lineitem.parquet").selectExpr("l_suppkey * 2", "l_partkey * 2 + 1").distinct().collect()]
    rows += [(-k, -k - 1) for k in range(1, 60) if k % 7] + [(10_000 + k // 2, 10_000 + k) for k in range(1, 200)]
    parent = {x: x for r in rows for x in r}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in rows:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.id: r.component for r in I.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent} and len(set(got.values())) > 8


def test_linked_components_are_many(spark):
    got = bindings.QUERIES["linked_components"](spark, DATA).groupBy("component").agg(F.count("*").alias("n"))
    assert got.count() > 100 and got.agg(F.max("n")).first()[0] > 3


def test_linked_components_by_any_part(spark, tmp_path):
    """Orders that share a month of a part that isn't the least of either are linked; of other months they aren't."""
    import datetime as dt

    day = lambda m: dt.datetime(1996, m, 5)
    orders = [(1, 1, day(1)), (2, 2, day(1)), (3, 3, day(2)), (4, 3, day(3))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 5), (1, 9), (2, 6), (2, 9), (3, 9)], "l_orderkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.id: r.component for r in bindings.QUERIES["linked_components"](spark, str(tmp_path)).collect()}
    assert {k: got[k * 3] for k in range(1, 5)} == {1: 3, 2: 3, 3: 9, 4: 9} and len(got) == 11


@pytest.mark.parametrize("alone", [0, 40, 100_000])
def test_components_whatever_is_left_alone(spark, alone):
    edges = [(k * 7919 % 503, k * 104729 % 503 + 503) for k in range(420)] + [(k + 2000, k + 2001) for k in range(120)]
    parent = {x: x for edge in edges for x in edge}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.id: r.component for r in I.components(df, alone=alone).collect()} == {x: find(x) for x in parent}
    assert I.components(df.where("a < 0"), alone=alone).count() == 0


def test_components_by_key(spark):
    """The same as those of the links as edges: with keys of one node, of many, links that come twice, and none."""
    links = [(k * 7919 % 401 + 50, (k * 104729 % 503) + 1000 * (k % 2)) for k in range(600)] * 2 + [(900, 5000), (901, 5001), (902, 5001)]
    df = spark.createDataFrame([(a, -b if b < 500 else b + 2000) for a, b in links if b], "a long, b long")
    got, want = I.components_by_key(df, "a", "b").collect(), I.components(df).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len({r.component for r in got}) > 2
    assert I.components_by_key(df.where("a < 0"), "a", "b").count() == 0


def test_set_cover_takes_the_best_each_round(spark):
    nation = {r.s_suppkey: r.s_nationkey for r in spark.read.parquet(f"{DATA}/supplier.parquet").collect()}
    covers = {}
    for r in spark.read.parquet(f"{DATA}/lineitem.parquet").select("l_suppkey", "l_orderkey").collect():
        covers.setdefault(nation[r.l_suppkey], set()).add(r.l_orderkey)
    left, want = set().union(*covers.values()), []
    while left:
        best = min(covers, key=lambda k: (-len(covers[k] & left), k))
        want.append((best, len(covers[best] & left)))
        left -= covers[best]
    got = bindings.QUERIES["set_cover"](spark, DATA).orderBy("round").collect()
    assert [(r.s_nationkey, r.covered) for r in got] == want and len(want) > 3


def test_exact_percentiles(spark):
    import numpy as np

    from skyquilt.operators.aggregates import exact_percentiles

    rng = np.random.default_rng(0)
    rows = [(k, float(v)) for k in range(3) for v in rng.zipf(1.5, 500 * k + 1) % 1000] + [(0, None)]
    got = {r.k: r for r in exact_percentiles(spark.createDataFrame(rows, "k int, v double"), "v", [0.0, 0.013, 0.5, 0.99, 1.0], ["k"]).collect()}
    for k in range(3):
        v = [x for j, x in rows if j == k and x is not None]
        assert got[k].n == len(v) and np.allclose(got[k].p, np.percentile(v, [0, 1.3, 50, 99, 100]))
    assert exact_percentiles(spark.createDataFrame([], "v double"), "v", [0.5]).first().n is None


def test_ranks_by_any_columns(spark):
    from skyquilt.operators.sampling import with_rank

    rows = [("ab"[i % 2], None if i % 7 == 0 else i * 37 % 101, i) for i in range(300)]
    got = [(r.rank, r.x, r.y, r.z) for r in with_rank(spark.createDataFrame(rows, "x string, y int, z int"), ["x", "y", "z"], 8).orderBy("rank").collect()]
    want = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    assert [g[1:] for g in got] == want and [g[0] for g in got] == list(range(300))
