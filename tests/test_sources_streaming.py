import datetime as dt
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyquilt.operators import control
from skyquilt.sources import committed
from skyquilt.sources import tables as T
from skyquilt.streaming import stateful
from skyquilt.streaming import streams as ST

DATA = "/root/testdata/sf0.001"


def test_catalogue_pages(spark, tmp_path):
    page = lambda ids, nxt: {"features": [{"id": i, "properties": {"datetime": f"2022-06-0{i[-1]}T10:00:00Z", "eo:cloud_cover": c}} for i, c in ids], "links": [{"rel": "next", "href": nxt}] if nxt else []}
    (tmp_path / "page1.json").write_text(json.dumps(page([("s1", 10), ("s2", None)], "page2")))
    (tmp_path / "page2.json").write_text(json.dumps(page([("s3", 5.5), ("s4", 0)], None)))
    (tmp_path / "loop.json").write_text(json.dumps(page([("s5", 1)], "loop")))
    spark.dataSource.register(T.CatalogueSource)
    got = spark.read.format("catalogue").option("path", str(tmp_path)).load().orderBy("scene_id").collect()
    assert [(r.scene_id, r.date, r.cloud) for r in got] == [("s1", "2022-06-01", 10.0), ("s2", "2022-06-02", None), ("s3", "2022-06-03", 5.5), ("s4", "2022-06-04", 0.0)]
    with pytest.raises(Exception, match="linked after 7 pages"):  # never fewer rows without a word
        spark.read.format("catalogue").option("path", str(tmp_path)).option("first", "loop").option("max_pages", "7").load().count()


def test_survey_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("POINT_ID,GPS_LAT,GPS_LONG,LC1,NUTS0,SURVEY_YEAR\n1,59.1,15,B11,SE,2018\n1,59.1,15,B14,SE,15/06/2022\n2,50,10,B11,DE,2022\n3,x,15,B11,SE,2022\n")
    names = {"point_id": ["point_id"], "lat": ["th_lat", "gps_lat"], "lon": ["th_long", "gps_long"], "code": ["lc1"], "country": ["nuts0"], "year": ["survey_year", "year"]}
    got = T.survey_points(spark, str(tmp_path / "a.csv"), names, "SE", 2018).orderBy("point_id").collect()
    assert [(r.point_id, r.code, r.year, r.lat) for r in got] == [("1", "B14", 2022, 59.1), ("3", "B11", 2022, None)]


def test_features_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 4.0)], "name string, west double, south double, east double, north double")
    feature = T.as_features(df, ("west", "south", "east", "north"), ["name"]).collect()[0].value
    (tmp_path / "f.json").write_text(json.dumps({"type": "FeatureCollection", "features": [json.loads(feature)]}))
    assert tuple(T.feature_boxes(spark, str(tmp_path / "f.json"), ["name"]).collect()[0]) == ("a", 1.0, 2.0, 3.0, 4.0)


def test_manifest_ignores_order(spark, tmp_path):
    for name, text in (("x", "1"), ("y", "2")):
        (tmp_path / name).write_text(text)
    d = T.file_digests(spark, str(tmp_path))
    a, b = T.manifest(d).collect()[0], T.manifest(d.orderBy(F.desc("path"))).collect()[0]
    assert a == b and a.files == 2 and a.bytes == 2


def test_npz_tiles_and_logs(spark, tmp_path):
    np.savez(tmp_path / "t1.npz", label=np.arange(4).reshape(2, 2))
    (tmp_path / "bad.npz").write_bytes(b"no archive")
    got = T.read_tiles(spark, str(tmp_path), ["label", "none"]).collect()
    assert [(r.tile, r.array, r["shape"], r["values"]) for r in got] == [("t1", "label", [2, 2], [0.0, 1.0, 2.0, 3.0])]
    lines = spark.createDataFrame([("Epoch 3 loss=0.25 mIoU: 0.41",), ("noise",)], "value string")
    assert [tuple(r) for r in T.log_rows(lines).collect()] == [(3, 0.25, 0.41)]


def test_split_lists_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([("val", "b"), ("train", "c"), ("train", "a")], "split string, name string")
    T.write_splits(df, "split", "name", str(tmp_path / "s"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "s" / "split=train")).collect()) == ["a", "c"]
    committed.replace_parts(spark.createDataFrame([(1, "x"), (2, "y")], "v int, p string"), str(tmp_path / "p"), "p")
    committed.replace_parts(spark.createDataFrame([(3, "y")], "v int, p string"), str(tmp_path / "p"), "p")
    assert sorted((r.v, r.p) for r in committed.read_parts(spark, str(tmp_path / "p")).collect()) == [(1, "x"), (3, "y")]


def _events(spark, tmp_path):
    e = spark.read.parquet(f"{DATA}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.repartition(3).write.parquet(str(tmp_path / "events"))
    return e, ST.file_stream(spark, str(tmp_path / "events"), e.schema)


def test_stream_equals_batch(spark, tmp_path):
    batch, stream = _events(spark, tmp_path)
    f = lambda x: ST.window_counts(x, "ts", "14 days", None, ["event_type"], "value", "60 days")
    got = ST.run_once(f(stream), "windows", "complete", str(tmp_path / "c1"))
    assert sorted((str(r.start), r.event_type, r.n) for r in got.collect()) == sorted((str(r.start), r.event_type, r.n) for r in f(batch).collect())
    got = ST.run_once(ST.running_stats(stream, ["event_type"], "value"), "stats", "complete", str(tmp_path / "c2"))
    assert {r.event_type: r.n for r in got.collect()} == {r.event_type: r.n for r in ST.running_stats(batch, ["event_type"], "value").collect()}


def test_adaptive_limits(spark, tmp_path):
    now = dt.datetime(2024, 1, 1)
    rows = [("a", now + dt.timedelta(seconds=i), i != 7) for i in range(12)]
    spark.createDataFrame(rows, "source string, ts timestamp, ok boolean").coalesce(1).write.parquet(str(tmp_path / "r"))
    stream = ST.file_stream(spark, str(tmp_path / "r"), "source string, ts timestamp, ok boolean")
    got = ST.run_once(ST.adaptive_limits(stream, "source", "ts", "ok", up_after=3), "limits", "update", str(tmp_path / "c3")).collect()
    limit, run = 4, 0
    for _, _, ok in rows:
        limit, run = ST.adapt(limit, ok, run, 3, 1, 32)
    assert [(r.source, r.limit, r.events) for r in got] == [("a", limit, 12)]


def test_upsert(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    sink = committed.upsert_into(path, ["k"], F.col("v"))
    sink(spark.createDataFrame([(1, 1), (2, 5)], "k int, v int"), 0)
    sink(spark.createDataFrame([(1, 3), (2, 4), (3, 0)], "k int, v int"), 1)
    sink(spark.createDataFrame([(1, 9)], "k int, v int"), 1)  # a batch that comes again
    assert sorted(tuple(r) for r in committed.read_parts(spark, path).collect()) == [(1, 3), (2, 5), (3, 0)]


def test_commit_is_whole(spark, tmp_path, monkeypatch):
    """A task that fails, or a driver that stops before the last step, leaves the table readable as it was."""
    path = str(tmp_path / "t")
    rows = lambda n: spark.range(n).select("id", (F.col("id") % 3).alias("p"))
    held = lambda: sorted(tuple(r) for r in committed.read_parts(spark, path).collect())
    with pytest.raises(FileNotFoundError):
        held()
    assert committed.replace_parts(rows(6), path, "p") == 1
    before = held()
    with pytest.raises(Exception, match="no such row"):
        committed.replace_parts(rows(50).withColumn("id", F.when(F.col("id") == 49, F.raise_error(F.lit("no such row")).cast("long")).otherwise(F.col("id"))), path, "p")
    assert held() == before
    with monkeypatch.context() as m:
        m.setattr(committed._Folder, "put", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            committed.replace_parts(rows(50), path, "p")
    assert held() == before
    old = committed.read_parts(spark, path)
    assert committed.replace_parts(rows(100).where("p = 1"), path, "p") == 2
    assert len(held()) == 4 + 33 and sorted(tuple(r) for r in old.collect()) == before  # a reader keeps what it has opened
    assert committed.read_parts(spark, path, {"1"}.__contains__).count() == 33 and committed.read_parts(spark, path, version=1).count() == 6
    with pytest.raises(FileExistsError):
        committed._Folder(spark, path).put("{}", "_manifests", f"{2:012d}.json")
    assert committed.discard_old(spark, path) > 0 and len(held()) == 37 and committed.manifests(spark, path) == [2]


def test_catalogue_stream(spark, tmp_path):
    """Pages that are linked later are read by the next run, and none twice."""
    spark.dataSource.register(T.CatalogueSource)
    df = spark.range(95).select("id", F.concat(F.lit("s"), "id").alias("scene"), F.lit("2024-05-06").alias("day"), F.when(F.col("id") % 4 > 0, F.col("id") / 10).alias("cloud"))
    folder = str(tmp_path / "pages")
    run = lambda: stateful.run_available(spark.readStream.format("catalogue").option("path", folder).load(), str(tmp_path / "out"), str(tmp_path / "state"))
    assert T.write_catalogue(df, "id", "scene", "day", "cloud", folder, 10, last=4) == 4
    run()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40
    run()
    T.write_catalogue(df, "id", "scene", "day", "cloud", folder, 10)
    run()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.scene_id for r in got) == sorted(f"s{i}" for i in range(95)) and {r.cloud for r in got if r.scene_id in ("s4", "s5")} == {None, 0.5}
    assert spark.read.format("catalogue").option("path", folder).load().count() == 95


def _claims(n, keys, seed):
    rng, at = random.Random(seed), dt.datetime(2024, 1, 1)
    for i in range(n):
        at += dt.timedelta(minutes=rng.choice([0, 1, 5, 30, 200, 700]))
        yield rng.randrange(keys), at, i, rng.choice("ab"), rng.choice(["claim", "claim", "release"])


def _brute_claims(rows, stale, end):
    out, held = [], {}
    us = lambda t: round(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    for k, at, _, who, action in rows:
        t = us(at)
        if k in held and t - held[k][2] >= stale:
            h = held.pop(k)
            out.append((k, h[0], h[1], h[2] + stale, "stale"))
        if action == "claim" and held.get(k, (who,))[0] == who:
            held[k] = (who, held[k][1] if k in held else t, t)
        elif action == "claim":
            out.append((k, who, t, t, "denied"))
        elif k in held and held[k][0] == who:
            h = held.pop(k)
            out.append((k, h[0], h[1], t, "released"))
    out += [(k, h[0], h[1], h[2] + stale, "stale") for k, h in held.items() if h[2] + stale < us(end) - 1_000_000]  # the watermark is a second behind
    return sorted(out)


@pytest.mark.parametrize("files", [1, 4])
def test_claims_stream(spark, tmp_path, files):
    """Whatever the batches: claims renewed, denied, released and gone stale; a restart in the middle changes nothing."""
    rows = list(_claims(400, 12, 5))
    schema, step = "k long, ts timestamp, event long, who string, action string", -(-len(rows) // files)
    def put(part):
        spark.createDataFrame(rows[part * step : (part + 1) * step], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    def run():
        stateful.run_available(stateful.closed_claims(ST.file_stream(spark, str(tmp_path / "in"), schema, 1), "k"), str(tmp_path / "out"), str(tmp_path / "state"))
    for part in range(files):
        put(part)
        if part % 2:
            run()
    run()
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == _brute_claims(rows, 6 * 3_600_000_000, rows[-1][1]) and {r[4] for r in got} == {"stale", "denied", "released"}


def test_limits_and_jobs_streams(spark, tmp_path):
    rng, now = random.Random(2), dt.datetime(2024, 1, 1)
    rows = [(rng.randrange(5), now + dt.timedelta(seconds=i // 2), i, rng.random() < 0.8, rng.choice(["submit", "start", "done", "error"])) for i in range(200)]
    schema = "k long, ts timestamp, event long, ok boolean, kind string"
    for part in range(2):
        spark.createDataFrame(rows[part * 100 : (part + 1) * 100], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ST.file_stream(spark, str(tmp_path / "in"), schema, 1)
    stateful.run_available(stateful.concurrency_limits(stream, "k", up_after=3), str(tmp_path / "limits"), str(tmp_path / "s1"))
    want = {}
    for k in range(5):
        limit, run, n = 4, 0, 0
        for r in rows:
            if r[0] == k:
                limit, run = ST.adapt(limit, r[3], run, 3, 1, 32)
                n += 1
        want[k] = (limit, n)
    last = lambda path, c: {r.k: (r[c], r.events) for r in spark.read.parquet(str(tmp_path / path)).groupBy("k").agg(F.max_by(c, "events").alias(c), F.max("events").alias("events")).collect()}
    assert last("limits", "limit") == want
    stateful.run_available(stateful.job_states(stream, "k"), str(tmp_path / "jobs"), str(tmp_path / "s2"))
    batch = control.job_states(spark.createDataFrame(rows, schema), "k", ["ts", "event"], "kind")
    assert last("jobs", "state") == {r.k: (r.state, r.events) for r in batch.collect()}


def test_keys_share_states(spark, tmp_path):
    """Keys, null among them, share the states of a few buckets; calls of Python number as the buckets, and claims of one bucket go stale at their own times."""
    rows = [(None if i % 50 == 0 else i % 50, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), i, "x", "claim", i % 5 > 0, "start") for i in range(200)]
    schema = "k long, ts timestamp, event long, who string, action string, ok boolean, kind string"
    for part in range(2):
        spark.createDataFrame(rows[part * 100 : (part + 1) * 100], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream, calls = ST.file_stream(spark, str(tmp_path / "in"), schema, 1), spark.sparkContext.accumulator(0)

    class Counted(stateful._Jobs):
        def handleInputRows(self, key, rows, timerValues):
            calls.add(1)
            yield from super().handleInputRows(key, rows, timerValues)

    before, stateful._Jobs = stateful._Jobs, Counted
    try:
        stateful.run_available(stateful.job_states(stream, "k", buckets=3), str(tmp_path / "jobs"), str(tmp_path / "s1"))
    finally:
        stateful._Jobs = before
    assert 0 < calls.value <= 2 * 4
    got = {(r.k, r.events): r.state for r in spark.read.parquet(str(tmp_path / "jobs")).collect()}
    assert got == {(k or None, n): "RUNNING" for k in range(50) for n in (2, 4)}
    stateful.run_available(stateful.closed_claims(stream, "k", stale_hours=4, buckets=3), str(tmp_path / "claims"), str(tmp_path / "s2"))
    micros = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    want = [(k, "x", micros(ts), micros(ts) + 4 * 3_600_000_000, "stale") for k, ts, *_ in rows if micros(ts) + 4 * 3_600_000_000 < micros(rows[-1][1]) - 1_000_000]
    assert sorted((tuple(r) for r in spark.read.parquet(str(tmp_path / "claims")).collect()), key=lambda r: r[2]) == want


def test_files_share_folders(spark, tmp_path):
    """A file a row, many a folder; what is read back is what was written."""
    n = T.write_files(spark.range(300).selectExpr("id", "concat('name ', id) AS name"), "id", "name", f"file://{tmp_path}/in", folders=8)
    d = T.file_digests(spark, str(tmp_path / "in")).collect()
    assert n == len(d) == 300 and len(list((tmp_path / "in").iterdir())) == 8
    assert (tmp_path / "in").joinpath(*next(r.path for r in d if r.path.endswith("/42")).split("/")[-2:]).read_text() == "name 42\n"


def test_pages_share_tasks(tmp_path):
    """A task of a catalogue's stream has a run of pages; every page is in one of them, in order."""
    for k in range(1, 301):
        links = [{"rel": "next", "href": f"page{k + 1}"}] if k < 300 else []
        (tmp_path / f"page{k}.json").write_text(json.dumps({"features": [{"id": str(k), "properties": {"datetime": "2020-01-01"}}], "links": links}))
    stream = T.CatalogueStream({"path": str(tmp_path)})
    tasks = stream.partitions({"page1": 10}, stream.latestOffset())
    assert len(tasks) == 58 and [r[0] for t in tasks for r in stream.read(t)] == [str(k) for k in range(11, 301)]
    assert len(stream.partitions({"page1": 290}, {"page1": 300})) == 10 and stream.partitions({"page1": 300}, {"page1": 300}) == []
