"""Parquet tables that are replaced part by part, and whose writes appear at once or not at all.

Rows go to a new folder, by Spark's own Parquet writer; a manifest lists the folder of every part of the table. A write becomes visible when the next manifest
gets its name, by one rename, after all files are there; a task that fails, or a driver that stops before, leaves the table as it was. Readers
hold on to the folders of the manifest they have read. There is one writer at a time: a second one finds its manifest's name taken, and fails.

A manifest has an entry a part, so parts are few (years, hash buckets). ``discard_old`` deletes the folders that the last manifests don't name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class _Folder:
    """A folder in any store that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self.path = lambda *names: jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))
        self.store = self.path().getFileSystem(spark._jsc.hadoopConfiguration())
        self.text = lambda stream: jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")

    def names(self, *below: str) -> list[str]:
        place = self.path(*below)
        return sorted(f.getPath().getName() for f in self.store.listStatus(place)) if self.store.exists(place) else []

    def read(self, *names: str) -> str:
        stream = self.store.open(self.path(*names))
        try:
            return self.text(stream)
        finally:
            stream.close()

    def put(self, text: str, *names: str) -> None:
        """A file that appears whole under its name, which must be free."""
        hidden = self.path(*names[:-1], f".{names[-1]}.{uuid.uuid4().hex}")
        out = self.store.create(hidden, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.store.exists(self.path(*names)) or not self.store.rename(hidden, self.path(*names)):
            self.store.delete(hidden, False)
            raise FileExistsError(f"{'/'.join(names)} was written by another")

    def delete(self, *names: str) -> None:
        self.store.delete(self.path(*names), True)


def manifests(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in _Folder(spark, path).names("_manifests") if n.endswith(".json") and not n.startswith(".")]


def current(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The last manifest, or that of a version: ``version``, ``schema``, ``parts`` and what the writer noted; None before the first write."""
    known = manifests(spark, path)
    if not known:
        return None
    return json.loads(_Folder(spark, path).read("_manifests", f"{known[-1] if version is None else version:012d}.json"))


def replace_parts(df: DataFrame, path: str, by: str | Column, **notes) -> int:
    """The parts that ``df`` has replace those of the table, the others stay; gives the new version. ``notes`` are kept in the manifest."""
    spark = df.sparkSession
    held = current(spark, path) or {"version": 0, "parts": {}}
    name = uuid.uuid4().hex
    part = F.coalesce((F.col(by) if isinstance(by, str) else by).cast("string"), F.lit("null"))
    df.withColumn("__part", part).write.partitionBy("__part").parquet(f"{path.rstrip('/')}/data/{name}")
    folder = _Folder(spark, path)
    new = {n.removeprefix("__part="): f"data/{name}/{n}" for n in folder.names("data", name) if n.startswith("__part=")}
    version = held["version"] + 1
    folder.put(json.dumps({**notes, "version": version, "schema": df.schema.json(), "parts": {**held["parts"], **new}}), "_manifests", f"{version:012d}.json")
    return version


def read_parts(spark: SparkSession, path: str, keep: Callable[[str], bool] | None = None, version: int | None = None) -> DataFrame:
    """The table as of its last version, or of an older one; of the parts only those whose name ``keep`` takes."""
    held = current(spark, path, version)
    if held is None:
        raise FileNotFoundError(f"no table at {path}")
    schema = StructType.fromJson(json.loads(held["schema"]))
    folders = [f"{path.rstrip('/')}/{f}" for n, f in sorted(held["parts"].items()) if keep is None or keep(n)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def discard_old(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete what the last ``keep`` manifests don't name; gives the number of folders deleted."""
    folder, versions = _Folder(spark, path), manifests(spark, path)
    named = {f for v in versions[-keep:] for f in current(spark, path, v)["parts"].values()}
    gone = 0
    for name in folder.names("data"):
        for part in folder.names("data", name):
            if part.startswith("__part=") and f"data/{name}/{part}" not in named:
                folder.delete("data", name, part)
                gone += 1
        if not any(f.startswith(f"data/{name}/") for f in named):
            folder.delete("data", name)
    for v in versions[:-keep]:
        folder.delete("_manifests", f"{v:012d}.json")
    return gone


def upsert_into(path: str, keys: list[str], version: Column, buckets: int = 64):
    """A ``foreachBatch`` sink that keeps the newest row of each key, in ``buckets`` parts by hash of the keys.

    A batch replaces the parts of its keys alone, all at once. Its number is in the manifest, so that one that comes again does nothing.
    """

    def sink(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = current(spark, path)
        if held is not None and held.get("batch", -1) >= number:
            return
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        every = batch
        if held is not None:
            touched = {str(r["b"]) for r in batch.select(bucket.alias("b")).distinct().collect()}  # at most ``buckets``
            every = batch.unionByName(read_parts(spark, path, touched.__contains__), allowMissingColumns=True)
        newest = every.groupBy(*keys).agg(F.max_by(F.struct(*every.columns), version).alias("r")).select("r.*")
        replace_parts(newest, path, bucket, batch=number)

    return sink
