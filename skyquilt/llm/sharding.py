"""Sharding by fixed virtual slots.

Every record hashes to one of a few thousand virtual slots, for good. A versioned map says which shard holds which
slot; rebalancing edits the map and moves whole slots, so that a record's slot never changes and a version can be
read back at any time. The first version of a map is made from the bytes in each slot, the largest slot first
to the lightest shard; later versions move as few bytes as they need to.

Only sums by slot reach the driver: ``slots`` rows, whatever the size of the input. Texts are never shuffled.

Defined cases: a null text has no bytes (size 1, checksum 0); a null id hashes by its text; equal ids share a slot, and
repeated rows each get a position of their own; an empty table gives an empty result and an even map; columns other
than the named two are ignored, whatever their names.
"""

from __future__ import annotations

import heapq

from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyquilt.llm.common import materialize, new_path, table
from skyquilt.llm.files import locate

SLOTS = 4096
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes bigint"


class SlotMap:
    """Versions of the slot-to-shard map, kept as a Parquet table that is only ever added to."""

    def __init__(self, spark: SparkSession, path: str, slots: int = SLOTS):
        self.spark, self.path, self.slots = spark, path, slots

    def store(self, version: int, shards: list[int], sizes: list[int]) -> None:
        rows = [(version, s, shards[s], sizes[s]) for s in range(self.slots)]
        self.spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def exists(self) -> bool:
        store, path = locate(self.path if ":" in self.path else f"file://{self.path}")
        return any(f.base_name.endswith(".parquet") for f in store.get_file_info(FileSelector(path, allow_not_found=True)))

    def rebalanced(self, sizes: list[int], n_shards: int) -> int:
        """Store the next version, edited for new sizes of slots and ``n_shards``; gives its number."""
        rows = self.read().orderBy("virtual_slot").collect()  # one a slot
        version = rows[0]["version"] + 1
        self.store(version, rebalance([r["shard"] for r in rows], sizes, n_shards), sizes)
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """The map of one version, by default the newest."""
        every = self.spark.read.schema(MAP_SCHEMA).parquet(self.path)
        if version is None:
            version = every.agg(F.max("version")).first()[0]
        return every.where(F.col("version") == version)


def slot_sizes(records: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes in each slot, over all records."""
    out = [0] * slots
    for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("n")).collect():
        out[r["virtual_slot"]] = r["n"]
    return out


def first_map(sizes: list[int], n_shards: int) -> list[int]:
    """Largest slot first, each to the shard that holds least; empty slots go round, so that none is unassigned."""
    loads = [(0, k) for k in range(n_shards)]
    out = [0] * len(sizes)
    for s in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        load, k = heapq.heappop(loads)
        out[s] = k
        heapq.heappush(loads, (load + max(sizes[s], 1), k))
    return out


def rebalance(shards: list[int], sizes: list[int], n_shards: int, tolerance: float = 0.01) -> list[int]:
    """An edited map for ``n_shards`` and new sizes.

    Slots of shards that are gone move first, each to the lightest shard. Then the heaviest shard gives the lightest one the
    largest slot that narrows the gap, until the heaviest is within ``tolerance`` of the mean or no slot helps.
    """
    out = list(shards)
    loads = [0] * n_shards
    held: list[list[int]] = [[] for _ in range(n_shards)]
    gone = []
    for s, k in enumerate(out):
        if k < n_shards:
            loads[k] += sizes[s]
            held[k].append(s)
        else:
            gone.append(s)

    def put(s: int, k: int) -> None:
        out[s] = k
        loads[k] += sizes[s]
        held[k].append(s)

    for s in sorted(gone, key=lambda s: (-sizes[s], s)):
        put(s, min(range(n_shards), key=lambda k: (loads[k], len(held[k]), k)))
    mean = sum(loads) / n_shards
    for _ in range(len(out)):
        high = max(range(n_shards), key=lambda k: (loads[k], k))
        low = min(range(n_shards), key=lambda k: (loads[k], k))
        gap = loads[high] - loads[low]
        fits = [s for s in held[high] if 0 < sizes[s] < gap]
        if loads[high] <= mean * (1 + tolerance) and loads[low] >= mean * (1 - tolerance) or not fits:
            break
        s = min(fits, key=lambda s: (abs(2 * sizes[s] - gap), s))
        held[high].remove(s)
        loads[high] -= sizes[s]
        put(s, low)
    return out


def records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``id``, ``size`` in bytes with one for the end, ``text_crc32`` and ``virtual_slot`` of every row."""
    key = F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col))).otherwise(F.xxhash64(F.col(id_col)))
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    return df.select(
        F.col(id_col).alias("id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.pmod(key, F.lit(slots)).cast("int").alias("virtual_slot"),
        F.pmod(F.xxhash64(key, F.crc32(raw)), F.lit(1 << 20)).cast("int").alias("spread"),
    )


def assign_shards(
    df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, map_path: str | None = None, cell_rows: int = 200_000
) -> DataFrame:
    """Every row with its shard and its position in it: ``id size text_crc32 virtual_slot shard version position``.

    ``map_path`` is where the map is kept; its newest version is used as it is (``n_shards`` then says nothing; ``SlotMap.rebalanced`` changes it), and
    version 1 is made where there is none yet.
    Positions count from 0 in each shard without gaps: by slot, then by cells of a slot (as many as keep
    a cell near ``cell_rows``), then by id. No task sorts more than a cell.
    """
    spark = df.sparkSession
    rows = materialize(records(df, id_col, text_col, slots), "records")
    slot_map = SlotMap(spark, map_path or new_path(spark, "slot-map"), slots)
    if not slot_map.exists():
        sizes = slot_sizes(rows, slots)
        slot_map.store(1, first_map(sizes, n_shards), sizes)
    mapped = slot_map.read().select("virtual_slot", "shard", "version")
    most = rows.groupBy("virtual_slot").count().agg(F.max("count")).first()[0] or 0
    cells = max(1, -(-most // cell_rows))
    placed = rows.join(F.broadcast(mapped), "virtual_slot").withColumn("cell", (F.col("spread") % cells).cast("int"))
    counts = placed.groupBy("shard", "virtual_slot", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("virtual_slot", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("virtual_slot", "cell").orderBy("id", "text_crc32", "size")
    return (
        placed.withColumn("k", F.row_number().over(inside) - 1)
        .join(offsets, ["virtual_slot", "cell"])
        .select("id", "size", "text_crc32", "virtual_slot", "shard", "version", (F.col("offset") + F.col("k")).alias("position"))
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 under the law ``bytes``."""
    got = assign_shards(table(spark, sf_dir, "documents"), 8)
    return got.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )
