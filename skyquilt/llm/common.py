"""Helpers shared by the training-data operators: tables in the shared folder, file access, id ranges."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm.files import locate

#: Fixed value of the row contracts: what separates words (space, tab, LF, VT, FF, CR).
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file:///tmp/checkpoints/skyquilt"
        spark.conf.set("spark.checkpoint.dir", found)
    return found if ":" in found else f"file://{found}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends here and lost executors cost nothing."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*written: DataFrame | None) -> None:
    """Delete tables that ``materialize`` made and that nothing will read again, not even after the loss of an executor: whatever was made of them is written."""
    for df in written:
        files = df.inputFiles() if df is not None else []
        if files:
            store, path = locate(files[0].rsplit("/", 1)[0])
            store.delete_dir(path)


def perhaps_among(df: DataFrame, key: Column, keys: DataFrame, name: str, times: int = 2) -> DataFrame:
    """``df`` with a boolean that is false only where ``key`` (a hash) surely isn't among ``keys``, a written table of one long column.

    Rows that need not meet a large table can so be told before a shuffle. Hashes are marked in bitmaps of eight bits a key or more, a
    row for 32,768 bits, which are broadcast: 32 MB at most, beyond which more rows are true in vain. Of the rows that aren't among them
    an eighth at most is true in vain; with ``times`` = 2 a second bitmap, of the hashes' upper halves, leaves an eighth of these. An exact join of the true rows must follow.
    """
    bits = 1 << min(28, max(15, (8 * keys.count() - 1).bit_length()))
    columns, out = df.columns, F.lit(True)
    for k in range(times):
        place = lambda c: F.pmod(F.shiftrightunsigned(c, 32 * k), F.lit(bits).cast("long")) + 1  # noqa: B023, E731
        at, own, mine = place(F.col(keys.columns[0])), f"__at{k}", f"__bits{k}"
        marks = keys.groupBy(F.bitmap_bucket_number(at).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias(mine))
        df = df.withColumn(own, place(key)).withColumn("__bucket", F.bitmap_bucket_number(own)).join(F.broadcast(marks), "__bucket", "left").drop("__bucket").withColumn(own, F.bitmap_bit_position(own))
        out = out & F.coalesce(F.expr(f"(shiftright(cast(conv(hex(substring({mine}, cast({own} div 8 as int) + 1, 1)), 16, 10) as int), cast({own} % 8 as int)) & 1) = 1"), F.lit(False))
    return df.select(*columns, out.alias(name))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once a row however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text, in order; null: none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def id_ranges(df: DataFrame, id_col: str, size_col: str, target: int, divide: bool = False, most: int = 4096, cells: int = 1 << 14) -> list[tuple[int, int]]:
    """Lower ends of contiguous ranges of ids that hold about ``target`` of ``size_col`` each, the first one's left out.

    There are about ``most`` ranges at most: beyond that they grow with the input. The span of all ids is cut into ``cells`` cells of
    equal width; those that hold more than ``target`` are all cut again by one further job, until none of them has more than one
    id, so that the jobs number as many as the levels (one where ids lie even), not as the ranges. Exact sums of about ``cells`` cells a
    level come to the driver. An end is a pair: an id, and a number below 2 ** 31 from which on
    rows of that id belong to the range; it isn't 0 where ``divide`` asks to cut ids that alone hold more than a range may. Ranges depend on nothing but the rows. Null
    ids belong to the first range. Pass a written table: it is read once a level.
    """
    known = df.where(F.col(id_col).isNotNull())
    low, high, total = known.agg(F.min(id_col), F.max(id_col), F.sum(size_col)).first()
    if low is None:
        return []
    target = max(target, -(-total // most))
    atoms: list[tuple[int, int, int]] = []  # first id, last id, size
    wide = [(low, high)]
    while wide:
        fan = max(16, cells // len(wide))
        widths = [-(-(b - a + 1) // fan) for a, b in wide]
        spark = df.sparkSession
        k = range_of(F.col(id_col), [(a, 0) for a, _ in wide[1:]], F.lit(0))
        spans = spark.createDataFrame([(i, a, b, w) for i, ((a, b), w) in enumerate(zip(wide, widths, strict=True))], "k int, a long, b long, w long")
        inside = known.withColumn("k", k).join(F.broadcast(spans), "k").where(F.col(id_col) <= F.col("b"))  # at most ``most`` spans
        offset = (F.col(id_col).cast("decimal(20,0)") - F.col("a").cast("decimal(20,0)")) / F.col("w")
        got = inside.groupBy("k", F.floor(offset).cast("long").alias("c")).agg(F.sum(size_col).alias("n")).collect()
        again = []
        for r in sorted(got, key=lambda r: (r["k"], r["c"])):
            (a, b), w = wide[r["k"]], widths[r["k"]]
            first, last = a + r["c"] * w, min(b, a + (r["c"] + 1) * w - 1)
            if r["n"] > target and last > first:
                again.append((first, last))
            else:
                atoms.append((first, last, r["n"]))
        wide = again
    ends, held = [], 0
    for first, last, n in sorted(atoms):
        if held and held + n > target:
            ends.append((first, 0))
            held = 0
        held += n
        if n > target and divide:
            parts = -(-n // target)
            ends += [(first, (j << 31) // parts) for j in range(1, parts)]
            held = n // parts
    return ends


def range_of(id_col: Column, ends: list[tuple[int, int]], sub_col: Column) -> Column:
    """Which of the ranges a row lies in, null ids in the first: a binary search of the ends, in arrays that the plan holds as two constants."""
    if not ends:
        return F.lit(0)
    array = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # noqa: E731  folded to a constant
    ids, subs = array([e[0] for e in ends]), array([e[1] for e in ends])
    steps = [1 << k for k in range(len(ends).bit_length() - 1, -1, -1)]

    def step(found: Column, width: Column) -> Column:
        at = found + width - 1
        end, sub = F.get(ids, at), F.get(subs, at)  # null beyond the last end
        return F.when((end < id_col) | ((end == id_col) & (sub <= sub_col)), found + width).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
