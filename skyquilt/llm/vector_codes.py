"""Product-quantisation codes of vectors, with whole-number arithmetic throughout.

Components become integers, vectors are cut into equal parts, and each part position has a codebook that Lloyd rounds refine. In a round
the codebooks travel to the tasks as kd-trees, one broadcast of ``PARTS * ENTRIES`` entries whatever the input; tasks find
each part's nearest entry by branch and bound and hand back sums per entry, which Spark adds up as decimals.
A branch is left out only if its box is farther away than the best entry so far; boxes at just that distance are
visited, so that of entries equally near that with the lowest index wins.

Defined cases: rows whose vector is null, or holds null, NaN or infinite components, are dropped; of rows with equal ids that with
the smaller vector comes first, null ids come last; with fewer rows than entries the codebooks are that much smaller; vectors whose length
is not a multiple of the number of parts are filled with zeros, which change no distance; vectors of another length than the
first kept one raise an error, as do components of 2 ** 18 and more, beyond which distances would not fit 64 bits; an
empty table gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm.common import materialize, table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LEAF = 4
#: The largest component, scaled, with which all sums of squares stay below 2 ** 63.
LARGEST = 1 << 26


class Tree:
    """A kd-tree over the entries of one codebook; ``entries`` is a matrix of whole numbers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._grow(np.arange(len(entries)))

    def _grow(self, which: np.ndarray) -> tuple:
        """``(low, high, indexes, left, right)``: the box of the entries below, and either their ascending indexes or two branches."""
        inside = self.entries[which]
        low, high = inside.min(axis=0), inside.max(axis=0)
        axis = int(np.argmax(high - low))
        if len(which) <= LEAF or high[axis] == low[axis]:
            return low, high, np.sort(which), None, None
        order = which[np.argsort(inside[:, axis], kind="stable")]
        half = len(order) // 2
        return low, high, None, self._grow(order[:half]), self._grow(order[half:])

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry; ties go to the lower index."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.full(len(points), len(self.entries))
        self._visit(self.root, points, np.arange(len(points)), best, index)
        return index, best

    def _bound(self, node: tuple, points: np.ndarray) -> np.ndarray:
        off = np.maximum(np.maximum(node[0] - points, points - node[1]), 0)
        return (off * off).sum(axis=1)

    def _visit(self, node: tuple, points: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        if not len(rows):
            return
        _, _, indexes, left, right = node
        if indexes is not None:
            off = points[rows, None, :] - self.entries[indexes]
            d = (off * off).sum(axis=2)
            k = d.argmin(axis=1)  # the first of equals, and indexes ascend
            d, found = d[np.arange(len(rows)), k], indexes[k]
            better = (d < best[rows]) | ((d == best[rows]) & (found < index[rows]))
            best[rows[better]], index[rows[better]] = d[better], found[better]
            return
        to_left, to_right = self._bound(left, points[rows]), self._bound(right, points[rows])
        near = to_left <= to_right
        for first, second, mine, bound in ((left, right, near, to_right), (right, left, ~near, to_left)):
            these = rows[mine]
            self._visit(first, points, these, best, index)
            self._visit(second, points, these[bound[mine] <= best[these]], best, index)


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """The vectors of a batch as rows, filled with zeros to a multiple of ``parts``, cut into parts: (rows, parts, width)."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    length = len(flat) // n
    width = -(-length // parts)
    out = np.zeros((n, parts * width), np.int64)
    out[:, :length] = flat.reshape(n, length)
    return out.reshape(n, parts, width)


def _assigned(trees: list[Tree], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = [tree.nearest(points[:, p]) for p, tree in enumerate(trees)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _summer(sent, parts: int, entries: int):
    """Sums and counts of each entry's parts over a task's rows, as decimal strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        counts = np.zeros(parts * entries, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column(0), parts)
            index, _ = _assigned(sent.value, points)
            slot = index + np.arange(parts) * entries
            counts += np.bincount(slot.reshape(-1), minlength=len(counts))
            for at in np.unique(slot):
                p = int(at) // entries
                total = points[slot[:, p] == at, p].sum(axis=0).tolist()
                sums[int(at)] = [a + b for a, b in zip(sums.get(int(at), [0] * len(total)), total, strict=True)]
        for at, total in sums.items():
            yield pa.RecordBatch.from_pydict({
                "slot": pa.array([at] * len(total), pa.int32()), "place": pa.array(range(len(total)), pa.int32()),
                "total": pa.array(map(str, total)), "n": pa.array([int(counts[at])] * len(total), pa.int64()),
            })

    return run


def _coder(sent, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            index, error = _assigned(sent.value, _matrix(batch.column(2), parts))
            codes = [row.tobytes().hex() for row in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes), pa.array(error.sum(axis=1), pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def whole_numbers(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id``, ``label`` and ``v``, the scaled and floored components of the rows that are kept."""
    x = F.col(vector_col)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = df.where(x.isNotNull()).where(~odd)
    return kept.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("v"))


def codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """The codebooks, (parts, entries, width), of the vectors that ``whole_numbers`` made; None if there are none."""
    spark = whole.sparkSession
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    if not first:
        return None
    length = len(first[0]["v"])
    far = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))
    unlike, largest = whole.agg(F.count_if(F.size("v") != length), F.max(far)).first()
    if unlike or length == 0 or (largest or 0) > LARGEST:
        raise ValueError(f"{unlike} vectors are not of length {length}, or components pass {LARGEST // SCALE}")
    books = np.ascontiguousarray(_matrix(pa.array([r["v"] for r in first]), parts).transpose(1, 0, 2))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast([Tree(book) for book in books])
        parted = whole.select("v").mapInArrow(_summer(sent, parts, books.shape[1]), "slot int, place int, total string, n bigint")
        total = parted.groupBy("slot", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        books = books.copy()
        for r in total.collect():  # as many rows as the codebooks have numbers
            books[r["slot"] // books.shape[1], r["slot"] % books.shape[1], r["place"]] = int(r["total"]) // r["n"]
        sent.unpersist()
    return books


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """``vec_id, label, code, error`` of every kept vector, and the codebooks. ``entries`` are 256 at most."""
    whole = materialize(whole_numbers(df, id_col, vector_col, label_col), "vectors")
    books = codebooks(whole, parts, entries, rounds)
    if books is None:
        return whole.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")), None
    sent = df.sparkSession.sparkContext.broadcast([Tree(book) for book in books])
    kind = dict(whole.dtypes)
    return whole.select("vec_id", "label", "v").mapInArrow(_coder(sent, parts), f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error bigint"), books


def with_label_error(coded: DataFrame, hot_share: int = 1000) -> DataFrame:
    """Adds ``label_error``, the errors of equal labels summed.

    Labels that hold more than one row in ``hot_share`` are fewer than ``hot_share``: their sums are broadcast. The others are joined by shuffle.
    """
    sums = materialize(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("rows")), "label-errors")
    n = sums.agg(F.sum("rows")).first()[0] or 0
    hot = sums.where(F.col("rows") * hot_share > n).drop("rows")
    cold = sums.where(F.col("rows") * hot_share <= n).drop("rows")
    known = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("of")), "left")
    found = known.where(F.col("label_error").isNotNull()).drop("of")
    rest = known.where(F.col("label_error").isNull()).drop("of", "label_error").join(cold, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    return found.unionByName(rest)


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all entries' components by part, entry and position, joined by commas."""
    flat = [] if books is None else books.reshape(-1).tolist()
    return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(materialize(coded, "codes")).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds one after another; ``points`` has a row per vector and part, and each round compares it with every entry."""
    width = "(len(v) // 16)"
    steps = [
        "kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"points AS (SELECT vec_id, v, label, p, v[p * {width} + 1 : (p + 1) * {width}] AS x FROM kept, range(16) AS t(p))",
        "firsts AS (SELECT vec_id, v, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM kept)",
        f"books0 AS (SELECT p, e, v[p * {width} + 1 : (p + 1) * {width}] AS c FROM firsts, range(16) AS t(p) WHERE e < 64)",
    ]
    for k in range(3):
        steps.append(
            f"near{k} AS (SELECT vec_id, label, p, x, min((d, e)) AS b FROM (SELECT vec_id, label, p, x, e,"
            f" CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM points JOIN books{k} USING (p)) GROUP BY ALL)"
        )
        if k < 2:
            steps.append(
                f"sums{k} AS (SELECT p, e, list((s - (((s % n) + n) % n)) // n ORDER BY i) AS c FROM (SELECT p, b[2] AS e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n"
                f" FROM near{k}, range(1, 65) AS t(i) WHERE i <= len(x) GROUP BY ALL) GROUP BY ALL)"
            )
            steps.append(f"books{k + 1} AS (SELECT p, e, coalesce(s.c, o.c) AS c FROM books{k} AS o LEFT JOIN sums{k} AS s USING (p, e))")
    return (
        "WITH " + ", ".join(steps) + ", coded AS (SELECT vec_id, label, string_agg(printf('%02x', b[2]), '' ORDER BY p) AS code, CAST(sum(b[1]) AS BIGINT) AS error FROM near2 GROUP BY ALL)"
        " SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,"
        " (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM books2) AS codebooks_sha256 FROM coded"
    )


OP13_SQL = _sql()
