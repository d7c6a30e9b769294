"""A factorisation machine that tells good texts from bad ones.

Its inputs are a text's words, hashed into ``1 << BITS`` weights (root of the count, scaled to a length of 1), statistics of its structure
and its ``n_chars``, each as one of a few ranges. The score is the logistic function of ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``; the
second sum is taken as half of ``sum_f (sum_i v_if x_i) ** 2 - sum_i (v_if x_i) ** 2``, in time linear in a text's distinct words.

Fitting takes at most ``MOST_LABELLED`` documents of each label, those with the smallest hashes of their ids (a documented bound; what a label has beyond
it is made up for by weights). Their inputs are a written table dealt over ``WORKERS`` parts; in an epoch each part trains on its rows, a
batch at a time, from the common model, and the driver averages the parts' models, whose size is fixed. Scoring reads every row once,
without any shuffle.

Defined cases: a null or empty text has no words and is scored by its structure; a null ``n_chars`` is an input of its own; a null id is held out; long
texts are read whole; of rows with one id one text is used in fitting, and all are scored; ids whose labels differ teach nothing; without
labels every score is 0.5; an empty table gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm import ragged
from skyquilt.llm.common import materialize, table

BITS, RANK = 14, 8
MOST_LABELLED, WORKERS, EPOCHS, BATCH = 10_000, 8, 8, 128
RATE, DECAY = 0.1, 1e-5
THRESHOLD = 0.7
#: Fixed value of the row contract: characters that count as symbols in the quality rules as well.
SYMBOLS = b"#*$%&|<>"
#: Where the ranges of shares, and of means and logarithms, begin.
SHARES = np.array([0.002, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8])
SIZES = np.array([1.0, 2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16])
#: Which bytes are symbols, capitals, digits, marks, and marks or symbols.
_KINDS = [np.isin(np.arange(256), list(x)) for x in (SYMBOLS, range(65, 91), range(48, 58), b"!?", b"!?" + SYMBOLS)]
N_STATS = 12
WIDTH = 16
N_INPUTS = N_STATS * WIDTH + (1 << BITS)


def _by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the flags are set in each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def _repeated_lines(raw: np.ndarray, offsets: np.ndarray, starts: np.ndarray, before: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many lines with a word each text has, and how many of them have the words of an earlier one."""
    n_texts = len(offsets) - 1
    if not len(starts):
        return np.zeros(n_texts, np.int64), np.zeros(n_texts, np.int64)
    text = np.repeat(np.arange(n_texts), np.diff(before))
    line = np.searchsorted(np.flatnonzero(raw == 0x0A), starts) + text
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    place = np.arange(len(starts)) - np.repeat(first, np.diff(np.append(first, len(starts))))
    sums = np.add.reduceat(ragged.mix(hashed + place.astype(np.uint64)), first)
    of = text[first]
    order = np.lexsort((sums, of))
    same = (sums[order][1:] == sums[order][:-1]) & (of[order][1:] == of[order][:-1])
    return np.bincount(of, minlength=n_texts), np.bincount(of[order][1:][same], minlength=n_texts)


def inputs(raw: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indexes and values of the inputs of several texts, and where each text's begin: one range a statistic, then its distinct hashed words.

    ``n_chars`` is below 0 where it is null.
    """
    n_texts, mask = len(offsets) - 1, (1 << BITS) - 1
    starts, ends, before = ragged.words(raw, offsets)
    hashed, n = ragged.hashes(raw, starts, ends), np.diff(before)
    key = (np.repeat(np.arange(n_texts), n) << BITS) | (ragged.mix(hashed) & np.uint64(mask)).astype(np.int64)
    key, counts = np.unique(key, return_counts=True)
    of = key >> BITS
    distinct, top = np.bincount(of, minlength=n_texts), np.zeros(n_texts, np.int64)
    np.maximum.at(top, of, counts)
    some, size = np.maximum(n, 1), np.maximum(np.diff(offsets), 1)
    chars = np.diff(np.concatenate([[0], np.cumsum(ends - starts)])[before])
    lines, repeated = _repeated_lines(raw, offsets, starts, before, hashed)
    marked = np.diff(np.concatenate([[0], np.cumsum(_KINDS[4][raw[ends - 1]])])[before])
    shares = [*(_by_text(kind[raw], offsets) / size for kind in _KINDS[:4]), marked / some, distinct / some, top / some, repeated / np.maximum(lines, 1)]
    means = [chars / some, np.log2(some), np.log2(1 + some / np.maximum(lines, 1))]
    size_range = np.where(n_chars < 0, WIDTH - 1, np.minimum(np.floor(np.log2(np.maximum(n_chars, 0) + 1)), WIDTH - 2)).astype(np.int64)
    stats = [*(np.searchsorted(SHARES, x, "right") for x in shares), *(np.searchsorted(SIZES, x, "right") for x in means), size_range]
    stats = np.stack(stats, axis=1) + np.arange(N_STATS) * WIDTH
    value = np.sqrt(counts / np.maximum(n, 1)[of])  # squares add up to 1
    first = np.cumsum(distinct + N_STATS) - (distinct + N_STATS)
    at, x = np.zeros(int((distinct + N_STATS).sum()), np.int64), np.ones(int((distinct + N_STATS).sum()))
    word = np.ones(len(at), bool)
    word[(first[:, None] + np.arange(N_STATS)).reshape(-1)] = False
    at[~word], at[word], x[word] = stats.reshape(-1), (key & mask) + N_STATS * WIDTH, value
    return at, x, first


def batches_of_inputs(texts: pa.Array, n_chars: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    raw, offsets = ragged.buffers(texts)
    sizes = n_chars.fill_null(-1).to_numpy(zero_copy_only=False)
    for i, j in ragged.pieces(offsets):
        yield inputs(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], sizes[i:j])


class Machine:
    """Weights ``w0``, ``w`` (inputs) and ``v`` (inputs, rank)."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    @classmethod
    def new(cls, seed: int = 12) -> Machine:
        rng = np.random.Generator(np.random.PCG64(seed))
        return cls(0.0, np.zeros(N_INPUTS), 0.05 * rng.standard_normal((N_INPUTS, RANK)))

    def raw(self, at: np.ndarray, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum before the logistic function, and the sums of each factor, of the texts whose inputs begin at ``first``."""
        vx = self.v[at] * x[:, None]
        sums = np.add.reduceat(vx, first, axis=0)
        pairs = 0.5 * (sums * sums - np.add.reduceat(vx * vx, first, axis=0)).sum(axis=1)
        return self.w0 + np.add.reduceat(self.w[at] * x, first) + pairs, sums

    def score(self, at: np.ndarray, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(at, x, first)[0], -500, 500)))

    def train(self, batches: Iterator[tuple], state: list[np.ndarray]) -> None:
        """One pass of AdaGrad over batches of (indexes, values, first inputs, labels, weights); ``state`` holds squared gradients."""
        for at, x, first, y, weight in batches:
            z, sums = self.raw(at, x, first)
            off = (1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - y) * weight / len(y)
            n = np.diff(np.append(first, len(at)))
            g = np.repeat(off, n) * x
            used, which = np.unique(at, return_inverse=True)
            slope = np.bincount(which, g, len(used)) + DECAY * self.w[used]
            inner = np.repeat(sums, n, axis=0) - self.v[at] * x[:, None]
            slopes = np.stack([np.bincount(which, g * inner[:, f], len(used)) for f in range(RANK)], axis=1) + DECAY * self.v[used]
            g0 = float(off.sum())
            state[0] += g0 * g0
            state[1][used] += slope * slope
            state[2][used] += slopes * slopes
            self.w0 -= RATE * g0 / (float(np.sqrt(state[0][0])) + 1e-8)
            self.w[used] -= RATE * slope / (np.sqrt(state[1][used]) + 1e-8)
            self.v[used] -= RATE * slopes / (np.sqrt(state[2][used]) + 1e-8)


def _describer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inputs of labelled rows (h, y, weight, text, n_chars)."""
    for batch in batches:
        done = 0
        for at, x, first in batches_of_inputs(batch.column("text"), batch.column("n_chars")):
            part = batch.slice(done, len(first))
            done += len(first)
            cut = lambda a: pa.array([y.tobytes() for y in np.split(a, first[1:])], pa.binary())  # noqa: B023, E731
            columns = [part.column("h"), part.column("y"), part.column("weight"), cut(at.astype(np.int32)), cut(x.astype(np.float32))]
            yield pa.RecordBatch.from_arrays(columns, ["h", "y", "weight", "at", "x"])


def _pack(at: list[np.ndarray], x: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, at), np.int64, len(at))
    return np.concatenate(at).astype(np.int64), np.concatenate(x).astype(np.float64), np.cumsum(n) - n


def _trainer(sent):
    """A part's model after one pass over its rows, in the order they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, state = sent.value
        machine = Machine(machine.w0, machine.w.copy(), machine.v.copy())
        state = [s.copy() for s in state]
        seen = 0

        def minibatches():
            nonlocal seen
            for batch in batches:
                for i in range(0, batch.num_rows, BATCH):
                    part = batch.slice(i, BATCH)
                    at = [np.frombuffer(b, np.int32) for b in part.column("at").to_pylist()]
                    x = [np.frombuffer(b, np.float32) for b in part.column("x").to_pylist()]
                    seen += len(at)
                    yield *_pack(at, x), part.column("y").to_numpy().astype(np.float64), part.column("weight").to_numpy()

        machine.train(minibatches(), state)
        if seen:
            flat = np.concatenate([[machine.w0, state[0][0]], machine.w, machine.v.reshape(-1), state[1], state[2].reshape(-1)]).astype(np.float32)
            yield pa.RecordBatch.from_pydict({"rows": pa.array([seen], pa.int64()), "model": pa.array([flat.tobytes()], pa.binary())})

    return run


def sample(docs: DataFrame, labels: DataFrame, target: str, held_out, most: int) -> DataFrame:
    """``h, y, weight, text, n_chars`` of at most ``most`` documents of each label, one text an id."""
    told = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id")
    told = told.agg(F.min(target).alias("y"), F.max(target).alias("top")).where("y = top").select("doc_id", "y", F.xxhash64("doc_id").alias("h"))
    told = materialize(told, "labels")
    totals = {r["y"]: r["n"] for r in told.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = None
    for y, n in sorted(totals.items()):
        some = told.where(F.col("y") == y).orderBy("h", "doc_id").limit(most).withColumn("weight", F.lit(n / min(n, most)))
        taken = some if taken is None else taken.unionByName(some)
    if taken is None:
        return docs.select(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("y"), F.lit(1.0).alias("weight"), "text", "n_chars").limit(0)
    taken = materialize(taken, "sampled-labels")  # 2 * most rows
    found = docs.select("doc_id", "text", "n_chars").join(F.broadcast(taken), "doc_id")
    one = F.min_by(F.struct("text", "n_chars"), F.struct(F.xxhash64("text", "n_chars"), "text", "n_chars"))
    return found.groupBy("doc_id", "h", "y", "weight").agg(one.alias("d")).select("h", "y", "weight", "d.text", "d.n_chars")


def fit(rows: DataFrame, epochs: int = EPOCHS, workers: int = WORKERS) -> Machine:
    """A model of the rows that ``sample`` gave."""
    spark = rows.sparkSession
    described = materialize(rows.mapInArrow(_describer, "h bigint, y int, weight double, at binary, x binary"), "inputs")
    machine, state = Machine.new(), [np.zeros(1), np.zeros(N_INPUTS), np.zeros((N_INPUTS, RANK))]
    dealt = materialize(described.repartitionById(workers, F.pmod("h", F.lit(workers)).cast("int")).sortWithinPartitions("h"), "dealt")
    mean = dealt.agg(F.avg("weight")).first()[0] or 1.0
    dealt = dealt.withColumn("weight", F.col("weight") / F.lit(mean))
    for _ in range(epochs):
        sent = spark.sparkContext.broadcast((machine, state))
        parts = dealt.repartitionById(workers, F.pmod("h", F.lit(workers)).cast("int")).sortWithinPartitions("h")
        got = parts.mapInArrow(_trainer(sent), "rows bigint, model binary").collect()  # one model a worker, 1.2 MB each
        sent.destroy()
        if not got:
            break
        share = sum(r["rows"] for r in got)
        got.sort(key=lambda r: bytes(r["model"]))  # sums don't depend on the order of arrival
        flat = sum(np.frombuffer(r["model"], np.float32) * (r["rows"] / share) for r in got)
        head, w, v, g, gg = np.split(flat, np.cumsum([2, N_INPUTS, N_INPUTS * RANK, N_INPUTS]))
        machine, state = Machine(float(head[0]), w, v.reshape(N_INPUTS, RANK)), [head[1:2].copy(), g, gg.reshape(N_INPUTS, RANK)]
    if not epochs or machine.w0 == 0.0:
        machine = Machine(0.0, np.zeros(N_INPUTS), np.zeros((N_INPUTS, RANK)))
    return machine


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.score(*got) for got in batches_of_inputs(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found) if found else np.zeros(0))], ["doc_id", "score"])

    return run


def scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id`` and ``score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    return docs.select("doc_id", "text", F.col("n_chars").cast("bigint").alias("n_chars")).mapInArrow(_scorer(sent), f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def held_out(doc_id: Column) -> Column:
    """Every fourth document by the checksum of its id; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def op12_quality_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("n_chars", F.col("n_chars").cast("bigint"))
    machine = fit(sample(docs, table(spark, sf_dir, "labels"), "quality", held_out, MOST_LABELLED))
    return scores(docs, machine).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
