"""Near-duplicate documents by ProbMinHash signatures of shingles.

A shingle is a run of five words. All have the same weight, so that candidates are found by the similarity that decides; as an option
(``weighted``) the weight grows with the number of times it occurs in the text, and pairs that repeat unlike parts are missed more often. Each shingle starts
a Poisson process whose rate is its weight; every arrival goes to one of ``m`` components, which keeps the earliest arrival
and its shingle. A shingle stops as soon as its next arrival is later than the latest of all components, which is early for
nearly all of them. Two signatures agree in a component with the probability Jaccard similarity of the two weighted sets.

Texts whose words are equal fall into one class first; one of each is a node, named by the digest of its words. Signatures are cut into ``bands``;
nodes that share a band meet in a bucket. Each is compared there with the bucket's least node: a number of
comparisons in proportion to the rows, however large a bucket is. Buckets whose members are in one component then are done. In each of
the others members of unlike components are compared, block against block, by sketches: a byte of each component of
the signature, 125 bytes a text. Pairs whose sketches agree too rarely for the threshold are no links (one link in 100,000 is
taken for one of them); of the other pairs first the best of two components in two blocks goes on; where that didn't join them, the
bucket's sets come together in the task, which looks at pairs until all are joined or none is left.
Exact Jaccard similarity of the shingle sets decides on every pair that goes on; a set is sent once to each task that needs it. Where very
many texts share a band and no two of them are similar, all their sketches are compared: that work grows with the square of such a bucket.
Components are found by joins, and written to the shared folder between rounds.

Words are as in the other operators (``WORD_BREAK``), with A to Z in lower case. A text of one to four words is one shingle.

Defined cases: a text without words (null, empty or white space) is like every other such text; every row has a class by its text,
whatever its id: rows without an id and rows that share one are judged each by itself; ties fall together; the least id is the
class, and the class of texts that have no id at all is null; an empty table gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm import ragged
from skyquilt.llm.common import discard, materialize, perhaps_among, table

WIDTH, BANDS, ROWS, THRESHOLD = 5, 25, 5, 0.8
#: Partners of a text that are compared with it in one task.
PART = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, how many lie before each text, and a digest of each text's words."""
    raw = ragged.LOWER[raw]
    starts, ends, before = ragged.words(raw, offsets)
    h = ragged.mix(ragged.hashes(raw, starts, ends))
    n = np.diff(before)
    place = np.arange(len(h)) - np.repeat(before[:-1], n)
    with np.errstate(over="ignore"):
        digest = np.zeros(len(n), np.uint64)
        some = np.flatnonzero(n)
        if len(some):
            digest[some] = np.add.reduceat(ragged.mix(h + place.astype(np.uint64) * _STEP), before[:-1][some])
        out = h.copy()
        for k in range(1, width):
            out[: len(h) - k] = out[: len(h) - k] * np.uint64(0x100000001B3) + h[k:]
        out = ragged.mix(out)
    whole = place <= np.repeat(n, n) - width
    short = np.flatnonzero((n > 0) & (n < width))
    whole[before[:-1][short]] = True
    out[before[:-1][short]] = digest[short]
    return out[whole], np.concatenate([[0], np.cumsum(whole)])[before], digest


def _sets(h: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, with their text and their count."""
    doc = np.repeat(np.arange(len(before) - 1), np.diff(before))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return h[first], doc[first], np.diff(np.append(first, len(h)))


def prob_min_hash(h: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Signatures of ``n_docs`` weighted sets: for each component the shingle of the earliest arrival (0: none).

    All shingles of all sets advance together, an arrival each a round; those whose time is beyond the latest of their set's
    components leave. Random numbers come from the shingle and the round alone.
    """
    time = np.full(n_docs * m, np.inf)
    owner = np.zeros(n_docs * m, np.uint64)
    state, at = h.copy(), np.zeros(len(h))
    rate = weight.astype(float)
    live = np.arange(len(h))
    with np.errstate(over="ignore"):
        while len(live):
            state[live] += _STEP
            bits = ragged.mix(state[live])
            u = ((bits >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
            at[live] -= np.log(u) / rate[live]
            slot = doc[live] * m + (ragged.mix(bits + _STEP) % np.uint64(m)).astype(np.int64)
            order = np.lexsort((h[live], at[live], slot))
            first = np.ones(len(order), bool)
            first[1:] = slot[order][1:] != slot[order][:-1]
            best = order[first]
            s, t = slot[best], at[live][best]
            earlier = t < time[s]
            time[s[earlier]], owner[s[earlier]] = t[earlier], h[live][best][earlier]
            latest = time.reshape(n_docs, m).max(axis=1)
            live = live[at[live] < latest[doc[live]]]
    return owner.reshape(n_docs, m)


def weights(counts: np.ndarray) -> np.ndarray:
    """Of shingles that occur so many times: a line repeated all over a text must not outweigh the rest of it."""
    return 1 + np.log(counts)


def sketch_least(m: int, threshold: float, miss: float = 1e-5) -> int:
    """The number of equal bytes that a link's sketches of ``m`` bytes fall short of with probability ``miss`` at most."""
    p = threshold + (1 - threshold) / 256
    below, k = 0.0, 0
    while True:
        below += math.exp(math.lgamma(m + 1) - math.lgamma(k + 1) - math.lgamma(m - k + 1) + k * math.log(p) + (m - k) * math.log1p(-p))
        if below > miss or k == m:
            return k
        k += 1


SIGNED_SCHEMA = "id bigint, hash bigint, digest bigint, buckets array<bigint>, sketch binary"


def _signer(bands: int, rows: int, width: int, weighted: bool):
    m = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = ragged.buffers(batch.column(2))
            for i, j in ragged.pieces(offsets, 1 << 20):
                h, before, digest = shingles(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                s, doc, n = _sets(h, before)
                signature = prob_min_hash(s, doc, weights(n) if weighted else np.ones(len(n)), j - i, m)
                some = np.flatnonzero(np.diff(before))
                value = np.zeros((len(some), bands), np.uint64)
                with np.errstate(over="ignore"):
                    for r in range(rows):
                        value = ragged.mix(value * np.uint64(0x100000001B3) + signature[some].reshape(len(some), bands, rows)[:, :, r])
                    value = ragged.mix(value + np.arange(bands, dtype=np.uint64) * _STEP)
                at = np.concatenate([[0], np.cumsum(np.where(np.diff(before) > 0, bands, 0))])
                buckets = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(value.reshape(-1).view(np.int64)))
                sketch = ragged.mix(signature.reshape(-1)).astype(np.uint8).tobytes()
                sketches = pa.array([sketch[k * m : (k + 1) * m] for k in range(j - i)], pa.binary())
                yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(digest.view(np.int64)), buckets, sketches], names=[x.split()[0] for x in SIGNED_SCHEMA.split(", ")])

    return run


def _shingler(width: int):
    """Shingle sets of texts, as sorted arrays in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = ragged.buffers(batch.column(1))
            for i, j in ragged.pieces(offsets):
                h, before, _ = shingles(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                s, doc, _ = _sets(h, before)
                at = np.searchsorted(doc, np.arange(j - i + 1)) * 8
                sets = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(s.tobytes())]).cast(pa.binary())
                yield pa.record_batch([batch.column(0).slice(i, j - i), sets], names=["node", "shingles"])

    return run


def similar(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two sorted sets have that Jaccard similarity or more."""
    low, high = sorted((len(a), len(b)))
    if low < threshold * high - 1e-9:
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= threshold * (len(a) + len(b) - shared) - 1e-9


def _alike(least: int):
    """Pairs whose sketches agree in ``least`` bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                a, b = (np.frombuffer(b"".join(pdf[c]), np.uint8).reshape(len(pdf), -1) for c in ("a_sketch", "b_sketch"))
                yield pdf.loc[(a == b).sum(axis=1) >= least, ["a", "b"]]

    return run


def _verifier(threshold: float):
    """Of the pairs of a centre and a part of its partners those that are similar; in the centre's row it is its own partner."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        is_centre = (pdf["a"] == pdf["b"]).to_numpy()
        centre = np.frombuffer(pdf.loc[is_centre, "shingles"].iloc[0], np.uint64)
        rest = pdf.loc[~is_centre]
        ok = [similar(centre, np.frombuffer(x, np.uint64), threshold) for x in rest["shingles"]]
        return rest.loc[ok, ["a", "b"]]

    return run


def _unlike(pdf: pd.DataFrame, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places and agreement of pairs of members of two blocks of a bucket, in unlike components, whose sketches agree in ``least`` bytes; for some members at a time."""
    component, side = pdf["component"].to_numpy(), pdf["side"].to_numpy()
    sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(len(pdf), -1)
    if (side == 2).all():
        # a block with itself: every pair once, and none within the largest component, which comes last
        size = pd.Series(component).groupby(component).transform("size").to_numpy()
        left = np.lexsort((component, size))
        right, stop = left, int((component[left] != component[left[-1]]).sum())
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        stop = len(left)
    for k in range(0, stop, 64):
        mine, theirs = left[k : min(k + 64, stop)], right[k + 1 :] if right is left else right
        agree = (sketch[mine][:, None, :] == sketch[theirs][None, :, :]).sum(axis=2, dtype=np.uint8)
        x, y = np.nonzero((agree >= least) & (component[mine][:, None] != component[theirs][None, :]))
        yield mine[x], theirs[y], agree[x, y]


def _best_pairs(least: int):
    """Of each two components of a bucket's blocks the pair whose sketches agree most."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, component, best = pdf["node"].to_numpy(), pdf["component"].to_numpy(), []
        for a, b, score in _unlike(pdf, least):
            out = pd.DataFrame({"a": np.minimum(nodes[a], nodes[b]), "b": np.maximum(nodes[a], nodes[b]), "x": np.minimum(component[a], component[b]), "y": np.maximum(component[a], component[b]), "score": score})
            best.append(out.sort_values(["score", "a", "b"], ascending=[False, True, True]).drop_duplicates(["x", "y"]))
        if not best:
            return pd.DataFrame({"bucket": [], "a": [], "b": []}, dtype="int64")
        out = pd.concat(best).sort_values(["score", "a", "b"], ascending=[False, True, True]).drop_duplicates(["x", "y"])
        return out[["a", "b"]].drop_duplicates().assign(bucket=key[0])[["bucket", "a", "b"]]

    return run


def _joining_links(least: int, threshold: float):
    """Links between unlike components of a bucket's blocks, enough of them to join what they join; no pair within what is joined is looked at."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        nodes, sets, out = pdf["node"].to_numpy(), [np.frombuffer(x, np.uint64) for x in pdf["shingles"]], []
        parent = np.unique(pdf["component"].to_numpy(), return_inverse=True)[1]
        root = list(range(int(parent.max()) + 1))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b, score in _unlike(pdf, least):
            for k in np.argsort(-score.astype(np.int16), kind="stable").tolist():
                x, y = find(int(parent[a[k]])), find(int(parent[b[k]]))
                if x != y and similar(sets[a[k]], sets[b[k]], threshold):
                    root[x] = y
                    out.append((min(nodes[a[k]], nodes[b[k]]), max(nodes[a[k]], nodes[b[k]])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``id`` and ``component``, the least id it is linked to, of every id in ``edges`` (``a``, ``b``).

    Each round links every id to the least of its neighbours and its neighbours' least (large and small stars), until nothing
    changes; a round is a shuffle of the edges, and is written before the next.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct(), name)
    if now.isEmpty():
        return now.select(F.col("x").alias("id"), F.col("y").alias("component"))
    while True:
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        # large star: larger neighbours go to the least of the neighbourhood
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = materialize(large.where("x <> y").distinct(), name)
        # small star: what is left of a neighbourhood goes to its least
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").select(F.explode(F.array(F.struct(F.col("x"), F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e"))
        after = materialize(small.select("e.*").where("x <> y").distinct(), name)
        same = after.count() == now.count() and after.join(now, ["x", "y"], "left_anti").isEmpty()
        now = after
        if same:
            return now.select(F.col("x").alias("id"), F.col("y").alias("component"))


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    bands: int = BANDS,
    rows: int = ROWS,
    threshold: float = THRESHOLD,
    block: int = 4096,
    weighted: bool = False,
    keep_hash: bool = False,
) -> DataFrame:
    """One row a document: ``doc_id``, ``class_id`` (the least id of its class) and ``copy_of`` (the least id with the same words).

    ``keep_hash``: also ``hash``, xxhash64 of the text (null: empty), and ``keep``, which is true of one row of each class.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    # one pass over the texts; whatever follows is on digests, bands and sketches until a few texts are compared
    signed = materialize(docs.mapInArrow(_signer(bands, rows, width, weighted), SIGNED_SCHEMA), "signatures")
    one = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "hash")).alias("row")
    nodes = signed.groupBy(F.col("digest").alias("node")).agg(one, F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"))
    nodes = materialize(nodes.select("node", "row.id", "row.hash", "buckets", "sketch"), "nodes")
    rows_of = materialize(signed.select("id", "hash", "digest"), "digests")
    discard(signed)
    sketches = nodes.select("node", "sketch")
    members = nodes.select("node", F.explode(F.array_distinct("buckets")).alias("bucket"))
    least = 0 if weighted else sketch_least(bands * rows, threshold)

    # bands alone are counted first: most are of one node and go no further
    met = materialize(members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket"), "met")
    maybe = materialize(perhaps_among(members, F.col("bucket"), met, "met", times=1).where("met").drop("met"), "bands")
    # of buckets with the same members one counts; members are told by two sums of hashes
    sums = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    centres = maybe.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("size"), *sums).where("size > 1")
    centres = materialize(centres.groupBy("centre", "size", "x1", "x2").agg(F.min("bucket").alias("bucket")).select("bucket", "centre", "size"), "buckets")
    shared = materialize(maybe.join(centres, "bucket"), "shared")
    discard(met, maybe, centres)
    stars = materialize(shared.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    both = stars.join(sketches.toDF("a", "a_sketch"), "a").join(sketches.toDF("b", "b_sketch"), "b").select("a", "b", "a_sketch", "b_sketch")
    # the second and last pass over the texts: sets of all nodes that share a bucket
    wanted = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    wanted = wanted.join(nodes.select("node", F.col("id").alias("own"), F.col("hash").alias("h")), "node")
    wanted = materialize(wanted.select("node", "h", F.xxhash64("own", "h").alias("k")), "wanted")
    # other texts, and copies of these, are left out before texts are shuffled; equal hashes are equal texts, of which one is taken where they meet
    near = perhaps_among(docs, F.xxhash64("id", "hash"), wanted.select("k"), "near").where("near").drop("near")
    asked = near.join(wanted, F.col("hash") == F.col("h")).groupBy("h", "node").agg(F.first("text").alias("text")).select("node", "text")
    sets = materialize(asked.mapInArrow(_shingler(width), "node bigint, shingles binary"), "shingle-sets")

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that are similar. A centre with many partners goes to a task for each ``PART`` of them."""
        pairs = materialize(pairs, "pairs")
        counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        dealt = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part"))
        theirs = dealt.join(sets.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "shingles")
        own = dealt.select("a", "part").distinct().join(sets.withColumnRenamed("node", "a"), "a").select("a", "part", F.col("a").alias("b"), "shingles")
        return materialize(theirs.unionByName(own).groupBy("a", "part").applyInPandas(_verifier(threshold), "a bigint, b bigint"), "links")

    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = linked(both.mapInPandas(_alike(least), "a bigint, b bigint"))
    found = components(links)
    left = shared.where("size > 2").select("bucket", "node", "size")  # two members were compared as centre and partner
    for last in (False, True):
        # buckets whose members aren't in one component yet
        placed = left.join(found.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        open_ = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.first("size").alias("size")).where("low <> high")
        open_ = materialize(open_.select("bucket", F.ceil(F.col("size") / block).cast("int").alias("parts")), "open-buckets")
        mine, i = F.col("mine"), F.col("with")
        tasks = (
            placed.drop("size").join(open_, "bucket").withColumn("mine", F.pmod(F.xxhash64("node"), "parts").cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("bucket", F.least(mine, i).alias("i"), F.greatest(mine, i).alias("j"), F.when(mine == i, 2).otherwise((mine > i).cast("int")).alias("side"), "node", "component")
        )
        # a pair of blocks (i, i) holds block i once; of (i, j) the two sides
        # partitions by number: the rows are small, and the work behind them isn't
        tasks = tasks.join(sketches, "node")
        if last:
            dealt = tasks.join(sets, "node").repartition(spread, "bucket", "i", "j").groupBy("bucket", "i", "j")
            more = materialize(dealt.applyInPandas(_joining_links(least, threshold), "a bigint, b bigint").distinct(), "links")
        else:
            dealt = tasks.repartition(spread, "bucket", "i", "j").groupBy("bucket", "i", "j")
            best = materialize(dealt.applyInPandas(_best_pairs(least), "bucket bigint, a bigint, b bigint"), "best-pairs")
            left = left.join(best.select("bucket").distinct(), "bucket", "left_semi")  # no pair of the others will be alike later
            more = linked(best.select("a", "b").distinct())
        if not more.isEmpty():
            links = links.unionByName(more)
            found = components(links)
    discard(shared, stars, sets)
    classes = nodes.select("node", "id", "hash").join(found.withColumnRenamed("id", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    head = classes.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "hash")).alias("head"))
    classes = classes.join(head, "component").select(F.col("node").alias("digest"), F.col("head.id").alias("class_id"), F.col("head.hash").alias("head_hash"), F.col("id").alias("copy_of"))
    out = rows_of.join(classes, "digest")
    names = [F.col("id").alias("doc_id"), "class_id", "copy_of"]
    if not keep_hash:
        return out.select(*names)
    return out.select(*names, "hash", (F.col("id").eqNullSafe(F.col("class_id")) & (F.col("hash") == F.col("head_hash"))).alias("keep"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the least id, and of rows that share it the least text by hash; of rows equal in both, all stay."""
    gone = near_duplicates(docs, keep_hash=True).where("NOT keep").select(F.col("doc_id").alias("gone_id"), F.col("hash").alias("gone_hash")).distinct()
    gone = materialize(gone, "near-copies")
    hash_ = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    # only texts that may be copies are shuffled
    told = perhaps_among(docs, F.xxhash64(F.col("doc_id").cast("long"), hash_), gone.select(F.xxhash64("gone_id", "gone_hash").alias("k")), "__maybe")
    maybe = told.where("__maybe").drop("__maybe")
    left = maybe.join(gone, maybe["doc_id"].eqNullSafe(gone["gone_id"]) & (F.xxhash64(F.coalesce(maybe["text"], F.lit(""))) == gone["gone_hash"]), "left_anti")
    return told.where("NOT __maybe").drop("__maybe").unionByName(left)
