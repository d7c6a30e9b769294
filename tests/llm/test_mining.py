"""Phrases, the factorisation machine and vector codes against brute force, with nulls, ties, repeats and empty tables."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyquilt.llm import common, near_dup, phrases, quality_fm, vector_codes

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- phrases


def brute_phrases(rows, least, best=2000):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 6):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = set()
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        found = []
        for p, a in cands.items():
            if any(len(q) > len(p) and b >= a and inside(p, q) for q, b in cands.items()):
                continue
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


@pytest.mark.parametrize("shard_words", [3, 100_000])
def test_phrases(spark, monkeypatch, shard_words):
    """Whatever the shards' size; words in capitals, pieces, null and clashing languages, equal scores, rare words between frequent ones."""
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard_words)
    rng = random.Random(5)
    common = ["New", "york", "the", "of", "a", "naïve", "日本", "x-y"]
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice([*common, "in a far off land", f"rare{rng.random()}", "go.on", "tab\tthe\n"]) for _ in range(rng.randrange(60)))) for _ in range(400)]
    rows += [("en", "once upon a time there was"), ("en", "once upon a time there was")] * 20 + [("en", None), ("fr", ""), (None, "UPON A time"), ("en", "a " * 5000)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3).withColumns({c: F.lit("x") for c in ("word", "phrase", "a", "n", "key", "rank")})
    for least, best in ((12, 2000), (20, 7)):
        got = phrases.collocations(df, least, best=best)
        assert {tuple(r) for r in got.collect()} == brute_phrases(rows, least, best) and got.count() > 20
    assert phrases.collocations(df.limit(0), 5).count() == 0


def test_automaton():
    """Counts, and what always precedes and follows, of all substrings."""
    rng = random.Random(7)
    runs = [([rng.randrange(3) for _ in range(rng.randrange(1, 9))], rng.randrange(1, 4)) for _ in range(60)]
    machine = phrases.Automaton()
    for run, weight in runs:
        machine.add(run, weight)
    count, before, after = Counter(), defaultdict(set), defaultdict(set)
    for run, weight in runs:
        for i in range(len(run)):
            for j in range(i + 1, min(len(run), i + 5) + 1):
                x = tuple(run[i:j])
                count[x] += weight
                before[x].add(run[i - 1] if i else None)
                after[x].add(run[j] if j < len(run) else None)
    got = {tuple(machine.text[s:e]): (n, b, a) for s, e, n, b, a in machine.substrings(1, 5)}
    assert {x: v[0] for x, v in got.items()} == dict(count)
    only = lambda s: next(iter(s)) if len(s) == 1 and None not in s else -1
    assert all((b, a) == (only(before[x]), only(after[x])) for x, (_, b, a) in got.items())


def test_bit_set(spark):
    rng = np.random.Generator(np.random.PCG64(3))
    keys = rng.integers(-(2**63), 2**63 - 1, 5000)
    bits = phrases.bit_set(spark.createDataFrame([(int(k),) for k in keys], "key bigint"))
    assert len(bits) == 1 << 14 and phrases._hit(bits, keys.view(np.uint64)).all()
    others = rng.integers(-(2**63), 2**63 - 1, 5000).view(np.uint64)
    assert phrases._hit(bits, others).mean() < 0.1
    small = phrases.bit_set(spark.createDataFrame([(int(k),) for k in keys], "key bigint"), 1 << 10)
    assert len(small) == 128 and phrases._hit(small, keys.view(np.uint64)).all()
    assert not phrases._hit(phrases.bit_set(spark.createDataFrame([], "key bigint")), others).any()


# -- factorisation machine


def test_pairs_by_squares():
    """The score equals the sum over all pairs of inputs."""
    rng = np.random.Generator(np.random.PCG64(4))
    machine = quality_fm.Machine(0.3, rng.standard_normal(quality_fm.N_INPUTS), rng.standard_normal((quality_fm.N_INPUTS, quality_fm.RANK)) / 3)
    texts = ["a b c a", None, "", "one two\none two\nthree $$$ !!", "x " * 3000, "naïve 日本 Café"]
    ((at, x, first),) = quality_fm.batches_of_inputs(pa.array(texts), pa.array([7, None, 0, 30, 6000, 15], pa.int64()))
    got = machine.raw(at, x, first)[0]
    for k, (i, j) in enumerate(zip(first, [*first[1:], len(at)], strict=True)):
        a, b = at[i:j], x[i:j]
        pairs = sum(float(machine.v[a[p]] @ machine.v[a[q]]) * b[p] * b[q] for p in range(len(a)) for q in range(p))
        assert math.isclose(got[k], machine.w0 + float(machine.w[a] @ b) + pairs, rel_tol=1e-9, abs_tol=1e-9)


def test_inputs_do_not_depend_on_neighbours():
    texts = ["Alpha beta.\nAlpha beta.\n\ngamma 12 $", "", "UPPER CASE!! yes", "a", None]
    column, sizes = pa.array(texts), pa.array([1, 2, None, 4, 5], pa.int64())
    ((at, x, first),) = quality_fm.batches_of_inputs(column, sizes)
    for k in range(len(texts)):
        ((a, b, _),) = quality_fm.batches_of_inputs(column.slice(k, 1), sizes.slice(k, 1))
        span = slice(first[k], first[k + 1] if k + 1 < len(first) else None)
        assert (at[span] == a).all() and np.allclose(x[span], b)
        words = (texts[k] or "").encode().split()
        assert np.isclose((b[quality_fm.N_STATS :] ** 2).sum(), 1.0 if words else 0.0) and len(b) == quality_fm.N_STATS + len(set(words))


def test_gradient():
    """A step of training moves against the loss."""
    ((at, x, first),) = quality_fm.batches_of_inputs(pa.array(["good words here", "b@d *** $$$ !!"]), pa.array([15, 14], pa.int64()))
    machine, state = quality_fm.Machine.new(), [np.zeros(1), np.zeros(quality_fm.N_INPUTS), np.zeros((quality_fm.N_INPUTS, quality_fm.RANK))]
    y, losses = np.array([1.0, 0.0]), []
    for _ in range(20):
        p = machine.score(at, x, first)
        losses.append(-np.log(np.where(y == 1, p, 1 - p)).mean())
        machine.train(iter([(at, x, first, y, np.ones(2))]), state)
    assert losses[-1] < 0.2 < losses[0] and losses == sorted(losses, reverse=True)


def test_quality_machine(spark):
    """Held-out accuracy; every row scored; the held-out rows and the labels' columns as they must be."""
    sf = "/root/testdata/sf0.01"
    rows = quality_fm.op12_quality_machine(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    told = [(quality[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in quality]
    assert len(told) > 80 and sum(a == b for a, b in told) / len(told) > 0.95


def test_quality_machine_odd(spark):
    docs = spark.createDataFrame([(1, "a b", 3), (2, None, None), (3, "", 0), (None, "x y z", 5), (1, "a b", 3), (5, "w " * 50_000, 100_000)], "doc_id long, text string, n_chars long").withColumns({c: F.lit("x") for c in ("h", "y", "weight", "score", "lang")})
    none = spark.createDataFrame([], "doc_id long, quality int")
    machine = quality_fm.fit(quality_fm.sample(docs, none, "quality", quality_fm.held_out, 10))
    assert [r.score for r in quality_fm.scores(docs, machine).collect()] == [0.5] * 6
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (3, 1), (5, None), (None, 1), (77, 1)], "doc_id long, quality int")
    taken = quality_fm.sample(docs, labels, "quality", lambda c: F.lit(False), 10).collect()
    assert sorted((r.y, r.text) for r in taken if r.y == 1) == [(1, "a b")] and [(r.text, r.n_chars) for r in taken if r.y == 0] == [(None, None)]
    bounded = quality_fm.sample(docs, labels, "quality", lambda c: F.lit(False), 1).collect()
    assert len(bounded) <= 2 and all(r.weight in (1.0, 2.0) for r in bounded)
    fitted = quality_fm.fit(quality_fm.sample(docs, labels, "quality", lambda c: F.lit(False), 10))
    by = {r.doc_id: r.score for r in quality_fm.scores(docs, fitted).collect()}
    assert by[1] > by[2] and quality_fm.scores(docs.limit(0), fitted).count() == 0


# -- vector codes


def brute_codes(rows, parts=16, entries=64, rounds=2):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, lab, [math.floor(x * 256) for x in v]) for i, v, lab in rows if ok(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    width = len(kept[0][2]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(r[2], p) for r in kept[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for r in kept:
                groups[near(cut(r[2], p), books[p])[1]].append(cut(r[2], p))
            books[p] = [[sum(c) // len(groups[e]) for c in zip(*groups[e], strict=True)] if e in groups else old for e, old in enumerate(books[p])]
    found = [(r[0], r[1], [near(cut(r[2], p), books[p]) for p in range(parts)]) for r in kept]
    sums = Counter()
    for _, lab, f in found:
        sums[lab] += sum(d for d, _ in f)
    return Counter((i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), sums[lab]) for i, lab, f in found), books


def test_nearest():
    """Ties between equal and equally far entries go to the lower index."""
    rng = np.random.Generator(np.random.PCG64(9))
    for n, high in ((1, 3), (5, 2), (64, 3), (64, 400), (200, 9)):
        entries, points = rng.integers(-high, high, (n, 4)), rng.integers(-high, high, (3000, 4))
        index, d = vector_codes.Tree(entries).nearest(points)
        every = ((points[:, None] - entries) ** 2).sum(axis=2)
        assert (index == every.argmin(axis=1)).all() and (d == every.min(axis=1)).all()


def test_vector_codes(spark):
    """Coarse values make many ties; nulls, infinite components, repeated ids, null labels and ids."""
    rng = random.Random(3)
    f32 = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    rows = [(rng.choice([i, 3 * i, None]), [f32(rng.randrange(-4, 4) / rng.choice([256, 300])) for _ in range(32)], rng.choice([None, 1, 2, i])) for i in range(300)]
    rows += [(1, None, 1), (2, [1.0] * 31 + [None], 1), (3, [float("nan")] * 32, 1), (4, [float("-inf")] * 32, 2), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).withColumns({c: F.lit("x") for c in ("v", "code", "error", "slot")})
    coded, books = vector_codes.compress(df)
    got = vector_codes.with_label_error(coded, 20)
    want, want_books = brute_codes(rows)
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()) == want and books.tolist() == want_books
    few, small = vector_codes.compress(df.where("vec_id < 40"))
    assert small.shape[1] == few.count() < 64
    none, no_books = vector_codes.compress(df.limit(0))
    assert vector_codes.with_label_error(none).count() == 0 and no_books is None
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1), (2, [0.5, 2.0, 3.0], 1)], "vec_id long, embedding array<double>, label int")
    assert [r.code for r in vector_codes.compress(odd)[0].orderBy("vec_id").collect()] == ["00" * 16, "01" + "00" * 15]
    with pytest.raises(ValueError, match="length"):
        vector_codes.compress(odd.union(spark.createDataFrame([(9, [1.0], 1)], odd.schema)))


def test_perhaps_among(spark):
    """No row that is among the keys is told otherwise, few others are taken for one; the texts of a few near copies don't bring the others into a shuffle."""
    keys = common.materialize(spark.range(0, 5000).select(F.xxhash64("id").alias("k")).unionByName(spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,)], "k long")), "keys")
    df = spark.range(0, 50_000).select("id", F.xxhash64("id").alias("h")).unionByName(spark.createDataFrame([(-1, -(2**63)), (-2, 2**63 - 1), (-3, 0), (-4, None)], "id long, h long"))
    got = {r.id: r.maybe for r in common.perhaps_among(df, F.col("h"), keys, "maybe").collect()}
    assert len(got) == 50_004 and all(got[k] for k in (*range(5000), -1, -2, -3)) and not got[-4]
    assert sum(got[k] for k in range(5000, 50_000)) < 0.2 * 45_000
    assert not any(r.maybe for r in common.perhaps_among(df, F.col("h"), common.materialize(keys.limit(0), "keys"), "maybe").collect())
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(200)] + [(1000 + i, " ".join(f"w{i}x{k}" for k in range(40)) + " end") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = near_dup.stage(spark, docs, "")
    assert sorted(r.doc_id for r in left.collect()) == list(range(200))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = near_dup.stage(spark, docs, "")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.startswith("Union") and "LeftAnti" in plan


def test_few_texts_are_shuffled(spark, monkeypatch):
    """Hardly a row is taken for one of the keys in vain; of a text with many copies one alone is sent to the sets; bands are counted before their nodes are sent."""
    keys = common.materialize(spark.range(0, 5000).select(F.xxhash64("id").alias("k")), "keys")
    told = common.perhaps_among(spark.range(5000, 50_000).select(F.xxhash64("id").alias("h")), F.col("h"), keys, "maybe")
    assert told.where("maybe").count() < 0.02 * 45_000
    seen, perhaps_among = defaultdict(int), near_dup.perhaps_among

    def noted(df, key, keys, name, **kw):
        out = perhaps_among(df, key, keys, name, **kw)
        seen[name] += out.where(name).count()
        return out

    monkeypatch.setattr(near_dup, "perhaps_among", noted)
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    rows = [(i, text(i)) for i in range(100)] + [(1000 + k, text(7)) for k in range(300)] + [(2000, text(7) + " end"), (None, text(8)), (None, text(8)), (7, text(7))]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in got.where("doc_id IS NOT NULL").collect()} == {i: 7 if i >= 1000 else i for i, _ in rows if i is not None}
    assert got.count() == len(rows) and [r.class_id for r in got.where("doc_id IS NULL").collect()] == [8, 8]
    assert seen["near"] <= 6


def test_bands_are_joined_once(spark, monkeypatch):
    """Bands that no other node has are left out before they are shuffled to the buckets, and the buckets' members are found once, not in each round."""
    written, materialize = [], near_dup.materialize

    def noted(df, name):
        out = materialize(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(near_dup, "materialize", noted)
    text = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    rows = [(i, text(i, 40)) for i in range(100)] + [(1000 + i, text(i, 40) + " end") for i in range(3)] + [(2000 + i, text(i, 39)) for i in range(3)]
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i % 1000 for i, _ in rows}
    shared = [n for name, n in written if name == "shared"]
    assert len(shared) == 1 and 6 <= shared[0] <= 9 * near_dup.BANDS
