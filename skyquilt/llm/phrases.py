"""Phrases of two to five words that occur together more often than their parts suggest, by suffix automata.

Three passes look for what can't be in a frequent phrase. The first counts the words of each language. The second counts 64-bit hashes of the pairs of
neighbours both of which are frequent words, the third those of the triples both of whose pairs are frequent; unlike ones that share a hash add up, so that none that is frequent is missed. What is
frequent goes to the tasks as a bit set of ``MOST_BITS`` bits at most; a bit set by another pair or triple costs time, and changes nothing.

The last pass cuts each text into runs of words in which all pairs and triples are frequent (runs may share a word, but no pair). A task gathers distinct runs with their numbers into
shards of about ``SHARD_WORDS`` words, and builds the generalised suffix automaton of each. Endpos counts, added up along the suffix links, are the counts of all
substrings of a state; those of two to ``LONGEST`` words are enumerated and added up over the shards, by the task and then by Spark. With each substring goes the word
that always precedes it (it isn't the longest of its state, so that its suffix link's end is shorter than itself and the longer members have its
occurrences) and the one that always follows it (a transition to a state of the same count), if there is one; a phrase is
subsumed if all shards name the same one. No longer candidate can have a phrase's count unless one longer by a word has it, so that
this is all containment.

Parts of candidates are as frequent as these, hence counted already; they are found by two joins. The best of a language are
ranked within parts of its candidates first.

Within a task words are told apart by 64-bit hashes, which unlike words share with a probability of about 2 ** -64; counts of single words are by the words themselves.

Defined cases: a null text has no words; a null language is ``und``; long texts are cut like others; repeated rows count as often as they occur; ties in score go by count,
then by the bytes of the phrase; an empty table gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyquilt.llm import ragged
from skyquilt.llm.common import materialize, table

LEAST, LONGEST, BEST = 100, 5, 2000
NO_LANG = "und"
SHARD_WORDS, HELD_KEYS, HELD_WORDS = 120_000, 4_000_000, 400_000
MOST_BITS = 1 << 26
#: Fixed values of the row contract: A to Z in lower case, and what ends a piece, which becomes a line feed.
_MAP = ragged.LOWER.copy()
_MAP[[*b".,;:!?", *range(0x0A, 0x0E)]] = 0x0A
_TABLE = _MAP.tobytes()
_FIRST = np.uint64(0x9E3779B97F4A7C15)


# -- passes over the texts


def _of_lang(lang: str | None) -> str:
    return NO_LANG if lang is None else lang


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each language and how many of them a task has met, as often as its memory asks for."""
    held: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            text = [w.decode("utf-8", "surrogatepass") for w in counts]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(text)), "word": pa.array(text), "n": pa.array(counts.values(), pa.int64())})
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text:
                held.setdefault(_of_lang(lang), Counter()).update(text.encode("utf-8", "surrogatepass").translate(_TABLE).split())
        if sum(map(len, held.values())) > HELD_WORDS:
            yield from flush()
    yield from flush()


def _lang_hashes(langs: list[str | None]) -> np.ndarray:
    known = {x: zlib.crc32(_of_lang(x).encode()) * 0x9E3779B97F4A7C15 & (1 << 64) - 1 for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple]:
    """For runs of texts: their bytes, starts and ends of words, each word's key and text, and whether the next word is in the same piece."""
    raw, offsets = ragged.buffers(batch.column(1))
    salt = _lang_hashes(batch.column(0).to_pylist())
    for i, j in ragged.pieces(offsets):
        part, at = _MAP[raw[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        starts, ends, before = ragged.words(part, at)
        if len(starts) < 2:
            continue
        text = np.repeat(np.arange(i, j), np.diff(before))
        piece = np.searchsorted(np.flatnonzero(part == 0x0A), starts) + text
        key = ragged.mix(ragged.hashes(part, starts, ends) ^ salt[text])
        yield part, starts, ends, key, text, (piece[1:] == piece[:-1])


def _hit(bits: bytes, key: np.ndarray) -> np.ndarray:
    """Which keys may be in the set."""
    store = np.frombuffer(bits, np.uint64)
    place = key & np.uint64(len(store) * 64 - 1)
    return (store[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0


def _pairs(key: np.ndarray) -> np.ndarray:
    """Keys of the pairs of neighbours."""
    return ragged.mix(key[:-1] * _FIRST + key[1:])


def _triples(pairs: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keys of three words in a row, from those of their first pairs and of single words."""
    return ragged.mix(pairs[:-1] * _FIRST + key[2:])


def _count_keys(words, pairs=None):
    """Hashes of pairs of neighbouring frequent words, or with ``pairs`` of three words whose pairs are frequent, and how many of them a task has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                key, n = np.unique(np.concatenate(held), return_counts=True)
                held.clear()
                for k in range(0, len(key), 100_000):
                    yield pa.RecordBatch.from_pydict({"key": pa.array(key[k : k + 100_000].view(np.int64)), "n": pa.array(n[k : k + 100_000], pa.int64())})

        for batch in batches:
            for _, _, _, key, _, joined in _tokens(batch):
                if pairs is None:
                    known = _hit(words.value, key)
                    held.append(_pairs(key)[joined & known[:-1] & known[1:]])
                else:
                    both = _pairs(key)
                    go = joined & _hit(pairs.value, both)
                    held.append(_triples(both, key)[go[:-1] & go[1:]])
                if sum(map(len, held)) > HELD_KEYS:
                    yield from flush()
        yield from flush()

    return run


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys that ``_tokens`` gives to words of languages."""
    for batch in batches:
        raw, offsets = ragged.buffers(batch.column(1))
        key = ragged.mix(ragged.hashes(raw, offsets[:-1], offsets[1:]) ^ _lang_hashes(batch.column(0).to_pylist()))
        yield pa.RecordBatch.from_pydict({"key": pa.array(key.view(np.int64))})


def bit_set(keys: DataFrame, most_bits: int = MOST_BITS) -> bytes:
    """A set of the lowest bits of 64-bit ``key``s, about 16 bits a key and ``most_bits`` at most, as 64-bit words."""
    n = keys.count()
    bits = min(most_bits, 1 << max(10, (16 * n).bit_length()))
    place = F.col("key").bitwiseAND(F.lit(bits - 1))
    parts = keys.groupBy(F.shiftright(place, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((key & {bits - 1}L) & 63 as int))")).alias("word"))
    store = np.zeros(bits // 64, np.int64)
    for batch in parts.toArrow().to_batches():  # bits / 64 rows at most
        store[batch.column("at").to_numpy()] = batch.column("word").to_numpy()
    return store.tobytes()


# -- automata


class Automaton:
    """A generalised suffix automaton of weighted runs of whole numbers."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count, self.end = [-1], [0], [0], [-1]
        self.text: list[int] = []

    def _clone(self, p: int, c: int, q: int) -> int:
        """A state of its own for those members of ``q`` that end a string of ``p`` and ``c``."""
        new = len(self.next)
        self.next.append(self.next[q].copy())
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        self.end.append(self.end[q])
        self.link[q] = new
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def add(self, run: list[int], weight: int) -> None:
        following, link, length = self.next, self.link, self.length
        last = 0
        for c in run:
            self.text.append(c)
            q = following[last].get(c)
            if q is not None:  # met before, in another run
                last = q if length[q] == length[last] + 1 else self._clone(last, c, q)
            else:
                new = len(following)
                following.append({})
                link.append(0)
                length.append(length[last] + 1)
                self.count.append(0)
                self.end.append(len(self.text) - 1)
                p = last
                while p != -1 and c not in following[p]:
                    following[p][c] = new
                    p = link[p]
                if p != -1:
                    q = following[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
                last = new
            self.count[last] += weight

    def substrings(self, least: int, most: int) -> Iterator[tuple[int, int, int, int, int]]:
        """``(start, end, count, before, after)`` of every distinct substring of ``least`` to ``most`` numbers: where it lies in ``text``, how often it occurs, and what always precedes and follows it (-1: nothing does)."""
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[v]] += self.count[v]
        for v in range(1, len(self.next)):
            shortest, longest = max(self.length[self.link[v]] + 1, least), min(self.length[v], most)
            if shortest > longest:
                continue
            count, end = self.count[v], self.end[v] + 1
            after = next((c for c, u in self.next[v].items() if self.count[u] == count), -1)
            for m in range(shortest, longest + 1):
                yield end - m, end, count, self.text[end - m - 1] if m < self.length[v] else -1, after


PHRASE_SCHEMA = "lang string, phrase string, m int, a bigint, before string, after string"


def _shards(pairs, triples, longest: int):
    """Substrings of the automata of a task's shards, added up as far as the task's memory goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[int, int] = {}
        names: list[tuple[str, str]] = []
        runs: Counter = Counter()
        found: dict[bytes, list[int]] = {}
        size = 0

        def build() -> None:
            """Add the substrings of the shard at hand to those of the shards before."""
            nonlocal size
            machine = Automaton()
            for raw, weight in runs.items():
                machine.add(np.frombuffer(raw, np.int32).tolist(), weight)
            text = np.array(machine.text, np.int32).tobytes()
            for start, end, count, before, after in machine.substrings(2, longest):
                if end - start == longest:  # longer ones aren't candidates
                    before = after = -1
                held = found.setdefault(text[4 * start : 4 * end], [0, before, after])
                held[0] += count
                if held[1] != before:
                    held[1] = -1
                if held[2] != after:
                    held[2] = -1
            runs.clear()
            size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            name = lambda c: None if c < 0 else names[c][1]
            rows: list[tuple] = []
            for raw, (count, before, after) in found.items():
                x = np.frombuffer(raw, np.int32).tolist()
                rows.append((names[x[0]][0], " ".join([names[c][1] for c in x]), len(x), count, name(before), name(after)))
                if len(rows) == 50_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
            ids.clear()
            names.clear()
            found.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for part, starts, ends, key, text, joined in _tokens(batch):
                both = _pairs(key)
                go = joined & _hit(pairs.value, both)
                linked = go[:-1] & go[1:] & _hit(triples.value, _triples(both, key))  # a pair goes on into the next one
                first_pairs = np.flatnonzero(go & ~np.concatenate([[False], linked]))
                last_pairs = np.flatnonzero(go & ~np.concatenate([linked, [False]]))
                inside = np.zeros(len(key), bool)
                inside[:-1] |= go
                inside[1:] |= go
                words = np.flatnonzero(inside)
                if not len(words):
                    continue
                unique, first, which = np.unique(key[words], return_index=True, return_inverse=True)
                known = []
                for k, w in zip(unique.tolist(), words[first].tolist(), strict=True):
                    if k not in ids:
                        ids[k] = len(names)
                        names.append((_of_lang(langs[text[w]]), part[starts[w] : ends[w]].tobytes().decode("utf-8", "surrogatepass")))
                    known.append(ids[k])
                number = np.zeros(len(key), np.int32)
                number[words] = np.array(known, np.int32)[which]
                flat = number.tobytes()
                cut = [flat[4 * a : 4 * b + 8] for a, b in zip(first_pairs.tolist(), last_pairs.tolist(), strict=True)]
                size += sum(map(len, set(cut) - runs.keys())) // 4
                runs.update(cut)
                if size > SHARD_WORDS:
                    build()
                    if len(found) > HELD_WORDS:
                        yield from flush()
        build()
        yield from flush()

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    lang, phrase, m, a, before, after = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(phrase), pa.array(m, pa.int32()), pa.array(a, pa.int64()), pa.array(before, pa.string()), pa.array(after, pa.string())], ["lang", "phrase", "m", "a", "before", "after"])


# -- counts, scores and ranks


def _always(word: str) -> Column:
    """Whether all shards name the same word."""
    return (F.count(word) == F.count(F.lit(1))) & (F.min(word) == F.max(word))


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``lang, word, n`` of all words, and ``lang, phrase, m, a, subsumed`` of the phrases of two words and more that occur ``least`` times."""
    sc = docs.sparkSession.sparkContext
    docs = docs.select("lang", "text")
    words = materialize(docs.mapInArrow(_count_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    frequent = materialize(words.where(F.col("n") >= least).select("lang", "word").mapInArrow(_word_keys, "key bigint"), "word-keys")
    known = sc.broadcast(bit_set(frequent))
    frequent_keys = lambda f, name: materialize(docs.mapInArrow(f, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("key"), name)
    pairs = sc.broadcast(bit_set(frequent_keys(_count_keys(known), "pair-keys")))
    triples = sc.broadcast(bit_set(frequent_keys(_count_keys(known, pairs), "triple-keys")))
    found = docs.mapInArrow(_shards(pairs, triples, longest), PHRASE_SCHEMA).groupBy("lang", "phrase")
    phrases = found.agg(F.max("m").alias("m"), F.sum("a").alias("a"), (_always("before") | _always("after")).alias("subsumed")).where(F.col("a") >= least)
    return words, materialize(phrases, "phrases")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST) -> DataFrame:
    """The ``best`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    words, phrases = counted(docs, least, longest)
    parts = phrases.select("lang", "phrase", "a").unionByName(words.where(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), F.col("n").alias("a")))
    word = F.split("phrase", " ")
    cuts = phrases.where(~F.col("subsumed")).select("lang", "phrase", "a", word.alias("w"), F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    joined = lambda array: F.array_join(array, " ")
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.slice("w", F.lit(1), F.col("k"))).alias("left"), joined(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k"))).alias("right"))
    side = lambda name, count: parts.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    known = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(totals, "lang")
    wide = lambda c: f"cast({c} as decimal(19,0))"
    score = F.expr(f"({wide('a')} * {wide('n')} * 1000) div ({wide('l')} * {wide('r')})")
    lowest = known.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r", "n")).alias("s")).select("lang", "phrase", "s.*")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = lowest.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= best)  # 64 * best rows a language are left
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS MATERIALIZED (
    SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words), range(1, 6) AS t(m) WHERE i + m - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM grams WHERE m = 1 GROUP BY ALL),
frequent AS MATERIALIZED (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM grams WHERE a >= 100),
candidates AS (SELECT * FROM frequent WHERE m > 1),
inner_ones AS (
    SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, max(a) AS longer
    FROM candidates, range(2, 5) AS t(k), range(1, 5) AS u(i) WHERE k < m AND i + k - 1 <= m GROUP BY ALL),
kept AS (SELECT c.* FROM candidates AS c LEFT JOIN inner_ones AS x USING (lang, phrase) WHERE x.longer IS NULL OR 100 * x.longer < 100 * c.a),
halves AS (SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS tail FROM kept, range(1, 5) AS t(k) WHERE k < m),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, n, (CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.a AS HUGEINT) * y.a) AS score
    FROM halves AS c JOIN totals AS t ON t.lang = c.lang
    JOIN frequent AS x ON x.lang = c.lang AND x.phrase = c.head JOIN frequent AS y ON y.lang = c.lang AND y.phrase = c.tail),
lowest AS (SELECT lang, phrase, a, l, r, n, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM lowest QUALIFY rank <= 2000
"""
