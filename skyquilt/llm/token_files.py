"""Token-id files, compressed by a grammar of id pairs for each shard.

Documents are cut into ranges of ascending ids of about ``shard_bytes`` of text. A task encodes the texts of a range,
appends an end id to each document, and goes on in a further file after about ``file_bytes`` of ids. The ids of a file
are compressed by Re-Pair: the most frequent neighbouring pairs are replaced by nonterminals until no pair repeats (``pair_grammar``).
No pair holds an end id, so that a document is a run of whole symbols. A file stores the rules, the expansion length of each
symbol, and for each document its place in tokens and in symbols: any tokens of any document are decoded without the rest.

Layout, little-endian: magic, counts and bits a number; rules (left, right) and expansion lengths, packed; document ids (int64),
their null flags (uint8), token places and symbol places (int64, one more than documents); symbols, packed.

The encoder splits a text at white space, and words further where the tokenizer's own pattern surely does, and encodes each
distinct piece once a worker. That gives what the whole text gives for a tokenizer whose pre-tokenizer drops white space and never
joins across it, which the one used here does.

Defined cases: a null text is empty and has the end id alone; a null id comes first; equal ids are ordered by text, and
may go into several files of one shard; an empty table gives no files;
columns other than those named are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyquilt.llm import ragged
from skyquilt.llm.common import id_ranges, materialize, new_path, range_of, table
from skyquilt.llm.files import read_random, whole_file

MAGIC = b"SQTOKEN1"
MANIFEST_SCHEMA = "shard int, part int, file string, docs bigint, tokens bigint, symbols bigint, rules bigint, bytes bigint"


#: Fixed value: the pattern of a pre-tokenizer under which words fall into the pieces of ``ragged.pieces_of_words``.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What a worker has encoded, by tokenizer; its later tasks need not encode it again.
_known: dict[str, ragged.Encoder] = {}


def word_encoder(path: str | Callable[[], str]) -> Callable[[], ragged.Encoder]:
    """A function for tasks that gives the encoder of words of the tokenizer at ``path``, or at the path that ``path()`` gives in the task."""

    def load() -> ragged.Encoder:
        place = path() if callable(path) else path
        if place in _known:
            return _known[place]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import json

        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(place)
        ids = lambda coder: lambda texts: [e.ids for e in coder.encode_batch_fast(texts, add_special_tokens=False)]
        steps = json.loads(tokenizer.to_str())
        kinds = [n["type"] for n in (steps["normalizer"] or {}).get("normalizers", [])]
        split = (steps["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        plain = None
        if kinds == ["NFC", "Replace", "Lowercase"] and split.get("pattern") == {"Regex": PIECES} and split.get("invert") and split.get("behavior") == "Removed":
            # a piece in lower case needs no normaliser and no pattern
            bare = Tokenizer(tokenizer.model)
            bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            plain = ids(bare)
        _known[place] = ragged.Encoder(ids(tokenizer), 2_000_000, plain)
        return _known[place]

    return load


def encode_texts(encoder: ragged.Encoder, column: pa.Array, end_id: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: first and last, all their ids with an end id after each text, and how many each has."""
    raw, offsets = ragged.buffers(column)
    for i, j in ragged.pieces(offsets):
        part, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        if encoder.plain:
            part, starts, ends, before, plain = ragged.pieces_of_words(part, at)
            ids, n = encoder(part, starts, ends, plain)
        else:
            starts, ends, before = ragged.words(part, at)
            ids, n = encoder(part, starts, ends)
        place = np.concatenate([[0], np.cumsum(n)])[before]  # ids before each text
        out = np.full(len(ids) + j - i, end_id, np.int32)
        mask = np.ones(len(out), bool)
        mask[place[1:] + np.arange(j - i)] = False
        out[mask] = ids
        yield i, j, out, np.diff(place) + 1


def _winners(place: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the ascending places to take: no two neighbours, the lower rank first, until no more fit."""
    taken = np.zeros(len(place), bool)
    left = np.arange(len(place))
    while len(left):
        p, r = place[left], rank[left]
        beside = np.diff(p) == 1
        wins = np.ones(len(left), bool)
        wins[1:] &= ~beside | (r[1:] < r[:-1])
        wins[:-1] &= ~beside | (r[:-1] <= r[1:])
        taken[left[wins]] = True
        gone = wins.copy()
        gone[1:] |= beside & wins[:-1]
        gone[:-1] |= beside & wins[1:]
        left = left[~gone]
    return taken


def pair_grammar(ids: np.ndarray, first_symbol: int, end_id: int, least: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, rules)``: rule k stands for the pair ``rules[k]`` and has the number ``first_symbol + k``.

    Pairs are replaced until none occurs ``least`` times. A round takes all pairs that occur ``level`` times or more together, and lowers
    the level fourfold, from the highest count down to ``least``, where rounds go on until none is left. Where two occurrences
    overlap, the more frequent pair has it, and in a run of one symbol every second place is taken. Counts are exact. A pair that
    doesn't repeat can't repeat later, as later rounds only make pairs with new symbols; so a late round looks at the places
    whose pair repeated in the round before and at those beside new symbols.
    """
    a, rules, n_rules, level = ids.astype(np.uint32), [], 0, len(ids)
    live = np.arange(max(len(a) - 1, 0), dtype=np.int32)
    while len(live):
        whole = 2 * len(live) > len(a)  # look at every place rather than gather most of them
        left, right = (a[:-1], a[1:]) if whole else (a[live], a[live + 1])
        bits = min(20, max(8, len(left).bit_length()))
        bucket = (left * np.uint32(0x9E3779B1) + right * np.uint32(0x85EBCA77)) >> np.uint32(32 - bits)
        bucket = bucket.astype(np.intp)
        bucket[(left == end_id) | (right == end_id)] = 1 << bits
        counts = np.bincount(bucket, minlength=(1 << bits) + 1)
        counts[-1] = 0
        # counts by hash are never below a pair's own: what they leave out doesn't repeat
        level = max(least, min(level, int(counts.max())) // 4)
        at = np.flatnonzero((counts >= level)[bucket])
        if not whole:
            some = (counts >= least)[bucket]
        key = (left[at].astype(np.uint64) << np.uint64(32)) | right[at]
        place = at if whole else live[at]
        # in a run of one pair every second place
        opens = np.ones(len(place), bool)
        opens[1:] = (np.diff(place) != 1) | (key[1:] != key[:-1])
        spot = np.arange(len(place))
        first = ((spot - np.maximum.accumulate(np.where(opens, spot, 0))) & 1) == 0
        place = place[first]
        pairs, which, n = np.unique(key[first], return_inverse=True, return_counts=True)
        rank = np.empty(len(pairs), np.int64)
        rank[np.argsort(-n, kind="stable")] = np.arange(len(pairs))
        on = (n >= level)[which]
        place, which = place[on], which[on]
        if level == least:
            kept = place  # no other pair repeats
        elif not whole:
            kept = live[some]
        taken = _winners(place, rank[which])
        place, which = place[taken], which[taken]
        n = np.bincount(which, minlength=len(pairs))
        made = np.flatnonzero(n >= least)
        made = made[np.argsort(rank[made])]
        number = np.full(len(pairs), -1, np.int64)
        number[made] = np.arange(len(made))
        on = number[which] >= 0
        place, symbol = place[on], (number[which][on] + first_symbol + n_rules).astype(np.uint32)
        if len(made):
            rules.append(np.stack([pairs[made] >> np.uint64(32), pairs[made] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
            n_rules += len(made)
        elif level == least:
            break
        a[place] = symbol
        stay = np.ones(len(a), bool)
        stay[place + 1] = False
        a = a[stay]
        if whole and level > least:
            live = np.arange(len(a) - 1, dtype=np.int32)
            continue
        to = np.cumsum(stay, dtype=np.int32) - 1  # where each place goes
        seen = np.zeros(len(a) + 1, bool)
        seen[to[kept[stay[kept]]]] = True
        seen[to[place]] = True
        seen[to[place] - 1] = True  # before the first place: the last entry, which is cut off
        live = np.flatnonzero(seen[: len(a) - 1]).astype(np.int32)
    return a, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def generations(rules: np.ndarray, first_symbol: int) -> Iterator[tuple[int, int]]:
    """Runs of rules that name only symbols from before the run."""
    start, last = 0, rules.max(axis=1).astype(np.int64) - first_symbol if len(rules) else np.zeros(0, np.int64)
    while start < len(rules):
        step = 1024  # the run's end is looked for in growing windows
        while True:
            beyond = last[start : start + step] >= start
            if beyond.any() or start + step >= len(rules):
                break
            step *= 4
        end = start + int(beyond.argmax()) if beyond.any() else len(rules)
        yield start, end
        start = end


def symbol_lengths(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    """How many ids each symbol stands for, ids themselves included."""
    out = np.ones(first_symbol + len(rules), np.int64)
    for a, b in generations(rules, first_symbol):
        out[first_symbol + a : first_symbol + b] = out[rules[a:b, 0]] + out[rules[a:b, 1]]
    return out


class Expander:
    """Expands symbols: those of up to ``SHORT`` ids from a store, longer ones by their rules until they are short."""

    SHORT = 64

    def __init__(self, rules: np.ndarray, first_symbol: int):
        self.rules, self.first = rules, first_symbol
        self.lengths = symbol_lengths(rules, first_symbol)
        short = np.where(self.lengths <= self.SHORT, self.lengths, 0)
        self.offsets = np.cumsum(short) - short
        self.store = np.empty(int(short.sum()), np.uint32)
        self.store[:first_symbol] = np.arange(first_symbol)
        for a, b in generations(rules, first_symbol):
            mine = np.arange(a, b) + first_symbol
            mine = mine[short[mine] > 0]
            left, right = rules[mine - first_symbol, 0], rules[mine - first_symbol, 1]
            for part, at in ((left, self.offsets[mine]), (right, self.offsets[mine] + self.lengths[left])):
                n = self.lengths[part]
                if len(n):
                    first = np.cumsum(n) - n
                    self.store[np.repeat(at - first, n) + np.arange(int(n.sum()))] = ragged.gather(self.store, self.offsets[part], n)

    def __call__(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols.astype(np.int64)
        long = self.lengths[symbols] > self.SHORT
        if long.any():
            # each distinct long symbol as a sequence of short ones
            distinct, which = np.unique(symbols[long], return_inverse=True)
            parts, owner = distinct, np.arange(len(distinct))
            while (wide := self.lengths[parts] > self.SHORT).any():
                spot = np.cumsum(1 + wide) - 1 - wide
                out = np.empty(len(parts) + int(wide.sum()), np.int64)
                out[spot[~wide]] = parts[~wide]
                out[spot[wide]], out[spot[wide] + 1] = self.rules[parts[wide] - self.first].T
                parts, owner = out, np.repeat(owner, 1 + wide)
            n = np.bincount(owner, minlength=len(distinct))
            place, count = np.arange(len(symbols)), np.ones(len(symbols), np.int64)
            place[long], count[long] = (len(symbols) + np.cumsum(n) - n)[which], n[which]
            symbols = ragged.gather(np.concatenate([symbols, parts]), place, count)
        return ragged.gather(self.store, self.offsets[symbols], self.lengths[symbols])


def pack(values: np.ndarray, bits: int) -> bytes:
    """Numbers of ``bits`` bits each, one after another; groups of eight numbers start at whole bytes."""
    if not bits:
        return b""
    padded = np.zeros(-(-len(values) // 8) * 8, ">u4")
    padded[: len(values)] = values
    out = []
    for i in range(0, len(padded), 1 << 18):  # bounds what is held
        spread = np.unpackbits(padded[i : i + (1 << 18)].view(np.uint8).reshape(-1, 4), axis=1)
        out.append(np.packbits(spread[:, 32 - bits :]).tobytes())
    return b"".join(out)


def unpack(raw: bytes, bits: int, start: int, end: int) -> np.ndarray:
    """Numbers ``start`` to ``end`` of those that begin with ``raw``."""
    if not bits:
        return np.zeros(end - start, np.uint32)
    data = np.frombuffer(raw + bytes(5), np.uint8)
    at = np.arange(start, end, dtype=np.int64) * bits
    first, window = at >> 3, np.zeros(end - start, np.uint64)
    for k in range(5):  # forty bits hold any number of up to 32
        window = (window << np.uint64(8)) | data[first + k]
    return ((window >> (np.uint64(40 - bits) - (at & 7).astype(np.uint64))) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def packed_bytes(n: int, bits: int) -> int:
    return -(-n // 8) * bits


def write_file(uri: str, doc_ids: list[int | None], ids: np.ndarray, n_tokens: np.ndarray, vocabulary: int, end_id: int, **grammar) -> dict:
    symbols, rules = pair_grammar(ids, vocabulary, end_id, **grammar)
    every = symbol_lengths(rules, vocabulary)
    token_at = np.concatenate([[0], np.cumsum(n_tokens)]).astype(np.int64)
    ends = np.cumsum(every[symbols]) if len(symbols) else np.zeros(0, np.int64)
    symbol_at = np.concatenate([[0], np.searchsorted(ends, token_at[1:]) + 1]).astype(np.int64)
    lengths = every[vocabulary:]
    bits, length_bits = (vocabulary + len(rules) - 1).bit_length(), int(lengths.max()).bit_length() if len(rules) else 0
    head = np.array([len(doc_ids), int(token_at[-1]), len(symbols), len(rules), vocabulary, end_id, bits, length_bits], "<u8")
    parts = [
        MAGIC, head.tobytes(), pack(rules.reshape(-1), bits), pack(lengths, length_bits),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is None for x in doc_ids], "u1").tobytes(),
        token_at.astype("<i8").tobytes(), symbol_at.astype("<i8").tobytes(), pack(symbols, bits),
    ]
    with whole_file(uri) as out:
        for x in parts:
            out.write(x)
    return {"docs": len(doc_ids), "tokens": int(token_at[-1]), "symbols": len(symbols), "rules": len(rules), "bytes": sum(map(len, parts))}


class TokenFile:
    """A file opened for reading: its tables are read at once, symbols only where they are asked for."""

    def __init__(self, uri: str):
        self.file = read_random(uri)
        if self.file.read(8) != MAGIC:
            raise ValueError(f"not a token file: {uri}")
        self.n_docs, self.n_tokens, self.n_symbols, n_rules, self.vocabulary, self.end_id, self.bits, length_bits = (int(x) for x in self._read("<u8", 8))
        self.rules = self._packed(2 * n_rules, self.bits).reshape(-1, 2)
        self.rule_lengths = self._packed(n_rules, length_bits)
        self.doc_ids, self.doc_null = self._read("<i8", self.n_docs), self._read("u1", self.n_docs)
        self.token_at, self.symbol_at = self._read("<i8", self.n_docs + 1), self._read("<i8", self.n_docs + 1)
        self.symbols_start = self.file.tell()
        self._expander = None

    def _read(self, kind: str, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read(n * np.dtype(kind).itemsize), kind)

    def _packed(self, n: int, bits: int) -> np.ndarray:
        return unpack(self.file.read(packed_bytes(n, bits)), bits, 0, n)

    def symbols(self, start: int, end: int) -> np.ndarray:
        group = start // 8
        self.file.seek(self.symbols_start + group * self.bits)
        return unpack(self.file.read((-(-end // 8) - group) * self.bits), self.bits, start - 8 * group, end - 8 * group)

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        if self._expander is None:
            self._expander = Expander(self.rules, self.vocabulary)
        return self._expander(symbols)

    def tokens(self, doc: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Tokens ``start`` to ``end`` of the file's document number ``doc``; only the symbols that cover them are expanded."""
        n = int(self.token_at[doc + 1] - self.token_at[doc])
        start, end = max(0, min(start, n)), n if end is None else max(0, min(end, n))
        if start >= end:
            return np.zeros(0, np.uint32)
        symbols = self.symbols(int(self.symbol_at[doc]), int(self.symbol_at[doc + 1]))
        lengths = np.where(symbols < self.vocabulary, 1, self.rule_lengths[np.maximum(symbols.astype(np.int64) - self.vocabulary, 0)] if len(self.rules) else 1)
        ends = np.cumsum(lengths)
        i, j = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, end, "left")) + 1
        skipped = int(ends[i - 1]) if i else 0
        return self.expand(symbols[i:j])[start - skipped : end - skipped]


def _writer(root: str, load, vocabulary: int, end_id: int, most_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load()
        shard, part, held = None, 0, {"docs": [], "ids": [], "n": [], "bytes": 0}

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal part, held
            if held["docs"]:
                name = f"part-{shard:06d}-{part:04d}.tok"
                info = write_file(f"{root}/{name}", held["docs"], np.concatenate(held["ids"]), np.concatenate(held["n"]), vocabulary, end_id)
                part += 1
                held = {"docs": [], "ids": [], "n": [], "bytes": 0}
                row = {"shard": shard, "part": part - 1, "file": name, **info}
                kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 5]
                yield pa.record_batch([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

        for batch in batches:
            shards = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if shard != int(shards[a]):
                    yield from flush()
                    shard, part = int(shards[a]), 0
                ids, texts = batch.column(1).slice(a, b - a).to_pylist(), batch.column(2).slice(a, b - a)
                for i, j, tokens, n in encode_texts(encoder, texts, end_id):
                    held["docs"] += ids[i:j]
                    held["ids"].append(tokens)
                    held["n"].append(n)
                    held["bytes"] += 4 * len(tokens)
                    if held["bytes"] > most_bytes:
                        yield from flush()
        yield from flush()

    return write


def write_tokens(
    df: DataFrame, root: str, load, vocabulary: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = 32 << 20, file_bytes: int = 8 << 20
) -> DataFrame:
    """Write the files under ``root`` and return the manifest, which is stored there last.

    ``shard_bytes``: text of a range, which one task encodes, more where 4,096 ranges wouldn't do; ``file_bytes``: ids (uncompressed) after
    which a range goes on in a further file.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # texts of one id are told apart by their hashes, so that an id with many of them goes to several tasks
    sub = lambda: F.shiftrightunsigned(F.xxhash64("text"), 33)
    sizes = materialize(docs.select("id", (F.octet_length("text") + 4).cast("long").alias("n")), "sizes")
    ends = id_ranges(sizes, "id", "n", shard_bytes, True)
    written = (
        docs.select(range_of(F.col("id"), ends, sub()).cast("int").alias("shard"), "id", "text")
        .repartitionById(len(ends) + 1, F.col("shard"))
        .sortWithinPartitions("shard", "id", "text")
        .mapInArrow(_writer(root, load, vocabulary, end_id, file_bytes), MANIFEST_SCHEMA)
    )
    written.write.parquet(f"{root}/_manifest")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/_manifest")


DOC_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _reader(root: str, with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(f"{root}/{name}")
                step = 2048
                for i in range(0, file.n_docs, step):
                    j = min(i + step, file.n_docs)
                    flat = file.expand(file.symbols(int(file.symbol_at[i]), int(file.symbol_at[j])))
                    at = file.token_at[i : j + 1] - file.token_at[i]
                    raw = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    cols = [
                        pa.array(file.doc_ids[i:j], pa.int64(), mask=file.doc_null[i:j].astype(bool)),
                        pa.array(file.token_at[i:j] + base, pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64()),
                    ]
                    names = [x.split()[0] for x in DOC_SCHEMA.split(", ")]
                    if with_ids:
                        cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.astype(np.int32))))
                        names.append("ids")
                    yield pa.record_batch(cols, names=names)

    return read


def read_tokens(spark: SparkSession, root: str, with_ids: bool = False) -> DataFrame:
    """The documents of the files in the manifest: ``start`` counts the ids of all documents before it, over all files."""
    manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/_manifest")
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    n = max(1, manifest.count())
    return files.repartition(n, "file").mapInArrow(_reader(root, with_ids), DOC_SCHEMA + (", ids array<int>" if with_ids else ""))


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), root, word_encoder(_tokenizer), 49_408, 1)
    return read_tokens(spark, root)
