"""SentencePiece encoding and decoding with the tokenizers library as its backend.

``read_model`` parses the model protobuf itself. ``build`` makes a ``tokenizers.Tokenizer`` from it: normaliser (a compiled
character map, if the model has one; the white-space rules), metaspace marker, and either the unigram scores or the merges that a BPE
model's scores stand for, with byte fallback. ``encode`` and ``decode`` run over a table of texts.

Where no piece of the vocabulary has a marker after another character, the best segmentation of a text is made of those of its
pieces between spaces; ``encode`` then encodes each distinct piece once, in multithreaded batches, compares every one with the
sentencepiece library, and decodes it again. The ids are those of the rebuilt tokenizer: a document with a piece on which the two libraries
differ is reported with ``parity`` false, one with a piece that doesn't decode to itself with ``round_trip`` false. Models for which this
doesn't hold are encoded text by text, with the same comparison. A path may be given as a function, which is called in the tasks.

Defined cases: a null text is empty and has no ids; a marker character in a text decodes to a space, as in sentencepiece;
ids and texts repeat as rows do; an empty table gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm import ragged
from skyquilt.llm.common import table

#: Fixed values of the format: the marker for a space; types of pieces; types of models.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    char_map: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True


def messages(raw: bytes) -> Iterator[tuple[int, int | float | bytes]]:
    """Field numbers and values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(raw):
        key = varint()
        wire = key & 7
        if wire == 0:
            yield key >> 3, varint()
        elif wire == 2:
            n = varint()
            yield key >> 3, raw[at : at + n]
            at += n
        elif wire in (1, 5):
            n = 8 if wire == 1 else 4
            yield key >> 3, struct.unpack("<d" if n == 8 else "<f", raw[at : at + n])[0]
            at += n
        else:
            raise ValueError(f"wire type {wire} in a model file")


def read_model(path: str) -> Model:
    out = Model()
    with open(path, "rb") as f:
        raw = f.read()
    for number, value in messages(raw):
        if number == 1:  # a piece: text, score, type
            p = dict(messages(value))
            out.pieces.append((p[1].decode(), p.get(2, 0.0), p.get(3, NORMAL)))
        elif number == 2:  # trainer
            t = dict(messages(value))
            out.kind, out.byte_fallback, out.unknown = t.get(3, UNIGRAM), bool(t.get(35, 0)), t.get(40, 0)
            if t.get(24, 0):
                raise ValueError("markers behind words (treat_whitespace_as_suffix) aren't supported")
        elif number == 3:  # normaliser
            n = dict(messages(value))
            out.char_map, out.dummy_prefix, out.squeeze = n.get(2, b""), bool(n.get(3, 1)), bool(n.get(4, 1))
            if not n.get(5, 1):
                raise ValueError("spaces that stay as they are (escape_whitespaces off) aren't supported")
    return out


def merges(model: Model) -> list[tuple[str, str]]:
    """Pairs of pieces whose union is a piece, those of the best scores first, then of the lowest ids."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for piece, score, kind in model.pieces:
        if kind == NORMAL:
            found += [(-score, ids[piece[:k]], ids[piece[k:]]) for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids]
    return [(model.pieces[a][0], model.pieces[b][0]) for _, a, b in sorted(found)]


def build(model: Model, prefix: bool = True):
    """The tokenizer; without ``prefix`` no marker is put before a text.

    Text never becomes a control, unknown or byte piece by its spelling. In a unigram model the first two are named with a space before them, which no
    normalised text has; byte pieces keep their names, by which the fallback finds them, and texts that spell one are cut behind the bracket. In a pair model no pair makes
    such a piece. User-defined symbols of a pair model are cut out first, each a piece of its own.
    """
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = model.pieces[model.unknown][0]
    symbols = sorted((p for p, _, kind in model.pieces if kind == USER_DEFINED), key=len, reverse=True) if model.kind == BPE else []
    if model.kind == BPE:
        vocabulary = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab=vocabulary, merges=merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback, **({"ignore_merges": True} if symbols else {}))
    elif model.kind == UNIGRAM:
        core = models.Unigram([(f" {p}" if kind in (CONTROL, UNKNOWN) else p, s) for p, s, kind in model.pieces], model.unknown, model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} isn't supported")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.char_map)] if model.char_map else []
    if model.squeeze:
        steps += [normalizers.Replace(Regex(r"\A +| +\z"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if prefix and model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if symbols:
        out.pre_tokenizer = pre_tokenizers.Split(Regex("|".join(re.escape(p) for p in symbols)), "isolated")
    elif model.kind == UNIGRAM and model.byte_fallback:
        out.pre_tokenizer = pre_tokenizers.Split(Regex("(?<=<)0(?=x[0-9A-F]{2}>)"), "merged_with_next")
    tail = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return out


def splits_at_spaces(model: Model) -> bool:
    """Whether every text can be encoded piece by piece between spaces."""
    return not model.char_map and not model.squeeze and model.dummy_prefix and not any(MARK in p.lstrip(MARK) for p, _, _ in model.pieces)


def _starts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text and each run of spaces starts, unless a marker character comes before it."""
    space = raw == 0x20
    opens = space.copy()
    opens[1:] &= ~space[:-1]
    m = np.frombuffer(MARK.encode(), np.uint8)
    marks = np.flatnonzero((raw[:-2] == m[0]) & (raw[1:-1] == m[1]) & (raw[2:] == m[2])) + 3 if len(raw) > 2 else np.zeros(0, np.int64)
    opens[marks[marks < len(raw)]] = False
    first = offsets[:-1][np.diff(offsets) > 0]
    opens[first] = True
    starts = np.flatnonzero(opens)
    return starts, np.append(starts[1:], len(raw)), np.searchsorted(starts, offsets)


def _prefixed(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text that isn't empty with a space before it."""
    some = np.diff(offsets) > 0
    added = np.concatenate([[0], np.cumsum(some)])
    out = np.full(len(raw) + int(added[-1]), 0x20, np.uint8)
    mask = np.ones(len(out), bool)
    mask[(offsets[:-1] + added[:-1])[some]] = False
    out[mask] = raw
    return out, offsets + added


class Coder:
    """Encodes and decodes columns of texts in a task."""

    def __init__(self, path: str, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        import sentencepiece

        self.model = read_model(path)
        self.whole = not splits_at_spaces(self.model)
        self.tokenizer = build(self.model, prefix=self.whole)
        self.judge = sentencepiece.SentencePieceProcessor(model_file=path)
        self.encoder = ragged.Encoder(self._checked)

    def _checked(self, texts: list[str]) -> list[list[int]]:
        """Ids of pieces, each of which starts with a space; -1 ends those on which the libraries differ, -2 those that the decoder doesn't give back."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        # sentencepiece puts a marker before a text itself, but not before an empty one: a lone space is judged behind a letter
        want = self.judge.encode(texts if self.whole else [t[1:] or "x " for t in texts], num_threads=1)
        if not self.whole:
            lone = len(self.judge.encode("x"))
            want = [w if t != " " else w[lone:] for t, w in zip(texts, want, strict=True)]
        back = self.tokenizer.decode_batch(got, skip_special_tokens=False)
        cut = 1 if self.model.dummy_prefix else 0
        true = self.judge.decode(want) if self.whole else [t.replace(MARK, " ")[cut:] for t in texts]  # a normalised text is held against sentencepiece's own decoding
        return [g + [-1] * (g != w) + [-2] * (b != t) for g, w, t, b in zip(got, want, true, back, strict=True)]

    def encode(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of texts: first and last, all ids, how many each text has, whether the libraries agree on it, and whether it decodes to itself."""
        raw, offsets = ragged.buffers(column)
        for i, j in ragged.pieces(offsets):
            part, at = raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            if self.whole:
                starts, ends, before = at[:-1], at[1:], np.arange(len(at))
            else:
                part, at = _prefixed(part, at)
                starts, ends, before = _starts(part, at)
            ids, n = self.encoder(part, starts, ends)
            place = np.concatenate([[0], np.cumsum(n)])[before]
            fine = []
            for mark in (-1, -2):
                lost = np.concatenate([[0], np.cumsum(ids == mark)])
                fine.append(np.diff(lost[place]) == 0)
            if not (fine[0].all() and fine[1].all()):
                lost = np.concatenate([[0], np.cumsum(ids < 0)])
                place = place - lost[place]
                ids = ids[ids >= 0]
            yield i, j, ids, np.diff(place), *fine

    def decode(self, lists: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(lists, skip_special_tokens=False)


OUT_SCHEMA = "doc_id bigint, n_tokens bigint, ids array<int>, parity boolean, round_trip boolean"


def encode(df: DataFrame, path: str | Callable[[], str], id_col: str = "doc_id", text_col: str = "text", threads: int = 2) -> DataFrame:
    """Ids of every text, whether both libraries agree on it, and whether it decodes to itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path() if callable(path) else path, threads)
        for batch in batches:
            for i, j, ids, n, agree, back in coder.encode(batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.record_batch(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), lists, pa.array(agree), pa.array(back)],
                    names=["doc_id", "n_tokens", "ids", "parity", "round_trip"],
                )

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, OUT_SCHEMA)


def decode(df: DataFrame, path: str | Callable[[], str], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The texts of lists of ids, by the rebuilt tokenizer's decoder; a null list is empty, an id outside the vocabulary decodes to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path() if callable(path) else path, 1)
        for batch in batches:
            for k in range(0, len(batch), 256):  # lists in Python are large
                part = batch.slice(k, 256)
                yield pa.record_batch([part.column(0), pa.array(coder.decode([[x for x in v if x is not None and x >= 0] for v in part.column(1).to_pylist()]), pa.string())], names=["doc_id", "text"])

    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), ids.alias("ids")).mapInArrow(run, "doc_id bigint, text string")


def _path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_sentence_piece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), _path)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that the stages before it kept."""
    return encode(docs, _path)
