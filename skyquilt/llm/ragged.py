"""Vectorised work on batches of texts: words as slices of one byte buffer, their 64-bit hashes, ragged arrays.

A word's hash is a sum over its bytes of random numbers picked by byte and place, so that unlike words agree with a
probability of about 2 ** -64. Nothing here knows of Spark; tasks call it on the batches they are given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time; a longer text is worked on alone.
PIECE = 2 << 20
#: Slices that an encoder is given at a time, which bounds what it holds in its own objects.
CHUNK = 16_384
_PLACES = 64
_RANDOM = np.random.Generator(np.random.PCG64(20240101)).integers(1, 2**64 - 1, (_PLACES, 256), dtype=np.uint64)
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
#: A to Z in lower case, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes together."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``raw``, and how many words lie before each text (one more entry than texts)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    gap = _BREAK[raw]
    before = np.empty_like(gap)
    before[0] = True
    before[1:] = gap[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(raw)]
    before[edges] = True
    starts = np.flatnonzero(~gap & before)
    after = np.empty_like(gap)
    after[-1] = True
    after[:-1] = gap[1:]
    after[edges[edges > 0] - 1] = True
    ends = np.flatnonzero(~gap & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


#: Classes of bytes for ``pieces_of_words``: white space, letters, digits, other signs, and what makes a word be left whole.
_SPACE, _LETTER, _DIGIT, _SIGN, _WHOLE = range(5)
_CLASS = np.full(256, _WHOLE, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[[0x27, 0x3C]] = _WHOLE  # an apostrophe may begin an ending, "<" a special token
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE


def pieces_of_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words cut into runs of letters, single digits and runs of other signs, where that is certain: bytes, starts, ends, how many lie before each text, and which are plain.

    Certain are words of printable ASCII and of the letters U+00C0 to U+00FF; these are plain, and in lower case in the bytes
    returned. A word with an apostrophe, a "<" or any other character stays whole and as it is.
    """
    kind = _CLASS[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3) if len(raw) > 1 else np.zeros(0, np.int64)
    tail = raw[lead + 1] if len(lead) else np.zeros(0, np.uint8)
    good = (tail >= 0x80) & (tail != 0x97) & (tail != 0xB7)
    lead, tail = lead[good], tail[good]
    kind[lead] = kind[lead + 1] = _LETTER
    starts, ends, before = words(raw, offsets)
    if not len(starts):
        return raw, starts, ends, before, np.zeros(0, bool)
    plain = np.add.reduceat(kind == _WHOLE, np.stack([starts, ends], axis=1).reshape(-1)[: 2 * len(starts) - (ends[-1] == len(raw))], dtype=np.int32)[::2] == 0
    low = LOWER[raw]
    upper = lead[tail < 0x9F] + 1
    low[upper] += 0x20
    edge = np.zeros(len(raw) + 1, np.int8)  # inside plain words
    edge[starts[plain]] += 1
    edge[ends[plain]] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    raw = np.where(inside, low, raw)
    cut = np.zeros(len(raw), bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    cut &= inside
    cut[starts] = True
    starts_ = np.flatnonzero(cut)
    word = np.searchsorted(starts, starts_, "right") - 1
    ends_ = np.minimum(np.append(starts_[1:], len(raw)), ends[word])
    return raw, starts_, ends_, np.searchsorted(starts_, offsets), plain[word]


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice; slices ascend and don't overlap; an empty slice has hash 0."""
    out = np.zeros(len(starts), np.uint64)
    some = np.flatnonzero(ends > starts)
    if not len(some):
        return out
    s, n = starts[some], (ends - starts)[some]
    first = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    at = place + np.repeat(s, n)
    value = _RANDOM.reshape(-1)[((place & (_PLACES - 1)) << 8) + raw[at]]
    if int(n.max()) > _PLACES:
        value = value * (2 * (place // _PLACES) + 1).astype(np.uint64)
    out[some] = np.add.reduceat(value, first)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes: all bits of the result depend on all bits of ``x``."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gather(store: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``store`` one after another."""
    total = int(lengths.sum())
    if not total:
        return store[:0]
    first = np.cumsum(lengths) - lengths
    return store[np.repeat(offsets - first, lengths) + np.arange(total)]


class Encoder:
    """Token ids of slices of text, each distinct slice encoded once by ``encode``, which takes and gives lists.

    What is known is kept sorted by hash, and forgotten when it grows beyond ``most`` slices. ``plain``, if there is one, encodes
    the slices marked as plain.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = 1_000_000, plain: Callable[[list[str]], list[list[int]]] | None = None):
        self.encode, self.plain, self.most = encode, plain, most
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = np.zeros(0, np.int32)

    def _lists(self, text: bytes, starts: list[int], ends: list[int], plain: np.ndarray) -> list[list[int]]:
        slices = [text[a:b].decode("utf-8", "surrogatepass") for a, b in zip(starts, ends, strict=True)]
        if not plain.any():
            return self.encode(slices)
        if plain.all():
            return self.plain(slices)
        easy, hard = iter(self.plain([x for x, p in zip(slices, plain, strict=True) if p])), iter(self.encode([x for x, p in zip(slices, plain, strict=True) if not p]))
        return [next(easy if p else hard) for p in plain.tolist()]

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each slice has."""
        h = hashes(raw, starts, ends)
        plain = np.zeros(len(starts), bool) if plain is None else plain
        unique, first, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > self.most:
            self._forget()
        place = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == unique[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            text, lengths, flat = raw.tobytes(), [], []
            for k in range(0, len(new), CHUNK):
                some = first[new[k : k + CHUNK]]
                ids = self._lists(text, starts[some].tolist(), ends[some].tolist(), plain[some])
                lengths.append(np.fromiter(map(len, ids), np.int64, len(ids)))
                flat.append(np.fromiter(chain.from_iterable(ids), np.int32, int(lengths[-1].sum())))
            n = np.concatenate(lengths)
            at = len(self.store) + np.cumsum(n) - n
            self.store = np.concatenate([self.store, *flat])
            spot = place[new]  # keys stay sorted
            self.keys, self.at, self.n = (np.insert(x, spot, y) for x, y in ((self.keys, unique[new]), (self.at, at), (self.n, n)))
            place = np.searchsorted(self.keys, unique)
        place = place[which]
        lengths = self.n[place]
        return gather(self.store, self.at[place], lengths), lengths
