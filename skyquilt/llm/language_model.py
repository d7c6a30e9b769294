"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Each preceding word has a restaurant that serves the words that follow it; the end of a text is a word, and is also what precedes a
text's first one. All these restaurants share one parent, that of words without a context, which stands above a uniform choice among
the words of the training texts and one outcome for all others. A restaurant's tables are its parent's customers, so that
contexts share what they know.

Seating is sampled by Gibbs. Sweep 0 seats all customers one after another by the Chinese-restaurant rule (``seat``). In each later sweep
all customers of each dish are offered new tables, all together and ``MOVES`` times (``move``); tables that close or open take or
bring a customer in the parent. Discounts and strengths are sampled after each sweep, by auxiliary variables, from
totals over the restaurants. The probability of a word in a context is the average over the sweeps after the first ones.

How rows move: each task packs its texts into blocks of about two million tokens, whose words are numbered within the block; a block's
payload is a file in the shared folder, and stays there. Its distinct words go to slots (by hash), where they are counted and
numbered; its distinct pairs, as these numbers, to the slots of their second words, where they meet those of other blocks. A word's dishes of all
restaurants are in one slot, so that a frequent context is dealt over all slots, and a sweep exchanges nothing but the
tables of restaurants: each slot sends its own to the parts that add them up, and has the totals back. At last the slots answer with
each pair's probability, and every block is scored with its answers. All that is exchanged follows the pairs of the blocks, and so
grows with the input; only sums of a few numbers pass through the driver. What slots hold between sweeps are files too, written under a
temporary name; a task that runs again writes the same, as random numbers come from the slot and the sweep.

Defined cases: a null text is empty (its end is its one token); a null id counts as held out; equal ids and repeated rows are
scored each; with no training rows every count is 0; an empty table gives no rows; columns other than those named are
ignored. Probabilities are exchanged as single-precision logarithms, and summed in double. ``perplexity`` is that of a text, 10 ** (-score / n_tokens);
``held_out_perplexity`` that of all held-out texts together (null: none).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyquilt.llm import ragged
from skyquilt.llm.common import discard, materialize, new_path, table
from skyquilt.llm.files import read_stream, whole_file

BLOCK_TOKENS, SLOT_BYTES = 1_500_000, 12 << 20
BURN_IN, SAMPLES, MOVES = 2, 3, 2
#: Discounts and strengths to begin with, of the restaurants of words and of their parent.
START = (0.8, 1.0, 0.8, 1.0)


# -- numbers in few bytes


def planes(x: np.ndarray) -> bytes:
    """Whole numbers from 0 in few bytes: all their lowest bytes, then the next ones and so on as far as any is used, compressed; before that their width and number."""
    x = np.ascontiguousarray(x, "<u8")
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T[:width]).tobytes()
    return struct.pack("<BQ", width, len(x)) + pa.compress(raw, codec="zstd", asbytes=True)


def numbers(raw: bytes) -> np.ndarray:
    width, n = struct.unpack_from("<BQ", raw)
    part = np.frombuffer(pa.decompress(raw[9:], width * n, codec="zstd"), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = part.T
    return out.reshape(-1).view("<i8")


def many(raw: bytes) -> int:
    """How many numbers ``numbers`` gives."""
    return struct.unpack_from("<BQ", raw)[1]


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, the first as it is; ``np.cumsum`` gives them back."""
    return np.diff(x, prepend=0)


def save(uri: str, **arrays: np.ndarray) -> None:
    batch = pa.record_batch([pa.array([planes(v)], pa.large_binary()) for v in arrays.values()], names=list(arrays))
    with whole_file(uri) as out, pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)


def load(uri: str) -> dict[str, np.ndarray]:
    with read_stream(uri) as source, pa.ipc.open_stream(source) as reader:
        row = reader.read_next_batch().to_pylist()[0]
    return {k: numbers(v) for k, v in row.items()}


# -- seating


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series from 8 on."""
    shift = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
    y = x + 8
    r = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y - shift


def seat(customers: np.ndarray, pull: np.ndarray, d: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """``(sizes, dish)`` of all tables when customers of each dish arrive one after another.

    ``pull`` is what a new table weighs: (strength + discount x all tables) x the parent's probability. The customer who opens the next
    table is found by the probability that none before does; sizes follow from those customers by the urn of each table against those before it.
    """
    n_dishes = len(customers)
    tables = np.minimum(customers, 1)
    opened: list[tuple[np.ndarray, np.ndarray]] = []  # dishes, and the customer who opened their next table
    live = np.flatnonzero(customers > 1)
    seated = np.ones(len(live), np.int64)
    while len(live):
        n, a, taken = customers[live], np.maximum(pull[live], 1e-300), d * tables[live]
        none = lambda m: log_gamma(m - taken) - log_gamma(m - taken + a)  # noqa: B023, E731
        limit = np.log(1 - rng.random(len(live))) + none(seated)
        some = none(n) <= limit
        live, seated, n, a, taken, limit = live[some], seated[some], n[some], a[some], taken[some], limit[some]
        low, high = seated.copy(), n.copy()  # the one who opens lies in (low, high]
        while (high - low > 1).any():
            middle = (low + high) // 2
            done = none(middle) <= limit
            low, high = np.where(done, low, middle), np.where(done, middle, high)
        tables[live] += 1
        opened.append((live, high))
        on = high < n
        live, seated = live[on], high[on]
    rest, sizes, dishes = customers.copy(), [], []
    for k in range(len(opened), 0, -1):  # the table number k + 1
        dish, at = opened[k - 1]
        share = rng.beta(1 - d, at - 1 - d * k)
        size = 1 + rng.binomial(rest[dish] - at, share)
        rest[dish] -= size
        sizes.append(size)
        dishes.append(dish)
    one = np.flatnonzero(customers > 0)
    sizes, dishes = np.concatenate([rest[one], *sizes]), np.concatenate([one, *dishes])
    order = np.argsort(dishes, kind="stable")
    return sizes[order], dishes[order] if n_dishes else dishes[order]


class Seating:
    """The tables of dishes: ``sizes`` by dish; all methods take distinct, ascending dishes."""

    def __init__(self, sizes: np.ndarray, dish: np.ndarray, n_dishes: int):
        self.sizes, self.dish, self.n_dishes = sizes, dish, n_dishes

    @property
    def tables(self) -> np.ndarray:
        return np.bincount(self.dish, minlength=self.n_dishes)

    @property
    def customers(self) -> np.ndarray:
        return np.bincount(self.dish, weights=self.sizes, minlength=self.n_dishes).astype(np.int64)

    def _spans(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the tables of each dish start and end."""
        ends = np.cumsum(self.tables)
        return np.where(which > 0, ends[which - 1], 0), ends[which]

    @staticmethod
    def _pick(weights: np.ndarray, first: np.ndarray, end: np.ndarray, share: np.ndarray) -> np.ndarray:
        """A table of each span, drawn by weight; ``share`` in (0, 1)."""
        total = np.concatenate([[0.0], np.cumsum(weights)])
        at = np.searchsorted(total, total[first] + share * (total[end] - total[first]), "right") - 1
        return np.clip(at, first, end - 1)

    def remove(self, which: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """A customer of each dish leaves, drawn at random; gives the dishes that lose a table by it."""
        first, end = self._spans(which)
        at = self._pick(self.sizes, first, end, rng.random(len(which)))
        self.sizes[at] -= 1
        empty = self.sizes[at] == 0
        if empty.any():
            on = np.ones(len(self.sizes), bool)
            on[at[empty]] = False
            self.sizes, self.dish = self.sizes[on], self.dish[on]
        return empty

    def add(self, which: np.ndarray, pull: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
        """A customer of each dish is seated; ``pull`` as in ``seat``, for each of ``which``; gives the dishes that gain a table by it."""
        first, end = self._spans(which)
        total = np.concatenate([[0], np.cumsum(self.sizes)])
        old = np.maximum(total[end] - total[first] - d * (end - first), 0.0)
        draw = rng.random(len(which)) * (old + pull)
        new = (draw >= old) | (end == first)
        on = np.flatnonzero(~new)
        self.sizes[self._pick(self.sizes - d, first[on], end[on], draw[on] / old[on])] += 1
        if new.any():
            self.sizes, self.dish = np.insert(self.sizes, end[new], 1), np.insert(self.dish, end[new], which[new])
        return new

    def shift(self, change: np.ndarray, pull: float, d: float, rng: np.random.Generator) -> None:
        """So many customers of each dish come, or leave where the number is below 0."""
        change = change.copy()
        while change.any():
            which = np.flatnonzero(change)
            if 2 * len(which) < self.n_dishes:  # go on with these alone
                mine = np.zeros(self.n_dishes, bool)
                mine[which] = True
                on = mine[self.dish]
                part = Seating(self.sizes[on], np.searchsorted(which, self.dish[on]), len(which))
                part.shift(change[which], pull, d, rng)
                sizes, dish = np.concatenate([self.sizes[~on], part.sizes]), np.concatenate([self.dish[~on], which[part.dish]])
                order = np.argsort(dish, kind="stable")
                self.sizes, self.dish = sizes[order], dish[order]
                return
            less, more = np.flatnonzero(change < 0), np.flatnonzero(change > 0)
            if len(less):
                self.remove(less, rng)
            if len(more):
                self.add(more, np.full(len(more), pull), d, rng)
            change -= np.sign(change)

    def move(self, which: np.ndarray, strength: float, d: float, all_tables: np.ndarray, p: np.ndarray, moves: int, rng: np.random.Generator) -> None:
        """All customers of each dish leave their tables and are offered new ones together, ``moves`` times.

        ``all_tables``: those of each dish's restaurant when the sweep began; ``p``: the parent's probability of each dish. A dish of c customers
        has sizes m with probability in proportion to (r)_t p ** t / t! times the product of Sibuya's law of each size, where they add up to c; r is
        strength / discount + the restaurant's other tables. An offer draws the number of other tables and their sizes, and leaves the rest of the
        customers one table; it is weighed against that of the table of a customer drawn at random, by m z ** m P(m) (Metropolis and Hastings).
        """
        first, end = self._spans(which)
        total = np.concatenate([[0], np.cumsum(self.sizes)])
        c = total[end] - total[first]
        on = c > 1  # one customer has one table
        others = np.maximum(np.array(all_tables, float) - (end - first), 0.0)[on]
        which, c, p, r = which[on], c[on], p[on], strength / d + others
        z = tilt(c, r, p, d)
        log_z, few = np.log(z), log_rise(np.arange(1, 1 << 12), d)

        def weight(m: np.ndarray) -> np.ndarray:
            out = few[np.minimum(m, len(few)) - 1]
            far = np.flatnonzero(m > len(few))
            out[far] = log_rise(m[far], d)
            return out + m * log_z

        share = np.minimum(p * (1 - (1 - z) ** d), 1 - 1e-9)
        for _ in range(moves if len(which) else 0):
            more = rng.poisson(rng.gamma(r + 1, share / (1 - share)))
            fits = more < c
            owner = np.repeat(np.arange(len(which)), np.where(fits, more, 0))
            size = np.minimum(sibuya(d, z[owner], rng), c[owner])
            rest = c - np.bincount(owner, weights=size, minlength=len(which)).astype(np.int64)
            first, end = self._spans(which)
            now = self.sizes[self._pick(self.sizes, first, end, rng.random(len(which)))]
            taken = fits & (rest > 0) & (np.log(1 - rng.random(len(which))) <= weight(np.maximum(rest, 1)) - weight(now))
            gone = np.zeros(self.n_dishes, bool)
            gone[which[taken]] = True
            stay, new = ~gone[self.dish], taken[owner]
            sizes, dish = np.concatenate([self.sizes[stay], rest[taken], size[new]]), np.concatenate([self.dish[stay], which[taken], which[owner[new]]])
            order = np.argsort(dish, kind="stable")
            self.sizes, self.dish = sizes[order], dish[order]


def log_rise(m: np.ndarray, d: float) -> np.ndarray:
    """The logarithm of m times Sibuya's law at m, but for a constant."""
    return log_gamma(m - d) - log_gamma(m.astype(float))


def tilt(c: np.ndarray, r: np.ndarray, p: np.ndarray, d: float) -> np.ndarray:
    """z in (0, 1) by which sizes are tilted, so that a dish's tables hold about as many customers as it has."""
    low, a, b = np.full(len(c), -14.0), r * p * d, 1 - p
    for width in 41.0 / 2 ** np.arange(1, 9):  # of the logit
        x = low + width
        e = np.exp(x)
        whole = (1 + e) ** -d  # y ** d, where y = 1 - z = 1 / (1 + e)
        low = np.where(a * e * whole > c * (b + p * whole), low, x)
    return 1 / (1 + np.exp(-low))


def sibuya(d: float, z: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Sizes m with probability in proportion to z ** m times Sibuya's law: the first success of trials, the j-th with chance d / j."""
    out = np.ones(len(z), np.int64)
    left = np.arange(len(z))
    while len(left):
        x = np.ones(len(left), np.int64)
        longer = np.flatnonzero(rng.random(len(left)) >= d)
        x[longer] += rng.geometric(np.maximum(rng.beta(d, 2 - d, len(longer)), 1e-15))
        kept = rng.random(len(longer)) < z[left[longer]] ** (x[longer] - 1)
        out[left] = x
        left = left[longer[~kept]]
    return out


def _rare(values: np.ndarray, chance, integral, rng: np.random.Generator, most: int = 1 << 16) -> int:
    """How many of independent events j = 1 .. v - 1 of every value v happen, j with ``chance(j)``; beyond ``most``, where chances are small, by Poisson's law."""
    top = int(values.max(initial=0))
    if top < 2:
        return 0
    counts = np.bincount(np.minimum(values, most + 1))
    above = counts[::-1].cumsum()[::-1]  # values of j or more
    j = np.arange(1, len(above) - 1)
    out = int(rng.binomial(above[2:], np.clip(chance(j), 0, 1)).sum())
    far = values[values > most + 1]
    return out + (int(rng.poisson(integral(far, most).sum())) if len(far) else 0)


def discount_events(sizes: np.ndarray, d: float, rng: np.random.Generator) -> int:
    """Of the tables' sizes, what speaks for a low discount."""
    return _rare(sizes, lambda j: (1 - d) / (j - d), lambda c, m: (1 - d) * np.log((c - 0.5 - d) / (m + 0.5 - d)), rng)


def strength_events(customers: np.ndarray, tables: np.ndarray, d: float, strength: float, rng: np.random.Generator) -> tuple[float, int, int]:
    """Of restaurants: the sum of logarithms, and events for the strength and for the discount."""
    many = customers[customers > 1]
    logs = float(np.log(rng.beta(strength + 1, many - 1)).sum()) if len(many) else 0.0
    for_strength = _rare(tables, lambda i: strength / (strength + d * i), lambda t, m: strength / d * np.log((strength + d * t) / (strength + d * m)), rng)
    return logs, for_strength, int(np.maximum(tables - 1, 0).sum()) - for_strength


def draw_parameters(logs: float, for_strength: int, for_discount: int, against_discount: int, rng: np.random.Generator) -> tuple[float, float]:
    """Discount (uniform prior) and strength (prior of mean and variance 1), given the events."""
    d = float(rng.beta(1 + for_discount, 1 + against_discount))
    return min(max(d, 0.001), 0.999), max(1e-6, float(rng.gamma(1 + for_strength, 1 / (1 - logs))))


# -- blocks


def _rows(names: str, kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names=names.split())


WORD_SCHEMA = "slot int, block string, hashes binary, counts binary"
_WORD = ("slot block hashes counts", [pa.int32(), pa.string(), pa.binary(), pa.binary()])


def _packer(root: str, n_slots: int, most: int):
    """Texts to blocks: their files, and for each slot the block's words there, in the order of the block's numbers."""

    def pack(block: str, docs: list, held: np.ndarray, parts: list) -> pa.RecordBatch:
        h, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        unique, which = np.unique(h, return_inverse=True)
        slot = (ragged.mix(unique) % np.uint64(n_slots)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        tokens = rank[which]
        counts = np.bincount(tokens[np.repeat(~held, n)], minlength=len(order))
        sign = np.array([0 if x is None or x >= 0 else 1 for x in docs])
        save(f"{root}/block-{block}", docs=np.array([abs(x or 0) for x in docs], np.uint64), sign=sign, nulls=np.array([x is None for x in docs]), held=held, n=n, tokens=tokens)
        ends = np.searchsorted(slot[order], np.arange(n_slots + 1))
        h = unique[order]
        return _rows(*_WORD, [(k, block, planes(h[ends[k] : ends[k + 1]]), planes(counts[ends[k] : ends[k + 1]])) for k in np.flatnonzero(np.diff(ends)).tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, serial = TaskContext.get().partitionId(), 0
        docs, held, parts, tokens = [], [], [], 0
        for batch in batches:
            raw, offsets = ragged.buffers(batch.column(1))
            ids, out = batch.column(0).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for i, j in ragged.pieces(offsets):
                part, at = ragged.LOWER[raw[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
                starts, ends, before = ragged.words(part, at)
                h, n = ragged.hashes(part, starts, ends), np.diff(before)
                # an end, the empty word with hash 0, after every text's words
                word = np.zeros(len(h) + j - i, np.uint64)
                mask = np.ones(len(word), bool)
                mask[before[1:] + np.arange(j - i)] = False
                word[mask] = h
                parts.append((word, n + 1))
                docs, tokens = docs + ids[i:j], tokens + len(word)
                held.append(out[i:j])
                if tokens >= most:
                    yield pack(f"{task}-{serial}", docs, np.concatenate(held), parts)
                    docs, held, parts, tokens, serial = [], [], [], 0, serial + 1
        if docs:
            yield pack(f"{task}-{serial}", docs, np.concatenate(held), parts)

    return run


ID_SCHEMA = "slot int, block string, ids binary, counts binary, n bigint, v bigint"
_ID = ("slot block ids counts n v", [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64()])


def _by(key: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    held: dict = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault(row[key], []).append(row)
    while held:
        k = next(iter(held))
        yield k, held.pop(k)


def _numberer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of words: the slot, then the rank in the slot by count. To each block those of its words, and once (block null) tokens and words of the slot."""
    for slot, rows in _by("slot", batches):
        rows.sort(key=lambda r: r["block"])
        h, counts = (np.concatenate([numbers(r[c]) for r in rows]) for c in ("hashes", "counts"))
        unique, which = np.unique(h, return_inverse=True)
        total = np.bincount(which, weights=counts).astype(np.int64)
        rank = np.empty(len(unique), np.int64)
        rank[np.lexsort((unique, -total))] = np.arange(len(unique))
        out, at = [(slot, None, None, None, int(total.sum()), int((total > 0).sum()))], 0
        for r in rows:
            n = many(r["hashes"])
            mine = which[at : at + n]
            at += n
            out.append((slot, r["block"], planes((slot << 32) | rank[mine]), planes(total[mine]), None, None))
        yield _rows(*_ID, out)


PAIR_SCHEMA = "slot int, block string, words binary, befores binary, counts binary"
_PAIR = ("slot block words befores counts", [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()])


def _pairs(file: dict, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's distinct pairs by word and preceding word: their words' numbers, the preceding words' numbers, and each token's pair."""
    order = np.argsort(ids)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    now = rank[file["tokens"]]
    last = np.cumsum(file["n"]) - 1
    end = now[last[0]]  # every text ends with the empty word
    key = (now << 32) | np.concatenate([[end], now[:-1]])
    unique, which = np.unique(key, return_inverse=True)
    sorted_ids = ids[order]
    return sorted_ids[unique >> 32], sorted_ids[unique & 0xFFFFFFFF], which


def _pairer(root: str):
    """Each block's pairs to the slots of their words; the numbers and counts of its words go beside its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _by("block", batches):
            answers = sorted(rows, key=lambda x: x["slot"])
            ids, counts = (np.concatenate([numbers(x[c]) for x in answers]) for c in ("ids", "counts"))
            save(f"{root}/ids-{block}", ids=ids, counts=counts)
            file = load(f"{root}/block-{block}")
            word, before, which = _pairs(file, ids)
            n = np.bincount(which[np.repeat(file["held"] == 0, file["n"])], minlength=len(word))
            slot = word >> 32
            cuts = np.flatnonzero(np.diff(slot, prepend=-1))
            # within a word the preceding words ascend
            new = np.diff(word, prepend=-1) != 0
            gap = np.where(new, before, np.diff(before, prepend=0))
            out = []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(slot)], strict=True):
                out.append((int(slot[a]), block, planes(steps(word[a:b] & 0xFFFFFFFF)), planes(gap[a:b]), planes(n[a:b])))
            yield _rows(*_PAIR, out)

    return run


def _ungap(word: np.ndarray, gap: np.ndarray) -> np.ndarray:
    new = np.flatnonzero(np.diff(word, prepend=-1))
    total = np.cumsum(gap)
    return total - np.repeat(total[new] - gap[new], np.diff(np.append(new, len(word))))


PLACE_SCHEMA = "slot int, block string, places binary"
_PLACE = ("slot block places", [pa.int32(), pa.string(), pa.binary()])


def _merger(root: str):
    """A slot's dishes, by word and preceding word, to its file; for each block where its pairs are among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, rows in _by("slot", batches):
            rows.sort(key=lambda r: r["block"])
            word, before, counts = [], [], []
            for r in rows:
                word.append(np.cumsum(numbers(r["words"])))
                before.append(_ungap(word[-1], numbers(r["befores"])))
                counts.append(numbers(r["counts"]))
                r["befores"] = r["counts"] = None
            lengths = [len(x) for x in word]
            word, before, counts = np.concatenate(word), np.concatenate(before), np.concatenate(counts)
            order = np.lexsort((before, word))
            new = (np.diff(word[order], prepend=-1) != 0) | (np.diff(before[order], prepend=-1) != 0)
            which = np.empty(len(order), np.int64)
            which[order] = np.cumsum(new) - 1
            first = order[new]
            counts = np.bincount(which, weights=counts).astype(np.int64)
            word, before = word[first], before[first]
            save(f"{root}/dishes-{slot}", words=steps(word), befores=np.where(np.diff(word, prepend=-1) != 0, before, np.diff(before, prepend=0)), counts=counts)
            ends = np.cumsum([0, *lengths])
            yield _rows(*_PLACE, [(slot, None, None), *[(slot, r["block"], planes(steps(which[a:b]))) for r, a, b in zip(rows, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]])

    return run


# -- sweeps


class Slot:
    """The dishes of a slot's words, in the restaurants of preceding words (``low``) and in their parent (``top``).

    Dishes with one customer or none need no seating; the others are numbered in ``many``. ``rooms``: the restaurants that have
    dishes here; ``totals`` are their customers and tables over all slots, in that order, and ``top_totals`` the parent's.
    """

    def __init__(self, dishes: dict, outcomes: int):
        self.word = np.cumsum(np.diff(np.cumsum(dishes["words"]), prepend=-1) != 0) - 1
        self.before = _ungap(self.word, dishes["befores"])
        self.count, self.outcomes = dishes["counts"], outcomes
        self.n_words = int(self.word[-1]) + 1 if len(self.word) else 0
        self.many = np.flatnonzero(self.count > 1)
        self.rooms, self.room = np.unique(self.before, return_inverse=True)
        none = np.zeros(0, np.int64)
        self.low = Seating(self.count[self.many], np.arange(len(self.many)), len(self.many))  # one table each
        self.top = Seating(none, none, self.n_words)

    def tables(self) -> np.ndarray:
        out = np.minimum(self.count, 1)
        out[self.many] = self.low.tables
        return out

    def served(self) -> np.ndarray:
        """Tables of each word, which are the parent's customers."""
        return np.bincount(self.word, weights=self.tables(), minlength=self.n_words).astype(np.int64)

    def top_share(self, parameters: tuple, top_totals: tuple[int, int]) -> np.ndarray:
        """The parent's probability of each word."""
        d, strength = parameters[2:]
        customers, tables = top_totals
        return (np.maximum(self.top.customers - d * self.top.tables, 0) + (strength + d * tables) / self.outcomes) / (strength + customers)

    def sweep(self, number: int, parameters: tuple, totals: np.ndarray, top_totals: tuple[int, int], moves: int, rng: np.random.Generator) -> None:
        d, strength, d_top, strength_top = parameters
        if number:
            p = self.top_share(parameters, top_totals)
        else:  # nothing is seated above yet: words as often as in all contexts together
            p = (self.served() + 1 / self.outcomes) / (top_totals[0] + 1)
        p, all_tables = p[self.word[self.many]], totals[1, self.room[self.many]]
        if number:
            every = np.arange(len(self.many))
            self.low.move(every, strength, d, all_tables, p, moves, rng)
        else:
            sizes, dish = seat(self.count[self.many], (strength + d * all_tables) * p, d, rng)
            self.low = Seating(sizes, dish, len(self.many))
        served, pull = self.served(), (strength_top + d_top * top_totals[1]) / self.outcomes
        if not number:
            self.top = Seating(*seat(served, np.full(self.n_words, pull), d_top, rng), self.n_words)
            return
        self.top.shift(served - self.top.customers, pull, d_top, rng)
        which = np.flatnonzero(served > 1)
        self.top.move(which, strength_top, d_top, np.full(len(which), top_totals[1]), np.full(len(which), 1 / self.outcomes), moves, rng)

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of each room."""
        of = lambda x: np.bincount(self.room, weights=x, minlength=len(self.rooms)).astype(np.int64)
        return of(self.count), of(self.tables())

    def predict(self, parameters: tuple, totals: np.ndarray, top_totals: tuple[int, int]) -> np.ndarray:
        """The probability of every dish."""
        d, strength = parameters[:2]
        p = self.top_share(parameters, top_totals)[self.word]
        customers, tables = totals[0, self.room], totals[1, self.room]
        return (np.maximum(self.count - d * self.tables(), 0) + (strength + d * tables) * p) / (strength + customers)

    def store(self, uri: str) -> None:
        save(uri, sizes=self.low.sizes, dish=steps(self.low.dish), top_sizes=self.top.sizes, top_dish=steps(self.top.dish))

    def restore(self, uri: str) -> None:
        x = load(uri)
        self.low, self.top = Seating(x["sizes"], np.cumsum(x["dish"]), len(self.many)), Seating(x["top_sizes"], np.cumsum(x["top_dish"]), self.n_words)


#: What goes between slots and parts: ``a`` rooms, ``b`` customers, ``c`` tables. Once a slot (part -1) and once a part (slot -1): sums for the driver.
SWEEP_SCHEMA = "slot int, part int, a binary, b binary, c binary, sums array<double>"
_SWEEP = ("slot part a b c sums", [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64())])


def _parts(slot: Slot, n_parts: int) -> np.ndarray:
    return (ragged.mix(slot.rooms.astype(np.uint64)) % np.uint64(n_parts)).astype(np.int64)


def _taken(slot: Slot, rows: list[dict], n_parts: int) -> np.ndarray:
    part, totals = _parts(slot, n_parts), np.zeros((2, len(slot.rooms)), np.int64)
    for r in rows:
        totals[:, part == r["part"]] = np.stack([numbers(r["b"]), numbers(r["c"])])
    return totals


def _sweeper(root: str, number: int, parameters: tuple, outcomes: int, top_totals: tuple[int, int], n_parts: int, moves: int):
    """The sweep of that number; below 0 nothing is seated, and sums are those of one table a dish."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, rows in _by("slot", batches):
            rng = np.random.default_rng([20240101, k, number + 1])
            slot, sums = Slot(load(f"{root}/dishes-{k}"), outcomes), []
            if number < 0:
                sums = [float(slot.served().sum()), 0.0]
            else:
                if number:
                    slot.restore(f"{root}/seating-{number - 1}-{k}")
                slot.sweep(number, parameters, _taken(slot, rows, n_parts), top_totals, moves, rng)
                slot.store(f"{root}/seating-{number}-{k}")
                top = slot.top
                sums = [float(top.sizes.sum()), float(len(top.sizes)), discount_events(slot.low.sizes, parameters[0], rng), discount_events(top.sizes, parameters[2], rng)]
            part, (customers, tables), out = _parts(slot, n_parts), slot.sums(), [(k, -1, None, None, None, sums)]
            for j in np.unique(part).tolist():
                on = part == j
                out.append((k, j, planes(steps(slot.rooms[on])), planes(customers[on]), planes(tables[on]), None))
            yield _rows(*_SWEEP, out)

    return run


def _totals(number: int, parameters: tuple):
    """For each slot the totals of its restaurants in a part, in the order it sent them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by("part", batches):
            rooms = [np.cumsum(numbers(r["a"])) for r in rows]
            _, which = np.unique(np.concatenate(rooms), return_inverse=True)
            b, c = (np.bincount(which, weights=np.concatenate([numbers(r[k]) for r in rows])).astype(np.int64) for k in ("b", "c"))
            events = strength_events(b, c, *parameters[:2], np.random.default_rng([20240102, part, number + 1]))
            out, at = [(-1, part, None, None, None, [float(x) for x in events])], 0
            for r, mine in zip(rows, rooms, strict=True):
                mine = which[at : at + len(mine)]
                at += len(mine)
                out.append((r["slot"], part, None, planes(b[mine]), planes(c[mine]), None))
            yield _rows(*_SWEEP, out)

    return run


def _answer(root: str, kept: dict[int, tuple], outcomes: int, n_parts: int):
    """To each block the averaged probabilities of its pairs in a slot, as logarithms. ``kept``: parameters and the parent's totals by sweep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _by("slot", batches):
            slot, by_sweep = Slot(load(f"{root}/dishes-{number}"), outcomes), {}
            for r in rows:
                if r["sweep"] >= 0:
                    by_sweep.setdefault(r["sweep"], []).append(r)
            p = np.zeros(len(slot.count))
            for k, mine in sorted(by_sweep.items()):
                slot.restore(f"{root}/seating-{k}-{number}")
                p += slot.predict(kept[k][0], _taken(slot, mine, n_parts), kept[k][1]) / len(by_sweep)
            logs = np.log10(p).astype(np.float32)
            for r in rows:
                if r["sweep"] < 0:
                    at = np.cumsum(numbers(r["b"]))
                    yield _rows("slot block logs", [pa.int32(), pa.string(), pa.binary()], [(number, r["block"], logs[at].tobytes())])

    return run


SCORE_SCHEMA = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _scorer(root: str, total: int, distinct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _by("block", batches):
            logs = np.concatenate([np.frombuffer(x["logs"], np.float32) for x in sorted(rows, key=lambda x: x["slot"])]).astype(float)
            file, words = load(f"{root}/block-{block}"), load(f"{root}/ids-{block}")
            which = _pairs(file, words["ids"])[2]
            counts = words["counts"][file["tokens"]]
            base = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
            first = np.cumsum(file["n"]) - file["n"]
            sums = [np.add.reduceat(x, first) for x in ((counts > 0).astype(np.int64), base, logs[which])]
            cols = [
                pa.array(np.where(file["sign"] > 0, -file["docs"], file["docs"]), pa.int64(), mask=file["nulls"] > 0), pa.array(file["held"] > 0), pa.array(file["n"], pa.int64()),
                pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.float64()), pa.array(sums[2], pa.float64()),
            ]
            yield pa.record_batch(cols, names=[x.split()[0] for x in SCORE_SCHEMA.split(", ")])

    return run


def score_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None, burn_in: int = BURN_IN, samples: int = SAMPLES, moves: int = MOVES) -> DataFrame:
    """A row a text: ``doc_id held_out n_tokens n_known base_score score train_tokens perplexity held_out_perplexity``.

    ``held_out``: a column that tells which rows the model doesn't learn from; by default a tenth, by checksum of the id.
    """
    spark = df.sparkSession
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(True)).alias("held"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slots = max(8, -(-size // SLOT_BYTES))
    root = new_path(spark, "model")
    asked = docs.mapInArrow(_packer(root, n_slots, BLOCK_TOKENS), WORD_SCHEMA)
    words = materialize(asked.repartitionById(n_slots, F.col("slot")).mapInArrow(_numberer, ID_SCHEMA), "words")
    found = words.where("block IS NULL").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    total, outcomes = found["n"] or 0, (found["v"] or 0) + 1

    # numbers of partitions are given: messages are small, and the work behind them isn't
    n_blocks = max(1, words.select("block").distinct().count())
    pairs = words.where("block IS NOT NULL").select("block", "slot", "ids", "counts").repartition(n_blocks, "block").mapInArrow(_pairer(root), PAIR_SCHEMA)
    slots = materialize(pairs.repartitionById(n_slots, F.col("slot")).mapInArrow(_merger(root), PLACE_SCHEMA), "slots")
    discard(words)

    parameters, top_totals, last = START, (0, 0), None
    waiting = slots.where("block IS NULL").select("slot").repartitionById(n_slots, F.col("slot"))
    kept: dict[int, tuple] = {}
    answers = []
    for k in range(-1, burn_in + samples):
        swept = materialize(waiting.mapInArrow(_sweeper(root, k, parameters, outcomes, top_totals, n_slots, moves), SWEEP_SCHEMA), "sweep")
        own = swept.where("part < 0").agg(*[F.sum(F.get("sums", F.lit(i))) for i in range(4)]).first()
        totals = swept.where("part >= 0").repartitionById(n_slots, F.col("part")).mapInArrow(_totals(k, parameters), SWEEP_SCHEMA)
        totals = materialize(totals, "totals")
        discard(swept, last)
        last = totals if k < burn_in else None
        top_totals = (int(own[0] or 0), int(own[1] or 0))
        if k >= burn_in:
            kept[k] = (parameters, top_totals)
            answers.append(totals.where("slot >= 0").withColumn("sweep", F.lit(k)))
        if k >= 0:
            logs, up, down = (x or 0 for x in totals.where("slot < 0").agg(*[F.sum(F.get("sums", F.lit(i))) for i in range(3)]).first())
            rng = np.random.default_rng([20240103, k])
            top = strength_events(np.array([top_totals[0]]), np.array([top_totals[1]]), *parameters[2:], rng)
            parameters = (*draw_parameters(logs, int(up), int(down), int(own[2] or 0), rng), *draw_parameters(*top, int(own[3] or 0), rng))
        waiting = totals.where("slot >= 0").select("slot", "part", "b", "c").repartitionById(n_slots, F.col("slot"))

    rows = slots.where("block IS NOT NULL").select("slot", "block", F.lit(-1).alias("sweep"), F.lit(-1).alias("part"), F.col("places").alias("b"), F.lit(None).cast("binary").alias("c"))
    for totals in answers:
        rows = rows.unionByName(totals.select("slot", F.lit(None).cast("string").alias("block"), "sweep", "part", "b", "c"))
    replies = rows.repartitionById(n_slots, F.col("slot")).mapInArrow(_answer(root, kept, outcomes, n_slots), "slot int, block string, logs binary")
    scored = materialize(replies.repartition(n_blocks, "block").mapInArrow(_scorer(root, total, outcomes - 1), SCORE_SCHEMA), "scores")
    held = scored.where("held_out").agg(F.sum("score").alias("score"), F.sum("n_tokens").alias("n")).first()
    overall = 10 ** (-held["score"] / held["n"]) if held["n"] else None
    return scored.withColumns({
        "train_tokens": F.lit(total).cast("long"), "perplexity": F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")), "held_out_perplexity": F.lit(overall).cast("double"),
    })


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
