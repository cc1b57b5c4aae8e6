"""Runs of repeating words, caught online by dyadic blocks.

A square of period q is a stretch of 2q words whose halves are equal; a run is a stretch with smallest period q and of at least
max(12, 2q) words that can't be extended. SquareCatcher reads words in order. Every completed block of B = 2, 4, 8 ... words
that begins at a multiple of B is a catcher: it looks for itself q words further on, B = 2 for periods 1 to 6, other blocks for
2B - 1 to 4B - 2, so that every square's first half holds a block of its level whole. A block that meets itself begins a
match: the stretch of words that equal those q words on, compared backwards once and forwards with every appended word. A
match that has grown to a square is reported, and grows on as a run until a word differs.

Comparisons of stretches use two prefix sums of polynomial hashes. These can only make a match too long, never too short, so
every run is compared word by word before it is given; what a collision made too long is cut where words differ.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from evidra.llm.common import by_bytes, lean, ship, table, text_lists

#: A run has at least so many words.
LEAST = 12
#: Two primes below 2^31: products of two residues fit into 64 bits.
PRIMES = (np.uint64(2147483647), np.uint64(2147483629))
BASES = (np.uint64(911382323), np.uint64(972663749))
MIXERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Pairs of blocks and offsets that are compared at once.
AT_ONCE = 1 << 18
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(k: int, n: int) -> np.ndarray:
    """Powers 0 to n - 1, at least, of the base of a hash."""
    while len(_POWERS[k]) < n:
        have = _POWERS[k]
        step = have[-1] * BASES[k] % PRIMES[k]
        _POWERS[k] = np.concatenate([have, have * step % PRIMES[k]])
    return _POWERS[k]


class SquareCatcher:
    """append(codes) reads further words, given as numbers, and returns the squares (start, period) it has caught by them;
    runs() gives all runs (start, end, period) of what was read. `longest` bounds the length of a run, where it is known."""

    def __init__(self, longest: int | None = None):
        self.longest, self.n = longest, 0
        self.codes = np.zeros(0, np.int64)
        self.sums = [np.zeros(1, np.uint64), np.zeros(1, np.uint64)]
        none = np.zeros(0, np.int64)
        self.open = (none, none, none)  # period, start, stop of matches that reach the last word; a period has one at most
        self.closed: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # matches that ended as squares

    def append(self, codes: np.ndarray) -> np.ndarray:
        before, self.n = self.n, self.n + len(codes)
        self.codes = np.concatenate([self.codes, codes])
        for k, (prime, mixer) in enumerate(zip(PRIMES, MIXERS)):
            value = codes.astype(np.uint64) * mixer
            value = ((value ^ (value >> np.uint64(29))) >> np.uint64(7)) % prime
            value = value * powers(k, self.n)[before : self.n] % prime
            self.sums[k] = np.concatenate([self.sums[k], (self.sums[k][-1] + np.cumsum(value, dtype=np.uint64)) % prime])
        caught = [self._advance()]
        block = 2
        while block + (1 if block == 2 else 2 * block - 1) <= self.n and (block == 2 or 4 * block - 2 <= (self.longest or self.n)):
            caught.append(self._level(block, before))
            block *= 2
        return np.concatenate(caught)

    def runs(self) -> np.ndarray:
        """Runs (start, end, period) by start, then period: of matches with the same ends that of the smallest period."""
        period, start, stop = (np.concatenate(x) for x in zip(*self.closed, self._squares(*self.open)))
        checked = [(a, b + q, q) for p, i, j in zip(period.tolist(), start.tolist(), stop.tolist()) for q, a, b in self._compared(p, i, j)]
        best: dict[tuple[int, int], int] = {}
        for a, b, q in checked:
            best[a, b] = min(q, best.get((a, b), q))
        return np.array(sorted((a, b, q) for (a, b), q in best.items()), np.int64).reshape(-1, 3)

    def _compared(self, q: int, start: int, stop: int) -> list[tuple[int, int, int]]:
        """The match compared word by word; what is left of it that still is a square."""
        same = self.codes[start:stop] == self.codes[start + q : stop + q]
        if same.all():
            return [(q, start, stop)]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        return [(q, start + a, start + b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a + q >= max(LEAST, 2 * q)]

    @staticmethod
    def _squares(period, start, stop):
        good = stop - start + period >= np.maximum(LEAST, 2 * period)
        return period[good], start[good], stop[good]

    def _shift(self, k: int, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """A number that stays the same from one place to the next as long as words equal those `period` further on."""
        prime, sums = PRIMES[k], self.sums[k]
        return (sums[at + period] + (prime - sums[at] * powers(k, self.n + 1)[period] % prime)) % prime

    def _equal(self, a: np.ndarray, b: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether all words from a to b equal those `period` further on."""
        same = self._shift(0, a, period) == self._shift(0, b, period)
        some = np.flatnonzero(same)
        same[some] = self._shift(1, a[some], period[some]) == self._shift(1, b[some], period[some])
        return same

    def _reach(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, sign: int) -> np.ndarray:
        """How far words from `at` on, or before it, equal those `period` further on, at most `most`: doubled, then halved."""
        low, high = np.zeros_like(at), np.zeros_like(at)
        live, step = np.flatnonzero(most > 0), 1
        while len(live):
            to = np.minimum(step, most[live])
            far = at[live] + sign * to
            good = self._equal(np.minimum(at[live], far), np.maximum(at[live], far), period[live])
            low[live[good]] = to[good]
            high[live] = to
            live, step = live[good & (to < most[live])], step * 2
        high = np.where(low == high, low, high - 1)
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live] + 1) // 2
            far = at[live] + sign * mid
            good = self._equal(np.minimum(at[live], far), np.maximum(at[live], far), period[live])
            low[live] = np.where(good, mid, low[live])
            high[live] = np.where(good, high[live], mid - 1)
            live = live[low[live] < high[live]]
        return low

    def _advance(self) -> np.ndarray:
        """Carry on the open matches over the words just appended; returns those that have become squares."""
        period, start, stop = self.open
        had = stop - start + period >= np.maximum(LEAST, 2 * period)
        stop = stop + self._reach(stop, period, self.n - period - stop, 1)
        self._keep(period, start, stop)
        now = (stop - start + period >= np.maximum(LEAST, 2 * period)) & ~had
        return np.stack([start[now], period[now]], axis=1)

    def _keep(self, period, start, stop) -> None:
        ended = stop + period < self.n
        self.advanced = (period, start, stop)
        self.open = tuple(x[~ended] for x in self.advanced)
        self.closed.append(self._squares(*(x[ended] for x in self.advanced)))

    def _matches(self, block: int, before: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks (their starts) and periods at which a block meets itself, completed by words after `before`."""
        low, high = (1, 7) if block == 2 else (2 * block - 1, 4 * block - 1)
        first = max(0, -(-(before - high + 2 - block) // block))
        count = (self.n - low) // block - first  # catchers whose nearest place is completed
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        prime, sums = PRIMES[0], self.sums[0]
        origin = first * block
        here = (sums[origin + block :] + (prime - sums[origin : len(sums) - block])) % prime
        width = high - low
        own = here[: count * block : block]
        padded = np.concatenate([here, np.full(max(0, (count - 1) * block + high - len(here)), prime, np.uint64)])  # no residue
        windows = np.lib.stride_tricks.as_strided(padded[low:], (count, width), (block * 8, 8), writeable=False)
        factor, rows = powers(0, high)[low:high], max(1, AT_ONCE // width)
        starts, offsets = [], []
        for i in range(0, count, rows):
            row, column = np.nonzero(own[i : i + rows, None] * factor % prime == windows[i : i + rows])
            starts.append(origin + (row + i) * block)
            offsets.append(column + low)
        starts, periods = np.concatenate(starts).astype(np.int64), np.concatenate(offsets).astype(np.int64)
        new = starts + periods + block > before
        starts, periods = starts[new], periods[new]
        good = self._equal(starts, starts + block, periods)
        return starts[good], periods[good]

    def _level(self, block: int, before: int) -> np.ndarray:
        """Catch by the blocks of one size: matches that no other holds yet, extended both ways."""
        start, period = self._matches(block, before)
        if len(start):
            held, a, b = self.advanced  # of the matches that were open, those of this period
            order = np.argsort(held)
            at = order[np.minimum(np.searchsorted(held[order], period), max(0, len(held) - 1))] if len(held) else np.zeros(len(start), np.int64)
            inside = (held[at] == period) & (a[at] <= start) & (start < b[at]) if len(held) else np.zeros(len(start), bool)
            start, period = start[~inside], period[~inside]
        if len(start):
            repeated = self._repeats(start, period)
            start, period = start[~repeated], period[~repeated]
        if not len(start):
            return np.zeros((0, 2), np.int64)
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        begins = np.concatenate([[True], (period[1:] != period[:-1]) | (start[1:] != start[:-1] + block)])
        ends = np.concatenate([np.flatnonzero(begins)[1:] - 1, [len(start) - 1]])
        stop = start[ends] + block
        start, period = start[begins], period[begins]
        start = start - self._reach(start, period, start, -1)
        stop = stop + self._reach(stop, period, self.n - period - stop, 1)
        _, one = np.unique(np.stack([period, start, stop], axis=1), axis=0, return_index=True)
        period, start, stop = period[one], start[one], stop[one]
        ended = stop + period < self.n
        self.open = tuple(np.concatenate([x, y[~ended]]) for x, y in zip(self.open, (period, start, stop)))
        self.closed.append(self._squares(*(x[ended] for x in (period, start, stop))))
        found = self._squares(period, start, stop)
        return np.stack([found[1], found[0]], axis=1)

    def _repeats(self, start: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether the first half lies in a known run whose period divides this one: then the square is that run's."""
        q, a, b = (np.concatenate(x) for x in zip(*self.closed, self._squares(*self.open)))
        if not len(q):
            return np.zeros(len(start), bool)
        order = np.lexsort((q, a))
        q, a, b = q[order], a[order], (b + q)[order]
        farthest = np.maximum.accumulate(b)
        owner = np.maximum.accumulate(np.where(b == farthest, np.arange(len(b)), 0))
        at = np.searchsorted(a, start, side="right") - 1
        run = owner[np.maximum(at, 0)]
        return (at >= 0) & (b[run] >= start + period) & (q[run] < period) & (period % q[run] == 0)


def repeating(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Where the contract makes the words of a document repeat and with which period; None where it leaves them."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def documents_runs(codes: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each list of words. Lists of about one length are read by one catcher, one after another, words being told
    apart by their list."""
    out = [np.zeros((0, 3), np.int64)] * len(codes)
    groups: dict[int, list[int]] = {}
    for i, c in enumerate(codes):
        if len(c) >= LEAST:
            groups.setdefault(len(c).bit_length(), []).append(i)
    for members in groups.values():
        catcher = SquareCatcher(max(len(codes[i]) for i in members))
        catcher.append(np.concatenate([codes[i] | (k << 32) for k, i in enumerate(members)]))
        runs = catcher.runs()
        begins = np.cumsum([0] + [len(codes[i]) for i in members])
        cuts = np.searchsorted(runs[:, 0], begins)
        for k, i in enumerate(members):
            out[i] = runs[cuts[k] : cuts[k + 1]] - np.array([begins[k], begins[k], 0])
    return out


FOUND = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def found_row(words: list[bytes], runs: np.ndarray) -> tuple:
    """A document's row of FOUND."""
    if not len(runs):
        return 0, None, None, None, None, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()
    told = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs.tolist())
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    kept = b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges)[:-1] == 0).tolist()])
    a, b, q = min(runs.tolist(), key=lambda r: (r[0] - r[1], r[0], r[2]))
    return len(runs), a, b - a, q, 1000 * (b - a) // q, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def repeated_runs(docs: DataFrame, rewritten: bool = False) -> DataFrame:
    """doc_id and FOUND of every row of docs (doc_id, text): the number of runs, the longest (ties: the first, then the smallest
    period), a digest of all, and one of the words that stay if each run is kept up to its first period. `rewritten` first makes
    the words of some documents repeat, as `repeating` says.

    A null or empty text has no words and no runs; a null doc_id stays and isn't rewritten; repeated rows are rows each; other
    columns are left out. A text is read whole, however long, and needs some 60 bytes of memory a word.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            ids = batch.column("doc_id").to_pylist()
            vocabulary: dict[bytes, int] = {}
            texts, codes = [], []
            for doc_id, text in zip(ids, text_lists(batch)):
                words = text.encode().split()
                if rewritten and (at := repeating(doc_id, len(words))):
                    a, p = at
                    words = words[:a] + (words[a : a + p] * (-(-(len(words) - a) // p)))[: len(words) - a]
                texts.append(words)
                codes.append(np.fromiter([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64, len(words)))
            rows = [found_row(w, r) for w, r in zip(texts, documents_runs(codes))]
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, t) for c, t in zip(columns, kinds)]], names=["doc_id", *[x.split()[0] for x in FOUND.split(", ")]])

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(lean(run), f"doc_id long, {FOUND}")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_runs(table(spark, sf_dir, "documents"), rewritten=True)
