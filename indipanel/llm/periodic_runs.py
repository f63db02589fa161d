"""Periodic runs of words in texts, found by catching squares while words are appended."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts

# Bytes of text whose words are appended to one sequence; a longer text is a sequence of its own.
SLICE_BYTES = 2 << 20

# Pairs of blocks whose neighbourhood is compared at once.
PAIRS = 1 << 18

# Base of the fingerprints of blocks. Equal fingerprints are only a hint: words are compared afterwards.
_BASE = np.uint64(0x9E3779B97F4A7C15)

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def _mixed(words: np.ndarray) -> np.ndarray:
    """One pseudo-random odd number for each word."""
    x = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(32))) | np.uint64(1)


class SquareCatchers:
    """Catches the squares (a stretch of words said twice in a row) of a growing sequence of words.

    On level k every completed block of L = 2**k words has a catcher. It is in charge of the squares
    with a half of 2L - 1 to 4L - 2 words whose first half holds the block: any such half holds one.
    With each appended word it compares the last L words of the sequence with its block, by fingerprints.
    If they agree at distance p, the words before the two places are compared backwards, and the words
    behind them forwards, as long as words are appended. Once 2p words repeat at distance p there is a
    square, and each further agreement is a new one. Overlapping squares of one period merge into runs.

    All catchers of a level take their p-th next word together, as one comparison of arrays, whether
    the words are appended one by one or many at once; the runs are the same.

    max_period  longer halves are not looked for
    """

    def __init__(self, max_period: int | None = None):
        self.max_period = max_period
        self.n = 0
        self._words = np.zeros(0, np.int64)
        self._prints = np.zeros(1, np.uint64)       # sums of word fingerprints times powers of the base
        self._powers = np.ones(1, np.uint64)
        self._live = np.zeros((4, 0), np.int64)     # place, period, agreeing words before and from the place on
        self._runs = np.zeros((3, 0), np.int64)     # start, end, period

    def append(self, words: np.ndarray) -> np.ndarray:
        """Take the next words; gives (start, end, period) of the stretches whose squares they completed."""
        old, self.n = self.n, self.n + len(words)
        self._store(np.asarray(words, np.int64), old)
        caught = [self._settle(self._live)]
        level = 1
        most = self.n - 1 if self.max_period is None else min(self.max_period, self.n - 1)
        while 2 * level - 1 <= most:
            for pairs in self._copies(level, min(4 * level - 2, most), old):
                before = self._agreeing(pairs[0] - 1, pairs[1], np.minimum(pairs[0], pairs[1]), -1)
                caught.append(self._settle(np.stack([*pairs, before, np.zeros_like(before)]), level))
            level *= 2
        return np.concatenate(caught, axis=1)

    def runs(self) -> np.ndarray:
        """(start, end, smallest period) of every run so far of two periods or more, by start and period."""
        start, end, period = self._runs
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.ones(len(start), bool)           # a multiple of the period fills the same stretch
        first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        found = np.stack([start[first], end[first], period[first]])
        return found[:, np.lexsort((found[2], found[0]))]

    def _store(self, words: np.ndarray, old: int) -> None:
        if self.n > len(self._words):
            room = max(self.n, 2 * len(self._words))
            self._words = np.concatenate([self._words[:old], np.zeros(room - old, np.int64)])
            self._prints = np.concatenate([self._prints[: old + 1], np.zeros(room - old, np.uint64)])
            more = np.multiply.accumulate(np.full(room + 1 - len(self._powers), _BASE, np.uint64))
            self._powers = np.concatenate([self._powers, more * self._powers[-1:]])
        self._words[old: self.n] = words
        terms = _mixed(words) * self._powers[old: self.n]
        self._prints[old + 1: self.n + 1] = np.add.accumulate(terms) + self._prints[old: old + 1]

    def _copies(self, size: int, longest: int, old: int):
        """(places, periods) of blocks whose copy ends in the new words, in parts of bounded size."""
        ends, begins = self._prints[size: self.n + 1: size], self._prints[: self.n + 1 - size: size]
        blocks = ends - begins
        known = self._runs[:, self._runs[2] <= size]
        known = known[:, np.argsort(known[0], kind="stable")]
        reach = np.append(0, np.maximum.accumulate(known[1]))
        places, periods, waiting = [], [], 0
        for p in range(2 * size - 1, longest + 1):
            first, last = max(0, -((p + size - 1 - old) // size)), (self.n - p - size) // size
            if last < first:
                continue
            a, b = first * size + p, last * size + p
            later = self._prints[a + size: b + size + 1: size] - self._prints[a: b + 1: size]
            at = (np.flatnonzero(blocks[first: last + 1] * self._powers[p] == later) + first) * size
            if len(at) and known.shape[1]:
                # inside one run of a shorter period the copy says nothing new
                at = at[at + p + size > reach[np.searchsorted(known[0], at, side="right")]]
            if len(at):
                places.append(at)
                periods.append(np.full(len(at), p))
                waiting += len(at)
            if waiting > PAIRS:
                yield np.concatenate(places), np.concatenate(periods)
                places, periods, waiting = [], [], 0
        if waiting:
            yield np.concatenate(places), np.concatenate(periods)

    def _agreeing(self, place: np.ndarray, period: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
        """How many words in a row, up to the limit, equal those a period later; from place on, in steps of 1 or -1."""
        done = np.zeros(len(place), np.int64)
        live, width = np.arange(len(place)), 8
        while len(live):
            offsets = done[live, None] + np.arange(width)
            at = np.clip(place[live, None] + step * offsets, 0, self.n - 1)
            same = self._words[at] == self._words[np.minimum(at + period[live, None], self.n - 1)]
            same &= offsets < limit[live, None]
            grown = np.where(same.all(axis=1), width, same.argmin(axis=1))
            done[live] += grown
            live = live[grown == width]
            width = min(4 * width, max(8, PAIRS // max(len(live), 1)))
        return done

    def _settle(self, pairs: np.ndarray, size: int = 1) -> np.ndarray:
        """Compare forwards as far as there are words; keep what may go on, merge what is a square."""
        place, period, before, after = pairs
        limit = np.minimum(2 * period, self.n - place - period)
        after = after + self._agreeing(place + after, period, limit - after, 1)
        goes_on = (after == limit) & (limit < 2 * period)
        still = np.stack([place, period, before, after])[:, goes_on]
        self._live = still if pairs is self._live else np.concatenate([self._live, still], axis=1)
        square = before + after >= period
        found = np.stack([place - before, place + period + after, period])[:, square]
        if found.shape[1]:
            self._runs = _merged(np.concatenate([self._runs, found], axis=1))
        return found


def _merged(stretches: np.ndarray) -> np.ndarray:
    """Stretches of one period that share a period's words or more are one stretch."""
    start, end, period = stretches[:, np.lexsort((stretches[0], stretches[2]))]
    group = np.cumsum(np.append(0, period[1:] != period[:-1]))
    wide = int(end.max()) + 1
    furthest = np.maximum.accumulate(end + group * wide) - group * wide
    new = np.ones(len(start), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > furthest[:-1] - period[1:])
    firsts = np.flatnonzero(new)
    return np.stack([start[firsts], np.maximum.reduceat(end, firsts), period[firsts]])


def runs_of(sequences: list[np.ndarray], min_exponent: int = 4, min_words: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """((start, length, period) of the runs of all sequences, by sequence, start and period; n + 1 bounds of them).

    A run has at least ``min_exponent`` (2 or more) periods and ``min_words`` words.
    """
    sizes = np.array([len(s) for s in sequences], np.int64)
    bounds = np.append(0, np.cumsum(sizes))
    if not bounds[-1]:
        return np.zeros((3, 0), np.int64), np.zeros(len(sequences) + 1, np.int64)
    words = np.concatenate(sequences).astype(np.int64)
    # words of different sequences differ, so that no square reaches from one into the next
    words += np.repeat(np.arange(len(sequences)), sizes) * (int(words.max()) + 1)
    catchers = SquareCatchers(max_period=int(sizes.max()) // min_exponent)
    catchers.append(words)
    start, end, period = catchers.runs()
    kept = end - start >= np.maximum(min_exponent * period, min_words)
    start, end, period = start[kept], end[kept], period[kept]
    owner = np.searchsorted(bounds, start, side="right") - 1
    return np.stack([start - bounds[owner], end - start, period]), np.searchsorted(owner, np.arange(len(sequences) + 1))


def find_runs(df: DataFrame, keep: list[str] = ("doc_id",), text: str = "text", min_exponent: int = 4,
              min_words: int = 6) -> DataFrame:
    """The columns ``keep`` and of each text n_words, runs (start, length, period) and collapsed.

    Words are split at blanks and \\t to \\r and numbered from 0. A run is a longest stretch with one
    smallest period. ``collapsed`` are the words, joined by one blank, without those that some run
    holds after its first period. A null or empty text has no words, no runs and an empty collapsed
    text. Repeated rows repeat their result; columns not named are not read. Every text is taken whole;
    memory is bounded by the longest text.
    """
    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
              T.StructField("collapsed", T.StringType())]

    def fill(texts: pa.Array) -> list[pa.Array]:
        said = [(t or "").encode().split() for t in texts.to_pylist()]
        sizes = [len(s) for s in said]
        codes = pa.array([w for s in said for w in s], pa.large_binary()).dictionary_encode().indices
        codes = codes.to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        found, bounds = runs_of([codes[e - n: e] for e, n in zip(ends, sizes)], min_exponent, min_words)
        start, length, period = found
        left = []
        for words, a, b in zip(said, bounds[:-1], bounds[1:]):
            if b > a:
                turns = np.zeros(len(words) + 1, np.int64)
                np.add.at(turns, start[a:b] + period[a:b], 1)
                np.add.at(turns, start[a:b] + length[a:b], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(turns[:-1]) == 0)]
            left.append(b" ".join(words).decode())
        runs = pa.ListArray.from_arrays(
            pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(c) for c in found], RUN.fieldNames()))
        return [pa.array(sizes, pa.int64()), runs, pa.array(left, pa.large_string())]

    return map_texts(df, text, fields, lambda: fill, list(keep), SLICE_BYTES)
