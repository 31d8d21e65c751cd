"""FM-index over a sequence of integer symbols: suffix sorting, wavelet ranks, backward search, locating."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in lexicographic order.

    Prefix doubling: a group of suffixes that agree so far is ordered by the rank of what follows. Only groups
    that are still undecided are sorted again.
    """
    size = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(size, np.int64)
    ordered = symbols[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(size), 0))
    alone = fresh & np.concatenate([fresh[1:], [True]])
    open_ = np.flatnonzero(~alone)
    step = 1
    while len(open_):
        at = order[open_]
        follow = np.where(at + step < size, rank[np.minimum(at + step, size - 1)] + 1, 0)
        group = rank[at]
        sort = np.argsort(group * (size + 1) + follow, kind="stable")
        at, follow, group = at[sort], follow[sort], group[sort]
        order[open_] = at
        fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        rank[at] = np.maximum.accumulate(np.where(fresh, open_, 0))
        open_ = open_[~(fresh & np.concatenate([fresh[1:], [True]]))]
        step *= 2
    return order


class Bits:
    """A bit vector that counts the ones before a position."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))]).astype(np.int32)
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6] + np.bitwise_count(self.words[at >> 6] & mask).astype(np.int64)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """Wavelet levels over a sequence, highest bit first: symbol at a position and rank of a symbol before it."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for shift in range(bits - 1, -1, -1):
            bit = ((symbols >> shift) & 1).astype(np.uint8)
            self.levels.append((shift, Bits(bit)))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        start = np.zeros_like(at)
        for shift, level in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            ones_at, ones_start = level.ones(at), level.ones(start)
            at = np.where(one, level.zeros + ones_at, at - ones_at)
            start = np.where(one, level.zeros + ones_start, start - ones_start)
        return at - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for shift, level in self.levels:
            bit = level.get(at).astype(np.int64)
            symbol |= bit << shift
            ones = level.ones(at)
            at = np.where(bit == 1, level.zeros + ones, at - ones)
        return symbol


class FMIndex:
    """Index of a sequence of symbols >= 1; patterns are found by backward search."""

    def __init__(self, symbols: np.ndarray, top: int):
        text = np.append(symbols, np.int32(0)).astype(np.int32)
        order = suffix_order(text)
        self.size = len(text)
        self.wavelet = Wavelet(text[order - 1], max(1, int(top).bit_length()))
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        sampled = order % SAMPLE == 0
        self.sampled, self.samples = Bits(sampled), order[sampled].astype(np.int32)

    def search(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range [low, high) of each pattern, ``lengths`` symbols from ``starts`` on."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.size, np.int64)
        for back in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > back) & (low < high))
            if not len(live):
                break
            symbol = symbols[starts[live] + lengths[live] - 1 - back].astype(np.int64)
            low[live] = self.below[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: walks back until a sampled suffix."""
        found, steps, live = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.astype(np.int64)
        while len(live):
            hit = self.sampled.get(rows).astype(bool)
            found[live[hit]] = self.samples[self.sampled.ones(rows[hit])] + steps
            live, rows = live[~hit], rows[~hit]
            symbol = self.wavelet.access(rows)
            rows = self.below[symbol] + self.wavelet.rank(symbol, rows)
            steps += 1
        return found
