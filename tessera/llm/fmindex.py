"""A full-text index over integer symbols: suffix array, Burrows-Wheeler transform, wavelet-tree ranks, sampled suffixes.

Symbol 0 separates stretches and never occurs in a pattern. All searches work on arrays of patterns at once.
"""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 32


def suffix_array(sym: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order; every separator counts as different, in the order of position.

    Prefix doubling that starts with as many symbols as a 64-bit key holds and re-sorts only the groups that still tie.
    ``sym`` must end with a separator.
    """
    n = len(sym)
    at = np.flatnonzero(sym == 0)
    single = sym.astype(np.int64) + len(at)
    single[at] = np.arange(len(at))
    base = int(single.max()) + 1
    key, depth = single, 1
    padded = np.concatenate((single, np.zeros(64, np.int64)))
    while base ** (depth + 1) < 1 << 62 and depth < 64:  # several symbols in one key from the start
        key = key * base + padded[depth : depth + n]
        depth += 1
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    sorted_key = key[order]
    head = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[order] = group
    active = np.flatnonzero(~(head & np.concatenate((head[1:], [True]))))
    while len(active):
        pos, own = order[active], group[active]
        then = rank[pos + depth]
        pair = own * n + then
        by = np.argsort(pair)
        pos, pair, own = pos[by], pair[by], own[by]
        order[active] = pos
        fresh = np.concatenate(([True], pair[1:] != pair[:-1]))
        group[active] = np.maximum.accumulate(np.where(fresh, active, 0))
        rank[pos] = group[active]
        alone = fresh & np.concatenate((fresh[1:], [True]))
        active = active[~alone]
        depth *= 2
    return order


class BitVector:
    """Packed bits with constant-time rank."""

    def __init__(self, bits: np.ndarray) -> None:
        self.n = len(bits)
        raw = np.packbits(bits, bitorder="little")
        words = np.zeros(self.n // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(raw)] = raw
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in [0, i)."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletTree:
    """Ranks of symbols by one bit vector a level, all nodes of a level side by side."""

    def __init__(self, seq: np.ndarray, sigma: int) -> None:
        self.levels: list[tuple[int, BitVector, int]] = []
        seq = seq.astype(np.uint32)
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bit = (seq >> shift) & 1 == 1
            self.levels.append((shift, BitVector(bit), int(len(seq) - bit.sum())))
            seq = np.concatenate((seq[~bit], seq[bit]))
        self.start = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where((c >> shift) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol c in [0, i)."""
        return self._down(c, i) - self.start[c]


class FMIndex:
    def __init__(self, sym: np.ndarray, sigma: int) -> None:
        """``sym``: symbols in [0, sigma), ending with a separator."""
        self.n = len(sym)
        order = suffix_array(sym)
        self.bwt = sym[order - 1]
        self.tree = WaveletTree(self.bwt, sigma)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(sym, minlength=sigma))))[:-1]
        # the start of a stretch is always sampled: no walk steps over a separator
        sampled = (order % SAMPLE_EVERY == 0) | (self.bwt == 0)
        self.sampled, self.samples = BitVector(sampled), order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [lo, hi) of the patterns, rows of a right-aligned matrix; empty where lo == hi."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        live = np.arange(len(patterns))
        for k in range(width):
            live = live[(lengths[live] > k) & (lo[live] < hi[live])]
            if not len(live):
                break
            c = patterns[live, width - 1 - k]
            lo[live] = self.less[c] + self.tree.rank(c, lo[live])
            hi[live] = self.less[c] + self.tree.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, walking back to the nearest sampled suffix."""
        out = np.zeros(len(rows), np.int64)
        left, row, steps = np.arange(len(rows)), rows, 0
        while len(left):
            done = self.sampled[row]
            out[left[done]] = self.samples[self.sampled.rank(row[done])] + steps
            left, row = left[~done], row[~done]
            c = self.bwt[row]
            row = self.less[c] + self.tree.rank(c, row)
            steps += 1
        return out
