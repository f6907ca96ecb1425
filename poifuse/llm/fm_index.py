"""FM-index of word sequences: backward search over a wavelet matrix, many patterns at a time."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector in 64-bit words with a running count of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.int32)
        np.cumsum(np.bitwise_count(self.words)[:-1], out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = at >> 6
        low = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """Order of all suffixes by doubling; the ranks must tell every suffix apart in the end."""
    n = len(ranks)
    rank = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        follow = np.zeros(n, dtype=np.int64)
        follow[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, dtype=np.int64)
        new[order] = np.cumsum(np.append(0, key[order[1:]] != key[order[:-1]]))
        if new[order[-1]] == n - 1 or step >= n:
            return order
        rank, step = new, step * 2


class FmIndex:
    """Sequences of 64-bit symbols, each with an owner; patterns match inside one sequence.

    `least` tells the smallest owner of a range of suffixes, so that a search can
    ask for occurrences of smaller owners only."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, owners: np.ndarray) -> None:
        count, n = len(sizes), len(symbols) + len(sizes)
        self.alphabet, ids = np.unique(symbols, return_inverse=True)
        place = np.arange(len(symbols)) + np.repeat(np.arange(count), sizes)
        text = np.zeros(n, dtype=np.int64)  # 0 ends each sequence
        text[place] = ids + 1
        ranks = text + count
        ends = np.flatnonzero(text == 0)
        ranks[ends] = np.arange(count)  # every end is a symbol of its own
        order = suffix_array(ranks)
        owner = np.repeat(owners.astype(np.int32), sizes + 1)[order]
        last = text[order - 1]
        self.size, self.levels = n, max(1, int(len(self.alphabet)).bit_length())
        self.bits, self.zeros = [], []
        current = last.astype(np.int32)
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            self.bits.append(Bits(bit.astype(np.uint8)))
            zero = bit == 0
            self.zeros.append(int(zero.sum()))
            current = np.concatenate([current[zero], current[~zero]])
        smaller = np.searchsorted(np.sort(text), np.arange(len(self.alphabet) + 1))
        self.shift = np.zeros(len(self.alphabet) + 1, dtype=np.int64)
        self.shift = smaller - self._descend(np.arange(len(self.alphabet) + 1), np.zeros(len(self.alphabet) + 1, dtype=np.int64))
        table = [owner]
        while 2 << (len(table) - 1) <= n:
            half, top = 1 << (len(table) - 1), table[-1]
            table.append(top.copy())
            np.minimum(top[:-half], top[half:], out=table[-1][:-half])
        self.table = np.concatenate(table)
        self.power = np.zeros(n + 1, dtype=np.int8)
        for k in range(1, len(table)):
            self.power[1 << k :] = k

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            ones = self.bits[k].ones(at)
            at = np.where((symbol >> (self.levels - 1 - k)) & 1 == 1, self.zeros[k] + ones, at - ones)
        return at

    def symbols(self, values: np.ndarray) -> np.ndarray:
        """Symbol numbers of values; -1 if the index has none."""
        at = np.minimum(np.searchsorted(self.alphabet, values), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == values, at + 1, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of symbol + pattern from the ranges of the patterns."""
        both = self._descend(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return both[: len(low)] + self.shift[symbol], both[len(low) :] + self.shift[symbol]

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest owner in each range that isn't empty."""
        power = self.power[high - low].astype(np.int64)
        base = power * self.size
        return np.minimum(self.table[base + low], self.table[base + high - (1 << power)])


def repeated_spans(index: FmIndex, symbols: np.ndarray, sizes: np.ndarray, owners: np.ndarray, least: int, piece: int = 160) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal spans of at least `least` symbols of each sequence that occur with a smaller owner: (sequence, from, to).

    Every sequence is read from its end, in pieces of at most `piece` symbols that
    overlap by all but one of a window. After a search that fell short, and before
    the next window is searched in full, two short probes at its left end can rule out
    all windows that hold them."""
    if piece < 2 * least:
        piece = 2 * least
    whole, step = np.asarray(sizes), piece - least + 1
    count = np.maximum(1, -(-(whole - least + 1) // step))
    parent = np.repeat(np.arange(len(whole)), count)
    offset = (np.arange(len(parent)) - np.repeat(np.cumsum(count) - count, count)) * step
    first = (np.cumsum(whole) - whole)[parent] + offset
    sizes, owners = np.minimum(whole[parent] - offset, piece), np.asarray(owners)[parent]
    coded = index.symbols(symbols)
    probes = (min(8, least), min(24, least), least)
    alive = np.flatnonzero(sizes >= least)
    end = first[alive] + sizes[alive]  # largest undecided end of a window
    begin, owner = first[alive], owners[alive]
    stage = np.full(len(alive), 2, dtype=np.int64)
    top = end.copy()
    at = top.copy()
    low, high = np.zeros(len(alive), dtype=np.int64), np.full(len(alive), index.size, dtype=np.int64)
    ahead = np.array(probes)
    found = []
    while len(alive):
        left = end - least
        can = at > begin
        symbol = np.where(can, coded[np.maximum(at - 1, 0)], -1)
        tries = np.flatnonzero(symbol > 0)
        good = np.zeros(len(alive), dtype=bool)
        if len(tries):
            lo, hi = index.extend(symbol[tries], low[tries], high[tries])
            some = np.flatnonzero(lo < hi)
            some = some[index.least(lo[some], hi[some]) < owner[tries[some]]]
            good[tries[some]] = True
            low[tries[some]], high[tries[some]] = lo[some], hi[some]
        at[good] -= 1
        rise = good & (stage < 2) & (at == left)
        stop = ~good
        hit = stop & (at <= left)  # only full searches pass the left end
        if hit.any():
            found.append(np.stack([alive[hit], at[hit] - begin[hit], top[hit] - begin[hit]]))
        end = np.where(hit, at - 1 + least, np.where(stop, top - 1, end))
        stage = np.where(rise, stage + 1, np.where(stop, 0, stage))
        fresh = rise | stop
        top = np.where(fresh, end - least + ahead[stage], top)
        at = np.where(fresh, top, at)
        low = np.where(fresh, 0, low)
        high = np.where(fresh, index.size, high)
        keep = end - least >= begin
        if not keep.all():
            alive, end, begin, owner, stage, top, at, low, high = (x[keep] for x in (alive, end, begin, owner, stage, top, at, low, high))
    if found:
        part, a, b = np.concatenate(found, axis=1)
        return parent[part], a + offset[part], b + offset[part]
    return (np.zeros(0, dtype=np.int64),) * 3
