"""Word-aligned integer coding: a 4-bit selector and up to 60 values in each 64-bit word.

Selector s > 0 says how many values of how many bits share the word; the next
values that fit go in, as many as possible. Selector 0 is the escape: its word
holds the position of one value of over 60 bits in a side list. Values come in
blocks of BLOCK; each block starts a new word and its word offset is stored, so
every block can be coded and decoded on its own, all of them at once."""

from __future__ import annotations

import numpy as np

COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.uint64)
BLOCK = 256
_SHIFT = np.uint64(60)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, word offset of each block, and the escaped values."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    starts = np.arange(0, n, BLOCK)
    stops = np.minimum(starts + BLOCK, n)
    # bits of each value, a row per block; zeros behind a block's end let its last word be short
    bits = np.zeros((len(starts), BLOCK + 60), dtype=np.uint8)
    flat = np.zeros(len(starts) * BLOCK, dtype=np.uint8)
    flat[:n] = np.frexp(values.astype(np.float64))[1]  # may round up next to a power of two: never too few
    bits[:, :BLOCK] = flat.reshape(-1, BLOCK)
    most = {1: bits}  # largest among as many values from here
    for count, part in ((2, 1), (3, 2), (4, 2), (5, 3), (6, 3), (7, 4), (8, 4), (10, 5), (12, 6), (15, 8), (20, 10), (30, 15), (60, 30)):
        shift = count - part
        most[count] = most[part].copy()
        np.maximum(most[part][:, :-shift], most[part][:, shift:], out=most[count][:, :-shift])
    choice = np.zeros((len(starts), BLOCK), dtype=np.int8)  # 0: more than 60 bits
    for s in range(len(COUNTS) - 1, 0, -1):
        np.copyto(choice, np.int8(s), where=most[int(COUNTS[s])][:, :BLOCK] <= np.uint8(BITS[s]))
    choice = choice.ravel()
    at, block, chosen = starts.copy(), np.arange(len(starts)), []
    while len(at):  # all blocks step together
        chosen.append(np.stack([block, at]))
        at = at + COUNTS[choice[at]]
        more = at < stops[block]
        at, block = at[more], block[more]
    block, at = np.concatenate(chosen, axis=1)
    order = np.argsort(at)
    block, at = block[order], at[order]
    s = choice[at].astype(np.int64)
    words = s.astype(np.uint64) << _SHIFT
    room = np.minimum(COUNTS[s], stops[block] - at)
    for k in range(int(room.max())):
        has = np.flatnonzero((room > k) & (s > 0))
        if len(has):
            words[has] |= values[at[has] + k] << (BITS[s[has]] * np.uint64(k))
    escaped = np.flatnonzero(s == 0)
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    return words, np.searchsorted(block, np.arange(len(starts))), values[at[escaped]]


def decode(words: np.ndarray, offsets: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The n values again, all words at once."""
    if n == 0:
        return np.zeros(0, dtype=np.uint64)
    s = (words >> _SHIFT).astype(np.int64)
    count = COUNTS[s]
    ends = np.cumsum(count)
    first = np.arange(len(offsets)) * BLOCK
    # a block's last word may hold fewer values than its selector says
    last = np.append(offsets[1:], len(words)) - 1
    held = np.minimum(first + BLOCK, n) - first
    before = np.where(offsets > 0, ends[np.maximum(offsets - 1, 0)], 0)
    count[last] = held - (ends[last] - count[last] - before)
    ends = np.cumsum(count)
    slot = (np.arange(n) - np.repeat(ends - count, count)).astype(np.uint64)
    width = np.repeat(BITS[s], count)
    body = words & np.uint64((1 << 60) - 1)
    out = (np.repeat(body, count) >> (slot * width)) & ((np.uint64(1) << width) - np.uint64(1))
    if len(escaped):
        far = np.repeat(s == 0, count)
        out[far] = escaped[out[far].astype(np.int64)]
    return out
