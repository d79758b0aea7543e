"""Simple-8b coding of id sequences, vectorised over lanes.

A 64-bit word holds a selector (upper 4 bits) and as many values as fit its width in the other 60.
Values that need more than ``ESCAPE_BITS`` bits are written as 0 and listed apart with their
positions, so one large value does not force a wide word; any unsigned 64-bit value can be coded.
Each block of ``BLOCK`` values starts on a word of its own, and the offsets of the blocks are kept, so
blocks can be found and decoded independently.  Encoding walks all blocks in step (one numpy pass per
word of the longest block); decoding takes one pass per selector.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256
ESCAPE_BITS = 30
# Fixed values of the coding: values per word and bits per value, by selector.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)


def _windows(bits: np.ndarray) -> dict[int, np.ndarray]:
    """For each count, the most bits in the window of that many values from each position (rows are
    padded with zeros, which always fit)."""
    longest, out, span = bits, {1: bits}, 1
    for count in sorted(COUNTS)[1:]:
        while 2 * span <= count:
            ahead = np.zeros_like(longest)
            ahead[:, :-span] = longest[:, span:]
            longest, span = np.maximum(longest, ahead), 2 * span
        shift = count - span
        if shift:
            ahead = np.zeros_like(longest)
            ahead[:, :-shift] = longest[:, shift:]
            out[count] = np.maximum(longest, ahead)
        else:
            out[count] = longest
    return out


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``words, offsets`` (first word of each block, one more at the end), ``escape positions, escaped
    values``."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    escaped = np.flatnonzero(values >> np.uint64(ESCAPE_BITS))
    n, lanes = len(values), -(-len(values) // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32), escaped.astype(np.uint32), np.zeros(0, np.uint64)
    grid = np.zeros((lanes, BLOCK), np.uint64)
    grid.ravel()[:n] = values
    grid.ravel()[escaped] = 0
    # frexp's exponent is the bit length; values are below 2**30 here, so float64 holds them exactly
    bits = np.frexp(grid.astype(np.float64))[1].astype(np.uint8)
    most = _windows(bits)
    selector = np.full(grid.shape, 15, np.uint8)
    for s in range(14, -1, -1):
        selector[most[COUNTS[s]] <= WIDTHS[s]] = s
    counts = np.array(COUNTS, np.int64)
    length = np.full(lanes, BLOCK, np.int64)
    length[-1] = n - (lanes - 1) * BLOCK
    at, live, steps = np.zeros(lanes, np.int64), np.arange(lanes), []
    while len(live):
        pos = at[live]
        steps.append((live, pos, selector[live, pos]))
        at[live] = pos + counts[selector[live, pos]]
        live = live[at[live] < length[live]]
    lane = np.concatenate([s[0] for s in steps])
    pos = np.concatenate([s[1] for s in steps])
    sel = np.concatenate([s[2] for s in steps])
    order = np.lexsort((pos, lane))
    lane, pos, sel = lane[order], pos[order], sel[order]
    words = sel.astype(np.uint64) << np.uint64(60)
    padded = np.zeros((lanes, BLOCK + 60), np.uint64)
    padded[:, :BLOCK] = grid
    for s in range(2, 16):
        at_s = np.flatnonzero(sel == s)
        if len(at_s):
            word = words[at_s]
            for j in range(COUNTS[s]):
                word |= padded[lane[at_s], pos[at_s] + j] << np.uint64(j * WIDTHS[s])
            words[at_s] = word
    offsets = np.searchsorted(lane, np.arange(lanes + 1)).astype(np.uint32)
    return words, offsets, escaped.astype(np.uint32), values[escaped]


def decode(words: np.ndarray, offsets: np.ndarray, n: int, escape_at: np.ndarray, escape_values: np.ndarray,
           ) -> np.ndarray:
    """The ``n`` values of ``encode``."""
    out = np.zeros(max(n, 0) + 240, np.uint64)
    if n:
        sel = (words >> np.uint64(60)).astype(np.uint8)
        counts = np.array(COUNTS, np.int64)[sel]
        before = np.cumsum(counts) - counts
        lane = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets.astype(np.int64)))
        start = before - before[offsets[:-1].astype(np.int64)][lane] + lane * BLOCK
        end = np.minimum((lane + 1) * BLOCK, n)
        for s in range(2, 16):
            at_s = np.flatnonzero(sel == s)
            if len(at_s):
                mask = np.uint64((1 << WIDTHS[s]) - 1)
                for j in range(COUNTS[s]):
                    to = start[at_s] + j
                    ok = to < end[at_s]
                    out[to[ok]] = (words[at_s][ok] >> np.uint64(j * WIDTHS[s])) & mask
    out = out[:n]
    out[escape_at.astype(np.int64)] = escape_values
    return out
