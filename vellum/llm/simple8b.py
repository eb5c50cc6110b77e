"""Simple-8b words: a selector in the top 4 bits, equal-width values in the other 60.

Selector 0 is the escape: the next word is one raw 64-bit value.  Raw values
need more than 60 bits, so their top bits are never a 0 selector and escapes
can be told apart without reading words in turn.

Blocks of BLOCK values start on a word; the offset of each block's first word
is kept, so blocks are coded and decoded side by side (numpy lanes).
"""

from __future__ import annotations

import numpy as np

BLOCK = 128

# Fixed values of the code: values per word and bits per value, by selector
# (1 to 14).
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
_LIMITS = np.array([1 << w for w in WIDTHS], dtype=np.uint64)
_NARROW = np.searchsorted(np.array(WIDTHS), np.arange(64)).astype(np.uint8)  # by bits of the value
SELECTOR_COUNT = np.array([1, *COUNTS, 0], dtype=np.int64)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint64) and the first word of every block, with the total at the end."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    grid = np.zeros(blocks * BLOCK, np.uint64)
    grid[:n] = values
    # one column per block, so that steps along a block run over whole rows
    place = np.arange(BLOCK, dtype=np.uint8)[:, None]
    size = np.minimum(BLOCK, n - BLOCK * np.arange(blocks))
    left = np.maximum(size[None, :] - place, 0).astype(np.uint8)
    # how many of the widths are too narrow for each value
    narrow = _NARROW[np.frexp(grid.astype(float))[1]] if int(grid.max()) < 1 << 52 else np.searchsorted(_LIMITS, grid, side="right").astype(np.uint8)
    lanes = np.ascontiguousarray(narrow.reshape(blocks, BLOCK).T)
    take = np.ones((BLOCK, blocks), np.uint8)
    selector = np.zeros((BLOCK, blocks), np.uint8)  # 0 where nothing fits: an escape
    # from few wide values to many narrow ones, the last that fits packs most; where no value is too wide, one is enough
    for s in range(min(len(COUNTS), int(lanes.max()) + 1), 0, -1):
        next_wide = np.where(lanes >= s, place, np.uint8(BLOCK))
        for i in range(BLOCK - 2, -1, -1):
            np.minimum(next_wide[i], next_wide[i + 1], out=next_wide[i])
        want = np.minimum(np.uint8(COUNTS[s - 1]), left)
        good = (next_wide - place >= want) & (want > 0)
        if not good.any():
            continue
        np.copyto(take, want, where=good)
        np.copyto(selector, np.uint8(s), where=good)
    # every lane walks its own block, one word a step
    at, row = np.zeros(blocks, np.int64), np.arange(blocks)
    order, starts = [], []
    step = 0
    while len(row):
        here = at[row]
        order.append(row * (2 * BLOCK) + step)
        starts.append(row * BLOCK + here)
        at[row] = here + take[here, row]
        row = row[at[row] < size[row]]
        step += 1
    order, starts = np.concatenate(order), np.concatenate(starts)
    starts = starts[np.argsort(order, kind="stable")]
    sel = selector[starts % BLOCK, starts // BLOCK]
    width = 1 + (sel == 0)
    to = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    flat_take = take[starts % BLOCK, starts // BLOCK]
    padded = np.concatenate([grid, np.zeros(64, np.uint64)])
    for s in range(1, len(COUNTS) + 1):
        mine = np.flatnonzero(sel == s)
        if not len(mine):
            continue
        k = np.arange(COUNTS[s - 1])
        v = padded[starts[mine][:, None] + k[None, :]]
        v[k[None, :] >= flat_take[mine][:, None]] = 0
        packed = np.bitwise_or.reduce(v << (k * WIDTHS[s - 1]).astype(np.uint64)[None, :], axis=1)
        words[to[mine]] = packed | np.uint64(s << 60)
    raw = np.flatnonzero(sel == 0)
    words[to[raw] + 1] = grid[starts[raw]]
    per_block = np.bincount(starts // BLOCK, weights=width, minlength=blocks).astype(np.int64)
    return words, np.concatenate([[0], np.cumsum(per_block)])


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values again (uint64)."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    raw[np.flatnonzero(sel[:-1] == 0) + 1] = True
    counts = np.where(raw, 0, SELECTOR_COUNT[sel])
    block = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    before = np.cumsum(counts) - counts
    start = block * BLOCK + before - before[offsets[block]]
    end = np.minimum((block + 1) * BLOCK, n)
    for s in range(1, len(COUNTS) + 1):
        mine = np.flatnonzero((sel == s) & ~raw)
        if not len(mine):
            continue
        k = np.arange(COUNTS[s - 1])
        v = (words[mine][:, None] >> (k * WIDTHS[s - 1]).astype(np.uint64)[None, :]) & np.uint64((1 << WIDTHS[s - 1]) - 1)
        to = start[mine][:, None] + k[None, :]
        good = to < end[mine][:, None]
        out[to[good]] = v[good]
    escapes = np.flatnonzero((sel == 0) & ~raw)
    out[start[escapes]] = words[escapes + 1]
    return out
