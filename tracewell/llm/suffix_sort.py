"""Suffix sorting by a difference cover, to the depth at which prefixes are compared."""

from __future__ import annotations

import numpy as np

#: Symbols and ranks are packed three to a word.
BITS = np.uint64(21)
MOST = (1 << 21) - 4
#: Prefixes that are compared at a time.
ROWS = 1 << 15


def packed(*parts: np.ndarray) -> np.ndarray:
    out = parts[0].astype(np.uint64)
    for p in parts[1:]:
        out = out << BITS | p.astype(np.uint64)
    return out


def suffix_order(t: np.ndarray, depth: int, covered: int = 1) -> np.ndarray:
    """Positions of t in the order of what follows them, as far as `depth` characters tell; t is of at most MOST small integers.

    The difference cover is {1, 2} modulo 3. Triples at sampled positions are sorted and named; unless all
    names differ (or stand for `depth` characters already) the string of names is ordered the same way,
    which ranks the samples. The other positions are ordered by their symbol and the rank behind it, and
    merged in: against positions 1 modulo 3 by (symbol, rank), against 2 modulo 3 by (symbol, symbol, rank).
    `covered` is how many characters a symbol of t stands for.
    """
    n = len(t)
    if covered >= depth or n < 3:
        return np.argsort(t, kind="stable")
    t = np.concatenate([t, np.zeros(3, t.dtype)])
    ones, twos = np.arange(1, n, 3), np.arange(2, n, 3)
    sampled = np.concatenate([ones, twos])
    names, name = np.unique(packed(t[sampled], t[sampled + 1], t[sampled + 2]), return_inverse=True)
    if len(names) == len(sampled):
        samples = sampled[np.argsort(name)]
    else:
        child = np.concatenate([name[: len(ones)] + 1, [0], name[len(ones) :] + 1]).astype(np.uint32)
        order = suffix_order(child, depth, covered * 3)
        order = order[order != len(ones)]
        samples = sampled[order - (order > len(ones))]
    rank = np.zeros(n + 3, np.uint32)
    rank[samples] = np.arange(1, len(samples) + 1, dtype=np.uint32)
    others = np.arange(0, n, 3)
    others = others[np.argsort(packed(t[others], rank[others + 1]), kind="stable")]
    ones, twos = samples[samples % 3 == 1], samples[samples % 3 == 2]
    before = np.searchsorted(packed(t[ones], rank[ones + 1]), packed(t[others], rank[others + 1]))
    before += np.searchsorted(packed(t[twos], t[twos + 1], rank[twos + 2]), packed(t[others], t[others + 1], rank[others + 2]))
    places = np.arange(len(others)) + np.maximum.accumulate(before)
    out, free = np.empty(n, np.int64), np.ones(n, bool)
    out[places] = others
    free[places] = False
    out[free] = samples
    return out


def repeated(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each text, which of its strings of `width` bytes also begin elsewhere in texts, by their first byte.

    All suffixes are sorted together; those with equal beginnings then stand side by side, so comparing
    the first `width` bytes of neighbours finds every repetition. The texts have at most MOST bytes in all,
    counting one more for each.
    """
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    joined = np.frombuffer(b"\0".join(texts) + b"\0" * width, np.uint8)
    symbols = joined[: ends[-1]].astype(np.uint32) + 1
    symbols[ends[:-1]] = 0
    starts = np.ones(len(symbols), bool)  # where a whole string begins
    for end, text in zip(ends.tolist(), texts, strict=True):
        starts[max(end - len(text), end - width + 1) : end + 1] = False
    order = suffix_order(symbols, width)
    order = order[starts[order]]
    windows, same = np.lib.stride_tricks.sliding_window_view(joined, width), np.zeros(len(symbols), bool)
    for at in range(0, len(order) - 1, ROWS):
        part = order[at : at + ROWS + 1]
        rows = np.ascontiguousarray(windows[part])
        rows = rows.view(np.uint64) if width % 8 == 0 else rows
        equal = (rows[1:] == rows[:-1]).all(axis=1)
        same[part[1:][equal]] = True
        same[part[:-1][equal]] = True
    return [same[end - len(t) : max(end - len(t), end - width + 1)] for end, t in zip(ends.tolist(), texts, strict=True)]
