"""Burrows-Wheeler transform and common prefixes of a collection, built column by column.

Round ``j`` inserts one symbol of every text: its suffix of length ``j`` takes its place
among all shorter suffixes of the collection. The place follows from the transform so far:
the suffixes that begin with a symbol stand in the order in which that symbol stands in the
transform. The common prefix with a neighbour is one more than the least common prefix
between the two places where the symbol stood before. Each round reads the transform and
the prefixes front to back and writes them anew with the insertions, as a merge of files
does; the collection is bounded by its caller, so the lists are arrays of one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Transform:
    """One entry a suffix, in lexicographic order; end marks come before all symbols, in the texts' order."""
    symbol: np.ndarray  # the symbol before the suffix, 0 where it is a whole text
    prefix: np.ndarray  # symbols in common with the entry before
    text: np.ndarray
    length: np.ndarray


def _least_between(prefix: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least prefix of entries ``low + 1 .. high``; both ascend by ``high``."""
    padded = np.append(prefix, 0)
    return np.minimum.reduceat(padded, np.stack([low + 1, high + 1], 1).ravel())[::2]


def transform(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Transform:
    """The transform of the texts ``data[start: start + length]`` (bytes; at most 255 different ones)."""
    used = np.zeros(256, bool)
    used[data] = True
    codes = np.cumsum(used).astype(np.uint8)  # 0 stays free for "no symbol before"
    if used.all():
        raise ValueError("a collection may use at most 255 different bytes")
    coded = codes[data]
    m, longest = len(starts), int(lengths.max(initial=0))
    small = np.uint8 if longest < 256 else np.int32
    symbol = np.zeros(m, np.uint8)
    full = lengths > 0
    symbol[full] = coded[starts[full] + lengths[full] - 1]
    prefix, length = np.zeros(m, small), np.zeros(m, small)
    text, place = np.arange(m, dtype=np.int32), np.arange(m, dtype=np.int64)
    active = np.flatnonzero(full)
    for j in range(1, longest + 1):
        n, done = len(symbol), m - len(active)
        order = np.argsort(symbol, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        active = active[np.argsort(place[active])]
        here = place[active]
        mine = rank[here]
        c = symbol[here]
        before = order[mine - 1]  # rank 0 is never asked for where an entry without a symbol stands first
        joined = (mine > 0) & (symbol[before] == c)
        after = order[np.minimum(mine + 1, n - 1)]
        follows = (mine + 1 < n) & (symbol[after] == c)
        ahead = np.zeros(len(active), small)
        ahead[joined] = _least_between(prefix, before[joined], here[joined]) + 1
        behind = np.zeros(len(active), small)
        behind[follows] = _least_between(prefix, here[follows], after[follows]) + 1

        target = mine + (m - done)
        old = np.ones(n + len(active), bool)
        old[target] = False
        left = lengths[active] - j
        coming = np.where(left > 0, coded[starts[active] + np.maximum(left - 1, 0)], 0).astype(np.uint8)

        def merged(kept: np.ndarray, new) -> np.ndarray:
            out = np.empty(len(old), kept.dtype)
            out[old] = kept
            out[target] = new
            return out

        symbol, text, length = merged(symbol, coming), merged(text, active), merged(length, j)
        prefix = merged(prefix, ahead)
        inner = target + 1 < len(old)
        prefix[target[inner] + 1] = behind[inner]
        place[active] = target
        active = active[left > 0]
    return Transform(symbol, prefix, text, length)
