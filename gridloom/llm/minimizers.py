"""Content-defined pieces of texts: every window of ``width`` bytes belongs to the piece of its least gram.

The least of the ``width - gram + 1`` gram hashes in a window (the leftmost of equal ones)
depends on the window's bytes alone. Consecutive windows with the same least gram make a
piece. So equal windows, wherever they stand, lie in pieces with equal gram hash (``key``),
at the same place relative to that gram, and a window whose key is unique occurs once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from gridloom.llm.words import _SEGMENT, _VALUES, _power_tables, mix, take_ranges, word_hashes

STARTS = 1 << 20  # windows handled at once; a longer text takes several turns
_SAME = np.arange(256, dtype=np.uint8)
_PLACE = np.uint64((1 << 31) - 1)


@dataclass
class Pieces:
    """``n`` windows from byte ``first`` on; ``gram`` is the place of their least gram."""
    first: np.ndarray
    n: np.ndarray
    gram: np.ndarray
    key: np.ndarray

    def hashes(self, data: np.ndarray, width: int) -> np.ndarray:
        """64-bit hashes of the pieces' bytes."""
        return word_hashes(data, self.first, self.first + self.n + width - 1, _SAME)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    out = np.empty(max(len(data) - gram + 1, 0), np.uint64)
    up, down = _power_tables(_SEGMENT + gram + 1)
    for a in range(0, len(out), _SEGMENT):
        b = min(a + _SEGMENT, len(out))
        part = data[a: b + gram - 1]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_VALUES[part] * up[: len(part)], out=sums[1:])
        out[a:b] = (sums[gram:] - sums[:-gram]) * down[: b - a]
    return mix(out)


def _sliding_least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive values, by running minima of blocks from both ends."""
    n = len(values) - size + 1
    blocks = np.concatenate([values, np.full(-len(values) % size, values.max())]).reshape(-1, size)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1]).ravel()
    return np.minimum(behind[:n], ahead[size - 1: size - 1 + n])


def _turn(data: np.ndarray, ok: np.ndarray, width: int, gram: int) -> Pieces:
    """Pieces of the windows marked in ``ok``, one for each start in ``data``."""
    hashes = gram_hashes(data, gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least((hashes & ~_PLACE) | places, width - gram + 1)
    at = (least & _PLACE).astype(np.int64)
    edge = np.ones(len(at) + 1, bool)  # between windows of different pieces
    edge[1:-1] = (at[1:] != at[:-1]) | ~ok[1:] | ~ok[:-1]
    first = np.flatnonzero(ok & edge[:-1])
    last = np.flatnonzero(ok & edge[1:])
    return Pieces(first, last - first + 1, at[first], hashes[at[first]])


def pieces(data: np.ndarray, bounds: np.ndarray, width: int, gram: int) -> Pieces:
    """The pieces of texts that lie one after another in ``data``; windows never leave their text."""
    n = len(data) - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Pieces(none, none, none, np.zeros(0, np.uint64))
    ok = np.ones(n, bool)
    tail = np.maximum(bounds[:-1], bounds[1:] - width + 1)
    beyond = take_ranges(tail, bounds[1:] - tail)
    ok[beyond[beyond < n]] = False
    turns = []
    for a in range(0, n, STARTS):
        b = min(a + STARTS, n)
        found = _turn(data[a: b + width - 1], ok[a:b], width, gram)
        turns.append(Pieces(found.first + a, found.n, found.gram + a, found.key))
    return Pieces(*(np.concatenate([getattr(t, f) for t in turns]) for f in ("first", "n", "gram", "key")))
