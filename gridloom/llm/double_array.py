"""Double-array tries: BASE and CHECK over dense symbols, built level by level and walked for all keys at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_TRIES = 32  # free slots that a node with several children tries before it goes to the end


@dataclass
class DoubleArray:
    """The child of state ``s`` by symbol ``c`` is ``base[s] + c`` where ``check`` of that slot is ``s``; state 0 is the root."""
    base: np.ndarray
    check: np.ndarray

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children, -1 where there is none."""
        slots = self.base[states] + symbols
        inside = (slots > 0) & (slots < len(self.check))
        return np.where(inside & (self.check[np.where(inside, slots, 0)] == states), slots, -1)


class _Slots:
    def __init__(self, n: int):
        self.base = np.zeros(n, np.int64)
        self.check = np.full(n, -1, np.int64)
        self.check[0] = 0
        self.low, self.end = 1, 1  # the first slot that may be free; all from ``end`` on are

    def _room(self, n: int) -> None:
        if n > len(self.check):
            more = max(n, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def place(self, state: int, symbols: np.ndarray) -> None:
        """Give the children of a state slots; ``symbols`` ascend."""
        span = int(symbols[-1] - symbols[0]) + 1
        while self.low < self.end and self.check[self.low] != -1:
            self.low += 1
        start = self.low
        if len(symbols) > 1:
            away = symbols - symbols[0]
            self._room(self.end + span)
            free = np.flatnonzero(self.check[self.low: self.end] == -1)[:_TRIES] + self.low
            start = next((int(f) for f in free if (self.check[f + away] == -1).all()), self.end)
        self._room(start + span)
        slots = start + (symbols - symbols[0])
        self.check[slots] = state
        self.base[state] = start - symbols[0]
        self.end = max(self.end, int(slots[-1]) + 1)


def build(symbols: np.ndarray, bounds: np.ndarray) -> DoubleArray:
    """The trie of the keys ``symbols[bounds[i]: bounds[i + 1]]``; symbols are dense, from 0."""
    slots = _Slots(len(symbols) + 2)
    lengths = np.diff(bounds)
    rows, states = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
    for depth in range(int(lengths.max(initial=0))):
        go = lengths[rows] > depth
        rows, states = rows[go], states[go]
        taken = symbols[bounds[rows] + depth]
        order = np.lexsort((taken, states))
        s, c = states[order], taken[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
        s, c = s[new], c[new]
        cut = np.append(np.flatnonzero(np.append(True, s[1:] != s[:-1])), len(s))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            slots.place(int(s[a]), c[a:b])
        states = slots.base[states] + taken
    return DoubleArray(slots.base[: slots.end], slots.check[: slots.end])
