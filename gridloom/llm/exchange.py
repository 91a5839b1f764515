"""Exchange clustering of symbols into classes that keep most of the bigrams' mutual information."""

from __future__ import annotations

import numpy as np


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def information(table: np.ndarray) -> float:
    """Likelihood of the class bigrams ``table``, up to terms that no clustering changes."""
    return float(_f(table).sum() - _f(table.sum(0)).sum() - _f(table.sum(1)).sum())


def exchange(pairs: np.ndarray, n_classes: int, fixed: int, rounds: int = 10, start: np.ndarray | None = None,
             held: int | None = None) -> np.ndarray:
    """The class of each symbol from the table ``pairs[left, right]`` of bigram counts.

    Symbol ``fixed`` keeps class ``n_classes`` for itself. The others start dealt by
    frequency, or from the classes ``start``, and move, one after another, to the class that
    raises the likelihood of the class bigrams most, until a round moves none. Symbols from
    ``held`` on keep the classes of ``start``.
    """
    n = len(pairs)
    pairs = pairs.astype(np.float64)
    weight = pairs.sum(0) + pairs.sum(1)
    free = [int(s) for s in np.argsort(-weight, kind="stable")
            if s != fixed and weight[s] > 0 and (held is None or s < held)]
    classes = np.zeros(n, np.int64) if start is None else start.astype(np.int64)
    classes[fixed] = n_classes
    if start is None:
        for i, s in enumerate(free):
            classes[s] = i % n_classes
    size = n_classes + 1
    member = np.zeros((n, size))
    member[np.arange(n), classes] = 1.0
    table = member.T @ pairs @ member
    own = np.arange(n_classes)
    for _ in range(rounds):
        moved = 0
        for s in free:
            old = classes[s]
            out = np.bincount(classes, pairs[s], size)
            into = np.bincount(classes, pairs[:, s], size)
            self_count = pairs[s, s]
            out[old] -= self_count
            into[old] -= self_count
            table[old] -= out
            table[:, old] -= into
            table[old, old] -= self_count
            rows = _f(table + out) - _f(table)                 # row b gains `out`
            columns = _f(table + into[:, None]) - _f(table)    # column b gains `into`
            cross = np.diagonal(table)[:n_classes]
            gain = (rows.sum(1)[:n_classes] - rows[own, own] + columns.sum(0)[:n_classes] - columns[own, own]
                    + _f(cross + out[:n_classes] + into[:n_classes] + self_count) - _f(cross))
            # the symbol is still a neighbour of all classes, wherever it goes
            left, right = (table.sum(1) + into)[:n_classes], (table.sum(0) + out)[:n_classes]
            gain -= _f(left + out.sum() + self_count) - _f(left)
            gain -= _f(right + into.sum() + self_count) - _f(right)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9 * abs(gain[old]):
                new = int(old)
            table[new] += out
            table[:, new] += into
            table[new, new] += self_count
            classes[s] = new
            moved += new != old
        if not moved:
            break
    return classes
