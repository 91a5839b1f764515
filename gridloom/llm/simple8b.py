"""Simple-8b word-aligned coding of token ids, with escapes and per-block offsets.

Each 64-bit word has a 4-bit selector on top and 60 bits of ids of one width below, the
first id lowest. Blocks hold ``BLOCK`` ids and start at a word of their own, so that a
reader can begin at any block; the last word of a block may hold fewer ids than its
selector allows. An id of more than 60 bits is an escape: a word with selector 0 whose
payload is the id's place in a list beside the words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 1024
# ids in a word and bits of an id by selector: the published table, with 0 for escapes
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 240], np.int64)
WIDTHS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0], np.uint64)
_ORDER = [15, *range(1, 15)]  # selectors by width
_PLACE = {s: i for i, s in enumerate(_ORDER)}
_LIMITS = (np.uint64(1) << WIDTHS[_ORDER]) - np.uint64(1)
_small: np.ndarray | None = None


@dataclass
class Packed:
    n: int
    words: np.ndarray     # uint64
    blocks: np.ndarray    # first word of each block
    escapes: np.ndarray   # uint64


def _kinds(ids: np.ndarray) -> np.ndarray:
    """For each id the place of the least width that holds it, by small widths first."""
    def of(x: np.ndarray) -> np.ndarray:
        return np.searchsorted(_LIMITS, x, side="left").astype(np.uint8)
    global _small
    if _small is None:
        _small = of(np.arange(1 << 16, dtype=np.uint64))
    low = ids < np.uint64(1 << 16)
    if low.all():
        return _small[ids]
    out = np.empty(len(ids), np.uint8)
    out[low] = _small[ids[low]]
    out[~low] = of(ids[~low])
    return out


def _selectors(ids: np.ndarray) -> np.ndarray:
    """For each position the selector that holds most ids from there to its block's end.

    The widest id of the next 1, 2, 3, ... ids comes from the maxima of two shorter runs;
    places behind a block's end count as zeros.
    """
    n = len(ids)
    kinds = np.zeros(-(-n // BLOCK) * BLOCK, np.uint8)
    kinds[:n] = _kinds(ids)
    runs = {1: kinds.reshape(-1, BLOCK)}
    chosen = np.where(runs[1] == len(_LIMITS), 0, 14).astype(np.uint8)
    for count in sorted({*COUNTS[1:].tolist(), 120} - {1}):
        one = max(r for r in runs if r <= count)
        two = min(r for r in runs if r >= count - one)
        widest = runs[one].copy()
        np.maximum(widest[:, : BLOCK - (count - two)], runs[two][:, count - two:],
                   out=widest[:, : BLOCK - (count - two)])
        runs[count] = widest
        for selector in np.flatnonzero(COUNTS == count).tolist():  # none holds 120
            chosen[widest <= _PLACE[selector]] = selector
    return chosen.ravel()[:n].astype(np.int64)


def _starts(taken: np.ndarray, n: int) -> np.ndarray:
    """Positions at which words start: all blocks walk in step, each from its own first id."""
    first = np.arange(0, n, BLOCK, dtype=np.int64)
    stop = np.minimum(first + BLOCK, n)
    begin = np.zeros(n, bool)
    at = first
    while len(at):
        begin[at] = True
        at = at + taken[at]
        live = at < stop
        at, stop = at[live], stop[live]
    return np.flatnonzero(begin)


def pack(ids: np.ndarray) -> Packed:
    """Code ids (unsigned integers of up to 64 bits)."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if n == 0:
        return Packed(0, np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint64))
    chosen = _selectors(ids)
    place = np.arange(n, dtype=np.int64)
    room = np.minimum((place // BLOCK + 1) * BLOCK, n) - place
    taken = np.minimum(COUNTS[chosen], room)
    starts = _starts(taken, n)
    selector = chosen[starts]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in np.unique(selector).tolist():
        mine = np.flatnonzero(selector == s)
        first, have = starts[mine], taken[starts[mine]]
        if s == 0:
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
            continue
        if WIDTHS[s] == 0:
            continue
        for j in range(int(COUNTS[s])):
            held = j < have
            words[mine[held]] |= ids[first[held] + j] << np.uint64(j * int(WIDTHS[s]))
    blocks = np.searchsorted(starts, np.arange(0, n, BLOCK)).astype(np.int32)
    return Packed(n, words, blocks, ids[starts[selector == 0]])


def unpack(packed: Packed, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ids of blocks ``first_block .. last_block - 1``, all words at once."""
    n_blocks = len(packed.blocks)
    last_block = n_blocks if last_block is None else last_block
    if first_block >= last_block:
        return np.zeros(0, np.uint64)
    edges = np.append(packed.blocks, len(packed.words)).astype(np.int64)
    low, high = edges[first_block], edges[last_block]
    words = packed.words[low:high]
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    begin = edges[first_block:last_block] - low
    sizes = np.full(last_block - first_block, BLOCK, np.int64)
    if last_block == n_blocks:
        sizes[-1] = packed.n - (n_blocks - 1) * BLOCK
    final = edges[first_block + 1: last_block + 1] - low - 1
    counts[final] -= np.add.reduceat(counts, begin) - sizes
    which = np.repeat(np.arange(len(words)), counts)
    slot = np.arange(len(which), dtype=np.uint64) - np.repeat(np.cumsum(counts) - counts, counts).astype(np.uint64)
    width = WIDTHS[selector][which]
    mask = (np.uint64(1) << width) - np.uint64(1)
    ids = (words[which] >> (slot * width)) & mask
    escaped = selector[which] == 0
    if escaped.any():
        ids[escaped] = packed.escapes[ids[escaped].astype(np.int64)]
    return ids
