"""Words of whole Arrow batches as byte positions and 64-bit hashes, without a Python step per word."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20  # text handled at once; one longer text is a slice of its own
_SEGMENT = 1 << 20
_STEP = 0x9E3779B97F4A7C15 | 1

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
NOT_ALNUM[65:91] = False  # A-Z are folded to a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_VALUES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return memory that is no longer used to the machine: Python workers live on from batch to batch and task to task."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get("up")
    if have is None or len(have) < n:
        n = max(n, _SEGMENT + 1)
        for name, base in (("up", _STEP), ("down", pow(_STEP, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, end row, bytes, offsets`` of runs of rows; a null text has no bytes."""
    texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    wide = np.dtype(np.int64 if pa.types.is_large_string(texts.type) else np.int32)
    offsets = np.frombuffer(texts.buffers()[1], wide)[texts.offset: texts.offset + n + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte start and end of every word; words end at separators and at text bounds."""
    inside = ~separator[data]
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    cuts = bounds[:-1]
    cuts = cuts[(cuts < len(data))]
    begin[cuts] = inside[cuts]
    cuts = cuts[cuts > 0] - 1
    finish[cuts] = inside[cuts]
    return np.flatnonzero(begin), np.flatnonzero(finish) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = LOWER,
                window: int = _SEGMENT) -> np.ndarray:
    """64-bit hash of each word's folded bytes, alike in every batch and on every machine.

    ``window`` bytes are summed at once; the sums of few stay in a core's cache.
    """
    out = np.empty(len(starts), np.uint64)
    values = _VALUES[fold]
    at = 0
    while at < len(starts):
        stop = int(np.searchsorted(ends, starts[at] + window, side="right"))
        stop = max(stop, at + 1)
        low, high = int(starts[at]), int(ends[stop - 1])
        up, down = _power_tables(high - low + 1)
        sums = np.empty(high - low + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = stop
    return out


def rows_of(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The first word of each row: ``len(bounds)`` positions into the words."""
    return np.searchsorted(starts, bounds)


def take_ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions ``first[i] .. first[i] + length[i] - 1`` of all ``i``, one after another."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(length) - length
    return np.repeat(first - before, length) + np.arange(total, dtype=np.int64)
