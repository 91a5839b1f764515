"""HyperMinHash sketches of word-shingle sets."""

from __future__ import annotations

import numpy as np

from gridloom.llm.words import mix

REGISTERS = 256    # a power of two
MANTISSA = 10      # bits kept below the leading zeros
BAND = 5           # registers of a band
BANDS = REGISTERS // BAND

_PROBES = np.random.default_rng(7).integers(0, REGISTERS, (REGISTERS, 64 * REGISTERS), dtype=np.int16)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of the runs of ``width`` words, ascending; fewer words are one run, none are no run."""
    if len(words) == 0:
        return words
    n = max(len(words) - width + 1, 1)
    h = np.full(n, np.uint64(min(width, len(words))), np.uint64)
    for i in range(min(width, len(words))):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[i: i + n])
    return np.unique(h)


def registers(shingles: np.ndarray) -> np.ndarray:
    """One register for each bucket: leading zeros of the bucket's least hash, then its mantissa bits.

    The bucket is the hash's low bits. An empty bucket takes the register of the first
    full one on its own fixed random walk, so that equality of two registers has the
    same chance (the similarity of the sets) whether the sets are large or small.
    """
    bucket = (shingles & np.uint64(REGISTERS - 1)).astype(np.int64)
    rest = shingles >> np.uint64(8)  # 56 bits
    least = np.full(REGISTERS, np.uint64(2**64 - 1), np.uint64)
    np.minimum.at(least, bucket, rest)
    full = least != np.uint64(2**64 - 1)
    value = least[full]
    # float64 rounding may lift a value to the next power of two; frexp of the high bits is exact
    high = (value >> np.uint64(8)).astype(np.float64)
    exponent = np.frexp(high)[1].astype(np.int64)           # bits in use of 48
    zeros = 48 - exponent
    shift = np.maximum(exponent + 8 - 1 - MANTISSA, 0).astype(np.uint64)
    mantissa = (value >> shift) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(REGISTERS, np.uint16)
    out[full] = (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    if not full.all():
        empty = np.flatnonzero(~full)
        at, column = empty, 0
        source = np.empty(REGISTERS, np.int64)
        while len(at):
            if column < _PROBES.shape[1]:
                seen = _PROBES[at, column].astype(np.int64)
            else:  # a fixed walk over all buckets ends the search
                seen = (at + column) % REGISTERS
            hit = full[seen]
            source[at[hit]] = seen[hit]
            at, column = at[~hit], column + 1
        out[empty] = out[source[empty]]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of a sketch (rows: sketches)."""
    used = sketch[..., : BANDS * BAND].astype(np.uint64).reshape(*sketch.shape[:-1], BANDS, BAND)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), used.shape[:-1])
    for i in range(BAND):
        h = mix(h * np.uint64(0xA0761D6478BD642F) + used[..., i])
    return h


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimate: share of equal registers, less the equality of unequal minima.

    Two unequal minima of a bucket share leading zeros with chance 1/3 and the mantissa
    with chance ``2**-MANTISSA``.
    """
    chance = 2.0 ** -MANTISSA / 3
    return np.clip(((a == b).mean(axis=-1) - chance) / (1 - chance), 0, 1)
