"""Small column expressions shared by the operators."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: what trimming a line removes at both ends (blank and control characters).
WHITESPACE = "".join(chr(code) for code in range(1, 33))


def trimmed(text: Column | str) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def at_least_zero(margin: Column | str) -> Column:
    """Threshold of a margin: 1.0 from zero on, else 0.0."""
    value = F.col(margin) if isinstance(margin, str) else margin
    return F.when(value >= 0, F.lit(1.0)).otherwise(F.lit(0.0))


def squared_distance(left: Sequence[Column], right: Sequence[Column]) -> Column:
    total = None
    for a, b in zip(left, right):
        term = (a - b) * (a - b)
        total = term if total is None else total + term
    return total


# Products of up to this many factors are written out, which stays in generated code.
WRITTEN_OUT = 120


def dot(x: Column, weights: Sequence[float], start: float = 0.0, limit: int = WRITTEN_OUT) -> Column:
    """``start`` plus the product of an ``array<double>`` column with fixed weights."""
    if len(weights) <= limit:
        total = F.lit(0.0)
        for i, w in enumerate(weights):
            total = total + x[i] * F.lit(float(w))
        return total + F.lit(float(start))
    products = F.zip_with(x, F.lit([float(w) for w in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(float(start)), lambda total, p: total + p)


def gaussian_similarity(distance_squared: Column) -> Column:
    return F.exp(-distance_squared / F.lit(2.0))


def bracketed(items: Column | str) -> Column:
    """Items rendered ``[a,b]``."""
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def grid_id(job_id: str, index: int) -> str:
    return f"{job_id}_{index}"


def now_millis() -> str:
    return str(int(time.time() * 1000))
