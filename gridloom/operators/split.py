"""Train/test splits and per-iteration samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = 1 << 32


def key_hash(key: Column | str) -> Column:
    """0 to 2^32 - 1 from the md5 of the key: the same on every engine and rerun. A null key gives 0."""
    digest = F.md5(F.col(key) if isinstance(key, str) else key)
    return F.coalesce(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(0))


def split_by_key(rows: DataFrame, ratio: float, key: Column | str = "key") -> tuple[DataFrame, DataFrame | None]:
    """Train and test rows by key; no test rows (``None``) when the ratio is 1.

    Needs no shuffle and no stored copy: a lost executor recomputes the same rows.
    Rows with the same key stay on one side.
    """
    if ratio >= 1.0:
        return rows, None
    in_train = key_hash(key) < F.lit(float(ratio) * SPAN)
    return rows.where(in_train), rows.where(~in_train)


def split_at_random(rows: DataFrame, ratio: float, seed: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Row-wise random split, as ``randomSplit`` does it."""
    if ratio >= 1.0:
        return rows, None
    train, test = rows.randomSplit([ratio, 1.0 - ratio], seed)
    return train, test


def mini_batch(rows: DataFrame, fraction: float, iteration: int, seed: int = 42,
               key: str | None = None) -> DataFrame:
    """The row sample of one descent iteration; by a hash of ``key`` it does not depend on the partitioning."""
    if fraction >= 1.0:
        return rows
    if key is None:
        return rows.sample(fraction, seed=seed + iteration)
    named = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{iteration}"))
    return rows.where(key_hash(named) < F.lit(float(fraction) * SPAN))
