"""Rows of a SQL text, by position, as points, baskets, ratings and documents."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.columns import trimmed
from gridloom.session import ensure_checkpoint_dir

NO_LABEL = -1.0  # fixed value: the label written for rows that have none


def _key() -> Column:
    return F.col("c0").cast("string").alias("key")


def _positional(rows: DataFrame) -> DataFrame:
    return rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])


def _assemble(rows: DataFrame, lead: list[Column], first: int, invalid: str) -> DataFrame:
    plain = _positional(rows)
    names = plain.columns[first:]
    if not names:
        raise ValueError("the query returns no feature columns")
    typed = plain.select(*lead, *[F.col(n).cast("double").alias(n) for n in names])
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid=invalid)
    return assembler.transform(typed).drop(*names)


def labelled_points(rows: DataFrame, invalid: str = "error") -> DataFrame:
    """``key string, label double, features vector`` from key, label, features...

    Null features raise, or are left out with ``invalid="skip"``.
    """
    return _assemble(rows, [_key(), F.col("c1").cast("double").alias("label")], 2, invalid)


def cluster_points(rows: DataFrame, has_label: bool, invalid: str = "error") -> DataFrame:
    """The same; without labels the label is null and features start at column 1."""
    if has_label:
        return labelled_points(rows, invalid)
    return _assemble(rows, [_key(), F.lit(None).cast("double").alias("label")], 1, invalid)


def scoring_points(rows: DataFrame, invalid: str = "error") -> DataFrame:
    """``key, features`` from key, features..."""
    return _assemble(rows, [_key()], 1, invalid)


def label_first_points(rows: DataFrame, invalid: str = "error") -> DataFrame:
    """``label, features`` from label, features... (no key)."""
    return _assemble(rows, [F.col("c0").cast("double").alias("label")], 1, invalid)


def first_feature_points(rows: DataFrame) -> DataFrame:
    """``key, label, feature, weight`` for isotonic regression: only the first feature."""
    plain = _positional(rows)
    return plain.select(
        _key(), F.col("c1").cast("double").alias("label"),
        F.col("c2").cast("double").alias("feature"), F.lit(1.0).alias("weight"))


def one_hot_baskets(rows: DataFrame) -> DataFrame:
    """``id, items``: item *i* is in the basket when column *i* is not the text ``0``.

    Null counts as absent. A basket has at most as many items as the query columns.
    """
    plain = _positional(rows)
    present = [F.when(F.col(f"c{i}").cast("string") != "0", F.lit(str(i)))
               for i in range(1, len(plain.columns))]
    items = F.filter(F.array(*present), lambda item: item.isNotNull())
    return plain.select(F.col("c0").cast("string").alias("id"), items.alias("items"))


def text_baskets(lines: DataFrame, text: str = "value", *keep: str) -> DataFrame:
    """``items``: the distinct blank-separated words of every trimmed line."""
    return lines.select(*keep, F.array_distinct(F.split(trimmed(text), " ")).alias("items"))


def ratings(rows: DataFrame) -> DataFrame:
    """``user int, item int, rate double`` from three columns."""
    plain = _positional(rows)
    return plain.select(F.col("c0").cast("int").alias("user"), F.col("c1").cast("int").alias("item"),
                        F.col("c2").cast("double").alias("rate"))


def keyed_ratings(rows: DataFrame) -> DataFrame:
    """``user, item, rate double`` from three columns; users and items keep their type, so any key will do."""
    plain = _positional(rows)
    return plain.select(F.col("c0").alias("user"), F.col("c1").alias("item"), F.col("c2").cast("double").alias("rate"))


def user_items(rated: DataFrame) -> DataFrame:
    return rated.select("user", "item")


def document_vectors(rows: DataFrame, has_label: bool = False, has_key: bool = False) -> DataFrame:
    """``id, features`` (term counts); a leading label is dropped.

    A real key is kept as the id. Generated ids are checkpointed at once: they
    depend on the physical row order, which a recomputed partition may not keep.
    """
    plain = _positional(rows)
    first = int(has_label) + int(has_key)
    if has_key:
        return _assemble(rows, [F.col("c0").alias("id")], first, "error")
    ensure_checkpoint_dir(rows.sparkSession)
    numbered = plain.select(F.monotonically_increasing_id().alias("id"),
                            *plain.columns[int(has_label):]).checkpoint()
    return _assemble(numbered, [F.col("c0").alias("id")], 1, "error")
