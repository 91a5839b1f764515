"""Categorical feature specs such as ``0:4,2:3`` and their column metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def category_map(spec: Column | str) -> Column:
    """``"i:n,j:m"`` as ``map<int,int>``; entries without a colon are left out, the last one counts."""
    def add(known: Column, entry: Column) -> Column:
        index, arity = (F.split(entry, ":")[i].cast("int") for i in (0, 1))
        others = F.map_filter(known, lambda key, _: key != index)
        return F.when(entry.contains(":"), F.map_concat(others, F.create_map(index, arity))).otherwise(known)

    return F.aggregate(F.split(spec, ","), F.create_map().cast("map<int,int>"), add)


def parse_categories(spec: str | None) -> dict[int, int]:
    """The same for one job parameter."""
    pairs = [entry.split(":") for entry in (spec or "").split(",") if ":" in entry]
    return {int(pair[0]): int(pair[1]) for pair in pairs}


def feature_width(rows: DataFrame, features: str = "features") -> int:
    """Number of features, from the column metadata or else from one row."""
    known = rows.schema[features].metadata.get("ml_attr", {}).get("num_attrs")
    return known or rows.select(features).first()[0].size


def with_categories(rows: DataFrame, categories: dict[int, int],
                    features: str = "features") -> DataFrame:
    """Mark features as categorical (index -> arity) for the tree learners."""
    if not categories:
        return rows
    width = feature_width(rows, features)
    attributes = {
        "numeric": [{"idx": i} for i in range(width) if i not in categories],
        "nominal": [{"idx": i, "num_vals": n} for i, n in sorted(categories.items())],
    }
    metadata = {"ml_attr": {"attrs": {k: v for k, v in attributes.items() if v},
                            "num_attrs": width}}
    return rows.withMetadata(features, metadata)


def with_class_count(rows: DataFrame, num_classes: int, label: str = "label") -> DataFrame:
    """State the number of classes so that learners need no pass to find it."""
    return rows.withMetadata(label, {"ml_attr": {"type": "nominal", "num_vals": num_classes}})
