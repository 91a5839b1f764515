"""Registration, shared feature texts and helpers of the registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.session import shared_dir, stored
from gridloom.sources.sql import register_tables, run_sql, spread_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, uses: str = "lineitem"):
    """Register ``fn(spark)``; the tables it ``uses`` are known to SQL texts when it runs."""
    def register(fn: Callable[[SparkSession], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            register_tables(spark, folder, uses.split())
            return fn(spark)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder for a table a query writes and reads."""
    return f"{shared_dir(spark)}/gridloom/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, for rows with a join behind them that are read many times."""
    return stored(rows, name)


def spread(vector: str, names: list[str]) -> list[Column]:
    """A vector column as named double columns."""
    return [vector_to_array(vector)[i].alias(n) for i, n in enumerate(names)]


def rounded(*names: str, digits: int = 6) -> list[Column]:
    return [F.round(n, digits).alias(n) for n in names]


def training(spark: SparkSession, text: str, table: str = "lineitem") -> DataFrame:
    """Rows of a text over one table, for trainers that pass over them many times."""
    return spread_out(run_sql(spark, text), table)


def sql(spark: SparkSession, text: str) -> DataFrame:
    return run_sql(spark, text)


# Feature texts: the same words run on Spark and on the checking engine.
LINE_POINTS = """
SELECT l_orderkey AS k, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
       l_quantity / 50 AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2
FROM lineitem"""

# A label that depends on the features, for the learners that have to find it.
SIGNAL_POINTS = """
SELECT l_orderkey AS k,
       CASE WHEN l_quantity / 50 + l_discount * 2 - l_tax * 2 > 0.6 THEN 1 ELSE 0 END AS y,
       l_quantity / 50 AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2
FROM lineitem"""

# A numeric target that depends on the features.
TARGET_POINTS = """
SELECT l_orderkey AS k, l_quantity * (1 - l_discount) / 50 + l_tax AS y,
       l_quantity / 50 AS x0, l_discount * 10 AS x1, l_tax * 10 AS x2
FROM lineitem"""

# Plane points with a label of six values.
PART_POINTS = """
SELECT p_partkey AS k,
       CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'SMALL' THEN 1 WHEN 'STANDARD' THEN 2
                   WHEN 'LARGE' THEN 3 WHEN 'MEDIUM' THEN 4 ELSE 5 END AS y,
       p_size / 10 AS x0, p_retailprice / 20 - 45 AS x1
FROM part"""

PART_CENTRES = [[0.5, 0.5], [2.0, 4.0], [3.0, 1.0], [4.5, 4.5]]

# Term counts per user for the topic model.
USER_COUNTS = """
SELECT user_id AS k,
       sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS x0,
       sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS x1,
       sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS x2,
       sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS x3,
       sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS x4
FROM events GROUP BY user_id"""

RATINGS = """
SELECT o_custkey AS u, l_partkey AS i, avg(l_quantity) AS r
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey"""

# One-hot rows: an order and what occurs in its lines, "0" where it does not.
ORDER_FLAGS = """
SELECT CAST(l_orderkey AS STRING) AS k,
       CAST(max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS STRING) AS c1,
       CAST(max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS STRING) AS c2,
       CAST(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS STRING) AS c3,
       CAST(max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS STRING) AS c4,
       CAST(max(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS STRING) AS c5,
       CAST(max(CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END) AS STRING) AS c6,
       CAST(max(CASE WHEN l_tax <= 0.01 THEN 1 ELSE 0 END) AS STRING) AS c7,
       CAST(max(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS STRING) AS c8
FROM lineitem GROUP BY l_orderkey"""


def nearest_sql(source: str, centres: list[list[float]]) -> str:
    """``k, y, x0, x1, cluster, cost`` of the nearest centre for plane points."""
    distances = [f"(x0 - {a}) * (x0 - {a}) + (x1 - {b}) * (x1 - {b})" for a, b in centres]
    costs = ", ".join(f"CAST({d} AS DOUBLE) AS d{i}" for i, d in enumerate(distances))
    least = "least(" + ", ".join(f"d{i}" for i in range(len(centres))) + ")"
    cases = " ".join(f"WHEN d{i} = {least} THEN {i}" for i in range(len(centres)))
    return (f"SELECT k, y, x0, x1, CAST(CASE {cases} END AS DOUBLE) AS cluster, {least} AS cost "
            f"FROM (SELECT *, {costs} FROM ({source}) AS p) AS q")
