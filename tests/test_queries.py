"""Every registered query: against its SQL where there is one, else it must give rows."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle import connect, difference

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SMALL).toPandas()
    if name in ORACLES:
        assert difference(frame, duck.execute(ORACLES[name]).df()) is None
    else:
        assert len(frame) > 0


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["key_id", "rawLabel", "newLabel", "uniqueId"]
    assert frame.count() > 0


@pytest.mark.parametrize("name, rows", [("m12_als", 48), ("b4_als_scoring", 1), ("m12_planted", 1), ("m12_wide_keys", 49)])
def test_the_join_behind_the_ratings_is_done_once(spark, tmp_path, name, rows):
    orders = [(o, o % 8 + 1) for o in range(16)]
    lines = [(o, (o + 3 * i) % 10 + 1, float(i + o % 5 + 1)) for o, _ in orders for i in range(3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    found = QUERIES[name](spark, str(tmp_path))
    # what is scored comes from the stored ratings, not from the tables again
    assert not any("lineitem" in f or "orders" in f for f in found.inputFiles())
    assert found.count() == rows
