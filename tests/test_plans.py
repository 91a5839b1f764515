"""What the plans must look like at any size."""

import pytest

import __spark_entry__ as entry
from gridloom.operators import metrics, relabel
from gridloom.operators.pairs import similar_pairs
from gridloom.sources.sql import register_tables


@pytest.fixture
def plan(capsys):
    def text(frame):
        capsys.readouterr()
        frame.explain("formatted")
        return capsys.readouterr().out
    return text


def test_filter_and_columns_reach_the_scan(spark, folder, plan):
    text = plan(entry.queries()["s1_filter_project"](spark, folder))
    assert "GreaterThanOrEqual(l_discount,0.05)" in text and "EqualTo(l_returnflag,R)" in text
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "l_comment" not in schema and "l_tax" not in schema


@pytest.mark.parametrize("name", ["f1_labelled_point", "f5_one_hot_basket", "p1_split", "b3_kmeans_scoring"])
def test_row_shapes_need_no_shuffle_of_their_own(spark, folder, plan, name):
    text = plan(entry.queries()[name](spark, folder))
    assert text.count("Exchange") <= (4 if name == "f5_one_hot_basket" else 0)
    assert "Python" not in text


@pytest.mark.parametrize("name", [
    "j1_parameter_join", "s5_parameter_maps", "j2_rating_prediction", "j3_similar_pairs",
    "k9_cluster_report", "b9_relabelled_output", "m18_rules_from_itemsets"])
def test_no_cartesian_product(spark, folder, plan, name):
    text = plan(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_similar_pairs_join_on_the_cell(spark, folder, plan):
    register_tables(spark, folder, ["part"])
    points = spark.table("part").selectExpr("p_partkey AS id", "p_size AS x", "p_retailprice AS y")
    text = plan(similar_pairs(points, "id", ["x", "y"], 0.5))
    assert "Join" in text and "NestedLoop" not in text


def test_relabel_ranks_before_its_shuffle(spark, folder, plan):
    from pyspark.sql import Window, functions as F
    register_tables(spark, folder, ["lineitem"])
    table = metrics.contingency(spark.table("lineitem"), "l_partkey", "l_linenumber")
    rank = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("cnt"), "label"))
    assert "WindowGroupLimit" in plan(table.withColumn("rank", rank).where("rank <= 3"))
    assert len(relabel.relabel_map(table, 7)) == 7
