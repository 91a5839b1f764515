import pytest
from pyspark.sql import functions as F

from gridloom.functions.categories import category_map, parse_categories, with_categories
from gridloom.functions.columns import bracketed
from gridloom.operators import rows, split
from gridloom.sources import files
from gridloom.sources.sql import run_sql


def test_labelled_points_go_by_position(spark):
    source = spark.sql("SELECT 7 AS a, '1' AS b, 2 AS `x.y`, '3.5' AS x")
    row = rows.labelled_points(source).first()
    assert (row["key"], row["label"], list(row["features"])) == ("7", 1.0, [2.0, 3.5])


def test_null_features_raise_or_are_skipped(spark):
    source = spark.sql("SELECT 1 AS k, 0 AS y, CAST(NULL AS DOUBLE) AS x UNION ALL SELECT 2, 1, 3.0")
    with pytest.raises(Exception):
        rows.labelled_points(source).collect()
    assert [r["key"] for r in rows.labelled_points(source, invalid="skip").collect()] == ["2"]


def test_points_without_label_have_null(spark):
    row = rows.cluster_points(spark.sql("SELECT 'a' AS k, 1.0 AS x, 2.0 AS y"), False).first()
    assert row["label"] is None and list(row["features"]) == [1.0, 2.0]


def test_no_feature_columns(spark):
    with pytest.raises(ValueError):
        rows.labelled_points(spark.sql("SELECT 1 AS k, 1 AS y"))


def test_one_hot_basket_null_is_absent(spark):
    source = spark.sql("SELECT 'r' AS k, '1' AS a, '0' AS b, CAST(NULL AS STRING) AS c, 'x' AS d")
    row = rows.one_hot_baskets(source).select("id", bracketed("items").alias("t")).first()
    assert (row["id"], row["t"]) == ("r", "[1,4]")


def test_text_basket_is_distinct_and_trimmed(spark):
    lines = spark.createDataFrame([("  b a b\t\n",)], "value string")
    assert rows.text_baskets(lines).first()["items"] == ["b", "a"]


def test_generated_document_ids_are_distinct(spark):
    source = spark.range(0, 1000, 1, 7).select(F.lit(1).alias("y"), "id", (F.col("id") * 2).alias("z"))
    documents = rows.document_vectors(source, has_label=True)
    assert documents.select("id").distinct().count() == 1000
    assert documents.first()["features"].size == 2


@pytest.mark.parametrize("spec, wanted", [("0:4,2:3", {0: 4, 2: 3}), ("", {}), ("x", {}), ("0:4,0:5", {0: 5})])
def test_category_specs(spark, spec, wanted):
    assert parse_categories(spec) == wanted
    frame = spark.createDataFrame([(spec,)], "s string")
    assert frame.select(category_map(F.col("s")).alias("m")).first()["m"] == wanted


def test_category_metadata(spark):
    points = rows.labelled_points(spark.sql("SELECT 1 AS k, 1 AS y, 2 AS a, 3 AS b, 1 AS c"))
    attributes = with_categories(points, {0: 4, 2: 3}).schema["features"].metadata["ml_attr"]["attrs"]
    assert [a["idx"] for a in attributes["nominal"]] == [0, 2]
    assert [a["idx"] for a in attributes["numeric"]] == [1]


def test_split_by_key_is_a_partition(spark):
    points = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    train, test = split.split_by_key(points, 0.7)
    assert train.intersect(test).count() == 0
    assert train.count() + test.count() == 5000
    assert 0.66 < train.count() / 5000 < 0.74
    assert split.split_by_key(points, 1.0)[1] is None


def test_random_split_repeats_with_its_seed(spark):
    points = spark.range(2000)
    first = split.split_at_random(points, 0.5, 7)[0].collect()
    assert first == split.split_at_random(points, 0.5, 7)[0].collect()
    assert split.split_at_random(points, 1.0)[1] is None


def test_current_database_resolves_names(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS other")
    spark.sql("CREATE TABLE IF NOT EXISTS other.small USING orc AS SELECT 0.5 AS x")
    assert run_sql(spark, "SELECT x FROM small WHERE x < 0.75", "other").count() == 1
    assert spark.catalog.currentDatabase() == "default"
    with pytest.raises(ValueError):
        run_sql(spark, " ")


def test_text_files(spark, tmp_path):
    (tmp_path / "points.txt").write_text(" 1 2.5 3 \n4 5 6\n")
    found = sorted(r["numbers"] for r in files.read_numbers(spark, str(tmp_path)).collect())
    assert found == [[1.0, 2.5, 3.0], [4.0, 5.0, 6.0]]


def test_libsvm_files(spark, tmp_path):
    (tmp_path / "points.txt").write_text("1 1:2.5 3:1\n0 2:4\n")
    found = {r["label"]: list(r["features"].toArray()) for r in files.read_libsvm(spark, str(tmp_path), 3).collect()}
    assert found == {1.0: [2.5, 0.0, 1.0], 0.0: [0.0, 4.0, 0.0]}


def test_fine_ratios_and_null_keys(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key")).unionByName(
        spark.range(3).select(F.lit(None).cast("string").alias("key")))
    for ratio in (0.9996, 0.0004, 0.5):
        train, test = split.split_by_key(keys, ratio)
        assert train.count() > 0 and test.count() > 0
        assert train.count() + test.count() == 20_003


def test_keyed_batches_do_not_depend_on_the_partitioning(spark):
    keys = spark.range(2000).select(F.col("id").cast("string").alias("key"))
    one = split.mini_batch(keys, 0.3, 2, key="key").collect()
    assert sorted(one) == sorted(split.mini_batch(keys.repartition(7), 0.3, 2, key="key").collect())
    assert sorted(one) != sorted(split.mini_batch(keys, 0.3, 3, key="key").collect()) and 500 < len(one) < 700
