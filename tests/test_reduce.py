import numpy as np
import pytest

from gridloom.operators import isotonic, recommend, reduce, rows, topics

MATRIX = [(0, 1, 0, 7, 0), (2, 0, 3, 4, 5), (4, 0, 0, 6, 7)]


@pytest.fixture(scope="module")
def matrix(spark):
    table = [(str(i), *map(float, r)) for i, r in enumerate(MATRIX)]
    return rows.scoring_points(spark.createDataFrame(table))


def test_singular_values_and_reconstruction(matrix):
    found = reduce.singular_values(matrix, 5, rcond=1e-7)
    assert found.values == pytest.approx([13.029276, 5.368579, 2.533050], abs=1e-6)
    u = np.array([r["u"].toArray() for r in found.u.orderBy("key").collect()])
    assert np.allclose(u.T @ u, np.eye(3), atol=1e-9)
    assert np.allclose(u @ np.diag(found.values) @ found.v.T, np.array(MATRIX), atol=1e-9)


def test_components_and_label(spark):
    table = [("a", 0, 1, 0, 0, 0, 1), ("b", 1, 1, 1, 0, 1, 0), ("c", 1, 1, 1, 0, 0, 0),
             ("d", 0, 1, 0, 0, 0, 0), ("e", 1, 1, 1, 0, 0, 0)]
    points = rows.labelled_points(spark.createDataFrame(table))
    model = reduce.fit_components(points, 2)
    assert model.explained == pytest.approx([0.651252, 0.223638], abs=1e-6)
    reduced = reduce.project_features(points, 2)
    assert reduced.columns == ["key", "label", "features"]
    assert {r["key"]: r["label"] for r in reduced.collect()} == {r[0]: float(r[1]) for r in table}


def test_isotonic_is_monotone_and_honours_direction(spark):
    table = [(str(i), float(v), float(i)) for i, v in enumerate([1, 3, 2, 4, 3.5, 6])]
    points = rows.first_feature_points(spark.createDataFrame(table))
    up = isotonic.train_isotonic(points)
    fitted = [r["prediction"] for r in up.transform(points.orderBy("feature")).collect()]
    assert fitted == sorted(fitted)
    assert fitted == pytest.approx([1, 2.5, 2.5, 3.75, 3.75, 6])
    down = isotonic.train_isotonic(points, increasing=False)
    fitted = [r["prediction"] for r in down.transform(points.orderBy("feature")).collect()]
    assert fitted == sorted(fitted, reverse=True)


def test_isotonic_interpolates_between_boundaries(spark):
    points = rows.first_feature_points(spark.createDataFrame([("a", 1.0, 1.0), ("b", 3.0, 3.0)]))
    between = spark.createDataFrame([(2.0,)], "feature double")
    assert isotonic.train_isotonic(points).transform(between).first()["prediction"] == pytest.approx(2.0)


def test_als_recovers_two_groups(spark):
    rated = [(u, i, 5.0 if (u <= 2) == (i % 2 == 1) else 1.0) for u in range(1, 5) for i in range(1, 5)]
    frame = spark.createDataFrame(rated, "user int, item int, rate double")
    model = recommend.train_als(frame, rank=10, iterations=20, reg=0.01)
    for row in recommend.score_ratings(model, frame).collect():
        assert abs(row["prediction"] - row["rate"]) < 0.05


def test_repeated_pairs_multiply_in_the_prediction_join(spark):
    rated = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0)], "user int, item int, rate double")
    predicted = spark.createDataFrame([(1, 1, 2.5), (1, 1, 2.5)], "user int, item int, prediction double")
    assert recommend.join_predictions(rated, predicted).count() == 4


def test_topics_share_out_the_counts(spark):
    table = [(i, 9.0, 0.0, 1.0) if i % 2 else (i, 0.0, 8.0, 1.0) for i in range(20)]
    documents = rows.document_vectors(spark.createDataFrame(table), has_key=True)
    model = topics.train_topics(documents, k=2, iterations=10)
    totals = {r["term"]: r["w"] for r in topics.topic_terms(model).groupBy("term").agg({"weight": "sum"})
              .withColumnRenamed("sum(weight)", "w").collect()}
    assert totals == pytest.approx({0: 90.0, 1: 80.0, 2: 20.0}, abs=1e-6)
    online = topics.train_topics(documents, k=2, iterations=5, optimizer="online")
    assert topics.topic_terms(online).count() == 6
