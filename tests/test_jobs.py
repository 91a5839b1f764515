"""Whole jobs from control tables to result tables."""

import pytest
from pyspark.sql import functions as F

from gridloom.plans import jobs
from gridloom.plans.algorithms import ALGORITHMS
from gridloom.plans.grid import best_message, grid_points, point_message
from gridloom.sinks import tables
from gridloom.sources.models import load_model

# job id -> algorithm id, parameters
JOBS = {
    "svm": (1, {"data": "SELECT * FROM points", "ratio": "0.7", "step": "1,0.5", "regparam": "0.01",
                "iterations": "5", "saveresult": "svm_out", "savemodel": "{base}/svm"}),
    "logit": (2, {"data": "SELECT * FROM points", "ratio": "0.7", "saveresult": "logit_out"}),
    "bayes": (3, {"data": "SELECT * FROM points", "savemodel": "{base}/bayes", "ratio": "1.0"}),
    "iso": (11, {"data": "SELECT k, a AS y, b FROM points", "ratio": "0.7", "saveresult": "iso_out",
                 "savemodel": "{base}/iso"}),
    "als": (12, {"sql": "SELECT u, i, r FROM rated", "rank": "2,3", "iterations": "3",
                 "saveresult": "als_out", "savepath": "{base}/als"}),
    "kmeans": (13, {"rdd": "SELECT * FROM points", "haslabel": "true", "k": "2,3", "runs": "1",
                    "saveresult": "kmeans_out", "savemodel": "{base}/kmeans"}),
    "mixture": (14, {"rdd": "SELECT k, a, b FROM points", "k": "2"}),
    "bisect": (15, {"rdd": "SELECT k, a, b FROM points", "k": "2", "savemodel": "{base}/bisect",
                    "saveresult": "bisect_out"}),
    "fp": (16, {"data": "SELECT id, c1, c2, c3 FROM flags", "minsupport": "0.2,0.5", "output": "Rules",
                "minconfidence": "0.5", "saveresult": "fp_out"}),
}
SCORING = {
    "score-svm": ("SELECT k, a, b FROM points", "svm"),
    "score-iso": ("SELECT k, b FROM points", "iso"),
    "score-als": ("SELECT u, i FROM rated", "als"),
    "score-kmeans": ("SELECT k, a, b FROM points", "kmeans"),
    "score-bisect": ("SELECT k, a, b FROM points", "bisect"),
}


@pytest.fixture(scope="module")
def control(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("models"))
    spark.sql("""CREATE TABLE points USING orc AS
        SELECT id AS k, id % 2 AS y, id % 2 * 3 + id % 5 / 10 AS a, 2.0 + id % 7 / 10 - id % 2 AS b
        FROM range(300)""")
    spark.sql("CREATE TABLE rated USING orc AS SELECT id % 10 AS u, id DIV 10 AS i, id % 5 + 1 AS r FROM range(60)")
    spark.sql("""CREATE TABLE flags USING orc AS SELECT CAST(id AS STRING) AS id, '1' AS c1,
        CAST(id % 2 AS STRING) AS c2, CAST(id % 4 AS STRING) AS c3 FROM range(40)""")
    keys = sorted({key for _, params in JOBS.values() for key in params})
    spark.createDataFrame(list(enumerate(keys)), "ID int, KEY_NAME string").write.saveAsTable("sys_ml_algorithm_config")
    main = [(n, job, str(algorithm), "") for n, (job, (algorithm, _)) in enumerate(JOBS.items())]
    spark.createDataFrame(main, "ID int, UUID string, AL_ID string, APPLICATION_ID string").write.saveAsTable(
        "ml_algorithm_main")
    detail = [(n, keys.index(key), value.format(base=base))
              for n, (_, params) in enumerate(JOBS.values()) for key, value in params.items()]
    spark.createDataFrame(detail, "MODEL_ID int, KEY_ID int, KEY_VALUE string").write.saveAsTable("ml_algorithm_detail")
    scoring = [(job, text, model, "hive", job.replace("-", "_")) for job, (text, model) in SCORING.items()]
    spark.createDataFrame(scoring, "uuid string, select_table string, model_uuid string, output_param string, "
                          "output_table string").write.saveAsTable("ml_batchalgorithm_main")
    return {job: jobs.run_training(spark, f"conf@2@{job}", seed=3) for job in JOBS}


def test_grid_job_writes_predictions_messages_and_models(spark, control):
    result = control["svm"]
    assert [p.params["step"] for p in result.points] == ["1", "0.5"]
    out = spark.table("svm_out")
    assert out.columns == ["key_id", "rawLabel", "newLabel", "uniqueId", "timestamp"]
    assert {r[0] for r in out.select("uniqueId").distinct().collect()} == {"svm_0", "svm_1"}
    messages = [r["message"] for r in spark.table("train_information").where("key_id = 'svm'").collect()]
    assert len(messages) == 3
    assert sum("the best result is got by" in m for m in messages) == 1
    assert any(m.startswith("number: 0, iterations: 5, step: 1, regParam: 0.01") for m in messages)
    assert spark.table("mode_save_path").where("jobId = 'svm'").count() == 2
    assert result.points[result.best].value == max(p.value for p in result.points) > 0.9


def test_no_split_means_no_measure(control):
    assert control["bayes"].messages == [] and control["bayes"].best is None
    assert control["bayes"].points[0].model_path


def test_bare_job_id_without_a_grid(spark, control):
    assert {r[0] for r in spark.table("iso_out").select("uniqueId").distinct().collect()} == {"iso"}


def test_labelled_clusters_are_relabelled(spark, control):
    assert control["kmeans"].best == 0 and control["kmeans"].points[0].value == 1.0
    first = spark.table("kmeans_out").where("uniqueId = 'kmeans_0'")
    assert first.where("rawLabel <> newLabel").count() == 0


def test_unlabelled_clusters_have_a_measure_and_no_label(spark, control):
    assert control["mixture"].points[0].metric == "logLikelihood"
    assert control["bisect"].points[0].metric == "MSE"
    assert {r[0] for r in spark.table("bisect_out").select("rawLabel").distinct().collect()} == {-1.0}


def test_rating_job(spark, control):
    assert control["als"].points[0].metric == "RMSE"
    assert set(spark.table("als_out").columns) == {"user", "item", "rate", "prediction", "uniqueId", "timestamp"}
    packed = tables.rating_predictions_packed(spark.table("als_out"), "0")
    assert packed.columns == ["key_id", "rawLabel", "newLabel", "uniqueId", "timestamp"]


def test_pattern_job_writes_rules_of_every_support(spark, control):
    out = spark.table("fp_out_rules")
    assert {r[0] for r in out.select("min_support").distinct().collect()} == {0.2, 0.5}
    assert out.where("antecedent = '[2]' AND consequent = '[1]' AND confidence = 1.0").count() == 2


@pytest.mark.parametrize("job", sorted(SCORING))
def test_scoring_job(spark, control, job):
    jobs.run_scoring(spark, job)
    out = spark.table(job.replace("-", "_"))
    wanted = 60 if job == "score-als" else 300
    assert out.count() == wanted
    assert {"key_id", "predictLabel", "uniqueId", "timestamp"} <= set(out.columns)
    assert out.where(F.col("predictLabel").isNull()).count() == 0


def test_scored_labels_are_zero_or_one(spark, control):
    jobs.run_scoring(spark, "score-svm")
    assert {r[0] for r in spark.table("score_svm").select("predictLabel").distinct().collect()} == {0.0, 1.0}


def test_best_model_is_registered_and_scores(spark, control):
    best = spark.table("mode_save_path_best")
    for job, result in control.items():
        if getattr(result, "best_model_path", None):
            assert best.where((F.col("jobId") == job) & (F.col("savePath") == result.best_model_path)).count() == 1
    jobs.run_scoring(spark, "score-svm", which="best")
    with pytest.raises(ValueError):
        jobs.run_scoring(spark, "score-svm", which="any")


def test_ragged_lines_keep_every_field(spark, tmp_path):
    (tmp_path / "a.txt").write_text("a 1\nb 1 2 3 4\nc\n")
    rows = jobs.training_input(spark, {"path": str(tmp_path)}).orderBy("c0").collect()
    assert [tuple(r) for r in rows] == [("a", "1", None, None, None), ("b", "1", "2", "3", "4"),
                                        ("c", None, None, None, None)]


def test_database_from_the_dictionary(spark):
    names = jobs.ControlTables(dictionary="dic_for_test")
    assert jobs.job_database(spark, names, None) is None
    spark.createDataFrame([(*jobs.DATABASE_ENTRY, "warehouse_db")],
                          "PARENT_DIC_TYPE string, DIC_NAME string, dic_value string") \
        .write.mode("overwrite").saveAsTable("dic_for_test")
    assert jobs.job_database(spark, names, None) == "warehouse_db"
    assert jobs.job_database(spark, names, "given") == "given"


def test_names_of_measures_in_messages():
    from gridloom.plans.algorithms import ALGORITHMS
    shown = {i: ALGORITHMS[i].point_metric(ALGORITHMS[i].metric) for i in (1, 2, 3, 4, 5, 6, 7, 11, 12, 13)}
    assert shown == {1: "F_measure", 2: "F_measure", 3: "F_measure", 4: "f_measure", 5: "f_measure", 6: "f_measure",
                     7: "mse", 11: "mse", 12: "rmse", 13: "F_measure"}


def test_runs_are_recorded(spark, control):
    current = {r["jobId"]: r["appId"] for r in tables.current_runs(spark.table("applicationID")).collect()}
    assert current["svm"] == spark.sparkContext.applicationId and set(JOBS) <= set(current)


def test_unknown_ids_and_jobs_raise(spark, control):
    for bad in (0, 16, 99, ""):
        with pytest.raises(ValueError):
            load_model(bad, "/none")
    with pytest.raises(ValueError):
        jobs.run_training(spark, "conf@2@nothing")
    with pytest.raises(ValueError):
        jobs.run_scoring(spark, "nothing")
    with pytest.raises(ValueError):
        jobs.score_job(spark, "s", 3, "/none", "SELECT 1", dbtype="oracle")
    with pytest.raises(ValueError):
        jobs.train_job(spark, "x", 3, {})


def test_text_file_input(spark, tmp_path):
    (tmp_path / "points.txt").write_text("".join(f"{i} {i % 2} {i % 2 + 1} 2\n" for i in range(50)))
    result = jobs.train_job(spark, "p", 4, {"path": str(tmp_path), "ratio": "0.6"}, information=None, split_key="key")
    assert result.points[0].value == 1.0


def test_grid_points_trained_side_by_side(spark, control):
    params = {"data": "SELECT * FROM points", "ratio": "0.7", "maxdepth": "1,2,3"}
    options = {"information": None, "split_key": "key"}
    serial = jobs.train_job(spark, "t", 4, params, **options)
    side_by_side = jobs.train_job(spark, "t", 4, params, parallelism=3, **options)
    assert [p.value for p in serial.points] == [p.value for p in side_by_side.points]
    assert [p.model.depth for p in serial.points] == [p.model.depth for p in side_by_side.points]


def test_jobs_without_an_id(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("a b\na b c\nc\n")
    itemsets, rules = jobs.text_pattern_job(spark, {"path": str(tmp_path / "lines.txt"), "minconfidence": "0.9"})
    assert {tuple(r["items"]): r["freq"] for r in itemsets.collect()} == {
        ("a",): 2, ("b",): 2, ("c",): 2, ("a", "b"): 2}
    assert rules.count() == 2
    text = "SELECT id % 2 * 5 AS a, (id + 1) % 2 * 5 AS b FROM range(20)"
    terms = jobs.topic_job(spark, {"sql": text, "numclusters": "2", "savepath": str(tmp_path / "lda")})
    assert terms.count() == 4
    edges = "SELECT id AS src, id + 1 AS dst, 1.0 AS weight FROM range(12)"
    assert jobs.graph_job(spark, {"sql": edges, "numclusters": "2", "iterations": "5"}).count() == 13


def test_grid_order_and_messages():
    points = grid_points({"a": "1,2", "b": "x, y", "c": "0"}, ("a", "b"))
    assert [(p["a"], p["b"]) for p in points] == [("1", "x"), ("1", "y"), ("2", "x"), ("2", "y")]
    assert point_message(0, [("k", "3")], "MSE", 1.5) == "number: 0, k: 3, MSE: 1.5"
    assert best_message("SVM", "j", 2, "max", "F_measure", 0.5) == (
        "In SVM job j, the best result is got by 2-th group parameters, and the max F_measure is 0.5")


def test_sink_names(spark):
    assert tables.qualified("t", "db") == "db.t"
    assert tables.qualified("x.t", "db") == "x.t"
    assert tables.qualified("t", " ") == "t"
    assert tables.append(spark.range(1), " ") is None


def test_every_grid_key_has_a_default():
    for algorithm in ALGORITHMS.values():
        assert set(algorithm.grid) <= set(algorithm.defaults)
        assert {key for _, key in algorithm.shown} <= set(algorithm.defaults)
