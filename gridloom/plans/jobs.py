"""Job runners: training over a grid, frequent patterns, batch scoring."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.columns import grid_id, now_millis
from gridloom.operators import cluster, metrics, patterns, relabel, topics
from gridloom.operators import rows as shapes
from gridloom.operators.recommend import split_ratings
from gridloom.operators.scoring import score
from gridloom.operators.split import split_at_random, split_by_key
from gridloom.plans.algorithms import (
    ALGORITHMS, CLUSTERED, FP_GROWTH, FP_GROWTH_DEFAULTS, ISOTONIC, RATED, Algorithm, Params, truth)
from gridloom.plans.grid import best_message, grid_points, point_message
from gridloom.sinks import tables
from gridloom.sources import control
from gridloom.sources.files import read_lines
from gridloom.sources.models import load_model
from gridloom.sources.sql import run_sql

METRIC_SCHEMA = "job string, idx int, metric string, value double, params map<string,string>"


@dataclass
class PointResult:
    index: int
    params: Params
    model: Any
    metric: str | None = None
    value: float | None = None
    model_path: str | None = None


@dataclass
class JobResult:
    job_id: str
    points: list[PointResult] = field(default_factory=list)
    best: int | None = None
    messages: list[str] = field(default_factory=list)

    @property
    def best_model_path(self) -> str | None:
        """Where the best point's model was saved; the registry's newest is the last point's."""
        return None if self.best is None else self.points[self.best].model_path

    def metrics(self, spark: SparkSession) -> DataFrame:
        """``job, idx, metric, value, params`` of the evaluated points."""
        found = [(self.job_id, p.index, p.metric, p.value, p.params)
                 for p in self.points if p.value is not None]
        return spark.createDataFrame(found, METRIC_SCHEMA)


def _first(params: Params, *keys: str) -> str:
    return next((params[k] for k in keys if params.get(k)), "")


def training_input(spark: SparkSession, params: Params, database: str | None = None) -> DataFrame:
    """Rows of the job's SQL text, or of its blank-separated text files."""
    path = _first(params, "path")
    if path:
        lines = read_lines(spark, path)
        # every field of the widest line; shorter lines have nulls, which training reports
        width = lines.agg(F.max(F.size("fields"))).first()[0] or 1
        return lines.select(*[F.get("fields", F.lit(i)).alias(f"c{i}") for i in range(width)])
    text = _first(params, "data", "rdd", "sql")
    if not text:
        raise ValueError("the job has neither a SQL text nor a path")
    return run_sql(spark, text, database)


def _shaped(source: DataFrame, algorithm: Algorithm, params: Params) -> DataFrame:
    """Rows as the algorithm takes them; ``handleinvalid`` says whether a null feature is an error or skips the row."""
    invalid = params.get("handleinvalid", "error")
    if algorithm.shape == CLUSTERED:
        return shapes.cluster_points(source, truth(params["haslabel"]), invalid)
    if algorithm.shape == ISOTONIC:
        return shapes.first_feature_points(source)
    if algorithm.shape == RATED:
        return shapes.keyed_ratings(source)
    return shapes.labelled_points(source, invalid)


def _measure(algorithm: Algorithm, scored: DataFrame) -> tuple[str, float | None]:
    if algorithm.metric == "F_measure":
        return "F_measure", metrics.accuracy(scored).first()[0]
    if algorithm.metric == "RMSE":
        return "RMSE", metrics.root_mean_squared_error(scored, "rate").first()[0]
    return "MSE", metrics.mean_squared_error(scored).first()[0]


def _cluster_quality(model) -> tuple[str, float]:
    """Without labels: log-likelihood of a mixture, else the cost of the clusters."""
    if hasattr(model.summary, "logLikelihood"):
        return "logLikelihood", float(model.summary.logLikelihood)
    return "MSE", float(model.summary.trainingCost)


def train_job(spark: SparkSession, job_id: str, algorithm_id: int, params: Params,
              database: str | None = None, information: str | None = tables.TRAIN_INFORMATION,
              registry: str = tables.MODEL_PATHS, seed: int | None = None,
              split_key: str | None = None, partitions: int | None = None,
              parallelism: int = 1) -> JobResult:
    """Train every grid point, measure it on the test rows, keep predictions and models.

    ``split_key`` splits by the hash of that column instead of at random;
    ``partitions`` spreads a source of too few splits; ``parallelism`` grid points
    are trained at a time, which fills a cluster when one fit does not. Tables are written only
    where the parameters name one (``saveresult``, ``savemodel``); ``information``
    takes the messages.
    """
    algorithm = ALGORITHMS[int(algorithm_id)]
    params = {**algorithm.defaults, **params}
    points = grid_points(params, algorithm.grid)
    started = now_millis()
    data = _shaped(training_input(spark, params, database), algorithm, params)
    if partitions:
        data = data.repartition(partitions)
    rated = algorithm.shape == RATED
    ratio = 1.0 if algorithm.shape == CLUSTERED else float(params.get("ratio", "1.0"))
    # Rows are stored when several passes read them, and for a random split, whose
    # two sides must come from the same copy. A split by key needs no copy.
    if not algorithm.reads_once or (ratio < 1.0 and not split_key and not rated):
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    if rated:  # every user keeps a rating in training
        train, test = split_ratings(data, ratio)
    elif split_key:
        train, test = split_by_key(data, ratio, split_key)
    else:
        train, test = split_at_random(data, ratio, seed)
    if test is not None and not data.is_cached and len(points) > 1:
        test = test.persist(StorageLevel.MEMORY_AND_DISK)
    if algorithm.shape == CLUSTERED:
        test = data
    elif rated and test is None and truth(params["hastest"]):
        test = data  # without held-out ratings the measure is taken on those of the training

    result = JobResult(job_id)
    target = _first(params, "saveresult")
    base = _first(params, "savemodel", "savepath")
    try:
        models = algorithm.fit_grid(train, points, parallelism)
        for index, (point, model) in enumerate(zip(points, models)):
            entry = PointResult(index, point, model)
            if test is not None:
                _evaluate(algorithm, entry, test, job_id, target, started, database)
            entry.model_path = tables.save_model(
                spark, model, base, job_id, algorithm.app_name, registry, database)
            result.points.append(entry)
    finally:
        for stored in (data, test):
            if stored is not None and stored.is_cached:
                stored.unpersist()
    _report(spark, result, algorithm, information, started, database)
    if result.best_model_path:
        tables.register(spark, result.best_model_path, job_id, algorithm.app_name, now_millis(),
                        registry + tables.BEST_SUFFIX, database)
    return result


def _evaluate(algorithm: Algorithm, entry: PointResult, test: DataFrame, job_id: str, target: str,
              started: str, database: str | None) -> None:
    scored = score(entry.model, test)
    relabels = algorithm.shape == CLUSTERED and truth(entry.params["haslabel"])
    if target or relabels:  # read by more than the measure
        scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    unique_id = grid_id(job_id, entry.index) if algorithm.grid else job_id
    try:
        if algorithm.shape == RATED:
            entry.metric, entry.value = _measure(algorithm, scored)
            tables.append(tables.rating_predictions(scored, unique_id, started), target, database)
            return
        shown = scored
        if relabels:
            shown = relabel.relabel(scored, int(entry.params["k"]))
            shown = shown.withColumn("prediction", F.col("newLabel"))
        if algorithm.shape == CLUSTERED and not relabels:
            entry.metric, entry.value = _cluster_quality(entry.model)
        else:
            entry.metric, entry.value = _measure(algorithm, shown)
        tables.append(tables.prediction_and_label(shown, unique_id, started), target, database)
    finally:
        if scored.is_cached:
            scored.unpersist()


def _report(spark: SparkSession, result: JobResult, algorithm: Algorithm, information: str | None,
            started: str, database: str | None) -> None:
    measured = [p for p in result.points if p.value is not None]
    if not measured:
        return
    metric = measured[0].metric
    larger = metric in ("F_measure", "logLikelihood")
    result.messages = [
        point_message(p.index, [(name, p.params[key]) for name, key in algorithm.shown],
                      algorithm.point_metric(p.metric), p.value) for p in measured]
    result.best, value = _best(measured, metric, larger)
    if len(result.points) > 1:
        result.messages.append(best_message(
            algorithm.app_name, result.job_id, result.best, "max" if larger else "min", metric, value))
    if information:
        messages = tables.train_information(spark, result.job_id, result.messages, started)
        tables.append(messages.coalesce(1), information, database)


def _best(measured: list[PointResult], metric: str, larger: bool) -> tuple[int, float]:
    """First strictly best point, from the start value on."""
    start = metrics.START_ACCURACY if larger else metrics.START_ERROR
    best, value = 0, float("-inf") if metric == "logLikelihood" else start
    for point in measured:
        if (point.value > value) if larger else (point.value < value):
            best, value = point.index, point.value
    return best, value


def pattern_job(spark: SparkSession, job_id: str, params: Params,
                database: str | None = None) -> dict[str, DataFrame]:
    """FP-growth on one-hot rows for every support; appends ``<name>_items`` or ``<name>_rules``.

    Results go from the executors to the table; nothing is gathered on the driver.
    """
    params = {**FP_GROWTH_DEFAULTS, **params}
    output = params["output"].lower()
    if output not in ("items", "rules"):
        raise ValueError('output must be "Items" or "Rules"')
    baskets = shapes.one_hot_baskets(training_input(spark, params, database)).persist(
        StorageLevel.MEMORY_AND_DISK)
    target = _first(params, "saveresult")
    written: dict[str, DataFrame] = {}
    try:
        for support in [s.strip() for s in params["minsupport"].split(",")]:
            model = patterns.mine_itemsets(baskets, float(support), float(params["minconfidence"]),
                                           int(params["numpartitions"]))
            stamp = now_millis()
            if output == "items":
                rows = tables.item_rows(patterns.itemsets(model), job_id, float(support), stamp)
            else:
                rows = tables.rule_rows(patterns.rules(model), job_id, float(support), stamp)
            if target:
                tables.append(rows, f"{target}_{output}", database)
            written[support] = rows
    finally:
        baskets.unpersist()
    return written


# Defaults of the jobs that have no algorithm id.
TEXT_PATTERN_DEFAULTS = {"minsupport": "0.5", "numpartitions": "3", "minconfidence": "0.0"}
TOPIC_DEFAULTS = {"numclusters": "3", "haslabel": "false", "optimizer": "em"}
GRAPH_DEFAULTS = {"numclusters": "3", "iterations": "50", "modetype": "random"}


def text_pattern_job(spark: SparkSession, params: Params,
                     database: str | None = None) -> tuple[DataFrame, DataFrame]:
    """FP-growth on blank-separated lines (files, or the columns of a SQL text): itemsets, rules."""
    params = {**TEXT_PATTERN_DEFAULTS, **params}
    if _first(params, "path"):
        lines = spark.read.text(params["path"])
    else:
        source = training_input(spark, params, database)
        lines = source.select(F.concat_ws(" ", *source.columns).alias("value"))
    model = patterns.mine_itemsets(shapes.text_baskets(lines), float(params["minsupport"]),
                                   float(params["minconfidence"]), int(params["numpartitions"]))
    return patterns.itemsets(model), patterns.rules(model)


def topic_job(spark: SparkSession, params: Params, database: str | None = None) -> DataFrame:
    """Topics of term-count rows as ``topic, term, weight``; the model goes to ``savepath``."""
    params = {**TOPIC_DEFAULTS, **params}
    documents = shapes.document_vectors(training_input(spark, params, database), truth(params["haslabel"]))
    model = topics.train_topics(documents, int(params["numclusters"]), optimizer=params["optimizer"])
    if _first(params, "savepath"):
        model.save(f"{params['savepath'].rstrip('/')}/{now_millis()}")
    return topics.topic_terms(model)


def graph_job(spark: SparkSession, params: Params, database: str | None = None) -> DataFrame:
    """Clusters ``id, cluster`` of the edges ``src, dst, weight`` of a SQL text."""
    params = {**GRAPH_DEFAULTS, **params}
    edges = training_input(spark, params, database).toDF("src", "dst", "weight").select(
        F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"),
        F.col("weight").cast("double").alias("weight"))
    assigned = cluster.power_iteration(edges, int(params["numclusters"]), int(params["iterations"]),
                                       params["modetype"])
    if _first(params, "savepath"):
        tables.append(assigned, f"{params['savepath'].rstrip('/')}/{now_millis()}")
    return assigned


def score_job(spark: SparkSession, job_id: str, algorithm_id: int | str, model_path: str, text: str,
              target: str = "", dbtype: str = "hive", database: str | None = None,
              invalid: str = "error") -> DataFrame:
    """Predictions of a saved model for the rows of a SQL text, appended to the target table.

    Rating models take ``user, item`` rows with keys of any type; the key is then ``user`` and the item
    stays in its own column. With ``invalid="skip"`` rows with a null feature get no prediction row.
    """
    if dbtype.strip().lower() != "hive":
        raise ValueError(f"database {dbtype} is not supported")
    model = load_model(algorithm_id, model_path)
    source = run_sql(spark, text, database)
    if int(algorithm_id) == 12:
        pairs = source.toDF("user", "item", *source.columns[2:]).select("user", "item")
        scored = score(model, pairs).withColumnRenamed("user", "key")
        out = tables.prediction_only(scored, job_id, now_millis(), "item")
    else:
        out = tables.prediction_only(score(model, shapes.scoring_points(source, invalid)), job_id, now_millis())
    tables.append(out, target, database)
    return out


# Type and name of the dictionary entry that holds the database of all jobs.
DATABASE_ENTRY = ("DAO_API", "DAO_API_SCHEMA")


@dataclass
class ControlTables:
    """Catalog names of the control tables (fixed values)."""

    details: str = "ml_algorithm_detail"
    key_names: str = "sys_ml_algorithm_config"
    jobs: str = "ml_algorithm_main"
    scoring: str = "ml_batchalgorithm_main"
    dictionary: str = "sys_dic_info"
    paths: str = tables.MODEL_PATHS
    runs: str = tables.JOB_RUNS


def job_database(spark: SparkSession, names: ControlTables, database: str | None) -> str | None:
    """The database given, else the one the dictionary names, else none (the session's current one)."""
    if database or not spark.catalog.tableExists(names.dictionary):
        return database
    return control.dictionary_value(spark.table(names.dictionary), *DATABASE_ENTRY) or None


def run_training(spark: SparkSession, argument: str, control_tables: ControlTables | None = None,
                 database: str | None = None, **options):
    """Run the training job named by ``configName@2@jobID`` from its control tables."""
    names = control_tables or ControlTables()
    database = job_database(spark, names, database)
    job_id = argument.split("@2@")[-1]
    jobs = spark.table(names.jobs)
    params = control.job_parameters(spark.table(names.details), spark.table(names.key_names), jobs, job_id)
    algorithm = control.algorithm_id(jobs, control.first_job(job_id))
    if not algorithm:
        raise ValueError(f"job {job_id} is not in {names.jobs}")
    app_name = "FP_Growth" if int(algorithm) == FP_GROWTH else ALGORITHMS[int(algorithm)].app_name
    tables.record_run(spark, control.first_job(job_id), app_name, names.runs, database)
    if int(algorithm) == FP_GROWTH:
        return pattern_job(spark, job_id, params, database)
    return train_job(spark, job_id, int(algorithm), params, database, registry=names.paths, **options)


def run_scoring(spark: SparkSession, job_id: str, control_tables: ControlTables | None = None,
                database: str | None = None, which: str = "newest") -> DataFrame:
    """Run a scoring job from its row: a model of its training job on its SQL text.

    ``which`` is ``newest`` (the last point of the last grid) or ``best`` (the best point of the last
    grid that was measured).
    """
    if which not in ("newest", "best"):
        raise ValueError('which must be "newest" or "best"')
    names = control_tables or ControlTables()
    database = job_database(spark, names, database)
    registry = names.paths + (tables.BEST_SUFFIX if which == "best" else "")
    job = control.scoring_job(spark.table(names.scoring), job_id)
    model_job = job.get("muuid", "")
    path = control.model_path(spark.table(tables.qualified(registry, database)), model_job)
    if not path:
        raise ValueError(f"no model is registered for job {model_job!r}")
    tables.record_run(spark, control.first_job(job_id), "Prediction", names.runs, database)
    return score_job(spark, job_id, control.algorithm_id(spark.table(names.jobs), model_job), path,
                     job.get("sql", ""), job.get("tablename", ""), job.get("dbtype", "hive"), database)
