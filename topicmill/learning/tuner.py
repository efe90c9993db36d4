"""Grid search with leave-one-fold-out training and a fixed validation set."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from topicmill.constants import GRID_MAX_ITER, GRID_NUM_TOP_FEATURES, GRID_REG_PARAM
from topicmill.functions.hashing import fold_of
from topicmill.learning.selector import ChiSquareTopFeatures

METRICS_SCHEMA = "param_id int, params string, fold int, metric double"


def default_grid(
    selector,
    classifier,
    num_top_features: Sequence[int] = GRID_NUM_TOP_FEATURES,
    reg_param: Sequence[float] = GRID_REG_PARAM,
    max_iter: Sequence[int] = GRID_MAX_ITER,
) -> list[dict]:
    return (
        ParamGridBuilder()
        .addGrid(selector.numTopFeatures, list(num_top_features))
        .addGrid(classifier.regParam, list(reg_param))
        .addGrid(classifier.maxIter, list(max_iter))
        .build()
    )


def summarise(metrics: DataFrame) -> DataFrame:
    """Mean and spread of the metric per parameter set."""
    return metrics.groupBy("param_id", "params").agg(
        F.avg("metric").alias("avg_metric"),
        F.coalesce(F.stddev_samp("metric"), F.lit(0.0)).alias("std_metric"),
        F.count("*").alias("folds"),
    )


def best_params(summary: DataFrame, larger_is_better: bool = True) -> DataFrame:
    """The best parameter set; of equal ones the first in the grid."""
    if larger_is_better:
        best = F.max_by("param_id", F.struct("avg_metric", -F.col("param_id")))
    else:
        best = F.min_by("param_id", F.struct("avg_metric", "param_id"))
    return summary.agg(best.alias("param_id"))


class FixedValidationTuner(CrossValidator):
    """Tunes on rows of type `train`, always scoring on the rows of type `valid`.

    For each of `numFolds` folds the model is fitted on the training rows
    outside the fold and evaluated on all validation rows. The best parameter
    set is fitted again on train and valid together.

    The grid shares work: chi-square ranks are computed once per fold for all
    numbers of features, the sliced rows are kept while the classifiers that
    read them are fitted, and `parallelism` fits run at the same time.

    With `logPath`, each metric is appended to that table as soon as it is
    measured, and metrics found there are not measured again: a run that broke off
    goes on where it was. Use one path per training set.
    """

    typeCol = Param(Params._dummy(), "typeCol", "column with train and valid", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "id the folds are drawn from", TypeConverters.toString)
    logPath = Param(Params._dummy(), "logPath", "table that metrics are appended to", TypeConverters.toString)

    def __init__(self, *, typeCol="type", idCol="tweet_id", logPath="", **kwargs):
        super().__init__(**kwargs)
        self._setDefault(typeCol="type", idCol="tweet_id", logPath="")
        self._set(typeCol=typeCol, idCol=idCol, logPath=logPath)
        self.metrics: list[tuple] = []
        self._writing = Lock()

    def _known(self, spark) -> dict[tuple[str, int], float]:
        """Metrics in the log, by setting and fold."""
        path = self.getOrDefault(self.logPath)
        if not path:
            return {}
        # Reading with a schema: a log that isn't there yet has no rows.
        try:
            rows = spark.read.schema(METRICS_SCHEMA).parquet(path).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {(r.params, r.fold): r.metric for r in rows}

    def _record(self, spark, row: tuple) -> None:
        self.metrics.append(row)
        if path := self.getOrDefault(self.logPath):
            with self._writing:
                spark.createDataFrame([row], METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(path)

    def _rows(self, dataset: DataFrame, kind: str) -> DataFrame:
        return dataset.where(F.col(self.getOrDefault(self.typeCol)) == kind)

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        grid = self.getOrDefault(self.estimatorParamMaps)
        folds = self.getOrDefault(self.numFolds)
        estimator, evaluator = self.getOrDefault(self.estimator), self.getOrDefault(self.evaluator)
        id_col = F.col(self.getOrDefault(self.idCol))
        fold = fold_of(id_col, folds, self.getOrDefault(self.seed) or 0)
        train = self._rows(dataset, "train").withColumn("_fold", fold).persist(StorageLevel.MEMORY_AND_DISK)
        valid = self._rows(dataset, "valid").persist(StorageLevel.MEMORY_AND_DISK)
        known = self._known(dataset.sparkSession)
        named = [_describe(g) for g in grid]
        self.metrics = [(j, n, i, known[n, i]) for j, n in enumerate(named) for i in range(folds) if (n, i) in known]
        try:
            for i in range(folds):
                todo = [j for j, n in enumerate(named) if (n, i) not in known]
                if todo:
                    outside = train.where(F.col("_fold") != i)
                    self._fold_metrics(estimator, evaluator, grid, i, todo, outside, valid)
        finally:
            train.unpersist()
            valid.unpersist()

        self.metrics.sort(key=lambda row: (row[2], row[0]))
        averages = [sum(m for j, _, _, m in self.metrics if j == p) / folds for p in range(len(grid))]
        pick = max if evaluator.isLargerBetter() else min
        best = averages.index(pick(averages))
        model = estimator.fit(dataset, grid[best])
        return self._copyValues(CrossValidatorModel(model, averages))

    def metrics_table(self, spark) -> DataFrame:
        """`(param_id, params, fold, metric)` of the last fit, one row per model."""
        return spark.createDataFrame(self.metrics, METRICS_SCHEMA)

    def _fold_metrics(self, estimator, evaluator, grid, fold, todo, train, valid) -> None:
        groups = _selection_groups(estimator, grid, todo)
        if groups is None:
            self._run(estimator, evaluator, grid, fold, todo, train, valid)
            return
        selector, rest = estimator.getStages()[0], estimator.getStages()[1:]
        most = max(groups)
        ranked = selector.rank(train, most)
        for num_top, members in groups.items():
            slicer = selector.copy({selector.numTopFeatures: num_top}).slicer(ranked)
            sliced_train = slicer.transform(train).persist(StorageLevel.MEMORY_AND_DISK)
            sliced_valid = slicer.transform(valid).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                tail = Pipeline(stages=rest)
                self._run(tail, evaluator, grid, fold, members, sliced_train, sliced_valid)
            finally:
                sliced_train.unpersist()
                sliced_valid.unpersist()

    def _run(self, estimator, evaluator, grid, fold, members, train, valid) -> None:
        def measure(j: int) -> None:
            model: Transformer | PipelineModel = estimator.fit(train, grid[j])
            metric = evaluator.evaluate(model.transform(valid, grid[j]))
            self._record(train.sparkSession, (j, _describe(grid[j]), fold, float(metric)))

        workers = max(1, min(self.getParallelism(), len(members)))
        with ThreadPool(workers) as pool:
            pool.map(inheritable_thread_target(train.sparkSession)(measure), members)


def _selection_groups(estimator, grid, todo) -> dict[int, list[int]] | None:
    """Grid positions of `todo` per number of features, if the first stage selects them.

    None if the estimator starts otherwise, or the grid varies another
    parameter of the selector.
    """
    if not isinstance(estimator, Pipeline) or not isinstance(estimator.getStages()[0], ChiSquareTopFeatures):
        return None
    selector = estimator.getStages()[0]
    groups: dict[int, list[int]] = {}
    for j in todo:
        params = grid[j]
        own = {p.name: v for p, v in params.items() if p.parent == selector.uid}
        if set(own) - {"numTopFeatures"}:
            return None
        num_top = own.get("numTopFeatures", selector.getOrDefault(selector.numTopFeatures))
        groups.setdefault(num_top, []).append(j)
    return groups


def _describe(params: dict) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda item: item[0].name))
