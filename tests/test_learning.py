import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import functions as F

from topicmill.functions import fold_of
from topicmill.learning import (
    ChiSquareTopFeatures,
    FixedValidationTuner,
    RankingEvaluator,
    best_params,
    default_grid,
    readable_predictions,
    score_rows,
    summarise,
)
from topicmill.learning.tuner import METRICS_SCHEMA
from topicmill.sources import write_model


@pytest.fixture(scope="module")
def combined(spark):
    draw = random.Random(11)
    rows = []
    for i in range(160):
        label = float(draw.random() < 0.4)
        hits = {j: float(draw.randint(1, 2)) for j in range(12) if draw.random() < 0.3}
        if draw.random() < 0.8:
            hits[0 if label else 1] = 1.0
        rows.append((str(i), Vectors.sparse(12, hits), label, "valid" if i % 4 == 0 else "train"))
    return spark.createDataFrame(rows, ["tweet_id", "features", "label", "type"]).cache()


@pytest.fixture(scope="module")
def tuned(combined):
    selector, lr = ChiSquareTopFeatures(), LogisticRegression(featuresCol="selected")
    tuner = FixedValidationTuner(
        estimator=Pipeline(stages=[selector, lr]),
        estimatorParamMaps=default_grid(selector, lr, [1, 4], [0.01, 1.0], [5]),
        evaluator=RankingEvaluator(idCol="tweet_id"),
        numFolds=2,
        parallelism=2,
        seed=7,
    )
    return tuner, tuner.fit(combined)


def test_default_grid_is_the_full_one():
    selector, lr = ChiSquareTopFeatures(), LogisticRegression()
    assert len(default_grid(selector, lr)) == 80


def test_shared_ranks_give_the_metrics_of_plain_fits(combined, tuned):
    tuner, _ = tuned
    train, valid = combined.where("type = 'train'"), combined.where("type = 'valid'")
    train = train.withColumn("fold", fold_of(F.col("tweet_id"), 2, 7))
    grid = tuner.getEstimatorParamMaps()
    measured = {(j, fold): m for j, _, fold, m in tuner.metrics}
    assert len(measured) == 8
    for j, fold in [(0, 0), (3, 1)]:
        model = tuner.getEstimator().fit(train.where(F.col("fold") != fold), grid[j])
        assert measured[j, fold] == pytest.approx(tuner.getEvaluator().evaluate(model.transform(valid)), abs=1e-9)


def test_best_model_is_refit_on_everything(spark, combined, tuned, tmp_path):
    tuner, model = tuned
    summary = summarise(tuner.metrics_table(spark))
    best = best_params(summary).first()[0]
    assert model.avgMetrics[best] == max(model.avgMetrics)
    averages = {r.param_id: r.avg_metric for r in summary.collect()}
    assert [averages[j] for j in range(4)] == pytest.approx(model.avgMetrics)
    refit = tuner.getEstimator().fit(combined, tuner.getEstimatorParamMaps()[best])
    assert refit.stages[1].coefficients.toArray() == pytest.approx(model.bestModel.stages[1].coefficients.toArray())

    write_model(model, str(tmp_path / "cv"))
    again = CrossValidatorModel.load(str(tmp_path / "cv"))
    assert again.avgMetrics == pytest.approx(model.avgMetrics)
    predictions = again.transform(combined)
    # A ranking by chance has the share of positives as its average precision.
    chance = combined.agg(F.avg("label")).first()[0]
    assert predictions.count() == 160 and RankingEvaluator().evaluate(predictions) > chance


def test_inputs_are_released(spark, tuned, combined):
    persisted = spark.sparkContext._jsc.getPersistentRDDs()
    assert len(persisted) <= 2  # the module fixtures only


def test_other_estimators_run_plainly(combined):
    lr = LogisticRegression(maxIter=3)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.1, 1.0]).build()
    tuner = FixedValidationTuner(estimator=lr, estimatorParamMaps=grid, evaluator=RankingEvaluator(), numFolds=2)
    assert len(tuner.fit(combined).avgMetrics) == 2


def test_best_params_ties(spark):
    rows = [(0, "a", 0, 0.5), (1, "b", 0, 0.5), (2, "c", 0, 0.1), (2, "c", 1, 0.3)]
    summary = summarise(spark.createDataFrame(rows, METRICS_SCHEMA))
    assert best_params(summary).first()[0] == 0
    assert best_params(summary, larger_is_better=False).first()[0] == 2
    two = {r.param_id: (r.avg_metric, r.std_metric, r.folds) for r in summary.collect()}
    assert two[2] == pytest.approx((0.2, 0.02**0.5, 2)) and two[0] == (0.5, 0.0, 1)


def test_readable_predictions(spark, make_posts):
    posts = make_posts([(1, 0, "a", "x"), (2, 0, "b", "y"), (3, 0, "c", "z")])
    rows = [(str(i), Vectors.dense(1 - p, p), 1.0, 0.0) for i, p in [(1, 0.2), (2, 0.9), (3, 0.2)]]
    raw = spark.createDataFrame(rows, ["tweet_id", "probability", "label", "prediction"])
    found = readable_predictions(score_rows(raw, "tweet_id", "label", "prediction"), posts).collect()
    assert [(r.tweet_id, r.term, r.score) for r in found] == [("2", "y", 0.9), ("1", "x", 0.2), ("3", "z", 0.2)]
