import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.linalg import Vectors

from topicmill.learning import RankingEvaluator
from topicmill.operators import ranking


def brute_force(rows):
    positives = sum(label for _, label in rows)
    if not positives:
        return 0.0
    total = 0.0
    for score in {s for s, _ in rows}:
        above = [label for s, label in rows if s >= score]
        here = sum(label for s, label in rows if s == score)
        total += here / positives * sum(above) / len(above)
    return total


def table(spark, rows):
    full = [(s, float(label), str(i)) for i, (s, label) in enumerate(rows)]
    return spark.createDataFrame(full, "score double, label double, tweet_id string")


ROWS = st.lists(st.tuples(st.sampled_from([-1.5, 0.0, 0.1, 0.25, 0.5, 0.9, 1.0, 7.0]), st.integers(0, 1)), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.sampled_from([1, 2, 5]))
def test_average_precision(spark, rows, buckets):
    found = ranking.average_precision(table(spark, rows), buckets=buckets).first()[0]
    assert found == pytest.approx(brute_force(rows), abs=1e-12)


def test_buckets_do_not_change_running_totals(spark):
    rows = [((i * 7919 % 3001) / 3001, int(i % 11 == 0)) for i in range(3000)]
    one = ranking.threshold_totals(table(spark, rows), buckets=1).orderBy("score").collect()
    many = ranking.threshold_totals(table(spark, rows), buckets=64).orderBy("score").collect()
    assert one == many and len(one) == 3000 - len(rows) + len({s for s, _ in rows})


def test_no_window_holds_all_scores(spark):
    plan = ranking.threshold_totals(table(spark, [(0.1, 1), (0.2, 0), (0.3, 1)]), buckets=2)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("windowspecdefinition(_range") >= 2


def test_top_k_and_ties(spark):
    df = table(spark, [(0.5, 0), (0.9, 1), (0.5, 1), (0.1, 1)])
    assert [r.tweet_id for r in ranking.rank_predictions(df).collect()] == ["1", "0", "2", "3"]
    assert ranking.precision_at_k(df, 2).first()[0] == 0.5
    assert ranking.recall_at_k(df, 3).first()[0] == pytest.approx(2 / 3)
    assert ranking.recall_at_k(df.where("label = 0"), 3).first()[0] == 0.0
    assert ranking.precision_at_k(df.limit(0), 3).first()[0] == 0.0
    plan = ranking.top_k(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_evaluator(spark, tmp_path):
    rows = [(Vectors.dense(1 - p, p), float(p > 0.5), label) for p, label in [(0.9, 1.0), (0.8, 0.0), (0.6, 1.0), (0.2, 0.0)]]
    df = spark.createDataFrame(rows, ["probability", "prediction", "label"])
    assert RankingEvaluator().evaluate(df) == pytest.approx((1 + 2 / 3) / 2)
    assert RankingEvaluator(scoreCol="prediction").evaluate(df) == pytest.approx(2 / 3)
    assert RankingEvaluator(metric="precision_at_k", k=2).evaluate(df) == 0.5
    assert RankingEvaluator(metric="recall_at_k", k=3).evaluate(df) == 1.0
    assert RankingEvaluator().isLargerBetter()
    with pytest.raises(ValueError):
        RankingEvaluator(metric="P100")
    RankingEvaluator(metric="recall_at_k", k=7).save(str(tmp_path / "e"))
    loaded = RankingEvaluator.load(str(tmp_path / "e"))
    assert (loaded.getOrDefault("metric"), loaded.getOrDefault("k")) == ("recall_at_k", 7)
