import random
import time

import pytest
from pyspark.ml.feature import ChiSqSelector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from topicmill.functions.vectors import vector_entries
from topicmill.learning import ChiSquareTopFeatures
from topicmill.learning.selector import SelectedFeatures
from topicmill.operators.selection import chi_square_scores, top_features


def _vector_schema():
    return StructType([StructField("features", VectorUDT())])


@pytest.fixture(scope="module")
def data(spark):
    draw = random.Random(5)
    rows = []
    for _ in range(300):
        label = float(draw.random() < 0.3)
        values = [draw.choice([0, 0, 1, 2]), draw.choice([0, 1]) * label, draw.choice([0, 0, 0, 5]), 1.0, 0.0]
        rows.append((label, Vectors.sparse(5, [(i, float(v)) for i, v in enumerate(values) if v])))
    return spark.createDataFrame(rows, ["label", "features"]).cache()


def scores_of(df):
    long = df.select("label", F.inline(vector_entries(F.col("features")))).withColumnRenamed("value", "cnt")
    return chi_square_scores(long, df)


def test_scores_equal_chi_square_test(data):
    expected = {r.featureIndex: r for r in ChiSquareTest.test(data, "features", "label", flatten=True).collect()}
    found = {r.idx: r for r in scores_of(data).collect()}
    assert set(found) == {0, 1, 2, 3}  # a feature that is always 0 has no long rows
    for idx, row in found.items():
        assert row.statistic == pytest.approx(expected[idx].statistic, abs=1e-8)
        assert row.dof == expected[idx].degreesOfFreedom


def test_single_label_scores_zero(data):
    only = data.where("label = 1.0")
    assert {(r.statistic, r.dof) for r in scores_of(only).collect()} == {(0.0, 0)}


def test_top_features_ties(spark):
    scores = spark.createDataFrame([(3, 1.0), (1, 2.0), (2, 1.0 + 1e-13), (0, 0.1)], ["idx", "statistic"])
    assert [r.idx for r in top_features(scores, 3).collect()] == [1, 2, 3]


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_p_value_rank_equals_the_built_in_one(data, n):
    built_in = ChiSqSelector(numTopFeatures=n, featuresCol="features", labelCol="label", outputCol="o").fit(data)
    ours = ChiSquareTopFeatures(numTopFeatures=n, rankBy="p_value").fit(data)
    assert ours.getIndices() == sorted(built_in.selectedFeatures)


def test_statistic_rank_takes_many_distinct_values(spark):
    rows = [(float(i % 2), Vectors.dense(float(i), float(i % 2))) for i in range(12_000)]
    df = spark.createDataFrame(rows, ["label", "features"])
    selector = ChiSquareTopFeatures(numTopFeatures=1, rankBy="statistic")
    assert selector.rank(df, 2) == [0, 1]


def test_strong_features_rank_by_strength(spark):
    """All three p-values are 0 in double precision."""
    draw = random.Random(8)
    rows = []
    for _ in range(4000):
        label = float(draw.random() < 0.5)
        noisy = [label if draw.random() < keep else 1 - label for keep in (0.65, 0.8, 0.98)]
        rows.append((label, Vectors.dense(noisy)))
    df = spark.createDataFrame(rows, ["label", "features"])
    assert ChiSquareTopFeatures().rank(df, 3) == [2, 1, 0]
    assert ChiSquareTopFeatures(rankBy="p_value").rank(df, 3) == [2, 1, 0]


def test_selected_vectors(spark):
    rows = [(Vectors.sparse(6, [1, 3, 5], [1.0, 2.0, 3.0]),), (Vectors.dense(1, 2, 0, 4, 5, 6),), (None,), (Vectors.sparse(6, [], []),)]
    df = spark.createDataFrame(rows, _vector_schema())
    found = [r.selected for r in SelectedFeatures(indices=[0, 3, 5]).transform(df).collect()]
    assert found == [Vectors.sparse(3, [1, 2], [2.0, 3.0]), Vectors.sparse(3, [0, 1, 2], [1.0, 4.0, 6.0]), None, Vectors.sparse(3, [], [])]


def test_cost_does_not_grow_with_kept_features(spark):
    draw = random.Random(1)
    rows = [(Vectors.sparse(200_000, sorted((i, 1.0) for i in draw.sample(range(200_000), 30))),) for _ in range(2000)]
    df = spark.createDataFrame(rows, _vector_schema()).repartition(4).cache()
    df.count()

    def seconds(n):
        selected = SelectedFeatures(indices=list(range(n))).transform(df)
        start = time.perf_counter()
        selected.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(100)
    assert seconds(100_000) < 4 * seconds(100) + 1
    df.unpersist()


def test_rank_by_is_checked():
    with pytest.raises(ValueError):
        ChiSquareTopFeatures(rankBy="luck")


def test_columns_nothing_reads_are_pruned(spark, tmp_path):
    rows = [("a", "long text", Vectors.sparse(4, [1, 3], [1.0, 2.0])), ("b", "other text", Vectors.dense([0.0, 0.0, 5.0, 7.0]))]
    spark.createDataFrame(rows, ["tweet_id", "term", "features"]).write.parquet(str(tmp_path / "t"))
    slicer = SelectedFeatures(indices=[2, 3])
    found = slicer.transform(spark.read.parquet(str(tmp_path / "t"))).select("tweet_id", "selected")
    assert {r.tweet_id: r.selected.toArray().tolist() for r in found.collect()} == {"a": [0.0, 2.0], "b": [5.0, 7.0]}
    assert "term" not in found._jdf.queryExecution().executedPlan().toString()
