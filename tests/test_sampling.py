import pytest
from pyspark.sql import functions as F

from topicmill.functions import uniform_from_id
from topicmill.operators.sampling import stratified_sample, with_folds


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(4000).select(
        F.col("id").cast("string").alias("tweet_id"), (F.col("id") % 3).cast("double").alias("label")
    )


def test_uniform(rows):
    u = rows.select(uniform_from_id(F.col("tweet_id")).alias("u"))
    low, high, mean = u.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.02


def test_sample_does_not_depend_on_partitions(rows):
    fractions = {0.0: 0.1, 1.0: 1.0}
    first = {r.tweet_id for r in stratified_sample(rows, fractions).collect()}
    second = {r.tweet_id for r in stratified_sample(rows.repartition(13, "label"), fractions).collect()}
    assert first == second
    assert first != {r.tweet_id for r in stratified_sample(rows, fractions, seed=1).collect()}


def test_sample_shares(rows):
    counts = dict(
        tuple(r) for r in stratified_sample(rows, {0.0: 0.1, 1.0: 1.0}).groupBy("label").count().collect()
    )
    assert counts[1.0] == 1333 and 2.0 not in counts
    assert 90 < counts[0.0] < 180


def test_folds_cover_all_rows(rows):
    sizes = dict(tuple(r) for r in with_folds(rows, 5).groupBy("fold").count().collect())
    assert sorted(sizes) == [0, 1, 2, 3, 4] and sum(sizes.values()) == 4000
    assert all(700 < n < 900 for n in sizes.values())
