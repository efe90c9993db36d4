"""One key holds a third of the rows; joins may not broadcast."""

import pytest
from pyspark.sql import functions as F

from topicmill.operators import labelling, splitting
from topicmill.session import stage
from topicmill.sources import topic_tags, topics_from_mapping

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def small_partitions(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


@pytest.fixture
def posts(spark):
    n = F.col("id")
    hot = n % 3 == 0
    return stage(
        spark.range(0, 60_000, numPartitions=16).select(
            n.cast("double").alias("create_time"),
            F.lit("1").alias("from_id"),
            F.lit("u").alias("from_user"),
            F.when(hot, "hot").otherwise(F.concat(F.lit("h"), (n % 50).cast("string"))).alias("hashtag"),
            F.lit("l").alias("location"),
            F.lit("m").alias("mention"),
            F.md5(n.cast("string")).alias("term"),
            F.when(hot, "0").otherwise(n.cast("string")).alias("tweet_id"),
        ),
        "skewed_posts",
    )


def test_label_join_splits_a_hot_id(spark, posts, small_partitions):
    tags = topic_tags(topics_from_mapping(spark, {"t": ["h1", "hot"]}), "t")
    ids = stage(labelling.topical_ids(labelling.explode_hashtags(posts), tags), "ids")
    labelled = labelling.label_with_ids(posts, ids)
    positives, rows = labelled.agg(F.sum("label"), F.count("*")).first()
    expected = posts.where("hashtag in ('h1', 'hot')").count()
    assert (positives, rows) == (expected, 60_000)
    assert "skew=true" in final_plan(labelled)


def test_birthdays_of_a_hot_hashtag(spark, posts, small_partitions):
    tags = topic_tags(topics_from_mapping(spark, {"t": ["h1", "hot"]}), "t")
    birthdays = splitting.hashtag_birthdays(labelling.explode_hashtags(posts), tags)
    assert {tuple(r) for r in birthdays.collect()} == {("hot", 0.0), ("h1", 1.0)}


def test_leakage_guard_with_hot_id_and_hashtag(spark, posts, small_partitions):
    ranked = spark.createDataFrame([("hot", "train"), ("h2", "valid")], "each_hashtag string, split string")
    split = posts.withColumn("split", F.when(F.col("create_time") < 30_000, "valid").otherwise("test"))
    guarded = splitting.without_ids(split, stage(splitting.leaking_ids(split, ranked), "leaking"))
    assert "skew=true" in final_plan(guarded)
    kept = guarded.groupBy("split").count().collect()
    expected = split.where("not (hashtag = 'hot' or (split = 'test' and hashtag = 'h2'))").groupBy("split").count()
    assert {tuple(r) for r in kept} == {tuple(r) for r in expected.collect()}


def test_hot_content_keeps_one_row(posts, small_partitions):
    same = posts.withColumn("term", F.when(F.col("tweet_id") == "0", "copy").otherwise(F.col("term")))
    assert splitting.drop_duplicate_content(same, ["term"]).count() == 40_001
