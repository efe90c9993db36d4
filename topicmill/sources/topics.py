"""The topic dictionary: curated hashtags per topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicmill.schema import TOPIC


def topics_from_mapping(spark: SparkSession, mapping: dict[str, list[str]]) -> DataFrame:
    """`topic -> hashtags` as the table `(topic, hashtag)`, lower-cased.

    Hashtags are matched after tokenising, which lowers them.
    """
    rows = sorted({(topic, tag.lower()) for topic, tags in mapping.items() for tag in tags})
    return spark.createDataFrame(rows, TOPIC)


def topic_tags(topics: DataFrame, topic: str) -> DataFrame:
    """The hashtags of one topic, column `each_hashtag`.

    Repeats do no harm: the hashtags only enter semi joins and sets.
    """
    return topics.where(F.col("topic") == topic).select(F.col("hashtag").alias("each_hashtag"))
