"""All topics of the dictionary in one pass: labels, periods, splits, guard.

The dictionary `(topic, hashtag)` is a curated list. Its periods are ranked per
topic; the posts are then read once for all topics together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicmill.constants import TRAIN_SHARE, VALID_SHARE
from topicmill.functions.text import tokens
from topicmill.operators.labelling import MOST_LISTED, explode_hashtags


def topic_birthdays(posts: DataFrame, topics: DataFrame) -> DataFrame:
    """`(topic, each_hashtag, birthday)`: first use of each topic's hashtags.

    Posts are grouped by hashtag first, which combines on the map side; only one
    row per hashtag meets the dictionary, so a hashtag of many topics is counted once.
    """
    wanted = topics.select(F.col("hashtag").alias("each_hashtag")).distinct()
    used = explode_hashtags(posts).join(wanted, "each_hashtag", "left_semi")
    first = used.groupBy("each_hashtag").agg(F.min("create_time").alias("birthday"))
    names = topics.select("topic", F.col("hashtag").alias("each_hashtag")).distinct()
    return names.join(first, "each_hashtag").select("topic", "each_hashtag", "birthday")


def topic_periods(birthdays: DataFrame, train_share: float = TRAIN_SHARE, valid_share: float = VALID_SHARE) -> DataFrame:
    """`split_hashtags` of every topic: `tag_rank`, `n_tags` and `split` within it."""
    topic = Window.partitionBy("topic")
    ranked = birthdays.withColumns(
        {
            "tag_rank": F.row_number().over(topic.orderBy("birthday", "each_hashtag")) - 1,
            "n_tags": F.count("*").over(topic),
        }
    )
    split = (
        F.when(F.col("tag_rank") < F.floor(F.col("n_tags") * F.lit(train_share)), "train")
        .when(F.col("tag_rank") < F.floor(F.col("n_tags") * F.lit(valid_share)), "valid")
        .otherwise("test")
    )
    return ranked.withColumn("split", split)


def topic_cutoffs(periods: DataFrame, train_share: float = TRAIN_SHARE, valid_share: float = VALID_SHARE) -> DataFrame:
    """One row per topic: the cut positions and cut times of `split_cutoffs`."""

    def position(share: float) -> Column:
        return F.floor(F.col("n_tags") * F.lit(share))

    def birthday_at(share: float) -> Column:
        return F.max(F.when(F.col("tag_rank") == position(share), F.col("birthday")))

    return periods.groupBy("topic").agg(
        F.max("n_tags").alias("n_tags"),
        F.max(position(train_share)).alias("train_valid_pos"),
        F.max(position(valid_share)).alias("valid_test_pos"),
        birthday_at(train_share).alias("train_valid_time"),
        birthday_at(valid_share).alias("valid_test_time"),
    )


def _plan(topics: DataFrame, periods: DataFrame, train_share: float, valid_share: float) -> Column:
    """All topics as one array: cut times, hashtags, and those of earlier periods.

    The dictionary may have `MOST_LISTED` entries; a longer one raises an error,
    since the array is copied into every task.
    """
    tag = F.col("each_hashtag")
    known = periods.groupBy("topic").agg(
        F.collect_set(F.when(F.col("split") == "train", tag)).alias("train_tags"),
        F.collect_set(F.when(F.col("split").isin("train", "valid"), tag)).alias("early_tags"),
    )
    # Hashtags nobody used yet have no birthday, but they are the topic's all the same.
    tags = topics.groupBy("topic").agg(F.collect_set("hashtag").alias("tags"))
    cuts = topic_cutoffs(periods, train_share, valid_share).select("topic", "train_valid_time", "valid_test_time")
    rows = tags.join(known, "topic").join(cuts, "topic")
    fields = ["topic", "tags", "train_tags", "early_tags", "train_valid_time", "valid_test_time"]
    listed = rows.agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("plan"), F.sum(F.size("tags")).alias("n"))
    message = F.lit(f"more than {MOST_LISTED} hashtags: split the dictionary")
    kind = listed.schema["plan"].dataType
    return listed.select(F.when(F.col("n") > MOST_LISTED, F.raise_error(message).cast(kind)).otherwise(F.col("plan"))).scalar()


def split_all_topics(
    posts: DataFrame,
    topics: DataFrame,
    periods: DataFrame,
    train_share: float = TRAIN_SHARE,
    valid_share: float = VALID_SHARE,
) -> DataFrame:
    """`(topic, tweet_id, create_time, label, split)`: per topic what `label_posts`,
    `assign_split` and `drop_leaking` give, from one narrow pass over the posts.

    Each post is a row per topic, as its label is. `posts` has unique ids. A topic
    without used hashtags has no cut times, and none of its posts is in a split.
    """
    rows = posts.select(
        "tweet_id", "create_time", tokens("hashtag").alias("words"), F.explode(_plan(topics, periods, train_share, valid_share)).alias("t")
    )
    split = (
        F.when(F.col("create_time") <= F.col("t.train_valid_time"), "train")
        .when(F.col("create_time") <= F.col("t.valid_test_time"), "valid")
        .when(F.col("create_time") > F.col("t.valid_test_time"), "test")
    )
    label = F.when(F.arrays_overlap("words", "t.tags"), 1.0).otherwise(0.0)
    leaks = (
        F.when(F.col("split") == "valid", F.arrays_overlap("words", "t.train_tags"))
        .when(F.col("split") == "test", F.arrays_overlap("words", "t.early_tags"))
        .otherwise(False)
    )
    placed = rows.withColumn("split", split).where(F.col("split").isNotNull()).where(~leaks)
    return placed.select("t.topic", "tweet_id", "create_time", label.alias("label"), "split")
