"""Weak labels: a post with a curated hashtag is topical."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicmill.functions.text import tokens

# Entries that a list compared within rows may have.
MOST_LISTED = 10_000


def explode_hashtags(posts: DataFrame, *keep: str) -> DataFrame:
    """One row per post and hashtag: `tweet_id, create_time, each_hashtag`."""
    kept = keep or ("tweet_id", "create_time")
    return posts.select(*kept, F.explode(tokens("hashtag")).alias("each_hashtag"))


def topical_ids(exploded: DataFrame, tags: DataFrame) -> DataFrame:
    """Distinct ids of posts with one of the topic's hashtags.

    The dictionary side is a curated list: the planner broadcasts it by its
    size, and a larger one is shuffled like any table.
    """
    return exploded.join(tags, "each_hashtag", "left_semi").select("tweet_id").distinct()


def label_posts(posts: DataFrame, ids: DataFrame) -> DataFrame:
    """Distinct posts with a `label`: 1.0 where the id is among `ids`, 0.0 elsewhere.

    `ids` may repeat. Equal posts share their id, so removing repeats needs no
    exchange beyond the join's. Give a written table of ids where one id may hold
    a large part of all posts: the planner splits a hot key only in a join of
    plain exchanges, and broadcasts by measured size.
    """
    found = ids.select(F.col("tweet_id").alias("found_id")).distinct()
    joined = posts.join(found, posts["tweet_id"] == found["found_id"], "left")
    return joined.select(*posts.columns, F.col("found_id").isNotNull().cast("double").alias("label")).distinct()


def label_with_ids(posts: DataFrame, ids: DataFrame) -> DataFrame:
    """`label_posts` for ids that are known to be distinct, such as written ones."""
    found = ids.select(F.col("tweet_id").alias("found_id"))
    joined = posts.join(found, posts["tweet_id"] == found["found_id"], "left")
    return joined.select(*posts.columns, F.col("found_id").isNotNull().cast("double").alias("label")).distinct()


def bounded_list(tags: DataFrame, column: str = "each_hashtag") -> Column:
    """A curated list as one array, for comparison within rows.

    It may hold `MOST_LISTED` entries; a longer one raises an error in the query,
    since it would be copied into every task.
    """
    some = tags.select(column).distinct().limit(MOST_LISTED + 1).agg(F.collect_set(column).alias("tags"))
    message = F.lit(f"more than {MOST_LISTED} hashtags: use the join by id")
    checked = F.when(F.size("tags") > MOST_LISTED, F.raise_error(message).cast("array<string>")).otherwise(F.col("tags"))
    return some.select(checked.alias("tags")).scalar()


def label_by_row(posts: DataFrame, tags: DataFrame) -> DataFrame:
    """`label_posts` for a table whose ids are unique: no shuffle at all.

    Every row is its own post then, so its own hashtags decide.
    """
    hit = F.arrays_overlap(tokens("hashtag"), bounded_list(tags))
    return posts.withColumn("label", F.when(hit, 1.0).otherwise(0.0))


def restrict_to_labelled(exploded: DataFrame, labels: DataFrame) -> DataFrame:
    """Exploded hashtags of posts that have a label."""
    return exploded.join(labels.select("tweet_id"), "tweet_id", "left_semi")
