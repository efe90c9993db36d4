"""Field cleaning over the whole post table, as one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from topicmill.functions import clean_hashtag, clean_location, clean_mention, clean_term


def clean_posts(posts: DataFrame, whole_token: bool = False) -> DataFrame:
    """Sentinels for empty fields, normal locations, cleaned text.

    Two projections without a shuffle: text cleaning reads the hashtag and
    mention columns after their sentinels are in place.
    """
    fields = posts.withColumns(
        {
            "location": clean_location("location"),
            "hashtag": clean_hashtag("hashtag"),
            "mention": clean_mention("mention"),
        }
    )
    return fields.withColumn("term", clean_term("term", "mention", "hashtag", whole_token))
