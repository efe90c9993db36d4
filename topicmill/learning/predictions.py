"""Scores and readable ranked predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.functions.vectors import positive_score


def score_rows(predictions: DataFrame, *keep: str, probability_col: str = "probability") -> DataFrame:
    """Replace the probability vector by `score`, the probability of label 1."""
    return predictions.select(*keep, positive_score(predictions, probability_col).alias("score"))


def readable_predictions(scored: DataFrame, posts: DataFrame) -> DataFrame:
    """Scored ids with label, prediction and the post's text, best first."""
    text = posts.select("tweet_id", "term", "hashtag", "from_user")
    joined = scored.select("tweet_id", "score", "label", "prediction").join(text, "tweet_id")
    return joined.orderBy(F.desc("score"), "tweet_id")
