"""Ranked lists and ranking metrics, computed where the rows are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicmill.session import stage


def rank_predictions(predictions: DataFrame, score_col: str = "score", id_col: str = "tweet_id") -> DataFrame:
    """Highest score first, equal scores by id (a distributed range sort)."""
    return predictions.orderBy(F.desc(score_col), id_col)


def top_k(predictions: DataFrame, k: int, score_col: str = "score", id_col: str = "tweet_id") -> DataFrame:
    """The first `k` rows of the ranking; each task sends at most `k`."""
    return rank_predictions(predictions, score_col, id_col).limit(k)


def threshold_totals(
    rows: DataFrame, score_col: str = "score", label_col: str = "label", buckets: int | None = None
) -> DataFrame:
    """Per distinct score: `pos`, `n` and their running totals from the top.

    A window over all scores would be one task. Instead the totals per score are
    written in ranges of scores, `buckets` of them (the number of shuffle partitions
    by default); each range sums by itself and adds the totals of the ranges above
    it, one row per range. `rows` is read once. A score that is null or not a number
    has no place in a ranking: it raises an error.
    """
    score = F.col(score_col).cast("double")
    wrong = score.isNull() | F.isnan(score)
    score = F.when(wrong, F.raise_error(F.lit("a score is null or NaN")).cast("double")).otherwise(score)
    scored = rows.select(score.alias("score"), F.col(label_col).cast("double").alias("label"))
    grouped = scored.groupBy("score").agg(F.sum("label").alias("pos"), F.count("*").alias("n"))
    # Written before they are ranged: the bounds of ranges are drawn in a pass of their own.
    grouped = stage(grouped, "score_totals")
    wanted = buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = grouped.repartitionByRange(wanted, F.desc("score")).withColumn("_range", F.spark_partition_id())
    ranged = stage(ranged, "score_ranges")
    higher = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
        .select(
            "_range",
            F.coalesce(F.sum("pos").over(higher), F.lit(0.0)).alias("pos_above"),
            F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("n_above"),
        )
    )
    within = Window.partitionBy("_range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn("running_pos", F.col("pos_above") + F.sum("pos").over(within))
        .withColumn("running_n", F.col("n_above") + F.sum("n").over(within))
        .select("score", "pos", "n", "running_pos", "running_n")
    )


def average_precision(
    rows: DataFrame, score_col: str = "score", label_col: str = "label", buckets: int | None = None
) -> DataFrame:
    """One row `average_precision`: precision at each threshold, weighted by recall gain.

    Equal scores share a threshold. Without positives the result is 0.
    """
    totals = threshold_totals(rows, score_col, label_col, buckets)
    weighted = F.sum(F.col("pos") * F.col("running_pos") / F.col("running_n"))
    positives = F.sum("pos")
    value = F.when(positives > 0, weighted / positives).otherwise(0.0)
    return totals.agg(F.coalesce(value, F.lit(0.0)).alias("average_precision"))


def _hits(rows: DataFrame, k: int, score_col: str, label_col: str, id_col: str) -> DataFrame:
    best = top_k(rows.select(score_col, label_col, id_col), k, score_col, id_col)
    return best.agg(F.coalesce(F.sum(label_col), F.lit(0)).cast("double").alias("hits"))


def precision_at_k(
    rows: DataFrame, k: int, score_col: str = "score", label_col: str = "label", id_col: str = "tweet_id"
) -> DataFrame:
    """Share of positives among the first `k` of the ranking."""
    return _hits(rows, k, score_col, label_col, id_col).select((F.col("hits") / k).alias("precision_at_k"))


def recall_at_k(
    rows: DataFrame, k: int, score_col: str = "score", label_col: str = "label", id_col: str = "tweet_id"
) -> DataFrame:
    """Share of all positives found among the first `k` of the ranking."""
    positives: Column = rows.agg(F.sum(label_col).cast("double")).scalar()
    found = F.when(positives > 0, F.col("hits") / positives).otherwise(0.0)
    return _hits(rows, k, score_col, label_col, id_col).select(found.alias("recall_at_k"))
