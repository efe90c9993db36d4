"""Samples and folds that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.functions.hashing import fold_of, uniform_from_id


def stratified_sample(
    df: DataFrame,
    fractions: dict[float, float],
    label_col: str = "label",
    id_col: str = "tweet_id",
    seed: int = 0,
) -> DataFrame:
    """Keep a share of the rows of each label; a label without a share is dropped."""
    share = F.lit(0.0)
    for label, fraction in fractions.items():
        share = F.when(F.col(label_col) == label, F.lit(float(fraction))).otherwise(share)
    return df.where(uniform_from_id(F.col(id_col), seed) < share)


def with_folds(df: DataFrame, num_folds: int, id_col: str = "tweet_id", seed: int = 0) -> DataFrame:
    """Add `fold`; training set i is `fold != i`, its complement `fold == i`."""
    return df.withColumn("fold", fold_of(F.col(id_col), num_folds, seed))
