"""Chi-square scores of count features against a binary label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chi_square_scores(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """`(idx, statistic, dof)` from long counts `(idx, cnt, label)`.

    `labels` is the whole labelled table, for the rows in which a feature is
    absent: their cell is the label total minus what was seen. Cells are counted
    on the map side, so the exchange carries one row per feature and count
    value, and each (feature, value) row holds both labels side by side.
    """
    positive = (F.col("label") == 1.0).cast("long")
    totals = labels.agg(
        F.struct(
            F.sum(1 - positive).cast("double").alias("neg"), F.sum(positive).cast("double").alias("pos")
        ).alias("t")
    ).scalar()
    neg_total, pos_total = totals["neg"], totals["pos"]
    both = (neg_total > 0) & (pos_total > 0)

    def cell(neg, pos):
        share = (neg + pos) / (neg_total + pos_total)
        expected_neg, expected_pos = share * neg_total, share * pos_total
        deviation = F.pow(neg - expected_neg, 2) / expected_neg + F.pow(pos - expected_pos, 2) / expected_pos
        return F.when(both & (share > 0), deviation).otherwise(0.0)

    cells = counts.groupBy("idx", "cnt").agg(
        F.sum(1 - positive).cast("double").alias("neg"), F.sum(positive).cast("double").alias("pos")
    )
    per_feature = cells.groupBy("idx").agg(
        F.sum(cell(F.col("neg"), F.col("pos"))).alias("seen"),
        F.sum("neg").alias("neg"),
        F.sum("pos").alias("pos"),
        F.count("*").alias("n_values"),
    )
    zero_neg, zero_pos = neg_total - F.col("neg"), pos_total - F.col("pos")
    has_zero = (zero_neg + zero_pos > 0).cast("long")
    values = F.col("n_values") + has_zero
    return per_feature.select(
        "idx",
        (F.col("seen") + cell(zero_neg, zero_pos)).alias("statistic"),
        F.when(both, values - 1).otherwise(0).cast("long").alias("dof"),
    )


def top_features(scores: DataFrame, num_top: int) -> DataFrame:
    """The `num_top` features of highest statistic; ties take the lower index.

    Statistics are compared to nine digits, since sums over many tasks differ in
    the last ones from run to run.
    """
    return scores.orderBy(F.desc(F.round("statistic", 9)), "idx").limit(num_top)
