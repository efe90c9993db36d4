"""A pyspark.ml evaluator for ranking metrics."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from topicmill.functions.vectors import positive_score
from topicmill.operators import ranking

METRICS = ("AP", "precision_at_k", "recall_at_k")


class RankingEvaluator(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """Average precision, precision at k or recall at k; larger is better.

    `scoreCol` may be a probability vector (its element 1 ranks) or a number.
    `idCol`, where set, breaks ties in the first k; otherwise a tie is broken by
    the label, negatives first, which is the lowest value any order can give.
    """

    metric = Param(Params._dummy(), "metric", "one of " + ", ".join(METRICS), TypeConverters.toString)
    k = Param(Params._dummy(), "k", "length of the ranked list", TypeConverters.toInt)
    scoreCol = Param(Params._dummy(), "scoreCol", "probability vector or number", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label, 0 or 1", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "id column, or empty", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, metric="AP", k=100, scoreCol="probability", labelCol="label", idCol=""):
        super().__init__()
        if metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
        self._setDefault(metric="AP", k=100, scoreCol="probability", labelCol="label", idCol="")
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        id_col, label_col = self.getOrDefault(self.idCol), self.getOrDefault(self.labelCol)
        label = F.col(label_col).cast("double")
        rows = dataset.select(
            positive_score(dataset, self.getOrDefault(self.scoreCol)).alias("score"),
            label.alias("label"),
            (F.col(id_col) if id_col else label).alias("id"),
        )
        # Two passes read the scores (quantiles, then totals): two numbers and
        # an id per row are kept, not the model's whole output.
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return float(self._metric(rows).first()[0])
        finally:
            rows.unpersist()

    def _metric(self, rows: DataFrame) -> DataFrame:
        metric, k = self.getOrDefault(self.metric), self.getOrDefault(self.k)
        if metric == "AP":
            return ranking.average_precision(rows)
        measure = ranking.precision_at_k if metric == "precision_at_k" else ranking.recall_at_k
        return measure(rows, k, id_col="id")

    def isLargerBetter(self) -> bool:
        return True
