"""Chi-square feature selection that ranks once for any number of features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import ChiSquareTest
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicmill.functions.vectors import vector_entries
from topicmill.operators.selection import chi_square_scores, top_features


def _sliced(vectors: pa.StructArray, place: np.ndarray, width: int) -> pa.StructArray:
    """Entries of sparse or dense vectors at kept places, as sparse vectors.

    `place` holds the new index of every old one, or -1. The work follows the
    entries of the batch, whatever the number of kept features.
    """
    kind = np.asarray(vectors.field("type").fill_null(0))
    indices, values = vectors.field("indices"), vectors.field("values")
    counts = np.asarray(values.value_lengths().fill_null(0)).astype(np.int64)
    value = np.asarray(values.flatten(), np.float64)
    row = np.repeat(np.arange(len(vectors)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    old = within.copy()  # a dense vector's entries are in order
    old[kind[row] == 0] = np.asarray(indices.flatten(), np.int64)
    new = place[old]
    keep = (new >= 0) & (value != 0)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(vectors)))])
    offsets = pa.array(ends.astype(np.int32))
    arrays = [
        pa.array(np.zeros(len(vectors), np.int8)),
        pa.array(np.full(len(vectors), width, np.int32)),
        pa.ListArray.from_arrays(offsets, pa.array(new[keep].astype(np.int32))),
        pa.ListArray.from_arrays(offsets, pa.array(value[keep])),
    ]
    return pa.StructArray.from_arrays(arrays, ["type", "size", "indices", "values"], mask=vectors.is_null())


class SelectedFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Vectors cut down to `indices`, in their order; one narrow pass.

    Runs over Arrow batches of the vectors' own storage: a row costs what its
    entries cost, also with a hundred thousand kept features. Only the vectors go
    through Python; columns that nothing reads later (texts, tokens) are pruned.
    """

    inputCol = Param(Params._dummy(), "inputCol", "vector", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "selected vector", TypeConverters.toString)
    indices = Param(Params._dummy(), "indices", "kept indices, rising", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="selected", indices=None):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="selected", indices=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def getIndices(self) -> list[int]:
        return self.getOrDefault(self.indices)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept = np.array(self.getIndices(), np.int64)
        width = len(kept)
        source, output = self.getOrDefault(self.inputCol), self.getOrDefault(self.outputCol)
        columns = [c for c in dataset.columns if c != output]
        shared = dataset.sparkSession.sparkContext.broadcast(kept)

        def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            kept = shared.value
            place = np.full(1, -1, np.int64)
            for vectors in batches:
                size = max(int(kept.max(initial=-1)), _largest(vectors)) + 1
                if len(place) < size:
                    place = np.full(size, -1, np.int64)
                    place[kept] = np.arange(width)
                yield _sliced(vectors, place, width)

        return dataset.select(*columns, F.arrow_udf(cut, VectorUDT())(F.col(source)).alias(output))


def _largest(vectors: pa.StructArray) -> int:
    """Largest index that a batch may use."""
    sparse = np.asarray(vectors.field("indices").flatten(), np.int64)
    dense = np.asarray(vectors.field("values").value_lengths().fill_null(0), np.int64)
    return int(max(sparse.max(initial=-1), dense.max(initial=0) - 1))


class ChiSquareTopFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Keep the `numTopFeatures` features that depend most on the label.

    `rankBy` is `statistic` or `p_value`. P-values reach 0 in double precision
    from a statistic of some 70 upwards; features of equal p-value are therefore
    ranked by statistic, and equal statistics by index. `rank` can be computed
    once per training set and handed to `slicer` for every number of features of
    a grid.
    """

    numTopFeatures = Param(Params._dummy(), "numTopFeatures", "features to keep", TypeConverters.toInt)
    featuresCol = Param(Params._dummy(), "featuresCol", "count vector", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "selected vector", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label, 0 or 1", TypeConverters.toString)
    rankBy = Param(Params._dummy(), "rankBy", "statistic or p_value", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, numTopFeatures=50, featuresCol="features", outputCol="selected", labelCol="label", rankBy="statistic"
    ):
        super().__init__()
        if rankBy not in ("p_value", "statistic"):
            raise ValueError("rankBy must be statistic or p_value")
        self._setDefault(
            numTopFeatures=50, featuresCol="features", outputCol="selected", labelCol="label", rankBy="statistic"
        )
        self._set(**self._input_kwargs)

    def scores(self, dataset: DataFrame) -> DataFrame:
        """`(idx, statistic, dof)` of the features found in `dataset`."""
        features, label = self.getOrDefault(self.featuresCol), self.getOrDefault(self.labelCol)
        labelled = dataset.select(F.col(label).cast("double").alias("label"), features)
        entries = labelled.select("label", F.inline(vector_entries(F.col(features))))
        return chi_square_scores(entries.withColumnRenamed("value", "cnt"), labelled)

    def best(self, dataset: DataFrame, limit: int) -> DataFrame:
        """The best `limit` features: `idx`, by `statistic` also its value and `dof`."""
        if self.getOrDefault(self.rankBy) == "statistic":
            return top_features(self.scores(dataset), limit)
        features, label = self.getOrDefault(self.featuresCol), self.getOrDefault(self.labelCol)
        tests = ChiSquareTest.test(dataset.select(features, label), features, label, flatten=True)
        order = ["pValue", F.desc(F.round("statistic", 9)), "featureIndex"]
        return tests.orderBy(*order).limit(limit).select(F.col("featureIndex").alias("idx"))

    def rank(self, dataset: DataFrame, limit: int) -> list[int]:
        """Indices of the best `limit` features, best first."""
        return [row["idx"] for row in self.best(dataset, limit).select("idx").collect()]

    def slicer(self, ranked: list[int]) -> SelectedFeatures:
        keep = sorted(ranked[: self.getOrDefault(self.numTopFeatures)])
        return SelectedFeatures(
            inputCol=self.getOrDefault(self.featuresCol), outputCol=self.getOrDefault(self.outputCol), indices=keep
        )

    def _fit(self, dataset: DataFrame) -> SelectedFeatures:
        return self.slicer(self.rank(dataset, self.getOrDefault(self.numTopFeatures)))
