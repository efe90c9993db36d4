"""Saving a fitted chain of Python and JVM stages as one folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.util import MLWritable


def chain(*models: Transformer) -> PipelineModel:
    """One model of several, nested pipelines laid flat in their order."""
    stages: list[Transformer] = []
    for model in models:
        stages += chain(*model.stages).stages if isinstance(model, PipelineModel) else [model]
    return PipelineModel(stages)


def save_chain(path: str, *models: Transformer, overwrite: bool = False) -> PipelineModel:
    """Write fitted stages (cleaned text to scores, say) as one folder.

    Stages may be Spark's own or this library's; each is written by itself below
    the folder, with the order beside them. A stage that cannot be written is an
    error before anything is.
    """
    whole = chain(*models)
    for stage in whole.stages:
        if not isinstance(stage, MLWritable):
            raise TypeError(f"{type(stage).__name__} cannot be saved")
    writer = whole.write()
    (writer.overwrite() if overwrite else writer).save(path)
    return whole


def load_chain(path: str) -> PipelineModel:
    """The model that `save_chain` wrote; needs this library where it is loaded."""
    return PipelineModel.load(path)
