"""Model persistence: ALS and LSH models, and models saved as pipeline stages."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import BucketedRandomProjectionLSHModel
from pyspark.ml.recommendation import ALSModel


def save_model(model, path: str, overwrite: bool = False) -> str:
    writer = model.write()
    if overwrite:
        writer = writer.overwrite()
    writer.save(path)
    return path


def load_als(path: str) -> ALSModel:
    return ALSModel.load(path)


def load_lsh(path: str) -> BucketedRandomProjectionLSHModel:
    return BucketedRandomProjectionLSHModel.load(path)


def save_as_pipeline(model, path: str) -> str:
    """Save a fitted model as stage 0 of a one-stage pipeline model."""
    PipelineModel(stages=[model]).write().overwrite().save(path)
    return path


def load_pipeline_stage(path: str, stage: int = 0):
    return PipelineModel.load(path).stages[stage]
