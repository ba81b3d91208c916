"""Saved pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
