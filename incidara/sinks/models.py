"""Saved pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Save a fitted pipeline, replacing an older one."""
    model.write().overwrite().save(path)
