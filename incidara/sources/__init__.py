"""Readers."""

from incidara.sources.artifacts import cluster_by_id, read_cluster_profile, read_importances
from incidara.sources.csv import (
    as_published,
    read_incidents,
    read_inferred,
    read_strings,
    read_table_strings,
    read_typed,
    require_columns,
    typed_incidents,
)
from incidara.sources.models import load_pipeline
from incidara.sources.tables import read_landed

__all__ = [
    "as_published",
    "cluster_by_id",
    "load_pipeline",
    "read_cluster_profile",
    "read_importances",
    "read_incidents",
    "read_inferred",
    "read_landed",
    "read_strings",
    "read_table_strings",
    "read_typed",
    "require_columns",
    "typed_incidents",
]
