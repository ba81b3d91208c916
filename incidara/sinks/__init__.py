"""Writers."""

from incidara.sinks.models import save_pipeline
from incidara.sinks.tables import (
    land_by_year,
    write_csv,
    write_lines,
    write_result_csv,
    write_table,
)

__all__ = [
    "land_by_year",
    "save_pipeline",
    "write_csv",
    "write_lines",
    "write_result_csv",
    "write_table",
]
