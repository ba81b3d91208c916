"""Column expressions; all run inside Spark's generated code."""

from incidara.functions.calendar import (
    DAY_MINUTES_BOUND,
    duration_minutes,
    iso_week_dates,
    weekend_flag,
    with_calendar,
)
from incidara.functions.numbers import (
    exact_sum,
    from_log,
    halves_sum,
    log_target,
    mean_from,
    rounded_count,
    sum_halves,
)
from incidara.functions.parsing import parse_double, parse_int, parse_timestamp

__all__ = [
    "DAY_MINUTES_BOUND",
    "duration_minutes",
    "exact_sum",
    "from_log",
    "halves_sum",
    "iso_week_dates",
    "log_target",
    "mean_from",
    "parse_double",
    "parse_int",
    "parse_timestamp",
    "rounded_count",
    "sum_halves",
    "weekend_flag",
    "with_calendar",
]
