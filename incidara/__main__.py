"""Command line: ``spark-submit`` or ``python -m incidara JOB INPUT OUTPUT``."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import functions as F

from incidara.models.forecast import DEPTHS, ITERATIONS, STEPS
from incidara.models.metrics import PARALLEL_FITS
from incidara.operators.sampling import CHUNK_ROWS, FRACTION, chunk_of, sample_exact_strata
from incidara.operators.splits import TEST_START, VALID_START, TimeBounds
from incidara.plans.cleaning import clean
from incidara.plans.daily import daily_forecast
from incidara.plans.durations import USED as DURATION_COLUMNS, duration_prediction
from incidara.plans.hourly import hourly_counts
from incidara.schema import INCIDENT_COLUMNS, WEATHER_MEASURES
from incidara.session import build_session
from incidara.sinks import land_by_year, write_csv
from incidara.sources import read_table_strings, require_columns, typed_incidents


#: Published names of the weather measures.
MEASURES = [original for original, name, _ in INCIDENT_COLUMNS if name in WEATHER_MEASURES]


def _numbers(kind: type) -> Callable[[str], list]:
    return lambda text: [kind(part) for part in text.split(",")]


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="incidara", description=__doc__)
    parser.add_argument("job", choices=["sample", "clean", "land", "daily", "hourly", "duration"])
    parser.add_argument("input", help="incident table: CSV with a header (or with --names), or Parquet; raw, cleaned or landed")
    parser.add_argument("output", help="folder to write; must not exist")
    parser.add_argument("--names", help="comma-separated column names of a file without header")
    parser.add_argument("--fraction", type=float, default=FRACTION, help="share to sample")
    parser.add_argument("--rows", type=int, help="rows of the input, if known: saves counting them")
    parser.add_argument("--seed", type=int, default=42, help="seed of the sample")
    parser.add_argument("--by-state", action="store_true", help="key cities by state and name")
    parser.add_argument("--valid-start", type=date.fromisoformat, default=VALID_START)
    parser.add_argument("--test-start", type=date.fromisoformat, default=TEST_START)
    parser.add_argument("--exact-scale", type=int, help="decimals kept in exact sums")
    parser.add_argument("--depths", type=_numbers(int), default=DEPTHS, help="e.g. 3,4")
    parser.add_argument("--iterations", type=_numbers(int), default=ITERATIONS)
    parser.add_argument("--steps", type=_numbers(float), default=STEPS)
    parser.add_argument("--csv", action="store_true", help="write the cleaned table as CSV")
    parser.add_argument("--drop-duplicates", action="store_true", help="when cleaning")
    parser.add_argument("--parallelism", type=int, default=PARALLEL_FITS, help="fits at a time")
    parser.add_argument("--no-cache", action="store_true", help="keep no feature vectors between tree fits")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"incidara-{args.job}")
    names = args.names.split(",") if args.names else None
    raw = read_table_strings(spark, args.input, names)
    if args.job == "sample":
        chunk = chunk_of("ID", args.rows or require_columns(raw, ["ID"]).count(), CHUNK_ROWS)
        drawn = sample_exact_strata(
            raw.withColumn("_chunk", chunk), ["_chunk"], "ID", args.fraction, seed=args.seed
        )
        write_csv(drawn.drop("_chunk"), args.output)
    elif args.job == "clean":
        audits = clean(
            typed_incidents(require_columns(raw, MEASURES)),
            args.output,
            keep_duplicates=not args.drop_duplicates,
            as_csv=args.csv,
        )
        audits["non_null"].show(truncate=False)
        audits["duplicates"].show()
    elif args.job == "land":
        land_by_year(typed_incidents(require_columns(raw, ["Start_Time"])), args.output)
    elif args.job == "daily":
        used = ["Start_Time", "City", "Severity", *MEASURES, *["State"] * args.by_state]
        incidents = typed_incidents(require_columns(raw, used), any_null_drop=True, keep_rest=False)
        search = daily_forecast(
            incidents.filter(F.col("start_time").isNotNull()),
            args.output,
            keys=["state", "city"] if args.by_state else ["city"],
            bounds=TimeBounds(args.valid_start, args.test_start),
            depths=args.depths,
            iterations=args.iterations,
            steps=args.steps,
            parallelism=args.parallelism,
            exact_scale=args.exact_scale,
        )
        print(search.best)
    elif args.job == "hourly":
        hourly_counts(require_columns(raw, ["Start_Time", "Severity"]), args.output)
    else:
        duration_prediction(
            require_columns(raw, DURATION_COLUMNS),
            args.output,
            parallelism=args.parallelism,
            storage=None if args.no_cache else StorageLevel.MEMORY_AND_DISK,
        )


if __name__ == "__main__":
    main()
