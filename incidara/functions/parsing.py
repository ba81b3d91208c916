"""Lenient parsing: a bad string becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_timestamp(value: str | Column) -> Column:
    return F.try_to_timestamp(_col(value))


def parse_double(value: str | Column) -> Column:
    return _col(value).try_cast("double")


def parse_int(value: str | Column) -> Column:
    return _col(value).try_cast("int")
