"""Log target, its inverse, and means that do not depend on task order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def log_target(count: str | Column) -> Column:
    return F.log1p(count)


def from_log(prediction: str | Column) -> Column:
    return F.expm1(prediction)


def rounded_count(value: str | Column) -> Column:
    """Nearest whole number (half up), never below zero; null stays null."""
    whole = F.round(value)
    return F.when(whole.isNotNull(), F.greatest(whole, F.lit(0.0))).cast("int")


LOW_BITS = 20


def exact_sum(value: str, scale: int | None) -> Column:
    """Sum of a measure.

    With ``scale``, values are rounded to that many decimals and added up as
    whole numbers, so that the order in which tasks finish (or are run again)
    cannot change the last digit. High and low bits are summed apart, which
    keeps either sum within 64 bits for some 10^12 rows of one group; only the
    group's total becomes a decimal, which later sums cannot overflow. NaN has
    no whole number and raises under ANSI; drop or impute it first.
    """
    if scale is None:
        return F.sum(F.col(value).cast("double"))
    return halves_sum(*sum_halves(value, scale), scale)


def sum_halves(value: str, scale: int) -> tuple[Column, Column]:
    """The sums of the high and of the low bits, as aggregates; both may be added up further."""
    units = F.rint(F.col(value) * F.lit(10.0**scale)).cast("bigint")
    return F.sum(F.shiftright(units, LOW_BITS)), F.sum(units.bitwiseAND(F.lit(2**LOW_BITS - 1)))


def halves_sum(high: Column, low: Column, scale: int) -> Column:
    """The sum that two halves stand for."""
    total = high.cast("decimal(20,0)") * F.lit(Decimal(2**LOW_BITS)) + low.cast("decimal(20,0)")
    return (total * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def mean_from(total: Column, count: Column) -> Column:
    """Mean out of a sum and a count; null where nothing was counted."""
    return F.try_divide(total.cast("double"), count)
