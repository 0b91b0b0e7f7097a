"""Scalar column expressions shared by the operators.  All are JVM-side built-ins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def null_outside(column, low, high) -> Column:
    """The value when it lies in the inclusive range, otherwise NULL."""
    c = as_column(column)
    return F.when(c.between(low, high), c)


def null_below(column, low=0) -> Column:
    c = as_column(column)
    return F.when(c >= low, c)


def null_unless_period(column, strict: bool = False) -> Column:
    """Keep six-character ``YYYYMM`` text; ``strict`` also checks digits and the month."""
    c = as_column(column)
    if strict:
        return F.when(c.rlike("^[0-9]{4}(0[1-9]|1[0-2])$"), c)
    return F.when(F.length(c) == 6, c)


def encode(column, codes: Mapping[str, int]) -> Column:
    """Look a code up in a literal dictionary; unlisted codes and NULL give NULL."""
    entries = [F.lit(part) for pair in codes.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), as_column(column).cast("string"))


def clean_amount(column) -> Column:
    """Double without NaN; text that is not a number gives NULL instead of an error."""
    return F.nanvl(as_column(column).try_cast("double"), F.lit(None).cast("double"))


def round_to(column, step: int) -> Column:
    """Round half up to a multiple of ``step``; the result is a double."""
    return F.round(as_column(column) / F.lit(step)) * F.lit(float(step))


def mask_postal_code(column) -> Column:
    c = as_column(column)
    return F.when(F.length(c) >= 5, F.concat(F.substring(c, 1, 3), F.lit("00"))).otherwise(c)


def period_year(period) -> Column:
    return F.substring(as_column(period), 1, 4).try_cast("int")


def period_month(period) -> Column:
    return F.substring(as_column(period), 5, 2).try_cast("int")


def month_index(period) -> Column:
    """Months since year 0, so that differences are distances in months."""
    return period_year(period) * 12 + period_month(period)


def vintage_digits(key) -> Column:
    """Characters 2-3 of the loan id as a number."""
    return F.substring(as_column(key), 2, 2).try_cast("int")


def vintage_of(key, century_pivot: int | None = 90) -> Column:
    """Vintage year from characters 2-3 of the loan id.

    Two-digit years at or above ``century_pivot`` belong to the 1900s.
    ``century_pivot=None`` adds 2000 to every year, which puts 1999 loans in 2099.
    """
    yy = vintage_digits(key)
    if century_pivot is None:
        return yy + 2000
    return F.when(yy >= century_pivot, yy + 1900).otherwise(yy + 2000)


def stable_hash(key, seed: int = 42) -> Column:
    """32-bit value from md5: the same on every run, layout and engine."""
    text = F.concat(as_column(key).cast("string"), F.lit(f"#{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def stable_fraction(key, seed: int = 42) -> Column:
    """Uniform number in [0, 1) that depends on the key and the seed only."""
    return stable_hash(key, seed) / F.lit(float(2**32))


def share(numerator: Column, denominator: Column) -> Column:
    """Double division that gives 0 for a zero denominator, as the reports expect."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    )


def missing_text(column) -> Column:
    """Category text with every spelling of "no value" replaced by one word."""
    text = as_column(column).cast("string")
    return F.when(text.isNull() | text.isin("nan", "None", ""), F.lit("MISSING")).otherwise(text)
