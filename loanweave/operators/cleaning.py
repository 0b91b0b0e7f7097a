"""Cleaning of the raw origination and performance tables.

Each cleaner builds every output column from the *raw* columns in one projection,
so no rule can see another rule's output and the order of rules does not matter.
A rule whose column is absent is skipped.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from loanweave import columns as c
from loanweave.functions import expressions as x


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Replace the columns that have a rule and keep all others, in order."""
    return df.select(*[rules[n].alias(n) if n in rules else F.col(n) for n in df.columns])


def ltv_by_relief_flag(ltv, relief_flag, legacy: bool = False) -> Column:
    """LTV valid range depends on the *raw* relief-refinance flag.

    A NULL flag is an ordinary loan.  ``legacy=True`` keeps plain SQL comparison, under
    which a NULL flag satisfies neither branch and the LTV is lost.
    """
    value, flag = x.as_column(ltv), x.as_column(relief_flag)
    relief = flag == "Y" if legacy else flag.eqNullSafe("Y")
    return F.when(relief, x.null_outside(value, *c.LTV_RANGE_RELIEF)).when(
        ~relief, x.null_outside(value, *c.LTV_RANGE)
    )


def delinquency_code(status, extended: bool = False) -> Column:
    """Delinquency status as a number.

    By default only 0-9 and RA (10) are known and longer delinquencies become NULL.
    ``extended=True`` keeps any whole number of months and codes RA as 999.
    """
    if not extended:
        return x.encode(status, c.PERFORMANCE_CODES["CURRENT_LOAN_DELINQUENCY_STATUS"])
    text = x.as_column(status)
    return F.when(text == "RA", F.lit(999)).when(text.rlike("^[0-9]{1,4}$"), text.try_cast("int"))


def imputed_loan_age(age, period, first_payment=None) -> Column:
    """Age as reported; otherwise months since January 1999 (or since first payment)."""
    reported = x.null_below(age)
    if first_payment is None:
        derived = (x.period_year(period) - 1999) * 12 + x.period_month(period)
    else:
        derived = x.month_index(period) - x.month_index(first_payment)
    return F.coalesce(reported, derived)


def clean_origination(
    df: DataFrame, *, strict_periods: bool = False, legacy: bool = False
) -> DataFrame:
    rules = {n: x.null_outside(n, *r) for n, r in c.ORIGINATION_RANGES.items()}
    rules |= {n: x.null_unless_period(n, strict_periods) for n in c.ORIGINATION_PERIODS}
    rules |= {n: x.encode(n, codes) for n, codes in c.ORIGINATION_CODES.items()}
    rules["ORIGINAL_UPB"] = x.round_to("ORIGINAL_UPB", 1000)
    rules["ORIGINAL_LTV"] = ltv_by_relief_flag(
        "ORIGINAL_LTV", "RELIEF_REFINANCE_INDICATOR", legacy
    )
    rules["POSTAL_CODE"] = x.mask_postal_code("POSTAL_CODE")
    return apply_rules(df, rules)


def clean_performance(
    df: DataFrame, *, strict_periods: bool = False, extended_status: bool = False
) -> DataFrame:
    rules = {n: x.null_outside(n, *r) for n, r in c.PERFORMANCE_RANGES.items()}
    rules |= {n: x.null_unless_period(n, strict_periods) for n in c.PERFORMANCE_PERIODS}
    rules |= {n: x.encode(n, codes) for n, codes in c.PERFORMANCE_CODES.items()}
    rules |= {n: x.null_below(n) for n in c.NON_NEGATIVE}
    rules |= {n: x.clean_amount(n) for n in c.AMOUNTS}
    rules["CURRENT_LOAN_DELINQUENCY_STATUS"] = delinquency_code(
        "CURRENT_LOAN_DELINQUENCY_STATUS", extended_status
    )
    rules["LOAN_AGE"] = imputed_loan_age("LOAN_AGE", c.TIME)
    return apply_rules(df, rules)


def clean_both(origination: DataFrame, performance: DataFrame, **options):
    """Both tables cleaned; see ``table_counts`` for the count report."""
    legacy = options.pop("legacy", False)
    strict = options.pop("strict_periods", False)
    return (
        clean_origination(origination, strict_periods=strict, legacy=legacy),
        clean_performance(performance, strict_periods=strict, **options),
    )


def table_counts(origination: DataFrame, performance: DataFrame) -> DataFrame:
    """One row per table with its number of rows."""
    return origination.agg(F.count("*").alias("rows")).select(
        F.lit("origination").alias("table"), "rows"
    ).unionByName(
        performance.agg(F.count("*").alias("rows")).select(
            F.lit("performance").alias("table"), "rows"
        )
    )


def cast_text_columns(df: DataFrame, keep=()) -> DataFrame:
    """Text columns that are left after cleaning become doubles (bad text gives NULL)."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"} - set(keep)
    return apply_rules(df, {n: F.col(n).try_cast("double") for n in text})


def unique_columns(df: DataFrame) -> DataFrame:
    """Keep the first of any columns that share a name."""
    seen: dict[str, int] = {}
    for position, name in enumerate(df.columns):
        seen.setdefault(name, position)
    if len(seen) == len(df.columns):
        return df
    renamed = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return renamed.select(*[F.col(f"_{i}").alias(n) for n, i in seen.items()])


def drop_lineage(df: DataFrame) -> DataFrame:
    return df.drop(*c.LINEAGE)
