"""Loan-level summaries and model input tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from loanweave import columns as c
from loanweave.columns import KEY, TARGET, TIME

# Helper columns of the target that are not features either.
TARGET_HELPERS = ("is_in_default", "split", "fold")


def ever_positive(df: DataFrame, key: str = KEY) -> DataFrame:
    return df.groupBy(key).agg(F.max(TARGET).alias("ever_defaulted"))


def distinct_loans(df: DataFrame, key: str = KEY) -> DataFrame:
    return df.select(key).distinct()


def loan_summary(
    df: DataFrame, static: Sequence[str] = c.LOAN_SUMMARY, key: str = KEY, time: str = TIME
) -> DataFrame:
    """One row per loan: ever defaulted, and each attribute's first value by time."""
    return df.groupBy(key).agg(
        F.max(TARGET).alias("ever_defaulted"),
        *[F.min_by(n, F.when(F.col(n).isNotNull(), F.col(time))).alias(n) for n in static],
    )


def latest_values(
    df: DataFrame, key: str = KEY, time: str = TIME, whole_row: bool = False
) -> DataFrame:
    """The latest value per loan: each column's last non-NULL one, or the last row whole.

    One aggregation with a partial step on every executor; no sort, no window.
    """
    others = [n for n in df.columns if n != key]
    if whole_row:
        last = F.max_by(F.struct(*others), F.col(time)).alias("_row")
        return df.groupBy(key).agg(last).select(key, *[f"_row.{n}" for n in others])
    return df.groupBy(key).agg(
        *[F.max_by(n, F.when(F.col(n).isNotNull(), F.col(time))).alias(n) for n in others]
    ).select(*df.columns)


def latest_for(sample: DataFrame, panel: DataFrame, fallback: DataFrame, bound: int) -> DataFrame:
    """Latest values of the sampled loans; the fallback panel when the first has none."""
    from loanweave.operators.splits import restrict_to_sample

    chosen = restrict_to_sample(panel, sample, bound)
    if chosen.isEmpty():
        chosen = restrict_to_sample(fallback, sample, bound)
    return latest_values(chosen)


def select_model_columns(
    df: DataFrame, drop: Sequence[str] = c.DROP_FEATURES, key: str = KEY, time: str = TIME
) -> DataFrame:
    """Keys and target first, then every column that is not on the drop list."""
    lead = [key, time, TARGET]
    unwanted = {*drop, *TARGET_HELPERS, *lead}
    return df.select(*lead, *[n for n in df.columns if n not in unwanted])


def features_and_label(
    df: DataFrame, excluded: Sequence[str] = (KEY, TIME, TARGET, "vintage_year", "origination_year")
) -> DataFrame:
    """Feature columns plus the label as a long, on the same row."""
    names = [n for n in df.columns if n not in excluded]
    return df.select(*names, F.col(TARGET).cast("long").alias("label"))


def model_input(df: DataFrame, drop: Sequence[str] = c.MODEL_INPUT_DROP, key: str = KEY) -> DataFrame:
    """All features as numbers with 0 for what is missing or not a number; id last."""
    names = [n for n in df.columns if n not in drop]
    numbers = [
        F.coalesce(F.nanvl(F.col(n).try_cast("double"), F.lit(0.0)), F.lit(0.0)).alias(n)
        for n in names
    ]
    return df.select(*numbers, key)


def align_to_model(
    df: DataFrame,
    feature_names: Sequence[str],
    defaults: Mapping[str, object] = c.SCORING_DEFAULTS,
    passthrough: Sequence[str] = (KEY,),
    skip_unknown: bool = False,
) -> DataFrame:
    """The model's features in the model's order; known absent ones get their default.

    An absent feature without default is an error, because the model could not score the
    rows; ``skip_unknown`` leaves it out instead.
    """
    have = set(df.columns)
    added = {n: F.lit(defaults[n]) for n in feature_names if n not in have and n in defaults}
    missing = [n for n in feature_names if n not in have and n not in added]
    if missing and not skip_unknown:
        raise ValueError(f"the model needs {missing}, which have no default")
    names = [n for n in feature_names if n not in missing]
    filled = df.withColumns(added) if added else df
    numeric = [n for n, t in filled.dtypes if n in names and t != "string"]
    kept = [n for n in passthrough if n in have and n not in names]
    return filled.select(*kept, *names).fillna(0, subset=numeric)
