"""Behavioural features of a loan's history.

Trailing features look strictly backwards; running features include the current row.
The input is the cleaned performance panel joined to the cleaned origination table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from loanweave.columns import KEY, LINEAGE, TIME
from loanweave.functions import expressions as x
from loanweave.functions.history import History

# The seasonality features use this many digits of pi.
PI = 3.14159
ROLLING = {"CURRENT_ACTUAL_UPB": "balance", "CURRENT_INTEREST_RATE": "rate", "ELTV": "eltv"}
#: All features in the order of their columns.
FEATURES = (
    *"observation_year observation_month observation_quarter seasonality_sin seasonality_cos".split(),
    *"loan_age_squared loan_age_cubic remaining_term_pct delinquency_numeric is_delinquent".split(),
    *"max_delinquency_3m max_delinquency_6m max_delinquency_12m rolling_mean_delinquency_6m".split(),
    *"num_delinquent_months_12m last_delinquent_month delinquency_streak_id".split(),
    *"consecutive_delinquent_months months_since_last_delinquency delinquency_trend_6m".split(),
    *"remaining_balance_pct principal_paid_pct balance_change_3m balance_change_6m balance_change_12m".split(),
    *"rate_change_since_origination prev_interest_rate rate_reduction_after_mod".split(),
    *"ever_modified num_modifications last_modification_month payment_deferral_count".split(),
    "months_since_modification",
    *(f"rolling_{kind}_{suffix}_6m" for suffix in ROLLING.values() for kind in ("avg", "std", "min", "max")),
    *"dti_ltv_interaction credit_dti_interaction balance_delinquency_interaction age_balance_interaction".split(),
)
#: Columns of the steps that are no features.
HELPERS = ("_late_rows", "_clear_rows", "_at", "_last_clear", "_upb_3", "_upb_6", "_upb_12")


def join_static(performance: DataFrame, origination: DataFrame, key: str = KEY) -> DataFrame:
    """Every panel row with its loan's static attributes.

    No join hint: the static side grows with the book, so its strategy is AQE's choice.
    """
    static = [n for n in origination.columns if n == key or n not in performance.columns]
    return performance.drop(*LINEAGE).join(
        origination.select(*[n for n in static if n not in LINEAGE]), key, "inner"
    )


def time_features(df: DataFrame, time: str = TIME) -> DataFrame:
    month = x.period_month(time)
    angle = F.lit(2 * PI) * month / F.lit(12)
    term, remaining = F.col("ORIGINAL_LOAN_TERM"), F.col("REMAINING_MONTHS_TO_LEGAL_MATURITY")
    return df.withColumns({
        "observation_year": x.period_year(time),
        "observation_month": month,
        "observation_quarter": F.ceil(month / 3).cast("int"),
        "seasonality_sin": F.sin(angle),
        "seasonality_cos": F.cos(angle),
        "loan_age_squared": F.pow("LOAN_AGE", F.lit(2)),
        "loan_age_cubic": F.pow("LOAN_AGE", F.lit(3)),
        "remaining_term_pct": F.when(term > 0, remaining / term).otherwise(0.0),
    })


def _delinquency_inputs() -> dict[str, Column]:
    level = F.coalesce(F.col("CURRENT_LOAN_DELINQUENCY_STATUS").cast("int"), F.lit(0))
    return {"delinquency_numeric": level, "is_delinquent": F.when(level > 0, 1).otherwise(0)}


def _delinquency_windows(history: History) -> dict[str, Column]:
    is_late = F.col("is_delinquent") == 1
    return {
        **{
            f"max_delinquency_{n}m": F.max("delinquency_numeric").over(history.before(n))
            for n in (3, 6, 12)
        },
        "rolling_mean_delinquency_6m": F.avg("delinquency_numeric").over(history.before(6)),
        "num_delinquent_months_12m": F.sum("is_delinquent").over(history.before(12)),
        "last_delinquent_month": history.running_max(
            F.when(is_late, F.col(history.time)), "last_delinquent_month"
        ),
        "_late_rows": history.running_sum(F.col("is_delinquent"), "late_rows"),
        "_clear_rows": history.running_sum(1 - F.col("is_delinquent"), "clear_rows"),
        "_at": history.row_position(),
    }


def _position_windows(history: History) -> dict[str, Column]:
    """Windows over the row's position, which is a window itself."""
    clear = F.col("is_delinquent") != 1
    return {"_last_clear": history.running_max(F.when(clear, F.col("_at")), "last_clear")}


def _delinquency_values(history: History, legacy_streak: bool) -> dict[str, Column]:
    is_late = F.col("is_delinquent") == 1
    if legacy_streak:
        # Every late row of a loan shares one streak, so the length is a running count.
        streak, length = F.lit(0).cast("bigint"), F.col("_late_rows")
    else:
        # A streak is the set of late rows that follow the same number of clear rows; its
        # length so far is the distance to the last clear row.
        streak, length = F.col("_clear_rows"), F.col("_at") - F.coalesce(F.col("_last_clear"), F.lit(0))
    return {
        "delinquency_streak_id": F.when(is_late, streak),
        "consecutive_delinquent_months": F.when(is_late, length).otherwise(0).cast("int"),
        "months_since_last_delinquency": F.coalesce(
            x.month_index(history.time) - x.month_index("last_delinquent_month"), F.lit(-1)
        ),
        "delinquency_trend_6m": F.coalesce(
            F.col("max_delinquency_6m") - F.col("max_delinquency_3m"), F.lit(0)
        ),
    }


def delinquency_features(
    df: DataFrame, history: History = History(), legacy_streak: bool = False
) -> DataFrame:
    rows = df.withColumns(_delinquency_inputs()).withColumns(_delinquency_windows(history))
    rows = rows.withColumns(_position_windows(history)).withColumns(_delinquency_values(history, legacy_streak))
    return rows.drop(*HELPERS)


def running_values(history: History) -> tuple[dict[str, Column], dict[str, Column]]:
    """What the running features accumulate: (maxima, sums) over the raw columns.

    A segmented history carries these from one segment into the next.
    """
    late = F.coalesce(F.col("CURRENT_LOAN_DELINQUENCY_STATUS").cast("int"), F.lit(0)) > 0
    flag, deferral = F.col("MODIFICATION_FLAG"), F.col("PAYMENT_DEFERRAL_FLAG")
    maxima = {
        "last_delinquent_month": F.when(late, F.col(history.time)),
        "last_clear": F.when(~late, history.row_position()),
        "ever_modified": F.when(flag.isin(1, 2), 1).otherwise(0),
        "last_modification_month": F.when(flag.eqNullSafe(1), F.col(history.time)),
    }
    sums = {
        "late_rows": F.when(late, 1).otherwise(0),
        "clear_rows": F.when(late, 0).otherwise(1),
        "num_modifications": F.when(flag.eqNullSafe(1), 1).otherwise(0),
        "payment_deferral_count": F.when(deferral.isin(1, 2), 1).otherwise(0),
    }
    return maxima, sums


def _balance_windows(history: History) -> dict[str, Column]:
    return {f"_upb_{n}": history.value_before("CURRENT_ACTUAL_UPB", n) for n in (3, 6, 12)}


def _balance_changes() -> dict[str, Column]:
    # A missing earlier balance counts as no change; a missing current one stays NULL.
    return {
        f"balance_change_{n}m": F.when(
            F.col(f"_upb_{n}").isNotNull(), F.col("CURRENT_ACTUAL_UPB") - F.col(f"_upb_{n}")
        ).otherwise(0.0)
        for n in (3, 6, 12)
    }


def balance_features(df: DataFrame) -> DataFrame:
    upb, original = F.col("CURRENT_ACTUAL_UPB"), F.col("ORIGINAL_UPB")
    remaining = F.when(original > 0, upb / original).otherwise(0.0)
    return df.withColumns({"remaining_balance_pct": remaining, "principal_paid_pct": 1 - remaining})


def _interest_windows(history: History) -> dict[str, Column]:
    return {"prev_interest_rate": history.value_before("CURRENT_INTEREST_RATE", 1)}


def _interest_values() -> dict[str, Column]:
    rate, previous = F.col("CURRENT_INTEREST_RATE"), F.col("prev_interest_rate")
    moved = previous.isNotNull() | F.col("MODIFICATION_FLAG").eqNullSafe(1)
    return {"rate_reduction_after_mod": F.when(moved, previous - rate).otherwise(0.0)}


def interest_features(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "rate_change_since_origination", F.col("CURRENT_INTEREST_RATE") - F.col("ORIGINAL_INTEREST_RATE")
    )


def _modification_windows(history: History) -> dict[str, Column]:
    flag, deferral = F.col("MODIFICATION_FLAG"), F.col("PAYMENT_DEFERRAL_FLAG")
    modified = flag.eqNullSafe(1)
    return {
        "ever_modified": history.running_max(
            F.when(flag.isin(1, 2), 1).otherwise(0), "ever_modified"
        ),
        "num_modifications": history.running_sum(
            F.when(modified, 1).otherwise(0), "num_modifications"
        ),
        "last_modification_month": history.running_max(
            F.when(modified, F.col(history.time)), "last_modification_month"
        ),
        "payment_deferral_count": history.running_sum(
            F.when(deferral.isin(1, 2), 1).otherwise(0), "payment_deferral_count"
        ),
    }


def _modification_values(history: History) -> dict[str, Column]:
    since = x.month_index(history.time) - x.month_index("last_modification_month")
    return {"months_since_modification": F.coalesce(since, F.lit(-1))}


def _rolling_windows(history: History, n: int = 6) -> dict[str, Column]:
    frame = history.before(n)
    kinds = {"avg": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    return {
        f"rolling_{kind}_{suffix}_{n}m": function(column).over(frame)
        for column, suffix in ROLLING.items()
        for kind, function in kinds.items()
    }


def interaction_features(df: DataFrame) -> DataFrame:
    dti, level = F.col("ORIGINAL_DTI"), F.col("delinquency_numeric")
    return df.withColumns({
        "dti_ltv_interaction": F.coalesce(dti * F.col("ORIGINAL_LTV") / 100, F.lit(0.0)),
        "credit_dti_interaction": F.coalesce(F.col("CREDIT_SCORE") * dti / 100, F.lit(0.0)),
        "balance_delinquency_interaction": F.when(
            level > 0, F.col("CURRENT_ACTUAL_UPB") * level
        ).otherwise(0.0),
        "age_balance_interaction": F.col("LOAN_AGE") * F.col("remaining_balance_pct"),
    })


def with_windows(
    panel: DataFrame, history: History = History(), legacy_streak: bool = False,
    inputs: Mapping[str, Column] | None = None, windows: Mapping[str, Column] | None = None,
    late_windows: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The features that need a loan's other rows, and none of its static attributes.

    All windows over raw columns are in one step, those over their results in a second one, so a
    row is copied twice however many features there are.  ``inputs``, ``windows`` and
    ``late_windows`` are further columns of these steps.
    """
    first = {
        **_delinquency_windows(history), **_balance_windows(history), **_interest_windows(history),
        **_modification_windows(history), **_rolling_windows(history), **(windows or {}),
    }
    values = {
        **_balance_changes(), **_interest_values(), **_modification_values(history),
    }
    late = {**({} if legacy_streak else _position_windows(history)), **(late_windows or {})}
    rows = panel.withColumns({**_delinquency_inputs(), **(inputs or {})}).withColumns(first).withColumns(values)
    return (rows.withColumns(late) if late else rows).withColumns(_delinquency_values(history, legacy_streak)).drop(*HELPERS)


def row_features(rows: DataFrame, history: History = History()) -> DataFrame:
    """The features of single rows that carry the static attributes and the windows."""
    return (
        rows.transform(time_features, history.time).transform(balance_features)
        .transform(interest_features).transform(interaction_features)
    )


def in_order(rows: DataFrame, before: Sequence[str], after: Sequence[str] = ()) -> DataFrame:
    """The columns ``before`` the features, the features in their order, and those ``after`` them."""
    return rows.select(*dict.fromkeys([*before, *FEATURES, *after]))


def history_features(
    joined: DataFrame, history: History = History(), legacy_streak: bool = False
) -> DataFrame:
    """All feature groups on a panel that already carries the static attributes."""
    rows = row_features(with_windows(joined, history, legacy_streak), history)
    return in_order(rows, [n for n in joined.columns if n not in FEATURES])


def create_all_features(
    origination: DataFrame,
    performance: DataFrame,
    history: History = History(),
    legacy_streak: bool = False,
) -> DataFrame:
    joined = join_static(performance, origination, history.key)
    return history_features(joined, history, legacy_streak)


def features_joined_last(
    origination: DataFrame, performance: DataFrame, history: History = History(), legacy_streak: bool = False
) -> DataFrame:
    """``create_all_features`` of loans that occur once: the windows copy the columns of the panel only."""
    before = join_static(performance, origination, history.key).columns
    rows = join_static(with_windows(performance, history, legacy_streak), origination, history.key)
    return in_order(row_features(rows, history), [n for n in before if n not in FEATURES])
