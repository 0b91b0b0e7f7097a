"""Look-ahead default target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanweave.columns import KEY, TARGET
from loanweave.functions import expressions as x
from loanweave.functions.history import History
from loanweave.operators import features

LOOKAHEAD = 12
THRESHOLD_DAYS = 90
REO_DAYS = 999


def delinquency_days(status="CURRENT_LOAN_DELINQUENCY_STATUS", reo_code: int = 10) -> Column:
    """Days past due from the encoded status; REO counts as 999, unknown as 0."""
    code = x.as_column(status)
    known = code.between(0, reo_code - 1)
    return (
        F.when(code == reo_code, REO_DAYS).when(known, code * 30).otherwise(0).cast("int")
    )


def status_columns(reo_code: int = 10) -> dict[str, Column]:
    ended = F.when(F.col("ZERO_BALANCE_CODE").isNotNull(), 1).otherwise(0)
    return {"delinquency_days": delinquency_days(reo_code=reo_code), "is_terminated": ended}


def lookahead_windows(threshold: int, lookahead: int, history: History) -> dict[str, Column]:
    ahead, reached = history.after(lookahead), F.when(F.col("delinquency_days") >= threshold, 1).otherwise(0)
    return {
        "future_delinquency_max": F.max(reached).over(ahead),
        "future_termination": F.max("is_terminated").over(ahead),
    }


def add_lookahead(
    df: DataFrame,
    threshold: int = THRESHOLD_DAYS,
    lookahead: int = LOOKAHEAD,
    history: History = History(),
    reo_code: int = 10,
) -> DataFrame:
    """Whether the following rows contain a default or a termination.

    The columns are NULL on a loan's last row, which has nothing to look at.
    """
    rows = df.withColumns(status_columns(reo_code)).withColumns(lookahead_windows(threshold, lookahead, history))
    return rows.withColumn(TARGET, F.col("future_delinquency_max"))


def add_horizon_rows(
    df: DataFrame, lookahead: int = LOOKAHEAD, history: History = History()
) -> DataFrame:
    """How many rows the look-ahead actually saw (``lookahead`` when complete)."""
    return df.withColumn("horizon_rows", F.count(F.lit(1)).over(history.after(lookahead)))


def _observable(outcome: Column) -> Column:
    return (
        F.col("future_delinquency_max").isNotNull()
        & (F.col("is_terminated") == 0)
        & ((F.col("future_termination") == 0) | (outcome == 1))
    )


def observable() -> Column:
    """Rows whose outcome is known: not ended, and not ending without a default."""
    return _observable(F.col(TARGET))


def keep_observable(df: DataFrame) -> DataFrame:
    return df.filter(observable())


def keep_before_first_default(
    df: DataFrame,
    threshold: int = THRESHOLD_DAYS,
    lookahead: int = LOOKAHEAD,
    history: History = History(),
) -> DataFrame:
    """Rows before the first default, plus defaulted rows that will default again.

    Only each loan's first ``lookahead + 1`` observable rows are eligible; ``row_num``
    therefore counts the rows that ``keep_observable`` let through.
    """
    in_default = F.when(F.col("delinquency_days") >= threshold, 1).otherwise(0)
    df = df.withColumn("is_in_default", in_default).withColumns({
        "row_num": history.running_sum(F.lit(1), "row_num").cast("int"),
        "cumulative_delinquency": history.running_max(F.col("is_in_default"), "cumulative_delinquency"),
    })
    return df.filter(eligible(lookahead))


def eligible(lookahead: int = LOOKAHEAD) -> Column:
    fresh = F.col("cumulative_delinquency") == 0
    repeated = (F.col("is_in_default") == 1) & (F.col(TARGET) == 1)
    return (fresh | repeated) & (F.col("row_num") <= lookahead + 1)


def features_with_target(
    panel: DataFrame, origination: DataFrame | None = None, threshold: int = THRESHOLD_DAYS,
    lookahead: int = LOOKAHEAD, history: History = History(),
) -> DataFrame:
    """``create_target`` of all features in one plan of two window steps.

    Windows need no static attributes.  With ``origination`` these are joined to the rows that
    are left after the target, so that the windows copy the columns of the panel only; without
    it ``panel`` carries them.
    """
    before = (panel if origination is None else features.join_static(panel, origination, history.key)).columns
    names = [
        "delinquency_days", "is_terminated", "future_delinquency_max", "future_termination", TARGET,
        "is_in_default", "row_num", "cumulative_delinquency",
    ]
    in_default = F.when(F.col("delinquency_days") >= threshold, 1).otherwise(0)
    known = _observable(F.col("future_delinquency_max"))
    rows = features.with_windows(
        panel, history, inputs=status_columns(), windows=lookahead_windows(threshold, lookahead, history),
        late_windows={
            # rows that are not observable count for neither, and are dropped below
            "row_num": history.running_sum(F.when(known, 1).otherwise(0), "row_num").cast("int"),
            "cumulative_delinquency": history.running_max(F.when(known, in_default), "cumulative_delinquency"),
        },
    ).withColumns({TARGET: F.col("future_delinquency_max"), "is_in_default": in_default})
    rows = rows.filter(observable()).filter(eligible(lookahead))
    if origination is not None:
        rows = features.join_static(rows, origination, history.key)
    return features.in_order(
        features.row_features(rows, history), [n for n in before if n not in (*features.FEATURES, *names)], names
    )


def create_target(
    df: DataFrame,
    threshold: int = THRESHOLD_DAYS,
    lookahead: int = LOOKAHEAD,
    history: History = History(),
    require_full_horizon: bool = False,
    reo_code: int = 10,
) -> DataFrame:
    df = add_lookahead(df, threshold, lookahead, history, reo_code)
    if require_full_horizon:
        df = add_horizon_rows(df, lookahead, history).filter(
            (F.col("horizon_rows") == lookahead) | (F.col(TARGET) == 1)
        ).drop("horizon_rows")
    return keep_before_first_default(keep_observable(df), threshold, lookahead, history)


def target_distribution(df: DataFrame, by: tuple[str, ...] = (), key: str = KEY) -> DataFrame:
    """Rows, positives, negatives, default rate and loans that ever default: one job."""
    positive = F.col(TARGET) == 1
    return (
        df.groupBy(*by)
        .agg(
            F.count("*").alias("total_observations"),
            F.coalesce(F.sum(positive.cast("int")), F.lit(0)).cast("bigint").alias("positive_count"),
            F.count_distinct(F.when(positive, F.col(key))).alias("default_loans"),
        )
        .withColumns({
            "negative_count": F.col("total_observations") - F.col("positive_count"),
            "default_rate": x.share(F.col("positive_count"), F.col("total_observations")),
        })
    )
