"""Features and target of new months, without computing the old ones again.

A state row per loan holds what the next months need: its last rows with their features, how
many rows it has had, the running maxima and sums behind them, and what the target knows of
the rows that no later month can change.  Trailing features of a new month look into the kept
rows, running features start from the carried values, and the look-ahead target is made anew
only for the kept rows, whose following months were not all there yet.

``advance`` on an empty state is the full computation, and feeding months in any number of
steps gives the same rows as feeding them at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from loanweave.columns import TARGET
from loanweave.functions.history import History
from loanweave.operators import features, target
from loanweave.operators.long_history import TRAILING_ROWS

_TARGET_CARRIES = ("row_num", "cumulative_delinquency")


@dataclass(frozen=True)
class Advance:
    """Rows that new months add or change, and the state after them.

    ``features``: the new rows.  ``target``: the modelling rows among the new and the redone
    ones, and ``redone`` names all of these by key and time, so that rows which are no longer
    observable can go.  ``state``: the loans that had new months.
    """

    features: DataFrame
    target: DataFrame
    redone: DataFrame
    state: DataFrame


def _carried(history: History) -> tuple[list[str], list[str]]:
    maxima, sums = features.running_values(replace(history, position="_position"))
    return list(maxima), list(sums)


def state_schema(feature_schema: StructType, history: History = History()) -> str:
    """DDL of a state for feature rows of this schema."""
    maxima, sums = _carried(history)
    kinds = {f.name: f.dataType.simpleString() for f in feature_schema.fields}
    kind = {"last_delinquent_month": kinds[history.time], "last_modification_month": kinds[history.time], "last_clear": "bigint"}
    columns = [
        f"`{history.key}` {kinds[history.key]}", "`_position` bigint", f"`_last` {kinds[history.time]}",
        *[f"`_carry_{n}` {kind.get(n, 'int')}" for n in maxima], *[f"`_carry_{n}` bigint" for n in sums],
        "`_carry_row_num` bigint", "`_carry_cumulative_delinquency` int", f"`_tail` array<{feature_schema.simpleString()}>",
    ]
    return ", ".join(columns)


def _tail_rows(state: DataFrame, carries: Sequence[str]) -> DataFrame:
    """The kept rows of the given loans, with positions and carried values."""
    first = F.col("_position") - F.size("_tail") + 1
    return state.select(first.alias("_first"), *carries, F.posexplode("_tail").alias("_at", "_row")).select(
        "_row.*", *carries, (F.col("_first") + F.col("_at")).alias("_position"), F.lit(False).alias("_own")
    )


def late_rows(state: DataFrame, new: DataFrame, history: History = History()) -> DataFrame:
    """New rows that do not follow their loan's last month; ``advance`` needs none of them."""
    last = state.select(history.key, "_last")
    return new.join(last, history.key).filter(F.col(history.time) <= F.col("_last")).drop("_last")


def advance(
    state: DataFrame, joined: DataFrame, raw_columns: Sequence[str], history: History = History(),
    threshold: int = target.THRESHOLD_DAYS, lookahead: int = target.LOOKAHEAD,
) -> Advance:
    """Features, target and state after the new months in ``joined``.

    ``joined`` is the cleaned panel of the new months with its loans' static attributes, one
    row per loan and month, all later than what the state has seen; ``raw_columns`` are its
    columns.  Frames are measured in rows.  Loans without new months do not appear.
    """
    if history.by != "rows":
        raise ValueError("a state keeps a number of rows, so frames have to be measured in rows")
    key, time = history.key, history.time
    kept_rows = max(TRAILING_ROWS, lookahead)
    inside = replace(history, segment="_segment", position="_position")
    maxima, sums = _carried(history)
    carries = [f"_carry_{n}" for n in (*maxima, *sums, *_TARGET_CARRIES)]

    order = Window.partitionBy(key).orderBy(time)
    before = state.select(key, F.col("_position").alias("_seen"), *carries)
    fresh = joined.select(*raw_columns).join(before, key, "left").select(
        *raw_columns, *carries,
        (F.coalesce("_seen", F.lit(0)) + F.row_number().over(order)).alias("_position"), F.lit(True).alias("_own"),
    )
    touched = state.join(joined.select(key).distinct(), key, "left_semi")
    tail = _tail_rows(touched, carries)
    raw_tail = tail.select(*raw_columns, *carries, "_position", "_own")
    rows = raw_tail.unionByName(fresh).withColumn("_segment", F.lit(0))
    made = features.history_features(rows, inside).filter("_own")
    helpers = [*carries, "_position", "_own", "_segment"]
    feature_columns = [n for n in made.columns if n not in helpers]

    # the target looks ahead from the kept rows over the new ones
    both = tail.select(*feature_columns, *carries, "_position", "_own").unionByName(
        made.select(*feature_columns, *carries, "_position", "_own")
    ).withColumns({"_segment": F.lit(0), "_new": F.col("_own"), "_own": F.lit(True)})
    last = F.max("_position").over(Window.partitionBy(key, "_segment"))
    ahead = target.add_lookahead(both, threshold, lookahead, inside).withColumn("_left", last - F.col("_position"))
    labelled = target.keep_before_first_default(target.keep_observable(ahead), threshold, lookahead, inside)
    return Advance(
        made.select(*feature_columns),
        labelled.drop(*carries, "_position", "_own", "_segment", "_new", "_left"),
        both.select(key, time),
        _next_state(ahead, feature_columns, history, threshold, kept_rows),
    )


def _next_state(rows: DataFrame, feature_columns: Sequence[str], history: History, threshold: int, kept_rows: int) -> DataFrame:
    """Per loan: its last rows, and what all rows before them and the running features add up to.

    ``_left`` is the number of rows that follow a row.
    """
    key, time = history.key, history.time
    maxima, sums = features.running_values(replace(history, position="_position"))
    settled = target.observable() & (F.col("_left") >= kept_rows)
    in_default = F.when(F.col("delinquency_days") >= threshold, 1).otherwise(0)
    row = F.struct("_position", F.struct(*feature_columns).alias("row"))

    def carry(n: str):
        return F.max(f"_carry_{n}")

    latest = rows.groupBy(key).agg(
        F.max("_position").alias("_position"), F.max(time).alias("_last"),
        *[F.greatest(F.max(F.when(F.col("_new"), c)), carry(n)).alias(f"_carry_{n}") for n, c in maxima.items()],
        *[
            (F.coalesce(F.sum(F.when(F.col("_new"), c)), F.lit(0)) + F.coalesce(carry(n), F.lit(0))).cast("bigint").alias(f"_carry_{n}")
            for n, c in sums.items()
        ],
        (F.count_if(settled) + F.coalesce(carry("row_num"), F.lit(0))).cast("bigint").alias("_carry_row_num"),
        F.greatest(F.max(F.when(settled, in_default)), carry("cumulative_delinquency")).alias("_carry_cumulative_delinquency"),
        F.array_sort(F.collect_list(F.when(F.col("_left") < kept_rows, row))).alias("_rows"),
    )
    return latest.select(*[n for n in latest.columns if n != "_rows"], F.col("_rows.row").alias("_tail"))


def state_of(
    rows: DataFrame, history: History = History(), threshold: int = target.THRESHOLD_DAYS, lookahead: int = target.LOOKAHEAD,
) -> DataFrame:
    """The state after a features table that was built whole.

    All its windows are one step in the order of the features, so wide rows are copied once more
    and not sorted again.
    """
    maxima, sums = _carried(history)
    kinds = dict(rows.dtypes)
    kind = {"last_delinquent_month": kinds[history.time], "last_modification_month": kinds[history.time], "last_clear": "bigint"}
    none = {f"_carry_{n}": F.lit(None).cast(kind.get(n, "int")) for n in (*maxima, "cumulative_delinquency")}
    none |= {f"_carry_{n}": F.lit(None).cast("bigint") for n in (*sums, "row_num")}
    all_rows = history.ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    position = F.row_number().over(history.ordered).cast("bigint")
    numbered = rows.withColumns(target.status_columns()).withColumns({
        "_position": position, "_left": F.count(F.lit(1)).over(all_rows) - position,
        **target.lookahead_windows(threshold, lookahead, history),
    })
    ahead = numbered.withColumns({TARGET: F.col("future_delinquency_max"), "_new": F.lit(True), **none})
    return _next_state(ahead, rows.columns, history, threshold, max(TRAILING_ROWS, lookahead))


def empty_state(joined: DataFrame, history: History = History()) -> DataFrame:
    """The state before the first month of a panel with these columns."""
    schema = features.history_features(joined, history).schema
    return joined.sparkSession.createDataFrame([], state_schema(schema, history))


def merged_state(state: DataFrame, touched: DataFrame, history: History = History()) -> DataFrame:
    """The state of all loans after an advance."""
    return state.join(touched.select(history.key), history.key, "left_anti").select(*touched.columns).unionByName(touched)
