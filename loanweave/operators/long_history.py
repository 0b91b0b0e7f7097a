"""Features and target for keys whose history is too long for one task.

A loan panel has one row per loan and month, so a history is a few hundred rows.  A panel
with many rows per key and month has no such bound: one key may hold a third of the table.
Those keys - and only those - are handled here:

1. every row gets its position in the history (offset of its month plus its rank inside it);
2. positions are cut into segments; the rows next to a cut are copied across it, so a
   trailing or look-ahead frame never leaves its segment;
3. running maxima and sums of earlier segments are carried in from one small table.

The ordinary feature and target functions then run per (key, segment), and the copies are
dropped.  The result is the same, row for row, as one window over the whole history.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanweave.functions.history import History
from loanweave.operators import features, target
from loanweave.operators.ranking import hash_rank

TRAILING_ROWS = 12
MAX_HISTORY_ROWS = 100_000
BROADCAST_KEYS = 1_000_000


def long_keys(panel: DataFrame, limit: int = MAX_HISTORY_ROWS, history: History = History()) -> DataFrame:
    """Keys with more than ``limit`` rows.  Counted map-side first; reads one column."""
    return (
        panel.groupBy(history.key).agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > limit).select(history.key)
    )


def add_position(panel: DataFrame, row_id: str, history: History = History()) -> DataFrame:
    """``_position``: 1-based place of the row by time, equal times in md5 order of the id.

    A key has few distinct months, so the offsets come from a small table; the rank inside
    a month is computed in hash buckets and may span any number of rows.
    """
    months = panel.groupBy(history.key, history.time).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(history.key).orderBy(history.time).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = months.select(
        history.key, history.time,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
    )
    ranked = hash_rank(panel, row_id, [history.key, history.time], name="_rank_in_month")
    return (
        ranked.join(offsets, [history.key, history.time])
        .withColumn("_position", F.col("_offset") + F.col("_rank_in_month"))
        .drop("_offset", "_rank_in_month")
    )


def add_segments(
    numbered: DataFrame, segment_rows: int, before: int = TRAILING_ROWS, after: int = target.LOOKAHEAD
) -> DataFrame:
    """``_segment`` and ``_own``; rows near a cut also appear, not owned, on its other side."""
    if segment_rows <= max(before, after):
        raise ValueError("a segment must be longer than the frames that cross its ends")
    index = F.col("_position") - 1
    segment = F.floor(index / segment_rows)
    offset = index - segment * segment_rows
    none = F.lit(None).cast("bigint")
    copies = F.array(
        segment,
        F.when(offset >= segment_rows - before, segment + 1).otherwise(none),
        F.when((offset < after) & (segment > 0), segment - 1).otherwise(none),
    )
    exploded = numbered.withColumns({
        "_home": segment, "_segment": F.explode(F.array_compact(copies)),
    })
    return exploded.withColumn("_own", F.col("_segment") == F.col("_home")).drop("_home")


def add_carries(
    rows: DataFrame, history: History, maxima: Mapping[str, Column], sums: Mapping[str, Column]
) -> DataFrame:
    """``_carry_<name>``: the running value at the end of the previous segment."""
    key, segment = history.key, history.segment
    totals = rows.filter("_own").groupBy(key, segment).agg(
        *[F.max(c).alias(n) for n, c in maxima.items()],
        *[F.sum(c).alias(n) for n, c in sums.items()],
    )
    earlier = Window.partitionBy(key).orderBy(segment).rowsBetween(Window.unboundedPreceding, -1)
    carries = totals.select(
        key, segment,
        *[F.max(n).over(earlier).alias(f"_carry_{n}") for n in maxima],
        *[F.sum(n).over(earlier).alias(f"_carry_{n}") for n in sums],
    )
    return rows.join(carries, [key, segment], "left")


def _drop_helpers(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    helpers = [n for n in df.columns if n.startswith("_carry_") or n in ("_own", "_segment", "_position")]
    return df.drop(*[n for n in helpers if n not in keep])


def segmented_features(
    joined: DataFrame, row_id: str, history: History = History(), segment_rows: int = MAX_HISTORY_ROWS,
    lookahead: int = target.LOOKAHEAD,
) -> tuple[DataFrame, History]:
    """All features per segment, copies included, and the history that describes them."""
    inside = replace(history, segment="_segment", position="_position")
    cut = add_segments(add_position(joined, row_id, history), segment_rows, after=lookahead)
    carried = add_carries(cut, inside, *features.running_values(inside))
    return features.history_features(carried, inside), inside


def segmented_dataset(
    joined: DataFrame, row_id: str, history: History = History(), segment_rows: int = MAX_HISTORY_ROWS,
    threshold: int = target.THRESHOLD_DAYS, lookahead: int = target.LOOKAHEAD,
) -> DataFrame:
    """Features and target of long histories."""
    rows, inside = segmented_features(joined, row_id, history, segment_rows, lookahead)
    ahead = target.add_lookahead(rows, threshold, lookahead, inside).filter("_own")
    observable = _drop_helpers(
        target.keep_observable(ahead), keep=("_own", "_segment", "_position")
    )
    in_default = F.when(F.col("delinquency_days") >= threshold, 1).otherwise(0)
    carried = add_carries(
        observable, inside, {"cumulative_delinquency": in_default}, {"row_num": F.lit(1)}
    )
    kept = target.keep_before_first_default(carried, threshold, lookahead, inside)
    return _drop_helpers(kept)


def all_features(
    joined: DataFrame, row_id: str | None = None, history: History = History(), max_rows: int = MAX_HISTORY_ROWS,
) -> DataFrame:
    """The features of any panel; keys beyond ``max_rows`` rows are segmented."""
    if row_id is not None:
        history = replace(history, row_id=row_id)
    short, long = _by_length(joined, row_id, history, max_rows)
    made = features.history_features(short, history)
    if long is None:
        return made
    cut, _ = segmented_features(long, row_id, history, max_rows)
    return made.unionByName(_drop_helpers(cut.filter("_own")))


def _by_length(joined: DataFrame, row_id: str | None, history: History, max_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of short histories, and those of long ones if there are any."""
    keys = long_keys(joined, max_rows, history)
    found = keys.count()
    if not found:
        return joined, None
    if row_id is None:
        raise ValueError(f"{found} keys have more than {max_rows} rows: name a row_id to order them")
    keys = F.broadcast(keys) if found <= BROADCAST_KEYS else keys
    return joined.join(keys, history.key, "left_anti"), joined.join(keys, history.key, "left_semi")


def features_and_target(
    joined: DataFrame, row_id: str | None = None, history: History = History(),
    max_rows: int | None = MAX_HISTORY_ROWS, threshold: int = target.THRESHOLD_DAYS,
    lookahead: int = target.LOOKAHEAD, origination: DataFrame | None = None,
) -> DataFrame:
    """Features and target of any panel; keys beyond ``max_rows`` rows are segmented.

    ``joined`` carries the static attributes, unless ``origination`` brings them.

    ``max_rows=None`` states that months are unique per key and skips the check.  With a
    ``row_id``, short histories order rows of equal time as the segmented ones do.
    """
    if row_id is not None:
        history = replace(history, row_id=row_id)

    def whole(rows: DataFrame) -> DataFrame:
        return target.features_with_target(rows, origination, threshold, lookahead, history)

    if max_rows is None:
        return whole(joined)
    if origination is not None:
        joined, origination = features.join_static(joined, origination, history.key), None
    short, long = _by_length(joined, row_id, history, max_rows)
    if long is None:
        return whole(short)
    cut = segmented_dataset(long, row_id, history, max_rows, threshold, lookahead)
    return whole(short).unionByName(cut)
