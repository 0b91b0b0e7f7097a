"""Segmented histories must equal one window over the whole history, row for row."""

import pytest
from pyspark.sql import functions as F

from loanweave.columns import KEY, TIME
from loanweave.functions.history import History
from loanweave.operators import features, long_history, target
from loanweave.plans.adapters import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def joined(spark):
    """Every customer of one nation becomes one loan, so its months repeat."""
    loans, panel = Tables(spark, SF).clean()
    df = features.join_static(panel, loans)
    row_id = F.concat_ws("|", KEY, TIME)
    hot = F.when(F.substring(KEY, 4, 2) < "Q3", F.lit("F05Q1HOTLOAN")).otherwise(F.col(KEY))
    return df.withColumn("row_id", row_id).withColumn(KEY, hot).cache()


def as_set(df, names):
    rounded = [
        F.round(n, 6).alias(n) if dict(df.dtypes)[n] == "double" else F.col(n) for n in names
    ]
    return sorted(map(repr, df.select(*rounded).collect()))


def whole(joined):
    """The same order (time, then md5 of the id), but one window per key."""
    numbered = long_history.add_position(joined, "row_id")
    history = History(position="_position")
    rows = features.history_features(numbered, history)
    return rows, target.create_target(rows, history=history)


def test_position_is_a_permutation(joined):
    numbered = long_history.add_position(joined, "row_id")
    bad = numbered.groupBy(KEY).agg(
        F.count("*").alias("n"), F.count_distinct("_position").alias("d"), F.max("_position").alias("m")
    ).filter("n <> d or n <> m")
    assert bad.isEmpty()


def test_segments_give_the_same_features(joined):
    expected, _ = whole(joined)
    got, _ = long_history.segmented_features(joined, "row_id", segment_rows=13)
    got = got.filter("_own")
    names = [n for n in expected.columns if not n.startswith("_")]
    assert as_set(got, names) == as_set(expected, names)


def test_segments_give_the_same_target(joined):
    _, expected = whole(joined)
    got = long_history.segmented_dataset(joined, "row_id", segment_rows=20)
    names = [n for n in expected.columns if not n.startswith("_")]
    assert set(got.columns) == set(names)
    assert as_set(got, names) == as_set(expected, names)


def test_only_long_keys_are_segmented(joined):
    _, expected = whole(joined)
    got = long_history.features_and_target(joined, "row_id", max_rows=50)
    names = [n for n in got.columns]
    assert as_set(got, names) == as_set(expected, names)


def test_row_id_is_needed_for_long_keys(joined):
    with pytest.raises(ValueError, match="row_id"):
        long_history.features_and_target(joined, max_rows=50)


def test_segment_longer_than_frames(joined):
    with pytest.raises(ValueError):
        long_history.add_segments(joined.withColumn("_position", F.lit(1)), 12)
