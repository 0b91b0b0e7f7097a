"""Small literal histories that pin down the window semantics."""

import pytest
from pyspark.sql import functions as F

from loanweave.columns import KEY, TIME
from loanweave.functions import expressions as x
from loanweave.functions.history import History, one_row_per_month
from loanweave.operators import cleaning, features, loans, splits, target
from tests.conftest import rows


def panel(spark, *entries):
    """Rows of (loan, period, status, zero balance code)."""
    data = [(l, p, s, z, 100.0 - i, 5.0, 80.0, None, None, 1, 350) for i, (l, p, s, z) in enumerate(entries)]
    df = spark.createDataFrame(
        data,
        f"{KEY} string, {TIME} string, CURRENT_LOAN_DELINQUENCY_STATUS int, ZERO_BALANCE_CODE int, "
        "CURRENT_ACTUAL_UPB double, CURRENT_INTEREST_RATE double, ELTV double, MODIFICATION_FLAG int, "
        "PAYMENT_DEFERRAL_FLAG int, LOAN_AGE int, REMAINING_MONTHS_TO_LEGAL_MATURITY int",
    )
    return df.withColumns({
        "ORIGINAL_UPB": F.lit(200.0), "ORIGINAL_INTEREST_RATE": F.lit(4.0), "ORIGINAL_LOAN_TERM": F.lit(360),
        "ORIGINAL_DTI": F.lit(30), "ORIGINAL_LTV": F.lit(80), "CREDIT_SCORE": F.lit(700),
    })


def months(n, start=200501):
    out, year, month = [], start // 100, start % 100
    for _ in range(n):
        out.append(f"{year}{month:02d}")
        month += 1
        if month > 12:
            year, month = year + 1, 1
    return out


def test_streak_and_legacy_count(spark):
    df = panel(spark, *[("A", p, s, None) for p, s in zip(months(5), [0, 1, 0, 1, 1])])
    good = rows(features.delinquency_features(df), TIME)
    assert [r["consecutive_delinquent_months"] for r in good] == [0, 1, 0, 1, 2]
    old = rows(features.delinquency_features(df, legacy_streak=True), TIME)
    assert [r["consecutive_delinquent_months"] for r in old] == [0, 1, 0, 2, 3]
    assert [r["months_since_last_delinquency"] for r in good] == [-1, 0, 1, 0, 0]


def test_first_row_has_no_trailing_values(spark):
    df = features.history_features(panel(spark, ("A", "200501", 2, None)))
    row = rows(df)[0]
    assert row["max_delinquency_12m"] is None and row["rolling_avg_balance_6m"] is None
    assert row["balance_change_3m"] == 0 and row["delinquency_trend_6m"] == 0
    assert target.create_target(df).count() == 0


def test_rows_and_months_differ_over_a_gap(spark):
    df = panel(spark, ("A", "200501", 3, None), ("A", "200512", 0, None))
    by_rows = rows(features.delinquency_features(df), TIME)[1]
    by_months = rows(features.delinquency_features(df, History(by="months")), TIME)[1]
    assert by_rows["max_delinquency_3m"] == 3
    assert by_months["max_delinquency_3m"] is None and by_months["max_delinquency_12m"] == 3


def test_termination_without_default_is_dropped(spark):
    quiet = [("A", p, 0, 1 if i == 4 else None) for i, p in enumerate(months(5))]
    broken = [("B", p, 3 if i == 3 else 0, 1 if i == 4 else None) for i, p in enumerate(months(5))]
    got = rows(target.create_target(panel(spark, *quiet, *broken)), KEY, TIME)
    assert {r[KEY] for r in got} == {"B"}
    assert [r["target"] for r in got] == [1, 1, 1]


def test_full_horizon_option(spark):
    df = panel(spark, *[("A", p, 0, None) for p in months(15)])
    assert target.create_target(df).count() == 13
    assert target.create_target(df, require_full_horizon=True).count() == 3


def test_only_first_rows_are_eligible(spark):
    df = panel(spark, *[("A", p, 0, None) for p in months(40)])
    got = rows(target.create_target(df, lookahead=6), TIME)
    assert [r["row_num"] for r in got] == list(range(1, 8))


def test_relief_flag_and_legacy_ltv(spark):
    df = spark.createDataFrame(
        [("a", 120, "Y"), ("b", 120, "N"), ("c", 80, None), ("d", 999, "Y"), ("e", 5, None)],
        f"{KEY} string, ORIGINAL_LTV int, RELIEF_REFINANCE_INDICATOR string",
    )
    good = [r["ORIGINAL_LTV"] for r in rows(cleaning.clean_origination(df), KEY)]
    old = [r["ORIGINAL_LTV"] for r in rows(cleaning.clean_origination(df, legacy=True), KEY)]
    assert good == [120, None, 80, None, None] and old == [120, None, None, None, None]


def test_century_pivot(spark):
    df = spark.createDataFrame([("F99Q1",), ("F05Q1",)], f"{KEY} string")
    got = rows(df.select(KEY, x.vintage_of(KEY).alias("v"), x.vintage_of(KEY, None).alias("old")), KEY)
    assert [(r["v"], r["old"]) for r in got] == [(2005, 2005), (1999, 2099)]


def test_extended_status(spark):
    df = spark.createDataFrame([("0",), ("14",), ("RA",), ("XX",), (None,)], "s string")
    got = [r["v"] for r in rows(df.select(cleaning.delinquency_code("s", True).alias("v")))]
    assert got == [0, 14, 999, None, None]
    days = rows(
        spark.createDataFrame([(14,), (999,)], "CURRENT_LOAN_DELINQUENCY_STATUS int").select(
            target.delinquency_days(reo_code=999).alias("d")
        )
    )
    assert [r["d"] for r in days] == [420, 999]


def test_duplicate_months_are_reported(spark):
    df = panel(spark, ("A", "200501", 0, None), ("A", "200501", 0, None), ("B", "200501", 0, None))
    assert [r[KEY] for r in rows(one_row_per_month(df))] == ["A"]


def test_latest_value_per_column_and_whole_row(spark):
    df = spark.createDataFrame(
        [("A", "200501", 1, None), ("A", "200502", None, None), ("A", "200503", None, 7)],
        f"{KEY} string, {TIME} string, a int, b int",
    )
    assert rows(loans.latest_values(df))[0] == {KEY: "A", TIME: "200503", "a": 1, "b": 7}
    assert rows(loans.latest_values(df, whole_row=True))[0]["a"] is None


def test_latest_for_falls_back(spark):
    schema = f"{KEY} string, {TIME} string, a int"
    sample = spark.createDataFrame([("B",)], f"{KEY} string")
    small = spark.createDataFrame([("A", "200501", 1)], schema)
    full = spark.createDataFrame([("A", "200501", 1), ("B", "200501", 2)], schema)
    assert rows(loans.latest_for(sample, small, full, 1))[0]["a"] == 2


def test_splits_are_disjoint_and_complete(spark):
    ids = [(f"F{y:02d}Q1{i:05d}", f"2005{m:02d}", 0) for y in (99, 3, 8, 9, 12, 15) for i in range(40) for m in (1, 2)]
    df = spark.createDataFrame(ids, f"{KEY} string, {TIME} string, target int")
    got = splits.split_out_of_time(df)
    per_loan = got.groupBy(KEY).agg(F.count_distinct("split").alias("n"))
    assert per_loan.filter("n > 1").isEmpty()
    assert got.count() == 5 * 80
    assert got.filter("split = 'validation'").count() > 0
    train, validation = splits.fold_frames(splits.add_fold(df, 3), 0)
    assert train.count() + validation.count() == df.count()
    assert train.columns == df.columns


def test_stable_hash_ignores_layout(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    a = rows(df.repartition(7).filter(x.stable_fraction("k") < 0.3), "k")
    b = rows(df.coalesce(1).filter(x.stable_fraction("k") < 0.3), "k")
    assert a == b and 200 < len(a) < 400


@pytest.mark.parametrize("by", ["weeks", ""])
def test_unknown_frame_unit(by):
    with pytest.raises(ValueError):
        History(by=by)
