"""Join, window-feature, target, split and loan-level queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanweave import columns as c
from loanweave.columns import KEY, TIME
from loanweave.functions import expressions as x
from loanweave.functions.history import History
from loanweave.operators import cleaning, features, incremental, loans, ranking, splits, target
from loanweave.plans.catalog_cleaning import LOANS_CLEAN_SQL, PANEL_CLEAN_SQL
from loanweave.plans.registry import query, r6
from loanweave.session import checkpointed
from loanweave.sources import ingest

JOINED_SQL = (
    f"{LOANS_CLEAN_SQL}, {PANEL_CLEAN_SQL}, joined as (select p.*, "
    + ", ".join(
        f"l.{n}" for n in (
            "CREDIT_SCORE", "ORIGINAL_UPB", "ORIGINAL_LTV", "ORIGINAL_DTI", "ORIGINAL_CLTV",
            "ORIGINAL_INTEREST_RATE", "ORIGINAL_LOAN_TERM", "PROPERTY_STATE", "OCCUPANCY_STATUS",
            "vintage_year",
        )
    )
    + f" from panel_clean p join loans_clean l using ({KEY}))"
)
_YM = "cast(substr({0}, 1, 4) as integer) * 12 + cast(substr({0}, 5, 2) as integer)"
MONTH = _YM.format(TIME)
BASE_SQL = (
    JOINED_SQL
    + f""", base as (select *, cast(coalesce(CURRENT_LOAN_DELINQUENCY_STATUS, 0) as integer) as lvl,
  {MONTH} as mi, row_number() over (partition by {KEY} order by {TIME}) as seq from joined)"""
)
W = (
    f"window w as (partition by {KEY} order by {TIME}), "
    f"w3 as (partition by {KEY} order by {TIME} rows between 3 preceding and 1 preceding), "
    f"w6 as (partition by {KEY} order by {TIME} rows between 6 preceding and 1 preceding), "
    f"w12 as (partition by {KEY} order by {TIME} rows between 12 preceding and 1 preceding), "
    f"wc as (partition by {KEY} order by {TIME} rows between unbounded preceding and current row)"
)


def panel_query(name: str, listing: str, extra: str = "", source: str = "base", windows: str = W):
    return query(
        name,
        f"select {KEY}, {TIME}, {listing} from {source} {windows}",
        uses="loans panel",
        ctes=BASE_SQL + extra,
    )


# Single divisions, products and differences: both engines give the same bits, and rounding
# would only add ties.
UNROUNDED = {"remaining_balance_pct", "principal_paid_pct", "age_balance_interaction"}


#: SQL listings and names of all features, collected from the queries of the single ones.
FEATURE_SQL: dict[str, str] = {}
FEATURE_NAMES: dict[str, list[str]] = {}
DEVIATIONS = {f"rolling_std_{s}_6m": 4 if s == "balance" else 6 for s in features.ROLLING.values()}


def window_query(name: str, listing: str, extra: str = "", source: str = "base"):
    """A query whose Spark side is a projection of ``create_all_features``.

    Catalyst drops the windows that the projection does not use.
    """

    def register(names: str):
        names = names.split()
        FEATURE_SQL[name] = listing
        FEATURE_NAMES[name] = names

        @panel_query(name, listing, extra, source)
        def _(t):
            df = t.features()
            doubles = {n for n, kind in df.dtypes if kind == "double"} - UNROUNDED
            return df.select(KEY, TIME, *[r6(n) if n in doubles else n for n in names])

    return register


# ---------------------------------------------------------------- joins


@query(
    "jn_01_panel_with_static",
    "select * from joined",
    uses="loans panel",
    ctes=JOINED_SQL,
)
def _(t):
    joined = t.joined()
    wanted = [
        "CREDIT_SCORE", "ORIGINAL_UPB", "ORIGINAL_LTV", "ORIGINAL_DTI", "ORIGINAL_CLTV",
        "ORIGINAL_INTEREST_RATE", "ORIGINAL_LOAN_TERM", "PROPERTY_STATE", "OCCUPANCY_STATUS",
    ]
    return joined.select(*t.panel().columns, *wanted).withColumn(
        "vintage_year", x.vintage_of(KEY)
    )


_HASH = "cast(('0x' || substr(md5({0} || '#{1}'), 1, 8)) as bigint)"


def sql_hash(column: str, seed: int = 42) -> str:
    return _HASH.format(f"cast({column} as varchar)", seed)


def sql_fraction(column: str, seed: int = 42) -> str:
    return f"({sql_hash(column, seed)} / 4294967296.0)"


@query(
    "jn_02_restrict_to_loans",
    f"select {KEY}, {TIME}, CURRENT_ACTUAL_UPB from panel where {KEY} in "
    "(select " + KEY + " from loans where ORIGINAL_DTI > 40)",
    uses="loans panel",
)
def _(t):
    chosen = t.loans().filter(F.col("ORIGINAL_DTI") > 40)
    return splits.restrict_to(t.panel(), chosen).select(KEY, TIME, "CURRENT_ACTUAL_UPB")


@query(
    "jn_03_fold_frames",
    f"select {KEY}, {TIME}, case when cast(floor({sql_fraction(KEY)} * 5) as integer) = 2 "
    "then 'validation' else 'train' end as part from panel",
    uses="panel",
)
def _(t):
    folded = splits.add_fold(t.panel().select(KEY, TIME))
    train, validation = splits.fold_frames(folded, 2)
    return train.withColumn("part", F.lit("train")).unionByName(
        validation.withColumn("part", F.lit("validation"))
    )


@query(
    "jn_04_restrict_to_sample",
    f"""select {KEY}, {TIME} from panel where {KEY} in (
      select {KEY} from loans order by {sql_hash(KEY)}, {KEY} limit 300)""",
    uses="loans panel",
)
def _(t):
    sample = ranking.smallest_hash_rows(t.loans().select(KEY), 300, KEY)
    return splits.restrict_to_sample(t.panel(), sample, 300).select(KEY, TIME)


# ---------------------------------------------------------------- derived features


window_query(
    "drv_01_observation_time",
    f"cast(substr({TIME}, 1, 4) as integer) as observation_year, "
    f"cast(substr({TIME}, 5, 2) as integer) as observation_month, "
    f"cast(ceil(cast(substr({TIME}, 5, 2) as integer) / 3.0) as integer) as observation_quarter",
)("observation_year observation_month observation_quarter")
window_query(
    "drv_02_seasonality",
    f"round(sin(2 * cast(3.14159 as double) * cast(substr({TIME}, 5, 2) as integer) / 12), 6) as seasonality_sin, "
    f"round(cos(2 * cast(3.14159 as double) * cast(substr({TIME}, 5, 2) as integer) / 12), 6) as seasonality_cos",
)("seasonality_sin seasonality_cos")
window_query(
    "drv_03_age_powers",
    "round(pow(cast(LOAN_AGE as double), 2), 6) as loan_age_squared, round(pow(cast(LOAN_AGE as double), 3), 6) as loan_age_cubic",
)("loan_age_squared loan_age_cubic")
window_query(
    "drv_04_remaining_term",
    "round(case when ORIGINAL_LOAN_TERM > 0 then REMAINING_MONTHS_TO_LEGAL_MATURITY / cast(ORIGINAL_LOAN_TERM as double) else 0 end, 6) as remaining_term_pct",
)("remaining_term_pct")
_REMAINING = "(case when ORIGINAL_UPB > 0 then CURRENT_ACTUAL_UPB / ORIGINAL_UPB else cast(0 as double) end)"
window_query(
    "drv_05_balance_shares",
    f"{_REMAINING} as remaining_balance_pct, 1 - {_REMAINING} as principal_paid_pct",
)("remaining_balance_pct principal_paid_pct")
window_query(
    "drv_06_rate_change",
    "round(CURRENT_INTEREST_RATE - ORIGINAL_INTEREST_RATE, 6) as rate_change_since_origination",
)("rate_change_since_origination")
window_query(
    "drv_07_static_interactions",
    "round(coalesce(ORIGINAL_DTI * ORIGINAL_LTV / cast(100 as double), 0), 6) as dti_ltv_interaction, "
    "round(coalesce(CREDIT_SCORE * ORIGINAL_DTI / cast(100 as double), 0), 6) as credit_dti_interaction",
)("dti_ltv_interaction credit_dti_interaction")
window_query(
    "drv_08_balance_delinquency",
    "round(case when lvl > 0 then CURRENT_ACTUAL_UPB * lvl else 0 end, 6) as balance_delinquency_interaction",
)("balance_delinquency_interaction")
window_query(
    "drv_09_age_balance",
    f"LOAN_AGE * {_REMAINING} as age_balance_interaction",
)("age_balance_interaction")

# ---------------------------------------------------------------- window features


window_query("win_01_delinquency_level", "lvl as delinquency_numeric")("delinquency_numeric")
window_query(
    "win_02_max_delinquency",
    "max(lvl) over w3 as max_delinquency_3m, max(lvl) over w6 as max_delinquency_6m, max(lvl) over w12 as max_delinquency_12m",
)("max_delinquency_3m max_delinquency_6m max_delinquency_12m")
window_query(
    "win_03_mean_delinquency", "round(avg(lvl) over w6, 6) as rolling_mean_delinquency_6m"
)("rolling_mean_delinquency_6m")
window_query(
    "win_04_is_delinquent", "case when lvl > 0 then 1 else 0 end as is_delinquent"
)("is_delinquent")
window_query(
    "win_05_delinquent_months",
    "cast(sum(case when lvl > 0 then 1 else 0 end) over w12 as bigint) as num_delinquent_months_12m",
)("num_delinquent_months_12m")
_ISLANDS = (
    f", islands as (select *, case when lvl > 0 then 1 else 0 end as late, "
    f"seq - row_number() over (partition by {KEY}, lvl > 0 order by {TIME}) as island from base)"
)
window_query(
    "win_06_streaks",
    f"case when late = 1 then island end as delinquency_streak_id, "
    f"cast(case when late = 1 then row_number() over (partition by {KEY}, late, island order by {TIME}) else 0 end as integer) as consecutive_delinquent_months",
    extra=_ISLANDS,
    source="islands",
)("delinquency_streak_id consecutive_delinquent_months")


@panel_query(
    "win_06_streaks_legacy",
    "case when lvl > 0 then cast(0 as bigint) end as delinquency_streak_id, "
    "cast(case when lvl > 0 then sum(case when lvl > 0 then 1 else 0 end) over wc else 0 end as integer) as consecutive_delinquent_months",
)
def _(t):
    return features.delinquency_features(t.joined(), legacy_streak=True).select(
        KEY, TIME, "delinquency_streak_id", "consecutive_delinquent_months"
    )


_LAST_LATE = f"max(case when lvl > 0 then {TIME} end) over wc"
window_query("win_07_last_delinquent", f"{_LAST_LATE} as last_delinquent_month")(
    "last_delinquent_month"
)
window_query(
    "win_08_months_since_delinquency",
    "cast(coalesce(mi - max(case when lvl > 0 then mi end) over wc, -1) as integer) as months_since_last_delinquency",
)("months_since_last_delinquency")
window_query(
    "win_09_delinquency_trend",
    "coalesce(max(lvl) over w6 - max(lvl) over w3, 0) as delinquency_trend_6m",
)("delinquency_trend_6m")
window_query(
    "win_10_balance_change",
    ", ".join(
        f"round(case when lag(CURRENT_ACTUAL_UPB, {n}) over w is not null then CURRENT_ACTUAL_UPB - lag(CURRENT_ACTUAL_UPB, {n}) over w else 0 end, 6) as balance_change_{n}m"
        for n in (3, 6, 12)
    ),
)("balance_change_3m balance_change_6m balance_change_12m")
window_query(
    "win_11_average_balance", "round(avg(CURRENT_ACTUAL_UPB) over w6, 6) as rolling_avg_balance_6m"
)("rolling_avg_balance_6m")
window_query(
    "win_12_previous_rate", "round(lag(CURRENT_INTEREST_RATE) over w, 6) as prev_interest_rate"
)("prev_interest_rate")
window_query(
    "win_13_rate_reduction",
    "round(case when MODIFICATION_FLAG = 1 or lag(CURRENT_INTEREST_RATE) over w is not null then lag(CURRENT_INTEREST_RATE) over w - CURRENT_INTEREST_RATE else 0 end, 6) as rate_reduction_after_mod",
)("rate_reduction_after_mod")
window_query(
    "win_14_ever_modified",
    "max(case when MODIFICATION_FLAG in (1, 2) then 1 else 0 end) over wc as ever_modified",
)("ever_modified")
window_query(
    "win_15_modifications",
    "cast(sum(case when MODIFICATION_FLAG = 1 then 1 else 0 end) over wc as bigint) as num_modifications",
)("num_modifications")
window_query(
    "win_16_last_modification",
    f"max(case when MODIFICATION_FLAG = 1 then {TIME} end) over wc as last_modification_month, "
    "cast(coalesce(mi - max(case when MODIFICATION_FLAG = 1 then mi end) over wc, -1) as integer) as months_since_modification",
)("last_modification_month months_since_modification")
window_query(
    "win_17_deferrals",
    "cast(sum(case when PAYMENT_DEFERRAL_FLAG in (1, 2) then 1 else 0 end) over wc as bigint) as payment_deferral_count",
)("payment_deferral_count")
window_query(
    "win_18_rolling_extremes",
    ", ".join(
        f"round({kind}({column}) over w6, 6) as rolling_{kind}_{suffix}_6m"
        for column, suffix in features.ROLLING.items()
        for kind in ("avg", "min", "max")
    ),
)(" ".join(f"rolling_{k}_{s}_6m" for s in features.ROLLING.values() for k in ("avg", "min", "max")))


_DEVIATION_SQL = ", ".join(
    f"round(stddev_pop({column}) over w6, {4 if suffix == 'balance' else 6}) as rolling_std_{suffix}_6m"
    for column, suffix in features.ROLLING.items()
)


@panel_query("win_19_rolling_deviation", _DEVIATION_SQL)
def _(t):
    return t.features().select(KEY, TIME, *[F.round(n, d).alias(n) for n, d in DEVIATIONS.items()])


@panel_query(
    "win_20_calendar_frames",
    "max(lvl) over m6 as max_delinquency_6m, round(avg(CURRENT_ACTUAL_UPB) over m6, 6) as rolling_avg_balance_6m, "
    "round(coalesce(CURRENT_ACTUAL_UPB - max(CURRENT_ACTUAL_UPB) over m3, 0), 6) as balance_change_3m",
    windows=(
        f"window m6 as (partition by {KEY} order by mi range between 6 preceding and 1 preceding), "
        f"m3 as (partition by {KEY} order by mi range between 3 preceding and 3 preceding)"
    ),
)
def _(t):
    df = features.history_features(t.joined(), History(by="months"))
    return df.select(
        KEY, TIME, "max_delinquency_6m", r6("rolling_avg_balance_6m"), r6("balance_change_3m")
    )


# the rolling extremes hold the average balance, too
_SINGLE = [n for n in FEATURE_SQL if n != "win_11_average_balance"]
ALL_FEATURES = [*(f for n in _SINGLE for f in FEATURE_NAMES[n]), *DEVIATIONS]
ALL_FEATURES_SQL = ", ".join([*(FEATURE_SQL[n] for n in _SINGLE), _DEVIATION_SQL])


def rounded_features(df, names=None):
    """Feature columns as the SQL of the single features rounds them."""
    doubles = {n for n, kind in df.dtypes if kind == "double"} - UNROUNDED
    return [F.round(n, DEVIATIONS.get(n, 6)).alias(n) if n in doubles else F.col(n) for n in (names or ALL_FEATURES)]


@panel_query("drv_10_all_features", ALL_FEATURES_SQL, extra=_ISLANDS, source="islands")
def _(t):
    loans_, panel = t.clean()
    df = features.create_all_features(loans_, panel)
    return df.select(KEY, TIME, *rounded_features(df))


#: Months up to this one are computed first, the later ones are added.
ADDED_AFTER = "199812"


def added_months(t):
    """The state of the earlier months, written once, and what the later months add to it."""
    loans_, panel = t.clean()
    panel = checkpointed(panel)
    earlier = features.features_joined_last(loans_, panel.filter(F.col(TIME) <= ADDED_AFTER))
    state = checkpointed(incremental.state_of(earlier))
    later = features.join_static(panel.filter(F.col(TIME) > ADDED_AFTER), loans_)
    return earlier, incremental.advance(state, later, later.columns)


@panel_query("drv_12_added_months", ALL_FEATURES_SQL, extra=_ISLANDS, source="islands")
def _(t):
    earlier, step = added_months(t)
    df = earlier.unionByName(step.features)
    return df.select(KEY, TIME, *rounded_features(df))


# ---------------------------------------------------------------- target


def target_sql(threshold: int = 90, lookahead: int = 12) -> str:
    """The full target as independent SQL steps ending in ``labelled``."""
    ahead = f"(partition by {KEY} order by {TIME} rows between 1 following and {lookahead} following)"
    upto = f"(partition by {KEY} order by {TIME} rows between unbounded preceding and current row)"
    return BASE_SQL + f""",
days as (select *, case when CURRENT_LOAN_DELINQUENCY_STATUS = 10 then 999
    when CURRENT_LOAN_DELINQUENCY_STATUS between 0 and 9 then CURRENT_LOAN_DELINQUENCY_STATUS * 30 else 0 end as delinquency_days,
    case when ZERO_BALANCE_CODE is not null then 1 else 0 end as is_terminated from base),
ahead as (select *, max(case when delinquency_days >= {threshold} then 1 else 0 end) over {ahead} as target,
    max(is_terminated) over {ahead} as future_termination from days),
observable as (select * from ahead where target is not null and is_terminated = 0
    and (future_termination = 0 or target = 1)),
counted as (select *, cast(row_number() over (partition by {KEY} order by {TIME}) as integer) as row_num,
    max(case when delinquency_days >= {threshold} then 1 else 0 end) over {upto} as cumulative_delinquency from observable),
labelled as (select * from counted where row_num <= {lookahead + 1}
    and (cumulative_delinquency = 0 or (delinquency_days >= {threshold} and target = 1)))"""


def target_query(name: str, sql: str, threshold: int = 90, lookahead: int = 12):
    return query(name, sql, uses="loans panel", ctes=target_sql(threshold, lookahead))


@target_query(
    "tgt_01_delinquency_days",
    f"select {KEY}, {TIME}, cast(delinquency_days as integer) as delinquency_days from days",
)
def _(t):
    return t.clean()[1].select(KEY, TIME, target.delinquency_days().alias("delinquency_days"))


@target_query(
    "tgt_02_lookahead",
    f"select {KEY}, {TIME}, target as future_delinquency_max, target from ahead",
)
def _(t):
    return target.add_lookahead(t.joined()).select(KEY, TIME, "future_delinquency_max", "target")


@target_query(
    "tgt_03_termination",
    f"select {KEY}, {TIME}, future_termination, is_terminated from ahead",
)
def _(t):
    return target.add_lookahead(t.joined()).select(KEY, TIME, "future_termination", "is_terminated")


@target_query(
    "tgt_04_cumulative_default", f"select {KEY}, {TIME}, cumulative_delinquency from labelled"
)
def _(t):
    return t.labelled().select(KEY, TIME, "cumulative_delinquency")


@target_query("tgt_05_row_number", f"select {KEY}, {TIME}, row_num from labelled")
def _(t):
    return t.labelled().select(KEY, TIME, "row_num")


@target_query("tgt_06_target", f"select {KEY}, {TIME}, target from labelled")
def _(t):
    return t.labelled().select(KEY, TIME, "target")


@target_query(
    "tgt_08_added_months",
    f"select {KEY}, {TIME}, target, row_num, cumulative_delinquency, future_termination from labelled",
)
def _(t):
    earlier, step = added_months(t)
    names = [KEY, TIME, "target", "row_num", "cumulative_delinquency", "future_termination"]
    kept = target.create_target(earlier).join(step.redone, [KEY, TIME], "left_anti")
    return kept.select(*names).unionByName(step.target.select(*names))


@target_query(
    "tgt_06_target_30_days", f"select {KEY}, {TIME}, target from labelled", threshold=30, lookahead=6
)
def _(t):
    return t.labelled(threshold=30, lookahead=6).select(KEY, TIME, "target")


@target_query(
    "tgt_07_horizon_rows",
    f"""select {KEY}, {TIME}, count(*) over (partition by {KEY} order by {TIME}
        rows between 1 following and 12 following) as horizon_rows from base""",
)
def _(t):
    return target.add_horizon_rows(t.joined()).select(KEY, TIME, "horizon_rows")


@target_query("flt_01_observable", f"select {KEY}, {TIME}, target from observable")
def _(t):
    return target.keep_observable(target.add_lookahead(t.joined())).select(KEY, TIME, "target")


@target_query(
    "flt_02_before_first_default",
    f"select {KEY}, {TIME}, row_num, cumulative_delinquency, target from labelled",
    threshold=60,
)
def _(t):
    observable = target.keep_observable(target.add_lookahead(t.joined(), threshold=60))
    return target.keep_before_first_default(observable, threshold=60).select(
        KEY, TIME, "row_num", "cumulative_delinquency", "target"
    )


@target_query(
    "flt_04_predicate_counts",
    """select cast(count_if(target = 1) as bigint) as positive_rows,
      (select count(*) from (select max(target) as d from labelled group by LOAN_SEQUENCE_NUMBER) where d = 1) as defaulted_loans,
      (select count(*) from (select max(target) as d from labelled group by LOAN_SEQUENCE_NUMBER) where d = 0) as other_loans
    from labelled""",
)
def _(t):
    per_loan = t.labelled().groupBy(KEY).agg(
        F.sum("target").alias("positive"), F.max("target").alias("ever_defaulted")
    )
    return per_loan.agg(
        F.sum("positive").alias("positive_rows"),
        F.count_if(F.col("ever_defaulted") == 1).alias("defaulted_loans"),
        F.count_if(F.col("ever_defaulted") == 0).alias("other_loans"),
    )


_DISTRIBUTION = (
    "count(*) as total_observations, cast(count_if(target = 1) as bigint) as positive_count, "
    "cast(count_if(target <> 1) as bigint) as negative_count, "
    "round(count_if(target = 1) / cast(count(*) as double), 6) as default_rate, "
    f"count(distinct case when target = 1 then {KEY} end) as default_loans"
)


@target_query("agg_01_target_distribution", f"select {_DISTRIBUTION} from labelled")
def _(t):
    return target.target_distribution(t.labelled()).withColumn("default_rate", r6("default_rate"))


@target_query(
    "agg_01_target_by_vintage",
    f"select vintage_year, {_DISTRIBUTION} from labelled group by vintage_year",
)
def _(t):
    df = t.labelled().withColumn("vintage_year", x.vintage_of(KEY))
    return target.target_distribution(df, ("vintage_year",)).withColumn(
        "default_rate", r6("default_rate")
    )


@target_query(
    "agg_02_ever_positive", f"select {KEY}, max(target) as ever_defaulted from labelled group by {KEY}"
)
def _(t):
    return loans.ever_positive(t.labelled())


# ---------------------------------------------------------------- loan-level aggregates


@target_query("agg_04_distinct_loans", f"select distinct {KEY} from labelled")
def _(t):
    return loans.distinct_loans(t.labelled())


_SUMMARY = [n for n in c.LOAN_SUMMARY]


@target_query(
    "agg_05_loan_summary",
    f"select {KEY}, max(target) as ever_defaulted, "
    + ", ".join(f"arg_min({n}, {TIME}) filter ({n} is not null) as {n}" for n in _SUMMARY)
    + f" from labelled group by {KEY}",
)
def _(t):
    return loans.loan_summary(t.labelled().withColumn("vintage_year", x.vintage_of(KEY)))


_LATEST = "CURRENT_ACTUAL_UPB ELTV MODIFICATION_FLAG DDLPI MI_RECOVERIES LOAN_AGE".split()


@query(
    "agg_06_latest_values",
    f"select {KEY}, max({TIME}) as {TIME}, "
    + ", ".join(f"arg_max({n}, {TIME}) filter ({n} is not null) as {n}" for n in _LATEST)
    + f" from panel_clean group by {KEY}",
    uses="panel",
    ctes=PANEL_CLEAN_SQL,
)
def _(t):
    return loans.latest_values(t.clean()[1].select(KEY, TIME, *_LATEST))


@query(
    "agg_06_latest_row",
    f"select {KEY}, {TIME}, {', '.join(_LATEST)} from panel_clean "
    f"qualify row_number() over (partition by {KEY} order by {TIME} desc) = 1",
    uses="panel",
    ctes=PANEL_CLEAN_SQL,
)
def _(t):
    return loans.latest_values(t.clean()[1].select(KEY, TIME, *_LATEST), whole_row=True)


# ---------------------------------------------------------------- splits and samples


_VINTAGE = (
    f"(case when cast(substr({KEY}, 2, 2) as integer) >= 90 then 1900 else 2000 end "
    f"+ cast(substr({KEY}, 2, 2) as integer))"
)
_SPLIT = (
    f"case when {_VINTAGE} between 1999 and 2008 then case when {sql_fraction(KEY)} < 0.2 "
    f"then 'validation' else 'train' end when {_VINTAGE} between 2009 and 2012 then 'test' end"
)


@target_query(
    "smp_01_out_of_time_split",
    f"select {KEY}, {TIME}, target, {_SPLIT} as split from labelled where {_SPLIT} is not null",
)
def _(t):
    return splits.split_out_of_time(t.labelled()).select(KEY, TIME, "target", "split")


@target_query(
    "smp_01_out_of_time_split_legacy",
    f"""select {KEY}, {TIME}, case when v between 1999 and 2008 then case when {sql_fraction(KEY)} < 0.2
      then 'validation' else 'train' end else 'test' end as split
    from (select *, 2000 + cast(substr({KEY}, 2, 2) as integer) as v from labelled) where v between 1999 and 2012""",
)
def _(t):
    return splits.split_out_of_time(t.labelled(), century_pivot=None).select(KEY, TIME, "split")


@query(
    "flt_03_vintage_ranges",
    f"select {KEY}, vintage_year from loans where vintage_year between 2009 and 2012",
    uses="loans",
)
def _(t):
    split = splits.split_out_of_time(t.loans()).filter(F.col("split") == "test")
    return split.select(KEY, "vintage_year")


@query(
    "smp_02_validation_loans",
    f"select {KEY}, {sql_fraction(KEY)} < 0.2 as held_out from loans",
    uses="loans",
)
def _(t):
    return t.loans().select(KEY, (x.stable_fraction(KEY) < 0.2).alias("held_out"))


@query(
    "smp_03_folds",
    f"select {KEY}, {TIME}, cast(floor({sql_fraction(KEY)} * 5) as integer) as fold from panel",
    uses="panel",
)
def _(t):
    return splits.add_fold(t.panel().select(KEY, TIME))


@target_query(
    "smp_04_sampled_splits",
    f"""select s.{KEY}, s.{TIME}, s.split
    from (select *, {_SPLIT} as split, {sql_fraction(f"{KEY} || '|' || {TIME}")} as f from labelled where {_SPLIT} is not null) s
    join (select split, least(1.0, case split when 'train' then 2000 when 'validation' then 400 else 800 end / cast(count(*) as double)) as fraction
          from (select {_SPLIT} as split from labelled) where split is not null group by split) z using (split)
    where s.f < z.fraction""",
)
def _(t):
    df = splits.split_out_of_time(t.labelled()).select(KEY, TIME, "split")
    return splits.sample_splits(df, [KEY, TIME], train_rows=2000)


_PICK = f"order by {{0}}, {KEY} limit {{1}}"


@target_query(
    "smp_05_validation_sample",
    f"""select l.{KEY}, l.ever_defaulted, case min(tag) when 1 then 'defaulted' when 2 then 'non_defaulted' else 'random' end as sample_type
    from (select {KEY}, max(target) as ever_defaulted from labelled group by {KEY}) l join (
      (select {KEY}, 1 as tag from labelled group by {KEY} having max(target) = 1 order by {sql_hash(KEY)}, {KEY} limit 200)
      union all (select {KEY}, 2 from labelled group by {KEY} having max(target) = 0 order by {sql_hash(KEY)}, {KEY} limit 200)
      union all (select {KEY}, 3 from labelled group by {KEY} order by {sql_hash(KEY, 43)}, {KEY} limit 100)) using ({KEY})
    group by l.{KEY}, l.ever_defaulted""",
)
def _(t):
    per_loan = loans.ever_positive(t.labelled())
    return splits.validation_loans(per_loan, 200, 200, 100)


@query(
    "set_02_first_tag_wins",
    f"""select {KEY}, case min(tag) when 1 then 'defaulted' when 2 then 'non_defaulted' else 'random' end as sample_type from (
      (select {KEY}, 1 as tag from loans where ORIGINAL_DTI > 65 order by {sql_hash(KEY)}, {KEY} limit 50)
      union all (select {KEY}, 2 from loans where ORIGINAL_DTI <= 65 order by {sql_hash(KEY)}, {KEY} limit 50)
      union all (select {KEY}, 3 from loans order by {sql_hash(KEY, 43)}, {KEY} limit 400)) group by {KEY}""",
    uses="loans",
)
def _(t):
    marked = t.loans().select(KEY, (F.col("ORIGINAL_DTI") > 65).cast("int").alias("ever_defaulted"))
    return splits.validation_loans(marked, 50, 50, 400).select(KEY, "sample_type")


@target_query(
    "smp_06_aligned_sample",
    f"select {KEY}, {TIME}, target from labelled where {sql_fraction(f'''{KEY} || '|' || {TIME}''')} < 0.1",
)
def _(t):
    return splits.hash_sample(t.labelled(), 0.1, [KEY, TIME]).select(KEY, TIME, "target")


@query(
    "smp_08_stratified_folds",
    f"""select id, y_true, cast((row_number() over (partition by y_true order by {sql_hash('id')}, id)) % 3 as integer) as fold from scored""",
    uses="scored",
)
def _(t):
    return splits.add_stratified_fold(t.scored().select("id", "y_true"), "id", "y_true", 3)


@target_query(
    "agg_03_split_statistics",
    f"""select split, count(*) as observations, count(distinct {KEY}) as loans, round(avg(target), 6) as default_rate
    from (select *, {_SPLIT} as split from labelled) where split is not null group by split""",
)
def _(t):
    stats = splits.split_statistics(splits.split_out_of_time(t.labelled()))
    return stats.withColumn("default_rate", r6("default_rate"))


@query(
    "set_01_union_by_name",
    f"""select {KEY}, CREDIT_SCORE, ORIGINAL_DTI, cast(null as integer) as ORIGINAL_LTV from loans where vintage_year < 2005
    union all select {KEY}, CREDIT_SCORE, null, ORIGINAL_LTV from loans where vintage_year >= 2005""",
    uses="loans",
)
def _(t):
    early = t.loans().filter("vintage_year < 2005").select(KEY, "CREDIT_SCORE", "ORIGINAL_DTI")
    late = t.loans().filter("vintage_year >= 2005").select(KEY, "ORIGINAL_LTV", "CREDIT_SCORE")
    return ingest.union_years([early, late])


# ---------------------------------------------------------------- model input


@target_query(
    "prj_03_model_columns",
    f"select {KEY}, {TIME}, target, CURRENT_ACTUAL_UPB, LOAN_AGE, CURRENT_INTEREST_RATE, ELTV from labelled",
)
def _(t):
    df = t.labelled().select(
        "ELTV", "LOAN_AGE", "CURRENT_INTEREST_RATE", "CURRENT_ACTUAL_UPB", "row_num",
        "ZERO_BALANCE_CODE", "is_terminated", "future_termination", "delinquency_days", "DDLPI",
        "is_in_default", TIME, "target", KEY,
    )
    return loans.select_model_columns(df)


@target_query(
    "prj_05_features_and_label",
    "select CREDIT_SCORE, ORIGINAL_DTI, cast(target as bigint) as label from labelled",
)
def _(t):
    df = t.labelled().select(KEY, TIME, "target", "CREDIT_SCORE", "ORIGINAL_DTI")
    return loans.features_and_label(df)


@target_query(
    "prj_06_model_input",
    f"""select {KEY}, coalesce(cast(CREDIT_SCORE as double), 0) as CREDIT_SCORE, coalesce(ELTV, 0) as ELTV,
      coalesce(try_cast(DDLPI as double), 0) as DDLPI, coalesce(MI_RECOVERIES, 0) as MI_RECOVERIES from labelled""",
)
def _(t):
    df = t.labelled().select(
        KEY, TIME, "target", "CREDIT_SCORE", "ELTV", "DDLPI", "MI_RECOVERIES", "row_num"
    )
    return loans.model_input(df)


@target_query(
    "prj_07_align_to_model",
    f"""select {KEY}, coalesce(ELTV, 0) as ELTV, 0 as num_modifications, 'MISSING' as last_modification_month,
      coalesce(CREDIT_SCORE, 0) as CREDIT_SCORE from labelled""",
)
def _(t):
    wanted = ["ELTV", "num_modifications", "last_modification_month", "CREDIT_SCORE", "unknown_one"]
    return loans.align_to_model(t.labelled().select(KEY, "CREDIT_SCORE", "ELTV", "LOAN_AGE"), wanted, skip_unknown=True)
