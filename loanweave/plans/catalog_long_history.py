"""Queries over a pooled panel, whose keys hold many rows per month.

All loans of a vintage become one entity, so that a handful of keys hold all rows.  With the
row limit below every history is segmented; the SQL uses one window over each whole history.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loanweave.columns import KEY, TIME
from loanweave.operators import long_history
from loanweave.plans.catalog_panel import JOINED_SQL, MONTH, sql_hash
from loanweave.plans.registry import query, r6
from loanweave.session import checkpointed

MAX_ROWS = 100

_W = f"partition by {KEY} order by {TIME}, h, row_id"
_FEATURES = f"""pooled as (select * replace (substr({KEY}, 1, 3) as {KEY}), {KEY} || '|' || {TIME} as row_id from joined),
keyed as (select *, {sql_hash('row_id')} as h, {MONTH} as mi, cast(coalesce(CURRENT_LOAN_DELINQUENCY_STATUS, 0) as integer) as lvl from pooled),
placed as (select *, row_number() over ({_W}) as pos,
    row_number() over ({_W}) - row_number() over (partition by {KEY}, lvl > 0 order by {TIME}, h, row_id) as island from keyed),
featured as (select *,
    max(lvl) over rows12 as max_delinquency_12m,
    cast(sum(case when lvl > 0 then 1 else 0 end) over rows12 as bigint) as num_delinquent_months_12m,
    cast(case when lvl > 0 then row_number() over (partition by {KEY}, lvl > 0, island order by pos) else 0 end as integer) as consecutive_delinquent_months,
    cast(coalesce(mi - max(case when lvl > 0 then mi end) over upto, -1) as integer) as months_since_last_delinquency,
    cast(sum(case when MODIFICATION_FLAG = 1 then 1 else 0 end) over upto as bigint) as num_modifications,
    cast(sum(case when PAYMENT_DEFERRAL_FLAG in (1, 2) then 1 else 0 end) over upto as bigint) as payment_deferral_count,
    round(avg(CURRENT_ACTUAL_UPB) over rows6, 6) as rolling_avg_balance_6m,
    round(lag(CURRENT_INTEREST_RATE) over upto, 6) as prev_interest_rate
  from placed window rows12 as ({_W} rows between 12 preceding and 1 preceding), rows6 as ({_W} rows between 6 preceding and 1 preceding),
    upto as ({_W} rows between unbounded preceding and current row))"""
_TARGET = f"""late as (select *, case when CURRENT_LOAN_DELINQUENCY_STATUS = 10 then 999 else coalesce(CURRENT_LOAN_DELINQUENCY_STATUS, 0) * 30 end as late_days,
    case when ZERO_BALANCE_CODE is not null then 1 else 0 end as ended from featured),
ahead as (select *, max(case when late_days >= 90 then 1 else 0 end) over nxt as target, max(ended) over nxt as ends
  from late window nxt as (partition by {KEY} order by pos rows between 1 following and 12 following)),
seen as (select *, cast(row_number() over (partition by {KEY} order by pos) as integer) as row_num,
    max(case when late_days >= 90 then 1 else 0 end) over (partition by {KEY} order by pos rows between unbounded preceding and current row) as hit
  from ahead where target is not null and ended = 0 and (ends = 0 or target = 1)),
kept as (select * from seen where row_num <= 13 and (hit = 0 or (late_days >= 90 and target = 1)))"""

INTEGERS = (
    "max_delinquency_12m num_delinquent_months_12m consecutive_delinquent_months "
    "months_since_last_delinquency num_modifications payment_deferral_count"
).split()
DOUBLES = ["rolling_avg_balance_6m", "prev_interest_rate"]


def _pooled(t):
    """Written once: counting the keys, positions and carries read the rows several times."""
    return checkpointed(t.joined().withColumn("row_id", F.concat_ws("|", KEY, TIME)).withColumn(
        KEY, F.substring(KEY, 1, 3)
    ))


@query(
    "win_21_long_history_features",
    f"select {KEY}, row_id, {', '.join(INTEGERS + DOUBLES)} from featured",
    uses="loans panel",
    ctes=f"{JOINED_SQL}, {_FEATURES}",
)
def _(t):
    rows, _ = long_history.segmented_features(_pooled(t), "row_id", segment_rows=MAX_ROWS)
    return rows.filter("_own").select(KEY, "row_id", *INTEGERS, *[r6(n) for n in DOUBLES])


@query(
    "tgt_08_long_history_target",
    f"select {KEY}, row_id, row_num, target, consecutive_delinquent_months from kept",
    uses="loans panel",
    ctes=f"{JOINED_SQL}, {_FEATURES}, {_TARGET}",
)
def _(t):
    return long_history.features_and_target(_pooled(t), "row_id", max_rows=MAX_ROWS).select(
        KEY, "row_id", "row_num", "target", "consecutive_delinquent_months"
    )
