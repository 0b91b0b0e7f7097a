"""Scalar-function queries and the flagship report."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanweave.columns import KEY, TIME
from loanweave.functions import expressions as x
from loanweave.functions.history import History
from loanweave.operators import features, importance, metrics, profile, scoring, splits, target
from loanweave.plans.catalog_metrics import POINTS, THRESHOLD, _round, band_sql, report_sql, rounded, rows_sql
from loanweave.plans.catalog_panel import W, sql_fraction, sql_hash, target_sql
from loanweave.plans.catalog_profile import COLUMNS, PROFILE_SQL
from loanweave.plans.registry import query, r6


def vintage_report(t):
    """Default rate and average trailing delinquency per vintage."""
    joined = t.joined()
    worst = F.max(F.coalesce("CURRENT_LOAN_DELINQUENCY_STATUS", F.lit(0))).over(History().before(6))
    rows = target.create_target(joined.withColumn("max_delinquency_6m", worst))
    return (
        rows.groupBy(x.vintage_of(KEY).alias("vintage_year"))
        .agg(
            F.count("*").alias("observations"),
            F.sum("target").alias("defaults"),
            F.avg("target").alias("default_rate"),
            F.avg("max_delinquency_6m").alias("avg_max_delinquency_6m"),
            F.avg("CREDIT_SCORE").alias("avg_credit_score"),
        )
        .withColumns({
            n: F.round(n, 6) for n in ("default_rate", "avg_max_delinquency_6m", "avg_credit_score")
        })
    )


_WORST = (
    f"base as (select *, max(lvl) over (partition by {KEY} order by {TIME} "
    "rows between 6 preceding and 1 preceding) as worst from base0)"
)


@query(
    "flagship_vintage_report",
    "select vintage_year, count(*) as observations, cast(sum(target) as bigint) as defaults, round(avg(target), 6) as default_rate, "
    "round(avg(worst), 6) as avg_max_delinquency_6m, round(avg(CREDIT_SCORE), 6) as avg_credit_score from labelled group by vintage_year",
    uses="loans panel",
    ctes=target_sql().replace(", base as (", ", base0 as (", 1).replace(",\ndays as (", f", {_WORST},\ndays as (", 1),
)
def _(t):
    return vintage_report(t)


# ---------------------------------------------------------------- scalar functions


@query(
    "fn_01_text",
    f"select {KEY}, substr({KEY}, 2, 2) as vintage_digits, length(POSTAL_CODE) as postal_length, "
    "concat(substr(POSTAL_CODE, 1, 3), '00') as masked from loans",
    uses="loans",
)
def _(t):
    return t.loans().select(
        KEY, F.substring(KEY, 2, 2).alias("vintage_digits"),
        F.length("POSTAL_CODE").cast("bigint").alias("postal_length"),
        F.concat(F.substring("POSTAL_CODE", 1, 3), F.lit("00")).alias("masked"),
    )


@query(
    "fn_02_casts",
    f"select {KEY}, {TIME}, try_cast(CURRENT_LOAN_DELINQUENCY_STATUS as integer) as status, try_cast(DDLPI as double) as ddlpi from panel",
    uses="panel",
)
def _(t):
    return t.panel().select(
        KEY, TIME, F.col("CURRENT_LOAN_DELINQUENCY_STATUS").try_cast("int").alias("status"),
        F.col("DDLPI").try_cast("double").alias("ddlpi"),
    )


@query(
    "fn_03_conditions",
    f"""select {KEY}, {TIME}, case when MODIFICATION_FLAG in ('Y', 'P') then 1 else 0 end as modified,
      coalesce(LOAN_AGE, -9) as age, MI_RECOVERIES is null as no_recovery, isnan(MI_RECOVERIES) as bad_recovery,
      CURRENT_INTEREST_RATE between 0 and 30 as valid_rate from panel""",
    uses="panel",
)
def _(t):
    return t.panel().select(
        KEY, TIME, F.when(F.col("MODIFICATION_FLAG").isin("Y", "P"), 1).otherwise(0).alias("modified"),
        F.coalesce("LOAN_AGE", F.lit(-9)).alias("age"),
        F.col("MI_RECOVERIES").isNull().alias("no_recovery"),
        F.when(F.col("MI_RECOVERIES").isNotNull(), F.isnan("MI_RECOVERIES")).alias("bad_recovery"),
        F.col("CURRENT_INTEREST_RATE").between(0, 30).alias("valid_rate"),
    )


@query(
    "fn_04_math",
    f"""select {KEY}, round(ORIGINAL_UPB / 1000.0::double) * 1000 as rounded_upb, cast(ceil(ORIGINAL_DTI / 3.0::double) as bigint) as third,
      round(sqrt(ORIGINAL_LTV), 6) as root, round(pow(ORIGINAL_DTI::double, 3), 6) as cube, round(sin(ORIGINAL_DTI), 6) as sine, round(cos(ORIGINAL_DTI), 6) as cosine from loans""",
    uses="loans",
)
def _(t):
    return t.loans().select(
        KEY, x.round_to("ORIGINAL_UPB", 1000).alias("rounded_upb"),
        F.ceil(F.col("ORIGINAL_DTI") / 3).alias("third"),
        r6(F.sqrt("ORIGINAL_LTV"), "root"), r6(F.pow("ORIGINAL_DTI", F.lit(3)), "cube"),
        r6(F.sin("ORIGINAL_DTI"), "sine"), r6(F.cos("ORIGINAL_DTI"), "cosine"),
    )


@query(
    "fn_05_log_exp_clip",
    """select id, round(ln(least(0.9::double, greatest(0.1::double, y_proba))), 6) as clipped_log, round(exp(y_proba), 6) as e,
      round_even(y_proba * 10 - 0.5, 0) as half_even from tied""",
    uses="tied",
)
def _(t):
    p = F.col("y_proba")
    return t.tied().select(
        "id", r6(F.ln(F.least(F.lit(0.9), F.greatest(F.lit(0.1), p))), "clipped_log"),
        r6(F.exp(p), "e"), F.rint(p * 10 - 0.5).alias("half_even"),
    )


@query(
    "fn_06_stable_fraction",
    f"select {KEY}, {sql_hash(KEY)} as hash, round({sql_fraction(KEY, 7)}, 9) as fraction from loans",
    uses="loans",
)
def _(t):
    return t.loans().select(
        KEY, x.stable_hash(KEY).alias("hash"), F.round(x.stable_fraction(KEY, 7), 9).alias("fraction")
    )


@query("udf_01_score_band", f"select credit_score, {band_sql('credit_score')} as risk_band, count(*) as n from points group by credit_score", uses="scored", ctes=POINTS)
def _(t):
    return scoring.score_table(t.scored(), "y_proba").groupBy("credit_score", "risk_band").agg(
        F.count("*").alias("n")
    )


@query(
    "smp_07_train_and_validation_samples",
    f"select id, y_true from scored where {sql_fraction('id')} < 0.25",
    uses="scored",
)
def _(t):
    return splits.hash_sample(t.scored(), 0.25, ["id"]).select("id", "y_true")


@query(
    "ord_02_top_n",
    'select "column" as feature, cast(cardinality as double) as importance from profile order by cardinality desc, "column" limit 15',
    uses="loans",
    ctes=PROFILE_SQL,
)
def _(t):
    table = profile.exact_statistics(t.clean()[0].select(*COLUMNS)).select(
        F.col("column").alias("feature"), F.col("cardinality").cast("double").alias("importance")
    )
    return importance.top_features(table, 15)


@query(
    "ord_05_latest_by_period",
    f"select {KEY}, arg_max(CURRENT_ACTUAL_UPB, {TIME}) as last_balance, max({TIME}) as last_period from panel group by {KEY}",
    uses="panel",
)
def _(t):
    return t.panel().groupBy(KEY).agg(
        F.max_by("CURRENT_ACTUAL_UPB", TIME).alias("last_balance"), F.max(TIME).alias("last_period")
    )


_REPORT, _LINES = report_sql()


def _results(t):
    return metrics.add_prediction(t.tied()).select(
        F.col("y_true").alias("true_default"), F.col("y_pred").alias("predicted_default"),
        F.col("y_proba").alias("predicted_probability"),
    )


@query("sco_07_validation_confusion", "select tn, fp, fn, tp from cm", uses="tied", ctes=rows_sql("tied"))
def _(t):
    return scoring.validation_report(_results(t))["confusion_matrix"]


@query("sco_07_validation_classes", _REPORT, uses="tied", ctes=f"{rows_sql('tied')}, {_LINES}")
def _(t):
    return rounded(scoring.validation_report(_results(t))["classification_report"], "precision", "recall", "f1")
