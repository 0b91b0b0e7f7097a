"""Evaluation, calibration-quality and scoring queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from loanweave.columns import RISK_BANDS
from loanweave.operators import metrics, scoring
from loanweave.plans.catalog_panel import sql_hash
from loanweave.plans.registry import query, r6

# ---------------------------------------------------------------- SQL fragments

_PRED = "case when y_proba >= 0.5 then 1 else 0 end"
_EPS = "cast('2.220446049250313e-16' as double)"


def rows_sql(source: str, by: str = "") -> str:
    group, lead = (f"group by {by}", f"{by}, ") if by else ("", "")
    return f"""cm as (select {lead}
    cast(count_if(y_true = 0 and y_pred = 0) as bigint) as tn, cast(count_if(y_true = 0 and y_pred = 1) as bigint) as fp,
    cast(count_if(y_true = 1 and y_pred = 0) as bigint) as fn, cast(count_if(y_true = 1 and y_pred = 1) as bigint) as tp,
    avg(pow(y_proba - y_true, 2)) as brier_score,
    avg(-case when y_true = 1 then ln(least(greatest(y_proba, {_EPS}), 1 - {_EPS}))
             else ln(1 - least(greatest(y_proba, {_EPS}), 1 - {_EPS})) end) as log_loss
  from (select *, {_PRED} as y_pred from {source}) {group})"""


def curve_sql(source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    return f"""hist as (select {lead}y_proba, cast(count_if(y_true = 1) as bigint) as pos, cast(count_if(y_true <> 1) as bigint) as neg
    from {source} group by {lead}y_proba),
  curve as (select *, cast(sum(pos) over ({part} order by y_proba desc) as bigint) as cp,
    cast(sum(neg) over ({part} order by y_proba desc) as bigint) as cn,
    cast(sum(pos) over ({part}) as bigint) as p, cast(sum(neg) over ({part}) as bigint) as n from hist)"""


def _div(a: str, b: str) -> str:
    return f"(case when ({b}) = 0 then 0.0::double else cast({a} as double) / ({b}) end)"


THRESHOLD = {
    "accuracy": _div("tp + tn", "tp + tn + fp + fn"),
    "precision": _div("tp", "tp + fp"),
    "recall": _div("tp", "tp + fn"),
    "f1": _div("2 * tp", "2 * tp + fp + fn"),
    "balanced_accuracy": f"({_div('tp', 'tp + fn')} + {_div('tn', 'tn + fp')}) / 2",
    "mcc": _div(
        "tp::double * tn - fp::double * fn",
        "sqrt((tp + fp)::double) * sqrt((tp + fn)::double) * sqrt((tn + fp)::double) * sqrt((tn + fn)::double)",
    ),
}
RANKING = {
    "roc_auc": "sum(neg * (cp - pos) + neg * pos / 2.0::double) / (max(p)::double * max(n)::double)",
    "pr_auc": "sum(pos * cp / cast(cp + cn as double)) / max(p)",
    "ks_statistic": "max(abs(cp / p::double - cn / n::double))",
}


def _f(beta: int) -> str:
    b = beta * beta
    return _div(f"{1 + b} * cp", f"{b} * p + cp + cn")


def _best_sql(beta: int, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    return (
        f"select {lead}y_proba as threshold, {_f(beta)} as f_beta, {_f(1)} as f1, cp / cast(cp + cn as double) as precision, "
        f"{_div('cp', 'p')} as recall from curve qualify row_number() over ({part} order by {_f(beta)} desc, y_proba) = 1"
    )


def _round(columns: dict[str, str], only=None, digits: int = 6) -> str:
    return ", ".join(
        f"round({e}, {digits}) as {n}" for n, e in columns.items() if only is None or n in only
    )


def rounded(df, *names, digits: int = 6):
    return df.withColumns({n: F.round(n, digits) for n in names})


THREE = """three as (
  select 'noisy' as model, id, y_true, y_proba from scored
  union all select 'flipped', id, y_true, 1 - y_proba from scored
  union all select 'coarse', id, y_true, round(y_proba, 1) from scored)"""


def three_models(t):
    """The scored rows under three scorings, as the long table of a model comparison."""
    base = t.scored().select("id", "y_true", "y_proba")
    scorings = F.array(
        F.struct(F.lit("noisy").alias("model"), F.col("y_proba").alias("p")),
        F.struct(F.lit("flipped").alias("model"), (1 - F.col("y_proba")).alias("p")),
        F.struct(F.lit("coarse").alias("model"), F.round("y_proba", 1).alias("p")),
    )
    return base.select("id", "y_true", F.explode(scorings).alias("s")).select(
        "s.model", "id", "y_true", F.col("s.p").alias("y_proba")
    )


# ---------------------------------------------------------------- metrics

_ALL = "accuracy precision recall f1 balanced_accuracy mcc".split()


@query(
    "met_00_evaluate",
    f"select tn, fp, fn, tp, {_round(THRESHOLD)}, round(brier_score, 6) as brier_score, round(log_loss, 6) as log_loss, "
    f"r.* from cm, (select {_round(RANKING)} from curve) r",
    uses="scored",
    ctes=f"{rows_sql('scored')}, {curve_sql('scored')}",
)
def _(t):
    df = metrics.evaluate(t.scored())
    return rounded(df, *_ALL, "brier_score", "log_loss", *RANKING)


@query("met_01_confusion_matrix", "select tn, fp, fn, tp from cm", uses="scored", ctes=rows_sql("scored"))
def _(t):
    return metrics.confusion_matrix(metrics.add_prediction(t.scored()))


@query("met_01_confusion_tied", "select tn, fp, fn, tp from cm", uses="tied", ctes=rows_sql("tied"))
def _(t):
    return metrics.confusion_matrix(metrics.add_prediction(t.tied()))


@query("met_02_threshold_metrics", f"select {_round(THRESHOLD)} from cm", uses="scored", ctes=rows_sql("scored"))
def _(t):
    df = metrics.row_metrics(metrics.add_prediction(t.scored())).select(*_ALL)
    return rounded(df, *_ALL)


for _name, _source in (("", "scored"), ("_tied", "tied")):

    @query(f"met_03_roc_auc{_name}", f"select {_round(RANKING, ['roc_auc'])} from curve", uses=_source, ctes=curve_sql(_source))
    def _(t, source=_source):
        df = metrics.ranking_summary(metrics.ranked_scores(getattr(t, source)())).select("roc_auc")
        return rounded(df, "roc_auc")

    @query(f"met_04_average_precision{_name}", f"select {_round(RANKING, ['pr_auc'])} from curve", uses=_source, ctes=curve_sql(_source))
    def _(t, source=_source):
        df = metrics.ranking_summary(metrics.ranked_scores(getattr(t, source)())).select("pr_auc")
        return rounded(df, "pr_auc")

    @query(f"met_07_ks{_name}", f"select {_round(RANKING, ['ks_statistic'])} from curve", uses=_source, ctes=curve_sql(_source))
    def _(t, source=_source):
        df = metrics.ranking_summary(metrics.ranked_scores(getattr(t, source)())).select("ks_statistic")
        return rounded(df, "ks_statistic")


@query("met_05_brier", "select round(brier_score, 6) as brier_score from cm", uses="scored", ctes=rows_sql("scored"))
def _(t):
    return t.scored().agg(r6(metrics.probability_metrics()["brier_score"], "brier_score"))


@query("met_06_log_loss", "select round(log_loss, 6) as log_loss from cm", uses="scored", ctes=rows_sql("scored"))
def _(t):
    return t.scored().agg(r6(metrics.probability_metrics()["log_loss"], "log_loss"))


@query(
    "met_08_optimal_threshold",
    f"select threshold, 2.0::double as beta, round(f_beta, 6) as f_beta, round(f1, 6) as f1, "
    f"round(precision, 6) as precision, round(recall, 6) as recall from ({_best_sql(2)})",
    uses="scored",
    ctes=curve_sql("scored"),
)
def _(t):
    df = metrics.optimal_threshold(metrics.ranked_scores(t.scored()), 2.0)
    return rounded(df, "f_beta", "f1", "precision", "recall")


_OPTIMAL = (
    "a.threshold as f1_optimal_threshold, round(a.f1, 6) as f1_optimal, round(a.precision, 6) as precision_at_f1_optimal, "
    "round(a.recall, 6) as recall_at_f1_optimal, b.threshold as f2_optimal_threshold, round(b.f_beta, 6) as f2_optimal, "
    "round(b.precision, 6) as precision_at_f2_optimal, round(b.recall, 6) as recall_at_f2_optimal"
)
_OPTIMAL_ROUNDED = (
    "f1_optimal precision_at_f1_optimal recall_at_f1_optimal f2_optimal precision_at_f2_optimal recall_at_f2_optimal"
).split()


@query(
    "met_09_optimal_thresholds",
    f"select {_OPTIMAL} from ({_best_sql(1)}) a, ({_best_sql(2)}) b",
    uses="tied",
    ctes=curve_sql("tied"),
)
def _(t):
    df = metrics.optimal_thresholds(metrics.ranked_scores(t.tied()))
    return rounded(df, *_OPTIMAL_ROUNDED)


def deciles_sql(source: str, k: int = 10) -> str:
    return f"""numbered as (select y_true, row_number() over (order by y_proba desc, {sql_hash('id')}, id) - 1 as r,
    count(*) over () as total from {source}),
  placed as (select y_true, cast(least({k}, greatest(1, (r * {k} + total - 2) // (total - 1))) as integer) as decile from numbered),
  deciles as (select decile, count(*) as n_obs, cast(sum(y_true) as bigint) as n_defaults from placed group by decile)"""


_DECILES = """select decile, n_obs, n_defaults, round(n_defaults / cast(n_obs as double), 6) as default_rate,
  round((n_defaults / cast(n_obs as double)) / (sum(n_defaults) over () / cast(sum(n_obs) over () as double)), 6) as lift,
  cast(sum(n_defaults) over (order by decile) as bigint) as cumulative_defaults,
  cast(sum(n_obs) over (order by decile) as bigint) as cumulative_obs,
  round(sum(n_defaults) over (order by decile) / cast(sum(n_defaults) over () as double), 6) as gain from deciles"""

for _name, _source in (("", "scored"), ("_tied", "tied")):

    @query(f"met_10_deciles{_name}", _DECILES, uses=_source, ctes=deciles_sql(_source))
    def _(t, source=_source):
        return rounded(metrics.decile_table(getattr(t, source)()), "default_rate", "lift", "gain")


@query(
    "met_11_top_decile_capture",
    f"select gain as top_decile_capture from ({_DECILES}) where decile = 1",
    uses="tied",
    ctes=deciles_sql("tied"),
)
def _(t):
    return rounded(metrics.top_decile_capture(metrics.decile_table(t.tied())), "top_decile_capture")


@query(
    "met_12_risk_bands",
    " union all ".join(
        f"select '{n}' as risk_band, {low}::double as low, {high}::double as high, cast(count_if(y_proba >= {low} and y_proba < {high}) as bigint) as n_obs, "
        f"cast(count_if(y_true = 1 and y_proba >= {low} and y_proba < {high}) as bigint) as n_defaults, "
        f"round(coalesce(avg(y_true) filter (y_proba >= {low} and y_proba < {high}), 0), 6) as default_rate, "
        f"round(count_if(y_proba >= {low} and y_proba < {high}) / cast(count(*) as double), 6) as pct_of_portfolio from tied"
        for n, low, high in RISK_BANDS
    ),
    uses="tied",
)
def _(t):
    return rounded(metrics.risk_bands(t.tied()), "default_rate", "pct_of_portfolio")


def report_sql() -> str:
    def line(name, hit, called, actual):
        return (
            f"select '{name}' as class, {_div(hit, called)} as precision, {_div(hit, actual)} as recall, "
            f"{_div(f'2 * ({hit})', f'{called} + {actual}')} as f1, {actual} as support from cm"
        )

    both = f"{line('0', 'tn', 'tn + fn', 'tn + fp')} union all {line('1', 'tp', 'tp + fp', 'tp + fn')}"
    macro = ", ".join(f"avg({m}) as {m}" for m in ("precision", "recall", "f1"))
    weighted = ", ".join(
        f"sum({m} * support) / sum(support) as {m}" for m in ("precision", "recall", "f1")
    )
    return (
        f"select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from "
        f"(select * from lines union all select 'macro avg', {macro}, cast(sum(support) as bigint) from lines "
        f"union all select 'weighted avg', {weighted}, cast(sum(support) as bigint) from lines)"
    ), f"lines as ({both})"


_REPORT, _LINES = report_sql()


@query("met_13_classification_report", _REPORT, uses="scored", ctes=f"{rows_sql('scored')}, {_LINES}")
def _(t):
    confusion = metrics.confusion_matrix(metrics.add_prediction(t.scored()))
    return rounded(metrics.classification_report(confusion), "precision", "recall", "f1")


_RESULTS = (
    f"select model, {_round(THRESHOLD, ['f1', 'precision', 'recall', 'balanced_accuracy', 'mcc'])}, "
    "round(brier_score, 6) as brier_score, round(log_loss, 6) as log_loss, roc_auc, pr_auc, ks_statistic, "
    "f1_optimal_threshold, f1_optimal, f2_optimal_threshold, f2_optimal, precision_at_f2_optimal, recall_at_f2_optimal "
    f"from cm join (select model, {_round(RANKING)} from curve group by model) r using (model) "
    f"join (select a.model, {_OPTIMAL} from ({_best_sql(1, 'model')}) a join ({_best_sql(2, 'model')}) b using (model)) o using (model)"
)
_RESULTS_CTES = f"{THREE}, {rows_sql('three', 'model')}, {curve_sql('three', 'model')}"
_RESULT_ROUNDED = [*metrics.SUMMARY, "f1_optimal", "f2_optimal", "precision_at_f2_optimal", "recall_at_f2_optimal"]


@query("met_14_model_results", _RESULTS, uses="scored", ctes=_RESULTS_CTES)
def _(t):
    return rounded(metrics.model_results(three_models(t)), *_RESULT_ROUNDED)


@query(
    "met_15_summary",
    # One-decimal scores make six-digit ties likely, so nine digits are compared.
    f"select {_round(THRESHOLD, metrics.SUMMARY, 9)}, round(brier_score, 9) as brier_score, round(log_loss, 9) as log_loss, r.* "
    f"from cm, (select {_round(RANKING, digits=9)} from curve) r",
    uses="tied",
    ctes=f"{rows_sql('tied')}, {curve_sql('tied')}",
)
def _(t):
    return rounded(metrics.summary(metrics.evaluate(t.tied())), *metrics.SUMMARY, digits=9)


def curve_points_sql(points: int) -> str:
    return (
        f"select cast(floor((cp + cn - 1) * {points} / cast(p + n as double)) as integer) as point, y_proba as threshold, cp + cn as population, "
        f"round({_div('cp', 'p')}, 6) as tpr, round({_div('cn', 'n')}, 6) as fpr, round(cp / cast(cp + cn as double), 6) as precision, "
        f"round({_div('cp', 'p')} - {_div('cn', 'n')}, 6) as ks from curve "
        f"qualify row_number() over (partition by floor((cp + cn - 1) * {points} / cast(p + n as double)) order by cp + cn desc) = 1"
    )


for _name, _source in (("", "scored"), ("_tied", "tied")):

    @query(f"met_16_curves{_name}", curve_points_sql(200), uses=_source, ctes=curve_sql(_source))
    def _(t, source=_source):
        df = metrics.curve_points(metrics.ranked_scores(getattr(t, source)()), 200)
        return rounded(df, "tpr", "fpr", "precision", "ks")


_MELTED = ["roc_auc", "pr_auc", "f1", "ks_statistic"]


@query(
    "met_17_melted_results",
    " union all ".join(f"select model, '{m}' as metric, {m} as score from results" for m in _MELTED),
    uses="scored",
    ctes=f"{_RESULTS_CTES}, results as ({_RESULTS})",
)
def _(t):
    results = metrics.model_results(three_models(t))
    return rounded(metrics.melt_results(results, _MELTED), "score")


@query(
    "ord_03_model_ranking",
    "select model, roc_auc, cast(rank() over (order by roc_auc desc, model) as integer) as rank from results",
    uses="scored",
    ctes=f"{_RESULTS_CTES}, results as ({_RESULTS})",
)
def _(t):
    return rounded(metrics.rank_models(metrics.model_results(three_models(t))), "roc_auc")


_CURVE = (
    "cal as (select least(9, greatest(0, cast(ceil(y_proba * 10) as integer) - 1)) as bin, avg(y_true) as prob_true, "
    "avg(y_proba) as prob_pred, count(*) as bin_count, sum(pow(y_proba - y_true, 2)) as sq from {0} group by 1)"
)


@query(
    "cal_05_calibration_curve",
    "select bin, round(prob_true, 6) as prob_true, round(prob_pred, 6) as prob_pred, bin_count from cal",
    uses="scored",
    ctes=_CURVE.format("scored"),
)
def _(t):
    return rounded(metrics.calibration_curve(t.scored()), "prob_true", "prob_pred")


@query(
    "cal_05_calibration_error",
    "select round(sum(sq) / sum(bin_count), 6) as brier_score, round(sum(abs(prob_true - prob_pred) * bin_count) / sum(bin_count), 6) as ece, "
    "round(max(abs(prob_true - prob_pred)), 6) as mce from cal",
    uses="tied",
    ctes=_CURVE.format("tied"),
)
def _(t):
    return rounded(metrics.calibration_error(t.tied()), "brier_score", "ece", "mce")


@query(
    "ord_01_score_order",
    "select y_proba, cast(sum(count(*)) over (order by y_proba desc) as bigint) as rows_at_or_above from scored group by y_proba",
    uses="scored",
)
def _(t):
    ranked = metrics.ranked_scores(t.scored(), sums=["n"])
    return ranked.select("y_proba", F.col("cum_n").alias("rows_at_or_above"))


# ---------------------------------------------------------------- scoring

_LN2, _ODDS = math.log(2), math.log(0.05 / 0.95)


def score_sql(legacy: bool = False) -> str:
    slope = 20 / _LN2 if legacy else -20 / _LN2
    intercept = 600 - slope * _ODDS
    p = "least(greatest(y_proba, cast('1e-10' as double)), 1 - cast('1e-10' as double))"
    raw = f"cast('{intercept!r}' as double) + cast('{slope!r}' as double) * ln({p} / (1 - {p}))"
    return f"cast(round_even(least(900.0::double, greatest(300.0::double, {raw})), 0) as integer)"


def band_sql(score: str) -> str:
    return f"case when {score} >= 700 then 'Low' when {score} >= 600 then 'Medium' else 'High' end"


POINTS = f"points as (select id, y_true, y_proba, {score_sql()} as credit_score from scored)"


@query("sco_01_score", "select id, credit_score from points", uses="scored", ctes=POINTS)
def _(t):
    return t.scored().select("id", scoring.Scale().score("y_proba").alias("credit_score"))


@query("sco_01_score_legacy", f"select id, {score_sql(True)} as credit_score from scored", uses="scored")
def _(t):
    return t.scored().select("id", scoring.Scale(legacy=True).score("y_proba").alias("credit_score"))


@query(
    "sco_02_probability",
    f"select id, round(1 / (1 + exp(-(credit_score - cast('{600 + 20 / _LN2 * _ODDS!r}' as double)) / cast('{-20 / _LN2!r}' as double))), 6) as probability from points",
    uses="scored",
    ctes=POINTS,
)
def _(t):
    scale = scoring.Scale()
    scored = t.scored().select("id", scale.score("y_proba").alias("credit_score"))
    return scored.select("id", r6(scale.probability("credit_score"), "probability"))


@query("sco_03_band", f"select id, {band_sql('credit_score')} as risk_band from points", uses="scored", ctes=POINTS)
def _(t):
    return t.scored().select("id", scoring.score_band(scoring.Scale().score("y_proba")).alias("risk_band"))


@query(
    "sco_04_score_table",
    f"select id, y_true, y_proba, credit_score, {band_sql('credit_score')} as risk_band from points",
    uses="scored",
    ctes=POINTS,
)
def _(t):
    return scoring.score_table(t.scored().drop("user_id"), "y_proba")





@query(
    "sco_07_validation_report",
    f"select {_round(THRESHOLD, ['accuracy'])}, (select {RANKING['roc_auc']} from curve)::decimal(18,6)::double as roc_auc from cm",
    uses="scored",
    ctes=f"{rows_sql('scored')}, {curve_sql('scored')}",
)
def _(t):
    results = metrics.add_prediction(t.scored()).select(
        F.col("y_true").alias("true_default"),
        F.col("y_pred").alias("predicted_default"),
        F.col("y_proba").alias("predicted_probability"),
    )
    return rounded(scoring.validation_report(results)["metrics"], "accuracy", "roc_auc")


@query(
    "agg_15_score_distribution",
    "select min(credit_score) as min, max(credit_score) as max, round(avg(credit_score), 6) as mean, "
    "round(stddev_samp(credit_score), 6) as std, round(median(credit_score), 6) as median, "
    + ", ".join(
        f"round(quantile_cont(credit_score, {p}), 6) as {n}" for n, p in scoring.PERCENTILES.items()
    )
    + " from points",
    uses="scored",
    ctes=POINTS,
)
def _(t):
    df = scoring.score_distribution(scoring.score_table(t.scored(), "y_proba"))
    return rounded(df, "mean", "std", "median", *scoring.PERCENTILES)


@query(
    "agg_16_class_histogram",
    """select y_true, cast(bin as integer) as bin, round(low + bin * width, 6) as bin_low, count(v) as n, round(count(v) / (total * width), 9) as density
    from (select y_true, min(credit_score)::double as low, (max(credit_score) - min(credit_score)) / 30.0::double as width, count(*) as total from points group by y_true) s
    cross join range(30) b(bin)
    left join (select y_true as yt, credit_score as v from points) q on q.yt = s.y_true and least(29, floor((v - low) / width)) = bin
    group by y_true, bin, low, width, total""",
    uses="scored",
    ctes=POINTS,
)
def _(t):
    df = scoring.histogram_by_class(scoring.score_table(t.scored(), "y_proba"), "credit_score", "y_true")
    return df.withColumns({"bin_low": r6(F.col("bin_low")), "density": F.round("density", 9)})


@query(
    "met_18_evaluation_report",
    "select 'metrics' as part, 1 as rows union all select 'deciles', count(*) from deciles union all select 'risk_bands', 4 "
    "union all select 'curves', count(distinct floor((cp + cn - 1) * 200 / cast(p + n as double))) from curve "
    "union all select 'calibration', count(*) from cal union all select 'score_histogram', 60",
    uses="scored",
    ctes=f"{curve_sql('scored')}, {deciles_sql('scored')}, {_CURVE.format('scored')}",
)
def _(t):
    parts = metrics.evaluation_report(t.scored())
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("part"), "rows") for n, df in parts.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
