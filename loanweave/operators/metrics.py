"""Classification metrics as aggregations.

Input rows carry ``y_true`` (0/1), ``y_proba`` and optionally ``y_pred``.  Everything that
depends on the ranking is computed from the *score histogram* - one row per distinct score -
so ties are exact and no window ever spans the whole table in one task.  ``by`` computes the
metrics for many models at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanweave.columns import RISK_BANDS
from loanweave.functions.expressions import share
from loanweave.operators.ranking import (
    BUCKET_ROWS, hash_rank, running_totals, score_histogram,
)
from loanweave.session import checkpointed

LOG_LOSS_EPSILON = 2.220446049250313e-16
SUMMARY = (
    "roc_auc", "pr_auc", "f1", "precision", "recall", "balanced_accuracy", "mcc",
    "brier_score", "log_loss", "ks_statistic",
)


def add_prediction(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("y_pred", F.when(F.col("y_proba") >= threshold, 1).otherwise(0))


# ------------------------------------------------------------------ row-level metrics


def _matches(true: int, predicted: int) -> Column:
    hit = (F.col("y_true") == true) & (F.col("y_pred") == predicted)
    return F.sum(F.when(hit, 1).otherwise(0)).cast("bigint")


CONFUSION = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}


def confusion_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[_matches(*cell).alias(n) for n, cell in CONFUSION.items()])


def threshold_metrics() -> dict[str, Column]:
    """Metrics of a confusion matrix; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(n).cast("double") for n in CONFUSION)
    recall, specificity = share(tp, tp + fn), share(tn, tn + fp)
    spread = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    return {
        "accuracy": share(tp + tn, tp + tn + fp + fn),
        "precision": share(tp, tp + fp),
        "recall": recall,
        "f1": share(2 * tp, 2 * tp + fp + fn),
        "balanced_accuracy": (recall + specificity) / 2,
        "mcc": share(tp * tn - fp * fn, spread),
    }


def row_losses() -> dict[str, Column]:
    p, y = F.col("y_proba"), F.col("y_true")
    clipped = F.greatest(F.lit(LOG_LOSS_EPSILON), F.least(F.lit(1 - LOG_LOSS_EPSILON), p))
    return {
        "brier_score": F.pow(p - y, F.lit(2)),
        "log_loss": -F.when(y == 1, F.ln(clipped)).otherwise(F.ln(1 - clipped)),
    }


def probability_metrics() -> dict[str, Column]:
    return {n: F.avg(c) for n, c in row_losses().items()}


def row_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Confusion cells, threshold and probability metrics from one aggregation."""
    aggregated = df.groupBy(*by).agg(
        *[_matches(*cell).alias(n) for n, cell in CONFUSION.items()],
        *[c.alias(n) for n, c in probability_metrics().items()],
    )
    return aggregated.withColumns(threshold_metrics())


def _parts() -> dict[str, Column]:
    """Sums and counts per score that ``row_metrics`` can be put together from."""
    return {
        **{n: _matches(*cell) for n, cell in CONFUSION.items()},
        **{f"{n}_sum": F.sum(c) for n, c in row_losses().items()},
        **{f"{n}_rows": F.count(c) for n, c in row_losses().items()},
    }


def combined_metrics(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``row_metrics`` from a detailed histogram."""
    added = histogram.groupBy(*by).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in CONFUSION],
        *[
            (F.sum(f"{n}_sum") / F.nullif(F.sum(f"{n}_rows"), F.lit(0))).alias(n)
            for n in row_losses()
        ],
    )
    return added.withColumns(threshold_metrics())


# ------------------------------------------------------------------ ranking metrics


def written_histogram(df: DataFrame, by: Sequence[str] = (), detailed: bool = False) -> DataFrame:
    """The score histogram, written once: every metric of the ranking reads it, not the rows.

    ``detailed`` adds what row-level metrics need, so that they come from the same pass.
    """
    return checkpointed(score_histogram(df, by=by, extra=_parts() if detailed else {}))


def ranked_scores(
    df: DataFrame | None, by: Sequence[str] = (), bucket_rows: int = BUCKET_ROWS,
    sums: Sequence[str] = ("pos", "neg"), histogram: DataFrame | None = None,
) -> DataFrame:
    """Score histogram with running counts from the highest score down.

    ``df`` is read once, and not at all if its written ``histogram`` is given.
    """
    if histogram is None:
        histogram = written_histogram(df, by)
    return running_totals(histogram, "y_proba", sums, by, bucket_rows=bucket_rows)


def _curve_columns() -> dict[str, Column]:
    cum_pos, cum_neg = F.col("cum_pos"), F.col("cum_neg")
    return {
        "tpr": share(cum_pos, F.col("all_pos")),
        "fpr": share(cum_neg, F.col("all_neg")),
        "precision": share(cum_pos, cum_pos + cum_neg),
    }


def _auc() -> Column:
    """Share of (positive, negative) pairs in the right order; tied pairs count half.

    Undefined (NULL) when only one class is present.
    """
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    right = F.sum(neg * (F.col("cum_pos") - pos) + neg * pos / 2)
    return right / F.nullif(
        F.max("all_pos").cast("double") * F.max("all_neg").cast("double"), F.lit(0.0)
    )


def _average_precision() -> Column:
    gain = F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return share(F.sum(gain), F.max("all_pos"))


def _ks() -> Column:
    gap = F.abs(
        F.col("cum_pos").cast("double") * F.col("all_neg")
        - F.col("cum_neg").cast("double") * F.col("all_pos")
    )
    return F.max(gap) / F.nullif(
        F.max("all_pos").cast("double") * F.max("all_neg").cast("double"), F.lit(0.0)
    )


def _f_beta(beta: float) -> Column:
    """F-beta when everything down to this score is called positive."""
    weight = F.lit(float(beta**2))
    cum_pos = F.col("cum_pos").cast("double")
    return share(
        (1 + weight) * cum_pos,
        weight * F.col("all_pos") + cum_pos + F.col("cum_neg"),
    )


def _best(beta: float) -> Column:
    """The best point of the curve; the lowest score wins a tie."""
    point = F.struct(
        F.col("y_proba").alias("threshold"),
        _f_beta(beta).alias("f_beta"),
        _f_beta(1.0).alias("f1"),
        share(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        share(F.col("cum_pos"), F.col("all_pos")).alias("recall"),
    )
    return F.max_by(point, F.struct(_f_beta(beta), -F.col("y_proba")))


def ranking_metrics() -> dict[str, Column]:
    return {"roc_auc": _auc(), "pr_auc": _average_precision(), "ks_statistic": _ks()}


def ranking_summary(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return ranked.groupBy(*by).agg(*[c.alias(n) for n, c in ranking_metrics().items()])


def optimal_threshold(ranked: DataFrame, beta: float = 1.0, by: Sequence[str] = ()) -> DataFrame:
    """Threshold with the highest F-beta, and the metrics at that threshold."""
    return ranked.groupBy(*by).agg(_best(beta).alias("best")).select(
        *by, "best.threshold", F.lit(float(beta)).alias("beta"), "best.f_beta", "best.f1",
        "best.precision", "best.recall",
    )


def _optimal_columns() -> dict[str, Column]:
    return {
        "f1_optimal_threshold": F.col("_f1.threshold"),
        "f1_optimal": F.col("_f1.f1"),
        "precision_at_f1_optimal": F.col("_f1.precision"),
        "recall_at_f1_optimal": F.col("_f1.recall"),
        "f2_optimal_threshold": F.col("_f2.threshold"),
        "f2_optimal": F.col("_f2.f_beta"),
        "precision_at_f2_optimal": F.col("_f2.precision"),
        "recall_at_f2_optimal": F.col("_f2.recall"),
    }


def optimal_thresholds(ranked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F1- and F2-optimal summaries from one pass over the histogram."""
    best = ranked.groupBy(*by).agg(_best(1.0).alias("_f1"), _best(2.0).alias("_f2"))
    return best.select(*by, *[c.alias(n) for n, c in _optimal_columns().items()])


# ------------------------------------------------------------------ composites


def evaluate(
    df: DataFrame | None, by: Sequence[str] = (), optimal: bool = False,
    histogram: DataFrame | None = None, **options,
) -> DataFrame:
    """All metrics, one row (or one per ``by`` group), from one pass over ``df``.

    A detailed ``histogram`` of the same rows takes the place of ``df``.
    """
    if histogram is None:
        histogram = written_histogram(df if "y_pred" in df.columns else add_prediction(df), by, True)
    rows = combined_metrics(histogram, by)
    ranked = ranked_scores(None, by, histogram=histogram, **options)
    best = {"_f1": _best(1.0), "_f2": _best(2.0)} if optimal else {}
    curve = ranked.groupBy(*by).agg(
        *[c.alias(n) for n, c in {**ranking_metrics(), **best}.items()]
    )
    # Without groups both sides are a single row; a constant key joins them.
    on = list(by) or ["_one"]
    if not by:
        rows, curve = rows.withColumn("_one", F.lit(1)), curve.withColumn("_one", F.lit(1))
    joined = rows.join(curve, on).drop("_one")
    if optimal:
        joined = joined.withColumns(_optimal_columns()).drop("_f1", "_f2")
    return joined


def model_results(predictions: DataFrame, model: str = "model", **options) -> DataFrame:
    """One row per model with the published comparison columns."""
    return evaluate(predictions, [model], optimal=True, **options).select(
        model, *SUMMARY, "f1_optimal_threshold", "f1_optimal", "f2_optimal_threshold",
        "f2_optimal", "precision_at_f2_optimal", "recall_at_f2_optimal",
    )


def summary(evaluated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return evaluated.select(*by, *SUMMARY)


def melt_results(results: DataFrame, metrics: Sequence[str], model: str = "model") -> DataFrame:
    return results.unpivot([model], list(metrics), "metric", "score")


def rank_models(results: DataFrame, metric: str = "roc_auc", model: str = "model") -> DataFrame:
    """Models ranked by a metric; one row per model, so the window is tiny."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col(metric).desc(), F.col(model))
    return results.select(model, metric, F.rank().over(order).alias("rank"))


def classification_report(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    tn, fp, fn, tp = (F.col(n) for n in CONFUSION)

    def line(label: str, hit: Column, called: Column, actual: Column) -> Column:
        return F.struct(
            F.lit(label).alias("class"),
            share(hit, called).alias("precision"),
            share(hit, actual).alias("recall"),
            share(2 * hit, called + actual).alias("f1"),
            actual.alias("support"),
        )

    lines = confusion.select(
        line("0", tn, tn + fn, tn + fp).alias("zero"), line("1", tp, tp + fp, tp + fn).alias("one")
    )

    def average(label: str, weight_zero: Column, weight_one: Column) -> Column:
        total = weight_zero + weight_one
        fields = [
            share(F.col(f"zero.{m}") * weight_zero + F.col(f"one.{m}") * weight_one, total).alias(m)
            for m in ("precision", "recall", "f1")
        ]
        support = (F.col("zero.support") + F.col("one.support")).alias("support")
        return F.struct(F.lit(label).alias("class"), *fields, support)

    one = F.lit(1.0)
    return lines.select(
        F.inline(
            F.array(
                F.col("zero"),
                F.col("one"),
                average("macro avg", one, one),
                average("weighted avg", F.col("zero.support"), F.col("one.support")),
            )
        )
    )


# ------------------------------------------------------------------ deciles, bands, curves


def decile_table(
    df: DataFrame, deciles: int = 10, id_column: str = "id", seed: int = 42,
    histogram: DataFrame | None = None, **options,
) -> DataFrame:
    """Lift and gain per decile of the score, highest scores first.

    Decile ``d`` holds the 0-based ranks in ``((d-1)(n-1)/k, d(n-1)/k]`` and decile 1 also
    rank 0.  Rows with equal scores are put in md5 order of their id.

    Scores that fit one decile are summed straight from the histogram.  At most ``k - 1``
    scores can straddle a boundary; only their rows are read again, written and ranked one by
    one, so ``df`` is read twice at most.
    """
    ranked = ranked_scores(df, sums=["n"], histogram=histogram, **options)

    def decile(rank: Column) -> Column:
        steps = F.ceil(rank.cast("double") * deciles / F.greatest(F.lit(1), F.col("all_n") - 1))
        return F.least(F.lit(deciles), F.greatest(F.lit(1), steps)).cast("int")

    spans = ranked.select(
        "y_proba", "pos", "n", "all_n",
        (F.col("cum_n") - F.col("n")).alias("first"),
        (F.col("cum_n") - 1).alias("last"),
    ).withColumns({"decile": decile(F.col("first")), "_last_decile": decile(F.col("last"))})

    whole = spans.filter(F.col("decile") == F.col("_last_decile")).select("decile", "pos", "n")
    straddling = spans.filter(F.col("decile") != F.col("_last_decile")).select(
        "y_proba", "first", "all_n"
    )
    # Bounded: each of the k-1 boundaries lies inside at most one score.
    needed = df.select(id_column, "y_proba", "y_true")
    tied = checkpointed(needed.join(F.broadcast(straddling), "y_proba"))
    placed = hash_rank(tied, id_column, ["y_proba"], seed, "_place").select(
        decile(F.col("first") + F.col("_place") - 1).alias("decile"),
        F.when(F.col("y_true") == 1, 1).otherwise(0).cast("bigint").alias("pos"),
        F.lit(1).cast("bigint").alias("n"),
    )
    counted = whole.unionByName(placed).groupBy("decile").agg(
        F.sum("n").alias("n_obs"), F.sum("pos").alias("n_defaults")
    )
    every = df.sparkSession.range(1, deciles + 1).select(F.col("id").cast("int").alias("decile"))
    table = every.join(counted, "decile", "left").fillna(0, ["n_obs", "n_defaults"])
    group = Window.partitionBy(F.lit(0))  # k rows
    upto = group.orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    defaults, rows = F.sum("n_defaults").over(group), F.sum("n_obs").over(group)
    rate = share(F.col("n_defaults"), F.col("n_obs"))
    return table.select(
        "decile", "n_obs", "n_defaults",
        rate.alias("default_rate"),
        share(rate, share(defaults, rows)).alias("lift"),
        F.sum("n_defaults").over(upto).alias("cumulative_defaults"),
        F.sum("n_obs").over(upto).alias("cumulative_obs"),
        share(F.sum("n_defaults").over(upto), defaults).alias("gain"),
    )


def top_decile_capture(table: DataFrame) -> DataFrame:
    return table.filter(F.col("decile") == 1).select(F.col("gain").alias("top_decile_capture"))


def risk_bands(df: DataFrame, bands: Sequence[tuple] = RISK_BANDS) -> DataFrame:
    """Rows and default rate per half-open probability band.

    A probability equal to the last upper end is in no band but counts in the portfolio.
    """
    p = F.col("y_proba")
    band = F.coalesce(
        *[F.when((p >= low) & (p < high), F.lit(i)) for i, (_, low, high) in enumerate(bands)],
        F.lit(-1),
    )
    counted = df.groupBy(band.alias("_band")).agg(
        F.count("*").alias("n_obs"),
        F.sum(F.when(F.col("y_true") == 1, 1).otherwise(0)).cast("bigint").alias("n_defaults"),
    ).withColumn("_rows", F.sum("n_obs").over(Window.partitionBy(F.lit(0))))
    names = df.sparkSession.createDataFrame(
        [(i, n, float(low), float(high)) for i, (n, low, high) in enumerate(bands)],
        "_band int, risk_band string, low double, high double",
    )
    return names.join(counted, "_band", "left").select(
        "risk_band", "low", "high",
        F.coalesce("n_obs", F.lit(0)).alias("n_obs"),
        F.coalesce("n_defaults", F.lit(0)).alias("n_defaults"),
        F.coalesce(share(F.col("n_defaults"), F.col("n_obs")), F.lit(0.0)).alias("default_rate"),
        F.coalesce(share(F.col("n_obs"), F.col("_rows")), F.lit(0.0)).alias("pct_of_portfolio"),
    )


def curve_points(ranked: DataFrame, points: int = 200) -> DataFrame:
    """ROC, precision-recall and KS curves thinned to at most ``points`` points.

    Of all scores whose rank falls in the same slice of the population the last is kept, so
    every kept point lies exactly on its curve.
    """
    seen = F.col("cum_pos") + F.col("cum_neg")
    rows = F.col("all_pos") + F.col("all_neg")
    slice_ = F.floor((seen - 1).cast("double") * points / rows).cast("int")
    columns = {
        "threshold": F.col("y_proba"), "population": seen, **_curve_columns(),
        "ks": share(F.col("cum_pos"), F.col("all_pos")) - share(F.col("cum_neg"), F.col("all_neg")),
    }
    point = F.struct(*[c.alias(n) for n, c in columns.items()])
    return ranked.groupBy(slice_.alias("point")).agg(F.max_by(point, seen).alias("_p")).select(
        "point", *[f"_p.{n}" for n in columns]
    )


# ------------------------------------------------------------------ calibration quality


def calibration_curve(df: DataFrame, bins: int = 10) -> DataFrame:
    """Mean prediction and observed rate per equal-width bin ``(low, high]``; 0 is in bin 0."""
    steps = F.ceil(F.col("y_proba") * bins).cast("int") - 1
    number = F.least(F.lit(bins - 1), F.greatest(F.lit(0), steps))
    return df.groupBy(number.alias("bin")).agg(
        F.avg("y_true").alias("prob_true"),
        F.avg("y_proba").alias("prob_pred"),
        F.count("*").alias("bin_count"),
    )


def calibration_error(df: DataFrame, bins: int = 10) -> DataFrame:
    """Brier score, expected and maximum calibration error from the same bins.

    Each bin also carries its squared error, so the rows are read once.
    """
    steps = F.ceil(F.col("y_proba") * bins).cast("int") - 1
    number = F.least(F.lit(bins - 1), F.greatest(F.lit(0), steps))
    binned = df.groupBy(number.alias("bin")).agg(
        F.abs(F.avg("y_true") - F.avg("y_proba")).alias("gap"),
        F.sum(F.pow(F.col("y_proba") - F.col("y_true"), F.lit(2))).alias("squared"),
        F.count("*").alias("rows"),
    )
    return binned.agg(
        (F.sum("squared") / F.sum("rows")).alias("brier_score"),
        (F.sum(F.col("gap") * F.col("rows")) / F.sum("rows")).alias("ece"),
        F.max("gap").alias("mce"),
    )


def evaluation_report(df: DataFrame, **options) -> dict[str, DataFrame]:
    """Every table of the evaluation report; the caller writes or shows them."""
    from loanweave.operators.scoring import histogram_by_class, score_table

    histogram = written_histogram(df if "y_pred" in df.columns else add_prediction(df), detailed=True)
    ranked = ranked_scores(None, histogram=histogram, **options)
    scored = score_table(df, probability="y_proba")
    return {
        "metrics": evaluate(None, optimal=True, histogram=histogram, **options),
        "deciles": decile_table(df, histogram=histogram, **options),
        "risk_bands": risk_bands(df),
        "curves": curve_points(ranked),
        "calibration": calibration_curve(df),
        "score_histogram": histogram_by_class(scored, "credit_score", "y_true"),
    }
