"""Probability to score, risk bands and score distributions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loanweave.functions.expressions import as_column
from loanweave.operators.ranking import exact_percentiles

# The score cut-offs and the percentiles of the distribution report.
LOW_RISK_FROM, MEDIUM_RISK_FROM = 700, 600
PERCENTILES = {
    "p05": 0.05, "p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95,
}


@dataclass(frozen=True)
class Scale:
    """A log-odds score scale: ``pdo`` points double the odds.

    ``target_rate`` scores the middle of the range.  A higher score means *less* risk;
    ``legacy=True`` gives the inverted orientation, in which scores rise with default odds.
    """

    low: int = 300
    high: int = 900
    target_rate: float = 0.05
    pdo: float = 20.0
    legacy: bool = False

    @property
    def slope(self) -> float:
        """Score points per unit of log-odds of default."""
        per_unit = self.pdo / math.log(2)
        return per_unit if self.legacy else -per_unit

    @property
    def intercept(self) -> float:
        target_log_odds = math.log(self.target_rate / (1 - self.target_rate))
        return (self.low + self.high) / 2 - self.slope * target_log_odds

    def score(self, probability: Column | str) -> Column:
        """Whole score within the range, rounded half to even."""
        p = F.greatest(F.lit(1e-10), F.least(F.lit(1 - 1e-10), as_column(probability)))
        raw = F.lit(self.intercept) + F.lit(self.slope) * F.ln(p / (1 - p))
        clipped = F.greatest(F.lit(float(self.low)), F.least(F.lit(float(self.high)), raw))
        return F.rint(clipped).cast("int")

    def probability(self, score: Column | str) -> Column:
        odds = F.exp((as_column(score) - F.lit(self.intercept)) / F.lit(self.slope))
        return odds / (1 + odds)


def score_band(score: Column | str) -> Column:
    s = as_column(score)
    return (
        F.when(s >= LOW_RISK_FROM, "Low").when(s >= MEDIUM_RISK_FROM, "Medium").otherwise("High")
    )


def score_table(
    df: DataFrame, probability: str = "probability", score: str = "credit_score",
    scale: Scale = Scale(),
) -> DataFrame:
    return df.withColumn(score, scale.score(probability)).withColumn("risk_band", score_band(score))


def score_distribution(df: DataFrame, score: str = "credit_score") -> DataFrame:
    """Min, max, mean, median, sample standard deviation and seven percentiles.

    Scores are whole numbers in a fixed range, so the histogram has a bounded number of
    rows and exact percentiles cost no more than a count.
    """
    histogram = df.groupBy(score).agg(F.count("*").alias("n"))
    moments = df.agg(
        F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean"),
        F.stddev_samp(score).alias("std"), F.lit(1).alias("_one"),
    )
    ends = exact_percentiles(histogram, score, PERCENTILES).withColumn("_one", F.lit(1))
    return moments.join(ends, "_one").drop("_one").withColumn("median", F.col("p50"))


def histogram_by_class(
    df: DataFrame, score: str, label: str, bins: int = 30
) -> DataFrame:
    """Equal-width bins between each class's own extremes, with densities.

    Empty bins are listed with 0 rows; the highest value belongs to the last bin.
    ``label`` is 0 or 1, so the table of extremes has two rows and is broadcast.
    """
    value = F.col(score).cast("double")
    df = df.filter(F.col(label).isin(0, 1))
    spans = df.groupBy(label).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.count("*").alias("_rows")
    )
    width = (F.col("_high") - F.col("_low")) / bins
    number = F.when(width == 0, 0).otherwise(
        F.least(F.lit(bins - 1), F.floor((value - F.col("_low")) / F.nullif(width, F.lit(0.0))).cast("int"))
    )
    counted = (
        df.join(F.broadcast(spans), label).groupBy(label, number.alias("bin")).agg(F.count("*").alias("n"))
    )
    frame = spans.select(
        label, "_low", "_rows", width.alias("_width"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    n = F.coalesce("n", F.lit(0))
    return frame.join(counted, [label, "bin"], "left").select(
        label, "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_low"),
        n.alias("n"),
        F.coalesce(
            n / F.nullif(F.col("_rows") * F.col("_width"), F.lit(0.0)), F.lit(0.0)
        ).alias("density"),
    )


def validation_report(results: DataFrame, **options) -> dict[str, DataFrame]:
    """Accuracy, AUC, confusion matrix and per-class report of scored customers."""
    from loanweave.operators import metrics

    rows = results.select(
        F.col("true_default").alias("y_true"),
        F.col("predicted_default").alias("y_pred"),
        F.col("predicted_probability").alias("y_proba"),
    )
    confusion = metrics.confusion_matrix(rows)
    return {
        "metrics": metrics.evaluate(rows, **options).select("accuracy", "roc_auc"),
        "confusion_matrix": confusion,
        "classification_report": metrics.classification_report(confusion),
    }


def choose_model(available: Sequence[str], preferred: Sequence[str] = ("ensemble", "boosting_b")) -> str:
    """The first preferred model that exists."""
    for name in preferred:
        if name in available:
            return name
    raise LookupError(f"no model for scoring: need one of {list(preferred)}, have {sorted(available)}")
