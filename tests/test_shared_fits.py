"""Logistic fits in shared passes against Spark's own preparation, learner and folds."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanweave.operators import learning, shared_fits, tuning
from loanweave.operators.learning import FeatureSet
from loanweave.operators.preparation import LABEL

FEATURES = FeatureSet(("kind", "rare", "one", "wide", "near", "gap", "fold1"), ("kind", "rare"))
DRAWN = [
    {"C": 0.3, "class_weight": "balanced", "max_iter": 100}, {"C": 1e-3, "class_weight": None, "max_iter": 100},
    {"C": 8.0, "class_weight": "balanced", "max_iter": 100},
]


@pytest.fixture(scope="module")
def table(spark):
    """Columns that nearly coincide, are constant (in all or in two folds), empty in part, and categories of one fold."""
    n = F.col("id")
    noise = (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 10_000).cast("double")
    wide = (n * 7919 % 1009).cast("double")
    rows = spark.range(0, 1500, 1, 5).select(
        (n % 3).cast("int").alias("fold"), F.element_at(F.array(F.lit("b"), F.lit("a"), F.lit(None)), (n % 3 + n % 2).cast("int") % 3 + 1).alias("kind"),
        F.when(n % 3 == 1, F.lit("m")).when(n % 5 == 0, F.lit("z")).otherwise(F.lit("c")).alias("rare"),
        F.lit(7.25).alias("one"), (wide * 1000 + 5e6).alias("wide"), (wide * 1001 + noise).alias("near"),
        F.when(n % 4 == 0, F.lit(float("nan"))).otherwise(noise * 3).alias("gap"),
        F.when(n % 3 == 1, noise).otherwise(0.1).alias("fold1"), (noise + wide / 2018 > 0.9).cast("double").alias(LABEL),
    )
    return rows.checkpoint() if spark.sparkContext.getCheckpointDir() else rows.localCheckpoint()


def test_fits_have_no_slope_left_on_sparks_own_matrix(table):
    matrix = shared_fits.write_matrix(table, FEATURES)
    try:
        wanted = [(k, p) for k in range(3) for p in DRAWN]
        fits = shared_fits.fit_together(matrix, wanted)
        again = shared_fits.fit_together(matrix, wanted[-1:], fits[:1] + fits[-3:-1])
        scored = {(r.fit, r.y_true): (r.n, r.p) for r in shared_fits.held_out_scores(matrix, fits).groupBy("fit", "y_true").agg(
            F.count("*").alias("n"), F.avg("y_proba").alias("p")).collect()}
    finally:
        matrix.close()
    assert any(o.renumbered for o in matrix.folds)
    assert again[0].at == pytest.approx(fits[-1].at, abs=1e-6)
    for number, (fit, (k, p)) in enumerate(zip(fits, wanted)):
        prepared = learning.prepare("logistic", table.filter(F.col("fold") != k), FEATURES)
        rows = prepared.matrix.select(LABEL, vector_to_array("features").alias("x")).collect()
        x, y = np.array([[*r.x, 1.0] for r in rows]), np.array([r[LABEL] for r in rows])
        share = {c: (y == c).mean() for c in (0, 1)}
        w = np.where(y == 1, 0.5 / share[1], 0.5 / share[0]) if p["class_weight"] else np.ones(len(y))
        slopes = x.T @ (w * (1 / (1 + np.exp(-x @ fit.at)) - y)) + np.append(fit.at[:-1], 0) / p["C"]
        assert np.abs(slopes).max() < 1e-6 * len(y)
        held = prepared.transform(table.filter(F.col("fold") == k)).select(LABEL, vector_to_array("features").alias("x")).collect()
        for c in (0, 1):
            own = np.array([[*r.x, 1.0] for r in held if r[LABEL] == c])
            assert scored[number, c] == (len(own), pytest.approx((1 / (1 + np.exp(-own @ fit.at))).mean(), abs=1e-9))


def test_trials_equal_those_of_sparks_learner(table):
    matrix = shared_fits.write_matrix(table, FEATURES)
    try:
        together = tuning.evaluate_together(matrix, [], DRAWN, -np.inf)
        stopped = tuning.evaluate_together(matrix, [], DRAWN, together[0].first)
    finally:
        matrix.close()
    parts = tuning.prepared_folds("logistic", table, FEATURES)
    for p, trial, other in zip(DRAWN, together, stopped):
        alone = tuning.evaluate_trial("logistic", parts, {}, 42, p, -np.inf)
        assert (trial.score, trial.first) == pytest.approx((alone.score, alone.first), abs=2e-3)
        assert other.stopped == (trial.first < together[0].first)
        assert other.score == pytest.approx(trial.first if other.stopped else trial.score, abs=1e-9)


def test_a_search_needs_few_jobs(spark, table):
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "search")
    try:
        trials = tuning.search_trials("logistic", table, FEATURES, 6, fixed={"max_iter": 100}, startup=3, batch=3)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(trials) == 6
    # two batches of at most a dozen passes; one fit at a time took 18 fits of up to 100 iterations
    assert len(context.statusTracker().getJobIdsForGroup("few-jobs")) < 150
    with pytest.raises(ValueError, match="both classes"):
        tuning.search_trials("logistic", table.filter(F.col(LABEL) == 1), FEATURES, 2)
