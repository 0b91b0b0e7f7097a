"""Invariants of fitted models on a small table with a known signal."""

import threading

import pytest
from pyspark.sql import functions as F

from loanweave.operators import calibration, importance, learning, preparation, tuning
from loanweave.operators.learning import FeatureSet
from loanweave.operators.metrics import ranked_scores, ranking_summary
from loanweave.operators.preparation import LABEL
from tests.conftest import rows

FEATURES = FeatureSet(["strong", "weak", "grade"], ("grade",))
QUICK = {
    "logistic": {"max_iter": 50},
    "random_forest": {"n_estimators": 5, "min_samples_leaf": 5},
    "boosting_a": {"n_estimators": 5}, "boosting_b": {"n_estimators": 5}, "boosting_c": {"n_estimators": 5},
}


@pytest.fixture(scope="module")
def table(spark):
    u = lambda seed: (F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(10_000)) / 10_000.0)
    df = spark.range(1500).select("id", u(1).alias("strong"), u(2).alias("weak"), u(3).alias("_n"))
    grade = F.element_at(F.array(*[F.lit(v) for v in ("A", "B", "C")]), (F.col("id") % 3 + 1).cast("int"))
    df = df.withColumn("grade", F.when(F.col("id") % 17 == 0, None).otherwise(grade))
    df = df.withColumn("strong", F.when(F.col("id") % 23 == 0, None).otherwise(F.col("strong")))
    positive = F.coalesce("strong", F.lit(0.0)) + 0.5 * F.col("_n") > 1.1
    return df.withColumn(LABEL, positive.cast("double")).withColumn(
        "fold", (F.col("id") % 3).cast("int")
    ).drop("_n").cache()


def auc(df):
    scored = df.select(F.col(LABEL).alias("y_true"), "y_proba")
    return rows(ranking_summary(ranked_scores(scored)))[0]["roc_auc"]


@pytest.mark.parametrize("name", sorted(learning.DEFAULTS))
def test_every_model_learns_and_keeps_rows(table, name):
    train, test = table.filter("id < 1000"), table.filter("id >= 1000")
    validation = test if name.startswith("boosting") else None
    model = learning.fit_model(name, train, FEATURES, QUICK[name], validation)
    out = learning.predict_proba(model, test)
    assert out.count() == test.count()
    span = rows(out.agg(F.min("y_proba").alias("a"), F.max("y_proba").alias("b")))[0]
    assert 0 <= span["a"] < span["b"] <= 1
    assert auc(out) > 0.85
    table_ = rows(importance.model_importance(model, FEATURES, table.sparkSession), "feature")
    assert {r["feature"] for r in table_} == {"strong", "weak", "grade"}
    assert max(table_, key=lambda r: r["importance"])["feature"] == "strong"


def test_saved_model_scores_the_same(table, tmp_path):
    model = learning.fit_model("logistic", table, FEATURES, QUICK["logistic"])
    learning.save_model(model, str(tmp_path), "logistic")
    again = learning.load_model(str(tmp_path), "logistic")
    a = rows(learning.predict_proba(model, table).select("id", "y_proba"), "id")
    b = rows(learning.predict_proba(again, table).select("id", "y_proba"), "id")
    assert a == b


def test_unseen_category_is_scored(table, spark):
    model = learning.fit_model("random_forest", table, FEATURES, QUICK["random_forest"])
    new = spark.createDataFrame([(0.9, 0.5, "Z"), (None, None, None)], "strong double, weak double, grade string")
    assert learning.predict_proba(model, new).count() == 2


def test_stack_is_one_saved_pipeline(table, tmp_path):
    bases = ["logistic", "random_forest", "boosting_c"]
    assert learning.stackable(bases + ["ensemble"]) == ["logistic", "random_forest"]
    model = learning.fit_stack(bases, table, FEATURES, overrides=QUICK)
    out = learning.predict_proba(model, table)
    assert out.count() == table.count() and auc(out) > 0.85
    learning.save_model(model, str(tmp_path), "ensemble")
    again = learning.load_model(str(tmp_path), "ensemble")
    assert auc(learning.predict_proba(again, table)) == pytest.approx(auc(out))
    weights = rows(importance.stack_importance(model, learning.stackable(bases), table.sparkSession))
    assert len(weights) == 2


def test_fits_of_a_stack_run_side_by_side(table, monkeypatch):
    fit, held, running, most = learning.fit_prepared, threading.Lock(), [], []

    def counted(*args, **options):
        with held:
            running.append(1)
            most.append(len(running))
        try:
            return fit(*args, **options)
        finally:
            with held:
                running.pop()

    monkeypatch.setattr(learning, "fit_prepared", counted)
    bases, found = ["logistic", "random_forest"], []
    for workers in (1, 4):
        most.clear()
        model = learning.fit_stack(bases, table, FEATURES, overrides=QUICK, workers=workers)
        assert len(most) == 8 and (max(most) > 1) == (workers > 1)
        found.append(auc(learning.predict_proba(model, table)))
    assert found[0] == pytest.approx(found[1])


def test_single_base_model_is_returned_alone(table):
    model = learning.fit_stack(["logistic", "boosting_c"], table, FEATURES, overrides=QUICK)
    assert auc(learning.predict_proba(model, table)) > 0.85
    with pytest.raises(ValueError):
        learning.fit_stack(["boosting_c"], table, FEATURES)


def test_permutation_importance_finds_the_signal(table):
    model = learning.fit_model("logistic", table, FEATURES, QUICK["logistic"])
    got = {r["feature"]: r for r in rows(importance.permutation_importance(model, table, FEATURES, "id", repeats=2))}
    assert set(got) == {"strong", "weak", "grade"}
    assert got["strong"]["importance"] > 0.2
    assert abs(got["weak"]["importance"]) < 0.05


def test_permutation_prepares_a_row_once(table, monkeypatch):
    model = learning.fit_model("logistic", table, FEATURES, QUICK["logistic"])
    assert importance.prepares_by_feature(model, FEATURES)
    ask = lambda: rows(importance.permutation_importance(model, table, FEATURES, "id", repeats=2), "feature")
    with monkeypatch.context() as m:
        m.setattr(importance, "predict_proba", None)  # the copies do not go through the whole pipeline
        quick = ask()
    monkeypatch.setattr(importance, "prepares_by_feature", lambda *_: False)
    for a, b in zip(quick, ask(), strict=True):
        assert a["feature"] == b["feature"]
        assert (a["importance"], a["deviation"]) == pytest.approx((b["importance"], b["deviation"]))


def test_copies_of_a_linear_model_are_not_made(table, monkeypatch):
    """F2: every copy was a row with a vector of its own, and every score a row of the shuffle."""
    doubled = table.filter("id % 5 > 0").unionByName(table.filter("id % 7 = 0"))  # equal rows have tied scores
    model = learning.fit_model("logistic", doubled, FEATURES, QUICK["logistic"])
    ask = lambda rows_: rows(importance.permutation_importance(model, rows_, FEATURES, "id", repeats=2), "feature")
    with monkeypatch.context() as m:
        m.setattr(importance, "_is_linear", lambda _: False)
        slow, alone = ask(doubled), ask(table.filter(F.col(LABEL) == 1))
    assert [r["importance"] for r in ask(table.filter(F.col(LABEL) == 1))] == [r["importance"] for r in alone] == [None] * 3
    monkeypatch.setattr(importance, "ranked_scores", None)  # no row per score
    for buckets in ([], [0.1, 0.4, 0.4001, 0.9]):
        monkeypatch.setattr(importance, "bucket_edges", lambda *_, b=buckets: b)
        for a, b in zip(slow, ask(doubled), strict=True):
            assert a["feature"] == b["feature"]
            assert (a["importance"], a["deviation"]) == pytest.approx((b["importance"], b["deviation"]), abs=1e-9)


def test_search_returns_its_best_trial_and_fails_loudly(table):
    best, results = tuning.search("logistic", table, FEATURES, trials=2, fixed={"max_iter": 20})
    assert best == max(results, key=lambda r: r[1])[0]
    assert all(0.5 < score <= 1 for _, score in results)
    assert tuning.draw_trials("boosting_a", 3) == tuning.draw_trials("boosting_a", 3)
    with pytest.raises(ValueError):
        tuning.search("logistic", table, FEATURES, trials=1, fixed={"nonsense": 1})


def test_one_class_cannot_be_trained(table):
    with pytest.raises(ValueError, match="both classes"):
        learning.fit_model("logistic", table.filter(F.col(LABEL) == 1), FEATURES)


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_calibration_is_monotone_and_within_bounds(table, method):
    raw = table.select(F.col(LABEL).alias("y_true"), F.coalesce("strong", F.lit(0.0)).alias("y_proba"))
    out = rows(calibration.fit_calibrator(raw, method).transform(raw), "y_proba")
    values = [r["calibrated"] for r in out]
    assert all(0 <= v <= 1 for v in values)
    assert all(b >= a - 1e-12 for a, b in zip(values, values[1:]))
    both = rows(calibration.fit_calibrator(raw, method).both_classes(raw).limit(5))
    assert all(r["proba_0"] + r["proba_1"] == pytest.approx(1) for r in both)


def test_isotonic_on_the_histogram_equals_pooling(spark):
    """Pool adjacent violators by hand: 0.1->0, 0.2->1, 0.3->0, 0.4->1 pools the middle."""
    df = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.3, 0), (0.4, 1)], "y_proba double, y_true int")
    out = rows(calibration.fit_calibrator(df).transform(df), "y_proba")
    assert [r["calibrated"] for r in out] == [0.0, 0.5, 0.5, 1.0]


def test_calibration_across_folds(table):
    fitted = calibration.calibrate_across_folds(
        lambda df: learning.fit_model("logistic", df, FEATURES, QUICK["logistic"]), table, folds=2,
        fold="fold",
    )
    out = fitted.transform(table)
    assert len(fitted.members) == 2 and out.count() == table.count()
    assert out.filter("calibrated < 0 or calibrated > 1").isEmpty()


def test_batch_scores(table):
    model = learning.fit_model("logistic", table, FEATURES, QUICK["logistic"])
    df = table.withColumn("target", F.col(LABEL).cast("int"))
    out = learning.score_customers(model, df, "logistic", "id")
    assert out.columns == [
        "id", "predicted_probability", "predicted_default", "model_used", "true_default", "correct"
    ]
    assert learning.score_customers(model, table, "logistic", "id").columns[-1] == "model_used"
    wrong = out.filter("correct <> (predicted_default = true_default)")
    assert wrong.isEmpty()


def test_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], f"{LABEL} double")
    assert preparation.collected_weights(df, "balanced") == {0.0: pytest.approx(4 / 6), 1.0: 2.0}
    assert preparation.collected_weights(df, "unbalance") == {0.0: 1.0, 1.0: 3.0}
    assert preparation.collected_weights(df, 10) == {0.0: 1.0, 1.0: 10.0}
