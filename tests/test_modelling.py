"""The modelling and customer jobs, from written tables to reports."""

import threading

import pytest
from pyspark.sql import functions as F

from loanweave.columns import KEY, TARGET, TIME
from loanweave.operators import calibration, learning, metrics
from loanweave.operators.learning import FeatureSet
from loanweave.plans import customers, dataset, modelling
from loanweave.plans.adapters import Tables
from loanweave.plans.catalog_models import modelling_root
from loanweave.sources import layers
from tests.conftest import rows

SF = "/root/testdata/sf0.001"
PLAN = modelling.Modelling(
    models=("logistic", "random_forest"), train_rows=1500, folds=2,
    overrides={
        "logistic": {"max_iter": 10}, "random_forest": {"n_estimators": 3, "max_depth": 4},
    },
)


@pytest.fixture(scope="module")
def root(spark):
    """Target and dataset tables, and the modelling job run over them."""
    return modelling_root(Tables(spark, SF), PLAN)


def test_sample_keeps_its_sizes_and_whole_loans_in_folds(spark, root):
    sample = layers.read_layer(spark, f"{root}/sample")
    sizes = {r["split"]: r["n"] for r in rows(sample.groupBy("split").agg(F.count("*").alias("n")))}
    whole = {r["split"]: r["n"] for r in rows(layers.read_layer(spark, f"{root}/dataset").groupBy("split").agg(F.count("*").alias("n")))}
    for split, goal in (("train", 1500), ("validation", 300), ("test", 600)):
        expected = min(goal, whole[split])
        assert abs(sizes[split] - expected) <= max(5, 0.2 * expected)
    assert sample.groupBy(KEY).agg(F.count_distinct("fold").alias("n")).filter("n > 1").isEmpty()
    assert sample.groupBy("row_id").count().filter("count > 1").isEmpty()


def test_every_model_scores_every_row_once(spark, root):
    scored = layers.read_layer(spark, f"{root}/predictions")
    held_out = layers.read_layer(spark, f"{root}/sample").filter("split != 'train'")
    names = {"logistic", "random_forest", "ensemble"}
    counts = {r["model"]: r["n"] for r in rows(scored.groupBy("model").agg(F.count_distinct("split", "row_id").alias("n")))}
    assert counts == dict.fromkeys(names, held_out.count()) and scored.count() == 3 * held_out.count()
    at = modelling.Workspace(spark, root)
    again = learning.predict_proba(at.model("random_forest"), held_out).select("row_id", F.col("y_proba").alias("again"))
    assert scored.filter("model = 'random_forest'").join(again, "row_id").filter("y_proba != again").isEmpty()


def test_reports_equal_the_metrics_of_the_predictions(spark, root):
    test = layers.read_layer(spark, f"{root}/predictions").filter("split = 'test'")
    held = {r["model"]: r for r in rows(layers.read_layer(spark, f"{root}/reports/model_results"))}
    for name in ("logistic", "ensemble"):
        mine = test.filter(F.col("model") == name).select("y_true", "y_proba")
        direct = rows(metrics.evaluate(mine))[0]
        for metric in ("roc_auc", "pr_auc", "brier_score", "log_loss"):
            assert held[name][metric] == pytest.approx(direct[metric])
    best = max(held.values(), key=lambda r: r["roc_auc"])["model"]
    ranks = {r["model"]: r["rank"] for r in rows(layers.read_layer(spark, f"{root}/reports/model_ranking"))}
    assert ranks[best] == 1 and set(ranks) == set(held)
    for kind in modelling.PER_MODEL:
        report = layers.read_layer(spark, f"{root}/reports/{kind}")
        assert {r["model"] for r in rows(report.select("model").distinct())} == set(held)


def test_calibration_scores_and_importances(spark, root):
    calibrated = layers.read_layer(spark, f"{root}/calibrated")
    assert calibrated.filter("calibrated < 0 or calibrated > 1 or calibrated is null").isEmpty()
    errors = rows(layers.read_layer(spark, f"{root}/reports/calibration_errors"))
    assert len(errors) == 6
    scores = layers.read_layer(spark, f"{root}/scores")
    assert {r[0] for r in scores.select("model_used").distinct().collect()} == {"ensemble"}
    assert scores.filter("credit_score not between 300 and 900").isEmpty()
    importance = layers.read_layer(spark, f"{root}/reports/importance")
    used = modelling.Workspace(spark, root).features().names
    assert {r["feature"] for r in rows(importance.filter("model = 'random_forest'"))} == set(used)
    assert {r["feature"] for r in rows(importance.filter("model = 'ensemble'"))} == set(PLAN.models)


def test_unchanged_stages_are_not_run_again(spark, root):
    at = modelling.Workspace(spark, root)
    names = ("sample", "columns", "models", "predictions", "calibrated", "scores", "reports/model_results")
    before = [at.version(n) for n in names]
    dataset.run_stages(modelling.model_stages(spark, root, PLAN))
    assert [at.version(n) for n in names] == before
    with pytest.raises(ValueError):
        dataset.run_stages(modelling.model_stages(spark, root, PLAN), ["tune"])


def test_a_stage_without_its_inputs_says_so(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        modelling.model_stages(spark, str(tmp_path), PLAN)["predict"]()


def test_one_model_after_a_search(spark, root, tmp_path):
    at = modelling.Workspace(spark, root)
    folder = str(tmp_path / "layers")
    layers.write_layer(at.read("dataset"), f"{folder}/dataset", layers.Layout(partition_by=("split",)))
    plan = modelling.Modelling(trials=2, train_rows=1500, folds=2, overrides={"logistic": {"max_iter": 5}}).only("logistic")
    dataset.run_stages(modelling.model_stages(spark, folder, plan), ["sample", "columns", "tune", "train"])
    trials = rows(layers.read_layer(spark, f"{folder}/trials"))
    assert len(trials) == 2 and sum(r["best"] for r in trials) == 1
    models = rows(layers.read_layer(spark, f"{folder}/models"))
    assert [m["model"] for m in models] == ["logistic"]
    assert models[0]["parameters"] == next(r["parameters"] for r in trials if r["best"])


def test_roles_of_columns(spark):
    df = spark.createDataFrame(
        [(float(i), 5.0, i % 3, None if i % 2 else "a", "x", f"t{i}", None) for i in range(60)],
        "wide double, one double, few int, mixed string, same string, free string, nothing double",
    )
    candidates = FeatureSet(("wide", "one", "few", "mixed", "same", "nothing"), ("mixed", "same"))
    plain = {c: r for _, c, r in modelling.column_roles(df, candidates, ["free"])}
    assert plain == {
        "wide": "numeric", "one": "constant", "few": "numeric", "mixed": "categorical", "same": "constant",
        "free": "excluded", "nothing": "constant",
    }
    inferred = {c: r for _, c, r in modelling.column_roles(df, candidates, ["free"], infer=True)}
    assert (inferred["few"], inferred["free"], inferred["wide"]) == ("categorical", "categorical", "numeric")
    assert modelling.column_roles(df, FeatureSet(())) == []


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_a_saved_calibrator_maps_the_same(spark, tmp_path, method):
    scored = spark.range(200).select((F.col("id") / 200).alias("y_proba"), (F.col("id") % 7 < F.col("id") / 30).cast("int").alias("y_true"))
    fitted = calibration.fit_calibrator(scored, method)
    calibration.save_calibrator(fitted, str(tmp_path), "m")
    again = calibration.load_calibrator(str(tmp_path), "m", method)
    assert rows(fitted.transform(scored), "y_proba") == rows(again.transform(scored), "y_proba")


def test_customers_are_sampled_scored_and_validated(spark, root, tmp_path):
    stages = customers.customer_stages(spark, root, defaulted=10, non_defaulted=15, anyone=5)
    out = dataset.run_stages(stages)
    at = modelling.Workspace(spark, root)
    summary, sample = at.read("customers/loans"), at.read("customers/sample")
    assert summary.count() == at.read("target").select(KEY).distinct().count()
    tags = {r["sample_type"]: r["n"] for r in rows(sample.groupBy("sample_type").agg(F.count("*").alias("n")))}
    ever = summary.filter("ever_defaulted = 1").count()
    assert tags["defaulted"] == min(10, ever) and tags["non_defaulted"] == 15
    picked, predictions = at.read("customers/rows"), out["score"]
    assert picked.count() == sample.count() == predictions.select(KEY).distinct().count() == predictions.count()
    # the latest month of each loan
    latest = at.read("target").groupBy(KEY).agg(F.max(TIME).alias("last"))
    assert picked.join(latest, KEY).filter(F.col("last") != F.col(TIME)).isEmpty()
    truth = predictions.join(picked.select(KEY, F.col(TARGET).cast("int").alias("t")), KEY)
    assert truth.filter("not (true_default <=> t)").isEmpty()
    right = rows(predictions.agg(F.avg(F.col("correct").cast("double")).alias("a")))[0]["a"]
    assert rows(out["validate"])[0]["accuracy"] == pytest.approx(right)
    exported = modelling.export_reports(spark, root, str(tmp_path / "csv"))
    assert {"reports/model_results", "reports/customer_metrics", "customers/predictions", "scores"} <= set(exported)
    back = spark.read.option("header", True).csv(str(tmp_path / "csv/customers/predictions"))
    assert back.count() == predictions.count() and back.columns == predictions.columns


def test_models_and_stack_are_fitted_side_by_side(spark, tmp_path, monkeypatch):
    root, together = str(tmp_path), threading.Barrier(3, timeout=60)
    layers.write_layer(spark.createDataFrame([("train", 1.0, 2.0)], "split string, label double, x double"), f"{root}/sample")
    layers.write_layer(spark.createDataFrame([(0, "x", "numeric")], "position int, column string, role string"), f"{root}/columns")
    # each fit waits until the other two have begun
    monkeypatch.setattr(learning, "fit_model", lambda name, *_, **__: together.wait() and name)
    monkeypatch.setattr(learning, "fit_stack", lambda *_, **__: together.wait())
    monkeypatch.setattr(learning, "save_model", lambda *_: None)
    plan = modelling.Modelling(models=("logistic", "random_forest"))
    saved = modelling.model_stages(spark, root, plan)["train"]().orderBy("position").collect()
    assert [r.model for r in saved] == ["logistic", "random_forest", modelling.STACK]
