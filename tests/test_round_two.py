"""Order of equal times, exact calibration, early stopping, stale tables and rejected rows."""

import pytest
from pyspark.sql import functions as F

from loanweave import session
from loanweave.columns import KEY, TIME
from loanweave.operators import calibration, learning, loans, long_history, ranking, splits
from loanweave.operators.learning import FeatureSet
from loanweave.operators.preparation import LABEL
from loanweave.plans.catalog_long_history import _pooled
from loanweave.plans.adapters import Tables
from loanweave.sources import ingest, storage
from tests.conftest import rows


def test_history_order_depends_on_neither_size_nor_layout(spark):
    """Keys on both sides of the limit, all segmented, none segmented, two layouts."""
    joined = _pooled(Tables(spark, "/root/testdata/sf0.001")).cache()
    names = [KEY, "row_id", "row_num", "target", "consecutive_delinquent_months"]
    runs = [
        sorted(map(repr, long_history.features_and_target(df, "row_id", max_rows=limit).select(*names).collect()))
        for df, limit in ((joined, 100), (joined.repartition(7), 100), (joined, 20), (joined.repartition(3), 10**6))
    ]
    assert runs[0] == runs[1] == runs[2] == runs[3]


def pooled(points):
    """max over a of min over b of the weighted mean of a..b, the closed form."""
    out = []
    for i in range(len(points)):
        best = -1.0
        for a in range(i + 1):
            low, total, weight = 2.0, 0.0, 0.0
            for b in range(a, len(points)):
                total, weight = total + points[b][1], weight + points[b][2]
                if b >= i:
                    low = min(low, total / weight)
            best = max(best, low)
        out.append(best)
    return out


def test_isotonic_pools_exactly_over_many_stretches(spark):
    """Scores differ in the ninth decimal; no rounding may join them."""
    u = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000))
    df = spark.range(600).select(
        (F.pmod("id", F.lit(120)) * 1e-9 + 0.25).alias("y_proba"),
        (u(1) < 200 + F.pmod("id", F.lit(120)) * 4).cast("int").alias("y_true"),
    ).cache()
    points = [
        (r["y_proba"], r["s"], r["n"])
        for r in rows(df.groupBy("y_proba").agg(F.sum("y_true").alias("s"), F.count("*").alias("n")), "y_proba")
    ]
    want = dict(zip((p[0] for p in points), pooled(points)))
    fitted = calibration.fit_calibrator(df)
    for r in rows(fitted.transform(df.select("y_proba").distinct())):
        assert r["calibrated"] == pytest.approx(want[r["y_proba"]])
    assert len(points) == 120 and len(set(want.values())) > 5


def test_best_round_has_patience():
    assert learning.best_round([5, 4, 4.5, 4.4, 3, 3.5], patience=3) == 5
    assert learning.best_round([5, 4, 4.5, 4.4, 3, 3.5], patience=2) == 2
    assert learning.best_round([1.0]) == 1


def test_boosting_keeps_many_trees_on_a_strong_signal(spark):
    u = lambda seed: (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10_000)) / 10_000.0)
    df = spark.range(1200).select("id", u(1).alias("a"), u(2).alias("b"), u(3).alias("c"))
    df = df.withColumn(LABEL, (F.sin(F.col("a") * 12) + F.col("b") * 2 - F.col("c") > 0.6).cast("double")).cache()
    model = learning.fit_model(
        "boosting_a", df.filter("id < 800"), FeatureSet(["a", "b", "c"]),
        {"n_estimators": 60, "max_depth": 2, "learning_rate": 0.05}, df.filter("id >= 800"),
    )
    assert model.stages[-1].getNumTrees > 50


def test_changed_parameters_rebuild_a_table(spark, tmp_path):
    path, made = str(tmp_path / "t"), []

    def build(n):
        return lambda: made.append(n) or spark.range(n)

    for n, note in ((1, {"k": 90}), (2, {"k": 90}), (3, {"k": 30}), (4, None)):
        storage.unless_present(spark, path, build(n), made_from=note)
    assert made == [1, 3] and spark.read.parquet(path).count() == 3


def test_rows_without_id_are_kept_apart(spark, tmp_path):
    (tmp_path / "sample_orig_2001.txt").write_text("|x\n700|200101\n")
    raw = str(tmp_path)
    n_all = ingest.read_extract(spark, f"{raw}/sample_orig_2001.txt", "origination").count()
    good = ingest.read_years(spark, raw, [2001], "origination").count()
    bad = ingest.read_years(spark, raw, [2001], "origination", rejected=True).count()
    assert n_all == 2 and good + bad == 2 and bad >= 1
    assert ingest.read_origination(spark, f"{raw}/sample_orig_2001.txt", 2001).count() == good
    ingest.ingest(spark, raw, [2001], "origination", str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out_rejected")).count() == bad


def test_cluster_masters_need_a_shared_folder(monkeypatch):
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_samples_have_one_plan_for_any_size(spark):
    df = spark.range(5000).withColumn("g", F.col("id") % 2)
    shapes = []
    for n in (1_000, 4_000):
        sample = ranking.smallest_hash_rows(df, n, "id")
        shapes.append("TakeOrderedAndProject" in sample._jdf.queryExecution().executedPlan().toString())
        assert sample.count() == n
    assert shapes == [True, True]
    with pytest.raises(ValueError, match="more than"):
        splits.restrict_to_sample(df, df.select("id"), 10, "id").count()


def test_models_refuse_missing_features(spark):
    df = spark.range(2).withColumn(KEY, F.lit("k"))
    with pytest.raises(ValueError, match="other"):
        loans.align_to_model(df, ["id", "other"])
    assert loans.align_to_model(df, ["id", "other"], skip_unknown=True).columns == [KEY, "id"]
    assert TIME not in df.columns
