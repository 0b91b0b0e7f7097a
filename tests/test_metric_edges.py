"""Metrics against brute force on small and adversarial inputs."""

import random

import pytest
from pyspark.sql import functions as F

from loanweave.functions.expressions import stable_hash
from loanweave.operators import metrics, ranking, scoring
from tests.conftest import rows


def scored(spark, pairs):
    return spark.createDataFrame(
        [(i, y, float(p)) for i, (y, p) in enumerate(pairs)], "id bigint, y_true int, y_proba double"
    )


def brute_auc(pairs):
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one score; the rest are spread out."""
    rng = random.Random(3)
    pairs = [(int(rng.random() < 0.3), 0.5 if i % 3 == 0 else round(rng.random(), 3)) for i in range(900)]
    return pairs, scored(spark, pairs).cache()


@pytest.mark.parametrize("bucket_rows", [10, 100, 10**6])
def test_ranking_metrics_do_not_depend_on_buckets(hot, bucket_rows):
    pairs, df = hot
    got = rows(metrics.ranking_summary(metrics.ranked_scores(df, bucket_rows=bucket_rows)))[0]
    assert got["roc_auc"] == pytest.approx(brute_auc(pairs), abs=1e-12)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("bucket_rows", [7, 50])
def test_running_totals_equal_a_loop(hot, descending, bucket_rows):
    _, df = hot
    histogram = ranking.score_histogram(df)
    got = rows(ranking.running_totals(histogram, "y_proba", ["n"], descending=descending, bucket_rows=bucket_rows), "y_proba")
    total = 0
    for r in reversed(got) if descending else got:
        total += r["n"]
        assert r["cum_n"] == total and r["all_n"] == 900


def test_groups_are_independent(spark, hot):
    pairs, df = hot
    both = df.withColumn("model", F.lit("a")).unionByName(
        df.withColumn("model", F.lit("b")).withColumn("y_proba", 1 - F.col("y_proba"))
    )
    got = {r["model"]: r["roc_auc"] for r in rows(metrics.evaluate(both, ["model"], bucket_rows=20))}
    assert got["a"] == pytest.approx(brute_auc(pairs)) and got["b"] == pytest.approx(1 - brute_auc(pairs))


def test_auc_is_unchanged_by_increasing_maps(hot):
    _, df = hot
    one = rows(metrics.ranking_summary(metrics.ranked_scores(df)))[0]
    two = rows(metrics.ranking_summary(metrics.ranked_scores(df.withColumn("y_proba", F.pow("y_proba", F.lit(3))))))[0]
    assert one["roc_auc"] == pytest.approx(two["roc_auc"])


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_only(spark, label):
    df = scored(spark, [(label, 0.2), (label, 0.7)])
    got = rows(metrics.evaluate(df, optimal=True))[0]
    assert got["roc_auc"] is None and got["ks_statistic"] is None
    assert got["mcc"] == 0.0
    assert got["pr_auc"] == float(label)


def test_decile_sizes_of_102_rows(spark):
    df = scored(spark, [(i % 2, i / 1000) for i in range(102)])
    got = rows(metrics.decile_table(df), "decile")
    assert [r["n_obs"] for r in got] == [11, 10, 10, 10, 10, 10, 10, 10, 10, 11]


@pytest.mark.parametrize("bucket_rows", [5, 10**6])
def test_deciles_with_a_hot_score(hot, bucket_rows):
    """Brute force over the full order: score, then md5 order of the id."""
    pairs, df = hot
    ordered = sorted(
        rows(df.withColumn("h", stable_hash("id"))),
        key=lambda r: (-r["y_proba"], r["h"], r["id"]),
    )
    expected = [[0, 0] for _ in range(10)]
    for i, r in enumerate(ordered):
        d = max(1, -(-i * 10 // (len(ordered) - 1)))
        expected[d - 1][0] += 1
        expected[d - 1][1] += r["y_true"]
    got = rows(metrics.decile_table(df, bucket_rows=bucket_rows), "decile")
    assert [[r["n_obs"], r["n_defaults"]] for r in got] == expected


def test_band_and_bin_edges(spark):
    df = scored(spark, [(0, 0.0), (1, 0.02), (0, 0.1), (1, 1.0)])
    bands = {r["risk_band"]: r["n_obs"] for r in rows(metrics.risk_bands(df))}
    assert bands == {"Low": 1, "Medium": 1, "High": 0, "Very High": 1}
    share = sum(r["pct_of_portfolio"] for r in rows(metrics.risk_bands(df)))
    assert share == pytest.approx(0.75)
    bins = {r["bin"]: r["bin_count"] for r in rows(metrics.calibration_curve(df))}
    assert bins == {0: 3, 9: 1}


def test_hash_rank_is_a_permutation_of_a_hot_group(spark):
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") < 400, "a").otherwise("b").alias("g"))
    for buckets in (1, 16, 4096):
        got = rows(ranking.hash_rank(df, "id", ["g"], buckets=buckets), "g", "hash_rank")
        assert [r["hash_rank"] for r in got] == [*range(1, 401), *range(1, 101)]
        order = [r["id"] for r in got]
        if buckets == 1:
            first = order
        assert order == first


def test_smallest_hash_rows_equals_one_sort(spark):
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("g"))
    got = {r["id"] for r in rows(ranking.smallest_hash_rows(df, 50, "id", "g"))}
    expected = set()
    for g in (0, 1):
        expected |= {r["id"] for r in df.filter(F.col("g") == g).orderBy(stable_hash("id"), "id").limit(50).collect()}
    assert got == expected


def test_percentiles_match_linear_interpolation(spark):
    import numpy as np

    values = [300, 300, 301, 450, 450, 450, 899, 900]
    df = spark.createDataFrame([(v,) for v in values], "credit_score int")
    got = rows(scoring.score_distribution(df))[0]
    for name, p in scoring.PERCENTILES.items():
        assert got[name] == pytest.approx(float(np.quantile(values, p)))
    assert got["std"] == pytest.approx(float(np.std(values, ddof=1)))


def test_histogram_lists_empty_bins_and_constant_class(spark):
    df = spark.createDataFrame([(0, 1), (10, 1), (5, 0), (5, 0)], "s int, y int")
    got = rows(scoring.histogram_by_class(df, "s", "y", bins=5), "y", "bin")
    assert [r["n"] for r in got] == [2, 0, 0, 0, 0, 1, 0, 0, 0, 1]


def test_score_orientation(spark):
    df = spark.createDataFrame([(0.05,), (0.001,), (0.5,), (0.0,), (1.0,)], "p double")
    new = [r["s"] for r in rows(df.select(scoring.Scale().score("p").alias("s")))]
    old = [r["s"] for r in rows(df.select(scoring.Scale(legacy=True).score("p").alias("s")))]
    assert new[0] == old[0] == 600
    assert new[1] > 600 > new[2] and old[1] < 600 < old[2]
    assert new[3] == 900 and new[4] == 300


def test_model_choice():
    assert scoring.choose_model(["boosting_b", "ensemble"]) == "ensemble"
    assert scoring.choose_model(["boosting_b"]) == "boosting_b"
    with pytest.raises(LookupError):
        scoring.choose_model(["logistic"])
