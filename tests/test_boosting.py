"""Boosted trees against exhaustive search, ordered rates against a sequential pass."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from loanweave.operators import boosting, learning
from loanweave.operators.boosting import Growth
from loanweave.operators.ordered_encoding import ordered_rates
from loanweave.operators.preparation import LABEL, WEIGHT


def matrix(spark, x, y, w):
    names = [f"c{k}" for k in range(x.shape[1])]
    rows = [(*map(float, r), float(a), float(b)) for r, a, b in zip(x, y, w)]
    df = spark.createDataFrame(rows, [*names, LABEL, WEIGHT])
    return VectorAssembler(inputCols=names, outputCol="features").transform(df).select(LABEL, WEIGHT, "features")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 12, (400, 4)).astype(float)
    p = 1 / (1 + np.exp(-(x[:, 0] - 6) * 0.8 - (x[:, 1] > 8) * 2 + (x[:, 2] > 5) * (x[:, 0] > 6) * 3))
    return x, (rng.random(400) < p).astype(float), rng.choice([1.0, 2.0, 10.0], 400)


def exhaustive(x, y, w, growth):
    """Best-first trees of one thread that try every value of every feature."""
    share = (w * y).sum() / w.sum()
    margin = np.full(len(y), math.log(share / (1 - share)))
    for _ in range(growth.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def score(rows):
            return g[rows].sum() ** 2 / (h[rows].sum() + growth.l2)

        def best(rows, depth):
            found = (-math.inf, None)
            if growth.max_depth is not None and depth >= growth.max_depth:
                return found
            for f in range(x.shape[1]):
                for t in np.unique(x[rows, f])[:-1]:
                    left, right = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                    if min(len(left), len(right)) < growth.min_rows or min(h[left].sum(), h[right].sum()) < growth.min_hessian:
                        continue
                    gain = score(left) + score(right) - score(rows)
                    if gain > found[0] + 1e-9:
                        found = (gain, (left, right))
            return found

        leaves = [(np.arange(len(y)), 0)]
        while len(leaves) < (growth.max_leaves or 2 ** growth.max_depth):
            gains = [best(rows, depth) for rows, depth in leaves]
            k = max(range(len(leaves)), key=lambda i: gains[i][0])
            if gains[k][0] <= 1e-12:
                break
            _, depth = leaves.pop(k)
            leaves += [(part, depth + 1) for part in gains[k][1]]
        for rows, _ in leaves:
            margin[rows] -= growth.learning_rate * g[rows].sum() / (h[rows].sum() + growth.l2)
    return margin


@pytest.mark.parametrize("growth", [
    Growth(rounds=3, learning_rate=0.3, max_depth=None, max_leaves=9, l2=0.5, min_rows=5, quantile_error=0.0),
    Growth(rounds=3, learning_rate=0.3, max_depth=3, l2=1.0, min_hessian=1.0, quantile_error=0.0),
])
def test_trees_equal_an_exhaustive_search(spark, data, growth):
    x, y, w = data
    df = matrix(spark, x, y, w).repartition(5)
    fitted = boosting.fit_trees(df, growth)
    total = np.full(len(x), fitted["base"])
    for tree in fitted["trees"]:
        total += np.array(tree["value"])[boosting.route(list(zip(tree["feature"], tree["threshold"], tree["left"], tree["right"])), x)]
    assert np.allclose(total, exhaustive(x, y, w, growth), atol=1e-6)
    if growth.max_leaves:
        assert all(t["feature"].count(-1) == 9 for t in fitted["trees"])


def test_a_tree_takes_about_as_many_passes_as_it_is_deep(spark, data, monkeypatch):
    calls, real = [], boosting.histograms
    monkeypatch.setattr(boosting, "histograms", lambda *a: calls.append(1) or real(*a))
    x, y, w = data
    tree = boosting.fit_trees(matrix(spark, x, y, w), Growth(rounds=1, max_depth=None, max_leaves=31, min_rows=1))["trees"][0]
    depth = lambda k: 1 + max(depth(tree["left"][k]), depth(tree["right"][k])) if tree["feature"][k] >= 0 else 0
    assert tree["feature"].count(-1) == 31 and len(calls) <= depth(0) + 1


def test_early_stopping_ends_one_fit(spark, data):
    x, y, w = data
    train, held_out = matrix(spark, x[:300], y[:300], w[:300]), matrix(spark, x[300:], y[300:], w[300:])
    fitted = boosting.fit_trees(train, Growth(rounds=40, learning_rate=1.0, max_depth=4, l2=0.0, patience=3), validation=held_out)
    losses = fitted["losses"]
    best = min(range(len(losses)), key=lambda k: losses[k])
    assert len(fitted["trees"]) == best + 1 and len(losses) == best + 4 < 40


def test_model_is_a_saved_stage_and_bags_repeat(spark, data, tmp_path):
    x, y, w = data
    df = matrix(spark, x, y, w)
    growth = Growth(rounds=4, max_depth=3, subsample=0.7, bagging_every=2, colsample=0.5)
    one, two = (boosting.fit_trees(df, growth)["trees"] for _ in range(2))
    # sums of doubles may differ in their last bits
    assert [t["feature"] for t in one] == [t["feature"] for t in two]
    assert all(np.allclose(a["value"], b["value"]) for a, b in zip(one, two))
    model = boosting.BoostedTrees(boosting.fit_trees(df, growth))
    model.write().overwrite().save(str(tmp_path / "m"))
    again = boosting.BoostedTrees.load(str(tmp_path / "m"))
    score = lambda m: [r.p[1] for r in m.transform(df).select(F.col("probability").alias("p")).collect()]
    assert score(model) == score(again) and model.getNumTrees == 4
    assert sum(model.featureImportances) == pytest.approx(1)


def test_thirty_one_leaves_by_default():
    growth = learning.boosting_growth(learning.parameters("boosting_b"), 1)
    assert (growth.max_leaves, growth.max_depth, growth.bagging_every) == (31, None, 5)
    assert learning.boosting_growth(learning.parameters("boosting_c"), 1).l2 == 3.0
    assert learning.boosting_growth(learning.parameters("boosting_a"), 1).max_leaves is None


def test_ordered_rates_equal_a_sequential_pass(spark):
    """A category with most rows lies in many buckets; NULL is a category."""
    rng = random.Random(3)
    rows = [(k, rng.random(), "hot" if rng.random() < 0.7 else rng.choice(["a", "b", None]), rng.choice(["x", "y"]), float(rng.random() < 0.3)) for k in range(800)]
    df = spark.createDataFrame(rows, f"id long, place double, kind string, other string, {LABEL} double").repartition(6)
    got = {r.id: (r.kind__rate, r.other__rate) for r in ordered_rates(df, ["kind", "other"], order="place", strength=2.0, bucket_rows=50).collect()}
    share = sum(r[4] for r in rows) / len(rows)
    seen = {}
    for row in sorted(rows, key=lambda r: r[1]):
        want = []
        for name in (("kind", row[2]), ("other", row[3])):
            n, p = seen.get(name, (0, 0.0))
            want.append((p + 2.0 * share) / (n + 2.0))
            seen[name] = (n + 1, p + row[4])
        assert got[row[0]] == pytest.approx(tuple(want))
    drawn = ordered_rates(df, ["kind"]).agg(F.count("kind__rate")).first()[0]
    assert drawn == 800


def test_a_feature_of_a_block_is_contiguous_and_blocks_are_added_together(spark, monkeypatch):
    """bins were strided, and every small block was added to all cells on its own."""
    rng = np.random.default_rng(3)
    bins, y, margin = rng.integers(0, 6, (700, 4)).astype(np.uint8), (rng.random(700) < 0.3).astype(float), rng.normal(size=700)
    parts = [boosting._row(k, bins[k::70], y[k::70], np.full(10, 2.0), margin[k::70]) for k in range(70)]
    for (_, held, *_), k in zip((b for p in parts for b in boosting._read(p)), range(70)):
        assert held.flags.f_contiguous and (held == bins[k::70]).all()
    rows = [tuple(c.as_py() for c in (column[0] for column in p.columns)) for p in parts]
    blocks = spark.createDataFrame(rows, boosting._BLOCK).repartition(2)
    nodes = [(1, 2, 1, 2), (-1, 0, -1, -1), (-1, 0, -1, -1)]
    found = boosting.histograms(blocks, nodes, [2], [0, 3], 6, 1.0, (1, 1))[2]
    p = 1 / (1 + np.exp(-margin))
    for k, f in enumerate((0, 3)):
        for b in range(6):
            at = (bins[:, 1] > 2) & (bins[:, f] == b)
            assert found[k, b] == pytest.approx([(2 * (p - y))[at].sum(), (2 * p * (1 - p))[at].sum(), at.sum()])


def test_one_task_grows_the_trees_of_many_passes(spark, data, monkeypatch):
    """a pass was a Spark job however small the matrix, so hundreds of rounds were thousands of jobs."""
    x, y, w = data
    train, held_out = matrix(spark, x[:300], y[:300], w[:300]).repartition(3), matrix(spark, x[300:], y[300:], w[300:])
    growth = Growth(rounds=6, max_depth=3, subsample=0.7, bagging_every=2, colsample=0.75, patience=2)
    passes, real = [], boosting.histograms
    monkeypatch.setattr(boosting, "histograms", lambda *a: passes.append(1) or real(*a))
    one = boosting.fit_trees(train, growth, validation=held_out)
    assert not passes
    monkeypatch.setattr(boosting, "ONE_TASK_VALUES", 0)
    many = boosting.fit_trees(train, growth, validation=held_out)
    assert passes and len(one["trees"]) == len(many["trees"])
    assert one["losses"] == pytest.approx(many["losses"])
    for a, b in zip(one["trees"], many["trees"]):
        assert a["feature"] == b["feature"] and a["threshold"] == b["threshold"]
        assert a["value"] == pytest.approx(b["value"])


def test_registered_boosting_c_has_all_rounds(spark, monkeypatch):
    """it was cut to 12 rounds with a patience of 4."""
    from loanweave.plans import catalog_models
    from loanweave.plans.catalog import QUERIES

    class Ended(Exception):
        pass

    def fitted(matrix, growth, *_):
        raise Ended(growth.rounds, growth.patience)

    def small(self, _):
        rows = [(float(k), float(k % 2), k % 3, ("train", "validation", "test")[k % 3]) for k in range(60)]
        self.rows = spark.createDataFrame(rows, f"a double, {LABEL} double, fold int, split string")
        self.features = learning.FeatureSet(["a"])

    monkeypatch.setattr(catalog_models.Training, "__init__", small)
    monkeypatch.setattr(learning, "fit_trees", fitted)
    with pytest.raises(Ended) as ended:
        QUERIES["ml_14_boosting_c"](spark, "/nowhere")
    assert ended.value.args == (learning.DEFAULTS["boosting_c"]["n_estimators"], learning.PATIENCE) == (100, 50)


def test_scores_equal_a_walk_down_every_tree(spark, data):
    """each row walked down the trees in an interpreted expression, as deep as the deepest tree for all of them."""
    x, y, w = data
    fitted = boosting.fit_trees(matrix(spark, x, y, w), Growth(rounds=5, max_depth=None, max_leaves=12, min_rows=3))
    odd = np.vstack([x[:50], [math.nan, 1.0, 2.0, 3.0], [5.0, math.nan, math.inf, -math.inf]])
    total = np.full(len(odd), fitted["base"])
    for tree in fitted["trees"]:
        for k, row in enumerate(odd):
            at = 0
            while tree["feature"][at] >= 0:
                at = tree["left" if row[tree["feature"][at]] <= tree["threshold"][at] else "right"][at]
            total[k] += tree["value"][at]
    rows = spark.createDataFrame([(list(map(float, r)),) for r in odd], "x array<double>").select(array_to_vector("x").alias("features"))
    plan = boosting.BoostedTrees(fitted).transform(rows)
    got = [r.p[1] for r in plan.select(F.col("probability").alias("p")).collect()]
    assert got == pytest.approx(list(1 / (1 + np.exp(-total))), abs=1e-12)
    assert "aggregate(" not in plan._jdf.queryExecution().toString()
    nothing = boosting.BoostedTrees({"base": 0.0, "width": 4, "trees": [], "losses": []})
    assert nothing.transform(rows).select("prediction").distinct().collect()[0][0] == 1.0


def test_registered_stacks_have_all_iterations(spark, monkeypatch):
    """boosted bases were cut to 3 rounds and the logistic base to 100 iterations."""
    from loanweave.plans import catalog_models
    from loanweave.plans.catalog import QUERIES

    class Ended(Exception):
        pass

    def stacked(models, train, features, folds=3, overrides=None, **options):
        raise Ended({n: learning.parameters(n, (overrides or {}).get(n)) for n in models}, folds, options)

    def small(self, _):
        self.rows = spark.createDataFrame([(1.0, 1.0, 0, "train")], f"a double, {LABEL} double, fold int, split string")
        self.features = learning.FeatureSet(["a"])

    monkeypatch.setattr(catalog_models.Training, "__init__", small)
    monkeypatch.setattr(learning, "fit_stack", stacked)
    for name in ("ml_15_stacked_model", "ml_22_stack_importance"):
        with pytest.raises(Ended) as ended:
            QUERIES[name](spark, "/nowhere")
        whole = {n: learning.DEFAULTS[n] for n in ("logistic", "random_forest", "boosting_a", "boosting_b")}
        assert ended.value.args == (whole, 3, {})
