"""Sequential search on a known surface, stopped trials, and fits side by side."""

import math
import random
import threading
import time

import pytest
from pyspark.sql import functions as F

from loanweave.operators import tuning
from loanweave.operators.side_by_side import side_by_side
from loanweave.operators.tuning import Trial

SPACE = {
    "rate": ("log", 1e-4, 10.0), "depth": ("int", 3, 15, 1), "share": ("float", 0.0, 1.0),
    "weight": ("choice", ("balanced", "sqrt", None)),
}


def surface(p, least=-math.inf):
    """Highest, 0, at rate 0.1, depth 9, share 0.3 and weight None."""
    score = -abs(math.log10(p["rate"]) + 1) / 5 - abs(p["depth"] - 9) / 12 - abs(p["share"] - 0.3)
    score -= 0.4 * (p["weight"] is not None)
    return Trial(p, score, score, score < least)


def test_search_beats_random_draws_at_equal_trials():
    ours, draws = [], []
    for seed in range(30):
        ours.append(tuning.best_trial(tuning.optimise(surface, SPACE, 40, seed)).score)
        draws.append(max(t.score for t in tuning.optimise(surface, SPACE, 40, seed, startup=40)))
    assert sum(ours) / 30 > sum(draws) / 30 + 0.03
    assert sum(a > b for a, b in zip(ours, draws)) >= 20


def test_proposals_stay_inside_the_space():
    trials = tuning.optimise(surface, SPACE, 60, 3)
    assert len(trials) == 60
    for t in trials:
        p = t.parameters
        assert 1e-4 * 0.999 <= p["rate"] <= 10.001 and 0 <= p["share"] <= 1
        assert p["depth"] in range(3, 16) and p["weight"] in ("balanced", "sqrt", None)
    coarse = tuning.optimise(lambda p, _: Trial(p, -p["n"], -p["n"]), {"n": ("int", 50, 520, 50)}, 40, 1)
    assert {t.parameters["n"] for t in coarse} <= set(range(50, 501, 50))


def test_density_is_a_density():
    for spec, values in ((("float", -2.0, 3.0), [0.1, 0.2, 2.9]), (("log", 0.01, 10.0), [0.05, 0.05, 9.0])):
        density = tuning.Density(spec, values)
        n = 4000
        step = density.range / n
        inner = [density.low + (k + 0.5) * step for k in range(n)]
        back = math.exp if spec[0] == "log" else float
        assert sum(math.exp(density.log(back(x))) for x in inner) * step == pytest.approx(1, abs=1e-3)


def test_stopped_trials_never_win():
    def evaluate(p, least):
        first = p["x"]
        return Trial(p, first, first, True) if first < least else Trial(p, first - 1, first)

    trials = tuning.optimise(evaluate, {"x": ("float", 0.0, 1.0)}, 30, 2)
    assert any(t.stopped for t in trials) and not any(t.stopped for t in trials[:5])
    assert not tuning.best_trial(trials).stopped


def test_tasks_overlap_and_keep_their_order(spark):
    barrier = threading.Barrier(3, timeout=60)

    def task(k):
        barrier.wait()  # passes only if three tasks run at the same time
        time.sleep((3 - k) * 0.1)
        return spark.range(k + 1).count()

    assert side_by_side(spark, [lambda k=k: task(k) for k in range(3)], 3) == [1, 2, 3]
    assert side_by_side(spark, [], 3) == []
    assert side_by_side(spark, [lambda: 5, lambda: 6], 1) == [5, 6]


def test_a_failed_task_cancels_the_others(spark):
    started, begun = [], threading.Event()

    def slow():
        begun.set()
        # about ten minutes of work unless it is cancelled
        return spark.range(0, 600, 1, 600).mapInArrow(_sleep, "id long").count()

    def bad():
        begun.wait(60)
        time.sleep(1)
        raise ValueError("no such parameter")

    before = time.time()
    with pytest.raises(ValueError, match="no such parameter"):
        side_by_side(spark, [slow, bad, lambda: started.append(1)], 2)
    assert time.time() - before < 60 and not started
    assert spark.range(3).count() == 3


def _sleep(batches):
    for batch in batches:
        time.sleep(8)
        yield batch


def test_workers_do_not_change_the_trials(spark):
    def run(workers):
        return lambda tasks: side_by_side(spark, tasks, workers)

    def evaluate(p, least):
        time.sleep(random.random() / 50)
        return surface(p, least)

    one = tuning.optimise(evaluate, SPACE, 25, 7, run=run(1))
    assert tuning.optimise(evaluate, SPACE, 25, 7, run=run(4)) == one


def test_dominant_shares_are_exact_at_any_cardinality(spark):
    from loanweave.operators import profile

    n = F.col("id")
    df = spark.range(20_000).repartition(7).select(
        n.alias("unique"), (n % 7).alias("tied"), F.lit(None).cast("double").alias("empty"),
        F.when(n % 3 == 0, None).otherwise(n.cast("string")).alias("mostly different"),
        F.when(n % 1000 == 0, F.lit("rare")).otherwise(n.cast("string")).alias("below the sketch"),
        F.floor(F.sqrt(n)).alias("skewed"), (n < 19_990).alias("nearly constant"),
        F.when(n % 2 == 0, F.lit(float("nan"))).otherwise(n / 2).alias("nan"),
    )
    want = {r["column"]: r.dominant_value_share for r in profile.exact_statistics(df).collect()}
    for options in ({}, {"tracked": 64, "counted": 2}):
        got = profile.dominant_shares(df, **options).collect()
        assert {r["column"]: r.dominant_value_share for r in got} == want
    assert profile.dominant_shares(df.limit(0)).count() == 0
    values = {r["column"]: r["values"] for r in profile.sample_values(df, ["unique", "tied", "empty"], 3).collect()}
    assert values == {"unique": [0, 1, 2], "tied": [0, 1, 2], "empty": []}
