"""How often the input is read: score metrics once, deciles and fixed-size samples twice."""

import random

import pytest
from pyspark.sql import functions as F

from loanweave.operators import metrics, ranking, splits
from loanweave.functions.expressions import stable_hash


@pytest.fixture
def counted(spark):
    """A table and the number of times each of its rows was read."""
    reads = spark.sparkContext.accumulator(0)
    rng = random.Random(5)
    data = [(n, rng.randrange(2), rng.choice([0.1, 0.1, 0.4, 0.5, rng.random()])) for n in range(400)]

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    table = spark.createDataFrame(data, "id long, y_true int, y_proba double").mapInArrow(
        seen, "id long, y_true int, y_proba double"
    )
    return table, lambda: reads.value / 400, data


def test_evaluation_reads_the_rows_once(counted):
    table, passes, data = counted
    got = metrics.evaluate(table, optimal=True).first()
    assert passes() == 1
    plain = metrics.row_metrics(metrics.add_prediction(table)).first().asDict()
    for name, value in plain.items():
        assert got[name] == pytest.approx(value, abs=1e-12), name
    pairs = [(a[2], b[2]) for a in data for b in data if a[1] == 1 and b[1] == 0]
    assert got["roc_auc"] == pytest.approx(sum((p > n) + (p == n) / 2 for p, n in pairs) / len(pairs))


def test_deciles_read_the_rows_twice(counted):
    table, passes, data = counted
    assert sum(r.n_obs for r in metrics.decile_table(table).collect()) == len(data)
    assert passes() == 2


def test_the_report_shares_one_histogram(counted):
    table, passes, _ = counted
    report = metrics.evaluation_report(table)
    for name in ("metrics", "curves"):
        report[name].collect()
    assert passes() == 2  # the histogram, and the rows of the deciles' tied scores
    assert metrics.evaluate(table.limit(0)).first()["tp"] == 0


def test_samples_equal_a_sort_and_read_twice(counted):
    table, passes, _ = counted
    loans = table.select("id", F.when(F.col("id") % 7 != 0, F.col("y_true")).alias("ever_defaulted"), F.col("y_proba").alias("x"))
    for sizes in ((30, 20, 50), (1, 0, 1000), (500, 500, 0)):
        before = passes()
        got = splits.validation_loans(loans, *sizes, key="id")
        found = {r.id: r.sample_type for r in got.collect()}
        assert passes() - before == 2
        assert got.columns == ["id", "ever_defaulted", "x", "sample_type"]
        rows = loans.select("*", stable_hash("id", 42).alias("h"), stable_hash("id", 43).alias("g")).collect()
        wanted = {}
        for name, n, kept, at in (
            ("random", sizes[2], lambda r: True, "g"),
            ("non_defaulted", sizes[1], lambda r: r.ever_defaulted == 0, "h"),
            ("defaulted", sizes[0], lambda r: r.ever_defaulted == 1, "h"),
        ):
            chosen = sorted((r[at], r.id) for r in rows if kept(r))[:n]
            wanted |= {i: name for _, i in chosen}
        assert found == wanted
    assert splits.validation_loans(loans.limit(0), 3, 3, 3, key="id").count() == 0


def test_rounded_hashes_are_few_and_close(spark):
    values = [0, 1, 2, 63, 64, 127, 128, 129, 255, 256, 1000, 2**31, 2**32 - 1]
    rows = spark.createDataFrame([(v,) for v in values], "h bigint")
    for r in rows.select("h", ranking.rounded_up(F.col("h")).alias("up")).collect():
        assert r.h <= r.up <= r.h * (1 + 1 / 64)
    many = spark.range(20_000).select(ranking.rounded_up(stable_hash("id")).alias("up"))
    assert many.distinct().count() < 1_700
