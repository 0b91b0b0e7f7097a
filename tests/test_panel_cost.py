"""The plan of the modelling rows: few copies of a row, and generated code that the JVM compiles."""

import re

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from loanweave.columns import KEY
from loanweave.operators import features, learning, splits, target
from loanweave.plans import dataset
from loanweave.plans.adapters import ORIGINATION_EXPRESSIONS, PERFORMANCE_EXPRESSIONS, Tables, spark_listing

SF = "/root/testdata/sf0.001"
#: Larger methods are interpreted for as long as a job runs.
COMPILED = 8_000


def explained(df, mode):
    spark = df.sparkSession
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kind = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
        return df._jdf.queryExecution().explainString(kind)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SF)


def test_two_window_steps_before_the_static_join(tables):
    text = explained(dataset.create_dataset(tables.loans(), tables.panel()), "simple")
    lines = text.split("\n")
    windows = [k for k, line in enumerate(lines) if re.search(r"[+:\- ]Window \[", line)]
    join = next(k for k, line in enumerate(lines) if "Join" in line)
    assert len(windows) == 3, text  # one of them numbers the months of the table
    assert join < min(windows)


def test_generated_methods_are_compiled(tables):
    rows = dataset.training_frame(dataset.create_dataset(tables.loans(), tables.panel()))
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", explained(splits.add_fold(rows, 3), "codegen"))
    assert sizes and max(map(int, sizes)) < COMPILED


def test_late_join_gives_the_same_rows(tables):
    loans, panel = tables.clean()
    early = target.create_target(features.history_features(features.join_static(panel, loans)))
    late = target.features_with_target(panel, loans)
    assert late.schema.names == early.schema.names and late.count() > 0
    assert late.exceptAll(early).isEmpty() and early.exceptAll(late).isEmpty()


def test_spark_expressions_have_the_values_of_the_shared_texts(tables):
    customers = tables.read("customer")
    shared = customers.selectExpr(*[f"{e} as {n}" for n, e in ORIGINATION_EXPRESSIONS.items()])
    assert shared.exceptAll(customers.selectExpr(*spark_listing(ORIGINATION_EXPRESSIONS))).isEmpty()
    months = customers.selectExpr(
        f"'x' as {KEY}", "'200501' as period", "1.5D as upb", "1 as rn", "1 as is_last", "c_custkey as customer", "c_custkey as k"
    )
    shared = months.selectExpr(*[f"{e} as {n}" for n, e in PERFORMANCE_EXPRESSIONS.items()])
    assert shared.exceptAll(months.selectExpr(*spark_listing(PERFORMANCE_EXPRESSIONS))).isEmpty()


def test_vintages_outside_of_both_periods_have_no_split(spark):
    ids = spark.createDataFrame([("F98Q10000001",), ("F99Q10000001",), ("F12Q10000001",), ("F13Q10000001",), ("FxxQ10000001",), (None,)], f"{KEY} string")
    assert {r[KEY][1:3]: r["split"] == "test" for r in splits.split_out_of_time(ids).collect()} == {"99": False, "12": True}
    assert [r[KEY][1:3] for r in splits.split_out_of_time(ids, century_pivot=None).collect()] == ["12"]


def test_sessions_do_not_fuse_code_that_is_never_compiled(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "65535")
        Tables(spark, SF)
        assert int(spark.conf.get(name)) == COMPILED
        spark.conf.set(name, "4000")
        Tables(spark, SF)
        assert spark.conf.get(name) == "4000"
    finally:
        spark.conf.set(name, before)


def test_the_forest_keeps_the_nodes_of_its_rows(spark):
    rows = spark.range(600).select(
        (F.col("id") % 2).cast("double").alias("label"), F.lit(1.0).alias("weight"),
        array_to_vector(F.array((F.col("id") % 2 + F.col("id") % 7).cast("double"), (F.col("id") % 5).cast("double"))).alias("features"),
    )
    forest = learning._forest({**learning.parameters("random_forest"), "n_estimators": 5}, 600.0, "", 42)
    assert forest.getCacheNodeIds()
    walked = forest.copy({forest.cacheNodeIds: False}).fit(rows)
    assert forest.fit(rows).toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_values_are_counted_as_the_numbers_they_are(spark):
    """F14, F16: every cell became text, so that 0.0 and -0.0 were two values, too."""
    from loanweave.operators import profile

    nan = float("nan")
    rows = [(0.0, 2**53, "0"), (-0.0, 2**53 + 1, "0.0"), (nan, None, None), (nan, 1, ""), (None, 1, "")]
    df = spark.createDataFrame(rows, "`a.b` double, whole bigint, text string").repartition(3)
    found = {r["column"]: tuple(r)[1:] for r in profile.exact_statistics(df).collect()}
    assert found == {"a.b": (2, 0.2, 0.4), "whole": (3, 0.2, 0.4), "text": (3, 0.2, 0.4)}
    shares = {r["column"]: r["dominant_value_share"] for r in profile.dominant_shares(df).collect()}
    assert shares == {"a.b": 0.4, "whole": 0.4, "text": 0.4}
    cells = profile.column_values(df)
    assert dict(cells.dtypes) == {"column": "int", "number": "double", "whole": "bigint", "text": "string"}


def _plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def test_dominant_shares_of_the_dataset_need_one_pass(spark):
    """the dataset was written, then read by a sketch, by a count of its candidates, and by a full count."""
    from loanweave.plans.catalog import QUERIES

    plan = _plan(QUERIES["agg_11_dataset_dominant_share"](spark, SF))
    assert "ExistingRDD" not in plan and "orders.parquet" in plan


def test_the_pooled_panel_is_made_once(spark):
    """each of the reads of the pooled rows computed the panel from the orders again."""
    from loanweave.plans.catalog import QUERIES

    assert "orders.parquet" not in _plan(QUERIES["tgt_08_long_history_target"](spark, SF))


def test_a_state_sorts_wide_rows_once(spark):
    """numbering, looking ahead and counting the rows that follow were steps of their own, with two sorts."""
    from loanweave.operators import incremental

    loans_, panel = Tables(spark, SF).clean()
    rows = features.features_joined_last(loans_, panel)
    assert rows.columns == features.create_all_features(loans_, panel).columns
    windows = lambda df: _plan(df).count(" Window [")
    assert _plan(incremental.state_of(rows)).count(" Sort [") == _plan(rows).count(" Sort [")
    assert windows(incremental.state_of(rows)) == windows(rows) + 1
