"""Plans: one exchange for all windows, no single-task windows over rows, pruned scans."""

import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from loanweave.columns import KEY
from loanweave.operators import features, metrics, ranking
from loanweave.plans import dataset
from loanweave.plans.adapters import Tables
from loanweave.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    """Cleaned tables on disk, as the feature stage reads them."""
    root = str(tmp_path_factory.mktemp("layers"))
    loans, panel = Tables(spark, SF).clean()
    loans.write.parquet(f"{root}/loans")
    panel.write.parquet(f"{root}/panel")
    return spark.read.parquet(f"{root}/loans"), spark.read.parquet(f"{root}/panel")


def test_all_features_and_target_share_one_exchange_and_sort(spark, layers):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loans, panel = layers
        rows = features.create_all_features(loans, panel)
        from loanweave.operators.target import create_target

        text = plan(create_target(rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    exchanges = re.findall(r"^\(\d+\) Exchange", text, re.M)
    assert len(exchanges) == 2, text  # one per side of the join, none for the windows
    assert len(re.findall(r"hashpartitioning\(LOAN_SEQUENCE_NUMBER", text)) == 2


def test_scan_reads_only_needed_columns(layers):
    loans, panel = layers
    df = features.create_all_features(loans, panel).select(KEY, "max_delinquency_6m")
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", plan(df))
    for schema in schemas:
        assert schema.count(":") <= 3, schema


def test_filters_reach_the_scan(layers):
    loans, _ = layers
    text = plan(loans.filter("vintage_year = 2005").select(KEY))
    assert "EqualTo(vintage_year,2005)" in text


def test_row_windows_are_partitioned(spark):
    """Only windows over per-bucket totals may be unpartitioned."""
    rows = spark.range(1000).select(
        F.col("id"), (F.col("id") % 2).cast("int").alias("y_true"), (F.col("id") / 1000.0).alias("y_proba")
    )
    ranked = metrics.ranked_scores(rows, bucket_rows=100)
    text = plan(ranked)
    for block in re.findall(r"^\(\d+\) Window.*?\n\n", text, re.M | re.S):
        if "_sum_pos" not in block:
            assert "_bucket" in block, block


def test_buckets_are_balanced(spark):
    rows = spark.range(5000).select(F.col("id"), (F.col("id") / 7.0).alias("v"))
    edges = ranking.bucket_edges(rows, "v", 500)
    sizes = [r["count"] for r in ranking.add_bucket(rows, "v", edges).groupBy("_bucket").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 1000


def test_checkpoint_folder_is_read_from_the_session(spark):
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
    assert ensure_checkpoint_dir(spark)


def test_library_never_brings_rows_to_the_driver():
    import pathlib

    root = pathlib.Path(dataset.__file__).parents[1]
    for path in root.rglob("*.py"):
        text = path.read_text()
        assert "toPandas" not in text and "localCheckpoint" not in text, path
        assert ".crossJoin(" not in text and "udf(" not in text, path


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 14
    assert set(entry.oracle_sql()) <= set(entry.queries())
