"""Versioned tables, one panel exchange for all stages, rejects, and months added later."""

import io
import os
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from loanweave.columns import KEY, TIME
from loanweave.operators import features, target
from loanweave.plans import dataset
from loanweave.plans.adapters import Tables
from loanweave.sources import ingest, layers
from tests.conftest import rows
from tests.test_sources import perf_line, raw  # noqa: F401  (fixture)

SF = "/root/testdata/sf0.001"


def exchanges(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue().count("Exchange")


def as_set(df, names):
    kinds = dict(df.dtypes)
    return sorted(map(repr, df.select(*[F.round(n, 6).alias(n) if kinds[n] == "double" else n for n in names]).collect()))


def test_a_lost_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    layers.layer(spark, path, lambda: spark.range(3), made_from={"days": 90})
    monkeypatch.setattr(layers, "_swap", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        layers.layer(spark, path, lambda: spark.range(9), made_from={"days": 30})
    monkeypatch.undo()
    made = []
    again = layers.layer(spark, path, lambda: made.append(1), made_from={"days": 90})
    assert again.count() == 3 and not made
    assert layers.layer(spark, path, lambda: spark.range(9), made_from={"days": 30}).count() == 9
    assert layers.read_layer(spark, path).count() == 9


def test_old_versions_go_and_readers_keep_the_previous_one(spark, tmp_path):
    path = str(tmp_path / "t")
    previous = [layers.write_layer(spark.range(n), path) for n in (1, 2, 3)][1]
    assert previous.count() == 2
    assert len([n for n in os.listdir(path) if n.startswith("v")]) == 2


def test_features_target_and_dataset_move_no_row(spark, raw, tmp_path):  # noqa: F811
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        root = str(tmp_path / "layers")
        dataset.run_stages(dataset.data_stages(spark, raw, root, [2005, 2009], buckets=4), ["ingest", "clean"])
        panel, loans_ = (layers.read_layer(spark, f"{root}/silver/{n}") for n in ("performance", "origination"))
        made = features.join_static(panel, loans_.hint("shuffle_hash"))
        assert exchanges(features.history_features(made)) == 0
        stages = dataset.data_stages(spark, raw, root, [2005, 2009], buckets=4)
        dataset.run_stages(stages, ["features", "target", "dataset"])
        table = layers.read_layer(spark, f"{root}/features")
        assert exchanges(target.create_target(table)) == 0
        assert exchanges(layers.read_layer(spark, f"{root}/target").select(KEY)) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    whole = dataset.create_dataset(*(ingest.read_years(spark, raw, [2005, 2009], n) for n in ("origination", "performance")))
    stored = layers.read_layer(spark, f"{root}/dataset")
    names = sorted(n for n in whole.columns if n != "ingestion_timestamp")
    assert as_set(stored, names) == as_set(whole, names)


def test_every_line_is_counted_in_the_same_scan(spark, raw, tmp_path):  # noqa: F811
    with open(f"{raw}/sample_svcg_2009.txt", "a") as file:
        file.write(perf_line("", "200901") + "\n" + perf_line("F09Q10000004", "200902", upb="much") + "\n" + "F09Q10000005|200903\n")
    root = str(tmp_path / "layers")
    table = dataset.run_stages(dataset.data_stages(spark, raw, root, [2005, 2009]), ["ingest"])["ingest"]
    assert table.count() == 62
    report = {(r["layout"], r["status"]): r["records"] for r in rows(layers.read_layer(spark, f"{root}/reports/ingest"))}
    assert [report["performance", s] for s in ingest.STATUSES] == [60, 2, 1]
    bad = layers.read_layer(spark, f"{root}/bronze/performance").filter("_status != 'good'")
    assert bad.filter("_corrupt_record is null").count() == 1 and bad.count() == 3
    assert sum(report["origination", s] for s in ingest.STATUSES) == 3


def test_stages_use_their_parameters(spark, raw, tmp_path):  # noqa: F811
    root = str(tmp_path / "layers")
    with pytest.raises(ValueError, match="legacy"):
        dataset.data_stages(spark, raw, root, [2005], max_history_rows=30, legacy_streak=True)
    with open(f"{raw}/sample_svcg_2009.txt", "a") as file:
        file.write(perf_line("F09Q10000003", "200901", upb="7") + "\n")
    with pytest.raises(ValueError, match="several rows"):
        dataset.run_stages(dataset.data_stages(spark, raw, root, [2005, 2009], buckets=2), ["ingest", "clean"])
    cut = dataset.data_stages(spark, raw, root, [2005, 2009], buckets=2, max_history_rows=20, row_id=[TIME, "CURRENT_ACTUAL_UPB"])
    made = dataset.run_stages(cut)
    assert made["features"].count() == 61 and made["dataset"].count() > 0


def test_added_months_equal_a_full_build(spark, tmp_path):
    """Loans and months that are new, loans without new months, and untouched partitions."""
    root, by = str(tmp_path / "layers"), ("reporting_year",)
    loans_, panel = Tables(spark, SF).clean()
    panel = panel.withColumn("reporting_year", F.col("reporting_year").cast("int"))
    loans_ = layers.write_layer(loans_, f"{root}/silver/origination", layers.Layout(4, sort_by=(KEY,)))
    panel = layers.write_layer(panel, f"{root}/panel", layers.Layout(4, partition_by=by))
    whole = features.history_features(features.join_static(panel, loans_))
    old = layers.write_layer(whole.filter(f"{TIME} <= '199909'"), f"{root}/features", layers.Layout(4, partition_by=by), laid_out=True)
    layers.write_layer(target.create_target(old), f"{root}/target", layers.Layout(4, partition_by=by), laid_out=True)
    dataset.start_state(spark, root, buckets=4)
    stamp = {f: os.path.getmtime(f[7:]) for f in old.inputFiles() if "reporting_year=1999" not in f}
    touched = dataset.add_months(spark, root, panel.filter(f"{TIME} > '199909'"), buckets=4)
    assert touched["features"] == [1999, 2000, 2001]
    assert all(os.path.getmtime(f[7:]) == t for f, t in stamp.items()) and stamp
    got = layers.read_layer(spark, f"{root}/features")
    assert as_set(got, sorted(whole.columns)) == as_set(whole, sorted(whole.columns))
    labelled = target.create_target(whole)
    got = layers.read_layer(spark, f"{root}/target")
    assert as_set(got, sorted(labelled.columns)) == as_set(labelled, sorted(labelled.columns))
    with pytest.raises(ValueError, match="build anew"):
        dataset.add_months(spark, root, panel.filter(f"{TIME} > '200006'"), buckets=4)
