import os

import pytest
from pyspark.sql import functions as F

from loanweave import columns as c
from loanweave.plans import dataset
from loanweave.sources import ingest, storage
from loanweave.streaming import ingest as streaming
from tests.conftest import rows


def orig_line(loan, score="700", ltv="80", flag="Y"):
    names = [p.split()[0] for p in c.ORIGINATION_DDL.replace("\n", " ").split(",")]
    values = dict.fromkeys(names, "")
    values |= {c.KEY: loan, "CREDIT_SCORE": score, "ORIGINAL_LTV": ltv, "SUPER_CONFORMING_FLAG": " ",
               "FIRST_TIME_HOMEBUYER_FLAG": flag, "ORIGINAL_UPB": "123456", "ORIGINAL_LOAN_TERM": "360",
               "ORIGINAL_INTEREST_RATE": "5.5"}
    return "|".join(values[n] for n in names)


def perf_line(loan, period, status="0", upb="1000.5", zero=""):
    names = [p.split()[0] for p in c.PERFORMANCE_DDL.replace("\n", " ").split(",")]
    values = dict.fromkeys(names, "")
    values |= {c.KEY: loan, c.TIME: period, "CURRENT_LOAN_DELINQUENCY_STATUS": status,
               "CURRENT_ACTUAL_UPB": upb, "ZERO_BALANCE_CODE": zero, "CURRENT_INTEREST_RATE": "5.5",
               "LOAN_AGE": "1", "REMAINING_MONTHS_TO_LEGAL_MATURITY": "350"}
    return "|".join(values[n] for n in names)


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "sample_orig_2005.txt").write_text(
        orig_line("F05Q10000001") + "\n" + orig_line("F05Q10000002", score="bad", flag="") + "\n"
    )
    (folder / "sample_orig_2009.txt").write_text(orig_line("F09Q10000003") + "\n")
    months = [f"2005{m:02d}" for m in range(1, 13)] + [f"2006{m:02d}" for m in range(1, 13)]
    lines = [perf_line("F05Q10000001", p, "3" if p == "200606" else "0") for p in months]
    lines += [perf_line("F05Q10000002", p) for p in months]
    (folder / "sample_svcg_2005.txt").write_text("\n".join(lines) + "\n")
    (folder / "sample_svcg_2009.txt").write_text(
        "\n".join(perf_line("F09Q10000003", f"2009{m:02d}") for m in range(1, 13)) + "\n"
    )
    return str(folder)


def test_text_nulls(spark, raw):
    got = rows(ingest.read_origination(spark, f"{raw}/sample_orig_2005.txt", 2005), c.KEY)
    assert [r["CREDIT_SCORE"] for r in got] == [700, None]
    assert [r["FIRST_TIME_HOMEBUYER_FLAG"] for r in got] == ["Y", None]
    assert got[0]["SUPER_CONFORMING_FLAG"] == " "
    assert got[0]["vintage_year"] == 2005 and got[0]["ingestion_timestamp"] is not None


def test_years_come_from_file_names_and_absent_years_are_skipped(spark, raw):
    df = ingest.read_years(spark, raw, range(1999, 2013), "origination")
    counts = {r["vintage_year"]: r["records"] for r in rows(ingest.record_counts(df))}
    assert counts == {2005: 2, 2009: 1, None: 3}


def test_no_file_is_an_error(spark, raw):
    with pytest.raises(FileNotFoundError):
        ingest.read_years(spark, raw, [1980], "origination")


def test_bronze_panel_is_partitioned(spark, raw, tmp_path):
    out = str(tmp_path / "bronze")
    table = ingest.ingest(spark, raw, [2005, 2009], "performance", out)
    assert table.count() == 60
    assert {d for d in os.listdir(out) if "=" in d} == {f"reporting_year={y}" for y in (2005, 2006, 2009)}
    assert dict(table.dtypes)["reporting_year"] == "int"


def test_increment_keeps_other_partitions(spark, raw, tmp_path):
    out = str(tmp_path / "bronze")
    ingest.ingest(spark, raw, [2005], "performance", out)
    new = ingest.read_years(spark, raw, [2009], "performance")
    storage.write_parquet(new, out, ["reporting_year"], increment=True)
    assert spark.read.parquet(out).count() == 60


def test_streaming_ingest_reads_each_file_once(spark, raw, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    streaming.append_new_files(spark, raw, "performance", out, state)
    streaming.append_new_files(spark, raw, "performance", out, state)
    assert spark.read.parquet(out).count() == 60
    extra = "\n".join(perf_line("F10Q10000009", f"2010{m:02d}") for m in range(1, 4))
    with open(f"{raw}/sample_svcg_2010.txt", "w") as f:
        f.write(extra + "\n")
    streaming.append_new_files(spark, raw, "performance", out, state)
    got = spark.read.parquet(out)
    assert got.count() == 63
    assert got.filter("vintage_year = 2010").count() == 3


def test_skip_if_present_and_force(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    assert storage.unless_present(spark, path, build).count() == 1
    assert storage.unless_present(spark, path, build).count() == 1
    assert storage.unless_present(spark, path, build, force=True).count() == 2
    assert len(calls) == 2


def test_stages_run_in_order_over_layers(spark, raw, tmp_path):
    root = str(tmp_path / "layers")
    stages = dataset.data_stages(spark, raw, root, [2005, 2009])
    results = dataset.run_stages(stages)
    assert list(results) == ["ingest", "clean", "features", "target", "dataset"]
    splits = {r["split"] for r in results["dataset"].select("split").distinct().collect()}
    assert splits <= {"train", "validation", "test"} and "test" in splits
    assert results["dataset"].filter("target = 1").count() > 0
    status = rows(storage.dataset_status(spark, {"a": f"{root}/dataset", "b": f"{root}/nothing"}), "dataset")
    assert [r["present"] for r in status] == [True, False]
    with pytest.raises(ValueError):
        dataset.run_stages(stages, ["nonsense"])


def test_split_scan_prefers_the_sample(spark, tmp_path):
    full, sampled = str(tmp_path / "full"), str(tmp_path / "sampled")
    table = spark.range(10).withColumn("split", F.lit("train")).withColumn(c.KEY, F.lit("x"))
    storage.write_splits(table, full)
    assert storage.read_split(spark, full, "train", sampled).count() == 10
    storage.write_splits(table.limit(4), sampled)
    assert storage.read_split(spark, full, "train", sampled).count() == 4
    assert storage.read_split(spark, full, "validation", optional=True) is None
    with pytest.raises(FileNotFoundError):
        storage.read_split(spark, full, "test")


def test_first_readable(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "b"))
    assert storage.first_readable(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).count() == 3
    with pytest.raises(FileNotFoundError):
        storage.first_readable(spark, [str(tmp_path / "a")])


def test_csv_and_parameters_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("logistic", 0.8), ("forest", 0.7)], "model string, roc_auc double")
    storage.write_csv(df, str(tmp_path / "csv"))
    back = storage.read_csv(spark, str(tmp_path / "csv"), "model string, roc_auc double")
    assert rows(back, "model") == rows(df, "model")
    assert storage.read_parameters(spark, str(tmp_path / "none")) == {}
    parameters = {"logistic": {"C": 0.5, "class_weight": None}}
    storage.write_parameters(spark, str(tmp_path / "json"), parameters)
    assert storage.read_parameters(spark, str(tmp_path / "json")) == parameters
