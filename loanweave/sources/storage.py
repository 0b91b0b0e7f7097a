"""Parquet, CSV and JSON tables; path checks through the Hadoop file system."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Works for any storage Spark can read, not only local folders."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    return [p for p in paths if path_exists(spark, p)]


def first_readable(spark: SparkSession, candidates: Sequence[str]) -> DataFrame:
    """The first Parquet table of a candidate list that exists."""
    found = existing_paths(spark, candidates)
    if not found:
        raise FileNotFoundError(f"none of {list(candidates)} exists")
    return spark.read.parquet(found[0])


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
    increment: bool = False,
) -> DataFrame:
    """Write snappy Parquet and return the table read back (so lineage ends here).

    A partitioned table is rebalanced by its partition columns first, so that each folder
    gets few files; AQE splits a partition value that is larger than the advisory size
    over several tasks, so a hot year is not one task.  ``increment`` replaces only the
    partitions that occur in ``df`` and keeps the others.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).option("compression", "snappy").option(
        "partitionOverwriteMode", "dynamic" if increment else "static"
    ).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def unless_present(
    spark: SparkSession, path: str, build: Callable[[], DataFrame],
    force: bool = False, partition_by: Sequence[str] = (), made_from: Mapping | None = None,
) -> DataFrame:
    """Read the table at ``path``; build and write it first if absent or ``force``.

    ``made_from`` (parameters and inputs, JSON) is stored beside the table; a table that was
    made from something else is stale and built again.
    """
    note = f"{path.rstrip('/')}_made_from"
    wanted = None if made_from is None else json.dumps(made_from, sort_keys=True)
    if not force and path_exists(spark, f"{path}/_SUCCESS"):
        if wanted is None or (
            path_exists(spark, f"{note}/_SUCCESS") and spark.read.text(note).first()[0] == wanted
        ):
            return spark.read.parquet(path)
    if wanted is not None and path_exists(spark, note):
        # the old note goes before the table changes: a job lost in between is made again
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(note)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    table = write_parquet(build(), path, partition_by)
    if wanted is not None:
        spark.createDataFrame([(wanted,)], "value string").coalesce(1).write.mode("overwrite").text(note)
    return table


def file_sizes(spark: SparkSession, paths: Sequence[str]) -> dict[str, int]:
    """Bytes of each path that exists."""
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    found = {}
    for path in existing_paths(spark, paths):
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        found[path] = hadoop.getFileSystem(conf).getContentSummary(hadoop).getLength()
    return found


def file_states(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[int]]:
    """Bytes and modification time of each path that exists."""
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    found = {}
    for path in existing_paths(spark, paths):
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        status = hadoop.getFileSystem(conf).getFileStatus(hadoop)
        found[path] = [status.getLen(), status.getModificationTime()]
    return found


def dataset_status(spark: SparkSession, expected: Mapping[str, str]) -> DataFrame:
    """Which of the required tables are present, one row each."""
    rows = [(name, path, path_exists(spark, path)) for name, path in expected.items()]
    return spark.createDataFrame(rows, "dataset string, path string, present boolean")


def write_splits(splits: DataFrame, path: str, split: str = "split") -> DataFrame:
    """Train, validation and test rows in ONE pass, as partitions of one table."""
    return write_parquet(splits, path, [split])


def read_split(
    spark: SparkSession, path: str, name: str, sampled_path: str | None = None,
    optional: bool = False,
) -> DataFrame | None:
    """One split (partition-pruned); the sampled copy when one is given and present."""
    root = sampled_path if sampled_path and path_exists(spark, sampled_path) else path
    if not path_exists(spark, f"{root}/split={name}"):
        if optional:
            return None
        raise FileNotFoundError(f"{root} has no split {name!r}")
    return spark.read.parquet(root).filter(F.col("split") == name).drop("split")


def write_csv(df: DataFrame, path: str) -> None:
    """A report with header.  Spark writes one file per partition; reports are small."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with header under an explicit schema: no inference pass over the data."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_parameters(spark: SparkSession, path: str, parameters: Mapping) -> None:
    """Tuned parameters: one small JSON document per model."""
    rows = [(name, json.dumps(values)) for name, values in parameters.items()]
    spark.createDataFrame(rows, "model string, parameters string").coalesce(1).write.mode(
        "overwrite"
    ).json(path)


def read_parameters(spark: SparkSession, path: str) -> dict:
    """Tuned parameters, or an empty dictionary when none were saved."""
    if not path_exists(spark, path):
        return {}
    rows = spark.read.schema("model string, parameters string").json(path).collect()
    return {r.model: json.loads(r.parameters) for r in rows}
