"""Tables of a layered job: versions swapped by one manifest, laid out once by key.

A table is a folder of versions.  A new version is written beside the current one and becomes
current when one small manifest file appears under its final name, so readers and a lost
driver see either the old table with its note or the new one with its own, never a mixture.

A layout with buckets clusters rows by key on disk.  Windows, aggregates and joins by that key
then read the table without moving a row, and so do the tables made from it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loanweave.columns import KEY, TIME

MANIFESTS = "_manifest"


@dataclass(frozen=True)
class Layout:
    """How a table lies on disk; ``buckets`` should keep one bucket within a task's memory and disk."""

    buckets: int | None = None
    key: str = KEY
    sort_by: tuple[str, ...] = (KEY, TIME)
    partition_by: tuple[str, ...] = ()


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what a folder holds, none if it does not exist."""
    hadoop, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What the current version is: ``folder``, ``layout``, ``schema`` and ``made_from``."""
    root = path.rstrip("/")
    done = [n for n in _names(spark, f"{root}/{MANIFESTS}") if n.endswith(".json")]
    if not done:
        return None
    text = spark.read.text(f"{root}/{MANIFESTS}/{done[-1]}", wholetext=True).first()[0]
    return {**json.loads(text), "number": int(done[-1].split(".")[0])}


def _swap(spark: SparkSession, root: str, held: Mapping) -> None:
    """Make a version current: its manifest gets its final name in one rename."""
    number = held["number"]
    draft, fs = _file_system(spark, f"{root}/{MANIFESTS}/draft-{uuid.uuid4().hex}")
    final, _ = _file_system(spark, f"{root}/{MANIFESTS}/{number:08d}.json")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(dict(held), sort_keys=True).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"{root} got version {number} from another job")


def _drop_old(spark: SparkSession, root: str, keep: int) -> None:
    """Remove versions before the previous one, which readers may still hold."""
    for name in _names(spark, f"{root}/{MANIFESTS}"):
        if name.endswith(".json") and int(name.split(".")[0]) < keep:
            file, fs = _file_system(spark, f"{root}/{MANIFESTS}/{name}")
            held = json.loads(spark.read.text(file.toString(), wholetext=True).first()[0])
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(held['folder'])}")
            fs.delete(_file_system(spark, held["folder"])[0], True)
            fs.delete(file, False)


def _table_name(folder: str) -> str:
    return "layer_" + hashlib.md5(folder.encode()).hexdigest()


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _open(spark: SparkSession, held: Mapping) -> DataFrame:
    schema, layout, folder = StructType.fromJson(held["schema"]), held["layout"], held["folder"]
    if not layout["buckets"]:
        return spark.read.schema(schema).parquet(folder)
    name = _table_name(folder)
    if not spark.catalog.tableExists(name):
        # another session wrote the files: tell this one's catalog how they lie
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f"PARTITIONED BY ({_quoted(layout['partition_by'])})" if layout["partition_by"] else ""
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{folder}') {by} "
            f"CLUSTERED BY (`{layout['key']}`) SORTED BY ({_quoted(layout['sort_by'])}) INTO {layout['buckets']} BUCKETS"
        )
        if layout["partition_by"]:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table."""
    held = manifest(spark, path)
    if held is None:
        raise FileNotFoundError(f"{path} has no version yet")
    return _open(spark, held)


def write_layer(
    df: DataFrame, path: str, layout: Layout = Layout(), made_from: Mapping | None = None, laid_out: bool = False,
) -> DataFrame:
    """Write a new version, make it current and return it.

    ``laid_out`` states that ``df`` comes from tables of the same layout, key and bucket
    number; it is then written as it lies, otherwise its rows are dealt to the buckets first.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    last = manifest(spark, root)
    number = last["number"] + 1 if last else 1
    folder = f"{root}/v{number:08d}-{uuid.uuid4().hex[:8]}"
    if layout.buckets and not laid_out:
        df = df.repartition(layout.buckets, layout.key)
    writer = df.write.format("parquet").option("compression", "snappy").mode("errorifexists")
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    if layout.buckets:
        writer = writer.bucketBy(layout.buckets, layout.key).sortBy(*layout.sort_by)
        writer.option("path", folder).saveAsTable(_table_name(folder))
        schema = spark.table(_table_name(folder)).schema
    else:
        writer.save(folder)
        names = [n for n in df.columns if n not in layout.partition_by]
        schema = df.select(*names, *layout.partition_by).schema
    held = {
        "number": number, "folder": folder, "layout": asdict(layout), "schema": schema.jsonValue(),
        "made_from": None if made_from is None else json.dumps(made_from, sort_keys=True),
    }
    _swap(spark, root, held)
    _drop_old(spark, root, number - 1)
    return _open(spark, held)


def layer(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], layout: Layout = Layout(), made_from: Mapping | None = None,
    force: bool = False, laid_out: bool = False,
) -> DataFrame:
    """The current version if it was made from the same inputs and parameters, else a new one."""
    held = manifest(spark, path)
    wanted = None if made_from is None else json.dumps(made_from, sort_keys=True)
    layout_now = json.loads(json.dumps(asdict(layout)))
    if held and not force and held["layout"] == layout_now and wanted in (None, held["made_from"]):
        return _open(spark, held)
    return write_layer(build(), path, layout, made_from, laid_out)


def replace_partitions(df: DataFrame, path: str) -> DataFrame:
    """Put rows in place of the current version's partitions that occur in ``df``; others stay.

    ``df`` may come from that very table, as far as it has the same layout.  Running it twice
    gives the same table.
    """
    spark = df.sparkSession
    held = manifest(spark, path)
    if held is None or not held["layout"]["partition_by"]:
        raise ValueError(f"{path} has no partitioned version")
    table = _open(spark, held)
    rows = df.select(*table.columns)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        if held["layout"]["buckets"]:
            rows.write.mode("overwrite").insertInto(_table_name(held["folder"]))
        else:
            rows.write.mode("overwrite").partitionBy(*held["layout"]["partition_by"]).parquet(held["folder"])
    finally:
        spark.conf.set(mode, before)
    return _open(spark, held)
