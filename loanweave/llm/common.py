"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from loanweave.operators.ranking import rounded_up
from loanweave.session import ensure_checkpoint_dir

#: Rows and bytes of one Arrow batch, so that a worker's memory does not depend on row length.
BATCH_ROWS = 1_000
BATCH_BYTES = 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by rows and bytes for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read back: computed once, lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def among_smallest(df: DataFrame, hashed: Column, n: int) -> Column:
    """A condition that the ``n`` smallest different hashes meet, and few others.

    Hashes are 64 bits wide.  A histogram of at most some 1,700 rows comes to the driver;
    nothing is sorted, and no other column moves.
    """

    def high(column: Column) -> Column:
        return F.shiftrightunsigned(column.bitwiseXOR(F.lit(-(2**63))), 32)

    different = df.select(hashed.alias("hash")).distinct()
    sizes = different.groupBy(rounded_up(high(F.col("hash"))).alias("reach")).count()
    reach, found = -1, 0
    for r in sorted(sizes.collect()):
        if found >= n:
            break
        reach, found = r["reach"], found + r["count"]
    return high(hashed) <= reach


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def emit(schema: StructType, columns: list[list | pa.Array]) -> pa.RecordBatch:
    """A batch of the Spark schema from lists or Arrow arrays."""
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, to_arrow_type(f.dataType))
        for c, f in zip(columns, schema.fields, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def annotate(
    df: DataFrame,
    inputs: list[str],
    fields: str,
    start: Callable[[], Callable[..., list]],
) -> DataFrame:
    """Append columns computed in Python, batch by batch; every row and column stays.

    ``start()`` runs once per task and returns a function from the input columns (Arrow
    arrays) to the new columns.  A new column replaces an input column of the same name.
    """
    bounded_batches(df.sparkSession)
    new: StructType = _parse_datatype_string(fields)
    kept = [f for f in df.schema.fields if f.name not in new.names]
    schema = StructType([StructField(f.name, f.dataType, True) for f in kept] + new.fields)
    positions = [df.columns.index(c) for c in inputs]
    keep = [df.columns.index(f.name) for f in kept]
    types = [to_arrow_type(f.dataType) for f in new.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = work(*[batch.column(p) for p in positions])
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(out, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + arrays, names=schema.names)

    return df.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """Strings of a column, null as empty."""
    return [t or "" for t in column.to_pylist()]
