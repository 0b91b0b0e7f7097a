"""Incremental ingest: each run appends only the extract files it has not seen.

The batch ingest rewrites the bronze table from all years.  When a new year arrives, this
job reads that file alone; the file source's checkpoint remembers what was loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.sources.ingest import (
    FILE_PREFIXES, LAYOUTS, YEAR_IN_NAME, add_lineage, add_reporting_year, rejected_rows, valid_rows,
)


def stream_extracts(
    spark: SparkSession, directory: str, layout: str, prefix: str | None = None, rejected: bool = False
) -> DataFrame:
    """The extract files of a folder as a stream, with the columns and the rule of the batch read."""
    pattern = f"{prefix or FILE_PREFIXES[layout]}_*.txt"
    raw = (
        spark.readStream.schema(LAYOUTS[layout])
        .option("sep", "|").option("mode", "PERMISSIVE").option("pathGlobFilter", pattern)
        .csv(directory)
    )
    year = F.regexp_extract(F.col("_metadata.file_path"), YEAR_IN_NAME, 1)
    rows = (rejected_rows if rejected else valid_rows)(add_lineage(raw, year))
    return add_reporting_year(rows) if layout == "performance" else rows


def append_new_files(
    spark: SparkSession, directory: str, layout: str, output: str, checkpoint: str,
    prefix: str | None = None,
) -> None:
    """Append all unseen files to the bronze table and stop.

    ``checkpoint`` is a folder on the same shared storage as ``output``.  Rows without a loan
    id are appended to ``<output>_rejected``.
    """
    for rejected, ending in ((False, ""), (True, "_rejected")):
        writer = (
            stream_extracts(spark, directory, layout, prefix, rejected)
            .writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", f"{checkpoint.rstrip('/')}{ending}")
            .option("path", f"{output.rstrip('/')}{ending}")
            .trigger(availableNow=True)
        )
        if layout == "performance" and not rejected:
            writer = writer.partitionBy("reporting_year")
        writer.start().awaitTermination()
