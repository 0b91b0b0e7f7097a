"""Reading the pipe-delimited yearly extracts into partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from loanweave import columns as c
from loanweave.sources.storage import existing_paths, write_parquet

LAYOUTS = {"origination": c.ORIGINATION_DDL, "performance": c.PERFORMANCE_DDL}
FILE_PREFIXES = {"origination": "sample_orig", "performance": "sample_svcg"}
YEAR_IN_NAME = r"_(\d{4})\.[^/]*$"


def read_extract(spark: SparkSession, paths: str | Sequence[str], layout: str) -> DataFrame:
    """Pipe-delimited text without header; a field that does not parse becomes NULL."""
    return spark.read.schema(LAYOUTS[layout]).csv(
        [paths] if isinstance(paths, str) else list(paths),
        sep="|", header=False, mode="PERMISSIVE",
    )


def add_lineage(df: DataFrame, vintage: Column | int) -> DataFrame:
    year = vintage if isinstance(vintage, Column) else F.lit(vintage)
    return df.withColumns(
        {"vintage_year": year.cast("int"), "ingestion_timestamp": F.current_timestamp()}
    )


def add_reporting_year(df: DataFrame, time: str = c.TIME) -> DataFrame:
    return df.withColumn("reporting_year", F.substring(time, 1, 4))


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows with a loan id; every reader of extracts applies this rule."""
    return df.filter(F.col(c.KEY).isNotNull())


def rejected_rows(df: DataFrame) -> DataFrame:
    """Rows without a loan id, which no table can hold under a key."""
    return df.filter(F.col(c.KEY).isNull())


def read_origination(spark: SparkSession, path: str, year: int) -> DataFrame:
    return valid_rows(add_lineage(read_extract(spark, path, "origination"), year))


def read_performance(spark: SparkSession, path: str, year: int) -> DataFrame:
    return valid_rows(add_reporting_year(add_lineage(read_extract(spark, path, "performance"), year)))


def read_years(
    spark: SparkSession,
    directory: str,
    years: Sequence[int],
    layout: str,
    prefix: str | None = None,
    rejected: bool = False,
) -> DataFrame:
    """All years that are present, as ONE scan; the vintage comes from the file name.

    Years without a file are skipped; no file at all is an error.  ``rejected`` returns the
    rows that have no loan id instead of those that have one.
    """
    prefix = prefix or FILE_PREFIXES[layout]
    wanted = [f"{directory.rstrip('/')}/{prefix}_{year}.txt" for year in years]
    found = existing_paths(spark, wanted)
    if not found:
        raise FileNotFoundError(f"no {prefix}_<year>.txt for {list(years)} in {directory}")
    raw = read_extract(spark, found, layout)
    year = F.regexp_extract(F.col("_metadata.file_path"), YEAR_IN_NAME, 1)
    df = (rejected_rows if rejected else valid_rows)(add_lineage(raw, year))
    return add_reporting_year(df) if layout == "performance" else df


CORRUPT, STATUS = "_corrupt_record", "_status"
STATUSES = ("good", "repaired", "rejected")


def all_records(spark: SparkSession, directory: str, years: Sequence[int], layout: str) -> tuple[DataFrame, Observation]:
    """Every line of the years in ONE scan, none lost, and counts by status from the same pass.

    ``_status`` is ``rejected`` for lines without a loan id, ``repaired`` for lines in which a
    field did not parse (it is NULL then) or whose number of fields is wrong, else ``good``;
    ``_corrupt_record`` holds the text of lines that are not as the layout wants them.  The
    observation has its counts once the frame was written.
    """
    found = existing_paths(spark, [f"{directory.rstrip('/')}/{FILE_PREFIXES[layout]}_{year}.txt" for year in years])
    if not found:
        raise FileNotFoundError(f"no {FILE_PREFIXES[layout]}_<year>.txt for {list(years)} in {directory}")
    lines = spark.read.schema(f"{LAYOUTS[layout]}, {CORRUPT} string").csv(
        found, sep="|", header=False, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )
    year = F.regexp_extract(F.col("_metadata.file_path"), YEAR_IN_NAME, 1)
    status = F.when(F.col(c.KEY).isNull(), "rejected").when(F.col(CORRUPT).isNotNull(), "repaired").otherwise("good")
    df = add_lineage(lines, year).withColumn(STATUS, status)
    if layout == "performance":
        df = df.withColumn("reporting_year", F.substring(c.TIME, 1, 4).try_cast("int"))
    counts = Observation()
    return df.observe(counts, *[F.count_if(F.col(STATUS) == n).alias(n) for n in STATUSES]), counts


def usable_records(records: DataFrame) -> DataFrame:
    """The good and the repaired rows of a bronze table, as the layout wants them."""
    return records.filter(F.col(STATUS) != "rejected").drop(STATUS, CORRUPT)


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that some year lacks is NULL there."""
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined


def record_counts(df: DataFrame, vintage: str = "vintage_year") -> DataFrame:
    """Records per vintage and in total (NULL vintage), from one job."""
    return df.rollup(vintage).agg(F.count("*").alias("records"))


def ingest(
    spark: SparkSession,
    directory: str,
    years: Sequence[int],
    layout: str,
    output: str,
    prefix: str | None = None,
) -> DataFrame:
    """Bronze table from the yearly extracts; the panel is partitioned by reporting year.

    Rows without a loan id go to ``<output>_rejected``, so that none is lost unseen.
    """
    df = read_years(spark, directory, years, layout, prefix)
    write_parquet(read_years(spark, directory, years, layout, prefix, rejected=True), f"{output.rstrip('/')}_rejected")
    partition = ["reporting_year"] if layout == "performance" else []
    return write_parquet(df, output, partition)
