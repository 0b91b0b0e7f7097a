"""Data-quality reports: code violations, unmapped codes, missing vintages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from loanweave import columns as c


def _long(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("value")) for n in names]
            )
        ).alias("cell")
    ).select("cell.column", "cell.value")


def code_violations(df: DataFrame, valid: Mapping[str, Sequence[str]] = c.VALID_CODES) -> DataFrame:
    """Per rule: rows checked and rows whose code is set but not valid.  One pass."""
    rules = {n: codes for n, codes in valid.items() if n in df.columns}
    counted = df.agg(
        *[F.count(n).alias(f"{n}__checked") for n in rules],
        *[
            F.sum(F.when(~F.col(n).isin(*codes), 1).otherwise(0)).alias(f"{n}__bad")
            for n, codes in rules.items()
        ],
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column"),
                        F.col(f"{n}__checked").alias("checked"),
                        F.coalesce(F.col(f"{n}__bad"), F.lit(0)).cast("bigint").alias("violations"),
                    )
                    for n in rules
                ]
            )
        )
    )


def unmapped_values(
    raw: DataFrame,
    dictionaries: Mapping[str, Mapping[str, int]],
    not_available: Mapping[str, Sequence[str]] = c.NOT_AVAILABLE_CODES,
) -> DataFrame:
    """Codes that a dictionary silently turns into NULL, with their row counts.

    Codes that are documented as "not available" are not reported.
    """
    names = [n for n in dictionaries if n in raw.columns]
    known = F.create_map(
        *[
            part
            for n in names
            for part in (
                F.lit(n),
                F.array(*[F.lit(v) for v in (*dictionaries[n], *not_available.get(n, ()))]),
            )
        ]
    )
    cells = _long(raw, names).filter(F.col("value").isNotNull())
    return (
        cells.filter(~F.array_contains(F.try_element_at(known, F.col("column")), F.col("value")))
        .groupBy("column", "value")
        .agg(F.count("*").alias("rows"))
    )


def missing_vintages(
    df: DataFrame, first: int = 1999, last: int = 2012, vintage: str = "vintage_year"
) -> DataFrame:
    """Expected vintages that do not occur in the data."""
    expected = df.sparkSession.range(first, last + 1).select(
        F.col("id").cast("int").alias(vintage)
    )
    found = df.select(F.col(vintage).cast("int").alias(vintage)).distinct()
    return expected.join(found, vintage, "left_anti")
