"""Feature preparation as pyspark.ml stages, fitted once and saved with the model."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import (
    SQLTransformer, StandardScaler, StringIndexer, TargetEncoder, VectorAssembler,
)
from pyspark.sql import DataFrame, functions as F

from loanweave.columns import MISSING_TEXT

LABEL = "label"
WEIGHT = "weight"


def _quoted(name: str) -> str:
    return f"`{name}`"


def fill_stage(categorical: Sequence[str], numeric: Sequence[str], prefix: str = "") -> SQLTransformer:
    """Categories as text with MISSING, numbers as doubles with 0.  A SQL stage, so it is
    saved with the pipeline and runs as ordinary column expressions."""
    text = [
        f"CASE WHEN {_quoted(n)} IS NULL OR CAST({_quoted(n)} AS STRING) IN ('nan', 'None', '') "
        f"THEN '{MISSING_TEXT}' ELSE CAST({_quoted(n)} AS STRING) END AS {_quoted(f'{prefix}_text_{n}')}"
        for n in categorical
    ]
    numbers = [
        f"COALESCE(NANVL(CAST({_quoted(n)} AS DOUBLE), CAST(0 AS DOUBLE)), CAST(0 AS DOUBLE)) "
        f"AS {_quoted(f'{prefix}_num_{n}')}"
        for n in numeric
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(text + numbers)} FROM __THIS__")


def preparation_stages(
    categorical: Sequence[str],
    numeric: Sequence[str],
    *,
    prefix: str = "",
    scale: bool = False,
    target_encode: bool = False,
    output: str | None = None,
) -> list[Estimator | Transformer]:
    """Stages from raw feature columns to one vector column.

    Categories are numbered alphabetically at fit time and the same numbers are used ever
    after; a category first seen later gets the extra last number.  ``target_encode``
    replaces the numbers by smoothed target rates.
    """
    output = output or f"{prefix}features"
    stages: list[Estimator | Transformer] = [fill_stage(categorical, numeric, prefix)]
    codes = [f"{prefix}_code_{n}" for n in categorical]
    if categorical:
        stages.append(
            StringIndexer(
                inputCols=[f"{prefix}_text_{n}" for n in categorical], outputCols=codes,
                stringOrderType="alphabetAsc", handleInvalid="keep",
            )
        )
    if categorical and target_encode:
        rates = [f"{prefix}_rate_{n}" for n in categorical]
        stages.append(
            TargetEncoder(
                inputCols=codes, outputCols=rates, labelCol=LABEL, targetType="binary",
                handleInvalid="keep", smoothing=1.0,
            )
        )
        codes = rates
    inputs = [*codes, *[f"{prefix}_num_{n}" for n in numeric]]
    vector = f"{prefix}_unscaled" if scale else output
    stages.append(VectorAssembler(inputCols=inputs, outputCol=vector))
    if scale:
        stages.append(
            StandardScaler(inputCol=vector, outputCol=output, withMean=True, withStd=True)
        )
    return stages


def feature_groups(
    names: Sequence[str], configured: Sequence[str]
) -> tuple[list[str], list[str]]:
    """(categorical, numeric) in the order of ``names``."""
    return [n for n in names if n in configured], [n for n in names if n not in configured]


def class_weights(df: DataFrame, scheme: str | float | None, label: str = LABEL) -> DataFrame:
    """Weight per class, as a table of one row per class.

    ``balanced`` gives rows / (classes x class rows); ``sqrt_balanced`` its square root;
    ``unbalance`` weighs positives by negatives / positives; a number weighs positives by
    it; None weighs everything 1.
    """
    counts = df.groupBy(label).agg(F.count("*").cast("double").alias("_n"))
    totals = counts.agg(
        F.sum("_n").alias("_rows"),
        F.count("*").alias("_classes"),
        F.sum(F.when(F.col(label) == 1, F.col("_n"))).alias("_pos"),
        F.sum(F.when(F.col(label) == 0, F.col("_n"))).alias("_neg"),
        F.lit(1).alias("_one"),
    )
    even = F.col("_rows") / (F.col("_classes") * F.col("_n"))
    if scheme is None:
        weight = F.lit(1.0)
    elif scheme == "balanced":
        weight = even
    elif scheme == "sqrt_balanced":
        weight = F.sqrt(even)
    elif scheme == "unbalance":
        weight = F.when(F.col(label) == 1, F.col("_neg") / F.col("_pos")).otherwise(1.0)
    else:
        weight = F.when(F.col(label) == 1, float(scheme)).otherwise(1.0)
    joined = counts.withColumn("_one", F.lit(1)).join(totals, "_one")
    return joined.select(label, weight.alias(WEIGHT))


def collected_weights(df: DataFrame, scheme: str | float | None, label: str = LABEL) -> Mapping[int, float]:
    """``class_weights`` as a dictionary: two entries."""
    return {r[label]: r[WEIGHT] for r in class_weights(df, scheme, label).collect()}


def weights_of_counts(counts: Mapping[int, int], scheme: str | float | None) -> Mapping[int, float]:
    """``class_weights`` of classes 0 and 1 whose rows are counted already."""
    even = {c: sum(counts.values()) / (len(counts) * n) for c, n in counts.items()}
    if scheme is None:
        return dict.fromkeys(counts, 1.0)
    if scheme == "balanced":
        return even
    if scheme == "sqrt_balanced":
        return {c: math.sqrt(w) for c, w in even.items()}
    return {0: 1.0, 1: counts[0] / counts[1] if scheme == "unbalance" else float(scheme)}


def add_weight(df: DataFrame, weights: Mapping[int, float], label: str = LABEL, name: str = WEIGHT) -> DataFrame:
    column = F.lit(1.0)
    for value, weight in weights.items():
        column = F.when(F.col(label) == value, F.lit(float(weight))).otherwise(column)
    return df.withColumn(name, column)


def fill_missing_categories(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    from loanweave.functions.expressions import missing_text

    return df.withColumns({n: missing_text(n) for n in categorical})


def restrict_to_known(column: str, known: Sequence[str]):
    """Category text with unseen values replaced by MISSING."""
    text = F.col(column).cast("string")
    return F.when(text.isin(*known), text).otherwise(F.lit(MISSING_TEXT))
