"""Column profiling: cardinality, nulls, constants, dominant values, category candidates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from loanweave import columns as c

# Thresholds of the profile.
LOW_CARDINALITY = 50
NEAR_CONSTANT = 0.995
HIGH_CARDINALITY = 100
REVIEW_CARDINALITY = 20
REVIEW_VALUES = 15
#: Values that a sketch of frequent values tracks per column, and those counted exactly after.
TRACKED_VALUES, COUNTED_VALUES = 1024, 4
#: How values of all columns share one table: every value is in one of these columns.
KINDS = {"number": "double", "whole": "bigint", "text": "string"}


def is_text(field: T.StructField) -> bool:
    """Neither a number nor a timestamp."""
    return not isinstance(field.dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_text(f)]


def value_kind(field: T.StructField) -> str:
    """The column of ``column_values`` that holds a field's values without loss."""
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return "number"
    return "whole" if isinstance(field.dataType, T.IntegralType) else "text"


def column_values(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Long form: one row per cell with the ``column``'s place in the names and its value.

    Numbers stay numbers, because turning each into text costs more than counting it.
    """
    kinds = {f.name: value_kind(f) for f in df.schema.fields}
    cells = [
        F.struct(F.lit(k).alias("column"), *[
            (F.col(f"`{n}`") if kinds[n] == kind else F.lit(None)).cast(as_type).alias(kind) for kind, as_type in KINDS.items()
        ])
        for k, n in enumerate(names if names is not None else df.columns)
    ]
    return df.select(F.inline(F.array(*cells)))


def value_counts(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Rows per column and value, NULL included.  Counted before anything is shuffled."""
    names = list(names if names is not None else df.columns)
    counts = column_values(df, names).groupBy("column", *KINDS).agg(F.count("*").alias("n"))
    return counts.select(
        F.get(F.lit(names), "column").alias("column"), reduce(or_, [F.col(k).isNotNull() for k in KINDS]).alias("known"), "n"
    )


def exact_statistics(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Exact cardinality, null rate and dominant share of every column, from one shuffle."""
    rows = F.sum("n")
    return value_counts(df, names).groupBy("column").agg(
        F.count_if("known").alias("cardinality"),
        (F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))) / rows).alias("null_rate"),
        (F.max("n") / rows).alias("dominant_value_share"),
    )


def dominant_shares(
    df: DataFrame, names: Sequence[str] | None = None, tracked: int = TRACKED_VALUES, counted: int = COUNTED_VALUES
) -> DataFrame:
    """Exact share of every column's most frequent value (NULL is one), at any cardinality.

    One pass keeps a mergeable sketch of frequent values per column, a second counts the few
    likeliest values of each exactly.  A value that the sketch did not name cannot have more
    than twice the sketch's error of 3.5 rows in ``tracked``, nor more than the last one named
    if ``counted`` were; a column whose counted values reach that is settled without moving a
    cell.  Only the others are counted value by value.  An empty table has no shares.
    """
    names = list(names if names is not None else df.columns)
    kinds = {f.name: value_kind(f) for f in df.schema.fields}
    # adding 0 makes -0.0 the 0.0 that it equals
    values = [F.col(f"`{n}`") + 0.0 if kinds[n] == "number" else F.col(f"`{n}`") for n in names]
    text = df.select(*[v.cast("string").alias(f"c{k}") for k, v in enumerate(values)])
    sketches = [F.expr(f"approx_top_k(c{k}, {counted}, {tracked})").alias(f"c{k}") for k in range(len(names))]
    found = text.agg(F.count("*").alias("rows"), *sketches).first()
    rows = found["rows"]
    schema = "column string, dominant_value_share double"
    if not rows or not names:
        return df.sparkSession.createDataFrame([], schema)
    hits = [
        F.count_if(F.col(f"c{k}").eqNullSafe(F.lit(top["item"]))).alias(f"c{k}_{i}")
        for k in range(len(names)) for i, top in enumerate(found[f"c{k}"])
    ]
    exact = text.agg(*hits).first() if hits else {}
    settled, open_ = [], []
    for k, name in enumerate(names):
        tops = found[f"c{k}"]
        best = max((exact[f"c{k}_{i}"] for i in range(len(tops))), default=0)
        unnamed = max(7 * rows / tracked, tops[-1]["count"] if len(tops) == counted else 0)
        settled.append((name, best / rows)) if best >= unnamed else open_.append(name)
    shares = df.sparkSession.createDataFrame(settled, schema)
    if not open_:
        return shares
    rest = value_counts(df, open_).groupBy("column").agg((F.max("n") / F.lit(rows)).alias("dominant_value_share"))
    return shares.unionByName(rest)


def approx_cardinality(name: str, log2_registers: int = 12) -> Column:
    """HyperLogLog estimate of the distinct values (about 1.6 % error; small sets exact).

    The sketch is one binary buffer, so dozens of them fit one aggregation;
    ``approx_count_distinct`` would spread hundreds of buffer fields per column.
    """
    value = F.col(name)
    hashed = F.when(value.isNotNull(), F.xxhash64(value))
    sketch = F.hll_sketch_agg(hashed, F.lit(log2_registers))
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("bigint")


def wide_statistics(df: DataFrame) -> DataFrame:
    """One row with approximate cardinality, null rate and constancy of every column.

    A single map-side aggregation: the shuffle carries one sketch per column and task.
    """
    outputs: list[Column] = [F.count("*").alias("rows")]
    for field in df.schema.fields:
        name = field.name
        outputs.append(approx_cardinality(name).alias(f"{name}__cardinality"))
        outputs.append(F.avg(F.col(name).isNull().cast("int")).alias(f"{name}__nulls"))
        constant = F.lit(False) if is_text(field) else F.min(name) == F.max(name)
        outputs.append(F.coalesce(constant, F.lit(False)).alias(f"{name}__constant"))
    return df.agg(*outputs)


def tall_statistics(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """``wide_statistics`` with one row per column."""
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("column"),
                        F.col(f"{n}__cardinality").alias("cardinality"),
                        F.col(f"{n}__nulls").alias("null_rate"),
                        F.col(f"{n}__constant").alias("is_constant_numeric"),
                    )
                    for n in names
                ]
            )
        )
    )


def schema_table(df: DataFrame, categorical: Sequence[str], dropped: Sequence[str]) -> DataFrame:
    """One row per column: its type and whether the configuration names it."""
    rows = [
        (f.name, f.dataType.simpleString(), is_text(f), f.name in categorical, f.name in dropped)
        for f in df.schema.fields
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column string, dtype string, is_object_dtype boolean, "
        "in_config_categorical_features boolean, in_config_drop_features boolean",
    )


def near_constant(statistics: DataFrame, threshold: float = NEAR_CONSTANT) -> DataFrame:
    return statistics.filter(F.col("dominant_value_share") > threshold)


def high_cardinality_text(profile: DataFrame, threshold: int = HIGH_CARDINALITY) -> DataFrame:
    return profile.filter(F.col("is_object_dtype") & (F.col("cardinality") > threshold))


def column_profile(
    df: DataFrame,
    categorical: Sequence[str] = c.CATEGORICAL_FEATURES,
    dropped: Sequence[str] = c.DROP_FEATURES,
    exact: bool = False,
) -> DataFrame:
    """The consolidated profile, one row per column.

    By default cardinalities are HyperLogLog estimates, as is usual at this size, and only
    columns estimated to have few values are counted value by value.  ``exact`` counts all.
    """
    schema = schema_table(df, categorical, dropped)
    if exact:
        numeric = ~F.col("is_object_dtype")
        statistics = exact_statistics(df).withColumn(
            "dominant_value_share",
            F.when(F.col("cardinality") <= LOW_CARDINALITY, F.col("dominant_value_share")),
        )
        joined = schema.join(statistics, "column").withColumn(
            "is_constant_numeric", numeric & (F.col("cardinality") == 1)
        )
    else:
        # One row comes back, with a few numbers per column.
        wide = wide_statistics(df).first()
        low = [n for n in df.columns if wide[f"{n}__cardinality"] <= LOW_CARDINALITY]
        rows = [
            (n, wide[f"{n}__cardinality"], wide[f"{n}__nulls"], wide[f"{n}__constant"])
            for n in df.columns
        ]
        statistics = df.sparkSession.createDataFrame(
            rows, "column string, cardinality bigint, null_rate double, is_constant_numeric boolean"
        )
        dominant = dominant_shares(df, low)
        joined = schema.join(statistics, "column").join(dominant, "column", "left")
    return joined.select(
        "column", "dtype", "is_object_dtype", "cardinality", "null_rate", "is_constant_numeric",
        "dominant_value_share",
        F.coalesce(F.col("dominant_value_share") > NEAR_CONSTANT, F.lit(False)).alias("is_near_constant"),
        "in_config_categorical_features",
        (F.col("is_object_dtype") | (F.col("cardinality") < REVIEW_CARDINALITY)).alias("flagged_by_heuristic"),
        (F.col("is_object_dtype") & (F.col("cardinality") > HIGH_CARDINALITY)).alias("is_high_cardinality_object"),
        "in_config_drop_features",
    )


def sorted_profile(profile: DataFrame) -> DataFrame:
    """Text columns first, then by cardinality.  One row per column, so the sort is tiny."""
    return profile.orderBy(F.col("is_object_dtype").desc(), "cardinality", "column")


def review_candidates(profile: DataFrame, limit: int = REVIEW_CARDINALITY) -> DataFrame:
    """Numeric columns with so few values that they may be categories."""
    return profile.filter(~F.col("is_object_dtype") & (F.col("cardinality") <= limit))


def sample_values(df: DataFrame, names: Sequence[str], limit: int = REVIEW_VALUES) -> DataFrame:
    """The smallest ``limit`` distinct values of numeric columns, whatever their cardinality.

    Distinct values are ranked per column and slice first, so no task or buffer ever holds all
    values of a column.
    """
    if not names:
        return df.sparkSession.createDataFrame([], "column string, values array<double>")
    cells = [F.struct(F.lit(n).alias("column"), F.col(n).cast("double").alias("value")) for n in names]
    distinct = df.select(F.inline(F.array(*cells))).filter("value is not null").distinct()
    slice_ = F.pmod(F.xxhash64("value"), F.lit(64))
    near = Window.partitionBy("column", slice_).orderBy("value")
    last = Window.partitionBy("column").orderBy("value")
    kept = (
        distinct.withColumn("_rank", F.row_number().over(near)).filter(F.col("_rank") <= limit)
        .withColumn("_rank", F.row_number().over(last)).filter(F.col("_rank") <= limit)
    )
    found = kept.groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("values"))
    every = df.sparkSession.createDataFrame([(n,) for n in names], "column string")
    return every.join(found, "column", "left").select(
        "column", F.coalesce("values", F.array().cast("array<double>")).alias("values")
    )


def categorical_difference(profile: DataFrame) -> DataFrame:
    """Columns that only the heuristic or only the configuration calls categorical."""
    heuristic, configured = F.col("flagged_by_heuristic"), F.col("in_config_categorical_features")
    return profile.filter(heuristic != configured).select(
        "column", F.when(heuristic, "heuristic").otherwise("config").alias("only_in")
    )


def column_roles(profile: DataFrame) -> DataFrame:
    """Suggested role per column, from the profile's flags alone."""
    return profile.select(
        "column",
        F.when(
            F.col("in_config_drop_features") | F.col("is_constant_numeric") | F.col("is_near_constant")
            | F.col("is_high_cardinality_object"),
            "excluded",
        )
        .when(F.col("is_object_dtype") | F.col("in_config_categorical_features"), "categorical")
        .otherwise("numeric")
        .alias("role"),
    )


def inferred_categoricals(
    df: DataFrame, max_values: int = 20, min_values: int = 0, fraction: float | None = None, seed: int = 42
) -> list[str]:
    """Names of categorical columns: text, or numbers with few distinct values.

    ``fraction`` estimates from a sample; ``min_values=2`` leaves constants out.
    """
    numeric = [n for n in df.columns if n not in text_columns(df)]
    if not numeric:
        return text_columns(df)
    sampled = df if fraction is None else df.sample(fraction, seed)
    found = sampled.agg(*[approx_cardinality(n).alias(n) for n in numeric]).first()
    few = {n for n in numeric if min_values <= found[n] < max_values}
    return [n for n in df.columns if n in few or n not in numeric]


def drop_constant_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Without numeric columns that hold a single value (one aggregated row decides)."""
    numeric = [n for n in df.columns if n not in keep and n not in text_columns(df)]
    found = df.agg(*[(F.min(n).eqNullSafe(F.max(n))).alias(n) for n in numeric]).first()
    return df.drop(*[n for n in numeric if found[n]])
