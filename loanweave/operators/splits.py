"""Out-of-time, entity-level and fold splits.

A split is a column computed from the loan id, so splitting is a projection: no distinct,
no join, no shuffle, and the splits cannot overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from loanweave.columns import KEY, TARGET
from loanweave.functions import expressions as x
from loanweave.operators.ranking import hash_rank, hash_samples

TRAIN_YEARS = (1999, 2008)
TEST_YEARS = (2009, 2012)
BROADCAST_IDS = 1_000_000


def split_out_of_time(
    df: DataFrame,
    train_years: Sequence[int] = TRAIN_YEARS,
    test_years: Sequence[int] = TEST_YEARS,
    validation_fraction: float = 0.2,
    seed: int = 42,
    century_pivot: int | None = 90,
    key: str = KEY,
) -> DataFrame:
    """Rows of the train and test vintages with their ``split``.

    Vintages are told by their two digits, which is cheap where the scans below repeat the filter.
    """
    years = {yy: yy + (1900 if century_pivot is not None and yy >= century_pivot else 2000) for yy in range(-9, 100)}
    train, test = ([yy for yy, year in years.items() if a <= year <= b] for a, b in (train_years, test_years))
    digits = x.vintage_digits(key)
    held_out = x.stable_fraction(key, seed) < validation_fraction
    label = F.when(digits.isin(train), F.when(held_out, "validation").otherwise("train")).otherwise("test")
    return df.filter(digits.isin([*train, *test])).withColumn("split", label)


def split_statistics(df: DataFrame, key: str = KEY) -> DataFrame:
    """Rows, loans and default rate of every split from one job."""
    return df.groupBy("split").agg(
        F.count("*").alias("observations"),
        F.count_distinct(key).alias("loans"),
        F.avg((F.col(TARGET) == 1).cast("int")).alias("default_rate"),
    )


def restrict_to(panel: DataFrame, ids: DataFrame, key: str = KEY) -> DataFrame:
    """Panel rows whose loan is in ``ids``, with no columns of ``ids``."""
    return panel.join(ids.select(key), key, "left_semi")


def restrict_to_sample(
    panel: DataFrame, sample: DataFrame, bound: int, key: str = KEY,
    broadcast_limit: int = BROADCAST_IDS,
) -> DataFrame:
    """``restrict_to`` for a sample of at most ``bound`` loans.

    A sample above its bound is an error.  Within ``broadcast_limit`` ids (a few tens of MB)
    the panel is filtered in place, beyond it the join is left to AQE.
    """
    ids = sample.select(key)
    if bound > broadcast_limit:
        return panel.join(ids, key, "left_semi")
    # counted up to one above the bound, so the broadcast never rests on the caller's word
    found = ids.limit(bound + 1).count()
    if found > bound:
        raise ValueError(f"the sample has more than {bound} ids")
    return panel.join(F.broadcast(ids), key, "left_semi")


def add_fold(df: DataFrame, folds: int = 5, seed: int = 42, key: str = KEY) -> DataFrame:
    """Entity-level fold number: all rows of a loan share a fold."""
    return df.withColumn("fold", F.floor(x.stable_fraction(key, seed) * folds).cast("int"))


def fold_frames(df: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows of one fold, without the fold column."""
    return (
        df.filter(F.col("fold") != fold).drop("fold"),
        df.filter(F.col("fold") == fold).drop("fold"),
    )


def add_stratified_fold(
    df: DataFrame, id_column: str, label: str, folds: int = 3, seed: int = 42
) -> DataFrame:
    """Row-level folds whose class shares differ by at most one row per class."""
    ranked = hash_rank(df, id_column, [label], seed, "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank"), F.lit(folds)).cast("int")).drop("_rank")


def hash_sample(df: DataFrame, fraction: float, id_columns: Sequence[str], seed: int = 42) -> DataFrame:
    """Rows whose id hashes below ``fraction``: repeatable, and X and y stay aligned."""
    identity = F.concat_ws("|", *[F.col(c).cast("string") for c in id_columns])
    return df.filter(x.stable_fraction(identity, seed) < fraction)


def sample_splits(
    splits: DataFrame,
    id_columns: Sequence[str],
    train_rows: int = 500_000,
    validation_share: float = 0.2,
    test_share: float = 0.4,
    seed: int = 42,
) -> DataFrame:
    """About ``train_rows`` train rows, and fixed shares of that for the other splits.

    The fraction per split comes from one grouped count (three rows).
    """
    goals = {
        "train": train_rows,
        "validation": train_rows * validation_share,
        "test": train_rows * test_share,
    }
    goal = F.try_element_at(
        F.create_map(*[F.lit(v) for k, g in goals.items() for v in (k, float(g))]), F.col("split")
    )
    sizes = (
        splits.filter(F.col("split").isin(*goals))
        .groupBy("split")
        .agg(F.least(F.lit(1.0), goal / F.count("*")).alias("_fraction"))
    )
    identity = F.concat_ws("|", *[F.col(c).cast("string") for c in id_columns])
    return (
        splits.join(F.broadcast(sizes), "split")  # one row per split, three at most
        .filter(x.stable_fraction(identity, seed) < F.col("_fraction"))
        .select(*splits.columns)
    )


def validation_loans(
    loans: DataFrame,
    defaulted: int = 1000,
    non_defaulted: int = 1000,
    anyone: int = 500,
    outcome: str = "ever_defaulted",
    key: str = KEY,
    seed: int = 42,
) -> DataFrame:
    """Fixed-size samples by outcome plus a random one; a loan keeps its first tag.

    ``loans`` has one row per loan.  It is read twice, so write a costly one to a table first.
    """
    samples = [
        (F.col(outcome) == 1, defaulted, seed),
        (F.col(outcome) == 0, non_defaulted, seed),
        (F.lit(True), anyone, seed + 1),
    ]
    tags = F.array(F.lit("defaulted"), F.lit("non_defaulted"), F.lit("random"))
    return (
        hash_samples(loans, samples, key, "_sample")
        .withColumn("sample_type", F.element_at(tags, F.col("_sample") + 1))
        .drop("_sample")
    )
