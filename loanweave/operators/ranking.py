"""Running totals and ranks over a global order, without a single-task window.

A window without partitions would move every row to one task.  Here the order is cut into
buckets that follow it; totals per bucket give each bucket its starting offset, and an
ordinary window finishes the work inside each bucket.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from loanweave.functions.expressions import stable_hash

BUCKET_ROWS = 1_000_000
EDGE_SAMPLE_ROWS = 100_000
EDGE_SAMPLE_PER_BUCKET = 200
SLICES = 64
HASH_BITS = 7


def score_histogram(
    df: DataFrame, score: str = "y_proba", label: str = "y_true", by: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per distinct score: positives, negatives, rows, and ``extra`` aggregates.

    Ties collapse here.
    """
    positive = F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint")
    more = [c.alias(n) for n, c in (extra or {}).items()]
    return (
        df.groupBy(*by, score)
        .agg(positive.alias("pos"), F.count("*").alias("n"), *more)
        .withColumn("neg", F.col("n") - F.col("pos"))
    )


def bucket_edges(rows: DataFrame, order: str, bucket_rows: int = BUCKET_ROWS) -> list[float]:
    """Inner edges that cut the order into buckets of about ``bucket_rows`` rows.

    A table that fits one bucket needs none and costs one count.  Otherwise the edges are
    quantiles of a sample: they only balance the work, every row is still placed exactly.
    A value that is hot among ``rows`` shares its bucket with little else, and in a
    histogram it is one row wherever it falls.
    """
    total = rows.count()
    buckets = math.ceil(total / bucket_rows)
    if buckets <= 1:
        return []
    wanted = max(EDGE_SAMPLE_ROWS, EDGE_SAMPLE_PER_BUCKET * buckets)
    column = rows.select(order)
    sampled = column if total <= wanted else column.sample(wanted / total, 42)
    probabilities = [i / buckets for i in range(1, buckets)]
    return sorted(set(sampled.approxQuantile(order, probabilities, 1 / (4 * buckets))))


def add_bucket(df: DataFrame, order: str, edges: Sequence[float]) -> DataFrame:
    """Add ``_bucket``: the value's position among the edges; equal values share one."""
    if not edges:
        return df.withColumn("_bucket", F.lit(0.0))
    bucketizer = Bucketizer(
        splits=[-math.inf, *edges, math.inf], inputCol="_order", outputCol="_bucket",
        handleInvalid="keep",
    )
    return bucketizer.transform(df.withColumn("_order", F.col(order).cast("double"))).drop("_order")


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = True,
    bucket_rows: int = BUCKET_ROWS,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running total) and ``all_<c>`` (group total) per column.

    ``df`` must have one row per ``by`` and ``order`` value, as a histogram does.  Without
    ``edges`` they are taken from ``df`` itself; edges of the rows behind a histogram do as
    well, and spare an extra aggregation.
    """
    if edges is None:
        edges = bucket_edges(df, order, bucket_rows)
    return _with_offsets(
        add_bucket(df, order, edges),
        [F.col(order).desc() if descending else F.col(order).asc()],
        F.col("_bucket").desc() if descending else F.col("_bucket").asc(),
        sums,
        by,
    )


def _with_offsets(
    bucketed: DataFrame,
    inside: Sequence[Column],
    across: Column,
    sums: Sequence[str],
    by: Sequence[str],
) -> DataFrame:
    # Totals per bucket: a small table (groups x buckets), so ordering it is cheap.
    totals = bucketed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(across).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(group).alias(f"all_{c}") for c in sums],
    )
    within = Window.partitionBy(*by, "_bucket").orderBy(*inside)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = bucketed.withColumns({f"_cum_{c}": F.sum(c).over(upto) for c in sums})
    join_on = [*by, "_bucket"]
    return local.join(offsets, join_on).select(
        *[c for c in bucketed.columns if c != "_bucket"],
        *[(F.col(f"_cum_{c}") + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in sums],
        *[f"all_{c}" for c in sums],
    )


def hash_rank(
    df: DataFrame,
    id_column: str,
    by: Sequence[str] = (),
    seed: int = 42,
    name: str = "hash_rank",
    buckets: int | None = None,
) -> DataFrame:
    """1-based rank in md5 order of the id within ``by``: a repeatable random order.

    Hash values are uniform, so equal-width hash buckets are balanced without sampling and
    a group may be as large as the whole table.  Their number follows the rows (one count)
    unless given; the ranks do not depend on it.
    """
    if buckets is None:
        buckets = max(SLICES, math.ceil(df.count() / BUCKET_ROWS))
    hashed = df.withColumn("_hash", stable_hash(id_column, seed)).withColumns({
        "_bucket": F.floor(F.col("_hash") * F.lit(buckets) / F.lit(float(2**32))).cast("int"),
        name: F.lit(1).cast("bigint"),
    })
    ranked = _with_offsets(
        hashed, [F.col("_hash"), F.col(id_column)], F.col("_bucket"), [name], by
    )
    return ranked.drop("_hash", name, f"all_{name}").withColumnRenamed(f"cum_{name}", name)


def smallest_hash_rows(
    df: DataFrame,
    n: int,
    id_column: str,
    by: str | None = None,
    seed: int = 42,
) -> DataFrame:
    """The first ``n`` rows, per group if ``by`` is given, in hash order: a repeatable sample.

    Without groups this is one sort with a limit: every task keeps its own best ``n``.  With
    groups there are two stages, so that no task sees a whole group: the best ``n`` of each
    slice, then the best ``n`` of those.  The slices follow the number of rows.
    """
    order = [stable_hash(id_column, seed), F.col(id_column)]
    if by is None:
        return df.orderBy(*order).limit(n)
    slices = max(SLICES, math.ceil(df.count() / BUCKET_ROWS))
    slice_ = F.pmod(F.xxhash64(F.col(id_column)), F.lit(slices))
    first = Window.partitionBy(F.col(by), slice_).orderBy(*order)
    final = Window.partitionBy(F.col(by)).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(final))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def rounded_up(hashed: Column, bits: int = HASH_BITS) -> Column:
    """A non-negative hash with every bit after its first ``bits`` significant ones set.

    At most about 1,700 values for 32-bit hashes, each within two per cent of its hashes, so
    a histogram of them is small at any size and fine where hashes are small.
    """
    spare = F.greatest(F.length(F.bin(hashed)) - bits, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), spare)
    return hashed.bitwiseOR(step - 1)


def hash_samples(
    df: DataFrame, samples: Sequence[tuple[Column, int, int]], id_column: str, name: str = "sample"
) -> DataFrame:
    """Rows that are among the first ``n`` in hash order of any sample, with that sample's number.

    ``samples`` holds (condition, n, seed) in order of priority; a row of several samples
    keeps the first.  Ids must be unique.  The input is read twice whatever the number of
    samples: a histogram of rounded hashes tells up to which hash each sample reaches (one
    row per sample comes back), then one filter takes the candidates, and only those, about
    as many as are wanted, are shuffled and ranked.
    """
    hashes = {seed: stable_hash(id_column, seed) for _, _, seed in samples}
    places = [
        F.when(condition, F.struct(F.lit(k).alias("k"), rounded_up(hashes[seed]).alias("reach")))
        for k, (condition, _, seed) in enumerate(samples)
    ]
    sizes = (
        df.select(F.inline(F.array_compact(F.array(*places))))
        .groupBy("k", "reach").agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(Window.partitionBy("k").orderBy("reach")))
    )
    wanted = F.element_at(F.array(*[F.lit(n) for _, n, _ in samples]), F.col("k") + 1)
    # the first bin that fills the sample, or the last one there is
    reached = sizes.groupBy("k").agg(
        F.coalesce(F.min(F.when(F.col("upto") >= wanted, F.col("reach"))), F.max("reach")).alias("reach")
    )
    reach = {r["k"]: r["reach"] for r in reached.collect()}
    taken = [
        F.when(
            condition & (hashes[seed] <= reach.get(k, -1)),
            F.struct(F.lit(k).alias("k"), F.lit(n).alias("n"), hashes[seed].alias("hash")),
        )
        for k, (condition, n, seed) in enumerate(samples)
    ]
    candidates = (
        df.withColumn("_in", F.array_compact(F.array(*taken)))
        .filter(F.size("_in") > 0)
        .withColumn("_in", F.explode("_in"))
    )
    order = Window.partitionBy("_in.k").orderBy("_in.hash", id_column)
    first = Window.partitionBy(id_column).orderBy("_in.k")
    return (
        candidates.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= F.col("_in.n"))
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .select(*df.columns, F.col("_in.k").alias(name))
    )


def exact_percentiles(
    histogram: DataFrame,
    value: str,
    probabilities: Mapping[str, float],
    count: str = "n",
    by: Sequence[str] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Linearly interpolated percentiles from a histogram, exact at any size."""
    ranked = running_totals(histogram, value, [count], by, False, bucket_rows)
    seen, total = F.col(f"cum_{count}"), F.col(f"all_{count}")

    def at(rank: Column) -> Column:
        """The value at a 0-based rank."""
        return F.min(F.when(seen > rank, F.col(value).cast("double")))

    def position(p: float) -> Column:
        return F.lit(p) * (total - 1)

    ends = ranked.groupBy(*by).agg(
        *[at(F.floor(position(p))).alias(f"_low_{k}") for k, p in probabilities.items()],
        *[at(F.ceil(position(p))).alias(f"_high_{k}") for k, p in probabilities.items()],
        F.max(total).alias("_total"),
    )
    def between(k: str, p: float) -> Column:
        where = F.lit(p) * (F.col("_total") - 1)
        low, high = F.col(f"_low_{k}"), F.col(f"_high_{k}")
        return low + (high - low) * (where - F.floor(where))

    return ends.select(*by, *[between(k, p).alias(k) for k, p in probabilities.items()])
