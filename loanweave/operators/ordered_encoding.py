"""Target rates of categories that do not see their own row.

Rows are put into a random order.  A row's rate for its category comes from the rows before it
only, so a model that is trained on these rates does not learn its own labels.  The running
totals are built in buckets of the order: totals per category and bucket give each bucket its
start, and only the rows of one bucket are ranked together, however many rows a category has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from loanweave.operators.preparation import LABEL
from loanweave.session import checkpointed

#: Rows of one bucket of the order, about.
BUCKET_ROWS = 200_000


def ordered_rates(
    df: DataFrame, categories: Sequence[str], label: str = LABEL, prior: float | None = None, strength: float = 1.0,
    order: str | None = None, seed: int = 42, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Append ``<category>__rate``: (positives before + strength x prior) / (rows before + strength).

    ``order`` names a column of distinct numbers in [0, 1) to order by; without it every row draws
    one, which is written once so that no retry changes it.  ``prior`` is the share of positives
    by default.  NULL is a category of its own.  Tied orders count each other as later rows.
    """
    if order is None:
        rows = checkpointed(df.withColumn("_order", F.rand(seed)).withColumn("_row", F.monotonically_increasing_id()))
    else:
        rows = checkpointed(df.withColumn("_order", F.col(order)).withColumn("_row", F.monotonically_increasing_id()))
    total, positives = rows.agg(F.count("*"), F.sum(F.col(label).cast("double"))).first()
    share = prior if prior is not None else (positives or 0.0) / max(1, total)
    buckets = max(1, -(-total // bucket_rows))
    cells = F.array(*[F.struct(F.lit(k).alias("category"), F.col(n).cast("string").alias("value")) for k, n in enumerate(categories)])
    tall = rows.select(
        "_row", "_order", F.col(label).cast("double").alias("_y"), F.floor(F.col("_order") * buckets).cast("int").alias("_bucket"), F.inline(cells)
    )
    group = ["category", "value", "_bucket"]
    earlier = Window.partitionBy("category", "value").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = tall.groupBy(*group).agg(F.count("*").alias("_n"), F.sum("_y").alias("_p")).select(
        *[F.col(g).alias(f"s_{g}") for g in group],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_p").over(earlier), F.lit(0.0)).alias("_p0"),
    )
    before = Window.partitionBy(*group).orderBy("_order", "_row").rowsBetween(Window.unboundedPreceding, -1)
    counted = tall.withColumns({"_n": F.count("*").over(before), "_p": F.coalesce(F.sum("_y").over(before), F.lit(0.0))})
    same = [F.col(g).eqNullSafe(F.col(f"s_{g}")) for g in group]
    joined = counted.join(starts, same[0] & same[1] & same[2])
    rate = (F.col("_p") + F.col("_p0") + strength * share) / (F.col("_n") + F.col("_n0") + strength)
    wide = joined.select("_row", "category", rate.alias("_rate")).groupBy("_row").agg(
        *[F.max(F.when(F.col("category") == k, F.col("_rate"))).alias(f"{n}__rate") for k, n in enumerate(categories)]
    )
    return rows.join(wide, "_row").drop("_row", "_order")
