"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters rows by a seeded hash into buckets that fit in memory.  Pass two puts each
bucket in a canonical order and shuffles it with Spark's seeded ``shuffle`` (a Fisher-Yates
shuffle of the array).  The buckets one after the other are the shuffled table; row i of it
goes to shard i mod n, so shard sizes differ by one row at most.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanweave.llm.common import table, unused

#: Rows and bytes of one bucket, the array that one task holds and shuffles.
BUCKET_ROWS, BUCKET_BYTES = 20_000, 32 << 20
#: Buckets of one task of pass two, and of one group of the two-step running count.
BUCKETS_PER_TASK, GROUP = 2, 1_024


def shuffle_into_shards(
    df: DataFrame,
    shards: int,
    seed: int = 17,
    key_cols: tuple[str, ...] = ("doc_id",),
    size_col: str | None = None,
    bucket_rows: int = BUCKET_ROWS,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Append ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    All columns are carried along; select those that the shards need.  A column of the input
    that is called ``shard`` or ``slot`` comes back as ``_shard`` or ``_slot`` (with further
    underscores if that name is taken too); any other name is safe.  Rows are scattered
    by the hash of ``key_cols``, which should tell rows apart.  Keys that repeat more often
    than a quarter of a bucket (null keys and repeated rows too) are scattered row by row, so
    a hot key never fills a bucket.  ``size_col`` gives a row's bytes, for the bucket bound;
    null counts as 0.  The result depends on the rows, the seed and the bucket bounds, not on
    how Spark joins or partitions; with such hot keys also on the input's partitions.  Rows
    that are equal in all columns are interchangeable.  An empty table gives no rows.
    """
    kept = {c: unused(df, f"_{c}") if c.lower() in ("shard", "slot") else c for c in df.columns}
    sized = F.sum(F.coalesce(F.col(size_col), F.lit(0))) if size_col else F.lit(0)
    total = df.agg(F.count("*").alias("rows"), sized.alias("size")).first()
    buckets = max(1, math.ceil(total["rows"] / bucket_rows), math.ceil((total["size"] or 0) / bucket_bytes))
    tasks = math.ceil(buckets / BUCKETS_PER_TASK)

    fields = [F.col(f"`{c}`").alias(name) for c, name in kept.items()]
    rows = df.select(
        F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in key_cols]).alias("_key"), F.struct(*fields).alias("_record")
    )
    repeated = (
        rows.groupBy("_key").count().where(F.col("count") > bucket_rows // 4).select("_key", F.lit(True).alias("_hot"))
    )
    # hot keys: at most four per bucket, so this side has fewer rows than there are buckets x 4,
    # and its broadcast spares the rows a shuffle of their own
    scattered = (
        rows.join(F.broadcast(repeated), "_key", "left")
        .withColumn("_spread", F.when(F.col("_hot"), F.monotonically_increasing_id()).otherwise(F.lit(0)))
        .withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed + 1), "_key", "_spread"), F.lit(buckets)))
        .select("_bucket", F.struct("_key", "_record").alias("_row"))
        .repartition(tasks, "_bucket")
    )
    gathered = scattered.groupBy("_bucket").agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    # shuffle() draws by partition number and order, and both are fixed only here: repartition
    # gives a bucket its partition, the sort its turn.  A join before it would undo that.
    shuffled = gathered.sortWithinPartitions("_bucket").select("_bucket", F.shuffle("_rows", seed).alias("_rows"))
    sizes = gathered.select("_bucket", F.size("_rows").alias("n"))
    return _dealt(shuffled, sizes, shards, list(kept.values()))


def _dealt(shuffled: DataFrame, sizes: DataFrame, shards: int, carried: list[str]) -> DataFrame:
    inner = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    grouped = sizes.withColumn("_group", F.floor(F.col("_bucket") / GROUP))
    bases = grouped.groupBy("_group").agg(F.sum("n").alias("total")).select(
        "_group", F.coalesce(F.sum("total").over(outer), F.lit(0)).alias("base")
    )
    offsets = (
        grouped.withColumn("within", F.coalesce(F.sum("n").over(inner), F.lit(0)))
        .join(bases, "_group")
        .select("_bucket", (F.col("base") + F.col("within")).alias("offset"))
    )
    dealt = shuffled.join(offsets, "_bucket").select("offset", F.posexplode("_rows").alias("place", "_row"))
    position = F.col("offset") + F.col("place")
    return dealt.select(
        *[F.col(f"_row._record.`{c}`") for c in carried],
        F.pmod(position, F.lit(shards)).cast("int").alias("shard"),
        F.floor(position / F.lit(shards)).cast("long").alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, rows in the order of their slots."""
    count = sharded.select("shard").distinct().count() or 1
    (
        sharded.repartitionByRange(count * 4, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.mode("errorifexists").partitionBy("shard").parquet(path)
    )


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Shard and slot of every document of a directory; the texts go through the shuffle whole."""
    docs = table(spark, directory, "documents")
    docs = docs.withColumn(extra := unused(docs, "_bytes"), F.length(F.coalesce(F.col("text"), F.lit("")).cast("binary")) + 8)
    sharded = shuffle_into_shards(docs, 24, key_cols=("doc_id", "text"), size_col=extra)
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return sharded.select(
        "doc_id", (F.length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
