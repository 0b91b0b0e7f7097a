"""Exact search for the largest inner products, by buckets of like length.

All distinct vectors are sorted by length over the cluster and cut into buckets of like length.
A block of queries goes through the buckets of every task from the longest on.  The k-th best
product that a query has so far, divided by its own length and the bucket's, is the least
cosine that still counts there.  Above one the bucket and all shorter ones are done; a high
one confines the vector's largest coordinates of the query to a short interval
(coordinate pruning), and otherwise the vectors that are long enough are taken (length
pruning).  What is left is verified by its whole product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import _parse_datatype_string

from loanweave.llm.common import annotate, bounded_batches, emit, stored, table

#: Vectors of a bucket at most; its shortest has at least this share of its longest's length.
BUCKET_ROWS, LIKE = 1_024, 0.9
#: Queries of one pass over the vectors, and the longest vectors that give first thresholds.
BLOCK_QUERIES, SEED_ROWS = 8_192, 4_096
#: Least local cosine for coordinate pruning, and the coordinates it looks at.
COORDINATE_FROM, COORDINATES = 0.8, 4
#: Products in float are exact below this; beyond it Python's integers are used.
_EXACT = float(1 << 53)
_SLACK = 1e-9


def scaled(vector: str, factor: int = 256) -> Column:
    """The vector's components as floor(factor * x); beyond 64 bits they stay at the end of the range."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("bigint"))


def valid(vector: str) -> Column:
    """Neither null nor with null or non-finite components."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows padded with zeros up to ``width``; in Python integers where floats are not exact."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def size_of(rows: np.ndarray) -> float:
    """Largest magnitude of any component (of the least 64-bit number, too)."""
    return float(np.abs(rows.astype(np.float64)).max(initial=0.0))


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products; those beyond 64 bits stay at the end of the range."""
    if size_of(queries) * size_of(rows) * max(1, queries.shape[1]) < _EXACT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    exact = queries.astype(object) @ rows.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Best:
    """The best (score, id) pairs of every query so far; an entry's ids are ascending."""

    def __init__(self, least: np.ndarray, keep: int):
        self.least, self.keep = least.copy(), keep
        self.found: dict[int, list[tuple[int, int]]] = {}

    def add(self, query: int, scores: np.ndarray, rows: np.ndarray, ids: list[list[int]]) -> None:
        good = scores >= self.least[query]
        scores, rows = scores[good], rows[good]
        if len(scores) > self.keep:
            first = np.array([ids[r][0] for r in rows])
            order = np.lexsort((first, -scores))[: self.keep]
            scores, rows = scores[order], rows[order]
        pairs = self.found.get(query, []) + [(-int(s), i) for s, r in zip(scores, rows) for i in ids[r]]
        pairs.sort()
        self.found[query] = pairs[: self.keep]
        if len(pairs) >= self.keep:
            self.least[query] = max(self.least[query], -pairs[self.keep - 1][0])


class Queries:
    """A block of queries with their lengths, directions and widest coordinates."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
        self.units = rows / np.maximum(self.lengths, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(self.units), axis=1, kind="stable")[:, :COORDINATES]
        self.angles = np.arccos(np.clip(np.take_along_axis(self.units, self.focus, 1), -1, 1))

    def bucket(self, rows: np.ndarray, ids: list[list[int]], best: Best, counts: dict[str, int]) -> None:
        """Look for better products in one bucket, whose rows are in descending length."""
        lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
        longest = lengths[0]
        least = best.least.astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            # where nothing is known yet, or a length is zero, every row may count
            cosine = np.where((self.lengths > 0) & (longest > 0), least / (self.lengths * longest), np.where(least > 0, 2.0, -1.0))
        cosine = cosine * np.where(cosine > 0, 1 - _SLACK, 1 + _SLACK) - _SLACK
        open_ = cosine <= 1
        by_coordinate = np.flatnonzero(open_ & (cosine >= COORDINATE_FROM))
        by_length = np.flatnonzero(open_ & (cosine < COORDINATE_FROM))
        counts["pruned"] += len(cosine) - len(by_coordinate) - len(by_length)
        counts["coordinate"] += len(by_coordinate)
        counts["length"] += len(by_length)
        if len(by_coordinate):
            units = np.ascontiguousarray((rows / np.maximum(lengths, 1e-300)[:, None]).T)
            for q in by_coordinate:
                reach = math.acos(min(1.0, cosine[q])) + _SLACK
                near = np.ones(len(rows), bool)
                for f, angle in zip(self.focus[q], self.angles[q]):
                    near &= (units[f] >= math.cos(min(math.pi, angle + reach)) - _SLACK) & (units[f] <= math.cos(max(0.0, angle - reach)) + _SLACK)
                found = np.flatnonzero(near)
                if len(found):
                    counts["verified"] += len(found)
                    best.add(q, products(self.rows[q : q + 1], rows[found])[0], found, ids)
        for at in range(0, len(by_length), 256):
            some = by_length[at : at + 256]
            # rows are long enough for a query up to a place in the descending lengths
            with np.errstate(divide="ignore", invalid="ignore"):
                enough = np.where((least[some] > 0) & (self.lengths[some] > 0), least[some] / self.lengths[some] * (1 - _SLACK), -1.0)
            upto = int(np.searchsorted(-lengths, -enough.min(), side="right"))
            scores = products(self.rows[some], rows[:upto])
            counts["verified"] += scores.size
            better = scores >= best.least[some][:, None]
            for row in np.flatnonzero(better.any(1)):
                found = np.flatnonzero(better[row])
                best.add(int(some[row]), scores[row, found], found, ids)


def buckets(rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the buckets of rows in descending length."""
    lengths = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
    start = 0
    while start < len(rows):
        stop = min(start + BUCKET_ROWS, int(np.searchsorted(-lengths, -LIKE * lengths[start], side="right")))
        yield start, max(stop, start + 1)
        start = max(stop, start + 1)


def _first_thresholds(asked: DataFrame, seeds: np.ndarray, keep: int) -> DataFrame:
    """Append ``least``: the keep-th best product with the seeds (the least number with too few)."""
    shared = asked.sparkSession.sparkContext.broadcast(seeds)

    def start():
        held = shared.value

        def work(column):
            rows = matrix(column, held.shape[1])
            if len(held) < keep:
                return [[-(1 << 63)] * len(rows)]
            scores = products(rows, held)
            return [np.partition(scores, len(held) - keep, axis=1)[:, len(held) - keep].tolist()]

        return work

    return annotate(asked, ["vector"], "least bigint", start)


def _search(entries: DataFrame, numbers: list[int], rows: np.ndarray, least: np.ndarray, keep: int) -> DataFrame:
    """``number``, ``vec_id`` and ``score``: the ``keep`` best of every task for every query."""
    schema = _parse_datatype_string("number bigint, vec_id bigint, score bigint")
    shared = entries.sparkSession.sparkContext.broadcast((numbers, rows, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asked, known = shared.value
        queries, best = Queries(asked), Best(known, keep)
        counts = dict.fromkeys(("pruned", "coordinate", "length", "verified"), 0)
        for batch in batches:
            if batch.num_rows:
                held, ids = matrix(batch.column(0), asked.shape[1]), batch.column(1).to_pylist()
                for begin, end in buckets(held):
                    queries.bucket(held[begin:end], ids[begin:end], best, counts)
        found = [(names[q], i, -s) for q, pairs in best.found.items() for s, i in pairs]
        yield emit(schema, [list(c) for c in zip(*found)] if found else [[], [], []])

    return entries.select("vector", "ids").mapInArrow(run, schema)


def largest_products(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", factor: int = 256,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the k largest integer products per query, exactly.

    Components are taken as floor(factor * x).  Rows take part if they have an id and a vector
    without null or non-finite components; zero and empty vectors do (a shorter vector counts as
    padded with zeros).  A query's own id is no candidate; rows that repeat an id are one, with
    the first vector in array order.  Ties go to the smaller id.  Without rows, or without
    another id, there is nothing.  Components and products beyond 64 bits stay at the end of the
    range.  Extra columns, whatever their names, play no part.

    Equal vectors are one entry with their k + 1 smallest ids, and equal queries are searched
    once, so that copies cost nothing.  Queries go in blocks of ``BLOCK_QUERIES``, with one pass
    over the entries each; the entries are neither copied nor moved for it.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"

    def read(df: DataFrame) -> DataFrame:
        taken = df.where(valid(vector_col)).select(F.col(id_col).cast("bigint").alias("id"), scaled(vector_col, factor).alias("vector"))
        return taken.where("id is not null").groupBy("id").agg(F.min("vector").alias("vector"))

    by_id = Window.partitionBy("vector").orderBy("id")
    grouped = read(vectors).withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
    entries = grouped.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    length = F.aggregate("vector", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    order = [F.desc("length"), F.asc("spread")]
    entries = stored(
        entries.select("vector", "ids", length.alias("length"), F.xxhash64("vector").alias("spread"))
        .repartitionByRange(*order).sortWithinPartitions(*order).select("vector", "ids")
    )
    asked = read(queries)
    width = max(entries.agg(F.max(F.size("vector"))).first()[0] or 0, asked.agg(F.max(F.size("vector"))).first()[0] or 0, 1)
    # the longest entries: partitions are in descending length, so take() reads the first ones
    seeds = [r.vector for r in entries.select("vector").take(SEED_ROWS)]
    if not seeds:
        return spark.createDataFrame([], schema)
    sought = asked.groupBy("vector").agg(F.min("id").alias("number"))
    sought = stored(_first_thresholds(sought, matrix(pa.array(seeds, pa.list_(pa.int64())), width), k + 1))
    blocks = math.ceil(sought.count() / BLOCK_QUERIES)
    found = None
    for block in range(blocks):
        # about BLOCK_QUERIES rows
        part = sought.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).toArrow()
        rows = matrix(part["vector"].combine_chunks(), width)
        one = _search(entries, part["number"].to_pylist(), rows, part["least"].to_numpy(), k + 1)
        one = stored(one) if blocks > 1 else one
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], schema)
    best = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    # a query's own id takes one place at most
    short = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    named = asked.join(sought.select("vector", "number"), "vector").select(F.col("id").alias("query_id"), "number")
    return (
        named.join(short, "number")
        .where("query_id != vec_id")
        .withColumn("rank", F.row_number().over(mine))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """The five largest products of every fiftieth vector of a directory."""
    vectors = table(spark, directory, "embeddings")
    return largest_products(vectors, vectors.where("vec_id % 50 = 0"))
