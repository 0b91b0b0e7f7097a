"""Approximate nearest neighbours with an inverted multi-index.

Both halves of the unit vectors are quantised by a codebook of their own; a vector's cell is
its pair of centroids.  A query takes the pairs of centroids in the order of their summed
distance from a heap until the cells hold its share of all vectors, and the vectors of these
cells are reranked by exact cosine.  The share is calibrated on a sample against brute force.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loanweave.llm.common import among_smallest, annotate, stored, table

#: Vectors the codebooks are fitted on and the share is calibrated on, and queries used there.
SAMPLE_ROWS, SAMPLE_QUERIES = 20_000, 300
#: Neighbours to be found, as a share, in the calibration.
TARGET = 0.97
#: Vectors, and queries, that one group of the rerank holds at most (expected numbers).
BLOCK_ROWS, BLOCK_QUERIES = 32_768, 20_000


def centroids_for(rows: int) -> int:
    """Centroids of each half: about half the cube root of the rows, from 8 to 256."""
    return int(min(256, max(8, 2 ** math.floor(math.log2(max(8.0, rows ** (1 / 3) / 2))))))


def kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Lloyd's algorithm; empty clusters keep their centre."""
    centres = points[np.random.default_rng(seed).permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        nearest = distances(points, centres).argmin(1)
        for c in range(len(centres)):
            inside = nearest == c
            if inside.any():
                centres[c] = points[inside].mean(0)
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres."""
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class MultiIndex:
    """Two codebooks and the number of vectors in each pair of centroids."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second

    def cells(self, units: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        a = distances(units[:, :half], self.first).argmin(1)
        b = distances(units[:, half:], self.second).argmin(1)
        return a * len(self.second) + b

    def traverse(self, query: np.ndarray, counts: np.ndarray, wanted: float):
        """(cell, vectors before it) in the order of summed distance, until enough are met.

        Multi-sequence traversal: a heap holds the next pair of each sorted first half.
        """
        half = self.first.shape[1]
        near = distances(query[None, :half], self.first)[0]
        far = distances(query[None, half:], self.second)[0]
        rows, columns = np.argsort(near, kind="stable"), np.argsort(far, kind="stable")
        heap = [(near[rows[0]] + far[columns[0]], 0, 0)]
        met = 0
        while heap and met < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(rows[i]) * len(self.second) + int(columns[j])
            if counts[cell]:
                yield cell, met
                met += int(counts[cell])
            if j == 0 and i + 1 < len(rows):
                heapq.heappush(heap, (near[rows[i + 1]] + far[columns[0]], i + 1, 0))
            if j + 1 < len(columns):
                heapq.heappush(heap, (near[rows[i]] + far[columns[j + 1]], i, j + 1))


def calibrated_share(index: MultiIndex, sample: np.ndarray, k: int, target: float) -> float:
    """Share of the vectors a query must meet to find ``target`` of its k neighbours."""
    cells = index.cells(sample)
    size = len(index.first) * len(index.second)
    counts = np.bincount(cells, minlength=size)
    before = []
    for q in range(0, len(sample), max(1, len(sample) // SAMPLE_QUERIES)):
        similar = sample @ sample[q]
        similar[q] = -np.inf
        nearest = np.argsort(-similar, kind="stable")[: min(k, len(sample) - 1)]
        at = dict(index.traverse(sample[q], counts, math.inf))
        before += [at[int(cells[n])] + counts[cells[n]] for n in nearest]
    if not before:
        return 1.0
    return float(min(1.0, np.quantile(before, target) / len(sample)))


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` of the rows that take part.

    Left out are null ids and vectors, vectors with null or non-finite components, zero
    vectors, and vectors of another length than most have.
    """
    numbers = F.transform(vector_col, lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), numbers.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (lengths["n"] if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    target: float = TARGET, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the k nearest rows found per query.

    ``queries`` holds rows of ``vectors``; a query's own row is no candidate, and repeated
    rows are one.  Equal vectors
    are indexed once with their k + 1 smallest ids, which decides all their ties, and equal
    queries are searched once.  All valid vectors are indexed; only codebooks and the share
    of vectors to meet come from a sample of ``sample_rows``.
    """
    spark = vectors.sparkSession
    key = F.struct(F.xxhash64("vector").alias("x"), F.xxhash64(F.lit(1), "vector").alias("y")).alias("key")
    rows = stored(valid_vectors(vectors, id_col, vector_col).withColumn("key", key))
    first_ids = Window.partitionBy("key").orderBy("id")
    ranked = rows.select("key", "id", "vector").withColumn("place", F.dense_rank().over(first_ids)).where(F.col("place") <= k + 1)
    distinct = ranked.groupBy("key").agg(
        F.array_sort(F.collect_set("id")).alias("ids"), F.first("vector").alias("vector")
    )
    distinct = stored(distinct)
    total = distinct.count()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if total == 0:
        return spark.createDataFrame([], schema)
    hashed = F.xxhash64("key")
    near = distinct.where(among_smallest(distinct, hashed, sample_rows))
    taken = near.orderBy(hashed, "key").limit(sample_rows).select("vector").toArrow()
    sample = unit(_matrix(taken["vector"]))
    half = sample.shape[1] // 2
    centres = centroids_for(total)
    index = MultiIndex(kmeans(sample[:, :half], centres), kmeans(sample[:, half:], centres))
    share = calibrated_share(index, sample, k, target)
    books = spark.sparkContext.broadcast((index.first, index.second))

    def cells_start():
        held = MultiIndex(*books.value)
        return lambda column: [held.cells(unit(_matrix(column))).tolist()]

    celled = stored(annotate(distinct, ["vector"], "cell int", cells_start))
    # at most 256 x 256 cells
    counts = np.zeros(len(index.first) * len(index.second), np.int64)
    for r in celled.groupBy("cell").count().collect():
        counts[r["cell"]] = r["count"]
    known = spark.sparkContext.broadcast(counts)
    wanted = max(share * total, k + 1.0)

    asked = queries.select(F.col(id_col).cast("long").alias("id")).distinct().join(rows, "id").select("id", "key", "vector")
    asked = stored(asked.dropDuplicates(["id"]))
    sought = asked.groupBy("key").agg(F.first("vector").alias("vector"))

    def traverse_start():
        held = MultiIndex(*books.value)

        def walk(query):
            seconds: dict[int, list[int]] = {}
            for cell, _ in held.traverse(query, known.value, wanted):
                seconds.setdefault(cell // len(held.second), []).append(cell % len(held.second))
            return [{"first": a, "seconds": b} for a, b in seconds.items()]

        return lambda column: [[walk(q) for q in unit(_matrix(column))]]

    walks = annotate(sought, ["vector"], "walk array<struct<first:int,seconds:array<int>>>", traverse_start)
    # a group of the rerank holds the cells of one first centroid, so that a query gives few
    # rows; large groups fall into blocks and many queries into lanes, so none grows with the data
    width = len(index.second)
    per_first = counts.reshape(-1, width).sum(1)
    sizes = [(int(a), math.ceil(int(n) / BLOCK_ROWS)) for a, n in enumerate(per_first) if n]
    blocks = F.broadcast(spark.createDataFrame(sizes, "first int, blocks int"))
    lanes = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    entries = (
        celled.withColumn("first", F.floor(F.col("cell") / width).cast("int"))
        .join(blocks, "first")
        .withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
        .withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
        .select("first", "block", "lane", F.pmod("cell", F.lit(width)).alias("second"), "key", "ids", "vector")
    )
    visits = (
        walks.withColumn("lane", F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("int"))
        .select("key", "vector", "lane", F.explode("walk").alias("w"))
        .select("key", "vector", "lane", F.col("w.first").alias("first"), F.col("w.seconds").alias("seconds"))
        .join(blocks, "first")
        .select("first", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "lane", "key", "vector", "seconds")
    )
    by = ["first", "block", "lane"]
    scored = (
        visits.groupBy(*by)
        .cogroup(entries.groupBy(*by))
        .applyInArrow(_rerank(k + 1, width), "key struct<x:bigint,y:bigint>, ids array<bigint>, score double")
    )
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    candidates = scored.select("key", "score", F.explode("ids").alias("vec_id"))
    # removing a query's own row takes one entry at most, so k + 1 entries are enough
    short = candidates.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.select(F.col("id").alias("query_id"), "key")
        .join(short.drop("place"), "key")
        .where("query_id != vec_id")
        .withColumn("rank", F.row_number().over(mine))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _rerank(keep: int, width: int):
    schema = pa.schema([
        ("key", pa.struct([("x", pa.int64()), ("y", pa.int64())])), ("ids", pa.list_(pa.int64())), ("score", pa.float64()),
    ])

    def rerank(visits: pa.Table, entries: pa.Table) -> pa.Table:
        if visits.num_rows == 0 or entries.num_rows == 0:
            return schema.empty_table()
        asked, held = _matrix(visits["vector"]), _matrix(entries["vector"])
        second, lengths = entries["second"].to_numpy(), np.linalg.norm(held, axis=1)
        chosen = visits["seconds"].to_pylist()
        at_query, at_entry, scores = [], [], []
        for start in range(0, len(asked), 128):
            part = asked[start : start + 128]
            norms = np.linalg.norm(part, axis=1)
            similar = part @ held.T / (norms[:, None] * lengths)
            for q in range(len(part)):
                wanted = np.zeros(width, bool)
                wanted[chosen[start + q]] = True
                rows = np.flatnonzero(wanted[second])
                near = similar[q, rows]
                if len(rows) > keep:
                    # all that equal the last kept score stay: ties are decided by id later
                    least = np.partition(near, len(near) - keep)[-keep]
                    rows = rows[near >= least - 1e-12]
                at_query.append(np.full(len(rows), start + q))
                at_entry.append(rows)
                scores.append((part[q] * held[rows]).sum(1) / (norms[q] * lengths[rows]))
        query, entry = np.concatenate(at_query), np.concatenate(at_entry)
        return pa.Table.from_arrays(
            [
                visits["key"].combine_chunks().take(pa.array(query)),
                entries["ids"].combine_chunks().take(pa.array(entry)),
                pa.array(np.concatenate(scores)),
            ],
            schema=schema,
        )

    return rerank


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector of a directory."""
    vectors = table(spark, directory, "embeddings")
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"))
