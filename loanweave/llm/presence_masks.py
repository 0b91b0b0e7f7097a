"""Ranked lexical search by presence masks.

The documents are read once for a block of items: each keeps the counts of the words that items
ask for.  Batches of these postings become bitmaps, one per term, and for every item the
bitmaps of its terms are packed into one mask per document.  Documents of equal masks are one
group, whose score is at most the sum of its terms' largest scores in the corpus; groups are
scored in the order of these bounds, until no further one can reach the item's best documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import _parse_datatype_string

from loanweave.llm.common import annotate, as_bytes, bounded_batches, emit, stored, table

#: UTF-8 bytes of item text that are searched in one scan.  Larger item tables are cut into
#: blocks with a scan each, so the vocabulary on an executor stays bounded.
BLOCK_BYTES = 2 << 20
#: Documents and cells (terms x documents) of one bitmap batch.
BATCH_DOCS, BATCH_CELLS = 2_048, 16 << 20
#: Documents scored before the first look at the bounds.
FIRST_SCORED = 64

_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of UTF-8 text in order: letters and digits of ASCII, with A-Z in lower case, and all other signs."""
    return text.translate(_TERM).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def vocabulary(items: list[tuple[str, bytes]]) -> dict[bytes, int]:
    """Numbers of the distinct terms of the items."""
    return {t: k for k, t in enumerate(sorted({t for _, text in items for t in terms(text)}))}


def postings(docs: DataFrame, numbers: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats), and ``numbers`` and ``counts`` of the known terms."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def start():
        known = shared.value

        def work(column):
            n, found, counts = [], [], []
            for text in as_bytes(column):
                words = terms(text)
                n.append(len(words))
                held = Counter(words)
                pairs = sorted((known[t], held[t]) for t in held.keys() & known.keys())
                found.append([p[0] for p in pairs])
                counts.append([p[1] for p in pairs])
            return [n, found, counts]

        return work

    read = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return annotate(read, ["text"], "n bigint, numbers array<int>, counts array<bigint>", start).drop("text")


class Search:
    """The items of a block over one batch of documents after another, with their best ``k``."""

    def __init__(self, items: list[tuple[int, list[tuple[int, int]]]], best_parts: dict[int, int], k: int, size: int):
        self.k, self.size = k, size
        self.items = []
        for number, weighted in items:
            rows = np.array([t for t, _ in weighted], np.int64)
            factor = np.array([w for _, w in weighted], np.int64)
            self.items.append((number, rows, factor, factor * np.array([best_parts.get(int(t), 0) for t in rows], np.int64)))
        self.best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0

    def batch(self, ids: np.ndarray, parts: np.ndarray, present: np.ndarray) -> None:
        """``parts`` and ``present``: terms x documents."""
        for number, rows, factor, bounds in self.items:
            own = present[rows]
            held = np.flatnonzero(own.any(0))
            if not len(held):
                continue
            packed = np.packbits(own[:, held], axis=0)
            masks, group = np.unique(np.ascontiguousarray(packed.T).view(f"V{len(packed)}").ravel(), return_inverse=True)
            # the bound of a mask is the sum over its terms
            bits = np.unpackbits(masks.view(np.uint8).reshape(len(masks), -1), axis=1)[:, : len(rows)]
            most = bits.astype(np.int64) @ bounds
            order = np.argsort(-most, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            by_mask = np.argsort(place[group], kind="stable")
            ends = np.cumsum(np.bincount(place[group], minlength=len(masks)))
            most, done, step = most[order], 0, FIRST_SCORED
            while done < len(masks):
                least = self.least(number)
                if most[done] < least or most[done] <= 0:
                    break
                # whole masks, about as many documents as before, none that the bound excludes
                begin = ends[done - 1] if done else 0
                stop = min(int(np.searchsorted(ends, begin + step)) + 1, int(np.searchsorted(-most, -least, side="right")), len(masks))
                stop = max(stop, done + 1)
                docs = held[by_mask[begin : ends[stop - 1]]]
                self.scored += len(docs)
                self.keep(number, factor @ parts[np.ix_(rows, docs)], ids[docs])
                done, step = stop, 2 * step

    def least(self, number: int) -> int:
        """Score that a document must reach (ties are decided by id)."""
        scores = self.best.get(number, ((),))[0]
        return int(scores[-1]) if len(scores) == self.k else 1

    def keep(self, number: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least(number)
        scores, ids = scores[good], ids[good]
        if number in self.best:
            scores = np.concatenate([self.best[number][0], scores])
            ids = np.concatenate([self.best[number][1], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.best[number] = (scores[order], ids[order])


def _search(posted: DataFrame, items, best_parts: dict[int, int], size: int, documents: int, words: int, k: int) -> DataFrame:
    """``number`` of the item, ``doc_id`` and ``score``: the best of every task."""
    schema = _parse_datatype_string("number int, doc_id bigint, score bigint")
    shared = posted.sparkSession.sparkContext.broadcast((items, best_parts))
    rows = max(64, min(BATCH_DOCS, BATCH_CELLS // max(1, size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shared.value, k, size)

        def part(batch: pa.RecordBatch) -> None:
            ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(2)
            at = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
            term, tf = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            m = 75 + np.array([25 * int(x) * documents // words for x in n], np.int64)
            parts = np.zeros((size, len(n)), np.int32)
            present = np.zeros((size, len(n)), bool)
            parts[term, at] = 1_000_000_000 * tf // (1000 * tf + 12 * m[at])
            present[term, at] = True
            search.batch(ids, parts, present)

        for batch in batches:
            for k0 in range(0, batch.num_rows, rows):
                part(batch.slice(k0, rows))
        found = [(number, int(d), int(s)) for number, (scores, ids) in search.best.items() for s, d in zip(scores, ids)]
        yield emit(schema, [list(c) for c in zip(*found)] if found else [[], [], []])

    return posted.select("doc_id", "n", "numbers", "counts").mapInArrow(run, schema)


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: the k best documents of every item, scores above 0.

    Every row of ``docs`` is a document, repeated rows too; null texts have no terms, and rows
    without id count in the statistics but are never returned.  Items without id take no part,
    and an item's different texts, each once, are one; items without terms have no rows.  Equal
    scores go by ascending id.  Texts are read whole, an empty table gives no rows, and extra
    columns, whatever their names, play no part.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    asked = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).alias("text")).dropna().distinct()
    asked = stored(asked.groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_list("text")), " ").alias("text")))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(total / block_bytes)
    out = []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id")
        # about block_bytes of text
        texts = [(r.item_id, (r.text or "").encode()) for r in mine.collect()]
        numbers = vocabulary(texts)
        if numbers:
            out.append(_block(docs, texts, numbers, k, id_col, text_col))
    if not out:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    found = out[0]
    for other in out[1:]:
        found = found.unionByName(other)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _block(docs: DataFrame, texts, numbers: dict[bytes, int], k: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    posted = stored(postings(docs, numbers, id_col, text_col))
    documents, words = posted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.lit(75) + F.expr(f"(25 * n * {documents}L) div {max(1, words)}L")
    each = posted.select(m.cast("bigint").alias("m"), F.explode(F.arrays_zip("numbers", "counts")).alias("p"))
    part = F.expr("(1000000000L * p.counts) div (1000L * p.counts + 12L * m)")
    # one row per term of the block
    known = each.groupBy(F.col("p.numbers").alias("number")).agg(F.count("*").alias("holding"), F.max(part).alias("best")).collect()
    weights = {r.number: weight(documents, r.holding) for r in known}
    asked = []
    for place, (_, text) in enumerate(texts):
        repeats = Counter(numbers[t] for t in terms(text))
        weighted = [(t, c * weights[t]) for t, c in sorted(repeats.items()) if weights.get(t)]
        if weighted:
            asked.append((place, weighted))
    found = _search(posted.where("doc_id is not null and size(numbers) > 0"), asked, {r.number: r.best for r in known}, len(numbers), documents, words, k)
    names = spark.createDataFrame([(place, item) for place, (item, _) in enumerate(texts)], "number int, item_id bigint")
    return found.join(F.broadcast(names), "number").drop("number")


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """The twenty best documents of every benchmark item of a directory."""
    return ranked(table(spark, directory, "documents").select("doc_id", "text"), table(spark, directory, "benchmark"))
