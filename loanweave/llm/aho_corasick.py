"""Benchmark decontamination with one Aho-Corasick automaton.

The normalised test items are cut into windows of consecutive words, and one automaton over
word numbers holds all windows.  Every text is scanned once; a word outside the items'
vocabulary resets the automaton.  Hits are word positions, which map back to code points of
the original text.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.llm.common import annotate, as_bytes, stored, table

#: UTF-8 bytes of item text in one automaton.  Larger item tables are cut into blocks, each
#: with its own automaton and scan, so memory stays bounded and no item is left out.
BLOCK_BYTES = 2 << 20

_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    """Words of UTF-8 text: A-Z in lower case, every other ASCII sign a gap."""
    return text.translate(_WORD).split()


class Windows:
    """The automaton over all windows of the given (item id, text) pairs."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for k in range(max(1, len(ids) - size + 1) if ids else 0):
                owners.setdefault(tuple(ids[k : k + size]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, names in owners.items():
            self.automaton.add_word(window, (len(window), names))
        self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged runs [first, last] of hit words, and the items with a window here."""
        if self.empty or not found:
            return [], set()
        runs: list[list[int]] = []
        items: set[str] = set()
        number = self.vocabulary.get
        for end, (length, names) in self.automaton.iter(tuple([number(w, 0) for w in found])):
            first = end - length + 1
            items |= names
            while runs and first <= runs[-1][1] + 1:
                first = min(first, runs.pop()[0])
            runs.append([first, end])
        return [(a, b) for a, b in runs], items


def spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point spans of word runs in the original text."""
    at = [m.span() for m in _ORIGINAL_WORD.finditer(text)]
    return [(at[a][0], at[b][1]) for a, b in runs]


_FIELDS = "n_words bigint, runs array<struct<first:bigint,last:bigint>>, items array<string>"


def _scan(docs: DataFrame, items: list[tuple[str, bytes]], text_col: str, size: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def start():
        windows = Windows(shared.value, size)

        def work(column):
            n_words, runs, hits = [], [], []
            for text in as_bytes(column):
                found = words(text)
                run, names = windows.scan(found)
                n_words.append(len(found))
                runs.append([{"first": a, "last": b} for a, b in run])
                hits.append(sorted(names))
            return [n_words, runs, hits]

        return work

    return annotate(docs, [text_col], _FIELDS, start)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Append ``n_words``, ``runs`` (first and last word of each hit run) and ``items``.

    Items with fewer words than ``window`` are one window; items without words never occur.
    A null text has no words.  Repeated items share their windows.  Item tables above
    ``block_bytes`` are scanned block by block and the results united exactly.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("binary").alias("body")
    ).where("item is not null and body is not null")
    total = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1

    def block(k: int) -> list[tuple[str, bytes]]:
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == k)
        return [(r.item, bytes(r.body)) for r in part.collect()]

    if blocks == 1:
        return _scan(docs, block(0), text_col, window)
    # rows get a number once, in a stored copy, because repeated ids must stay apart
    base = stored(docs.withColumn("_row", F.monotonically_increasing_id()))
    parts = None
    for k in range(blocks):
        part = _scan(base.select("_row", text_col), block(k), text_col, window).where(F.size("items") > 0)
        part = part.select("_row", "runs", "items")
        parts = part if parts is None else parts.unionByName(part)
    united = parts.groupBy("_row").agg(
        F.flatten(F.collect_list("runs")).alias("all_runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    merged = annotate(united, ["all_runs"], "runs array<struct<first:bigint,last:bigint>>", _merge_start)
    counted = _scan(base, [], text_col, window).drop("runs", "items")
    none = F.array().cast("array<struct<first:bigint,last:bigint>>")
    return (
        counted.join(merged.select("_row", "runs", "items"), "_row", "left")
        .withColumn("runs", F.coalesce("runs", none))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
        .drop("_row")
    )


def _merge_start():
    def work(column):
        out = []
        for runs in column.to_pylist():
            merged: list[list[int]] = []
            for first, last in sorted((r["first"], r["last"]) for r in runs):
                if merged and first <= merged[-1][1] + 1:
                    merged[-1][1] = max(last, merged[-1][1])
                else:
                    merged.append([first, last])
            out.append([{"first": a, "last": b} for a, b in merged])
        return [out]

    return work


def locate(hits: DataFrame, text_col: str = "text") -> DataFrame:
    """Append ``hit_spans``: code points (end exclusive) of each hit run in the text."""

    def start():
        def work(texts, runs):
            out = []
            for text, run in zip(texts.to_pylist(), runs.to_pylist()):
                at = spans(text, [(r["first"], r["last"]) for r in run]) if run else []
                out.append([{"start": a, "end": b} for a, b in at])
            return [out]

        return work

    return annotate(hits, [text_col, "runs"], "hit_spans array<struct<start:bigint,end:bigint>>", start)


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Words, hit words and items of every document of a directory."""
    docs = table(spark, directory, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, directory, "benchmark"))
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda t, r: t + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
