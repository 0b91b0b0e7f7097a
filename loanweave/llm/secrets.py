"""Secret scan with corpus-wide ownership frequency.

Patterns give candidate spans.  The hash of each candidate value is counted over the whole
corpus by distinct repositories and owners.  A value that many owners hold is an example
that people copy; a value of few owners looks live, in however many repositories of theirs
it is.  All spans are reported, and ``live`` tells the two apart.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanweave.llm.common import annotate, as_texts, stored, table

KINDS = ("assign", "access", "hex", "entropy")
#: Values held by at most so many owners, or this share of all owners if that is more, count
#: as live.
LIVE_OWNERS, LIVE_SHARE = 2, 0.1
#: Shannon bits per character from which a mixed string counts as random.
ENTROPY_BITS = 3.8

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_MIXED = re.compile(r"[A-Za-z0-9+/_-]{20,}")

_CANDIDATES = "array<struct<kind:string,start:bigint,end:bigint,value_sha256:string>>"


def _random_looking(value: str) -> bool:
    if not (re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= ENTROPY_BITS


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of every candidate, in order of start and kind."""
    found = []
    if "=" in text or ":" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 12:
                found.append(("assign", m.start(), m.end(), m[2]))
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    taken = [(s, e) for _, s, e, _ in found]
    for m in _MIXED.finditer(text):
        if _random_looking(m[0]) and all(m.end() <= s or m.start() >= e for s, e in taken):
            found.append(("entropy", m.start(), m.end(), m[0]))
    return sorted(found, key=lambda c: (c[1], KINDS.index(c[0])))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Append ``candidates``: kind, code point span and value hash.  A null text has none."""

    def start():
        def work(column):
            return [[
                [
                    {"kind": k, "start": s, "end": e, "value_sha256": hashlib.sha256(v.encode()).hexdigest()}
                    for k, s, e, v in candidates(text)
                ]
                for text in as_texts(column)
            ]]

        return work

    return annotate(docs, [text_col], f"candidates {_CANDIDATES}", start)


def ownership(scanned: DataFrame, repository_col: str, owner_col: str) -> DataFrame:
    """Distinct repositories and owners of every candidate value.

    Counted in three steps, each with partial sums, so that a value in a third of all
    rows is spread by repository before it meets in one place.
    """
    each = scanned.select(
        F.explode(F.array_distinct(F.transform("candidates", lambda c: c["value_sha256"]))).alias("value_sha256"),
        F.col(owner_col).alias("owner"),
        F.col(repository_col).alias("repository"),
    )
    pairs = each.groupBy("value_sha256", "owner", "repository").agg(F.lit(1).alias("one"))
    owned = pairs.groupBy("value_sha256", "owner").agg(F.count("*").alias("repositories"))
    return owned.groupBy("value_sha256").agg(
        F.sum("repositories").alias("repositories"), F.count("*").alias("owners")
    )


def find_secrets(
    docs: DataFrame,
    text_col: str = "text",
    repository_col: str = "doc_id",
    owner_col: str = "source",
    live_owners: int = LIVE_OWNERS,
    live_share: float = LIVE_SHARE,
    carry: list[str] | None = None,
) -> DataFrame:
    """Append ``secrets``: kind, start, end, value_sha256, repositories, owners and live.

    Every row and column stays; rows with equal ids are told apart.  Null repositories and
    owners count as one value of their own.  Every span is listed, copied values with ``live``
    false.  The scan is stored once with the columns named by ``carry`` (default: all), which
    the result has.
    """
    kept = docs.columns if carry is None else carry
    scanned = stored(
        scan(docs, text_col).select(
            *[F.col(c) for c in kept if c not in ("candidates", "secrets")],
            F.col(repository_col).alias("_repository"),
            F.col(owner_col).alias("_owner"),
            F.monotonically_increasing_id().alias("_row"),
            "candidates",
        )
    )
    counted = ownership(scanned, "_repository", "_owner")
    few = max(live_owners, live_share * scanned.select("_owner").distinct().count())
    exploded = scanned.select("_row", F.explode("candidates").alias("c"))
    judged = (
        exploded.select("_row", "c.*")
        .join(counted, "value_sha256")
        .withColumn("live", F.col("owners") <= few)
    )
    entry = F.struct("start", "rank", "kind", "end", "value_sha256", "repositories", "owners", "live")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank")
    gathered = judged.select("*", rank).groupBy("_row").agg(F.array_sort(F.collect_list(entry)).alias("secrets"))
    empty = F.array().cast(gathered.schema["secrets"].dataType)
    return (
        scanned.drop("candidates", "_repository", "_owner")
        .join(gathered, "_row", "left")
        .withColumn("secrets", F.coalesce("secrets", empty))
        .drop("_row")
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Counts and spans of the secrets of every document of a directory."""
    docs = table(spark, directory, "documents").select("doc_id", "source", "text")
    found = find_secrets(docs, carry=["doc_id"])
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(F.filter("secrets", lambda s: s["kind"] != "entropy")), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
        F.size(F.filter("secrets", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("secrets", lambda s: ~s["live"])).cast("long").alias("n_copied"),
    )


def redact(found: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace every listed span by its kind in angle brackets; overlapping spans are one."""

    def start():
        def work(texts, secrets):
            out = []
            for text, spans in zip(texts.to_pylist(), secrets.to_pylist()):
                if spans:
                    parts, at = [], 0
                    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= at:
                            parts += [text[at : s["start"]], f"<{s['kind']}>"]
                        at = max(at, s["end"])
                    text = "".join(parts) + text[at:]
                out.append(text)
            return [out]

        return work

    return annotate(found, [text_col, "secrets"], f"{text_col} string", start)
