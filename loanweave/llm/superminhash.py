"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

SuperMinHash draws one permutation of the registers per element and gives register p(j) the
value r + j: the ranks of an element are correlated, so each element falls into every
register once and the estimate varies less than with independent hashes.  Registers are
filled rank by rank for all elements of a document at once, and filling ends as soon as no
later rank can lower a register, which gives the same signature.

Documents with equal shingle sets are one node.  Nodes that share a band are candidates, and two
steps verify them on their full sets.  Every member of a bucket is compared with the bucket's
heaviest one, which gives a number of pairs linear in the bucket.  In buckets that still hold
several groups, the members outside of the largest group are compared with all of other
groups, in blocks of bounded size.  No candidate is left out, and the number of steps is fixed.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.llm.common import annotate, as_bytes, stored, table

#: Rows of a band, and the chance that a pair at the threshold shares no band.
BAND_ROWS, MISS = 5, 1e-6
#: Elements whose ranks are drawn together, and bytes of text hashed together, which bounds
#: the memory of a long document.
BLOCK, STRETCH = 1 << 15, 1 << 19
#: Shingles of one block of a bucket, about; a group of the second step holds two blocks.
BLOCK_SHINGLES = 1 << 20

# lower case for A-Z, a space for every separator
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_STEP = 0x9E3779B97F4A7C15


def bands_for(threshold: float, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands after which a pair of the threshold's similarity is missed with chance ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def _powers(base: int, length: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    return np.concatenate([[np.uint64(1)], np.full(length - 1, base, np.uint64)]).cumprod(dtype=np.uint64)


#: Odd bases of two polynomial hashes and the powers of each and of its inverse.
_BASES = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)
_TABLES: dict[int, list[np.ndarray]] = {}


def _tables(length: int) -> list[np.ndarray]:
    if not _TABLES or len(_TABLES[0][0]) < length:
        size = max(1 << 16, 1 << (length - 1).bit_length())
        for k, base in enumerate(_BASES):
            _TABLES[k] = [_powers(base, size), _powers(pow(base, -1, 1 << 64), size)]
    return [t for k in range(len(_BASES)) for t in _TABLES[k]]


def _word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word of a text whose white space is spaces."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[False], raw != 32, [False]]).view(np.int8)
    edge = np.diff(inside)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    values = raw.astype(np.uint64) + np.uint64(1)
    tables = _tables(len(raw) + 1)
    # differences of prefix sums, shifted to the word's start, are the words' polynomials
    hashed = (last - first).astype(np.uint64)
    for k in range(len(_BASES)):
        ahead, back = tables[2 * k], tables[2 * k + 1]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values * ahead[: len(raw)], dtype=np.uint64)])
        hashed = _mixed(hashed + (sums[last] - sums[first]) * back[first])
    return hashed


def shingles(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of UTF-8 text (A-Z in lower case).

    Words are separated by space, tab, line feed, vertical tab, form feed and return.  A text
    of fewer words is one shingle; a text without words has none.
    """
    plain, parts, at = text.translate(_PLAIN), [], 0
    while at < len(plain):
        cut = len(plain) if len(plain) - at <= STRETCH else plain.find(b" ", at + STRETCH)
        cut = len(plain) if cut < 0 else cut
        parts.append(_word_hashes(plain[at:cut]))
        at = cut
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    joined = np.full(count, width, np.uint64)
    for k in range(width):
        joined = _mixed(joined + words[k : k + count])
    joined.sort()
    return joined[np.concatenate([[True], joined[1:] != joined[:-1]])]


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64 of every value."""
    x = x + np.uint64(_STEP)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(sets: list[np.ndarray], registers: int) -> np.ndarray:
    """SuperMinHash registers of every set: the smallest rank plus fraction in each.

    All sets advance rank by rank together; a set leaves once every register holds a value
    below the rank, because no later rank can lower one.  Empty sets keep infinity.
    """
    lowest = np.full((len(sets), registers), np.inf)
    flat = lowest.reshape(-1)
    elements = np.concatenate([np.zeros(0, np.uint64), *sets])
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for at in range(0, len(elements), BLOCK):
        part, owner = elements[at : at + BLOCK], owners[at : at + BLOCK]
        places = np.tile(np.arange(registers, dtype=np.int16), (len(part), 1))
        active, lo, hi = np.arange(len(part)), owner[0], owner[-1] + 1
        for j in range(registers):
            unfinished = lowest[lo:hi].max(axis=1) > j
            active = active[unfinished[owner[active] - lo]]
            if not len(active):
                break
            drawn = _mixed(part[active] + np.uint64(_STEP * (j + 1) & 0xFFFFFFFFFFFFFFFF))
            fraction = (drawn >> np.uint64(32)).astype(np.float64) / 4294967296.0
            k = j + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(registers - j)) >> np.uint64(32)).astype(np.int64)
            chosen = places[active, k]
            places[active, k] = places[active, j]
            np.minimum.at(flat, owner[active] * registers + chosen, fraction + j)
    return lowest


def signature(elements: np.ndarray, registers: int) -> np.ndarray:
    return signatures([elements], registers)[0]


def _bands(registers: np.ndarray, rows: int) -> list[int]:
    """One signed 64-bit key per band."""
    raw = registers.astype("<f8").tobytes()
    width = rows * 8
    keys = [xxhash.xxh3_64_intdigest(raw[k : k + width], seed=k) for k in range(0, len(raw), width)]
    return [k - (1 << 64) if k >= 1 << 63 else k for k in keys]


def _set_key(packed: bytes) -> bytes:
    return hashlib.blake2b(packed, digest_size=16).digest()


def sketch(docs: DataFrame, text_col: str, size: int, threshold: float) -> DataFrame:
    """Append ``n_shingles``, ``set_key`` (a digest of the set) and ``bands``."""
    bands = bands_for(threshold)

    def start():
        def work(column):
            sets = [shingles(t, size) for t in as_bytes(column)]
            keys = [_set_key(s.tobytes()) for s in sets]
            distinct = dict(zip(keys, sets))
            drawn = signatures(list(distinct.values()), bands * BAND_ROWS)
            banded = {
                key: _bands(row, BAND_ROWS) if len(s) else [] for (key, s), row in zip(distinct.items(), drawn)
            }
            return [[len(s) for s in sets], keys, [banded[k] for k in keys]]

        return work

    return annotate(docs, [text_col], "n_shingles bigint, set_key binary, bands array<bigint>", start)


def _elements(nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Packed shingle sets of the given nodes, recomputed from the texts that define them."""

    def start():
        def work(column):
            packed = [shingles(t, size).tobytes() for t in as_bytes(column)]
            return [packed, [_set_key(p) for p in packed]]

        return work

    texts = docs.join(nodes.select(F.col("node").alias("id")), "id", "left_semi")
    found = annotate(texts, ["text"], "elements binary, set_key binary", start).drop("text")
    return found.join(nodes.select("node", "set_key"), "set_key").where("id = node").select("node", "elements")


def _verified(pairs: DataFrame, elements: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets reach the threshold."""
    left = elements.select(F.col("node").alias("a"), F.col("elements").alias("left"))
    right = elements.select(F.col("node").alias("b"), F.col("elements").alias("right"))

    def start():
        def similar(left: bytes, right: bytes) -> bool:
            x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            return 100 * common >= percent * (len(x) + len(y) - common)

        return lambda left, right: [list(map(similar, left.to_pylist(), right.to_pylist()))]

    judged = annotate(pairs.join(left, "a").join(right, "b"), ["left", "right"], "linked boolean", start)
    return judged.where("linked").select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node reachable) of all nodes with links.

    Distributed union-find by contraction: every node hooks on its smallest neighbour, the
    hooks are followed (pointer jumping), and the links are rewritten between the hooks'
    ends until none is left.  The smallest node of a component always stays its own end, so
    it is the one that remains.  Every round is stored; no component is gathered anywhere.
    """
    edges, labels = links.where("a != b"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("v")).alias("to")))
        if hooks.isEmpty():
            return hooks.select(F.col("v").alias("node"), F.col("to").alias("label")) if labels is None else labels
        ends = _followed(hooks)
        if labels is None:
            labels = ends.select(F.col("v").alias("node"), F.col("end").alias("label"))
        else:
            moved = ends.withColumnRenamed("v", "label")
            labels = stored(labels.join(moved, "label", "left").select("node", F.coalesce("end", "label").alias("label")))
        edges = stored(
            edges.join(ends.select(F.col("v").alias("a"), F.col("end").alias("x")), "a")
            .join(ends.select(F.col("v").alias("b"), F.col("end").alias("y")), "b")
            .where("x != y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct()
        )


def _followed(hooks: DataFrame) -> DataFrame:
    """``v`` and ``end`` of every chain of hooks; each jump doubles the length followed."""
    ends = hooks.select("v", F.col("to").alias("end"))
    while True:
        beyond = ends.select(F.col("v").alias("end"), F.col("end").alias("far"))
        jumped = stored(ends.join(beyond, "end").select("v", F.col("far").alias("end"), (F.col("far") != F.col("end")).alias("moved")))
        ends = jumped.select("v", "end")
        if jumped.where("moved").isEmpty():
            return ends


def _buckets(nodes: DataFrame) -> DataFrame:
    """``bucket``, ``node``, ``n`` and ``weight`` of the buckets with several members.

    Bands often gather the same members: of buckets with equal member sets (equal digests
    and counts) one stays.  A node's weight is the sum of its buckets' sizes; in a group of
    near copies it is largest for the text that the others were made from.
    """
    keyed = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    sizes = keyed.groupBy("band", "key").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"),
    )
    one = sizes.where("members > 1").groupBy("members", "x", "y").agg(F.min(F.struct("band", "key")).alias("bucket"))
    members = stored(
        keyed.join(one.select("members", "bucket.band", "bucket.key"), ["band", "key"]).select(
            F.struct("band", "key").alias("bucket"), "node", "n", "members"
        )
    )
    weights = members.groupBy("node").agg(F.sum("members").alias("weight"))
    return members.drop("members").join(weights, "node")


def _with_centre(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of every member and its bucket's heaviest one, as far as their sizes allow a link."""
    # partial maxima make a bucket of any size cheap
    centre = members.groupBy("bucket").agg(F.max(F.struct("weight", -F.col("node"), "node", "n")).alias("c"))
    return (
        members.join(centre, "bucket")
        .where("node != c.node")
        .where(100 * F.least("n", "c.n") >= percent * F.greatest("n", "c.n"))
        .select(F.least("node", "c.node").alias("a"), F.greatest("node", "c.node").alias("b"))
        .distinct()
    )


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after links between nodes have joined their groups."""
    left = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
    right = labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    joined = links.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    merged = components(joined).select(F.col("node").alias("label"), F.col("label").alias("end"))
    return stored(labels.join(merged, "label", "left").select("node", F.coalesce("end", "label").alias("label")))


def _open_blocks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets with several labels, in blocks that are compared as one group.

    Nodes outside of a bucket's largest group ask, all nodes answer.  Both fall into blocks of
    bounded shingle numbers, and a group is one block that asks with one that answers, so
    every pair of two groups meets, and none inside the largest group is looked at.
    """
    grouped = members.select("bucket", "node", "n").join(labels, "node")
    per_label = grouped.groupBy("bucket", "label").agg(F.count("*").alias("members"), F.sum("n").alias("n"))
    largest = F.max(F.struct("members", -F.col("label"), "label", "n"))
    shape = per_label.groupBy("bucket").agg(F.count("*").alias("labels"), F.sum("n").alias("all"), largest.alias("most")).where("labels > 1")
    blocks = lambda n: F.ceil(n / F.lit(BLOCK_SHINGLES)).cast("int")
    shape = shape.select(
        "bucket", F.col("most.label").alias("main"), blocks(F.col("all")).alias("answering"), blocks(F.col("all") - F.col("most.n")).alias("asking")
    )
    rows = grouped.join(shape, "bucket")
    all_of = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda n, seed: F.array(F.pmod(F.xxhash64(F.lit(seed), "node"), F.col(n)).cast("int"))
    keep = ["bucket", "node", "label"]
    asks = rows.where("label != main").select(
        *keep, F.lit(True).alias("asks"), F.explode(own("asking", 1)).alias("q"), all_of("answering").alias("others")
    ).select(*keep, "asks", "q", F.explode("others").alias("r"))
    answers = rows.select(
        *keep, F.lit(False).alias("asks"), F.explode(own("answering", 2)).alias("r"), all_of("asking").alias("others")
    ).select(*keep, "asks", F.explode("others").alias("q"), "r")
    return asks.unionByName(answers)


def local_links(nodes: list[int], labels: list[int], asks: list[bool], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between different groups of a block that its asking nodes find: a local union-find.

    An inverted index counts the shingles that an asking node shares with all others; a link is
    emitted only if it joins two groups, so there are fewer links than nodes.
    """
    parent = {label: label for label in labels}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate([np.zeros(0, np.uint64), *sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(sets)), sizes)[order]
    links = []
    for k in np.flatnonzero(asks):
        low, high = np.searchsorted(flat, sets[k], "left"), np.searchsorted(flat, sets[k], "right")
        runs = high - low
        at = np.repeat(low - np.concatenate([[0], runs.cumsum()[:-1]]), runs) + np.arange(runs.sum())
        common = np.bincount(owner[at], minlength=len(sets))
        for other in np.flatnonzero(100 * common >= percent * (sizes + sizes[k] - common)):
            x, y = root(labels[k]), root(labels[other])
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((nodes[k], nodes[other]))
    return links


def _found_in_blocks(blocks: DataFrame, elements: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) from every group of an asking and an answering block."""

    def find(group: pa.Table) -> pa.Table:
        sets = [np.frombuffer(e, np.uint64) for e in group["elements"].to_pylist()]
        columns = [group[c].to_pylist() for c in ("node", "label", "asks")]
        links = local_links(*columns, sets, percent)
        return pa.table({"a": pa.array([min(p) for p in links], pa.int64()), "b": pa.array([max(p) for p in links], pa.int64())})

    return blocks.join(elements, "node").groupBy("bucket", "q", "r").applyInArrow(find, "a bigint, b bigint").distinct()


def _links(nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``node`` and ``label`` of the linked nodes among node, set_key, n and bands.

    First every member of a bucket is compared with the bucket's heaviest one, which joins near
    all of a group of copies.  Then the members of buckets that still hold several groups are
    compared across these groups, block by block.  Each step is followed by one contraction.
    """
    members = stored(_buckets(nodes))
    involved = stored(nodes.join(members.select("node").distinct(), "node", "left_semi"))
    elements = stored(_elements(involved.select("node", "set_key"), docs, size))
    labels = involved.select("node", F.col("node").alias("label"))
    labels = _relabelled(labels, stored(_verified(_with_centre(members, percent), elements, percent)))
    return _relabelled(labels, stored(_found_in_blocks(_open_blocks(members, labels), elements, percent)))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80,
) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` and ``kept``, one row per input row.

    Two documents are linked if 100 x common shingles >= percent x all shingles of both;
    equal sets are linked whatever their number.  ``component_id`` is the smallest id
    reachable over links.  Null texts and texts without words have no shingles and are
    linked with nothing.  Rows without id have no component and are kept.  Ids should be
    unique; the texts of a repeated id count as one document.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = stored(sketch(texts, "text", size, percent / 100).drop("text"))
    # equal sets are one node, named by its smallest id; partial minima make hot sets cheap
    nodes = stored(
        marked.where("n_shingles > 0 and id is not null")
        .groupBy("set_key")
        .agg(F.min(F.struct("id", "n_shingles", "bands")).alias("m"))
        .select(F.col("m.id").alias("node"), "set_key", F.col("m.n_shingles").alias("n"), F.col("m.bands").alias("bands"))
    )
    labels = _links(nodes, texts.where("id is not null"), size, percent)
    named = nodes.join(labels, "node", "left").groupBy("set_key").agg(F.min(F.coalesce("label", "node")).alias("label"))
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.coalesce("label", "id")).otherwise(F.col("id"))
    return (
        marked.select("id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .select("id", "n_shingles", component.alias("component_id"))
        .select("*", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` whose document represents its group; all columns stay."""
    found = near_duplicates(docs, id_col, text_col, size, percent)
    dropped = found.where("not kept").select(F.col("id").alias(id_col))
    return docs.join(dropped, id_col, "left_anti").select(*docs.columns)


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Groups of near duplicates among all documents of a directory."""
    docs = table(spark, directory, "documents").select("doc_id", "text")
    return near_duplicates(docs, size=3, percent=85).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept"
    )
