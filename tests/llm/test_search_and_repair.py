"""Conversation repair, lexical search and product search against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanweave.llm import conversation_repair, norm_buckets, presence_masks
from loanweave.llm.catalog import QUERIES
from loanweave.llm.common import table

SF = "/root/testdata/sf0.001"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(rows, kinds):
    """Shortest path over (rows used, last role), shortest letters first among equals."""
    heap, settled = [(0, "", 0, "", ())], set()
    while True:
        cost, letters, k, last, said = heapq.heappop(heap)
        if k == len(rows) and last in ("", "a"):
            return cost, letters, said
        if (k, last) in settled:
            continue
        settled.add((k, last))
        for role in "ua":
            if (last, role) in NEXT:
                heapq.heappush(heap, (cost + 3, letters + "I", k, role, (*said, NAMES[role] + ":")))
        if k == len(rows):
            continue
        heapq.heappush(heap, (cost + 4, letters + "D", k + 1, last, said))
        if kinds[k] != "gone":
            extra = 3 if kinds[k] == "cut" else 0
            _, role, text = rows[k]
            if (last, role[:1]) in NEXT:
                heapq.heappush(heap, (cost + extra, letters + "K", k + 1, role[:1], (*said, f"{role}:{text}")))
            for new in "ua":
                if (last, new) in NEXT:
                    heapq.heappush(heap, (cost + 3 + extra, letters + "R", k + 1, new, (*said, f"{NAMES[new]}:{text}")))


def repaired(rows):
    """conv -> the digest columns, from rows after damage."""
    found = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in mine if t is not None]
        seen, kinds, count = set(), [], Counter()
        for _, role, text in mine:
            body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            count[fault] += 1
            kinds.append({"truncated": "cut", "": ""}.get(fault, "gone"))
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, letters, said = cheapest(mine, kinds)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        found[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, letters, digest)
    return found


def repair_result(df):
    done = conversation_repair.repair(df)
    hashes = {r.conv_id: r.sha256 for r in conversation_repair.text_digests(done.messages("conv")).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (*tuple(r)[1:], hashes.get(r.conv_id, nothing)) for r in done.summary.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit").collect()}


def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = repaired(damaged(rows))
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, SF).collect()}
    assert {c: got[c] for c in want} == want
    assert got.keys() == {r[0] for r in rows}


def test_a_conversation_over_many_blocks_is_repaired_as_one(spark, monkeypatch):
    """Long conversations, hot rows, unknown roles, ties, nulls and clashing columns."""
    monkeypatch.setattr(conversation_repair, "LEAST_BLOCK", 4)
    rng = random.Random(5)
    rows = [(1, rng.choice([None, *range(60)]), rng.choice(["user", "assistant", "system", "tool", "", None, "umbra"]),
             rng.choice([None, "", " \n", "Yes.", "No", "Why?", f"{k}!", f"cut {k}", "Été. \t"])) for k in range(300)]
    rows += [(2, None, "user", "same.")] * 150 + [(None, 3, "assistant", "Hm."), (4, 9, "system", "Be kind."), (5, 1, None, None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df = df.withColumns({n: F.lit("clash") for n in ("block", "place", "kind", "conv", "audit", "state")}).repartition(7)
    want = repaired([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    assert repair_result(df) == want
    blocks = conversation_repair.repair(df).rows.groupBy("conv").agg(F.countDistinct("block").alias("n")).collect()
    assert max(b.n for b in blocks) >= 15
    damage = conversation_repair.damage(df)
    assert Counter(map(tuple, damage.collect())) == Counter(damaged(rows))


def test_messages_follow_the_audit(spark):
    rows = [(7, 0, "assistant", "Hello."), (7, 1, "assistant", "Again."), (7, 2, "user", "cut"), (7, 3, "user", "Bye!")]
    done = conversation_repair.repair(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    said = done.messages().orderBy("place", "entry").collect()
    want = cheapest([r[1:] for r in rows], ["", "", "cut", ""])
    assert done.summary.first().audit == want[1]
    assert tuple(f"{m.role}:{m.text}" for m in said) == want[2]
    assert "".join(m.edit for m in said) == want[1].replace("D", "")


def test_nothing_to_repair(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    done = conversation_repair.repair(empty)
    assert done.summary.count() == done.messages().count() == 0


def lexical(docs, items, k):
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    split = [(d, Counter(word.findall((t or "").translate(lower)))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in split]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text in items:
        asked = Counter(word.findall(text.translate(lower)))
        scored = []
        for (doc, held), n in zip(split, sizes):
            m = 75 + 25 * n * n_docs // max(1, total)
            score = sum(
                c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * held[t] // (1000 * held[t] + 12 * m))
                for t, c in asked.items() if t in held)
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_search_with_odd_rows_and_blocks(spark):
    rng = random.Random(3)
    letters = [f"w{k}" for k in range(200)] + ["É", "漢字", "don", "T"]
    docs = [(k, " ".join(rng.choices(letters, k=rng.choice([1, 5, 40])))) for k in range(300)]
    docs += [(k, docs[0][1]) for k in range(300, 420)] + [(420, None), (421, ""), (422, "?! "), (423, "w1 " * 50_000), (None, "w1 w2"), (5, docs[5][1])]
    items = [(k, " ".join(rng.choices(letters, k=rng.choice([1, 3, 90])))) for k in range(25)] + [(25, "DON't É"), (26, "absent words"), (27, "")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({n: F.lit("x") for n in ("n", "numbers", "score", "rank", "counts")})
    asked = spark.createDataFrame([*items, items[0], (None, "w1"), (28, None)], "item_id bigint, text string").withColumn("number", F.lit("x"))
    want = lexical(docs, items, 20)
    assert sorted(map(tuple, presence_masks.ranked(df, asked).collect())) == want
    assert sorted(map(tuple, presence_masks.ranked(df, asked, block_bytes=800).collect())) == want
    assert presence_masks.ranked(df.limit(0), asked).count() == presence_masks.ranked(df, asked.limit(0)).count() == 0


def test_masks_are_left_out_only_by_their_bounds():
    rng = np.random.default_rng(2)
    parts = rng.integers(1, 1000, (40, 3000)) * (rng.random((40, 3000)) < 0.1)
    weighted = [(t, int(w)) for t, w in enumerate(rng.integers(1, 9000, 40))]
    search = presence_masks.Search([(0, weighted)], {t: int(parts[t].max()) for t in range(40)}, 20, 40)
    for k in range(0, 3000, 500):
        search.batch(np.arange(k, k + 500), parts[:, k : k + 500].astype(np.int32), parts[:, k : k + 500] > 0)
    scores = np.array([w for _, w in weighted]) @ parts
    want = np.lexsort((np.arange(3000), -scores))[:20]
    assert list(search.best[0][1]) == list(want) and list(search.best[0][0]) == list(scores[want])
    assert search.scored < 2500


def dot(a, b):
    return max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b))))


def largest(rows, queries, k):
    out = []
    for q, v in queries.items():
        near = sorted((-dot(v, w), i) for i, w in rows.items() if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near)]
    return sorted(out)


def test_products_of_odd_vectors(spark):
    rng = random.Random(4)
    hot = [0.5, -0.25, 1.0]
    rows = [(k, [rng.gauss(0, rng.choice([0.01, 1, 30])) for _ in range(3)]) for k in range(200)]
    rows += [(k, hot) for k in range(200, 330)]
    rows += [(400, [0.0, 0.0, 0.0]), (401, []), (402, [1.0]), (403, [1e12, -1e12, 1e13]), (404, [1e300, 1.0, 1.0]), (50, rows[50][1])]
    bad = [(500, None), (501, [1.0, None, 2.0]), (502, [float("nan"), 0.0, 0.0]), (503, [float("inf"), 0.0, 1.0]), (None, hot)]
    df = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>")
    df = df.withColumns({n: F.lit("x") for n in ("id", "vector", "rank", "score", "length", "spread")})
    top = (1 << 63) - 1
    whole = {i: [max(-top - 1, min(top, math.floor(256 * x))) for x in v] for i, v in rows}
    asked = {i: v for i, v in whole.items() if i % 10 == 0 or i > 399}
    got = norm_buckets.largest_products(df, df.where("vec_id % 10 = 0 or vec_id > 399"))
    assert sorted(map(tuple, got.collect())) == largest(whole, asked, 5)
    assert norm_buckets.largest_products(df.limit(0), df).count() == norm_buckets.largest_products(df, df.limit(0)).count() == 0
    two = df.where("vec_id in (1, 2)")
    assert [tuple(r) for r in norm_buckets.largest_products(two, two.where("vec_id = 1")).collect()] == [(1, 1, 2, dot(whole[1], whole[2]))]


def test_query_blocks_give_the_same(spark, monkeypatch):
    vectors = table(spark, SF, "embeddings")
    whole = sorted(map(tuple, norm_buckets.digests(spark, SF).collect()))
    monkeypatch.setattr(norm_buckets, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(norm_buckets, "SEED_ROWS", 2)
    assert sorted(map(tuple, norm_buckets.largest_products(vectors, vectors.where("vec_id % 50 = 0")).collect())) == whole


@pytest.mark.parametrize("spread", [0.05, 2.0])
def test_all_three_prunings_are_used_and_exact(spread):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    rows = (centres[rng.integers(0, 40, 6000)] + spread * rng.normal(size=(6000, 16))) * rng.lognormal(0, 0.5, 6000)[:, None]
    rows = np.floor(256 * rows).astype(np.int64)
    rows = rows[np.argsort(-(rows.astype(float) ** 2).sum(1), kind="stable")]
    queries = norm_buckets.Queries(rows[::300])
    best = norm_buckets.Best(np.full(len(queries.rows), -(1 << 63)), 6)
    counts = dict.fromkeys(("pruned", "coordinate", "length", "verified"), 0)
    ids = [[k] for k in range(len(rows))]
    for a, b in norm_buckets.buckets(rows):
        queries.bucket(rows[a:b], ids[a:b], best, counts)
    scores = queries.rows @ rows.T
    for q in range(len(queries.rows)):
        assert [(-s, i) for s, i in best.found[q]] == [(int(scores[q, i]), int(i)) for i in np.lexsort((np.arange(6000), -scores[q]))[:6]]
    assert counts["pruned"] and counts["length"] and counts["verified"] < scores.size
    assert counts["coordinate"] or spread > 1
