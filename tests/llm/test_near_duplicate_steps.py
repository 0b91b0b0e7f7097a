"""The two steps of near-duplicate linking against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from loanweave.llm import superminhash


def groups(sets, percent):
    """Smallest reachable node by all pairs."""
    label = {k: k for k in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_local_links_join_what_all_pairs_join():
    rng = random.Random(7)
    for _ in range(30):
        base = rng.sample(range(1000), 40)
        sets = {k: set(rng.sample(base, rng.randint(30, 40)) + rng.sample(range(1000), rng.randint(0, 4))) for k in range(25)}
        asks = [rng.random() < 0.5 for _ in sets]
        links = superminhash.local_links(list(sets), list(sets), asks, [np.array(sorted(s), np.uint64) for s in sets.values()], 80)
        assert all(100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a, b in links)
        found, want = {k: k for k in sets}, {k: k for k in sets}
        every = [(a, b) for a in sets for b in sets if a != b and asks[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        for label, pairs in ((found, links), (want, every)):
            for _ in sets:
                for a, b in pairs:
                    label[a] = label[b] = min(label[a], label[b])
        assert found == want and len(links) < len(sets)


def test_chains_and_small_blocks_lose_no_link(spark, monkeypatch):
    """Chains whose ends share nothing with the heaviest member, in blocks of a few nodes."""
    monkeypatch.setattr(superminhash, "BLOCK_SHINGLES", 150)
    rng = random.Random(2)
    texts = {}
    for chain in range(4):
        words = [f"{chain}w{rng.randrange(10**6)}" for _ in range(60)]
        for k in range(25):
            words = list(words)
            words[(k * 2) % 60] = f"{chain}x{k}"
            texts[len(texts)] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(58)} for k, t in texts.items()}
    got = {r.id: r.component_id for r in superminhash.near_duplicates(docs, size=3, percent=85).collect()}
    assert got == groups(sets, 85)


def test_the_number_of_steps_is_fixed(spark):
    """Every node of a bucket with several groups meets every node outside of its largest one."""
    members = spark.createDataFrame([((0, 1), k, 5) for k in range(40)], "bucket struct<band:int,key:bigint>, node bigint, n bigint")
    labels = spark.range(40).select(F.col("id").alias("node"), F.when(F.col("id") < 30, 0).otherwise(F.col("id")).cast("bigint").alias("label"))
    rows = superminhash._open_blocks(members, labels).collect()
    asking = {(r.node, r.r) for r in rows if r.asks}
    answering = {(r.node, r.r) for r in rows if not r.asks}
    assert {n for n, _ in asking} == set(range(30, 40)) and {n for n, _ in answering} == set(range(40))
