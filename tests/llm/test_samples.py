"""Bounded samples: the smallest different hashes, without a sort of the whole table."""

import pytest
from pyspark.sql import functions as F

from loanweave.llm import licences, multi_index
from loanweave.llm.common import among_smallest, unused


@pytest.mark.parametrize("n", [1, 7, 300, 5_000])
def test_condition_keeps_the_smallest_hashes_and_few_others(spark, n):
    # one value is a third of all rows
    df = spark.range(4_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("text"))
    hashed = F.xxhash64("text")
    every = sorted({r.h for r in df.select(hashed.alias("h")).collect()})
    kept = sorted({r.h for r in df.where(among_smallest(df, hashed, n)).select(hashed.alias("h")).collect()})
    assert kept[:n] == every[:n]
    assert len(kept) <= 1.05 * n + 20
    assert df.limit(0).where(among_smallest(df.limit(0), hashed, n)).count() == 0


def test_copies_do_not_fill_a_licence_sample(spark):
    texts = [(f"Sentence {k} about rivers and boats number {k}.",) for k in range(40)] + [("The same old words again.",)] * 400
    docs = spark.createDataFrame(texts + [(None,)], "text string")
    repeated, once = licences.classifier(docs, "text", 41), licences.classifier(docs.distinct(), "text", 41)
    words = licences.words("Released under the MIT License.")
    assert repeated.predict(words) == once.predict(words)


def test_unused_names_clash_with_nothing(spark):
    df = spark.range(1).select(F.lit(1).alias("Host"), F.lit(2).alias("_host"))
    assert unused(df, "host") == "__host" and unused(df, "salt") == "salt"
