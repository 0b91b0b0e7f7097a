"""From raw documents to token ids: filter, deduplicate, decontaminate, redact and encode."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanweave.llm import aho_corasick, nbsvm, secrets, sentencepiece_chunks, superminhash
from loanweave.llm.common import table, unused
from loanweave.session import ensure_checkpoint_dir

#: Documents with a lower quality score go.
LEAST_QUALITY = 0.3


def set_aside(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its own columns of these names renamed, and the columns that restore it.

    An operator appends columns; one of the same name in ``docs`` would be lost to it.
    """
    renamed = {c: unused(docs, f"_own_{c}") for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(renamed), [F.col(f"`{renamed.get(c, c)}`").alias(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled rows of op7.

    Null and empty texts have a score too; repeated rows share theirs.  Columns of any name
    and tables without rows are fine, as in every stage.
    """
    docs, own = set_aside(docs, "score")
    labels = table(spark, sf_dir, "labels").where(~nbsvm.held_out(5, 0))
    return nbsvm.score(docs, labels).where(F.col("score") >= LEAST_QUALITY).select(*own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates.

    Links need a similarity of 0.8 on shingles of five words.  Documents without words stay;
    rows of one id stay or go together.
    """
    return superminhash.deduplicate(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; null and empty texts have none."""
    docs, own = set_aside(docs, "n_words", "runs", "items")
    found = aho_corasick.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("items") == 0).select(*own)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by its kind and ``n_chars`` counted anew.

    Null and empty texts stay as they are, and so do the counts of texts without secrets.
    """
    docs, own = set_aside(docs, "candidates", "secrets", "_repository", "_owner", "_row")
    found = secrets.redact(secrets.find_secrets(docs))
    changed = F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", changed).select(*own)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether decoding them gives the text again.

    A null text counts as empty; every row gives one row, repeated ones too.
    """
    import public_tokenizers

    done = sentencepiece_chunks.encode_decode(docs, str(public_tokenizers.path("piece_bpe_32k.model")))
    return done.select(
        "doc_id", "lang", "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL can't express the classifier and the encoder; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each but the last is written and read again."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
