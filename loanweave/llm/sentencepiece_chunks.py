"""SentencePiece encoding and decoding by a table of distinct chunks.

In a model whose pieces never hold a space marker behind another character, no merge
crosses the place where a marker follows a word.  The marked text therefore falls into
chunks (markers, then a word) that can be segmented one by one.  Each task keeps a table of
the distinct chunks it has met: a chunk goes through the library once, and the ids of a
document are joined from the table by position.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.llm.common import annotate, as_texts, table

MARKER = "▁"
#: Chunks of a task's table; a full table is emptied, which costs time but changes nothing.
TABLE_SIZE = 300_000
_SPACED = re.compile(" [ ]*[^ ]*")


def require_word_bound(processor: sentencepiece.SentencePieceProcessor) -> None:
    """Raise unless chunks may be segmented alone: no piece has a marker inside a word."""
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if MARKER in piece.lstrip(MARKER):
            raise ValueError(f"piece {i} crosses a marker: chunks can't be segmented alone")
    if processor.encode("a  b") != processor.encode("a") + processor.encode(" b"):
        raise ValueError("the model's normaliser changes white space: chunks can't be cut")


def units(text: str) -> list[str]:
    """The chunks of a text, each without its first marker (the library adds that one)."""
    text = text.replace(MARKER, " ")
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return [c[1:] for c in _SPACED.findall(f" {text}")]
    return text.split(" ")


class ChunkTable:
    """Ids (as 32-bit little-endian bytes) of the distinct chunks met so far."""

    def __init__(self, processor: sentencepiece.SentencePieceProcessor, size: int = TABLE_SIZE):
        self.processor, self.size = processor, size
        self.ids: dict[str, bytes] = {}
        self.changed: dict[str, str] = {}  # chunks that decoding alters

    def _learn(self, chunks: set[str]) -> None:
        if len(self.ids) + len(chunks) > self.size:
            self.ids.clear()
            self.changed.clear()

    def lookup(self, text: str) -> tuple[bytes, str]:
        """The packed ids of a text and what they decode to."""
        if not text:
            return b"", ""
        parts = units(text)
        distinct = set(parts)
        if not distinct <= self.ids.keys():
            self._learn(distinct)
            fresh = list(distinct.difference(self.ids))
            encoded = self.processor.encode(fresh, num_threads=1)
            # the empty chunk is a lone marker, which the library gives only before a space
            for chunk, ids in zip(fresh, encoded):
                if not chunk:
                    ids = [self.processor.piece_to_id(MARKER)]
                self.ids[chunk] = np.asarray(ids, "<i4").tobytes()
                if (decoded := self.processor.decode(ids)) != chunk:
                    self.changed[chunk] = decoded
        packed = b"".join([self.ids[p] for p in parts])
        if self.changed and not distinct.isdisjoint(self.changed):
            parts = [self.changed.get(p, p) for p in parts]
        return packed, " ".join(parts)


def encode_decode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Append ``ids`` (array<int>) and ``decoded`` (string) to every row.

    ``model_path`` must be readable on every executor.  A null or empty text has no ids and
    decodes to the empty string.  Texts are never cut.
    """

    def start():
        processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        require_word_bound(processor)
        chunks = ChunkTable(processor)

        def work(column):
            packed, decoded = zip(*(chunks.lookup(t) for t in as_texts(column)))
            offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype("i4")
            values = pa.Array.from_buffers(
                pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(packed))]
            )
            return [pa.ListArray.from_arrays(pa.array(offsets), values), list(decoded)]

        return work

    return annotate(docs, [text_col], "ids array<int>, decoded string", start)


def digests(spark: SparkSession, directory: str) -> DataFrame:
    """Token counts and digests of every document of a directory."""
    import public_tokenizers

    docs = table(spark, directory, "documents").select("doc_id", "text")
    done = encode_decode(docs, str(public_tokenizers.path("piece_bpe_32k.model")))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
