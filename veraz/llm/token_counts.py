"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts come in slices balanced by bytes and are split where no token can cross: in front of white
space, and within ASCII words where letters, digits and signs meet (see ``pieces``). A long text
reaches the tokenizer in one piece only where it has none of these, such as a line of Chinese. Pieces
that a worker does not remember go to the library in batches balanced by bytes; the lengths of
recent short pieces are kept in a memo that is bounded in bytes. Sentencepiece models get whole
texts in batches balanced by bytes, without splitting, as their pieces depend on what stands before.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows give repeated rows;
an empty table gives no rows; other columns of the input are not read, whatever their names are.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.llm.pieces import Cutter, PieceMemo, bytes_of, sized
from veraz.llm.shared import giving_back

#: Bytes of text that one call of the library gets.
BATCH_BYTES = 256 << 10


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to the executor's tasks
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def balanced(items: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """The items in order, in batches of at most ``limit`` bytes or of one item."""
    batch, size = [], 0
    for x in items:
        n = len(x) if x.isascii() else len(x.encode())
        if batch and size + n > limit:
            yield batch
            batch, size = [], 0
        batch.append(x)
        size += n
    if batch:
        yield batch


class PieceLengths:
    """Numbers of tokens of texts, for a ``tokenizers`` file with a byte-level pre-tokenizer."""

    def __init__(self, path: str, **bounds: int):
        self.tokenizer = tokenizer(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = PieceMemo(Cutter(spaced=True, single_digits=False, added=added), self._make, **bounds)

    def _make(self, pieces: list[bytes]) -> tuple[np.ndarray, None]:
        encoded = (e for batch in balanced([p.decode() for p in pieces]) for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False))
        return np.fromiter(map(len, encoded), np.int64, len(pieces)), None

    def count(self, texts: pa.Array) -> np.ndarray:
        return self.memo.turn(*bytes_of(texts))[0]


class PieceModelLengths:
    """Numbers of tokens of whole texts, for a ``sentencepiece`` model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, texts: pa.Array) -> np.ndarray:
        return np.array([n for batch in balanced(texts.to_pylist()) for n in map(len, self.model.encode(batch, num_threads=1))], np.int64)


@lru_cache(maxsize=4)
def counter(path: str):
    return PieceModelLengths(path) if path.endswith(".model") else PieceLengths(path)


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, make: Callable = counter) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes long, n_tokens long, over_limit boolean (n_tokens > limit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = make(path)
        for batch in sized(batches, 1):
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(lengths.count(batch.column(1)))], ["id", "n_bytes", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    counted = rows.mapInArrow(giving_back(run), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
