"""Best-fit packing of token sequences: bounded-space online best-fit.

A packer keeps a fixed number of open bins, keyed by free space in a bitset: bit f is set while a
bin with f free tokens is open. A piece goes where it leaves the least space, found by shifting
the bitset and taking its lowest bit. When a new bin is needed and all places are taken, the
fullest open bin closes first.

Each partition of the input packs its own rows in their order, so a lost task packs the same rows
into the same sequences again and no row moves: there is no shuffle. At the end of a partition at
most ``open_bins`` sequences are not full, whatever the size of the partition. Partitions of a small
table are put together first, so that each packs some ``LEAST_BYTES`` of text and few are left open.

Defined results: a null or empty text is a piece of one token (the end mark); a document longer
than a sequence is cut into full pieces and a rest; repeated rows are packed each; an empty table
gives no rows; other columns of the input are not read, whatever their names are.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.llm.pieces import Cutter, PieceMemo, bytes_of, joined, sized, spread
from veraz.llm.shared import giving_back
from veraz.llm.token_counts import balanced, tokenizer

MAX_TOKENS = 4096
OPEN_BINS = 1024
#: Bytes of text that a partition packs at least, on average.
LEAST_BYTES = 8 << 20
# Fixed value: what the last token of a word ends with in the vocabulary.
WORD_END = "</w>"


class Packer:
    """Online best-fit with at most ``open_bins`` open bins of ``size`` tokens."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.free, self.count, self.made = 0, 0, 0
        self.bins: dict[int, list[int]] = defaultdict(list)  # by free space: numbers of open bins

    def place(self, length: int) -> tuple[int, int]:
        """The number of the bin and the offset in it for a piece of this length."""
        if not 0 < length <= self.size:
            raise ValueError(f"a piece has 1 to {self.size} tokens, not {length}")
        if fits := self.free >> length:
            space = length + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.count == self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            space, number = self.size, self.made
            self.made += 1
        if space > length:
            self.bins[space - length].append(number)
            self.free |= 1 << (space - length)
            self.count += 1
        return number, self.size - space

    def _take(self, space: int) -> int:
        number = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.count -= 1
        return number


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceMemo:
    """Ids by a ``tokenizers`` file that drops white space and takes every digit by itself."""
    t = tokenizer(path)
    added = [x.content for x in t.get_added_tokens_decoder().values()]
    vocabulary = t.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
    odd = re.compile("|".join(map(re.escape, ["'", *(x[:2] for x in added)])))

    def each(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for batch in balanced(pieces) for e in t.encode_batch_fast(batch, add_special_tokens=False)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return counts, np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum()))

    def make(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces that are one word go to the library in one text; its words tell them apart."""
        texts = [p.decode() for p in pieces]
        plain = [x for x in texts if x.isascii() and not odd.search(x)]
        ids = np.array([i for batch in balanced(plain) for i in t.encode(" ".join(batch), add_special_tokens=False).ids], np.uint32)
        last = np.flatnonzero(ends[ids])
        if len(last) != len(plain):  # not a file that ends every word with a mark
            return each(texts)
        if len(plain) == len(texts):
            return np.diff(last, prepend=-1), ids
        other = np.array([not x.isascii() or bool(odd.search(x)) for x in texts])
        other_counts, other_ids = each([x for x, y in zip(texts, other.tolist(), strict=True) if y])
        counts = np.empty(len(texts), np.int64)
        counts[~other], counts[other] = np.diff(last, prepend=-1), other_counts
        out = np.empty(len(ids) + len(other_ids), np.uint32)
        of_other = np.repeat(other, counts)
        out[~of_other], out[of_other] = ids, other_ids
        return counts, out

    return PieceMemo(Cutter(spaced=False, single_digits=True, added=added), make)


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, end_id: int = 1, open_bins: int = OPEN_BINS) -> DataFrame:
    """One row per piece: ``id_col``, piece int, start long, length long, ids binary (little-endian
    uint32), sequence_id long, offset long. Sequence numbers are unique, not consecutive."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, packer, first = encoder(path), Packer(max_tokens, open_bins), TaskContext.get().partitionId() << 40
        for batch in sized(batches, 1):
            counts, ids = memo.turn(*bytes_of(batch.column(1)))
            ids, counts = np.insert(ids, np.cumsum(counts), end_id), counts + 1
            pieces = -(-counts // max_tokens)
            row, piece = np.repeat(np.arange(len(counts)), pieces), spread(np.zeros(len(counts), np.int64), pieces)
            length = np.minimum(counts[row] - piece * max_tokens, max_tokens)
            placed = np.array([packer.place(n) for n in length.tolist()], np.int64).reshape(-1, 2)
            columns = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(piece * max_tokens), pa.array(length), joined(ids, 4 * length, pa.binary()), pa.array(first + placed[:, 0]), pa.array(placed[:, 1])]
            yield pa.record_batch(columns, ["id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    kind = df.schema[id_col].dataType.simpleString()
    rows_in = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows_in.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows_in = rows_in.coalesce(max(1, -(-size // LEAST_BYTES)))  # more than there are: no change
    packed = rows_in.mapInArrow(giving_back(run), f"id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long")
    return packed.withColumnRenamed("id", id_col)
