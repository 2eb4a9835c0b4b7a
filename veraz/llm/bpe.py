"""Byte-level BPE encoding and decoding.

Every pre-token is encoded with a priority queue of merge ranks over a doubly linked list of
symbols; queue entries whose symbols have changed since they were pushed are stale and skipped.
Decoding concatenates the byte strings of the vocabulary.

The vocabulary file is read from a path given as a parameter, once in every Python worker. Texts
are cut into pre-tokens for whole batches at once, and those that have been merged are remembered
in a memo that is bounded in bytes (see ``pieces``), so memory does not grow with the corpus.

Defined results: a null text is encoded as the empty text; an empty text gives no ids; null ids
decode to the empty text; repeated rows give repeated rows; an empty table gives no rows; other columns of the input are not read, whatever their names are.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.llm.pieces import Cutter, PieceMemo, bytes_of, joined, sized, spread
from veraz.llm.shared import giving_back

# The published pre-token pattern of byte-level BPE, with white space spelled out.
SPACE = r"\t-\r\x20\x85\xa0  -     　"
PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others for 256, 257, ... in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class BpeCodec:
    """Encoder and decoder for one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        to_byte = {c: b for b, c in enumerate(symbols)}
        vocab = spec["model"]["vocab"]
        self.byte_ids = [vocab[c] for c in symbols]
        # A pair of ids -> (rank, id of the merged symbol).
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        strings = [b""] * size
        for token, i in {**vocab, **self.added}.items():
            strings[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.pattern = regex.compile(PRETOKEN)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self.odd = re.compile(b"|".join(map(re.escape, [b"'", *(t.encode()[:2] for t in self.added)])))
        # The strings one after the other, and the place and length of each.
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.length = np.array([len(x) for x in strings])
        self.place = np.cumsum(self.length) - self.length
        self.memo = PieceMemo(Cutter(spaced=True, single_digits=False, added=list(self.added)), self._make)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        ids = [self.byte_ids[b] for b in word]
        n, merges = len(ids), self.merges
        if n < 2:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two symbols has been merged meanwhile
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((merged, ids[k])):
                    heapq.heappush(heap, (found[0], i, merged, ids[k], found[1]))
            h = before[i]
            if h >= 0 and (found := merges.get((ids[h], merged))):
                heapq.heappush(heap, (found[0], h, ids[h], merged, found[1]))
        return [i for i in ids if i >= 0]

    def _make(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self._encode_piece(p) for p in pieces]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return counts, np.fromiter(chain.from_iterable(ids), np.uint32, int(counts.sum()))

    def _encode_piece(self, piece: bytes) -> list[int]:
        """Strings of added tokens inside a piece become those tokens."""
        if piece.isascii() and not self.odd.search(piece):
            return self.merge(piece)  # cut where a pre-token begins and ends
        parts = self.special.split(piece.decode()) if self.special else [piece.decode()]
        return [i for k, part in enumerate(parts) for i in ([self.added[part]] if k % 2 else [i for word in self.pattern.findall(part) for i in self.merge(word.encode())])]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and all ids in order."""
        return self.memo.turn(data, offsets)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many bytes each id stands for, and all bytes in order."""
        length = self.length[ids]
        return length, self.bytes[spread(self.place[ids], length)]


@lru_cache(maxsize=4)
def codec(path: str) -> BpeCodec:
    return BpeCodec(path)


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_tokens long, ids binary (little-endian uint32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in sized(batches, 1):
            counts, ids = bpe.encode(*bytes_of(batch.column(1)))
            yield pa.record_batch([batch.column(0), pa.array(counts), joined(ids, 4 * counts, pa.binary())], ["id", "n_tokens", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(giving_back(run), f"id {kind}, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: ``id_col``, n_tokens long, ids binary, text string. Null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in sized(batches, 1):
            data, offsets = bytes_of(batch.column(1))
            sizes, text = bpe.decode(data.view("<u4"))
            places = np.concatenate([[0], np.cumsum(sizes)])[offsets // 4]
            texts = joined(text, np.diff(places), pa.string())
            try:
                texts.validate(full=True)
            except pa.ArrowInvalid:  # ids that don't spell UTF-8
                texts = pa.array([x.decode("utf-8", "replace") for x in joined(text, np.diff(places), pa.binary()).to_pylist()], pa.string())
            yield pa.record_batch([batch.column(0), pa.array(np.diff(offsets) // 4), batch.column(1), texts], ["id", "n_tokens", "ids", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))
    return rows.mapInArrow(giving_back(run), f"id {kind}, n_tokens long, ids binary, text string").withColumnRenamed("id", id_col)
