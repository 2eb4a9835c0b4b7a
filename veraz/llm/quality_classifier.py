"""A quality classifier: logistic regression on hashed word n-grams.

Features are word n-grams (of one and two words), n-grams of word shapes (of one to three words: a
word's looks, and whether the word has been seen in the text), hashed to a fixed number of
coordinates, counted and scaled to unit length by kind. Weights come from follow-the-regularised-
leader updates with a learning rate for every coordinate; a score is the logistic function of a
sparse dot product.

The model is fitted on at most ``max_rows`` labelled rows, those whose ids hash lowest, in one task
that holds their features and not their texts; that bound is the only one. Scores are computed for all rows, whole texts, without a shuffle.

Defined results: null and empty texts get the score of the bias alone; repeated rows give repeated
rows; an empty table gives no rows; labels, languages, sources and ids are never features; without
labelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veraz.llm.pieces import sized
from veraz.llm.shared import giving_back
from veraz.llm.words import CHUNK_BYTES, chunks, mix, ngrams, shape_hashes, word_hashes

BITS = 18
#: Most labelled rows that a model is fitted on.
MAX_ROWS = 8192


@dataclass(frozen=True)
class Ftrl:
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.1
    l2: float = 0.1
    epochs: int = 2


def _seen_before(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each word, whether it has occurred earlier in its text."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((np.arange(len(h)), h, text))
    again = np.zeros(len(h), bool)
    if len(h) > 1:
        a, b = order[:-1], order[1:]
        again[b] = (h[a] == h[b]) & (text[a] == text[b])
    return again


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coordinates and values of all texts, and where each text's begin. Coordinate 0 is the bias."""
    parts = []
    for a, b in chunks(texts):
        h, offsets = word_hashes(texts[a:b], fold=True)
        with np.errstate(over="ignore"):
            shapes = mix(shape_hashes(texts[a:b]) + _seen_before(h, offsets).astype(np.uint64) * np.uint64(0x5BD1E995))
        kinds = []
        for tag, (base, n) in enumerate(((h, 1), (h, 2), (shapes, 1), (shapes, 2), (shapes, 3)), 1):
            g, o = ngrams(base, offsets, n, short=False)
            with np.errstate(over="ignore"):
                ids = 1 + (mix(g + np.uint64(tag * 0x1000193)) >> np.uint64(64 - bits)).astype(np.int64) % ((1 << bits) - 1)
            kinds.append((ids, np.repeat(np.arange(b - a), np.diff(o))))
        rows, coordinates, values = [np.arange(b - a)], [np.zeros(b - a, np.int64)], [np.ones(b - a)]
        for ids, row in kinds:
            key, count = np.unique(row << bits | ids, return_counts=True)
            row = key >> bits
            norm = np.sqrt(np.bincount(row, (count.astype(np.float64)) ** 2, minlength=b - a))
            rows.append(row)
            coordinates.append(key & ((1 << bits) - 1))
            values.append(count / norm[row])
        rows = np.concatenate(rows)
        order = np.argsort(rows, kind="stable")
        parts.append((np.concatenate(coordinates)[order], np.concatenate(values)[order], np.bincount(rows, minlength=b - a)))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([[0], np.cumsum(np.concatenate([p[2] for p in parts]))])


def fit(examples: Iterable[tuple[np.ndarray, np.ndarray]], labels: Sequence[int], how: Ftrl = Ftrl(), bits: int = BITS) -> np.ndarray:
    """Weights after the updates for every example (coordinates, values) in turn, several times over."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    held = list(zip(examples, labels, strict=True))

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= how.l1, 0.0, (np.sign(zi) * how.l1 - zi) / ((how.beta + np.sqrt(n[i])) / how.alpha + how.l2))

    for _ in range(how.epochs):
        for (i, x), y in held:
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            more = n[i] + g * g
            z[i] += g - (np.sqrt(more) - np.sqrt(n[i])) / how.alpha * w
            n[i] = more
    return weights(np.arange(1 << bits))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", usable: Column | None = None, max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights fitted on at most ``max_rows`` labelled rows for which ``usable`` holds."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.where(usable) if usable is not None else known
    chosen = known.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id", "label").limit(max_rows)
    texts = df.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts become coordinates as they come; what is held is bounded by the coordinates of the rows."""
        held = []
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                ids, values, offsets = features(part.column(2).to_pylist())
                ids, values = ids.astype(np.int32), values.astype(np.float32)
                bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                held += [(h, y, ids[a:b].copy(), values[a:b].copy()) for h, y, (a, b) in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), bounds, strict=True)]
        held.sort(key=lambda r: (r[0], r[1], len(r[2]), r[2].tobytes()))
        w = fit([(i, x) for _, _, i, x in held], [y for _, y, _, _ in held]).astype("<f4")
        yield pa.record_batch([pa.array([w.tobytes()], pa.binary())], ["weights"])

    found = rows.select(F.xxhash64("id").alias("h"), "label", "text").repartition(1).mapInArrow(giving_back(run), "weights binary").collect()
    return np.frombuffer(found[0][0], "<f4") if found else np.zeros(1 << BITS, np.float32)


def _dots(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """The logistic function of each text's sparse dot product with the weights."""
    ids, values, offsets = features(texts)
    return 1 / (1 + np.exp(-np.clip(np.add.reduceat(weights[ids] * values, offsets[:-1]), -35, 35)))


def scored(df: DataFrame, weights: np.ndarray, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of the input and ``score_col`` double (0 to 1), which replaces one of that name. Rows
    stay where they are: nothing is joined or shuffled."""
    shared = df.sparkSession.sparkContext.broadcast(weights)  # a fixed size: 4 bytes a coordinate
    own = [c for c in df.columns if c.lower() != score_col.lower()]
    rows, place = df.select(*(F.col(f"`{c}`") for c in own)), own.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for part in sized(batches, place, CHUNK_BYTES):
            texts = [b"" if t is None else t for t in part.column(place).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(_dots(texts, w), pa.float64())], names=[*own, score_col])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in own)
    return rows.mapInArrow(giving_back(run), f"{fields}, `{score_col}` double")


def score(df: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, score double (0 to 1)."""
    return scored(df.select(id_col, text_col), weights, text_col).select(id_col, "score")


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % folds == 0, F.lit(False))
