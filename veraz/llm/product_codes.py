"""Product quantisation of vectors in whole numbers, with a vantage-point tree for each part.

Components become floor(scale * x). Vectors are cut into equal parts; each part position has a
codebook that starts with the parts of the vectors of the smallest ids and is refined by rounds of
Lloyd's method with floored means. Assignments and sums run where the vectors lie; the driver gets
one row for each entry of each position (at most ``parts * entries``), whatever the table's size.

The nearest entry is found by branch and bound in a vantage-point tree over the entries. The metric
is the Euclidean distance, whose roots are rounded outwards to whole numbers: the lower end of a
subtree's ring down, its upper end up, and a query's distance both ways, so that a subtree's lower
bound is never too high. A subtree is left out only if the square of its bound exceeds the best
squared distance; one that could tie is visited, so the lower index can win. Squared distances
themselves are whole numbers of 64 bits and exact.

Defined results: rows whose vector is null or holds null or non-finite components go. Vectors of
another length than that of the smallest id, or of one that isn't a multiple of ``parts``, stay with a
null code and error. Rows of one id are told apart by their components where codebooks start, null
ids come last there; fewer vectors than entries make smaller codebooks. Repeated rows give repeated
rows, null labels are one label, an empty table gives no rows, other columns are not read. Components
so large that errors could leave 64 bits (beyond some 90,000 for eight dimensions a part) raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.llm.shared import giving_back, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Entries that a leaf of a tree compares one by one.
LEAF = 2
#: Vectors that are assigned at a time.
BLOCK = 1 << 14
#: Labels up to which their sums are broadcast (some 24 MB); more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
_FAR = np.iinfo(np.int64).max


def root_floor(x: np.ndarray) -> np.ndarray:
    """The whole part of the square root, exactly, up to 2^62."""
    r = np.sqrt(x.astype(np.float64)).astype(np.int64)
    r -= r * r > x
    return r + ((r + 1) * (r + 1) <= x)


def root_ceil(x: np.ndarray) -> np.ndarray:
    r = root_floor(x)
    return r + (r * r < x)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


@dataclass(frozen=True)
class Node:
    """A vantage point with its subtrees and the rings, rounded outwards, that their entries lie in; or a leaf."""

    entries: tuple[int, ...]
    children: tuple[tuple[int, int, Node], ...] = ()


def tree(codebook: np.ndarray, members: list[int] | None = None) -> Node | None:
    """The tree of a part's entries. The vantage point is the entry farthest from the first."""
    members = list(range(len(codebook))) if members is None else members
    if not members:
        return None
    if len(members) <= LEAF:
        return Node(tuple(members))
    point = members[int(np.argmax(squared(codebook[members], codebook[members[0]])))]
    rest = [m for m in members if m != point]
    far = squared(codebook[rest], codebook[point])
    order = np.argsort(far, kind="stable")
    children = []
    for part in (order[: len(order) // 2], order[len(order) // 2 :]):
        if len(part):
            ring = far[part]
            children.append((int(root_floor(ring.min())), int(root_ceil(ring.max())), tree(codebook, [rest[i] for i in part.tolist()])))
    return Node((point,), tuple(children))


def nearest(vectors: np.ndarray, codebook: np.ndarray, root: Node | None) -> tuple[np.ndarray, np.ndarray, int]:
    """The index and squared distance of the nearest entry, the lower index of several, and how many
    distances were computed."""
    best, index, computed = np.full(len(vectors), _FAR), np.full(len(vectors), len(codebook)), 0

    def visit(node: Node, rows: np.ndarray) -> None:
        nonlocal computed
        for e in node.entries:
            d = squared(vectors[rows], codebook[e])
            computed += len(rows)
            better = (d < best[rows]) | ((d == best[rows]) & (e < index[rows]))
            best[rows[better]], index[rows[better]] = d[better], e
        if not node.children:
            return
        low, high = root_floor(d), root_ceil(d)  # of the distances to the vantage point
        bounds = [np.maximum(np.maximum(low - hi, lo - high), 0) for lo, hi, _ in node.children]
        first = np.argmin(bounds, axis=0)
        for turn in range(len(node.children)):  # each query goes to its nearer subtree first
            for k, (_, _, child) in enumerate(node.children):
                going = ((first == k) == (turn == 0)) & (bounds[k] * bounds[k] <= best[rows])
                if going.any():
                    visit(child, rows[going])

    if root is not None and len(vectors):
        visit(root, np.arange(len(vectors)))
    return index, best, computed


def _components(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _assigned(ints: np.ndarray, codebooks: list[np.ndarray], trees: list[Node | None]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes by row and part, and the summed squared distance of each row."""
    size = ints.shape[1] // len(codebooks)
    codes, error = np.empty((len(ints), len(codebooks)), np.int64), np.zeros(len(ints), np.int64)
    for p, book in enumerate(codebooks):
        codes[:, p], d, _ = nearest(np.ascontiguousarray(ints[:, p * size : (p + 1) * size]), book, trees[p])
        error += d
    return codes, error


def whole(vectors: DataFrame, vector_col: str, scale: int = SCALE) -> DataFrame:
    """The usable rows with their vector as whole numbers (ints); those that could overflow raise."""
    v = F.col(vector_col)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    scaled = lambda x: F.floor(x.cast("double") * scale)
    return vectors.where(v.isNotNull() & F.coalesce(F.forall(v, finite), F.lit(False))).withColumn("ints", F.transform(v, scaled))


def _guarded(width: int, parts: int):
    """Raises on components whose squared distances could leave 64 bits when summed."""
    bound = int((2**62 / max(width, 1)) ** 0.5) // 2

    def check(ints: np.ndarray) -> np.ndarray:
        if ints.size and (ints.max() > bound or ints.min() < -bound):
            raise ValueError(f"a scaled component lies beyond {bound}: its errors may leave 64 bits")
        return ints

    return check


def _blocks(batches: Iterator[pa.RecordBatch], name: str, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(i, BLOCK)
            yield rows, _components(rows.column(rows.schema.get_field_index(name)), width)


def first_codebooks(usable: DataFrame, id_col: str, parts: int, entries: int) -> tuple[int, list[np.ndarray]]:
    """The vectors' length and the codebooks of the first vectors. A length that can't be cut gives empty ones."""
    order = [F.col(id_col).asc_nulls_last(), F.col("ints").asc()]
    first = usable.select(id_col, "ints").orderBy(*order).limit(1).collect()
    if not first or len(first[0].ints) % parts:
        return (len(first[0].ints) if first else 0), []
    width = len(first[0].ints)
    rows = usable.select(id_col, "ints").where(F.size("ints") == width).orderBy(*order).limit(entries).collect()
    start = np.array([r.ints for r in rows], np.int64).reshape(len(rows), width)
    return width, [np.ascontiguousarray(x) for x in np.split(start, parts, axis=1)] if width else [np.zeros((len(rows), 0), np.int64)] * parts


def refined(usable: DataFrame, width: int, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """One round of Lloyd's method; entries that no vector is nearest to stay as they are."""
    parts, size, trees, check = len(codebooks), width // len(codebooks), [tree(b) for b in codebooks], _guarded(width, len(codebooks))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(b.shape, np.int64) for b in codebooks]
        count = [np.zeros(len(b), np.int64) for b in codebooks]
        for _, ints in _blocks(batches, "ints", width):
            codes, _ = _assigned(check(ints), codebooks, trees)
            for p in range(parts):
                np.add.at(total[p], codes[:, p], ints[:, p * size : (p + 1) * size])
                count[p] += np.bincount(codes[:, p], minlength=len(count[p]))
        rows = [(p, e, int(count[p][e]), total[p][e].tolist()) for p in range(parts) for e in np.flatnonzero(count[p]).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["part", "entry", "n", "total"])

    partial = usable.select("ints").mapInArrow(giving_back(sums), "part int, entry int, n long, total array<long>")
    added = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("total")[i].cast("decimal(20,0)")).alias(f"t{i}") for i in range(size)))
    out = [b.copy() for b in codebooks]
    for r in added.collect():  # at most parts * entries rows
        out[r.part][r.entry] = [int(r[f"t{i}"]) // r.n for i in range(size)]
    return out


def fit(usable: DataFrame, id_col: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[int, list[np.ndarray]]:
    """The vectors' length and the final codebooks, from rows of ``whole``."""
    width, codebooks = first_codebooks(usable, id_col, parts, entries)
    own = usable.where(F.size("ints") == width)
    for _ in range(rounds if codebooks and width else 0):
        codebooks = refined(own, width, codebooks)
    return width, codebooks


def digest(codebooks: list[np.ndarray]) -> str:
    """The SHA-256 of all components by part, entry and place, in decimal, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in codebooks for x in b.ravel().tolist()).encode()).hexdigest()


def encode(usable: DataFrame, width: int, codebooks: list[np.ndarray]) -> DataFrame:
    """Adds code (two hex digits a part) and error to rows of ``whole``, whose vectors go."""
    trees, kept = [tree(b) for b in codebooks], [f for f in usable.schema if f.name not in ("ints", "code", "error")]
    names, check = [f.name for f in kept], _guarded(width, len(codebooks))
    own = usable.select(*names, "ints")
    fits = F.size("ints") == width if codebooks else F.lit(False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ints in _blocks(batches, "ints", width):
            codes, error = _assigned(check(ints), codebooks, trees)
            digits = codes.astype(np.uint8).tobytes().hex()
            step = 2 * len(codebooks)
            text = [digits[i : i + step] for i in range(0, len(digits), step)]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in names), pa.array(text, pa.string()), pa.array(error)], names=[*names, "code", "error"])

    others = own.where(~fits).drop("ints").withColumns({"code": F.lit(None).cast("string"), "error": F.lit(None).cast("long")})
    if not codebooks:
        return others
    return own.where(fits).mapInArrow(giving_back(run), others.schema).unionByName(others)


def with_label_error(coded: DataFrame, label_col: str) -> DataFrame:
    """Adds label_error: the errors of all rows of the same label, summed. Labels are summed first, so a
    frequent one is no large group anywhere; their sums are broadcast up to a counted bound."""
    sums = coded.groupBy(F.col(label_col).alias("_label")).agg(F.sum("error").alias("label_error"))
    sums = written(sums)
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col(label_col).eqNullSafe(F.col("_label"))).drop("_label")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Id, label, code, error, label_error and codebooks_sha256 of each usable vector. ``entries`` is 256 at most."""
    if not 1 <= entries <= 256 or parts < 1:
        raise ValueError("a code has two hex digits a part")
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("_vector"), F.col(label_col).alias("label"))
    usable = written(whole(named, "_vector", scale).drop("_vector"))
    width, codebooks = fit(usable, "vec_id", parts, entries, rounds)
    coded = written(encode(usable, width, codebooks))
    return with_label_error(coded, "label").withColumn("codebooks_sha256", F.lit(digest(codebooks)))
