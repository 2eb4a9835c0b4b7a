"""Codes against plain whole-number arithmetic; the tree against all distances."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import TESTDATA
from veraz.llm import product_codes, queries


def brute(rows, parts=8, entries=16, rounds=6):
    """{row's place: (code, error, label error, digest)} with Python's own integers."""
    kept = {i: [math.floor(4096 * x) for x in v] for i, (_, v, _) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    size = len(next(iter(kept.values()))) // parts
    cut = {i: [tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for i, v in kept.items()}
    books = [[cut[i][p] for i in sorted(cut, key=lambda i: (rows[i][0], kept[i]))[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p, v: min((far(v, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        groups = defaultdict(list)
        for v in cut.values():
            for p in range(parts):
                groups[p, near(p, v[p])[1]].append(v[p])
        for (p, k), members in groups.items():
            books[p][k] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    found = {i: [near(p, v[p]) for p in range(parts)] for i, v in cut.items()}
    errors = {i: sum(d for d, _ in f) for i, f in found.items()}
    of_label = defaultdict(int)
    for i, e in errors.items():
        of_label[rows[i][2]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: ("".join(f"{k:02x}" for _, k in f), errors[i], of_label[rows[i][2]], digest) for i, f in found.items()}


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 24), st.integers(1, 4), st.sampled_from([1, 3, 50, 1 << 27]), st.integers(0, 10**6))
def test_the_tree_finds_the_nearest_with_the_lowest_index(entries, width, reach, seed):
    rnd = np.random.default_rng(seed)
    book = rnd.integers(-reach, reach + 1, (entries, width))
    vectors = np.concatenate([rnd.integers(-reach, reach + 1, (40, width)), book])
    index, best, computed = product_codes.nearest(vectors, book, product_codes.tree(book))
    assert computed <= len(vectors) * entries
    for v, i, d in zip(vectors, index, best, strict=True):
        every = [int(((v - e) ** 2).sum()) for e in book]
        if every:
            assert (d, i) == (min(every), every.index(min(every)))


def test_the_tree_leaves_subtrees_out():
    book = np.array([[1000 * i, 7 * i] for i in range(64)])
    vectors = np.repeat(book, 20, axis=0) + 3
    _, _, computed = product_codes.nearest(vectors, book, product_codes.tree(book))
    assert computed < len(vectors) * len(book) / 3


def test_roots_are_exact_at_squares():
    roots = np.array([0, 1, 2, 3, (1 << 31) - 2, (1 << 31) - 1, 94_906_267])
    for off in (-1, 0, 1):
        x = np.maximum(roots * roots + off, 0)
        assert product_codes.root_floor(x).tolist() == [math.isqrt(v) for v in x.tolist()]
        assert product_codes.root_ceil(x).tolist() == [math.isqrt(v) + (math.isqrt(v) ** 2 < v) for v in x.tolist()]


def test_odd_rows(spark):
    rnd = np.random.default_rng(5)
    rows = [(int(i % 29), [float(np.float32(x)) for x in rnd.normal(0, 2, 8).round(1)], [None, 1, 2][i % 3]) for i in range(60)]
    rows += [rows[7]] * 3 + [(70, None, 1), (0, [None] + [0.0] * 7, 1), (0, [float("nan")] + [0.0] * 7, 1), (0, [float("-inf")] + [0.0] * 7, 2)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, error string").repartition(5)
    got = product_codes.compress(table, parts=4, entries=5, rounds=3)
    want = brute(rows, 4, 5, 3)
    assert sorted(map(str, ((rows[i][0], rows[i][2], *v) for i, v in want.items()))) == sorted(map(str, map(tuple, got.collect())))
    assert got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    assert product_codes.compress(table.limit(0)).count() == 0


def test_other_lengths_and_few_vectors(spark):
    kind = "vec_id long, embedding array<float>, label int"
    rows = [(2, [1.0, 2.0], 1), (1, [0.5, -0.5], 1), (3, [1.0], 1), (None, [9.0, 9.0], None), (4, [], 2)]
    got = {r.vec_id: r for r in product_codes.compress(spark.createDataFrame(rows, kind), parts=2, rounds=0).collect()}
    assert {k: r.code for k, r in got.items()} == {1: "0000", 2: "0101", None: "0202", 3: None, 4: None} and got[3].error is None and got[1].label_error == 0
    assert {r.code for r in product_codes.compress(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], kind), parts=2).collect()} == {None}
    with pytest.raises(Exception, match="64 bits"):
        product_codes.compress(spark.createDataFrame([(1, [1e30, 0.0], 1)], kind), parts=2).collect()


def test_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{TESTDATA}/embeddings.parquet").collect()]
    got = {r.vec_id: tuple(r)[1:] for r in queries.op12_vector_codes(spark, TESTDATA).collect()}
    assert got == {rows[i][0]: v for i, v in brute(rows).items()}
