"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from tests.conftest import TESTDATA
from veraz.llm import components, jaccard


def brute(rows, n=5, percent=80):
    """(id, text) -> {id: (set size, component)} by comparing all pairs that share a shingle."""
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df).collect()}


def test_documents(spark):
    df = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert got(df) == want and any(i != c for i, (_, c) in want.items())


@pytest.mark.parametrize(("seed", "block"), [(1, None), (2, 2), (3, 7)])
def test_chains_hubs_and_borders(spark, monkeypatch, seed, block):
    """Chains of small edits, groups of copies, shared passages, and pairs at just about the threshold."""
    if block:  # many blocks for one hub, and joins instead of broadcasts
        for name in ("HUB_BLOCK", "CROSS_BLOCK", "BROADCAST_ROWS", "HOT_ROWS"):
            monkeypatch.setattr(jaccard, name, block)
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
    texts = [None, "", " \t", "one two", "One\ttwo", "ONE two three", "a b c d e", "é b c d e", "É b c d e"]
    passage = [word() for _ in range(12)]
    for _ in range(12):
        base = [word() for _ in range(rng.randint(6, 60))]
        if rng.random() < 0.5:
            base[3:3] = passage
        for _ in range(rng.randint(1, 9)):
            texts.append(" ".join(base))
            if rng.random() < 0.8:
                base = list(base)
                base[rng.randrange(len(base))] = word()
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows] + [(0, texts[0], 1, "x")], "doc_id long, text string, n int, key string").repartition(3)
    assert got(df) == brute(rows)


def test_overlaps():
    row = np.array([2, 5, 9], np.uint64)
    assert jaccard.overlaps(row, [np.array(x, np.uint64) for x in ([], [2, 9], [1, 3], [9], [2, 5, 9, 11])]).tolist() == [0, 2, 0, 1, 3]
    assert jaccard.overlaps(row, []).tolist() == [] and jaccard.overlaps(row[:0], [row]).tolist() == [0]


@pytest.mark.parametrize("sizes", [(300, 310), (500, 620), (500, 700), (1000, 1100), (40_000, 45_000)])
def test_sketches_rule_out_no_link(sizes):
    """Sets at and around the threshold, of one width of sketch and of neighbouring ones."""
    rng = np.random.default_rng(sum(sizes))
    a, b = sizes
    shared = -(-80 * (a + b) // 180)
    pool = np.unique(rng.integers(0, 2**64, 2 * (a + b), dtype=np.uint64))
    rng.shuffle(pool)
    one = np.sort(pool[:a])
    for overlap in (min(shared, a), max(shared - 3, 0), a // 2, 0):
        other = np.sort(np.concatenate([one[:overlap], pool[a : a + b - overlap]]))
        links = 100 * overlap >= 80 * (a + b - overlap)
        x, y = (np.frombuffer(jaccard.parity(s), np.uint64) for s in (one, other))
        for p, q, n, m in ((x, y, a, b), (y, x, b, a)):
            assert jaccard.may_link(p, n, [q], np.array([m]), 80)[0] or not links
        if overlap <= a // 2:
            assert not jaccard.may_link(x, a, [y], np.array([b]), 80)[0]
    assert jaccard.folded(y[None], len(x) // 4).shape[1] == len(x) // 4


def test_cells_follow_the_input():
    assert [jaccard._cells(n) for n in (0, 1 << 30, 1 << 36, 1 << 37, 1 << 60)] == [1 << 20, 1 << 20, 1 << 22, 1 << 22, 1 << 22]
    h = np.array([0, 2**64 - 1, 2**63], np.uint64)
    assert jaccard._cell(h, 1 << 20).tolist() == [0, (1 << 20) - 1, 1 << 19]


def test_one_id_with_different_texts(spark):
    """The longest of them counts."""
    a, b = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("a", 40), ("b", 30)))
    df = spark.createDataFrame([(1, a), (1, b), (1, None), (2, a + " more"), (3, b), (4, "other words that link with nothing"), (None, a), (None, a)], "doc_id long, text string")
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(df).collect()]
    assert sorted(r for r in rows if r[0]) == [(1, 36, 1), (2, 37, 1), (3, 26, 3), (4, 2, 4)] and [r for r in rows if r[0] is None] == [(None, 36, None)] * 2


def test_null_and_other_ids(spark):
    """Every row without an id stays and links with nothing; ids that aren't whole numbers are refused."""
    texts = ["a b c d e f", "a b c d e f", "one two", None, ""]
    df = spark.createDataFrame([(None, t) for t in texts] + [(7, texts[0])], "doc_id long, text string")
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(df).collect()]
    assert sorted(rows, key=str) == sorted([(None, len(s), None) for s in ("xx", "xx", "x", "", "")] + [(7, 2, 7)], key=str)
    with pytest.raises(TypeError):
        jaccard.join(spark.createDataFrame([("x", "a")], "doc_id string, text string"))


def group_under_a_hub(n):
    """Document 0 holds a passage, a licence and its annex, n near copies hold the licence, a word of their
    own and the passage; twice as many others hold licence and annex, half of those are near copies in
    pairs. Licence and annex are more frequent than the passage, so document 0 heads its columns."""
    licence, passage, annex = ([f"{c}{i}" for i in range(k)] for c, k in (("l", 60), ("p", 40), ("m", 90)))
    texts = [passage + licence + annex] + [licence + [f"own{i}"] + passage for i in range(n)]
    texts += [licence + annex + [f"o{i // 2 if i < n else i}x{k}" for k in range(50)] + ["end", f"{i}"] for i in range(2 * n)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("n", "block"), [(60, None), (60, 16), (400, None)])
def test_near_copies_under_a_hub_that_is_not_linked_to_them(spark, monkeypatch, n, block):
    """Some pairs a document are multiplied, not all pairs of the group."""
    if block:
        monkeypatch.setattr(jaccard, "CROSS_BLOCK", block)
    rows, written, links = group_under_a_hub(n), [], jaccard._links

    def counted(pairs, *rest):
        written.append(pairs.count())
        return links(pairs, *rest)

    monkeypatch.setattr(jaccard, "_links", counted)
    out = got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    if n < 100:
        assert out == brute(rows)
    assert {out[i][1] for i in range(1, n + 1)} == {1} and out[0][1] == 0
    assert sum(written) <= (20 if block else 8) * len(rows) and sum(written) < n * (n - 1) // 2 or n < 100


def test_a_round_that_links_nothing_is_followed_by_a_wider_one(spark, monkeypatch):
    """Sketches that rule nothing out: the pairs held back are checked in the end."""
    monkeypatch.setattr(jaccard, "folded", lambda sketches, width: np.zeros((len(sketches), width), np.uint64))
    monkeypatch.setattr(jaccard, "parity", lambda s: bytes(128))
    monkeypatch.setattr(jaccard, "PICKS", 1)
    rng = random.Random(5)
    common = [f"c{i}" for i in range(12)]
    rows = [(0, " ".join(common + [f"z{i}" for i in range(3)]))]
    for i in range(1, 40):
        own = [f"{(i % 13)}w{k}" for k in range(6)] + [f"e{rng.randint(0, 9)}"]
        rows.append((i, " ".join(common + own)))
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_empty_table(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == {}


def test_components(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(99, 5), (99, 7), (3, 3)]
    out = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**dict.fromkeys(range(10, 41), 10), 99: 5, 5: 5, 7: 5}
