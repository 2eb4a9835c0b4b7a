"""Periodic runs against brute force, on words and in the query."""

import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import TESTDATA
from veraz.llm import periodic_runs, queries


def brute(w, min_length=24, min_periods=3):
    """For each period the maximal stretches that keep it; the smallest period of each stretch counts."""
    found = {}
    for q in range(1, len(w) // min_periods + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(min_length, min_periods * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, t - s, q) for (s, t), q in found.items())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.lists(st.tuples(st.integers(0, 60), st.integers(1, 15), st.integers(1, 60)), max_size=4), st.sampled_from([1, 2, 5, 8, 24]), st.integers(2, 4))
def test_runs(w, repeats, min_length, min_periods):
    for a, p, n in repeats:  # periodic stretches among other words
        for i in range(a + p, min(a + n, len(w))):
            w[i] = w[i - p]
    want = brute(w, min_length, min_periods)
    assert periodic_runs.runs(w, min_length, min_periods) == want
    text = " \n".join(f"w{x}" for x in w).encode()
    assert [r for r, _ in periodic_runs.runs_of([b"w1 " * 3, text, b"", text], min_length, min_periods)][1:] == [want, [], want]


def test_factors_are_the_longest_that_begin_earlier():
    rnd = random.Random(3)
    for _ in range(200):
        w = [rnd.randrange(2) for _ in range(rnd.randrange(40))]
        at = 0
        for i, n, source in periodic_runs.lz_factors(w):
            assert i == at
            longest = max((k for b in range(i) for k in range(len(w) - i + 1) if w[b : b + k] == w[i : i + k]), default=0)
            assert n == max(longest, 1) and (source < 0 if longest == 0 else source < i and w[source : source + n] == w[i : i + n])
            at += n
        assert at == len(w)


def test_narrow_keeps_every_run():
    assert periodic_runs.narrow(24, 3) == 9 and periodic_runs.narrow(24, 2) == 1
    w = list(range(100, 108)) * 3  # the hardest: three periods of eight
    assert list(periodic_runs.stretches(periodic_runs.np.array(w), periodic_runs.np.array([0, 24]), 9)) == [(0, 0, 24)]


def test_odd_rows(spark):
    long = " ".join(f"x{i % 4000}" for i in range(30_000))
    rows = [(1, None, "a"), (1, "", "b"), (None, " \t\n", "c"), (2, "é\u00a0è " * 24, None), (2, "é\u00a0è " * 24, None), (3, long, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumnRenamed("runs", "collapsed")
    got = periodic_runs.find_runs(docs.withColumnRenamed("collapsed", "n_words"))
    assert got.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    seen = sorted((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed[:20]) for r in got.collect())
    same = (2, 24, [(0, 24, 1)], "é\u00a0è")
    assert seen == [(0, 0, [], ""), (1, 0, [], ""), (1, 0, [], ""), same, same, (3, 30_000, [(0, 30_000, 4000)], long[:20])]
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
    shorter = periodic_runs.find_runs(spark.createDataFrame([("a b a b c",)], "text string"), min_length=4, min_periods=2).first()
    assert [tuple(r) for r in shorter.runs] == [(0, 4, 2)] and shorter.collapsed == "a b c"


def test_query(spark):
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{TESTDATA}/documents.parquet").collect()}
    rows = queries.op13_periodic_runs(spark, TESTDATA).collect()
    assert {r.doc_id for r in rows} == set(source) and len(rows) == len(source)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", source[r.doc_id] or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute(w)
        best = None
        for x in found:
            if best is None or x[1] * best[2] > best[1] * x[2]:
                best = x
        dropped = {i for s, n, q in found for i in range(s + q, s + n)}
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        assert tuple(r) == (r.doc_id, len(found), *first, sha(listed), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))
