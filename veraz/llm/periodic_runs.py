"""Periodic runs of words: stretches that repeat with a smallest period, by the method of Kolpakov
and Kucherov.

A suffix automaton gives the LZ factors of a sequence, Main's algorithm the runs that touch a border
between factors, and the runs strictly inside a factor are those of its earlier occurrence. Only
runs of at least ``min_length`` words and ``min_periods`` periods are looked for, which bounds the
windows of Main's algorithm and lets short factors be passed over.

The sequences that it works on are stretches of a text. In a run of length L and period q, with
L >= 2q + k - 1, each k-gram occurs twice (q words on or back), so all its words lie in k-grams that
occur twice in the text; ``narrow`` gives the largest such k, and the stretches of such words hold
every run whole. k-grams are found by hashes: a collision can only lengthen a stretch.

One text is handled by one task, in memory proportional to its length (some 60 bytes a word, and
600 a word of its longest stretch); many short ones are handled a megabyte at a time.

Defined results: null and empty texts have no words, no runs and an empty collapsed text; repeated
rows give repeated rows; an empty table gives no rows; other columns of the input stay, and those
named as a result are replaced.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from veraz.llm.shared import giving_back
from veraz.llm.words import chunks, mix, ngrams

MIN_LENGTH, MIN_PERIODS = 24, 3
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_ARROW_RUN = pa.struct([pa.field(c, pa.int64()) for c in ("start", "length", "period")])


def lz_factors(w: list[int]) -> list[tuple[int, int, int]]:
    """(begin, length, earlier begin) of each factor: the longest prefix of what is left that begins
    earlier too, overlapping or not, or one new symbol (earlier begin -1)."""
    following, link, longest, first_end = [{}], [-1], [0], [-1]
    last = 0
    for i, c in enumerate(w):
        new = len(following)
        following.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        first_end.append(i)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if longest[q] != longest[p] + 1:
                copy = len(following)
                following.append(dict(following[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                first_end.append(first_end[q])
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = copy
                    p = link[p]
                link[q] = copy
                q = copy
            link[new] = q
        last = new
    factors, i, n = [], 0, len(w)
    while i < n:
        state, at = 0, i
        while at < n:
            step = following[state][w[at]]
            if first_end[step] >= at:  # what ends here is its first occurrence
                break
            state, at = step, at + 1
        factors.append((i, at - i, first_end[state] - (at - i) + 1) if at > i else (i, 1, -1))
        i = max(at, i + 1)
    return factors


def _prefixes(s: list) -> list[int]:
    """At each place the length of the longest common prefix with the whole."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def runs(w: list[int], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``min_length`` symbols and ``min_periods`` (two
    or more) periods, by start and period."""
    n = len(w)
    period: dict[tuple[int, int], int] = {}
    ends: dict[int, list[int]] = {}
    starts: list[int] = []

    def add(s: int, t: int, q: int) -> None:
        if (s, t) not in period:
            period[s, t] = q
            if s not in ends:
                ends[s] = []
                insort(starts, s)
            ends[s].append(t)

    before = 0  # where the factor before begins
    for b, length, source in [*lz_factors(w), (n, 0, -1)]:
        end = b + length
        # A run [s, t) with s <= b <= t <= end has s > before - period (else the factor before would be
        # longer), so min_periods * period <= t - s < end - before + period.
        widest = (end - before - 1) // (min_periods - 1)
        if b and end - before + widest > min_length:
            low = max(0, before - widest)
            left, right = w[low:b], w[b:end]
            nl, nr = len(left), len(right)
            right_on = _prefixes(right)  # right with itself, q on
            left_on = _prefixes([*right, None, *left, *right])  # right with what begins q before it
            back = left[::-1]
            left_back = _prefixes(back)  # left with itself, q back
            right_back = _prefixes([*back, None, *right[::-1], *back])  # left with what ends q after it
            for q in range(1, widest + 1):
                least = max(min_length, min_periods * q)
                found = []
                if q <= nr:  # q symbols at least lie behind the border
                    found.append((b - right_back[nl + 1 + nr - q], b + q + (right_on[q] if q < nr else 0)))
                if q <= nl:  # or before it
                    found.append((b - q - (left_back[q] if q < nl else 0), b + left_on[nr + 1 + nl - q]))
                for s, t in found:
                    if t - s >= least and (s == 0 or w[s - 1] != w[s - 1 + q]) and (t == n or w[t] != w[t - q]):
                        add(s, t, q)
        if source >= 0:
            shift = b - source
            i = bisect_right(starts, source)
            while i < len(starts) and starts[i] + shift < end:  # copies land further on in the list
                s = starts[i]
                for t in ends[s]:
                    if t + shift < end:
                        add(s + shift, t + shift, period[s, t])
                i += 1
        before = b
    return sorted((s, t - s, q) for (s, t), q in period.items())


def narrow(min_length: int, min_periods: int) -> int:
    """The largest k for which each k-gram of a run occurs twice."""
    return 1 + max(0, min(max(min_length, min_periods * q) - 2 * q for q in range(1, min_length + 1)))


def stretches(ids: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(text, begin, end) of maximal stretches of words in k-grams that occur twice in their text."""
    grams, begins = ngrams(mix(ids.astype(np.uint64) + np.uint64(1)), offsets, k, short=False)
    counts = np.diff(begins)
    text = np.repeat(np.arange(len(counts)), counts)
    with np.errstate(over="ignore"):
        keys = mix(grams + mix(text.astype(np.uint64))) if len(grams) else grams
    order = np.argsort(keys)
    twice = np.zeros(len(keys), bool)
    same = keys[order[1:]] == keys[order[:-1]]
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    if not len(at):
        return
    first = offsets[text[at]] + at - begins[text[at]]  # the grams' first words
    inside = np.zeros(len(ids) + 1, np.int64)
    np.add.at(inside, first, 1)
    np.add.at(inside, first + k, -1)
    covered = np.cumsum(inside)[:-1] > 0
    for i in np.unique(text[at]).tolist():
        edges = np.flatnonzero(np.diff(np.concatenate([[False], covered[offsets[i] : offsets[i + 1]], [False]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            yield i, a, b


def runs_of(texts: list[bytes], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """The runs and the words of each text."""
    words = [t.split() for t in texts]  # bytes are split at the six white space characters of ASCII only
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(x, len(known)) for one in words for x in one), np.int64, sum(map(len, words)))
    offsets = np.cumsum([0, *map(len, words)])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for i, a, b in stretches(ids, offsets, narrow(min_length, min_periods)):
        if b - a >= min_length:
            found[i] += ((a + s, n, q) for s, n, q in runs(ids[offsets[i] + a : offsets[i] + b].tolist(), min_length, min_periods))
    return list(zip(found, words, strict=True))


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words, but those of a run behind its first period, joined by one space."""
    if found:
        dropped = np.zeros(len(words), bool)
        for s, n, q in found:
            dropped[s + q : s + n] = True
        words = [words[i] for i in np.flatnonzero(~dropped).tolist()]
    return b" ".join(words)


def find_runs(docs: DataFrame, text_col: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Adds n_words, runs (by start and period) and the collapsed text of each row."""
    if min_periods < 2 or min_length < 1:
        raise ValueError("a run has two periods at least")
    added = ["n_words", "runs", "collapsed"]
    kept = [f for f in docs.schema if f.name not in added]
    place = [f.name for f in docs.schema].index(text_col)
    where = [i for i, f in enumerate(docs.schema) if f.name not in added]
    names = [f.name for f in kept] + added

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b"" if t is None else t for t in batch.column(place).cast(pa.binary()).to_pylist()]
            for a, b in chunks(texts):
                out = runs_of(texts[a:b], min_length, min_periods)
                rows = batch.slice(a, b - a)
                new = [
                    pa.array([len(w) for _, w in out], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in f] for f, _ in out], pa.list_(_ARROW_RUN)),
                    pa.array([collapsed(w, f) for f, w in out], pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in where), *new], names=names)

    schema = T.StructType([*kept, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return docs.mapInArrow(giving_back(run), schema)
