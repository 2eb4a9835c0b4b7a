"""Cutting, hashing and remembering pieces, against the libraries on whole texts."""

import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from veraz.llm import bpe, packing, pieces, token_counts

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ALPHABET = st.sampled_from([*" \n\t\r'sa7é×ŻAß漢<|>1२\x1f\x85.\u00a0\u1680\u2003\u2028\u202f\u205f\u3000\u0301\u2019\u200b\x00", "<|endoftext|>", "'ll", "  ", "word", "\n\n"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=30).map("".join), max_size=6)


def want(path, texts):
    return [token_counts.tokenizer(path).encode(t, add_special_tokens=False).ids for t in texts]


def split(counts, ids):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if len(counts) else []


@pytest.fixture(params=[1 << 20, 7], ids=["whole", "small windows"])
def small(request):
    """Memos with windows of one size, and with bounds that they pass again and again."""
    made = [(packing.encoder(WORD), WORD), (bpe.codec(BYTE).memo, BYTE), (token_counts.counter(BYTE).memo, BYTE)]
    bounds = (1 << 19, 4 << 20) if request.param > 7 else (3, 9)
    before = [(m.window, m.max_entries, m.max_values) for m, _ in made]
    for m, _ in made:
        m.window, (m.max_entries, m.max_values) = request.param, bounds
    yield made
    for (m, _), old in zip(made, before, strict=True):
        m.window, m.max_entries, m.max_values = old


@settings(max_examples=400, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TEXTS)
def test_any_texts(small, texts):
    data, offsets = pieces.bytes_of(pa.array(texts, pa.string()))
    for memo, path in small:
        counts, ids = memo.turn(data, offsets)
        expected = want(path, texts)
        assert counts.tolist() == [len(x) for x in expected]
        if len(ids) or not sum(counts):
            assert split(counts, ids) == expected
        assert memo.used <= memo.max_entries or not len(data)


def test_slices():
    texts = ["a" * 5, "", "b" * 50, "c", "", "d" * 3]
    batch = pa.record_batch([pa.array(texts)], ["t"]).slice(1)
    got = [x.column(0).to_pylist() for x in pieces.sized(iter([batch]), 0, limit=10)]
    assert got == [[""], ["b" * 50], ["c", "", "d" * 3]]
    data, offsets = pieces.bytes_of(batch.column(0).cast(pa.large_binary()))
    assert data.tobytes() == "".join(texts[1:]).encode() and offsets.tolist() == [0, 0, 50, 51, 51, 54]
    assert list(pieces.sized(iter([batch.slice(0, 0)]), 0)) == []


def test_long_texts_without_spaces():
    """Texts of one character class, in other scripts and without any white space stay exact and are not remembered."""
    texts = ["x" * 200_000, "漢字かな" * 20_000, "ab1." * 50_000, "слово" * 10_000 + " конец", "a\u00a0" * 30_000, "z\t" * 50_000]
    data, offsets = pieces.bytes_of(pa.array(texts))
    memo = token_counts.counter(BYTE).memo
    began = time.perf_counter()
    assert memo.turn(data, offsets)[0].tolist() == [len(x) for x in want(BYTE, texts)]
    counts, ids = packing.encoder(WORD).turn(data, offsets)
    assert split(counts, ids) == want(WORD, texts)
    assert time.perf_counter() - began < 60
    counts, ids = bpe.codec(BYTE).encode(*pieces.bytes_of(pa.array([t[:20_000] for t in texts])))
    assert split(counts, ids) == want(BYTE, [t[:20_000] for t in texts])


def test_memory_is_bounded_in_bytes():
    """Thousands of distinct long texts leave nothing behind; short ones no more than the bounds."""
    memo = token_counts.PieceLengths(BYTE, entries=1000, values=4000).memo
    rng = np.random.default_rng(3)
    for _ in range(4):
        texts = ["".join(map(chr, rng.integers(0x4E00, 0x9000, 300))) for _ in range(200)] + ["".join(map(chr, rng.integers(97, 123, 9))) for _ in range(2000)]
        memo.turn(*pieces.bytes_of(pa.array(texts)))
        assert memo.used <= 1000
    assert len(memo.keys) < 20_000


def test_added_tokens_with_white_space_are_refused():
    with pytest.raises(ValueError):
        pieces.Cutter(spaced=True, single_digits=False, added=["a b"])
