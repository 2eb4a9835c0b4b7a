"""The classifier on held-out labels, the rules against plain counts, the language model against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import TESTDATA
from veraz.llm import queries, quality_classifier, quality_rules, words
from veraz.llm.shared import written

BIG = TESTDATA.replace("0.001", "0.01")
ODD = [None, "", " \n\t", "One two", "aé b\x0bc\x85d # * <|>", "x\nx\n \n \nx y\ny x", "a b c a b c d", "q " * 300, "Same words here. " * 20, "x" * 5000]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i if i != 2 else None, t, None if i % 2 else "xx", 1, "kept?", 3.0) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[-1]], "doc_id long, text string, lang string, n_words int, kept string, score double")


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    again = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


def test_measures(spark, odd):
    for df in (spark.read.parquet(f"{TESTDATA}/documents.parquet"), odd):
        want = Counter((r.doc_id, *base(r.text)) for r in df.collect())
        rows = quality_rules.judge(df).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
        for r in rows:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
    assert quality_rules.judge(odd.limit(0)).count() == 0


def brute_model(texts, order=quality_rules.ORDER):
    """Modified Kneser-Ney by dictionaries: a function from n-grams of symbols to probabilities."""
    seqs = [tuple(quality_rules._FOLD[np.frombuffer(t, np.uint8)].tolist()) for t in texts]
    tables = [Counter(s[i : i + order] for s in seqs for i in range(len(s) - order + 1))]
    while len(tables[0]) and len(next(iter(tables[0]))) > 1:
        tables.insert(0, Counter(g[1:] for g in tables[0]))
    discounts = []
    for t in tables:
        n = [sum(c == k for c in t.values()) for k in range(1, 5)]
        if not n[0] or not n[1]:
            discounts.append([0, 0.5, 1, 1.5])
            continue
        y = n[0] / (n[0] + 2 * n[1])
        d = [0] + [(k - (k + 1) * y * n[k] / n[k - 1]) if n[k - 1] else k / 2 for k in (1, 2, 3)]
        discounts.append([min(max(x, 0), m) for x, m in zip(d, (0, 0.999, 1.999, 2.999), strict=True)])

    def p(gram):
        if not gram:
            return 1 / quality_rules.SYMBOLS
        t, d = tables[len(gram) - 1], discounts[len(gram) - 1]
        follow = [t[gram[:-1] + (s,)] for s in range(quality_rules.SYMBOLS)]
        total, lower = sum(follow), p(gram[1:])
        if not total:
            return lower
        c = t[gram]
        return (c - d[min(c, 3)]) / total + sum(d[min(x, 3)] for x in follow) / total * lower

    return p


def test_language_model():
    texts = ["the cat sat on the mat. The rat sat, too!".encode(), "Ça va très bien 12 fois".encode(), b"zzzz", b"ab"]
    code, offsets = quality_rules.codes(texts)
    assert np.diff(offsets).tolist() == [max(len(t) - 3, 0) for t in texts]
    model = quality_rules.NgramModel.of(np.bincount(code, minlength=quality_rules.GRAMS))
    p = brute_model(texts)
    tried = np.concatenate([code, quality_rules.codes([b"the zebra xylophone q9?", b"sat on"])[0]])
    for c, got in zip(tried.tolist(), model.log_probability(tried).tolist(), strict=True):
        gram = tuple(c >> 5 * k & 31 for k in (3, 2, 1, 0))
        assert math.isclose(got, math.log(p(gram)), rel_tol=1e-5, abs_tol=1e-5)
    for keys, _ in model.grams + model.contexts:
        assert (np.diff(keys.astype(object)) > 0).all()


def test_rules_keep_clean_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = queries.op8_quality_rules(spark, BIG).collect()
    clean = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert any(not r.kept and not r.base_failed for r in rows)


def test_word_model_against_brute_force(spark):
    texts = ["a b a", "b a é12", "", None, "x" * 3000, "a b", "b"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    df = written(df)
    model = quality_rules.models(quality_rules.count(df))[0]
    seqs = {i: [*(t or "").split(), None] for i, t in enumerate(texts) if t}

    def p(i, v, w):
        others = [s for j, s in seqs.items() if j != i]
        n, c = sum(map(len, others)), sum(s.count(w) for s in others)
        cv, cvw = sum(s.count(v) for s in others), sum((a, b) == (v, w) for s in others for a, b in zip([None, *s], s, strict=False))
        spelling = -math.log(quality_rules.SYMBOLS) if w is None else quality_rules.spelled([w.encode()], model, np.zeros(quality_rules.GRAMS))[0]
        unseen = math.log(quality_rules.WORD) + spelling - math.log(n + quality_rules.WORD)
        word = math.log(c / (n + quality_rules.WORD) + math.exp(unseen)) if c else unseen
        return math.log((cvw + quality_rules.BIGRAM * math.exp(word)) / (cv + quality_rules.BIGRAM)) if cvw else math.log(quality_rules.BIGRAM) + word - math.log(cv + quality_rules.BIGRAM)

    got = {r.doc_id: r.log_perplexity for r in quality_rules.measure(df, {0: model}, 5).collect()}
    assert set(got) == set(range(len(texts))) and got[2] is None and got[3] is None
    for i, s in seqs.items():
        assert math.isclose(got[i], -sum(p(i, v, w) for v, w in zip([None, *s], s, strict=False)) / len(s), rel_tol=1e-6)


def test_wide_hashes_give_the_same(spark):
    df = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    model = quality_rules.models(quality_rules.count(df))
    got = [{r.doc_id: r.log_perplexity for r in quality_rules.measure(df, model, 7, bits=b).collect()} for b in (36, 56)]
    assert all(a == b or math.isclose(a, b, rel_tol=1e-9) for a, b in zip(got[0].values(), (got[1][k] for k in got[0]), strict=True))
    assert [quality_rules.key_bits(n) for n in (0, 10**9, 50 * 10**9, 10**14, 1 << 60)] == [36, 36, 42, 53, 56]


def test_word_model_sees_word_order(spark):
    rng = np.random.default_rng(8)
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text", "lang")
    labels = {r.doc_id for r in spark.read.parquet(f"{BIG}/labels.parquet").collect() if r.quality == 1}
    clean = [r for r in docs.collect() if r.doc_id in labels and len(r.text.split()) >= 300][:40]
    mixed = spark.createDataFrame([(-1 - r.doc_id, " ".join(rng.permutation(r.text.split())), r.lang) for r in clean], docs.schema)
    got = {r.doc_id: r.log_perplexity for r in quality_rules.judge(docs.unionByName(mixed)).collect()}
    assert sum(got[-1 - r.doc_id] > got[r.doc_id] for r in clean) >= 0.95 * len(clean)


def test_languages_come_from_the_data(spark):
    text = " ".join(f"parola{i % 40} altra{i * i % 97}" for i in range(1000))
    rows = [(0, text, "it"), (1, text, "it"), (2, text, "en"), (3, text, "en"), (4, text, None), (5, "one two three", "tiny"), (6, None, "it")]
    got = {r.doc_id: r.lang_no for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[0] == got[1] == got[6] and got[2] == got[3] and got[4] == got[5]
    assert len({got[0], got[2], got[4]}) == 3


def test_rules_reject_junk(spark):
    rng = np.random.default_rng(9)
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "text", "lang")
    texts = {r.doc_id: r.text for r in docs.collect()}
    letters = [chr(c) for c in range(0x430, 0x450)]
    digits = " ".join("".join(map(str, rng.integers(0, 10, 7))) for _ in range(200))
    cyrillic = " ".join("".join(rng.choice(letters, 7)) for _ in range(200))
    planted = [(-1 - 2 * i - j, t, lang) for i, lang in enumerate(("en", "fr", "de", "es")) for j, t in enumerate((digits[i:], cyrillic[i:]))]
    rows = quality_rules.judge(docs.unionByName(spark.createDataFrame(planted, docs.schema))).collect()
    assert not any(r.kept for r in rows if r.doc_id < 0)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    marked = [r for r in rows if labels.get(r.doc_id) == 0 and not r.base_failed and sum(map(texts[r.doc_id].count, ("***", "%%%", "$$$", "&&&", "###"))) > 10]
    assert marked and sum(not r.kept for r in marked) >= 0.5 * len(marked)


def test_classifier_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = queries.op2_quality_classifier(spark, BIG).collect()
    assert len(rows) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = defaultdict(list)
    for r in rows:
        if r.held_out and r.doc_id in labels:
            held[labels[r.doc_id]].append(r.score)
    order = [(a > b) + 0.5 * (a == b) for a in held[1] for b in held[0]]
    assert sum(order) / len(order) > 0.95


def test_classifier_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 0, "x"), (7, 1, "y"), (None, 1, "z"), (3, None, "w")], "doc_id long, quality int, text string")
    w = quality_classifier.train(odd, labels)
    rows = quality_classifier.score(odd, w).collect()
    assert len(rows) == len(ODD) + 1 and all(0 <= r.score <= 1 for r in rows)
    none = quality_classifier.train(odd, labels.limit(0))
    assert {r.score for r in quality_classifier.score(odd, none).collect()} == {0.5}
    assert quality_classifier.score(odd.limit(0), w).count() == 0


def test_long_texts_are_hashed_in_windows(monkeypatch):
    """Windows of a few bytes, and words longer than them, give the hashes of one window."""
    texts = ["aa bb! cc aa".encode(), b"", b"x" * 50 + b" y Z1", b" "]
    whole = [words.word_hashes(texts, fold=True), words.shape_hashes(texts)]
    monkeypatch.setattr(words, "CHUNK_BYTES", 7)
    monkeypatch.setattr(words, "_tables", [])
    (h, o), s = words.word_hashes(texts, fold=True), words.shape_hashes(texts)
    assert h.tolist() == whole[0][0].tolist() and o.tolist() == whole[0][1].tolist() and s.tolist() == whole[1].tolist() and len(h) == 7


M64 = (1 << 64) - 1


def _mix(h):
    h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & M64
    h = ((h ^ h >> 27) * 0x94D049BB133111EB) & M64
    return h ^ h >> 31


def _polynomial(values):
    return _mix(sum(v * pow(words._BASE, k, 1 << 64) for k, v in enumerate(values)) & M64)


def plain_features(text):
    """Coordinates and values of one text with whole numbers and dictionaries."""
    tokens = re.findall(rb"[^\x20\x09-\x0D]+", text)
    value = lambda b: _mix((b + 1) * words._BASE & M64)
    hashes = [_polynomial([value(b) for b in w.lower()]) for w in tokens]
    shapes, seen = [], set()
    for w, h in zip(tokens, hashes, strict=True):
        look = [1 if chr(b).islower() and b < 128 or b >= 128 else 2 if chr(b).isupper() else 3 if chr(b).isdigit() else b for b in w]
        runs = [x for k, x in enumerate(look) if not k or look[k - 1] != x]
        shapes.append(_mix((_polynomial([_mix(x + 7) for x in runs]) + (h in seen) * 0x5BD1E995) & M64))
        seen.add(h)
    out = {0: 1.0}
    merged = Counter(out)
    for tag, (base_, n) in enumerate(((hashes, 1), (hashes, 2), (shapes, 1), (shapes, 2), (shapes, 3)), 1):
        grams = Counter()
        for k in range(len(base_) - n + 1):
            g = 0
            for x in base_[k : k + n]:
                g = (g * words._BASE + x) & M64
            grams[1 + (_mix((_mix(g) + tag * 0x1000193) & M64) >> 64 - quality_classifier.BITS) % ((1 << quality_classifier.BITS) - 1)] += 1
        norm = math.sqrt(sum(c * c for c in grams.values()))
        for c, x in grams.items():
            merged[c] += x / norm  # coordinates that meet add up in a dot product
    return merged


def test_classifier_against_plain_code():
    """Features by dictionaries, and the updates written out for one coordinate at a time."""
    texts = ["One two, two three! écu 12 12", "", "Buy NOW *** buy now *** 100%", "one Two three four five", "x"]
    data = [t.encode() for t in texts]
    ids, values, offsets = quality_classifier.features(data)
    rows = []
    for k, t in enumerate(data):
        got = Counter()
        for c, v in zip(ids[offsets[k] : offsets[k + 1]].tolist(), values[offsets[k] : offsets[k + 1]].tolist(), strict=True):
            got[c] += v
        want = plain_features(t)
        assert set(got) == set(want) and all(math.isclose(got[c], want[c], rel_tol=1e-9) for c in want)
        assert len(got) == offsets[k + 1] - offsets[k]  # no coordinates met here, so that updates are one by one
        rows.append(want)
    labels, how = [1, 0, 0, 1, 1], quality_classifier.Ftrl()
    z, n = defaultdict(float), defaultdict(float)
    weight = lambda c: 0.0 if abs(z[c]) <= how.l1 else (math.copysign(how.l1, z[c]) - z[c]) / ((how.beta + math.sqrt(n[c])) / how.alpha + how.l2)
    for _ in range(how.epochs):
        for x, y in zip(rows, labels, strict=True):
            w = {c: weight(c) for c in x}
            p = 1 / (1 + math.exp(-sum(w[c] * v for c, v in x.items())))
            for c, v in x.items():
                g = (p - y) * v
                z[c] += g - (math.sqrt(n[c] + g * g) - math.sqrt(n[c])) / how.alpha * w[c]
                n[c] += g * g
    split = lambda a: [a[i:j] for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
    got = quality_classifier.fit(list(zip(split(ids), split(values), strict=True)), labels)
    assert np.count_nonzero(got) == sum(weight(c) != 0 for c in z) > 0 and all(math.isclose(got[c], weight(c), rel_tol=1e-9, abs_tol=1e-12) for c in z)
    scores = quality_classifier._dots(data, got)
    for s, x in zip(scores.tolist(), rows, strict=True):
        assert math.isclose(s, 1 / (1 + math.exp(-sum(weight(c) * v for c, v in x.items()))), rel_tol=1e-9)


def test_scored_rows_keep_their_columns(spark):
    df = spark.createDataFrame([(1, None, "a", {"k": 1}), (None, "b c", None, None), (1, "b c", "a", {})], "id long, text string, `odd name` string, m map<string,int>").withColumn("score", F.lit("old"))
    out = quality_classifier.scored(df, np.zeros(1 << quality_classifier.BITS, np.float32))
    assert out.columns == ["id", "text", "odd name", "m", "score"] and {r.score for r in out.collect()} == {0.5}
    assert sorted(((r.id, r.text, r["odd name"], r.m) for r in out.collect()), key=str) == sorted(((r.id, r.text, r["odd name"], r.m) for r in df.collect()), key=str)


def test_bands_and_verdicts_against_plain_code(spark):
    rows = quality_rules.judge(spark.read.parquet(f"{BIG}/documents.parquet")).collect()
    fair = defaultdict(list)
    for r in rows:
        if r.log_perplexity is not None and r.n_words >= 50:
            fair[r.lang_no].append(round(1000 * r.log_perplexity) / 1000)
    limits = {}
    for x, values in fair.items():
        values.sort()
        low, high = (values[math.ceil(q * len(values)) - 1] for q in (0.25, 0.75))
        limits[x] = (low - max(quality_rules.BAND_BELOW * (high - low), quality_rules.BAND_LEAST), high + max(quality_rules.BAND_ABOVE * (high - low), quality_rules.BAND_LEAST))
    assert len(limits) == 4
    for r in rows:
        low, high = limits.get(r.lang_no, (-math.inf, math.inf))
        assert r.kept == (not r.base_failed and (r.log_perplexity is None or low <= r.log_perplexity <= high))


def test_kept_rows_are_judged_each(spark):
    """Rows with null and repeated ids: only the bad ones go, and all columns stay as they are."""
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    verdict = {r.doc_id: r.kept for r in quality_rules.judge(docs).collect()}
    odd = docs.withColumns({"doc_id": F.when(F.col("doc_id") % 2 == 0, F.lit(None).cast("long")).otherwise(F.lit(7).cast("long")), "kept": F.col("doc_id"), "lang_no": F.lit("x")})
    out = quality_rules.kept_rows(odd)
    assert out.columns == odd.columns and not all(verdict.values())
    assert Counter(map(tuple, out.collect())) == Counter(tuple(r) for r in odd.collect() if verdict[r.kept])
    assert quality_rules.kept_rows(odd.limit(0)).count() == 0


def test_word_hashes_do_not_depend_on_the_batch():
    texts = ["a b c".encode(), b"", " Àé b\x0bc a ".encode(), b"one"]
    h, o = words.word_hashes(texts, fold=True)
    assert np.diff(o).tolist() == [3, 0, 4, 1]
    for i, t in enumerate(texts):
        alone = words.word_hashes([b"zz", t], fold=True)
        assert alone[0][1:].tolist() == h[o[i] : o[i + 1]].tolist()
    assert h[1] == h[4] and h[2] == h[5] and len(set(h.tolist())) == 5
    s = words.shape_hashes([b"Abc Xyz! abc ABC!! DE!!", "écu".encode()])
    assert s[0] != s[1] and s[3] == s[4] and s[2] == s[5]
    g, o = words.ngrams(*words.word_hashes([b"a b", b"a b c d e f", b""], True), 5)
    assert np.diff(o).tolist() == [1, 2, 0]
