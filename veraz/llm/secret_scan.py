"""Secret scans in SQL expressions only.

Three base patterns (assignments, access keys, runs of hex digits) give spans by position. On top
of them, candidate strings are searched with a sliding window: the window's Shannon entropy over
its character class is kept up to date from the counts of the one character that enters and the
one that leaves. A candidate whose best window reaches the threshold of its class is a secret,
unless the allow-list suppresses it or a base span covers it.

All work is done row by row inside the scan's stage: there is no shuffle and no Python. It grows in
proportion to the length of candidates, and with the power 1.5 of the number of spans in a text.

Defined results: null and empty texts have no spans; repeated rows give repeated rows; an empty
table gives no rows; columns of the input named like a result are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, the group whose length counts and the least length.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN, 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]{16,}", 0, 16))
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class CharClass:
    """Candidates of one character class: what a whole candidate must match and its threshold in bits."""

    name: str
    alphabet: str
    pattern: str
    bits: float


UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
CLASSES = (
    CharClass("hex", DIGITS + "ABCDEF", "^[0-9A-F]+$", 3.0),
    CharClass("base32", UPPER + "234567", "^[A-Z2-7]+$", 3.5),
    CharClass("base64", UPPER + LOWER + DIGITS + "+/_-", "^[A-Za-z0-9+/_-]+$", 3.8),
)
#: Candidates have as many characters at least as the window.
WINDOW = 20
#: What looks random but is known not to be a secret: markers of samples, counting runs, UUIDs, runs of one sign.
ALLOW = r"(?i)example|sample|placeholder|redacted|changeme|0123456|1234567|abcdefg|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|(.)\1{7}|[-_/+]{4}"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _blocks(items: str) -> str:
    """SQL: an array cut into about as many blocks as one block has items. Arrays grow by copying, so
    what is built up item by item is built up in blocks; an empty array has one empty block."""
    step = f"cast(ceil(sqrt(greatest(size({items}), 1))) as int)"
    return f"transform(sequence(0, greatest(size({items}) - 1, 0) div {step}), k -> slice({items}, k * {step} + 1, {step}))"


def _positions(matches: str, gaps: str) -> str:
    """SQL: array of (start, stop) of matches in a text, from the matches and what lies between them."""
    steps = f"zip_with({matches}, slice({gaps}, 1, size({matches})), (m, g) -> named_struct('gap', length(g), 'own', length(m)))"
    none = "cast(array() as array<struct<start: int, stop: int>>)"
    inner = f"""transform({_blocks("st")}, x -> aggregate(x, named_struct('at', cast(0 as int), 'out', {none}),
        (a, s) -> named_struct('at', a.at + s.gap + s.own, 'out', concat(a.out, array(named_struct('start', a.at + s.gap, 'stop', a.at + s.gap + s.own))))))"""
    outer = f"""aggregate({inner}, named_struct('at', cast(0 as int), 'out', cast(array() as array<array<struct<start: int, stop: int>>>)),
        (a, x) -> named_struct('at', a.at + x.at, 'out', concat(a.out, array(transform(x.out, s -> named_struct('start', s.start + a.at, 'stop', s.stop + a.at))))),
        a -> flatten(a.out))"""
    return f"transform(array({steps}), st -> {outer})[0]"


def _entropy(candidate: str, alphabet: str, window: int, enough: float) -> str:
    """SQL: the highest Shannon entropy of all windows of a candidate, in bits, by incremental counts. Nothing
    more is counted once ``enough`` is reached."""
    if not 0 < window <= 60:
        raise ValueError("a window has 1 to 60 characters")
    weigh = lambda c: f"(case when {c} > 1 then {c} * log2({c}) else 0D end)"
    count = lambda c: f"(ascii(substring(a.counts, {c}, 1)) - 64)"
    put = lambda counts, n, c: f"overlay({counts} placing char(64 + {n}) from {c} for 1)"
    # The counts are a string with a character for each of the alphabet, '@' for 0, 'A' for 1 and so on,
    # as replacing a character of a short string costs less than building an array. A character
    # that enters as the same one leaves changes nothing.
    seen = f"named_struct('come', ch[i - 1], 'leave', if(i > {window}, ch[i - 1 - {window}], 0))"
    known = f"transform(array({seen}), x -> named_struct('come', x.come, 'leave', x.leave, 'more', {count('x.come')}, 'less', if(x.leave > 0, {count('x.leave')}, 0)))[0]"
    step = f"""transform(array({known}), x -> case when x.come = x.leave then a else named_struct(
        'counts', if(x.leave > 0, {put(put("a.counts", "x.more + 1", "x.come"), "x.less - 1", "x.leave")}, {put("a.counts", "x.more + 1", "x.come")}),
        'sum', a.sum + {weigh("(x.more + 1)")} - {weigh("x.more")} + if(x.leave > 0, {weigh("(x.less - 1)")} - {weigh("x.less")}, 0D),
        'best', a.best) end)[0]"""
    return f"""transform(array(transform(split({candidate}, ''), c -> locate(c, {_sql(alphabet)}))), ch -> aggregate(sequence(1, length({candidate})),
        named_struct('counts', repeat('@', {len(alphabet)}), 'sum', 0D, 'best', 0D),
        (a, i) -> case when a.best >= {enough} then a else transform(array({step}), n -> named_struct('counts', n.counts, 'sum', n.sum,
            'best', case when i >= {window} then greatest(n.best, log2({window}) - n.sum / {window}) else n.best end))[0] end,
        a -> a.best))[0]"""


def _reaches(blocks: str, rank: int) -> str:
    """SQL: for each block of spans, how far the spans below a rank in all blocks before it reach."""
    furthest = f"array_max(transform(filter(x, s -> s.rank < {rank}), s -> s.stop))"
    return f"aggregate({blocks}, array(cast(0 as int)), (a, x) -> concat(a, array(greatest(element_at(a, -1), {furthest}))))"


def scan(df: DataFrame, text_col: str = "text", window: int = WINDOW, classes: tuple[CharClass, ...] = CLASSES, allow: str = ALLOW) -> DataFrame:
    """All columns of the input and secret_spans array<struct<start: int, rank: int, stop: int>>:
    code points, end exclusive, ordered by start and rank, the place of the kind in ``KINDS``."""
    own = [c for c in df.columns if c.lower() != "secret_spans"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    candidates = "[A-Za-z0-9+/_-]{%d,}" % window
    rows = df.select(*own, text.alias("_scan_text"), *(F.regexp_extract_all(text, F.lit(p), 0).alias(f"_m_{kind}") for kind, p, _, _ in BASE), F.regexp_extract_all(text, F.lit(candidates), 0).alias("_m_entropy"))
    patterns = {kind: (p, group, least) for kind, p, group, least in BASE} | {"entropy": (candidates, 0, window)}
    none = "cast(array() as array<struct<start: int, stop: int>>)"
    for kind, (p, group, least) in patterns.items():
        m = f"_m_{kind}"
        rows = rows.withColumn(f"_g_{kind}", F.expr(f"case when size({m}) > 0 then split(_scan_text, {_sql(p)}, -1) end"))
        if group:
            rows = rows.withColumn(f"_v_{kind}", F.expr(f"case when size({m}) > 0 then regexp_extract_all(_scan_text, {_sql(p)}, {group}) end"))
        value = f"_v_{kind}" if group else m
        if kind == "entropy":
            judged = " ".join(f"when c.text rlike {_sql(k.pattern)} then {_entropy('c.text', k.alphabet, window, k.bits)} >= {k.bits}" for k in classes)
            keep = f"c.text rlike '[0-9]' and c.text rlike '[A-Za-z]' and not c.text rlike {_sql(allow)} and case {judged} else false end"
        else:
            keep = f"length(c.text) >= {least}"
        found = f"zip_with({_positions(m, f'_g_{kind}')}, {value}, (s, t) -> named_struct('span', s, 'text', t))"
        spans = f"transform(filter({found}, c -> {keep}), c -> c.span)"
        rows = rows.withColumn(f"_s_{kind}", F.expr(f"case when size({m}) > 0 then {spans} else {none} end"))
    base = "concat(" + ", ".join(f"transform(_s_{kind}, s -> named_struct('start', s.start, 'rank', {KINDS.index(kind)}, 'stop', s.stop))" for kind, *_ in BASE) + ")"
    rows = rows.withColumn("_base", F.expr(base))
    rows = rows.withColumn("_all", F.expr(f"array_sort(concat(_base, transform(_s_entropy, s -> named_struct('start', s.start, 'rank', {KINDS.index('entropy')}, 'stop', s.stop))))"))
    # Of the added spans those go that a base span before them covers.
    n, none = len(BASE), "cast(array() as array<struct<start: int, rank: int, stop: int>>)"
    kept = f"""transform(array({_blocks("_all")}), bl -> flatten(zip_with(bl, slice({_reaches("bl", n)}, 1, size(bl)), (x, r) -> aggregate(x, named_struct('reach', r, 'out', {none}),
        (a, s) -> named_struct('reach', if(s.rank < {n}, greatest(a.reach, s.stop), a.reach), 'out', if(s.rank < {n} or a.reach < s.stop, concat(a.out, array(s)), a.out)),
        a -> a.out))))[0]"""
    return rows.select(*own, F.expr(f"case when size(_s_entropy) = 0 or size(_base) = 0 then _all else {kept} end").alias("secret_spans"))


def rendered(spans: str = "secret_spans", base_only: bool = False) -> Column:
    """kind:start:end of the spans, joined by commas."""
    kinds = "array(" + ", ".join(map(_sql, KINDS)) + ")"
    chosen = f"filter({spans}, s -> s.rank < {len(BASE)})" if base_only else spans
    return F.expr(f"array_join(transform({chosen}, s -> concat(element_at({kinds}, s.rank + 1), ':', s.start, ':', s.stop)), ',')")


def counted(kind: str, spans: str = "secret_spans") -> Column:
    return F.expr(f"cast(size(filter({spans}, s -> s.rank = {KINDS.index(kind)})) as long)")


def redacted(text_col: str = "text", spans: str = "secret_spans", mark: str = "[SECRET]") -> Column:
    """The text with every run of overlapping spans replaced by a mark; null stays null."""
    # Each block of spans takes its own stretch of the text, from where the blocks before it reach.
    piece = f"""aggregate(x, named_struct('at', r, 'out', cast(array() as array<string>)),
        (a, s) -> named_struct('at', greatest(a.at, s.stop), 'out', if(s.start >= a.at, concat(a.out, array(substring(tx, a.at - r + 1, s.start - a.at), {_sql(mark)})), a.out)),
        a -> array_join(a.out, ''))"""
    stretch = f"substring({text_col}, r + 1, greatest(array_max(transform(x, s -> s.start)) - r, 0))"
    parts = f"zip_with(bl, slice(re, 1, size(bl)), (x, r) -> transform(array({stretch}), tx -> {piece})[0])"
    whole = f"concat(array_join({parts}, ''), substring({text_col}, element_at(re, -1) + 1))"
    made = f"transform(array({_blocks(spans)}), bl -> transform(array({_reaches('bl', len(KINDS))}), re -> {whole})[0])[0]"
    return F.expr(f"case when {text_col} is null or size({spans}) = 0 then {text_col} else {made} end")
