"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for the rest.

Everything is DataFrame and SQL functions. Features of a URL are lengths, depths, digit ratio, entropy,
numbers of parameters and hyphens, and statistics of its suffixes: of the host's last label and last two
labels and of the path's first part, the rate of blocked URLs (smoothed) and their share. Suffixes
count over all labelled URLs of one half (by a hash of the URL), the trees learn from the other half,
so no URL meets its own label. A suffix has statistics of its own from one in 2^16 of the counted
URLs on, so each kind has at most 2^16 (which bounds what is broadcast); a rarer host suffix has those
of the next shorter one, a rarer first part those of all.

The trees learn by histograms: each feature is cut at quantiles of the labelled rows, a level of a tree
is one aggregation of whole-number gradients by node, feature and bin, and the driver picks splits from
at most 2^DEPTH * features * bins rows. Sums of whole numbers don't depend on their order, so the trees
don't either. At most about ``MAX_ROWS`` labelled URLs (by a hash) train the trees; rows with equal
bins are put together first.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule and is
judged by the trees. URLs may repeat; where rules of equal length fit, the one listed first wins.
Without labelled URLs every score is 0.5 and the verdict is allow. Other columns of the input stay, and
those named as a result are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veraz.llm.shared import written

#: (verdict, host, path)
Rule = tuple[str, str, str]
KINDS = ("suffix", "domain", "directory")
LEXICAL = ("length", "host_length", "host_depth", "path_depth", "digit_ratio", "entropy", "parameters", "hyphens")
FEATURES = (*LEXICAL, *(f"{k}_{s}" for k in KINDS for s in ("rate", "share")))
#: Labelled URLs that train the trees, about; suffix statistics use all of the other half.
MAX_ROWS = 200_000
#: A suffix has its own statistics from this share of the counted URLs on.
LEAST_SHARE = 2**-16
SMOOTHING = 8.0
TREES, DEPTH, BINS, RATE, LAMBDA, LEAST_ROWS = 16, 3, 16, 0.4, 1.0, 4
#: Gradients are whole multiples of 2^-20.
UNIT = 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``, or nothing."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    for v, h, p in reversed(ordered):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def entropy(text: Column) -> Column:
    """Bits a character: equal characters lie together once sorted, and each stretch of n adds n log n."""
    nothing = F.struct(F.lit("").alias("c"), F.lit(0).alias("n"), F.lit(0.0).alias("s"))
    own = lambda a: F.when(a["n"] > 1, a["n"] * F.log2(a["n"])).otherwise(F.lit(0.0))
    grown = lambda a, c: F.struct(c.alias("c"), F.when(a["c"] == c, a["n"] + 1).otherwise(F.lit(1)).alias("n"), F.when(a["c"] == c, a["s"]).otherwise(a["s"] + own(a)).alias("s"))
    total = F.length(text)
    together = F.aggregate(F.array_sort(F.split(text, "")), nothing, grown, lambda a: a["s"] + own(a))
    return F.when(total > 0, F.round(F.log2(total) - together / total, 9)).otherwise(F.lit(0.0))


def described(pages: DataFrame, url_col: str) -> DataFrame:
    """Adds _host and _path, the lexical features and the keys of suffix statistics in the struct _x."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    split = pages.withColumns({"_host": host(url), "_path": path(url)})
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    values = {
        "length": F.length(url),
        "host_length": F.length("_host"),
        "host_depth": F.when(F.col("_host") == "", 0).otherwise(F.size(F.split("_host", r"\."))),
        "path_depth": F.size(F.filter(F.split("_path", "/"), lambda s: s != "")),
        "digit_ratio": F.when(F.length(url) > 0, digits / F.length(url)).otherwise(F.lit(0.0)),
        "entropy": entropy(F.concat("_host", "_path")),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "hyphens": F.length("_host") - F.length(F.regexp_replace("_host", "-", "")),
    }
    keys = {"suffix": F.substring_index("_host", ".", -1), "domain": F.substring_index("_host", ".", -2), "directory": F.regexp_extract("_path", "^/([^/]*)", 1)}
    return split.withColumn("_x", F.struct(*(c.cast("double").alias(k) for k, c in values.items()), *(c.alias(f"{k}_key") for k, c in keys.items())))


@dataclass(frozen=True)
class Statistics:
    """Rates and shares of suffixes (kind, key, rate, share), and the rate of all."""

    table: DataFrame
    prior: float


def suffix_statistics(labelled: DataFrame) -> Statistics:
    """From described rows with a label _y (1: blocked)."""
    keys = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"_x.{k}_key").alias("key")) for k in KINDS))
    counted = written(labelled.select(F.inline(keys), "_y").groupBy("kind", "key").agg(F.count("*").alias("n"), F.sum("_y").alias("blocked")))
    n, blocked = counted.where(F.col("kind") == KINDS[0]).agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    prior = (blocked + 1) / (n + 2)
    rate = (F.col("blocked") + SMOOTHING * prior) / (F.col("n") + SMOOTHING)
    own = counted.where(F.col("n") >= n * LEAST_SHARE)
    return Statistics(own.select("kind", "key", rate.alias("rate"), (F.col("n") / max(n, 1)).alias("share")), prior)


def with_features(rows: DataFrame, statistics: Statistics) -> DataFrame:
    """Described rows with all features in the struct _f. At most 2^16 suffixes of a kind are broadcast."""
    out = rows
    for k in KINDS:
        own = statistics.table.where(F.col("kind") == k).select(F.col("key").alias(f"_{k}"), F.struct("rate", "share").alias(f"_{k}_known"))
        out = out.join(F.broadcast(own), F.col(f"_x.{k}_key") == F.col(f"_{k}"), "left").drop(f"_{k}")
    prior = F.lit(statistics.prior)
    rates = {"suffix": F.coalesce("_suffix_known.rate", prior), "domain": F.coalesce("_domain_known.rate", "_suffix_known.rate", prior), "directory": F.coalesce("_directory_known.rate", prior)}
    shares = {k: F.coalesce(f"_{k}_known.share", F.lit(0.0)) for k in KINDS}
    columns = [F.col(f"_x.{c}").alias(c) for c in LEXICAL] + [c.alias(f"{k}_{s}") for k in KINDS for s, c in (("rate", rates[k]), ("share", shares[k]))]
    return out.withColumn("_f", F.struct(*columns)).drop("_x", *(f"_{k}_known" for k in KINDS))


#: A leaf's value, or (feature, cut, tree where the feature is at most the cut, tree beyond).
Tree = float | tuple[int, float, "Tree", "Tree"]


@dataclass(frozen=True)
class Model:
    base: float
    trees: tuple[Tree, ...]
    statistics: Statistics | None = None

    def margin(self, feature) -> Column:
        """``feature`` gives the column of a feature's number."""
        total = F.lit(self.base)
        for t in self.trees:
            total = total + _value(t, feature)
        return total


def _value(tree: Tree, feature) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    i, cut, low, high = tree
    return F.when(feature(i) <= cut, _value(low, feature)).otherwise(_value(high, feature))


def logistic(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def quantile_cuts(rows: DataFrame) -> list[list[float]]:
    """At most BINS - 1 different cuts a feature: values at equal steps of rank, of bounded rows."""
    at = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*(F.percentile(f"_f.{f}", F.array(*map(F.lit, at))).alias(f) for f in FEATURES)).first()
    return [sorted(set(found[f] or [])) for f in FEATURES]


def binned(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """Rows as bins (the number of cuts below each feature) and label, equal ones counted."""
    below = lambda f, cut: sum(((F.col(f"_f.{f}") > c).cast("int") for c in cut), F.lit(0))
    return rows.select(F.array(*(below(f, c) for f, c in zip(FEATURES, cuts, strict=True))).alias("bins"), "_y").groupBy("bins", "_y").agg(F.count("*").alias("n"))


def best_split(sums: dict[tuple[int, int], tuple[int, int, int]], bins: list[int]) -> tuple[int, int, tuple[int, int], tuple[int, int]] | None:
    """(feature, last bin below, gradient and curvature below and beyond) of the best cut of a node, from its
    sums (gradient, curvature, rows) by feature and bin; ties go to the lower feature and bin. None if no
    cut gains."""
    most, best = 1e-6 * UNIT, None
    score = lambda g, h: g * g / (h + LAMBDA * UNIT)
    for f, size in enumerate(bins):
        per = [sums.get((f, b), (0, 0, 0)) for b in range(size)]
        g, h, n = (sum(x[i] for x in per) for i in range(3))
        lg = lh = ln = 0
        for b in range(size - 1):
            lg, lh, ln = lg + per[b][0], lh + per[b][1], ln + per[b][2]
            gain = score(lg, lh) + score(g - lg, h - lh) - score(g, h)
            if min(ln, n - ln) >= LEAST_ROWS and gain > most:
                most, best = gain, (f, b, (lg, lh), (g - lg, h - lh))
    return best


def boost(rows: DataFrame, cuts: list[list[float]]) -> Model:
    """The trees, from rows of ``binned``. Each level of a tree is one aggregation."""
    n, blocked = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("_y")), F.lit(0))).first()
    base = math.log((blocked + 1) / (n - blocked + 1))
    bins = [len(c) + 1 for c in cuts]
    by_bin: list[Tree] = []  # with numbers of bins for cuts
    for _ in range(TREES if 0 < blocked < n else 0):
        p = logistic(Model(base, tuple(by_bin)).margin(lambda i: F.col("bins")[i]))
        moved = rows.withColumn("p", p).select("bins", "n", (F.round((F.col("p") - F.col("_y")) * UNIT).cast("long") * F.col("n")).alias("g"), (F.round(F.col("p") * (1 - F.col("p")) * UNIT).cast("long") * F.col("n")).alias("h"))
        splits: dict[int, tuple[int, int]] = {}  # by node: 1 is the root, 2i and 2i + 1 are the children of i
        leaves: dict[int, tuple[int, int]] = {}
        for level in range(DEPTH):
            node = F.lit(1)
            for i, (f, b) in sorted(splits.items()):  # parents come first
                node = F.when(node == i, F.when(F.col("bins")[f] <= b, 2 * i).otherwise(2 * i + 1)).otherwise(node)
            reached = moved.withColumn("node", node).where(F.col("node") >= 1 << level)
            sums = reached.select("node", F.posexplode("bins").alias("feature", "bin"), "n", "g", "h").groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
            at: dict[int, dict[tuple[int, int], tuple[int, int, int]]] = {}
            for r in sums.collect():  # at most 2^level * features * bins rows
                at.setdefault(r.node, {})[r.feature, r.bin] = (r.g, r.h, r.n)
            for i, own in at.items():
                if found := best_split(own, bins):
                    splits[i], leaves[2 * i], leaves[2 * i + 1] = found[:2], found[2], found[3]
        if not splits:
            break
        by_bin.append(_grown(1, splits, leaves))
    return Model(base, tuple(_with_cuts(t, cuts) for t in by_bin))


def _grown(i: int, splits: dict, leaves: dict) -> Tree:
    if i in splits:
        return (*splits[i], _grown(2 * i, splits, leaves), _grown(2 * i + 1, splits, leaves))
    g, h = leaves[i]
    return -RATE * g / (h + LAMBDA * UNIT)


def _with_cuts(tree: Tree, cuts: list[list[float]]) -> Tree:
    if isinstance(tree, float):
        return tree
    f, b, low, high = tree
    return (f, cuts[f][b], _with_cuts(low, cuts), _with_cuts(high, cuts))


def train(labelled: DataFrame, url_col: str, blocked: Column) -> Model:
    """A model from labelled URLs; rows without a label teach nothing."""
    rows = labelled.select(F.col(url_col).alias("_url"), blocked.cast("int").alias("_y")).where(F.col("_y").isNotNull())
    rows = described(rows, "_url")
    half = F.pmod(F.xxhash64("_url"), F.lit(2))
    statistics = suffix_statistics(rows.where(half == 0))
    own = rows.where(half == 1)
    thinned = F.pmod(F.xxhash64("_url", F.lit("trees")), F.lit(1 << 30)) < F.lit(int(min(1.0, MAX_ROWS / max(own.count(), 1)) * (1 << 30)))
    taught = written(with_features(own.where(thinned), statistics).select("_f", "_y"))
    cuts = quantile_cuts(taught)
    model = boost(written(binned(taught, cuts).coalesce(4)), cuts)
    return Model(model.base, model.trees, statistics)


def judge(pages: DataFrame, model: Model, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """Adds host, path, rule, score (the trees' probability of block) and verdict: the rule's, else block
    where the score is above a half."""
    added = ("host", "path", "rule", "score", "verdict")
    kept = [c for c in pages.columns if c not in added]
    rows = with_features(described(pages.select(*kept, F.col(url_col).alias("_url")), "_url"), model.statistics)
    text, said = fitting_rule(rules, F.col("_host"), F.col("_path"))
    scored = rows.withColumns({"_rule": text, "_said": said, "_score": logistic(model.margin(lambda i: F.col(f"_f.{FEATURES[i]}")))})
    verdict = F.coalesce("_said", F.when(F.col("_score") > 0.5, "block").otherwise("allow"))
    return scored.select(*kept, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_score").alias("score"), verdict.alias("verdict"))


def by_rules(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> tuple[DataFrame, Column]:
    """The rows that a rule decides, and whether theirs blocks: labels for ``train``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    _, said = fitting_rule(rules, host(url), path(url))
    return pages.where(said.isNotNull()), said == "block"
