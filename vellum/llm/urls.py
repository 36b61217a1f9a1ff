"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for all other urls.

The trees are trained from labelled urls by histograms: features are cut into quantile bins, and each level of a tree is one
aggregate over (leaf, feature, bin), whose result has a bounded size whatever the number of urls; the driver only
picks the best cuts. Trees compile into column expressions. Only DataFrame functions are used. The query's
labelled urls are those that a rule decides; a bounded sample of them (TRAIN_ROWS expected, by a hash of the url) trains. The suffix statistics are the block rate and the number of
training urls of the host's last label, of its last two, and of those with the path's first part. A training url's rates are
those of the other FOLDS (by a hash of the url), so its own label is not among its features.

Cases: a null url, or one without "://", has an empty host and path, fits no rule and is scored like any other. With
no labelled urls, or of one class, the score is the smoothed share of blocked ones (0.5 without any: allow). Repeated
rows each give a row. Ties: a score of 0.5 allows; of equal cuts the first feature and bin. Very long urls are read whole. An empty table gives an empty result. Other columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import keep, maybe_broadcast

TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE = 8, 3, 16, 0.4
FOLDS = 4
#: (verdict, rule): the longest rule that fits wins.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
LEVELS = ("label", "suffix", "section")
FEATURES = ("length", "host_length", "host_labels", "depth", "digit_ratio", "hyphens", "entropy", "parameters", "last_part_length", *(f"{level}_{x}" for level in LEVELS for x in ("rate", "seen")))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)
        found = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def suffix_keys() -> Column:
    """What the block rates are of, an array by LEVELS: the host's last label, its last two, and those with the path's first part."""
    last = lambda n: F.substring_index(F.col("host"), ".", -n)
    return F.array(F.concat(F.lit("label "), last(1)), F.concat(F.lit("suffix "), last(2)), F.concat(F.lit("section "), last(2), F.lit("/"), F.coalesce(F.get(F.split("path", "/"), F.lit(1)), F.lit(""))))


def with_features(df: DataFrame, rates: DataFrame, n_rates: int, average: float, by: tuple[str, ...] = ()) -> DataFrame:
    """df (url, host, path and more) with column x, the array of FEATURES; rates: key (and what else `by` names), rate, seen: n_rates rows."""
    url = F.coalesce(F.col("url"), F.lit(""))
    df = df.withColumn("keys", suffix_keys())
    for k, level in enumerate(LEVELS):
        own = rates.where(F.startswith("key", F.lit(f"{level} "))).select(F.col("key").alias("own"), *by, F.col("rate").alias(f"rate{k}"), F.col("seen").alias(f"seen{k}"))
        df = df.withColumn("own", F.get("keys", F.lit(k))).join(maybe_broadcast(own, n_rates, 128), ["own", *by], "left").drop("own")
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    chars = F.array_distinct(F.filter(F.split(url, ""), lambda c: c != ""))
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / F.length(url)
    entropy = F.aggregate(chars, F.lit(0.0), lambda t, c: t - share(c) * F.ln(share(c)))
    x = F.array(
        n, F.length("host").cast("double"), F.size(F.split("host", r"\.")).cast("double"), F.regexp_count("path", F.lit("/")).cast("double"), F.regexp_count(url, F.lit("[0-9]")) / n,
        F.regexp_count("host", F.lit("-")).cast("double"), entropy, F.regexp_count(url, F.lit("[?&][^=&#]+=")).cast("double"), F.length(F.substring_index("path", "/", -1)).cast("double"),
        *(c for k in range(len(LEVELS)) for c in (F.coalesce(f"rate{k}", F.lit(average)), F.coalesce(f"seen{k}", F.lit(0.0)))),
    )
    return df.withColumn("x", x).drop("keys", *(f"{c}{k}" for k in range(len(LEVELS)) for c in ("rate", "seen")))


@dataclass
class Node:
    value: float = 0.0
    feature: int = -1
    cut: int = 0
    below: Node | None = None
    above: Node | None = None

    def column(self, over: Column, leaf) -> Column:
        """The tree over an array of bins; leaf: what a leaf is written as."""
        if self.feature < 0:
            return leaf(self)
        return F.when(F.get(over, F.lit(self.feature)) <= self.cut, self.below.column(over, leaf)).otherwise(self.above.column(over, leaf))


@dataclass
class Boosted:
    """Boosted trees over binned features: edges[f] are the upper bounds of the bins of feature f."""

    prior: float
    edges: list[list[float]] = field(default_factory=list)
    trees: list[Node] = field(default_factory=list)

    def bins(self, x: Column) -> Column:
        return F.array(*[_bin(F.get(x, F.lit(f)), edges) for f, edges in enumerate(self.edges)])

    def margin(self, bins: Column) -> Column:
        out = F.lit(self.prior)
        for tree in self.trees:
            out = out + tree.column(bins, lambda n: F.lit(n.value))
        return out


def _bin(value: Column, edges: list[float]) -> Column:
    out = F.lit(0)
    for e in edges:
        out = out + (value > e).cast("int")
    return out


def boost(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Boosted:
    """Fit to labelled (x: array<double>, y: 0.0 or 1.0) by one aggregate for every level of a tree."""
    n, ones = labelled.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
    share = (ones + 1) / (n + 2)
    model = Boosted(math.log(share / (1 - share)))
    if not 0 < ones < n:
        return model
    width = len(FEATURES)
    cuts = labelled.agg(*[F.percentile_approx(F.get("x", F.lit(f)), [k / bins for k in range(1, bins)], 1000).alias(f"f{f}") for f in range(width)]).first()
    model.edges = [sorted(set(c)) for c in cuts]
    rows = keep(labelled.select(model.bins(F.col("x")).alias("b"), "y"))
    for _ in range(trees):
        root = Node()
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-model.margin(F.col("b"))))
        leaves = [root]
        for level in range(depth + 1):
            at = {id(leaf): k for k, leaf in enumerate(leaves)}
            place = root.column(F.col("b"), lambda node, at=at: F.lit(at.get(id(node), -1)))
            graded = rows.select(place.alias("leaf"), (p - F.col("y")).alias("g"), (p * (1 - p)).alias("h"), F.posexplode("b").alias("f", "bin")).where("leaf >= 0")
            sums: dict[tuple[int, int], dict[int, tuple[float, float]]] = {}
            for r in graded.groupBy("leaf", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
                sums.setdefault((r.leaf, r.f), {})[r.bin] = (r.g, r.h)
            grown = []
            for k, leaf in enumerate(leaves):
                total_g, total_h = (sum(v[i] for v in sums.get((k, 0), {}).values()) for i in (0, 1))
                leaf.value = -rate * total_g / (total_h + 1)
                best = 1e-6
                for f in range(width) if level < depth else ():
                    g = h = 0.0
                    for b in sorted(sums.get((k, f), {}))[:-1]:
                        g, h = g + sums[k, f][b][0], h + sums[k, f][b][1]
                        gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                        if gain > best:
                            best, leaf.feature, leaf.cut = gain, f, b
                if leaf.feature >= 0:
                    leaf.below, leaf.above = Node(), Node()
                    grown += [leaf.below, leaf.above]
            leaves = grown
            if not leaves:
                break
        model.trees.append(root)
    return model


@dataclass
class UrlModel:
    trees: Boosted
    rates: DataFrame
    n_rates: int
    average: float

    def scored(self, df: DataFrame) -> DataFrame:
        """df (url, host, path and more) with column p, the probability of block."""
        df = with_features(df, self.rates, self.n_rates, self.average)
        if not self.trees.trees:
            return df.withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-self.trees.prior)))).drop("x")
        df = df.withColumn("b", self.trees.bins(F.col("x")))
        return df.withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-self.trees.margin(F.col("b"))))).drop("x", "b")


def train(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> UrlModel:
    """The model of labelled urls: url, host, path, y (1.0: block). A hash of the url picks about train_rows of them."""
    n = labelled.count()
    share = min(1.0, train_rows / max(n, 1))
    sample = labelled.where(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < math.ceil(1_000_000 * share))
    sample = keep(sample.select("url", "host", "path", "y", F.pmod(F.xxhash64(F.lit("fold"), "url"), F.lit(FOLDS)).alias("fold")), math.ceil(n * share))
    average = sample.agg((F.coalesce(F.sum("y"), F.lit(0.0)) + 1) / (F.count("*") + 2)).first()[0]
    folds = keep(sample.select(F.explode(suffix_keys()).alias("key"), "fold", "y").groupBy("key", "fold").agg(F.sum("y").alias("y"), F.count("*").alias("n")), math.ceil(n * share))
    sums = folds.groupBy("key").agg(F.sum("y").alias("all_y"), F.sum("n").alias("all_n"))
    rate = lambda y, n: ((y + average) / (n + 1)).alias("rate")
    rates = keep(sums.select("key", rate(F.col("all_y"), F.col("all_n")), F.col("all_n").cast("double").alias("seen")), math.ceil(n * share))
    others = folds.join(sums, "key").select("key", "fold", rate(F.col("all_y") - F.col("y"), F.col("all_n") - F.col("n")), (F.col("all_n") - F.col("n")).cast("double").alias("seen"))
    x = with_features(sample, others, folds.count(), average, ("fold",))
    return UrlModel(boost(x.select("x", "y")), rates, rates.count(), average)


def labelled_urls(rows: DataFrame) -> DataFrame:
    """The urls that a rule decides, with y; rows: as ruled() gives them."""
    return rows.where("m is not null").select("url", "host", "path", (F.col("m.verdict") == "block").cast("double").alias("y"))


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    url = F.col("url").cast("string")
    return pages.select("page_id", url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path")).withColumn("m", match_rule(F.col("host"), F.col("path"), rules))


def judge(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the trees' probability of block; null where a rule decides)."""
    rows = ruled(pages, rules)
    scored = train(labelled_urls(rows), train_rows).scored(rows)
    scored = scored.select("page_id", "host", "path", F.col("m.rule").alias("rule"), F.col("m.verdict").alias("decided"), F.when(F.col("m").isNull(), F.col("p")).alias("score"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decided", F.when(F.col("score") > 0.5, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "score")


def op1_urls(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
