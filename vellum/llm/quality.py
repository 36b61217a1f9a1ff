"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of every whole text are computed in one pass. A bounded sample of labelled rows (about TRAIN_ROWS,
picked by a hash of doc_id) trains boosted trees; every path of a tree becomes a conjunctive rule;
L1-penalised logistic weights keep few of them; the kept rules are compiled into one Spark column expression,
so scoring stays inside the generated code. Only statistics of the text enter a score.

Cases: null and empty texts get the statistics of the empty text and so a score. With no usable labels, or of
one class only, the score is the smoothed share of label 1 (0.5 without any). Repeated labels of a doc_id
count as their mean, 0.5 as 1; null labels are ignored. Rows that repeat a doc_id train once, by the least statistics. Rows repeat in the output as in the input. Ties: a score of 0.5 is predicted 1 and kept. An empty table gives an empty result. Very long texts are
read whole. Columns of any other names pass through keep_good unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import crc32_fold, keep, maybe_broadcast, ship

ship(__name__)

#: Labelled rows that training reads to the driver, as expected from a hash of doc_id.
TRAIN_ROWS = 20_000
STATISTICS = ("log_bytes", "log_words", "word_bytes", "longest_word", "upper", "digit", "space", "newline", "stop", "symbol", "exclaim", "pipe", "high", "distinct_words", "repeated_lines", "symbol_words", "short_lines", "distinct_bytes")
_GROUPS = {
    "upper": range(65, 91), "digit": range(48, 58), "space": b" \t", "newline": b"\n\r", "stop": b".,;:?'\"-()", "symbol": b"#$%&*+/<=>@[\\]^_`{|}~", "exclaim": b"!", "pipe": b"|", "high": range(128, 256),
}
_MASK = np.zeros((256, len(_GROUPS)))
for _k, _bytes in enumerate(_GROUPS.values()):
    _MASK[list(_bytes), _k] = 1


def statistics(text: str | None) -> list[float]:
    """The values of STATISTICS for one whole text."""
    raw = (text or "").encode("utf-8", "replace")
    n = max(len(raw), 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = (counts @ _MASK / n).tolist()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    w = max(len(words), 1)
    marked = sum(x[-1] in b"!#$%&*|" for x in words)
    return [
        math.log1p(len(raw)), math.log1p(len(words)), sum(map(len, words)) / w, float(max(map(len, words), default=0)), *shares, len(set(words)) / w,
        1 - len(set(lines)) / max(len(lines), 1), marked / w, sum(len(x) < 20 for x in lines) / max(len(lines), 1), float(np.count_nonzero(counts)),
    ]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [statistics(t.as_py()) for t in batch.column(batch.num_columns - 1)]
        described = pa.array(values, pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], described], names=[*batch.schema.names[:-1], batch.schema.names[-1]])


def with_statistics(docs: DataFrame, keep_columns: list[str], name: str) -> DataFrame:
    """keep_columns of docs and the array column `name` of the text's statistics. No shuffle."""
    schema = T.StructType([*(docs.schema[c] for c in keep_columns), T.StructField(name, T.ArrayType(T.DoubleType()))])
    return docs.select(*[F.col(f"`{c}`") for c in keep_columns], F.col("text").cast("string").alias(name)).mapInArrow(_describe, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is greater, threshold)."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, greater, cut in self.terms:
            out &= (x[:, k] > cut) if greater else (x[:, k] <= cut)
        return out

    def column(self, stats: Column) -> Column:
        out = None
        for k, greater, cut in self.terms:
            value = F.get(stats, F.lit(k))
            one = value > F.lit(float(cut)) if greater else value <= F.lit(float(cut))
            out = one if out is None else out & one
        return out

    def __str__(self) -> str:
        return " and ".join(f"{STATISTICS[k]} {'>' if g else '<='} {c:.4g}" for k, g, c in self.terms)


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]

    def score(self, stats: Column) -> Column:
        """The score in [0, 1] as one column expression."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total += weight * rule.holds(x)
        return 1 / (1 + np.exp(-total))


def boosted_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, bins: int = 32, rate: float = 0.2, seed: int = 7) -> list[Rule]:
    """Distinct rules of all paths of boosted trees over quantile bins."""
    rng, n = np.random.default_rng(seed), len(y)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    total, rules = np.zeros(n), {}

    def grow(rows: np.ndarray, terms: tuple, g: np.ndarray, h: np.ndarray, columns: np.ndarray, left: int, out: np.ndarray) -> None:
        if terms:
            merged = {}
            for k, greater, cut in terms:  # the tightest bound of each side
                old = merged.get((k, greater))
                merged[k, greater] = cut if old is None else max(old, cut) if greater else min(old, cut)
            rules.setdefault(Rule(tuple(sorted((k, s, float(c)) for (k, s), c in merged.items()))))
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None, None)
        if left and len(rows) >= 20:
            for k in columns:
                if not len(cuts[k]):
                    continue
                size = len(cuts[k]) + 1
                below_g = np.cumsum(np.bincount(binned[rows, k], g[rows], size))[:-1]
                below_h = np.cumsum(np.bincount(binned[rows, k], h[rows], size))[:-1]
                gain = below_g**2 / (below_h + 1) + (sum_g - below_g) ** 2 / (sum_h - below_h + 1) - sum_g**2 / (sum_h + 1)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], int(k), at)
        if best[1] is None:
            out[rows] += -rate * sum_g / (sum_h + 1)
            return
        _, k, at = best
        low = binned[rows, k] <= at
        for part, greater in ((rows[low], False), (rows[~low], True)):
            grow(part, (*terms, (k, greater, cuts[k][at])), g, h, columns, left - 1, out)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        columns = rng.choice(x.shape[1], max(1, x.shape[1] * 2 // 3), replace=False)
        grow(np.arange(n), (), p - y, p * (1 - p), columns, depth, total)
    return list(rules)


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and L1-penalised weights by accelerated proximal gradient steps."""
    n, m = z.shape
    mean = z.mean(axis=0)
    z = z - mean
    step = 4.0 / max(np.linalg.norm(z, 2) ** 2 / n + 1, 1e-9)
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    v, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        residual = 1 / (1 + np.exp(-np.clip(z @ v + c, -35, 35))) - y
        new_w = v - step * (z.T @ residual) / n
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
        new_b = c - step * residual.mean()
        new_t = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return b - float(mean @ w), w


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> RuleModel:
    """The sparse rule ensemble for statistics x and labels y (0 or 1)."""
    if len(y) < 20 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(share / (1 - share))), (), ())
    rules = [r for r in boosted_rules(x, y) if 0.001 < r.holds(x).mean() < 0.999]
    seen, distinct = set(), []
    for r in rules:  # rules that hold on the same rows count once
        mark = np.packbits(r.holds(x)).tobytes()
        if mark not in seen:
            seen.add(mark)
            distinct.append(r)
    if not distinct:
        return fit_rules(x[:0], y[:0])
    intercept, weights = lasso_logistic(np.stack([r.holds(x) for r in distinct], axis=1).astype(float), y.astype(float), penalty)
    kept = np.flatnonzero(np.abs(weights) > 1e-4)
    return RuleModel(float(intercept), tuple(distinct[k] for k in kept), tuple(float(weights[k]) for k in kept))


def training_marks(labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, quality) of about train_rows labelled ids outside the held-out third (crc32 of the id's text mod 3 is 1)."""
    marks = labels.where("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    marks = marks.where(crc32_fold(F.col("doc_id")) != 1)
    share = min(1.0, train_rows / max(marks.count(), 1))
    return marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < math.ceil(1_000_000 * share))


def learn(described: DataFrame, marks: DataFrame, name: str) -> RuleModel:
    """Fit to the statistics (column `name`) of the rows of described whose doc_id is marked; marks: as training_marks gives them."""
    rows = described.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).alias("stats")).join(marks, "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("stats").alias("stats")).collect()  # as many rows as marks
    rows.sort(key=lambda r: (r.doc_id, r.stats))
    if not rows:
        return fit_rules(np.zeros((0, len(STATISTICS))), np.zeros(0))
    return fit_rules(np.array([r.stats for r in rows]), np.array([r.quality for r in rows], float))


def _free(docs: DataFrame, name: str) -> str:
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def quality_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, score, predicted) of every row; one pass over the texts."""
    described = keep(with_statistics(docs.select("doc_id", "text"), ["doc_id"], "stats"))
    model = learn(described, training_marks(labels, train_rows), "stats")
    scored = described.select("doc_id", model.score(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of docs that score at least the threshold, with their columns."""
    marks = keep(training_marks(labels, train_rows))
    marked = docs.select("doc_id", "text").join(maybe_broadcast(marks, 2 * train_rows, 16), "doc_id", "left_semi")
    model = learn(with_statistics(marked, ["doc_id"], "stats"), marks, "stats")
    name = _free(docs, "stats")
    scored = with_statistics(docs, docs.columns, name)
    return scored.where(model.score(F.col(name)) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = F.coalesce(crc32_fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return quality_scores(docs, labels).select("doc_id", held, "score", "predicted")
