"""Quality classifier: a sparse rule ensemble.

Statistics of a text are Spark columns. On a bounded sample of labelled rows (``SAMPLE`` rows, the first by a hash of doc_id),
boosted trees of depth 3 propose rules: every path from a root to a node is a conjunction of comparisons. Logistic regression
with a lasso penalty weighs the rules and leaves most of them at 0; the rest are compiled into one column expression. So learning
costs the same at every size and scoring is a single pass inside code generation, without Python.

Neither labels nor doc_id, lang or source enter a score.

Defined cases: a null or empty text has statistics 0 and a score like any other; rows of ``labels`` without id or label are left
out; without labels every score is 0.5, with one class only it is that class's smoothed share; equal rows get equal scores; an
empty table gives no rows; only doc_id, text and the label column are read, whatever other columns there are.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, table

#: Labelled rows that the driver learns from at most.
SAMPLE = 20_000


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a text, by name."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.split(F.trim(t), r"\s+")
    n_words = F.size(words).cast("double")
    lines = F.split(t, "\n")

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, ""))

    def count(mark: str) -> Column:
        return F.length(t) - F.length(F.replace(t, F.lit(mark), F.lit("")))

    return {
        "log_chars": F.log1p(F.length(t).cast("double")),
        "word_length": n / n_words,
        "upper": left(r"[^\p{Lu}]+") / n,
        "digits": left(r"[^0-9]+") / n,
        "symbols": left(r"[\p{L}\p{N}\s.,;:'\"()?-]+") / n,
        "doubled_symbols": F.regexp_count(t, F.lit(r"[^\p{L}\p{N}\s][^\p{L}\p{N}\s]+")) / n_words,
        "stops": count(".") / n_words,
        "commas": count(",") / n_words,
        "bars": count("|") / n_words,
        "shouts": count("!") / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "line_words": n_words / F.size(lines),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
    }


@dataclass
class Rules:
    """Conjunctions of (statistic, is at most, threshold), their weights, and the intercept."""

    intercept: float = 0.0
    terms: list[tuple[tuple[tuple[str, bool, float], ...], float]] = field(default_factory=list)

    def column(self) -> Column:
        """The score, over columns named as the statistics are."""
        def rule(parts: tuple) -> Column:
            return reduce(lambda a, b: a & b, [F.col(f"stats.{f}") <= x if below else F.col(f"stats.{f}") > x for f, below, x in parts])

        total = reduce(lambda a, b: a + b, [F.when(rule(p), F.lit(w)).otherwise(F.lit(0.0)) for p, w in self.terms], F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))

    def score(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        """The same over arrays."""
        z = np.full(n, self.intercept)
        for parts, w in self.terms:
            z += w * _holds(parts, x, n)
        return 1 / (1 + np.exp(-z))


def _holds(parts: tuple, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for f, below, at in parts:
        out &= x[f] <= at if below else x[f] > at
    return out


def _split(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, n_bins: int, least: float) -> tuple[float, int, int]:
    """The best cut (gain, feature, bin) of one node; rows go left up to that bin."""
    best = (1e-9, -1, -1)
    g, h = grad.sum(), hess.sum()
    for f in range(bins.shape[1]):
        gl = np.cumsum(np.bincount(bins[:, f], grad, n_bins))[:-1]
        hl = np.cumsum(np.bincount(bins[:, f], hess, n_bins))[:-1]
        gain = np.where((hl >= least) & (h - hl >= least), gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1), 0)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, k)
    return best


def propose(x: dict[str, np.ndarray], y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3) -> list[tuple]:
    """Rules from the paths of boosted trees."""
    names = list(x)
    cuts = [np.unique(np.quantile(x[f], np.linspace(0, 1, 65)[1:-1])) for f in names]
    bins = np.stack([np.searchsorted(c, x[f], "left") for c, f in zip(cuts, names, strict=True)], axis=1)
    margin, rules = np.full(y.size, np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        nodes = [((), np.arange(y.size))]
        for level in range(depth + 1):
            grown = []
            for path, rows in nodes:
                gain, f, k = _split(bins[rows], grad[rows], hess[rows], 66, 1.0) if level < depth else (0, -1, -1)
                if f < 0 or k >= len(cuts[f]):
                    margin[rows] += rate * grad[rows].sum() / (hess[rows].sum() + 1)
                    continue
                below = bins[rows, f] <= k
                for side, part in ((True, rows[below]), (False, rows[~below])):
                    longer = (*path, (names[f], side, float(cuts[f][k])))
                    rules[longer] = None
                    grown.append((longer, part))
            nodes = grown
    return list(rules)


def lasso(rules: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of logistic regression with an L1 penalty, by accelerated proximal gradient."""
    n, m = rules.shape
    a = np.concatenate([np.ones((n, 1)), rules], axis=1)
    v = np.ones(m + 1) / np.sqrt(m + 1)
    for _ in range(20):
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    step = 4 * n / float(v @ (a.T @ (a @ v)))
    w = np.zeros(m + 1)
    w[0] = np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    old, t, at = w, 1.0, w
    for _ in range(steps):
        new = at - step * (a.T @ (1 / (1 + np.exp(-(a @ at))) - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        at, old = new + (last - 1) / t * (new - old), new
    return float(old[0]), old[1:]


def fit_arrays(x: dict[str, np.ndarray], y: np.ndarray, penalty: float = 5e-4) -> Rules:
    if y.size == 0:
        return Rules()
    if y.min() == y.max():
        p = (y.sum() + 1) / (y.size + 2)
        return Rules(float(np.log(p / (1 - p))))
    proposed = propose(x, y)
    held = np.stack([_holds(r, x, y.size) for r in proposed], axis=1).astype(float) if proposed else np.zeros((y.size, 0))
    _, one = np.unique(held, axis=1, return_index=True) if held.size else (None, np.zeros(0, int))
    one = np.sort(one)
    intercept, weights = lasso(held[:, one], y, penalty)
    return Rules(intercept, [(proposed[k], float(w)) for k, w in zip(one.tolist(), weights, strict=True) if w != 0])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, sample: int = SAMPLE) -> Rules:
    """Learn from labelled rows whose crc32(doc_id) mod ``folds`` is not ``held_out``, at most ``sample`` of them."""
    ids = F.col("doc_id").cast("long")
    known = (labels.select(ids.alias("doc_id"), F.col(label).cast("double").alias("y")).dropna()
             .filter(crc_mod(F.col("doc_id"), folds) != held_out).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample))
    text = docs.select(ids.alias("doc_id"), F.col("text").cast("string").alias("text"))
    stats = statistics(F.col("text"))
    # the sample's size is the bound of this broadcast
    rows = text.join(F.broadcast(known), "doc_id").select(
        "doc_id", F.struct("y", *(c.cast("double").alias(k) for k, c in stats.items())).alias("row"))
    # one row for each id, the same on every run
    got = rows.groupBy("doc_id").agg(F.min("row").alias("row")).select("doc_id", "row.*").orderBy("doc_id").toPandas()
    return fit_arrays({k: got[k].to_numpy(float) for k in stats}, (got["y"].to_numpy(float) > 0.5).astype(float))


def score(docs: DataFrame, rules: Rules) -> DataFrame:
    """``docs`` with a column ``stats`` (a struct) and the column ``score``."""
    stats = F.struct(*(c.cast("double").alias(k) for k, c in statistics(F.col("text")).items()))
    # The explode of one element stops a filter on the score from being pushed below and computing the statistics rule by rule.
    return docs.withColumn("stats", stats).withColumn("stats", F.explode(F.array("stats"))).withColumn("score", rules.column())


def op7_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, rules).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
