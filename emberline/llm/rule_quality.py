"""Operator 4: quality by a sparse rule ensemble.

Statistics of each whole text are Spark columns.  Small boosted trees are grown on a bounded sample of labelled
rows; every path from a root becomes a rule, a conjunction of comparisons; lasso-penalised logistic regression
keeps few of the rules; and those are compiled to one Spark column expression, so scoring never leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .toxicity import held_out, labelled_sample

_SPACES = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"


def _count(chars: str) -> Column:
    """Characters of the text that are among ``chars``."""
    return F.length("text") - F.length(F.translate("text", chars, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``stats`` of doubles; null texts count as empty, whose shares are 0."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.withColumn("text", text)
    words = F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    d = d.withColumn("_w", words).withColumn("_l", lines)
    size, n, k = F.greatest(F.length("text"), F.lit(1)), F.greatest(F.size("_w"), F.lit(1)), F.greatest(F.size("_l"), F.lit(1))
    letters = size - _count(_SPACES)
    stats = {
        "log_words": F.log1p(F.size("_w")), "word_length": letters / n, "symbol_share": _count("#*$%&|<>{}[]\\^~@_=+") / size, "digit_share": _count("0123456789") / size,
        "upper_share": _count(_UPPER) / size, "exclaim_share": _count("!?") / n, "bar_share": _count("|") / n, "stop_share": _count(".,;:") / n,
        "distinct_words": F.size(F.array_distinct("_w")) / n, "same_as_before": F.size(F.filter(F.arrays_zip(F.slice("_w", F.lit(1), n - 1).alias("a"), F.slice("_w", F.lit(2), n - 1).alias("b")), lambda p: p.a == p.b)) / n,
        "distinct_lines": F.size(F.array_distinct("_l")) / k, "line_words": F.log1p(F.size("_w") / k),
    }
    return d.withColumn("stats", F.struct(*(c.cast("double").alias(x) for x, c in stats.items()))).drop("_w", "_l")


NAMES = ("log_words", "word_length", "symbol_share", "digit_share", "upper_share", "exclaim_share", "bar_share", "stop_share", "distinct_words", "same_as_before", "distinct_lines", "line_words")

#: A comparison (feature number, whether it is >, bound); a rule is a set of them.
Rule = frozenset[tuple[int, bool, float]]


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[tuple[Rule, float], ...]
    bias: float

    def score(self, stats: Column) -> Column:
        """The ensemble as one column over the struct ``stats``."""
        one = lambda c: stats[NAMES[c[0]]] > c[2] if c[1] else stats[NAMES[c[0]]] <= c[2]
        terms = [F.when(reduce(lambda a, b: a & b, map(one, sorted(rule))), w).otherwise(0.0) for rule, w in self.rules]
        z = reduce(lambda a, b: a + b, terms, F.lit(self.bias))
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))

    def score_rows(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule, w in self.rules:
            z += w * _holds(rule, x)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, bound in rule:
        out &= x[:, f] > bound if above else x[:, f] <= bound
    return out


def grow(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, bins: int = 32, rate: float = 0.3, least: int = 10, seed: int = 5) -> list[Rule]:
    """Paths of boosted regression trees on the residuals of the label, each tree on half of the rows."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)  # in bin k: at most cut k
    z, rules = np.full(len(x), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        residual, weight = y - p, p * (1 - p) + 1e-6
        half = np.flatnonzero(rng.random(len(x)) < 0.5)
        open_ = [(half, np.arange(len(x)), frozenset())]
        for _level in range(depth):
            below = []
            for rows, reach, path in open_:
                best = (1e-6, None)
                total, n = residual[rows].sum(), len(rows)
                for f, c in enumerate(cuts):
                    g = np.bincount(binned[rows, f], residual[rows], len(c) + 1).cumsum()[:-1]
                    m = np.bincount(binned[rows, f], minlength=len(c) + 1).cumsum()[:-1]
                    ok = (m >= least) & (n - m >= least)
                    if ok.any():
                        gain = np.where(ok, g**2 / np.maximum(m, 1) + (total - g) ** 2 / np.maximum(n - m, 1) - total**2 / n, 0)
                        if gain.max() > best[0]:
                            best = (gain.max(), (f, int(gain.argmax())))
                if best[1] is None:
                    continue
                f, k = best[1]
                for above in (False, True):
                    side = lambda r: r[(binned[r, f] > k) == above]  # noqa: E731, B023
                    rule = path | {(f, above, float(cuts[f][k]))}
                    rules[rule] = None
                    below.append((side(rows), side(reach), rule))
            open_ = below
        for rows, reach, _path in open_:
            z[reach] += rate * residual[rows].sum() / (weight[rows].sum() + 1)
    return list(rules)


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of logistic regression with an L1 penalty on the weights, by accelerated proximal gradient."""
    n, step = len(x), 4 / (np.linalg.norm(x, 2) ** 2 / len(x) + 1)
    w = v = np.zeros(x.shape[1])
    b = c = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    t = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(x @ v + c, -30, 30))) - y
        new = v - step * (x.T @ error / n)
        new, new_b = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0), c - step * error.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    return w, float(b)


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.001, most: int = 48) -> RuleModel:
    """Rules with the largest lasso weights, refitted; a constant score if a class is missing."""
    if len(y) == 0 or y.min() == y.max():
        return RuleModel((), 0.0 if len(y) == 0 else 4.0 if y.min() else -4.0)
    rules = grow(x, y)
    if not rules:
        return RuleModel((), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))))
    fires = np.stack([_holds(r, x) for r in rules], axis=1).astype(float)
    w, _ = lasso(fires, y, penalty)
    kept = np.argsort(-np.abs(w), kind="stable")[:most]
    kept = kept[w[kept] != 0]
    w, b = lasso(fires[:, kept], y, penalty / 4)
    return RuleModel(tuple((rules[k], float(v)) for k, v in zip(kept, w) if v), b)


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = 6000) -> RuleModel:
    """Fits on a bounded sample: the statistics of at most ``most`` labelled documents a class reach the driver."""
    rows = statistics(labelled_sample(docs, labels, "quality", most)).select("doc_id", "label", "stats.*").collect()
    rows.sort(key=tuple)
    return fit(np.array([r[2:] for r in rows], float).reshape(len(rows), len(NAMES)), np.array([r.label for r in rows], float))


def score_quality(docs: DataFrame, model: RuleModel) -> DataFrame:
    """Adds ``quality`` (0 to 1) to every row of ``docs`` from its whole text; null texts score as empty ones.

    Repeated rows stay, a column of the same name is replaced, an empty table stays empty.
    """
    kept = [c for c in docs.columns if c != "quality"]
    scored = statistics(docs.select(F.struct(*kept).alias("_row"), F.col("text")))
    return scored.select(*(F.col("_row")[c].alias(c) for c in kept), model.score(F.col("stats")).alias("quality"))


def op4_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), F.col("quality").alias("score"), (F.col("quality") >= 0.3).cast("int").alias("predicted"))
