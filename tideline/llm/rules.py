"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown over statistics of labelled texts. Every path from a root to
a node becomes a rule, a conjunction of comparisons. A lasso logistic regression keeps the few
rules that matter, and these are compiled to one Spark column, so that scoring is a
projection over the table.

The fit uses at most ``max_rows`` labelled rows (a documented bound), chosen by a hash of their ids
among all of them; statistics and scores are computed for every whole text.

Defined cases: a null text is scored as an empty one. A label that is null, or of an id that no
document has, is not used. Several labels of one id count as several rows. Without labels every score is
0.5; with labels of one class only, it is that class's smoothed rate. Repeated
documents are scored each. Extra columns are kept by ``score_documents``, but for ``score`` and ``predicted``. Names that
start with an underscore are the operator's own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import remainder, text_of

MAX_ROWS = 20_000
THRESHOLD = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; all are defined for an empty one."""
    words = F.col("_words")

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    n_chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    lines = F.split(text, "\n")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")
    return {
        "log_chars": F.log1p(F.length(text).cast("double")),
        "mean_word": n_chars / n_words,
        "words_per_line": n_words / n_lines,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "upper": count(r"\p{Lu}") / n_chars,
        "digits": count("[0-9]") / n_chars,
        "symbols": count(r"[#$%&*@^~<>{}\[\]\\=+_]") / n_chars,
        "exclaim": count("[!?]") / n_words,
        "bars": count(r"\|") / n_words,
        "stops": count(r"[.](?=\s|$)") / n_words,
        "commas": count(",") / n_words,
        "short_words": count(r"(?<!\S)\S{1,3}(?!\S)") / n_words,
        "long_words": count(r"\S{16,}") / n_words,
        "same_again": count(r"(?<!\S)(\S{1,60})(?=\s\1(?!\S))") / n_words,
        "other_marks": count(r"[^\p{L}\p{N}\s.,!?|#$%&*@^~<>{}\[\]\\=+_]") / n_chars,
    }


def with_statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with one column of statistics, the array ``_stats``."""
    text = F.col("_text")
    stats = statistics(text)
    with_text = docs.withColumn("_text", text_of(text_col)).withColumn("_words", F.regexp_extract_all("_text", F.lit(r"(\S+)")))
    return with_text.withColumn("_stats", F.array(*stats.values())).drop("_text", "_words"), list(stats)


@dataclass
class Node:
    rows: np.ndarray
    path: tuple[tuple[int, float, bool], ...] = ()
    value: float = 0.0


@dataclass
class RuleModel:
    """``rules`` are conjunctions of (statistic, cut, above); ``weights`` their logistic weights."""

    names: list[str]
    bias: float
    rules: list[tuple[tuple[int, float, bool], ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def column(self, stats: Column) -> Column:
        """The probability of label 1 as a Spark column over the array of statistics."""
        terms = [F.lit(self.bias)]
        terms += [F.when(_condition(r, stats), w).otherwise(0.0) for r, w in zip(self.rules, self.weights, strict=True)]
        while len(terms) > 1:  # a balanced sum keeps the expression shallow
            terms = [a + b for a, b in zip(terms[::2], terms[1::2], strict=False)] + ([terms[-1]] if len(terms) % 2 else [])
        return 1.0 / (1.0 + F.exp(-terms[0]))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.bias + _fires(self.rules, x) @ np.asarray(self.weights, float).reshape(-1))


def _condition(rule, stats: Column) -> Column:
    out = None
    for i, cut, above in rule:
        test = stats[i] > cut if above else stats[i] <= cut
        out = test if out is None else out & test
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _fires(rules, x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for i, cut, above in rule:
            out[:, j] *= (x[:, i] > cut) if above else (x[:, i] <= cut)
    return out


def _split(codes: np.ndarray, grad: np.ndarray, hess: np.ndarray, n_bins: int, least: int):
    """The best (gain, statistic, bin) of a node; None if nothing gains."""
    g, h = grad.sum(), hess.sum()
    best = None
    for i in range(codes.shape[1]):
        gs = np.bincount(codes[:, i], grad, n_bins).cumsum()[:-1]
        hs = np.bincount(codes[:, i], hess, n_bins).cumsum()[:-1]
        ns = np.bincount(codes[:, i], minlength=n_bins).cumsum()[:-1]
        gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
        gain = np.where((ns >= least) & (len(grad) - ns >= least), gain, 0)
        k = int(gain.argmax())
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = (gain[k], i, k)
    return best


def extract_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, n_bins: int = 64, least: int = 5):
    """Grow boosted trees; return the distinct paths to all their nodes."""
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, n_bins + 1)[1:-1])) for i in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)], axis=1)
    score = np.full(len(y), math.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    rules: dict[tuple, None] = {}
    for _ in range(trees):
        p = _sigmoid(score)
        grad, hess = y - p, p * (1 - p)
        level = [Node(np.arange(len(y)))]
        leaves = []
        for _ in range(depth):
            below = []
            for node in level:
                r = node.rows
                found = _split(codes[r], grad[r], hess[r], n_bins, least)
                if found is None:
                    leaves.append(node)
                    continue
                _, i, k = found
                goes_up = codes[r, i] > k
                for above, rows in ((False, r[~goes_up]), (True, r[goes_up])):
                    child = Node(rows, (*node.path, (i, float(cuts[i][k]), above)))
                    rules[child.path] = None
                    below.append(child)
            level = below
        for node in leaves + level:
            r = node.rows
            score[r] += rate * grad[r].sum() / (hess[r].sum() + 1)
    return list(rules)


def lasso(features: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty, by accelerated proximal gradient."""
    n, m = features.shape
    mean = features.mean(axis=0)

    def times(w: np.ndarray) -> np.ndarray:  # the centred features are never written out
        return features @ w - mean @ w

    def back(e: np.ndarray) -> np.ndarray:
        return features.T @ e - mean * e.sum()

    v = np.full(m, 1 / math.sqrt(max(m, 1)))
    for _ in range(20):  # the largest eigenvalue gives the step
        v = back(times(v))
        v /= max(np.linalg.norm(v), 1e-12)
    step = 4 / max(float(np.sum(times(v) ** 2)) / n * 1.1 + 1, 1e-9)
    w, bias = np.zeros(m), math.log((y.sum() + 1) / (n - y.sum() + 1))
    look, look_bias, t = w.copy(), bias, 1.0
    for _ in range(steps):
        err = _sigmoid(look_bias + times(look)) - y
        new = look - step * back(err) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_bias = look_bias - step * err.mean()
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look = new + (t - 1) / t_next * (new - w)
        look_bias = new_bias + (t - 1) / t_next * (new_bias - bias)
        w, bias, t = new, new_bias, t_next
    return float(bias - mean @ w), w


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str], penalty: float = 3e-4) -> RuleModel:
    if len(y) == 0:
        return RuleModel(names, 0.0)
    prior = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    if y.min() == y.max():
        return RuleModel(names, prior)
    rules = extract_rules(x, y)
    if not rules:
        return RuleModel(names, prior)
    bias, weights = lasso(_fires(rules, x), y, penalty)
    kept = np.flatnonzero(np.abs(weights) > 1e-6)
    return RuleModel(names, bias, [rules[i] for i in kept], [float(weights[i]) for i in kept])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, label: str = "quality", penalty: float = 3e-4) -> RuleModel:
    """Fit on labelled documents whose id is not held out."""
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(5) != 0))
    n = usable.count()
    scale = 1_000_003
    keep = scale if n <= max_rows else int(scale * max_rows / n * 0.97)
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(scale)) < keep)
    chosen = chosen.select("doc_id", F.col(label).cast("double").alias("_y"))
    # at most max_rows pairs of numbers, up to the hash's spread
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    frame, names = with_statistics(texts)
    rows = frame.select("doc_id", "_stats", "_y").orderBy("doc_id", "_y", "_stats").toArrow()
    x = rows.column("_stats").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, len(names))
    return fit_rules(x, rows.column("_y").to_numpy(), names, penalty)


def score_documents(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``."""
    frame, _ = with_statistics(docs)
    scored = frame.withColumn("score", model.column(F.col("_stats"))).drop("_stats")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op3_rules(spark, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from ``labels``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")
