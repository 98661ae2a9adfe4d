"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees are grown on statistics of labelled texts; every path from
a root to a node is a rule, a conjunction of comparisons. A logistic regression
with an L1 penalty weighs the rules and drops most. What is left is compiled
into one Spark column expression, so scoring is a projection over the
statistics: no join, no shuffle.

The fit uses at most ``max_rows`` labelled rows (20,000), those with the
smallest hash of doc_id among all that may be learned from. Statistics and
scores cover every text in full. Statistics are computed from the text alone,
a batch at a time.

Edge cases: a null or empty text has all statistics 0 and a score like any
other. Labels other than 0 and 1, null doc_ids and labels without a document
teach nothing; of several labels of a document the smallest counts. Without
labels the score is 0.5, with labels of one class it leans to that class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, fold_of, ship, slices, text_of

MAX_ROWS = 20_000
STATISTICS = (
    "log_bytes", "log_words", "word_length", "longest_word", "upper", "digit", "symbol", "stop", "non_ascii",
    "lines", "distinct", "top_word", "repeated", "symbol_words", "upper_words", "lone_symbols", "line_words")
_UPPER = np.arange(65, 91)
_DIGIT = np.arange(48, 58)
_STOP = np.array([ord(c) for c in ".,;:?'\"-"])
_SYMBOL = np.array([b for b in range(33, 127) if not chr(b).isalnum() and b not in _STOP])
_SYMBOL_BYTES = bytes(_SYMBOL.tolist())


def statistics_of(text: bytes) -> tuple[float, ...]:
    """The statistics of one text, in the order of STATISTICS."""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, count = len(words), np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    total = len(text)
    tally = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    repeated = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(w[-1] in _SYMBOL_BYTES for w in words)
    return (
        float(np.log1p(total)), float(np.log1p(n)), float(sizes.mean()), float(sizes.max()),
        count[_UPPER].sum() / total, count[_DIGIT].sum() / total, count[_SYMBOL].sum() / total,
        count[_STOP].sum() / total, count[128:].sum() / total, count[10] / n, len(tally) / n,
        max(tally.values()) / n, repeated / n, ends / n, sum(map(bytes.isupper, words)) / n,
        sum(tally.get(bytes([b]), 0) for b in _SYMBOL_BYTES) / n, n / (count[10] + 1))


def with_statistics(docs: DataFrame, *columns: str) -> DataFrame:
    """columns of docs and one double per statistic of its text (null: empty)."""
    ship(docs.sparkSession)
    taken = docs.select(*columns, F.coalesce(docs["text"], F.lit("")).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema if f.name != "_text")
    names = [f"_s_{s}" for s in STATISTICS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            table = np.array([statistics_of(t) for t in as_bytes(batch, "_text")], np.float64)
            table = table.reshape(batch.num_rows, len(STATISTICS))
            kept = [c for f, c in zip(batch.schema, batch.columns) if f.name != "_text"]
            yield pa.RecordBatch.from_arrays(
                kept + [pa.array(table[:, i]) for i in range(len(names))], names=[*columns, *names])

    return taken.mapInArrow(run, ", ".join([kinds, *(f"`{n}` double" for n in names)]))


Condition = tuple[int, bool, float]  # statistic, above (else at most), threshold


@dataclass
class RuleEnsemble:
    """Rules (conjunctions of conditions) with weights; score = logistic(intercept + sum of those that hold)."""

    intercept: float = 0.0
    rules: list[tuple[Condition, ...]] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def column(self) -> Column:
        """The score as a Spark column over the statistics' columns."""
        total = F.lit(float(self.intercept))
        for rule, weight in zip(self.rules, self.weights):
            holds = F.lit(True)
            for statistic, above, threshold in rule:
                value = F.col(f"_s_{STATISTICS[statistic]}")
                holds = holds & (value > threshold if above else value <= threshold)
            total = total + F.when(holds, float(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + rule_matrix(self.rules, x) @ np.array(self.weights, float))))


def rule_matrix(rules: list[tuple[Condition, ...]], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for statistic, above, threshold in rule:
            out[:, k] *= (x[:, statistic] > threshold) == above
    return out


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, bins: int = 32,
               rate: float = 0.3, least: float = 0.005) -> list[tuple[Condition, ...]]:
    """Paths of gradient-boosted trees (logistic loss), without those that hold for almost no or almost all rows."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], 1)  # value <= edges[code]
    margin = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    found: dict[tuple[Condition, ...], None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = y - p, p * (1 - p) + 1e-6
        leaves = [((), np.arange(len(y)))]
        for _ in range(depth):
            grown = []
            for path, rows in leaves:
                best = (1e-6, None)
                g, h = slope[rows], curve[rows]
                whole = g.sum() ** 2 / (h.sum() + 1)
                for j, e in enumerate(edges):
                    left = np.cumsum([np.bincount(code[rows, j], w, len(e) + 1) for w in (g, h)], axis=1)[:, :-1]
                    if not left.size:
                        continue
                    right = np.array([[g.sum()], [h.sum()]]) - left
                    gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - whole
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], (j, k))
                if best[1] is None:
                    continue
                j, k = best[1]
                low = code[rows, j] <= k
                for above, part in ((False, rows[low]), (True, rows[~low])):
                    rule = tuple(sorted((*path, (j, above, float(edges[j][k])))))
                    if least * len(y) <= len(part) <= (1 - least) * len(y):
                        found[rule] = None
                    if len(part):
                        margin[part] += rate / depth * slope[part].sum() / (curve[part].sum() + 1)
                        grown.append((rule, part))
            leaves = grown
    return list(found)


def fit_lasso(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on all but the intercept, by accelerated proximal gradient."""
    design = np.concatenate([np.ones((len(z), 1)), z], 1)
    v = np.ones(design.shape[1])
    for _ in range(20):  # largest eigenvalue, for the step
        v = design.T @ (design @ v)
        v /= np.linalg.norm(v)
    step = 4 * len(y) / max(np.linalg.norm(design @ v) ** 2, 1e-9)
    beta = np.zeros(design.shape[1])
    beta[0] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    ahead, t = beta.copy(), 1.0
    for _ in range(rounds):
        slope = design.T @ (1 / (1 + np.exp(-(design @ ahead))) - y) / len(y)
        new = ahead - step * slope
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - beta)
        beta, t = new, t_new
    return float(beta[0]), beta[1:]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 3e-4) -> RuleEnsemble:
    if not len(y):
        return RuleEnsemble()
    if y.min() == y.max():
        return RuleEnsemble(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    rules = grow_rules(x, y)
    intercept, weights = fit_lasso(rule_matrix(rules, x), y, penalty)
    kept = np.flatnonzero(weights)
    return RuleEnsemble(intercept, [rules[k] for k in kept], weights[kept].tolist())


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 3, held_out: int = 1,
          max_rows: int = MAX_ROWS) -> RuleEnsemble:
    """Fit on the labelled documents outside the held-out fold, max_rows of them at most."""
    sample = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
              .where(fold_of("doc_id", folds) != held_out)
              .groupBy("doc_id").agg(F.min(label).cast("double").alias("_label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = (with_statistics(text_of(docs).join(F.broadcast(sample), "doc_id"), "doc_id", "_label")  # max_rows small rows
            .orderBy(F.xxhash64("doc_id"), "doc_id", "_s_log_bytes").limit(max_rows).toPandas())
    return fit(rows[[f"_s_{s}" for s in STATISTICS]].to_numpy(float), rows["_label"].to_numpy(float))


def score(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """Per row: doc_id, score (0 to 1; higher: label 1 likelier)."""
    return with_statistics(text_of(docs), "doc_id").select("doc_id", model.column().alias("score"))


def keep_good(docs: DataFrame, model: RuleEnsemble, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, that score at least the threshold."""
    columns = [f"_c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*columns)
    text = columns[docs.columns.index("text")]
    scored = with_statistics(renamed.withColumn("text", F.col(text)), *columns)
    return scored.where(model.column() >= threshold).select(*columns).toDF(*docs.columns)
