"""Quality classifier: a sparse rule ensemble.

Statistics of the texts are native columns. Small boosted trees over them are only a source of
rules: each path from a root is a conjunction of thresholds. A lasso logistic regression
weighs the rules and sets most weights to zero; the rest becomes one Spark column expression,
so that scoring is a projection over the statistics.

The model is fitted on at most ``TRAINING_ROWS`` labelled rows, those with the smallest hashes
of their id (a documented bound; statistics and scores cover all rows).

Defined cases: a NULL text is an empty one, all its shares are 0; without any labelled row, or
with labels of one kind only, the score is the smoothed share of label 1 (one half for no rows).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import fold
from tallyloom.settings import written_table

FOLDS, HELD_OUT = 4, 2
GOOD = 0.7
TRAINING_ROWS = 20_000
TREES, DEPTH, BINS, SHRINK, LEAST_LEAF = 40, 3, 32, 0.3, 20
PENALTY, STEPS = 2e-3, 400

STATISTICS = (
    "log_chars", "bytes_per_char", "space_share", "line_share", "upper_share", "digit_share",
    "symbol_share", "decoration_share", "bang_share", "bar_share", "stop_share", "word_length",
    "distinct_words", "distinct_lines",
)


def statistics(text: Column) -> dict[str, Column]:
    """Native statistics of a text."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text)

    def share(count: Column, of: Column = chars) -> Column:
        return F.when(of > 0, count / of).otherwise(F.lit(0.0))

    def number(piece: str) -> Column:
        return chars - F.length(F.replace(text, F.lit(piece), F.lit("")))

    def matching(pattern: str) -> Column:
        return chars - F.length(F.regexp_replace(text, pattern, ""))

    spaces, lines = number(" "), number("\n")
    return {
        "log_chars": F.log1p(chars.cast("double")),
        "bytes_per_char": share(F.octet_length(text)),
        "space_share": share(spaces), "line_share": share(lines),
        "upper_share": share(matching("[A-Z]+")), "digit_share": share(matching("[0-9]+")),
        "symbol_share": share(matching(r"[^\p{L}\p{N}\s]+")),
        "decoration_share": share(matching("[%$*#&~^<>{}]+")),
        "bang_share": share(number("!")), "bar_share": share(number("|")),
        "stop_share": share(number(".") + number(",")),
        "word_length": share(chars, spaces + lines + 1),
        "distinct_words": share(F.size(F.array_distinct(F.split(text, " "))), spaces + 1),
        "distinct_lines": share(F.size(F.array_distinct(F.split(text, "\n"))), lines + 1),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, upper bound?, threshold): ``<=`` or ``>``."""

    terms: tuple[tuple[int, bool, float], ...]

    def holds(self, values: np.ndarray) -> np.ndarray:
        out = np.ones(len(values), dtype=bool)
        for place, below, threshold in self.terms:
            column = values[:, place]
            out &= column <= threshold if below else column > threshold
        return out

    def column(self) -> Column:
        out = None
        for place, below, threshold in self.terms:
            value = F.col(STATISTICS[place])
            term = value <= F.lit(threshold) if below else value > F.lit(threshold)
            out = term if out is None else out & term
        return out


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[float, Rule], ...]

    def column(self) -> Column:
        total = F.lit(self.bias)
        for weight, rule in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    def scores(self, values: np.ndarray) -> np.ndarray:
        total = np.full(len(values), self.bias)
        for weight, rule in self.rules:
            total += weight * rule.holds(values)
        return 1.0 / (1.0 + np.exp(-total))


def tree_rules(values: np.ndarray, labels: np.ndarray) -> list[Rule]:
    """The paths of small boosted trees, to inner nodes and leaves."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in values.T]
    places = np.stack([np.searchsorted(cut, column, side="left") for cut, column in zip(cuts, values.T)], axis=1)
    margin, rules = np.zeros(len(labels)), {}
    for _ in range(TREES):
        chance = 1.0 / (1.0 + np.exp(-margin))
        slope, curve = labels - chance, chance * (1.0 - chance)

        def grow(rows: np.ndarray, terms: tuple, depth: int) -> None:
            g, c = slope[rows].sum(), curve[rows].sum()
            best = (1e-3, None, None)
            if depth < DEPTH and len(rows) >= 2 * LEAST_LEAF:
                for place, cut in enumerate(cuts):
                    width = len(cut) + 1
                    where = places[rows, place]
                    left = np.cumsum(np.stack([
                        np.bincount(where, slope[rows], width), np.bincount(where, curve[rows], width),
                        np.bincount(where, minlength=width)]), axis=1)[:, :-1]
                    enough = (left[2] >= LEAST_LEAF) & (len(rows) - left[2] >= LEAST_LEAF)
                    gain = np.where(enough, left[0] ** 2 / (left[1] + 1) + (g - left[0]) ** 2 / (c - left[1] + 1)
                                    - g * g / (c + 1), 0.0)
                    if len(gain) and gain.max() > best[0]:
                        best = (gain.max(), place, int(gain.argmax()))
            _, place, at = best
            if place is None:
                margin[rows] += SHRINK * g / (c + 1)
                return
            below = places[rows, place] <= at
            for side, chosen in ((True, rows[below]), (False, rows[~below])):
                longer = (*terms, (place, side, float(cuts[place][at])))
                rules.setdefault(tuple(sorted(set(longer))), None)
                grow(chosen, longer, depth + 1)

        grow(np.arange(len(labels)), (), 0)
    return [Rule(terms) for terms in rules]


def lasso_logistic(features: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient steps; the bias is not penalized."""
    means = features.mean(axis=0)
    scale = np.sqrt(means * (1 - means))
    x = np.hstack([np.ones((len(labels), 1)), (features - means) / scale]).astype(np.float32)
    gram = x.T @ x / len(labels)
    step = 4.0 / float(np.linalg.eigvalsh(gram)[-1])
    weights = ahead = np.zeros(x.shape[1])
    momentum = 1.0
    for _ in range(STEPS):
        chance = 1.0 / (1.0 + np.exp(-(x @ ahead.astype(np.float32))))
        moved = ahead - step * (x.T @ (chance - labels).astype(np.float32)) / len(labels)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0.0)
        new[0] = moved[0]
        faster = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = new + (momentum - 1) / faster * (new - weights)
        weights, momentum = new, faster
    rule_weights = weights[1:] / scale
    return float(weights[0] - rule_weights @ means), rule_weights


def fit_rules(values: np.ndarray, labels: np.ndarray) -> RuleModel:
    share = (labels.sum() + 1) / (len(labels) + 2)
    alone = RuleModel(float(np.log(share / (1 - share))), ())
    if len(labels) < 2 * LEAST_LEAF or labels.min() == labels.max():
        return alone
    rules = tree_rules(values, labels)
    columns = [rule.holds(values) for rule in rules]
    seen: dict[bytes, Rule] = {}
    for rule, column in zip(rules, columns):  # of rules that hold for the same rows, the shortest
        if LEAST_LEAF // 2 <= column.sum() <= len(column) - LEAST_LEAF // 2:
            key = np.packbits(column).tobytes()
            if key not in seen or len(rule.terms) < len(seen[key].terms):
                seen[key] = rule
    if not seen:
        return alone
    rules = list(seen.values())
    bias, weights = lasso_logistic(np.stack([rule.holds(values) for rule in rules], axis=1).astype(np.float64), labels)
    return RuleModel(bias, tuple((float(w), rule) for w, rule in zip(weights, rules) if abs(w) > 1e-6))


def labelled_sample(measured: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most TRAINING_ROWS rows that may be learned from."""
    allowed = measured.where(~F.col("held_out"))
    known = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1))
    rows = (allowed.join(known, "doc_id")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *STATISTICS).limit(TRAINING_ROWS)
            .select("quality", *STATISTICS).toPandas())
    return rows[list(STATISTICS)].to_numpy(np.float64), rows["quality"].to_numpy(np.float64)


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of all documents (doc_id, text), learned from
    labels (doc_id, quality)."""
    measured = written_table(documents.select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        *[column.alias(name) for name, column in statistics(F.col("text")).items()]), "statistics")
    model = fit_rules(*labelled_sample(measured, labels))
    scored = measured.select("doc_id", "held_out", model.column().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= GOOD, 1).otherwise(0))
