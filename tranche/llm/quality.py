"""Document quality by a sparse ensemble of rules over text statistics.

Shallow trees are grown on statistics of labelled texts; every path from a root to a node is a rule,
a conjunction of comparisons. A logistic regression with an L1 penalty weighs the rules, and those of
weight zero fall away. The rest is compiled into one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tranche.llm import words as W
from tranche.llm.frames import fresh, with_columns
from tranche.llm.labelled import balanced, training_sample

#: Labelled documents of each class to learn from, at most.
PER_CLASS = 8_000
TREES = 24
DEPTH = 3
PENALTY = 0.002
SEED = 42

STATISTICS = (
    "words", "mean_word", "distinct_share", "top_share", "repeat_share", "phrase_share", "upper_share",
    "digit_share", "symbol_share", "mark_share", "shout_share", "wide_share", "line_words", "line_repeat_share",
)
# ASCII characters of ordinary prose, besides letters, digits and white space
MARKS = b".,;:'\"?!-()"


def _is(chars: bytes) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(chars, np.uint8))


UPPER, DIGIT = _is(bytes(range(65, 91))), _is(bytes(range(48, 58)))
LETTER = _is(bytes(range(65, 91)) + bytes(range(97, 123)))
MARK, SHOUT, WIDE = _is(MARKS), _is(b"!"), np.arange(256) >= 128
SYMBOL = ~(LETTER | DIGIT | MARK | WIDE | W.SPACES) & (np.arange(256) > 32)
LINES = _is(b"\n")


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def per_document(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many of each document's flags are set."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[starts[1:]] - sums[starts[:-1]]


def distinct_of(doc: np.ndarray, value: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different values each document has, and how often its most frequent one occurs."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(doc)))
    most = np.zeros(count, np.int64)
    np.maximum.at(most, doc[first], size)
    return np.bincount(doc[first], minlength=count), most


def statistics(piece: W.Piece) -> list[np.ndarray]:
    """The STATISTICS of each document of a piece (letters not lowered)."""
    count, data, starts = len(piece.starts) - 1, piece.data, piece.starts
    found, lines = W.words(piece, W.SPACES), W.words(piece, LINES)
    words = np.diff(found.starts)
    solid = per_document(~W.SPACES[data], starts)
    distinct, most = distinct_of(found.doc, found.hash, count)
    same = np.zeros(len(found.doc), bool)
    same[1:] = (found.hash[1:] == found.hash[:-1]) & (found.doc[1:] == found.doc[:-1])
    phrases = W.shingles(found, 3)[0]
    n_lines = np.diff(lines.starts)
    distinct_lines, _ = distinct_of(lines.doc, lines.hash, count)
    chars = [per_document(flag[data], starts) for flag in (UPPER, LETTER, DIGIT, SYMBOL, MARK, SHOUT, WIDE)]
    upper, letter, digit, symbol, mark, shout, wide = chars
    return [
        words.astype(float), share(solid, words), share(distinct, words), share(most, words),
        share(per_document(same, found.starts), words),
        share(np.bincount(phrases, minlength=count), words - 2), share(upper, letter), share(digit, solid),
        share(symbol, solid), share(mark, solid), share(shout, words), share(wide, solid), share(words, n_lines),
        share(n_lines - distinct_lines, n_lines),
    ]


def measured(documents: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add the statistics as doubles; their names are returned."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        parts = [statistics(p) for p in W.pieces(batch.column("text"), lower=False)]
        return [pa.array(np.concatenate(x), pa.float64()) for x in zip(*parts)]

    return with_columns(documents, ", ".join(f"{s} double" for s in STATISTICS), compute)


Rule = tuple[tuple[int, bool, float], ...]


@dataclass
class Ensemble:
    """Rules (statistic, whether at most or more, bound), their weights, and the intercept."""

    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self, columns: list[str]) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, columns), F.lit(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: Rule, columns: list[str]) -> Column:
    condition = F.lit(True)
    for at, low, bound in rule:
        column = F.col(columns[at])
        condition = condition & ((column <= bound) if low else (column > bound))
    return condition


def paths(tree) -> set[Rule]:
    """The rules of a fitted tree: of each comparison along a path the tightest."""
    found: set[Rule] = set()

    def walk(node, bounds: dict[tuple[int, bool], float]) -> None:
        if bounds:
            found.add(tuple(sorted((at, low, bound) for (at, low), bound in bounds.items())))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        at, bound = split.featureIndex(), split.threshold()
        for child, low in ((node.leftChild(), True), (node.rightChild(), False)):
            known = bounds.get((at, low), bound)
            walk(child, {**bounds, (at, low): min(known, bound) if low else max(known, bound)})

    walk(tree._call_java("rootNode"), {})
    return found


def learn(documents: DataFrame, labels: DataFrame, usable: Column, per_class: int = PER_CLASS) -> Ensemble:
    """An ensemble from labelled documents for which ``usable`` (a condition on ``labels``) holds, at
    most ``per_class`` of each class. With labels of one class only, or none, there are no rules.
    """
    sample = balanced(training_sample(documents, labels, "quality", usable, per_class))
    classes = [r[0] for r in sample.select("label").distinct().collect()]
    if len(classes) < 2:
        return Ensemble({(): 0.0, (1.0,): 4.0, (0.0,): -4.0}[tuple(classes)], [])
    rows, names = measured(sample)
    rows = VectorAssembler(inputCols=names, outputCol="statistics").transform(rows)
    rows = rows.select("label", "weight", "statistics", *names).cache()
    forest = RandomForestClassifier(
        featuresCol="statistics", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, bootstrap=False,
        featureSubsetStrategy="sqrt", minInstancesPerNode=10, seed=SEED,
    ).fit(rows)
    rules = sorted(set().union(*(paths(t) for t in forest.trees)))
    if not rules:
        rows.unpersist()
        return Ensemble(0.0, [])
    flags = [holds(rule, names).cast("double").alias(f"rule{k}") for k, rule in enumerate(rules)]
    applied = VectorAssembler(inputCols=[f"rule{k}" for k in range(len(rules))], outputCol="rules").transform(
        rows.select("label", "weight", *flags)
    )
    applied = applied.select("label", "weight", "rules").cache()
    lasso = LogisticRegression(
        featuresCol="rules", weightCol="weight", elasticNetParam=1.0, regParam=PENALTY, standardization=False,
        maxIter=100,
    ).fit(applied)
    rows.unpersist()
    applied.unpersist()
    weights = lasso.coefficients.toArray()
    return Ensemble(
        float(lasso.intercept), [(rule, float(w)) for rule, w in zip(rules, weights) if abs(w) > 1e-9]
    )


def scored(documents: DataFrame, ensemble: Ensemble) -> tuple[DataFrame, str]:
    """Add the score (0 to 1; name returned). A null text is an empty one, whose statistics are all 0;
    repeated rows are scored each; a column of the same name stays and the new one gets an underscore.
    """
    rows, names = measured(documents)
    name = fresh("score", documents.columns)
    return rows.withColumn(name, ensemble.score(names)).drop(*names), name
