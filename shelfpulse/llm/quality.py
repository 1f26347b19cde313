"""Quality scores from a sparse ensemble of rules.

Statistics of each text, taken in one pass over its bytes, are all that a score depends on. A
random forest over them is grown on labelled documents; every path from a root to a node becomes
a rule, a conjunction of bounds on statistics. A lasso-penalised logistic regression over the
rules leaves few with a weight. Those are compiled into one Spark column expression, so scoring
any table needs no model object and no Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfpulse.llm.common import Scratch, set_aside, text_parts, word_bounds
from shelfpulse.llm.naming import word_names

#: Labelled documents used for learning, at most: those with the smallest hash of their id.
MAX_LABELLED = 20_000
TREES = 24
DEPTH = 3
LASSO = 0.001
THRESHOLD = 0.3

STATISTICS = (
    "bytes", "words", "lines", "word_bytes", "longest_word", "upper", "digits", "stops",
    "commas", "loud", "symbols", "pipes", "foreign", "same_as_before", "distinct", "line_words",
    "symbol_words", "upper_words",
)
COLUMN = "_statistics"


def _class(characters: str) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[[ord(c) for c in characters]] = True
    return found


_UPPER, _DIGIT = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789")
_STOP, _COMMA, _LOUD, _PIPE = _class(".?"), _class(",;:"), _class("!"), _class("|")
_SYMBOL = _class("#$%&*@^~<>{}[]\\/_=+")
_FOREIGN = np.arange(256) >= 128


def measure(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """STATISTICS of every text, one row each. Shares are of bytes or words; an empty text has
    zeros."""

    def per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[edges[1:]] - sums[edges[:-1]]

    size = np.diff(begins)
    starts, ends, begin = word_bounds(data, begins)
    words = np.diff(begin)
    length = ends - starts
    names = word_names(data, starts, ends)
    text = np.repeat(np.arange(len(words)), words)
    same = np.zeros(len(names), dtype=bool)
    same[1:] = (names[1:] == names[:-1]) & (text[1:] == text[:-1])
    order = np.lexsort((names, text))
    new = np.ones(len(names), dtype=bool)
    new[1:] = (names[order][1:] != names[order][:-1]) | (text[order][1:] != text[order][:-1])
    longest = np.zeros(len(words), dtype=np.int64)
    np.maximum.at(longest, text, length)
    lines = per_text(data == 10, begins) + (size > 0)
    of_bytes, of_words = np.maximum(size, 1), np.maximum(words, 1)
    shares = [per_text(c[data], begins) / of_bytes for c in (_UPPER, _DIGIT, _STOP, _COMMA, _LOUD, _SYMBOL, _PIPE, _FOREIGN)]
    last = data[ends - 1] if len(ends) else data[:0]
    second = data[np.minimum(starts + 1, ends - 1)] if len(ends) else data[:0]
    columns = [
        size, words, lines, per_text(length, begin) / of_words, longest, *shares,
        per_text(same, begin) / of_words, per_text(new, begin) / of_words,
        words / np.maximum(lines, 1), per_text(_SYMBOL[last], begin) / of_words,
        per_text(_UPPER[second] & (length > 1), begin) / of_words,
    ]
    return np.stack([np.asarray(c, dtype=np.float64) for c in columns], axis=1)


def _measured(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, begins in text_parts(batch, "text"):
                rows = measure(data, begins)
                values = pa.ListArray.from_arrays(
                    np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), pa.array(rows.ravel())
                )
                part = batch.slice(low, high - low)
                columns = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, values], [*names, COLUMN])

    return run


def with_statistics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """`docs` (the columns `keep`) and the array of STATISTICS of its `text`; null is empty."""
    docs = docs.drop(COLUMN)
    keep = docs.columns if keep is None else keep
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{n}` {kinds[n]}" for n in keep), f"{COLUMN} array<double>"])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(_measured(keep), schema)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, whether at most, bound)


def tree_rules(forest: str) -> list[Rule]:
    """Every path from a root to a node below it, as a conjunction, from a forest's printed form.
    Bounds on one side of the same statistic are merged into the tighter one."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, bool, float]] = []
    for line in forest.splitlines():
        test = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-\d.Ee]+)\)", line)
        if line.lstrip().startswith("Tree "):
            path, root = [], None
        if not test:
            continue
        indent = len(test[1])
        root = indent if root is None else root
        path = path[: indent - root]
        path.append((int(test[2]), test[3] == "<=", float(test[4])))
        tight: dict[tuple[int, bool], float] = {}
        for statistic, most, bound in path:
            old = tight.get((statistic, most), bound)
            tight[statistic, most] = min(old, bound) if most else max(old, bound)
        found[tuple(sorted((s, m, b) for (s, m), b in tight.items()))] = None
    return list(found)


def rule_column(rule: Rule) -> Column:
    tests = [
        F.col(COLUMN)[s] <= F.lit(bound) if most else F.col(COLUMN)[s] > F.lit(bound)
        for s, most, bound in rule
    ]
    met = tests[0]
    for test in tests[1:]:
        met = met & test
    return met.cast("double")


@dataclass(frozen=True)
class RuleEnsemble:
    """Rules with a weight, and the score where none is met."""

    intercept: float
    rules: tuple[tuple[float, Rule], ...]

    def score(self) -> Column:
        """The probability of label 1, over a table that has the statistics."""
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            total = total + F.lit(weight) * rule_column(rule)
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        """One line per rule, heaviest first."""
        def text(rule: Rule) -> str:
            return " and ".join(f"{STATISTICS[s]} {'<=' if m else '>'} {b:g}" for s, m, b in rule)

        return [f"{w:+.3f}  {text(r)}" for w, r in sorted(self.rules, key=lambda x: -abs(x[0]))]


def training_fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether labels of a row may be learned from; a null id has no fold and no label."""
    return F.crc32(F.col(doc_id).cast("string")) % folds != 0


def fit(
    measured: DataFrame, labels: DataFrame, scratch: Scratch, max_labelled: int = MAX_LABELLED
) -> RuleEnsemble:
    """Learn from `measured` (doc_id and statistics) and `labels` (doc_id, quality).

    Only labelled rows of the training fold are used, at most `max_labelled`. Labels that are
    null or neither 0 nor 1 are ignored; of several labels of a document the smallest counts.
    Without labels every score is 0.5; with one kind of label it is that label.
    """
    labels = labels.filter("quality IN (0, 1)").filter(training_fold())
    labels = labels.groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    sample = (
        measured.select("doc_id", COLUMN).join(labels, "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", COLUMN).limit(max_labelled)
        .select("label", COLUMN)
    )
    sample = scratch.table(sample.coalesce(4), "labelled")
    low, high = sample.agg(F.min("label"), F.max("label")).first()
    if low == high:
        return RuleEnsemble({1.0: 50.0, 0.0: -50.0, None: 0.0}[low], ())
    rows = sample.select("label", array_to_vector(COLUMN).alias("features"), COLUMN).cache()
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="sqrt", seed=7, maxBins=64
    ).fit(rows)
    rules = tree_rules(forest.toDebugString)
    met = array_to_vector(F.array(*map(rule_column, rules))).alias("features")
    ruled = rows.select("label", met).cache()
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=60).fit(ruled)
    rows.unpersist()
    ruled.unpersist()
    weights = lasso.coefficients.toArray()
    kept = tuple((float(w), r) for w, r in zip(weights, rules, strict=True) if w)
    return RuleEnsemble(float(lasso.intercept), kept)


def classify(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, whatever its id: rows with equal doc_id
    are scored each by its own text, and in learning each counts with the label of the id.
    Further columns are left out."""
    measured = scratch.table(with_statistics(docs, ["doc_id"]), "statistics")
    model = fit(measured, labels, scratch)
    return measured.select(
        "doc_id",
        F.coalesce(~training_fold(), F.lit(False)).alias("held_out"),
        model.score().alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of `docs` whose score reaches the threshold, with all their columns as they are.
    Rows with equal doc_id are scored each by its own text."""
    docs, back = set_aside(docs)
    measured = scratch.table(with_statistics(docs), "statistics")
    model = fit(measured, labels, scratch)
    return back(measured.filter(model.score() >= THRESHOLD))
