"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees grown on labelled statistics are taken apart into paths; each path is a conjunctive rule. A lasso logistic
fit weighs the rules and drops most. What is left is one Spark column expression over the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrydesk.llm.words import Words, slices, text_bytes
from quarrydesk.session import write_out

#: Labelled texts that rules are fitted on, at most: the bound of the training sample.
SAMPLE_ROWS = 20_000
TREES, DEPTH, LASSO = 20, 4, 0.002

STATISTICS = ["n_chars", "n_words", "word_length", "upper", "digits", "symbols", "pipes", "bangs", "stops", "non_ascii",
              "line_words", "distinct_words", "symbol_words", "short_words", "repeated_lines"]


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars.encode())] = True
    return out


_CLASSES = {
    "upper": _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _class("0123456789"), "symbols": _class("#$%&*@^~<>{}[]\\/=+_|"),
    "pipes": _class("|"), "bangs": _class("!?"), "stops": _class(".,;:"), "non_ascii": np.arange(256) >= 0x80}


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(flags))[bounds])


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` for each whole text; shares of nothing are 0."""
    data, offsets = text_bytes(column)
    words = Words(data, offsets)
    hashes, counts, text = words.hashes(lower=True), words.counts, words.text_of()
    width = words.ends - words.starts
    chars, n = np.maximum(np.diff(offsets), 1), np.maximum(counts, 1)
    out = {"n_chars": np.diff(offsets), "n_words": counts, "word_length": _sums(width, words.first) / n}
    for name, members in _CLASSES.items():
        out[name] = _sums(members[data], offsets) / chars
    out["line_words"] = counts / (_sums(data == 0x0A, offsets) + 1)
    order = np.lexsort((hashes, text))
    same = np.append(False, (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1]))
    out["distinct_words"] = 1 - np.bincount(text[order], weights=same[:len(order)], minlength=len(counts)) / n
    last = data[words.ends - 1] if len(words.ends) else data[:0]
    out["symbol_words"] = _sums(_CLASSES["symbols"][last], words.first) / n
    out["short_words"] = _sums(width <= 2, words.first) / n
    grams, at = words.grams(hashes, 4)
    owner = text[at] if len(at) else at
    order = np.lexsort((grams, owner))
    same = np.append(False, (grams[order][1:] == grams[order][:-1]) & (owner[order][1:] == owner[order][:-1]))
    out["repeated_lines"] = np.bincount(owner[order], weights=same[:len(order)], minlength=len(counts)) / n
    return np.stack([out[name].astype(np.float64) for name in STATISTICS], axis=1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch):
            rows = statistics(piece.column(1))
            yield pa.RecordBatch.from_arrays([piece.column(0), *map(pa.array, rows.T)], names=["doc_id", *STATISTICS])


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of each whole text; a null text counts as an empty one."""
    ddl = "doc_id long, " + ", ".join(f"{name} double" for name in STATISTICS)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _measure, ddl)


Condition = tuple[str, bool, float]


@dataclass(frozen=True)
class RuleModel:
    """Weighted conjunctions of (statistic, is at most, threshold), and what holds without any rule."""

    rules: list[tuple[frozenset[Condition], float]]
    intercept: float

    def score(self) -> Column:
        """Probability of quality 1 over the columns of ``with_statistics``."""
        margin = reduce(lambda total, rule: total + F.when(condition(rule[0]), rule[1]).otherwise(0.0), self.rules,
                        F.lit(float(self.intercept)))
        return 1 / (1 + F.exp(-margin))


def condition(rule: frozenset[Condition]) -> Column:
    tests = [F.col(name) <= value if most else F.col(name) > value for name, most, value in sorted(rule)]
    return reduce(lambda a, b: a & b, tests)


def tree_rules(node, path: tuple[Condition, ...] = ()) -> Iterator[frozenset[Condition]]:
    """Every path from the root of a fitted tree to a node below it, with redundant bounds merged."""
    if path:
        tight: dict[tuple[str, bool], float] = {}
        for name, most, value in path:
            held = tight.get((name, most), value)
            tight[name, most] = min(held, value) if most else max(held, value)
        yield frozenset((name, most, value) for (name, most), value in tight.items())
    if node.numDescendants():
        name, value = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
        yield from tree_rules(node.leftChild(), (*path, (name, True, value)))
        yield from tree_rules(node.rightChild(), (*path, (name, False, value)))


def fit_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = 11, id_col: str = "doc_id",
              text_col: str = "text", label_col: str = "quality") -> RuleModel:
    """Grow trees and weigh their paths on about ``sample_rows`` labelled texts, chosen by a hash of the id.

    Rows whose id or label is null, or whose label is not 0 or 1, teach nothing, and an id with both labels teaches
    both. With one class or none the model has no rules and scores that class's share (1/2 without labels).
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label")).where(
        "doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    total = known.count()
    if total > sample_rows:
        known = known.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < int(sample_rows / total * (1 << 30)))
    # the ids are at most about sample_rows, so they travel to the texts
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(known), "doc_id")
    measured = with_statistics(picked.select("doc_id", "text")).distinct().join(known, "doc_id")
    table = write_out(VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(measured).coalesce(4), "quality")
    counts = {r["label"]: r["n"] for r in table.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        share = 0.5 if not counts else min(max(next(iter(counts)), 1e-6), 1 - 1e-6)
        return RuleModel([], float(np.log(share / (1 - share))))
    table = table.cache()
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="onethird",
                                    labelCol="label", cacheNodeIds=False).fit(table)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree._call_java("rootNode"))},
                   key=lambda rule: sorted(rule))
    columns = [condition(rule).cast("double").alias(f"rule_{k}") for k, rule in enumerate(rules)]
    fired = VectorAssembler(inputCols=[f"rule_{k}" for k in range(len(rules))], outputCol="fired").transform(
        table.select("label", *columns)).select("label", "fired").cache()
    lasso = LogisticRegression(featuresCol="fired", labelCol="label", regParam=LASSO, elasticNetParam=1.0, maxIter=100,
                               standardization=False).fit(fired)
    fired.unpersist()
    table.unpersist()
    weights = lasso.coefficients.toArray()
    return RuleModel([(rule, float(w)) for rule, w in zip(rules, weights) if w], float(lasso.intercept))


def score_quality(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` and the statistics of whole texts, null and empty ones too; a null id stays null.

    Repeated rows are scored each, equal texts equally; an empty table gives none.
    """
    measured = with_statistics(docs, id_col, text_col).withColumn("score", model.score())
    return measured.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *STATISTICS)
