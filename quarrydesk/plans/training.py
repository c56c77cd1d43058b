"""Train, score and compare models; every statistic comes from the train side."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrydesk.operators import features as feat
from quarrydesk.operators import boosting, forest, linear_fit, metrics, models, routing, scans, splits
from quarrydesk.operators.tfidf import MAX_FEATURES, MAX_FEATURES_SIMILARITY
from quarrydesk.schema import MODEL_INPUT, NUMERIC_FEATURES, POST_OUTCOME_FEATURES, ROW_SEQ
from quarrydesk.session import write_out

#: Rows of a partition of a small table, partitions that these make at most, and rows of a partition of a large one: each
#: scan of a fit sends a whole set of sums for each partition.
ROWS_PER_PARTITION, SMALL_PARTITIONS, ROWS_OF_LARGE = 1_000, 32, 16_000
#: Rows of a partition for boosting: each sends a whole set of histograms for every tree level.
BOOSTING_ROWS = 8_000


@dataclass(frozen=True)
class Trained:
    name: str
    space: feat.FeatureSpace
    model: object
    labels: tuple[str, ...]
    predictions: DataFrame      # row_seq, label, scores, prediction, confidence
    metrics: DataFrame          # model, accuracy, macro_f1, weighted_f1, rows, seconds
    projection: models.Projection | None = None


def _labels_and_weights(train: DataFrame, label: str) -> tuple[tuple[str, ...], dict[str, float], int]:
    rows = train.groupBy(label).agg(F.count("*").alias("n")).orderBy(label).collect()   # one row per class
    total, k = sum(r["n"] for r in rows), len(rows)
    return tuple(r[label] for r in rows), {r[label]: total / (k * r["n"]) for r in rows}, total


def _parts(rows: int) -> int:
    """Small partitions for small tables, large ones for large tables; their number depends on the rows alone."""
    return max(1, min(-(-rows // ROWS_PER_PARTITION), SMALL_PARTITIONS), -(-rows // ROWS_OF_LARGE))


def _boosting_parts(spark: SparkSession, rows: int) -> int:
    """Few partitions; at most one for each shuffle partition, and no more than are added up without a shuffle."""
    return max(1, min(-(-rows // BOOSTING_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")), scans.FAN_IN))


def _forest_parts(rows: int) -> int:
    """Their number depends on the rows alone, as bags are drawn block by block; each sends counts to a level's scan."""
    return max(1, min(-(-rows // BOOSTING_ROWS), scans.FAN_IN))


def _finish(name: str, scored: DataFrame, test: DataFrame, label: str, began: float) -> tuple[DataFrame, DataFrame]:
    named = routing.with_prediction(scored).join(test.select(ROW_SEQ, F.col(label).alias("label")), ROW_SEQ)
    predictions = write_out(named, "predictions")
    summary = metrics.summary(metrics.confusion_counts(predictions)).select(
        F.lit(name).alias("model"), "*", F.lit(time.time() - began).alias("seconds"))
    return predictions, summary


def _check_inputs(numeric: list[str] | None, leaky: bool) -> list[str]:
    columns = list(NUMERIC_FEATURES if numeric is None else numeric)
    if leaky:
        return columns + list(POST_OUTCOME_FEATURES)
    feat.leakage_guard(columns + MODEL_INPUT)
    return columns


def train_category_model(split: DataFrame, kind: str = "svm", label: str = "category", max_features: int = MAX_FEATURES,
                         iterations: int | None = None, folds: int = models.FOLDS, leaky: bool = False) -> Trained:
    """Fit ``lr`` or Platt-calibrated ``svm`` on the train side of a split, score the test side."""
    if kind not in ("lr", "svm"):
        raise ValueError(f"unknown model kind: {kind}")
    began = time.time()
    train, test = splits.train_rows(split), splits.test_rows(split)
    if leaky:
        train, test = (d.withColumn("resolved", F.col("resolved").cast("double")) for d in (train, test))
    numeric = _check_inputs(None, leaky)
    labels, weights, rows = _labels_and_weights(train, label)
    space = feat.fit_space(train, max_features, numeric)
    if kind == "svm":
        train = splits.stratified_folds(train, label, folds)
    keep = [ROW_SEQ, label, *(["fold"] if kind == "svm" else []), "entries"]
    table = write_out(space.transform(train).select(*keep), "train_entries")
    coded = models.labelled(table, label, labels).select(
        ROW_SEQ, F.col("fold") if kind == "svm" else F.lit(-1).alias("fold"), F.col("label_code").alias("code"), "entries")
    packed = linear_fit.packed_rows(coded, space.size, _parts(rows))
    if kind == "lr":
        model = models.fit_logistic(packed, labels, weights, iterations or models.LR_ITERATIONS)
    else:
        model = models.fit_calibrated_svm(table, packed, labels, label, folds, iterations or models.SVM_ITERATIONS)
    packed.blocks.unpersist()
    scored = models.score_linear(space.transform(test).select(ROW_SEQ, "entries"), model, [ROW_SEQ])
    predictions, summary = _finish(kind, scored, test, label, began)
    return Trained(kind, space, model, labels, predictions, summary)


def train_priority_model(split: DataFrame, kind: str = "boosted", label: str = "priority",
                         max_features: int = MAX_FEATURES_SIMILARITY, components: int = models.COMPONENTS,
                         trees: int | None = None, depth: int | None = None) -> Trained:
    """SVD of the text, then ``boosted`` trees or a ``forest`` on short dense rows."""
    if kind not in ("boosted", "forest"):
        raise ValueError(f"unknown model kind: {kind}")
    began = time.time()
    train, test = splits.train_rows(split), splits.test_rows(split)
    labels, weights, rows = _labels_and_weights(train, label)
    space = feat.fit_space(train, max_features, _check_inputs(None, False))
    table = write_out(space.transform(train).select(ROW_SEQ, label, "entries"), "train_entries")
    text = table.select(ROW_SEQ, F.lit(0).alias("fold"), F.lit(0).alias("code"),
                        F.filter("entries", lambda e: e["idx"] < space.text_size).alias("entries"))
    packed = linear_fit.packed_rows(text, space.text_size, _parts(rows))
    projection = models.fit_projection(packed, min(components, space.text_size))
    packed.blocks.unpersist()
    short = projection.components + space.size - space.text_size
    dense = models.project(models.labelled(table, label, labels, weights), projection, space.text_size)
    ordered = dense.select(ROW_SEQ, F.col("label_code").cast("int").alias("code"), "weight", "entries")
    if kind == "forest":
        model = forest.fit(write_out(ordered, "forest_rows"), short, [weights[n] for n in labels], _forest_parts(rows),
                           trees or models.TREES_FOREST, depth or models.FOREST_DEPTH, models.SEED)
    else:
        model = boosting.fit(write_out(ordered, "boosting_rows"), short, len(labels), _boosting_parts(train.sparkSession, rows),
                             trees or models.TREES_BOOSTED, depth or models.BOOST_DEPTH, models.BOOST_RATE)
    asked = models.project(space.transform(test).select(ROW_SEQ, "entries"), projection, space.text_size)
    predictions, summary = _finish(kind, models.score_trees(asked, model, labels, [ROW_SEQ]), test, label, began)
    return Trained(kind, space, model, labels, predictions, summary, projection)


def compare_models(first: Trained, second: Trained, preferred: str) -> DataFrame:
    """Metric rows of both models with the winner marked (the preferred one wins ties)."""
    rows = first.metrics.unionByName(second.metrics)
    winner = metrics.pick_winner(rows, preferred).select("model").scalar()
    return rows.withColumn("is_winner", F.col("model") == winner)


def leakage_experiment(clean: DataFrame, iterations: int | None = None, max_features: int = MAX_FEATURES_SIMILARITY) -> DataFrame:
    """Priority model with and without post-outcome columns on one random split."""
    split = splits.random_split(clean)
    runs = {name: train_category_model(split, "lr", "priority", max_features, iterations, leaky=name == "leaky")
            for name in ("leaky", "clean")}
    rows = runs["leaky"].metrics.withColumn("model", F.lit("leaky")).unionByName(
        runs["clean"].metrics.withColumn("model", F.lit("clean"))).select("model", "accuracy", "macro_f1")
    return _difference(rows, "leaky", "clean", "inflation_pct")


def _difference(rows: DataFrame, high: str, low: str, name: str) -> DataFrame:
    """Two metric rows plus their difference in percentage points."""
    def at(model: str, column: str):
        return F.max(F.when(F.col("model") == model, F.col(column)))
    gap = rows.agg(F.lit(name).alias("model"), *[((at(high, c) - at(low, c)) * 100).alias(c) for c in ("accuracy", "macro_f1")])
    return rows.unionByName(gap)


def compare_splits(clean: DataFrame, label: str = "category", iterations: int | None = None,
                   max_features: int = MAX_FEATURES_SIMILARITY, fit=None) -> DataFrame:
    """The same estimator on a random and a customer split, with overlap and gap.

    ``fit(split, label)`` may replace the default logistic regression.
    """
    fit = fit or (lambda split, name: train_category_model(split, "lr", name, max_features, iterations))
    frames = []
    for kind, split in (("random", splits.random_split(clean)), ("customer", splits.customer_split(clean))):
        result = fit(split, label).metrics.select("accuracy", "macro_f1")
        sizes = split.agg(F.count_if(F.col("split") == "train").alias("train_rows"), F.count_if(F.col("split") == "test").alias("test_rows"))
        overlap = splits.customer_overlap(split).select("test_customers", "shared_customers", "shared_pct")
        row = [*result.first(), *sizes.first(), *overlap.first()]
        frames.append((kind, *row))
    return clean.sparkSession.createDataFrame(
        frames + [("gap_pct", (frames[0][1] - frames[1][1]) * 100, (frames[0][2] - frames[1][2]) * 100, None, None, None, None, None)],
        "split string, accuracy double, macro_f1 double, train_rows long, test_rows long, test_customers long, "
        "shared_customers long, shared_pct double")
