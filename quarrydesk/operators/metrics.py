"""Classification metrics from one grouped count of (label, prediction)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Everything after ``confusion_counts`` has at most classes^2 rows.


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    """0 where undefined."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def per_class(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1, support for every label in truth or prediction."""
    sides = F.array(F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).alias("predicted"),
                             F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
                    F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("actual"),
                             F.col("n").cast("int").alias("predicted"), F.lit(0).cast("long").alias("hit")))
    sums = counts.select(F.inline(sides)).groupBy("class").agg(
        F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    precision, recall = _ratio(F.col("hit"), F.col("predicted")), _ratio(F.col("hit"), F.col("support"))
    f1 = _ratio(2.0 * F.col("hit"), F.col("predicted") + F.col("support"))
    return sums.select("class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support", "hit")


def summary(counts: DataFrame) -> DataFrame:
    """One row: accuracy, macro_f1 over labels in truth or prediction, weighted_f1, rows."""
    classes = per_class(counts)
    return classes.agg(
        (F.sum("hit") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        F.sum("support").alias("rows"))


def classification_report(counts: DataFrame) -> DataFrame:
    """Per-class rows plus accuracy, macro and weighted averages, four digits."""
    classes = per_class(counts)
    measures = ["precision", "recall", "f1"]
    total = F.sum("support")
    macro = classes.agg(F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in measures], total.alias("support"))
    weighted = classes.agg(F.lit("weighted avg").alias("class"),
                           *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in measures],
                           total.alias("support"))
    accuracy = classes.agg(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                           F.lit(None).cast("double").alias("recall"), (F.sum("hit") / total).alias("f1"),
                           total.alias("support"))
    rows = classes.drop("hit").unionByName(accuracy).unionByName(macro).unionByName(weighted)
    return rows.select("class", *[F.round(m, 4).alias(m) for m in measures], "support")


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """Every (actual, predicted) cell over the union of labels, zeros kept."""
    labels = counts.select(F.explode(F.array("label", "prediction")).alias("l")).agg(
        F.array_sort(F.collect_set("l")).alias("labels"))
    grid = labels.select(F.explode("labels").alias("label"), "labels").select(
        "label", F.explode("labels").alias("prediction"))
    return grid.join(counts, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def confusion_wide(counts: DataFrame, labels: list[str]) -> DataFrame:
    """One row per actual label, one column per predicted label."""
    return confusion_matrix(counts).groupBy("label").pivot("prediction", labels).agg(F.sum("n"))


def evaluation_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> dict[str, DataFrame]:
    """Summary, per-class report and confusion matrix of one prediction table."""
    counts = confusion_counts(df, label, prediction)
    return {"summary": summary(counts), "classes": classification_report(counts), "confusion": confusion_matrix(counts)}


def pick_winner(metrics: DataFrame, preferred: str) -> DataFrame:
    """The row of highest macro F1; the preferred model wins a tie."""
    order = W.partitionBy().orderBy(F.desc("macro_f1"), F.desc(F.col("model") == preferred), "model")
    return metrics.withColumn("_place", F.row_number().over(order)).filter("_place = 1").drop("_place")
