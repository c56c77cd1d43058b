"""Inputs the registered queries share, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrydesk.operators import neardup, retrieval, routing, splits
from quarrydesk.operators import tfidf as tf
from quarrydesk.schema import ROW_SEQ
from quarrydesk.session import staged
from quarrydesk.sources import tables
from quarrydesk.sources.tables import LABELS

_FOUND: dict[str, neardup.NearDuplicates] = {}


def customer_split(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, "split_customer", lambda: splits.customer_split(tables.clean_tickets(spark, sf)))


def random_split(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, "split_random", lambda: splits.random_split(tables.clean_tickets(spark, sf)))


def train_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    def build() -> DataFrame:
        vocabulary, _ = tf.tfidf(splits.train_rows(customer_split(spark, sf)))
        return vocabulary
    return staged(spark, sf, "train_vocabulary", build)


def ticket_terms(df: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(row_seq, term, x): unit TF-IDF of every ticket under a fitted vocabulary."""
    rows = df.select(F.col(ROW_SEQ).alias("doc"), F.lit(1).cast("long").alias("copies"),
                     F.coalesce("ticket_text", F.lit("")).alias("text"))
    weighted = tf.normalised_terms(tf.weighted_terms(rows, vocabulary))
    named = weighted.join(F.broadcast(vocabulary.select("idx", "term")), "idx")      # at most MAX_FEATURES rows
    return named.select(F.col("doc").alias(ROW_SEQ), "term", F.col("weight").alias("x"))


def near_duplicates(spark: SparkSession, sf: str, threshold: float = neardup.AUDIT_THRESHOLD) -> neardup.NearDuplicates:
    key = f"{spark.sparkContext.applicationId}|{sf}|{threshold}"
    if key not in _FOUND:
        _FOUND[key] = neardup.find_near_duplicates(tables.clean_tickets(spark, sf), threshold)
    return _FOUND[key]


def fold_weights(spark: SparkSession, sf: str) -> DataFrame:
    """(fold, label, feature, w): mean TF-IDF of a term inside a class minus outside it,
    over train rows of the other folds. A signed linear model without a fit.

    Sums per (fold, label) become columns of one row per term, so leaving a
    fold out is subtraction, not another pass.
    """
    train = splits.stratified_folds(splits.train_rows(customer_split(spark, sf)), "category")
    vectors = ticket_terms(splits.train_rows(customer_split(spark, sf)), train_vocabulary(spark, sf))
    cells = [(f, name) for f in range(splits.FOLDS) for name in LABELS]
    counted = {(r["fold"], r["category"]): r["n"] for r in
               train.groupBy("fold", "category").agg(F.count("*").alias("n")).collect()}   # folds x classes
    n = {cell: counted.get(cell, 0) for cell in cells}
    sums = (vectors.join(train.select(ROW_SEQ, "fold", "category"), ROW_SEQ)
            .groupBy("term").agg(*[F.coalesce(F.sum(F.when((F.col("fold") == f) & (F.col("category") == name), F.col("x"))),
                                              F.lit(0.0)).alias(f"_{f}_{name}") for f, name in cells]))
    weights = []
    for f, name in cells:
        inside = [c for c in cells if c[0] != f and c[1] == name]
        outside = [c for c in cells if c[0] != f and c[1] != name]
        mean_in = sum(F.col(f"_{a}_{b}") for a, b in inside) / F.lit(float(sum(n[c] for c in inside)))
        mean_out = sum(F.col(f"_{a}_{b}") for a, b in outside) / F.lit(float(sum(n[c] for c in outside)))
        weights.append(F.struct(F.lit(f).alias("fold"), F.lit(name).alias("label"), (mean_in - mean_out).alias("w")))
    return sums.select(F.concat(F.lit("text__"), "term").alias("feature"), F.inline(F.array(*weights))).select(
        "fold", "label", "feature", "w")


def staged_fold_weights(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, "fold_weights", lambda: fold_weights(spark, sf))


def predicted_test_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """(row_seq, prediction, confidence) of test tickets from the deterministic scores."""
    scored = routing.with_prediction(tables.predictions(spark, sf))
    test = splits.test_rows(customer_split(spark, sf)).select(ROW_SEQ)
    return test.join(scored.select(F.col("doc_id").alias(ROW_SEQ), "prediction", "confidence"), ROW_SEQ)


def test_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(row_seq, feature, x) of test tickets."""
    test = splits.test_rows(customer_split(spark, sf))
    return ticket_terms(test, train_vocabulary(spark, sf)).select(
        ROW_SEQ, F.concat(F.lit("text__"), "term").alias("feature"), "x")


def embedded_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector as a ticket, with raw ticket text and priority where one exists."""
    vectors = tables.table(spark, sf, "embeddings")
    raw = tables.raw_tickets(spark, sf).select(F.col(ROW_SEQ).alias("vec_id"), "ticket_text", "priority")
    return vectors.join(raw, "vec_id", "left").select(
        F.concat(F.lit("V-"), F.col("vec_id").cast("string")).alias("ticket_id"), "vec_id", "embedding", "ticket_text",
        F.concat(F.lit("src"), (F.col("vec_id") % 20).cast("string")).alias("product"),
        F.col("label").cast("string").alias("category"), "priority")


def index(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, "retrieval_index", lambda: retrieval.build_index(embedded_tickets(spark, sf)))


def vector_queries(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("query_id"), "embedding")


def turned_vectors(spark: SparkSession, sf: str, turns: int = 10) -> DataFrame:
    """Every vector with its components moved round by 0 to ``turns - 1`` places."""
    rows = tables.table(spark, sf, "embeddings").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("s"))
    return rows.select(F.concat_ws(":", "vec_id", "s").alias("query_id"), F.concat(
        F.slice("embedding", F.col("s") + 1, F.size("embedding")), F.slice("embedding", F.lit(1), F.col("s"))).alias("embedding"))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Request rows from conversation turns, some out of bounds."""
    turns = tables.table(spark, sf, "conversations")
    return turns.select(
        "conv_id", "turn", F.when(F.col("role") == "user", F.concat(F.lit("\t "), "text", F.lit(" \n"))).when(
            F.col("turn") % 4 == 1, F.lit(" \t\n")).alias("ticket_text"),
        F.when(F.col("turn") > 1, F.lit("web")).alias("product"),
        F.when(F.col("turn") > 0, F.col("turn") - 2).cast("int").alias("previous_tickets"),
        F.when(F.col("conv_id") % 3 > 0, F.col("conv_id") % 60).cast("int").alias("top_k"),
        F.when(F.col("conv_id") % 2 > 0, F.col("conv_id") % 25).cast("int").alias("top_n"))


def reply_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each turn next to the following turn of its conversation."""
    turns = tables.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("text_2"))
    return turns.withColumnRenamed("text", "text_1").join(following, ["conv_id", "turn"])
