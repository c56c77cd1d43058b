"""A corpus pipeline of five stages; each takes the documents that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrydesk.llm import byte_bpe, decontaminate, language_id, parity_join, pii
from quarrydesk.llm.catalog import vocabulary
from quarrydesk.session import scratch_path, write_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the centroids of the labelled texts reject go: nulls, texts without a letter, far outliers.

    ``lang`` becomes the predicted language. Each row is judged by itself; rows without an id go.
    """
    found = language_id.with_language(docs, language_id.fit_centroids(docs.select("lang", "text")))
    return found.where("NOT rejected AND doc_id IS NOT NULL").withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents stays."""
    groups = parity_join.near_duplicate_components(docs)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    hits = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    # the ids are written first, so their size is known before the texts would move
    return docs.join(write_out(hits.select("doc_id").distinct(), "leaks"), "doc_id", "left_anti").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kinds in brackets; no document goes."""
    seen = write_out(pii.candidates(docs), "candidates")
    clean = pii.masked(pii.find_personal_data(seen, pii.train_spans(seen)))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of the decoded text."""
    return byte_bpe.encode_documents(docs, *vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language), ("near_duplicates", drop_near_duplicates), ("decontamination", drop_benchmark_leaks),
    ("personal_data", mask_personal_data), ("byte_bpe", tokenize)]

#: Trained centroids, a trained span model and merges by rank are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
