"""The given tables, and the ticket tables Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrydesk.functions.ranking import running_count
from quarrydesk.session import staged

# --- fixed values -----------------------------------------------------------
LABELS = ["de", "en", "es", "fr"]
BAD_TIMESTAMPS = {0: "13/32/2023 10:00:00", 67: "2023/99/01 00:00", 134: "not-a-date", 201: "Jan 2023", 268: ""}
COPY_ID_OFFSET = 1_000_000_000
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive_raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty tickets: a document joined to the event of the same id, with planted defects.

    Earlier tickets are counted on rows without text; a document then meets its rows by its place in the table, so texts
    are moved once and never sorted. Resubmitted copies come from exploding a row, so the join runs once.
    """
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", "lang", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    met = docs.select("doc_id", "_file", "_row").join(events, F.col("doc_id") == F.col("event_id")).drop("doc_id")
    counted = running_count(met, "user_id", "ts", "event_id", "prev")
    base = docs.join(counted.hint("shuffle_hash"), ["_file", "_row"])

    seq, missing = F.col("doc_id"), F.lit(None)
    id_text = F.lpad(seq.cast("string"), 6, "0")
    created = F.substring(F.col("ts").cast("string"), 1, 19)
    for rest, bad in BAD_TIMESTAMPS.items():
        created = F.when(seq % 335 == rest, F.lit(bad)).otherwise(created)
    previous = (F.when(seq % 33 == 0, missing).when(seq % 333 == 1, F.lit(-1.0))
                .when(seq % 333 == 2, F.lit(-5.0)).when(seq % 333 == 4, F.lit(-999.0))
                .otherwise(F.col("prev").cast("double")))
    resolved = (seq * 31) % 100 < 82
    hours = (F.when(~resolved, missing).when(seq % 50 == 11, missing)
             .when(seq % 200 == 17, F.lit(-5.0)).when(seq % 200 == 18, F.lit(9999.0))
             .when(seq % 200 == 20, F.lit(0.001)).when(seq % 200 == 21, F.lit(50000.0))
             .otherwise(F.col("value")))
    urgency = (seq * 7) % 10
    copies = F.when(seq % 50 == 7, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    shaped = base.select(
        seq.alias("_seq"), id_text.alias("_id"), F.explode(copies).alias("_copy"),
        F.concat(F.lit("C-"), F.col("user_id").cast("string")).alias("customer_id"),
        F.when(seq % 25 == 0, missing).otherwise(F.col("text")).alias("ticket_text"),
        F.col("source").alias("product"),
        created.alias("created_at"),
        previous.alias("previous_tickets"),
        hours.alias("resolution_time"),
        F.when(urgency < 2, "HIGH").when(urgency < 7, "MEDIUM").otherwise("LOW").alias("priority"),
        F.col("lang").alias("category"),
        resolved.alias("resolved"))
    return shaped.select(
        F.when(F.col("_copy"), F.col("_seq") + COPY_ID_OFFSET).otherwise(F.col("_seq")).alias("row_seq"),
        F.concat(F.when(F.col("_copy"), "T-DUPE-").otherwise("T-"), F.col("_id")).alias("ticket_id"),
        *[c for c in shaped.columns if not c.startswith("_")])


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``derive_raw_tickets`` written once per application; scans then prune columns."""
    return staged(spark, sf_dir, "tickets_raw", lambda: derive_raw_tickets(spark, sf_dir))


def clean_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table that every later stage reads, written once per application."""
    from quarrydesk.plans.cleaning import clean_table
    return staged(spark, sf_dir, "tickets_clean", lambda: clean_table(raw_tickets(spark, sf_dir)))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic class scores: one row per document, scores as an array.

    Columns ``doc_id, truth, scores array<struct<label, p, margin>>``; the
    per-row array keeps row-wise work (softmax, argmax) free of shuffles.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("truth"))
    raws = [
        (F.lit(1) + (F.col("doc_id") * 7 + k * 13) % 10
         + F.when((F.col("truth") == label) & (F.col("doc_id") % 9 != 0), 20).otherwise(0)).cast("double")
        for k, label in enumerate(LABELS)]
    total = raws[0] + raws[1] + raws[2] + raws[3]
    scores = F.array(*[
        F.struct(F.lit(label).alias("label"), (raw / total).alias("p"), (raw / 10.0).alias("margin"))
        for label, raw in zip(LABELS, raws)])
    return docs.select("doc_id", "truth", scores.alias("scores"))
