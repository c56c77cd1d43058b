"""Exact keep-first dedupe and the same-customer length-band flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrydesk.functions.text import row_digest
from quarrydesk.schema import LENGTH_BAND, ROW_SEQ, require_columns

NOT_COMPARED = ("ticket_id", "is_near_duplicate", ROW_SEQ)


def drop_exact_copies(df: DataFrame) -> DataFrame:
    """Keep the first row (by ``row_seq``) of rows equal in every other column. NULLs are equal.

    Rows are grouped by a 256-bit digest of their content: copies collapse on the map side to a digest and a number, and
    no text is sorted. The numbers of the first rows then pick them out of the table.
    """
    require_columns(df, ROW_SEQ, "ticket_id")
    digest = row_digest([c for c in df.columns if c not in NOT_COMPARED])
    first = df.groupBy(digest.alias("_digest")).agg(F.min(ROW_SEQ).alias(ROW_SEQ))
    return df.join(first.select(ROW_SEQ), ROW_SEQ, "left_semi")


def crowded_lengths(df: DataFrame, band: int = LENGTH_BAND) -> DataFrame:
    """(customer_id, text_length) values that have another ticket within ``band``.

    Works on distinct lengths with their counts. A length is crowded when two
    tickets share it, or when the next shorter or longer length is near: the
    nearest neighbour in sorted order attains the smallest gap. The window sees
    at most one row per distinct length of a customer, however many tickets.
    """
    lengths = (df.groupBy("customer_id", F.length("ticket_text").alias("text_length"))
                 .agg(F.count("*").alias("_n")))
    near = W.partitionBy("customer_id").orderBy("text_length")
    shorter = F.col("text_length") - F.lag("text_length").over(near)
    longer = F.lead("text_length").over(near) - F.col("text_length")
    return (lengths.withColumn("_gap", F.least(shorter, longer))
                   .filter((F.col("_n") > 1) | (F.col("_gap") <= band))
                   .select("customer_id", "text_length"))


def flag_near_duplicates(df: DataFrame, band: int = LENGTH_BAND) -> DataFrame:
    """Add ``is_near_duplicate``; nothing is dropped.

    Joins the crowded lengths back. That side has unique keys, so adaptive
    skew handling can split a heavy customer's tickets.
    """
    require_columns(df, "customer_id", "ticket_text")
    crowded = crowded_lengths(df, band).withColumn("_hit", F.lit(True))
    # Row text_length is recomputed on the ticket side: cheaper than shuffling it twice.
    tickets = df.withColumn("text_length", F.length("ticket_text"))
    flagged = tickets.join(crowded, ["customer_id", "text_length"], "left")
    return flagged.select(*df.columns, F.coalesce("_hit", F.lit(False)).alias("is_near_duplicate"))
