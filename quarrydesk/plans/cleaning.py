"""The cleaning job: dirty table in, clean table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrydesk.operators.cleaning import clean_structured, clean_text, fix_timestamps
from quarrydesk.operators.dedupe import drop_exact_copies, flag_near_duplicates
from quarrydesk.schema import ROW_SEQ
from quarrydesk.session import write_out
from quarrydesk.sources.tickets import in_file_order, read_raw_csv, split_corrupt, write_tickets

CLEAN_ORDER = ["ticket_id", "customer_id", "ticket_text", "product", "created_at", "previous_tickets",
               "resolution_time", "priority", "category", "resolved", "hour_of_day", "day_of_week", "month",
               "is_near_duplicate"]


def deduped_table(raw: DataFrame) -> DataFrame:
    """Text, time and structured rules, then keep-first dedupe."""
    return raw.transform(clean_text).transform(fix_timestamps).transform(clean_structured).transform(drop_exact_copies)


def clean_table(raw: DataFrame) -> DataFrame:
    """The whole cleaning order. Dedupe is written out once, because the flag
    reads it twice: two narrow columns to find crowded lengths, then all rows."""
    deduped = write_out(deduped_table(raw), "tickets_deduped")
    return flag_near_duplicates(deduped).select(ROW_SEQ, *CLEAN_ORDER)


def clean_csv(spark: SparkSession, source: str, target: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    """File to file. Of equal rows the first by file path and place in the file stays."""
    good, _ = split_corrupt(read_raw_csv(spark, source, multi_line, with_place=True))
    write_tickets(clean_table(in_file_order(good, ROW_SEQ)), target, fmt)
    return spark.read.format(fmt).load(target) if fmt != "csv" else spark.read.option("header", True).csv(target)
