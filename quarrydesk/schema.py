"""Declared schemas and the fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_TICKET = T.StructType([
    T.StructField("ticket_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("ticket_text", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("previous_tickets", T.DoubleType()),
    T.StructField("resolution_time", T.DoubleType()),
    T.StructField("priority", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("resolved", T.BooleanType()),
])

# Ingest order of a raw table. Spark rows have no position, so it is a column.
ROW_SEQ = "row_seq"

# --- fixed values -----------------------------------------------------------
TIMESTAMP_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
HOURS_FLOOR = 0.0
HOURS_CEILING = 8760.0
LENGTH_BAND = 15
RARE_CLASS_BELOW = 100
PRIORITY_ORDER = ["LOW", "MEDIUM", "HIGH"]
TEXT_FEATURE = "ticket_text"
CATEGORICAL_FEATURE = "product"
NUMERIC_FEATURES = ["previous_tickets", "hour_of_day", "day_of_week", "month"]
POST_OUTCOME_FEATURES = {
    "resolution_time": "filled in when a ticket is closed",
    "resolved": "set when a ticket is closed",
}
OOD_THRESHOLD = 0.50
AUTO_ROUTE_FROM = 0.85
HIGH_MATCH_FROM = 0.70
PREVIEW_CHARS = 80
SLA_LABELS = {
    "HIGH": "CRITICAL / IMMEDIATE ATTENTION",
    "MEDIUM": "STANDARD QUEUE SLA (12H)",
    "LOW": "ROUTINE INQUIRY QUEUE SLA (24H)",
}
SLA_DEFAULT = "UNASSIGNED QUEUE"
# ----------------------------------------------------------------------------

MODEL_INPUT = [TEXT_FEATURE, CATEGORICAL_FEATURE, *NUMERIC_FEATURES]


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail at the boundary, before any job runs, when a column is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")
    return df
