"""Data-quality audit: counts of defects in one pass over a raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrydesk.functions.numeric import pct
from quarrydesk.functions.text import row_digest
from quarrydesk.operators.cleaning import parsed_timestamp
from quarrydesk.schema import HOURS_CEILING, HOURS_FLOOR, ROW_SEQ

ROW_IDENTITY = ("ticket_id", "is_near_duplicate", ROW_SEQ)


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def _named_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One aggregate row for all checks, turned into (check_name, n, total) rows."""
    row = df.agg(F.count("*").alias("total"), *[c.alias(f"_{i}") for i, c in enumerate(checks.values())])
    listed = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"_{i}").alias("n"))
                       for i, name in enumerate(checks)])
    return row.select("total", F.inline(listed))


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW_SEQ]


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, zeros included."""
    counts = _named_counts(df, {c: F.count_if(F.col(c).isNull()) for c in data_columns(df)})
    return counts.select(F.col("check_name").alias("column_name"), "n", pct(F.col("n"), F.col("total")).alias("pct"))


def exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group equal in all columns but the id; NULLs equal.

    Rows are grouped by a 256-bit digest of their content, so a huge group of
    copies shrinks to one short row per task before it is shuffled.
    """
    digest = row_digest([c for c in df.columns if c not in ROW_IDENTITY])
    return df.groupBy(digest.alias("_digest")).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("exact_duplicates"))


def malformed_timestamp(created_at: Column) -> Column:
    return parsed_timestamp(created_at).isNull()


def negative_count(previous: Column) -> Column:
    return F.coalesce(previous < 0, F.lit(False))


def hours_outlier(hours: Column) -> Column:
    return F.coalesce((hours < HOURS_FLOOR) | (hours > HOURS_CEILING), F.lit(False))


def defect_counts(df: DataFrame) -> DataFrame:
    """Malformed timestamps, negative counts and hours out of range, one row."""
    columns = set(df.columns)
    negative = (F.count_if(negative_count(F.col("previous_tickets")))
                if "previous_tickets" in columns else F.lit(0).cast("long"))
    return df.agg(F.count_if(malformed_timestamp(F.col("created_at"))).alias("malformed_timestamps"),
                  negative.alias("negative_previous_tickets"),
                  F.count_if(hours_outlier(F.col("resolution_time"))).alias("resolution_time_outliers"))


def audit_report(df: DataFrame) -> DataFrame:
    """All checks as (check_name, n, pct): one scan for counts, one grouped scan for copies."""
    checks: dict[str, Column] = {"total_rows": F.count("*")}
    checks |= {f"missing:{c}": F.count_if(F.col(c).isNull()) for c in data_columns(df)}
    checks["malformed_timestamps"] = F.count_if(malformed_timestamp(F.col("created_at")))
    if "previous_tickets" in df.columns:
        checks["negative_previous_tickets"] = F.count_if(negative_count(F.col("previous_tickets")))
    checks["resolution_time_outliers"] = F.count_if(hours_outlier(F.col("resolution_time")))
    counts = _named_counts(df, checks)
    copies = exact_duplicates(df).select(
        F.lit("exact_duplicates").alias("check_name"), F.col("exact_duplicates").alias("n"),
        total_rows(df).scalar().alias("total"))
    report = counts.unionByName(copies)
    return report.select("check_name", "n", pct(F.col("n"), F.col("total")).alias("pct"))


def before_after(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Audits of both tables side by side, with column and flag counts."""
    def summary(df: DataFrame, side: str) -> DataFrame:
        extra = {"columns": F.lit(len(data_columns(df))).cast("long")}
        if "is_near_duplicate" in df.columns:
            extra["near_duplicates_flagged"] = F.count_if(F.col("is_near_duplicate"))
        more = _named_counts(df, extra).select("check_name", "n")
        return audit_report(df).select("check_name", "n").unionByName(more).withColumnRenamed("n", side)
    return summary(raw, "n_before").join(summary(clean, "n_after"), "check_name", "full_outer")


def missing_table(df: DataFrame) -> DataFrame:
    """Columns with at least one NULL."""
    return null_counts(df).filter(F.col("n") > 0)


def null_patterns(df: DataFrame) -> DataFrame:
    """How many rows share each combination of NULL columns (heat-map data)."""
    flags = [F.when(F.col(c).isNull(), F.lit(c)) for c in data_columns(df)]
    return (df.groupBy(F.concat_ws(",", *flags).alias("null_columns")).agg(F.count("*").alias("n")))
