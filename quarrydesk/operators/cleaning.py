"""Row-wise cleaning rules and the conditional median imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrydesk.functions.numeric import clip
from quarrydesk.functions.quantiles import exact_median
from quarrydesk.functions.text import normalise_text, word_count_normalised
from quarrydesk.schema import HOURS_CEILING, HOURS_FLOOR, TIMESTAMP_SHAPE, require_columns


def parsed_timestamp(created_at: Column) -> Column:
    """Timestamp without zone, or NULL unless the text has the one accepted shape."""
    return F.when(created_at.rlike(TIMESTAMP_SHAPE), created_at.try_cast("timestamp_ntz"))


def clean_text(df: DataFrame) -> DataFrame:
    """Drop NULL text, keep blank text, normalise the rest."""
    require_columns(df, "ticket_text")
    return df.filter(F.col("ticket_text").isNotNull()).withColumn("ticket_text", normalise_text(F.col("ticket_text")))


def fix_timestamps(df: DataFrame) -> DataFrame:
    """Parse ``created_at``, drop what does not parse, add hour, weekday (Monday 0), month."""
    require_columns(df, "created_at")
    stamped = df.withColumn("created_at", parsed_timestamp(F.col("created_at"))).filter(
        F.col("created_at").isNotNull())
    return add_time_features(stamped)


def add_time_features(df: DataFrame) -> DataFrame:
    at = F.col("created_at")
    return df.withColumns({"hour_of_day": F.hour(at), "day_of_week": F.weekday(at), "month": F.month(at)})


def clean_previous_tickets(df: DataFrame) -> DataFrame:
    """NULL becomes 0, negatives become 0."""
    return df.withColumn("previous_tickets", F.greatest(F.coalesce("previous_tickets", F.lit(0.0)), F.lit(0.0)))


def cap_hours(df: DataFrame) -> DataFrame:
    return df.withColumn("resolution_time", clip(F.col("resolution_time"), HOURS_FLOOR, HOURS_CEILING))


def median_resolved_hours(capped: DataFrame) -> Column:
    """Exact median of capped hours over resolved rows, as a scalar subquery."""
    return exact_median(capped.filter("resolved").select("resolution_time"), "resolution_time")


def impute_hours(capped: DataFrame) -> DataFrame:
    """Resolved rows without hours get the median; open tickets stay NULL."""
    needs = F.col("resolved") & F.col("resolution_time").isNull()
    return capped.withColumn("resolution_time",
                             F.when(needs, median_resolved_hours(capped)).otherwise(F.col("resolution_time")))


def clean_structured(df: DataFrame) -> DataFrame:
    """Counts and hours, for whichever of these columns the table has."""
    if "previous_tickets" in df.columns:
        df = clean_previous_tickets(df)
    if {"resolution_time", "resolved"} <= set(df.columns):
        df = impute_hours(cap_hours(df))
    return df


def imputation_report(df: DataFrame) -> DataFrame:
    """Rows each structured rule touches, counted on the table before the rules."""
    hours, previous, resolved = F.col("resolution_time"), F.col("previous_tickets"), F.col("resolved")
    outside = (hours < HOURS_FLOOR) | (hours > HOURS_CEILING)
    counts = df.agg(F.count_if(previous.isNull()).alias("previous_filled"),
                    F.count_if(previous < 0).alias("previous_clipped"),
                    F.count_if(outside).alias("hours_capped"),
                    F.count_if(resolved & hours.isNull()).alias("hours_imputed"),
                    F.count_if(~resolved & hours.isNull()).alias("hours_left_open"))
    return counts.withColumn("median_hours", median_resolved_hours(cap_hours(df)))


def text_measures(df: DataFrame) -> DataFrame:
    """Character and word counts of cleaned text."""
    text = F.col("ticket_text")
    return df.withColumns({"text_length": F.length(text), "word_count": word_count_normalised(text)})
