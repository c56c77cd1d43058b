"""Exploratory reports over the clean table (the tables behind the charts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrydesk.functions.numeric import pct
from quarrydesk.functions.quantiles import exact_quantiles
from quarrydesk.schema import PRIORITY_ORDER, RARE_CLASS_BELOW

# --- fixed values -----------------------------------------------------------
HOURS_AXIS_CAP = 800.0
HOURS_AXIS_QUANTILE = 0.98
TOP_CUSTOMERS = 20
MONTH_LABEL = "MMM yyyy"
# ----------------------------------------------------------------------------


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value. The window runs over the few grouped rows."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("pct", pct(F.col("n"), F.sum("n").over(W.partitionBy())))


def class_frequency(df: DataFrame, column: str = "category", rare_below: int = RARE_CLASS_BELOW) -> DataFrame:
    return frequency(df, column).withColumn("is_rare", F.col("n") < rare_below)


def ordered_frequency(df: DataFrame, column: str = "priority", order: list[str] | None = None) -> DataFrame:
    """Counts in a fixed order; a value that never occurs keeps NULL counts."""
    order = order or PRIORITY_ORDER
    listed = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(v) for v in order])).alias("position", column))
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total")).scalar()
    return (listed.join(counts, column, "left")
                  .select("position", column, "n", pct(F.col("n"), total).alias("pct")))


def _long(df: DataFrame, measures: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
    return df.select(F.inline(pairs))


def length_statistics(df: DataFrame, measures: list[str]) -> DataFrame:
    """Min, max, mean, exact median and sample deviation of each measure."""
    long = _long(df, measures)
    stats = long.groupBy("measure").agg(F.min("value").alias("min"), F.max("value").alias("max"),
                                        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    medians = exact_quantiles(long, "value", [0.5], by=["measure"], few_groups=True).select(
        "measure", F.get("quantiles", F.lit(0)).alias("median"))
    return stats.join(medians, "measure")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty bins included.

    The top edge belongs to the last bin; a constant column gets a unit range.
    """
    x = F.col(value).cast("double")
    span = df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high")).alias("span")).scalar()
    low = F.when(span["high"] == span["low"], span["low"] - 0.5).otherwise(span["low"])
    high = F.when(span["high"] == span["low"], span["high"] + 0.5).otherwise(span["high"])
    width = (high - low) / bins
    place = F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (low + F.col("bin") * width).alias("low_edge"), (low + (F.col("bin") + 1) * width).alias("high_edge"),
        F.coalesce("n", F.lit(0)).alias("n"))


def resolved_with_hours(df: DataFrame) -> DataFrame:
    return df.filter(F.col("resolved") & F.col("resolution_time").isNotNull())


def length_vs_hours(df: DataFrame) -> DataFrame:
    """Pearson r of text length and hours of resolved tickets, and the axis cap."""
    rows = resolved_with_hours(df)
    cap = exact_quantiles(rows, "resolution_time", [HOURS_AXIS_QUANTILE]).select(F.get("quantiles", F.lit(0))).scalar()
    stats = rows.agg(F.count("*").alias("n"), F.corr("text_length", "resolution_time").alias("pearson_r"))
    return stats.withColumn("hours_cap", F.least(F.lit(HOURS_AXIS_CAP), cap))


def top_customers(df: DataFrame, k: int = TOP_CUSTOMERS) -> DataFrame:
    """The k busiest customers, ties by id: TakeOrderedAndProject, no full sort."""
    return (df.groupBy("customer_id").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "customer_id").limit(k))


def customer_concentration(df: DataFrame, k: int = TOP_CUSTOMERS) -> DataFrame:
    """Distinct customers and the share of tickets the k busiest hold."""
    counts = df.groupBy("customer_id").agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), "customer_id").limit(k).agg(F.sum("n")).scalar()
    return counts.agg(F.count("*").alias("customers"), F.sum("n").alias("tickets")).select(
        "customers", "tickets", top.alias("top_tickets"), pct(top, F.col("tickets")).alias("top_pct"))


def monthly_volume(df: DataFrame) -> DataFrame:
    """Tickets per calendar month; months without tickets count 0."""
    counts = df.groupBy(F.trunc(F.to_date("created_at"), "month").alias("month_start")).agg(F.count("*").alias("n"))
    months = counts.agg(F.min("month_start").alias("low"), F.max("month_start").alias("high")).select(
        F.explode(F.sequence("low", "high", F.expr("interval 1 month"))).alias("month_start"))
    return months.join(counts, "month_start", "left").select(
        "month_start", F.date_format("month_start", MONTH_LABEL).alias("label"), F.coalesce("n", F.lit(0)).alias("n"))


def row_normalised_crosstab(df: DataFrame, rows: str = "category", columns: str = "priority",
                            order: list[str] | None = None) -> DataFrame:
    """Share of each column value inside a row value, one decimal."""
    order = order or PRIORITY_ORDER
    counts: list[Column] = [F.count_if(F.col(columns) == v).alias(v) for v in order]
    wide = df.groupBy(rows).agg(F.count(columns).alias("_total"), *counts)
    return wide.select(rows, *[F.round(pct(F.col(v), F.col("_total")), 1).alias(f"{v.lower()}_pct") for v in order])


def hourly_volume(df: DataFrame) -> DataFrame:
    """Tickets per hour of day; hours without tickets are absent."""
    return df.groupBy("hour_of_day").agg(F.count("*").alias("n"))


def table_summary(df: DataFrame) -> DataFrame:
    """Totals a fresh table is announced with."""
    return df.agg(F.count("*").alias("tickets"), F.count_if("resolved").alias("resolved"),
                  F.count_if(F.col("ticket_text").isNull()).alias("null_text"),
                  F.countDistinct("category").alias("categories"), F.countDistinct("priority").alias("priorities"))
