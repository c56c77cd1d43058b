"""Ticket tables on disk: dirty CSV in, clean Parquet or CSV out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrydesk.functions.numeric import nan_to_null
from quarrydesk.schema import RAW_TICKET
from quarrydesk.session import write_out

CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False, with_place: bool = False) -> DataFrame:
    """Header CSV under the declared schema; a missing path raises.

    Large files are split between tasks. Only ``multi_line`` allows line breaks inside fields, and makes every file one
    task. ``with_place`` adds where a row stands: ``_file``, ``_block`` (first byte of the split) and ``_row``, which
    grows along a split. Malformed lines are kept in ``_corrupt_record`` instead of failing the job.
    Empty fields, quoted or not, and NaN are NULL: all kinds of missing behave alike.
    """
    schema = T.StructType([*RAW_TICKET.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line)
           .option("escape", '"').csv(path))
    doubles = {f.name: nan_to_null(F.col(f.name)) for f in RAW_TICKET.fields if f.dataType == T.DoubleType()}
    if with_place:
        raw = raw.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                         F.monotonically_increasing_id().alias("_row"))
    return raw.withColumns(doubles)


def in_file_order(placed: DataFrame, number: str) -> DataFrame:
    """Rows of ``read_raw_csv(with_place=True)``, once written, numbered 0, 1, ... by file path and place in the file.

    Splits are counted, a running sum over them gives each its first number; there is one row for each split in that sum.
    The numbers do not depend on how files are split or how many tasks read them.
    """
    splits = placed.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return placed.join(splits, ["_file", "_block"]).withColumn(number, F.col("_before") + F.col("_row") - F.col("_first")).drop(
        "_file", "_block", "_row", "_first", "_n", "_before")


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, corrupt lines) of ``read_raw_csv``.

    The CSV is parsed once into the shared folder; both halves scan that table.
    """
    parsed = write_out(raw, "parsed_csv")
    good = parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, parsed.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def write_tickets(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> None:
    """Overwrite a ticket table; parents are created by the file system."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if fmt == "csv":
        # Text must come back unchanged, edge white space included.
        (writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    else:
        writer.format(fmt).save(path)


def read_tickets(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Columnar formats keep ``created_at`` a timestamp; CSV would not."""
    return spark.read.format(fmt).load(path)
