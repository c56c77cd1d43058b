"""Ranks that never put a whole key into one task.

A plain ``row_number`` window sends every row of a key to one task. Here a key
is cut into ordered buckets, the (few) bucket sizes are summed up first, and
only the rows of one bucket are sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HASH_BUCKET_HEX = 4  # 65,536 buckets of a uniform hash


def seeded_hash(seed: int, *ids: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), *[i.cast("string") for i in ids]))


def hash_rank(df: DataFrame, id_col: str, seed: int, by: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """1-based rank in seeded-hash order, inside each ``by`` group."""
    bucket_keys = [*by, "_bucket"]
    hashed = (df.withColumn("_hash", seeded_hash(seed, F.col(id_col)))
                .withColumn("_bucket", F.substring("_hash", 1, HASH_BUCKET_HEX)))
    sizes = hashed.groupBy(*bucket_keys).agg(F.count("*").alias("_n"))
    before = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*bucket_keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy(*bucket_keys).orderBy("_hash", id_col)
    ranked = hashed.join(offsets, bucket_keys).withColumn(out, F.col("_offset") + F.row_number().over(inside))
    return ranked.drop("_hash", "_bucket", "_offset")


def hash_cutoff(ids: DataFrame, id_col: str, seed: int, wanted: Column) -> Column:
    """The ``wanted``-th smallest seeded hash of distinct ids, as a scalar subquery.

    ``hash <= cutoff`` then selects exactly that many ids with a row filter: no
    join, no shuffle of the table being split. Only bucket sizes and the one
    bucket that holds the cutoff are ordered. NULL when nothing is wanted.
    """
    hashed = (ids.select(seeded_hash(seed, F.col(id_col)).alias("_hash"))
                 .withColumn("_bucket", F.substring("_hash", 1, HASH_BUCKET_HEX)))
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    upto = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    everything = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    edge = (sizes.withColumn("_end", F.sum("_n").over(upto))
                 .withColumn("_total", F.sum("_n").over(everything))
                 .withColumn("_wanted", wanted)
                 .filter((F.col("_end") - F.col("_n") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_end")))
                 .select("_bucket", (F.col("_wanted") - F.col("_end") + F.col("_n")).alias("_kth")))
    place = F.row_number().over(W.partitionBy("_bucket").orderBy("_hash"))
    cut = (hashed.join(F.broadcast(edge), "_bucket")          # one row by construction
                 .withColumn("_place", place)
                 .filter(F.col("_place") == F.col("_kth"))
                 .agg(F.max("_hash").alias("_cut")))
    return cut.scalar()


def running_count(df: DataFrame, key: str, at: str, tie: str, out: str) -> DataFrame:
    """Rows of the same key strictly before this one, ordered by (at, tie).

    Three levels: days of a key, instants of a day, rows of an instant. A key
    that holds a third of the table is spread over its instants.
    """
    instants = (df.groupBy(key, at).agg(F.count("*").alias("_n"))
                  .withColumn("_day", F.to_date(at)))
    days = instants.groupBy(key, "_day").agg(F.sum("_n").alias("_n"))
    earlier_days = W.partitionBy(key).orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    days = days.select(key, "_day", F.coalesce(F.sum("_n").over(earlier_days), F.lit(0)).alias("_day_offset"))
    earlier_today = W.partitionBy(key, "_day").orderBy(at).rowsBetween(W.unboundedPreceding, -1)
    offsets = (instants.withColumn("_in_day", F.coalesce(F.sum("_n").over(earlier_today), F.lit(0)))
                       .join(days, [key, "_day"])
                       .select(key, at, (F.col("_day_offset") + F.col("_in_day")).alias("_offset")))
    place = F.row_number().over(W.partitionBy(key, at).orderBy(tie))
    return (df.join(offsets, [key, at])
              .withColumn(out, F.col("_offset") + place - 1)
              .drop("_offset"))
