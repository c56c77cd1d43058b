"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

Rows are dealt into parts by a hash. How many rows each part gives to each shard is drawn at once, exactly as a
uniform shuffle would deal them (a multivariate hypergeometric draw for each part from what the shards still
need). Each part permutes its rows and cuts them by its row of the matrix; each shard permutes what it got.
Every random value is a hash of a seed and the row, so a task that runs again makes the same rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Above so many rows numpy's sampler refuses, and draws invert the distribution from its mode.
NUMPY_LIMIT = 10**9


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Exact draw of how many of ``drawn`` items out of good + bad are good."""
    if good + bad < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn and good else 0
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    at = min(max((drawn + 1) * (good + 1) // (good + bad + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    mass = math.exp(log_choose(good, at) + log_choose(bad, drawn - at) - log_choose(good + bad, drawn))
    left = rng.random() - mass
    up, down, up_mass, down_mass = at, at, mass, mass
    while left > 0 and (up < high or down > low):
        if up < high:
            up_mass *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up, left = up + 1, left - up_mass
            if left <= 0:
                return up
        if down > low:
            down_mass *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down, left = down - 1, left - down_mass
            if left <= 0:
                return down
    return at


def communication_matrix(part_rows: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows of each part for each shard; rows add up to the parts, columns to sizes at most one apart."""
    rng = np.random.default_rng(seed)
    total = sum(part_rows)
    need = [total // shards + (s < total % shards) for s in range(shards)]
    out = np.zeros((len(part_rows), shards), dtype=np.int64)
    for p, n in enumerate(part_rows):
        rest = sum(need)
        for s in range(shards):
            rest -= need[s]
            out[p, s] = hypergeometric(rng, need[s], rest, n)
            n -= int(out[p, s])
        for s in range(shards):
            need[s] -= int(out[p, s])
    return out


def shard_exactly(rows: DataFrame, key: list[str], shards: int = 8, parts: int | None = None, seed: int = 7) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: shard sizes at most one apart, slots 0, 1, ... in each shard.

    ``key`` are the columns whose values tell rows apart. Rows equal in all of them are put in any order,
    which nobody can tell. Nulls are values like others. No rows give no rows. Only the row counts of ``parts``
    parts (the shuffle partitions unless given) reach the driver. Slots come from counts of fine ranges of a random
    order, so no task holds a whole shard. Whole rows move. Columns of ``rows`` named shard or slot give way to the new ones
    and may not be in ``key``.
    """
    spark = rows.sparkSession
    rows = rows.drop("shard", "slot")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    random = [F.xxhash64(F.lit(seed + k), *key) for k in range(3)]
    dealt = rows.withColumns({"_sx_part": F.pmod(random[0], F.lit(parts)).cast("int"), "_sx_order": random[1]})
    counts = {r["_sx_part"]: r["n"] for r in dealt.groupBy("_sx_part").agg(F.count("*").alias("n")).collect()}
    matrix = communication_matrix([counts.get(p, 0) for p in range(parts)], shards, seed)
    ends = np.cumsum(matrix, axis=1)
    cuts = spark.createDataFrame([(p, ends[p].tolist()) for p in range(parts)], "_sx_part int, _sx_ends array<long>")
    rank = F.row_number().over(Window.partitionBy("_sx_part").orderBy("_sx_order", *key))
    placed = dealt.withColumn("_sx_rank", rank).join(F.broadcast(cuts), "_sx_part").withColumn(
        "shard", F.size(F.filter("_sx_ends", lambda end: end < F.col("_sx_rank"))))
    ranges = max(1, parts)
    placed = placed.withColumn("_sx_again", F.xxhash64(F.lit(seed + 2), "_sx_rank", "_sx_part", "shard")).withColumn(
        "_sx_range", F.shiftrightunsigned("_sx_again", 33) * ranges / (1 << 31)).withColumn(
        "_sx_range", F.floor("_sx_range").cast("int"))
    sizes = placed.groupBy("shard", "_sx_range").agg(F.count("*").alias("_sx_n"))
    before = F.sum("_sx_n").over(Window.partitionBy("shard").orderBy("_sx_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", "_sx_range", F.coalesce(before, F.lit(0)).alias("_sx_start"))
    inner = F.row_number().over(Window.partitionBy("shard", "_sx_range").orderBy("_sx_again", "_sx_part", "_sx_rank"))
    placed = placed.withColumn("_sx_inner", inner).join(starts, ["shard", "_sx_range"])
    return placed.withColumn("slot", F.col("_sx_start") + F.col("_sx_inner") - 1).select(*rows.columns, "shard", "slot")
