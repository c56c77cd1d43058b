"""Exact interpolated quantiles without gathering a column in one task.

``percentile`` and ``median`` keep every distinct value of a group in one
buffer. Here a sketch only proposes bucket edges (it has no say in the result),
bucket sizes locate the wanted ranks, and just the buckets that hold a wanted
rank are counted value by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_BITS = 8


def _bucket_of(value: Column, edges: Column, bits: int) -> Column:
    """Number of edges below ``value`` by binary search over 2**bits - 1 edges."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    found = F.aggregate(
        steps, F.lit(0),
        lambda low, step: F.when(F.get(edges, low + step - 1) < value, low + step).otherwise(low))
    return F.coalesce(found, F.lit(0))  # never NULL, so no filter is inferred for the join key


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    few_groups: bool = False, bits: int = BUCKET_BITS) -> DataFrame:
    """Linear-interpolated quantiles: ``by`` columns, ``n`` and array ``quantiles``.

    NULLs are skipped and groups without values give no row. One plan serves
    every size. ``few_groups`` promises a small, fixed set of groups (classes,
    features), so the edge table is broadcast; otherwise the optimiser sizes
    that join.
    """
    src = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    by = list(by)
    count = 1 << bits
    cuts = ", ".join(f"{i / count!r}D" for i in range(1, count))
    edges = src.groupBy(*by).agg(F.expr(f"percentile_approx(_v, array({cuts}), {count * 8})").alias("_edges"))
    hint = F.broadcast if (few_groups or not by) else (lambda small: small)

    if by:
        cut = src.join(hint(edges), by)
        bucketed = cut.select(*by, "_v", _bucket_of(F.col("_v"), F.col("_edges"), bits).alias("_b"))
    else:
        bucketed = src.select("_v", edges.select("_edges").scalar().alias("_edges")).select(
            "_v", _bucket_of(F.col("_v"), F.col("_edges"), bits).alias("_b"))

    sizes = bucketed.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    group = W.partitionBy(*by)
    upto = group.orderBy("_b").rowsBetween(W.unboundedPreceding, 0)
    sizes = (sizes.withColumn("_end", F.sum("_n").over(upto))
                  .withColumn("_total", F.sum("_n").over(group)))
    # Two neighbouring ranks for each probability.
    position = [F.lit(float(p)) * (F.col("_total") - 1) for p in probs]
    ranks = F.array_distinct(F.concat(F.array(*[F.floor(p) for p in position]),
                                      F.array(*[F.ceil(p) for p in position])))
    wanted = (sizes.withColumn("_ranks", ranks)
                   .withColumn("_start", F.col("_end") - F.col("_n"))
                   .withColumn("_ranks", F.filter(
                       "_ranks", lambda r: (r >= F.col("_start")) & (r < F.col("_end"))))
                   .filter(F.size("_ranks") > 0)
                   .select(*by, "_b", "_start", "_total", "_ranks"))
    # At most two buckets per probability and group.
    held = (bucketed.join(hint(wanted), [*by, "_b"])
                    .groupBy(*by, "_b", "_start", "_total", "_ranks", "_v").agg(F.count("*").alias("_m")))
    through = W.partitionBy(*by, "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    held = (held.withColumn("_last", F.col("_start") + F.sum("_m").over(through))
                .withColumn("_hit", F.filter(
                    "_ranks", lambda r: (r >= F.col("_last") - F.col("_m")) & (r < F.col("_last"))))
                .select(*by, "_total", "_v", F.explode("_hit").alias("_rank")))
    picked = held.groupBy(*by, "_total").agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))

    def at(p: float) -> Column:
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        low = F.element_at("_at", F.floor(pos))
        high = F.element_at("_at", F.ceil(pos))
        return low + (high - low) * (pos - F.floor(pos))

    return picked.select(*by, F.col("_total").alias("n"), F.array(*[at(p) for p in probs]).alias("quantiles"))


def exact_median(df: DataFrame, value: str) -> Column:
    """Exact median of a column as a scalar subquery (NULL without values)."""
    return exact_quantiles(df, value, [0.5]).select(F.get("quantiles", F.lit(0)).alias("median")).scalar()
