"""Train/test splits, fold assignment and their leak checks.

Both splits find one hash cutoff and then filter rows: the split itself moves
no data, and re-running it gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrydesk.functions.numeric import pct
from quarrydesk.functions.ranking import hash_cutoff, hash_rank, seeded_hash
from quarrydesk.schema import require_columns

# --- fixed values -----------------------------------------------------------
TEST_SIZE = 0.2
SEED = 42
FOLDS = 5
# ----------------------------------------------------------------------------


def _assign(df: DataFrame, id_col: str, seed: int, cutoff) -> DataFrame:
    in_test = F.coalesce(seeded_hash(seed, F.col(id_col)) <= cutoff, F.lit(False))
    return df.withColumn("split", F.when(in_test, "test").otherwise("train"))


def random_split(df: DataFrame, test_size: float = TEST_SIZE, seed: int = SEED, id_col: str = "ticket_id") -> DataFrame:
    """Exactly ceil(n * test_size) rows are ``test``."""
    require_columns(df, id_col)
    ids = df.select(id_col)
    wanted = F.ceil(ids.agg(F.count("*")).scalar() * F.lit(test_size))
    return _assign(df, id_col, seed, hash_cutoff(ids, id_col, seed, wanted))


def customer_split(df: DataFrame, test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """floor(customers * test_size) customers are ``test`` with all their rows.

    A row's side depends on its customer alone, so no customer can be on both.
    """
    require_columns(df, "customer_id")
    ids = df.select("customer_id").distinct()
    wanted = F.floor(ids.agg(F.count("*")).scalar() * F.lit(test_size))
    return _assign(df, "customer_id", seed, hash_cutoff(ids, "customer_id", seed, wanted))


def train_rows(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split") == "train").drop("split")


def test_rows(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split") == "test").drop("split")


def customer_overlap(split: DataFrame) -> DataFrame:
    """Customers on each side and on both, one pass over customers."""
    sides = split.groupBy("customer_id").agg(F.max((F.col("split") == "test").cast("int")).alias("_test"),
                                             F.max((F.col("split") == "train").cast("int")).alias("_train"))
    counts = sides.agg(F.count_if(F.col("_train") == 1).alias("train_customers"),
                       F.count_if(F.col("_test") == 1).alias("test_customers"),
                       F.count_if((F.col("_test") == 1) & (F.col("_train") == 1)).alias("shared_customers"))
    return counts.withColumn("shared_pct", pct(F.col("shared_customers"), F.col("test_customers")))


def assert_disjoint(split: DataFrame) -> DataFrame:
    """Raise when a customer is on both sides."""
    shared = customer_overlap(split).first()["shared_customers"]
    if shared:
        raise ValueError(f"customer leakage: {shared} customers on both sides of the split")
    return split


def stratified_folds(df: DataFrame, label: str = "category", folds: int = FOLDS, seed: int = SEED,
                     id_col: str = "ticket_id") -> DataFrame:
    """``fold`` in 0..folds-1, even inside each class; a dominant class stays spread over tasks."""
    ranked = hash_rank(df, id_col, seed, by=[label], out="_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")
