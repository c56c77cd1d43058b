"""Model features: text, product and numbers in one sparse space, fitted on train rows only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrydesk.functions.quantiles import exact_quantiles
from quarrydesk.operators import tfidf as tf
from quarrydesk.operators.audit import null_counts
from quarrydesk.schema import CATEGORICAL_FEATURE, MODEL_INPUT, NUMERIC_FEATURES, POST_OUTCOME_FEATURES, ROW_SEQ
from quarrydesk.session import write_out


def leakage_guard(columns: list[str]) -> None:
    """Raise when a post-outcome column is among model inputs."""
    leaky = [c for c in columns if c in POST_OUTCOME_FEATURES]
    if leaky:
        raise ValueError(f"post-outcome feature(s) in model input: {', '.join(leaky)}")


def leakage_report(df: DataFrame) -> DataFrame:
    """(feature, role, reason, filled): every column with its role and how many rows hold a value."""
    name = F.col("column_name")
    role = (F.when(name.isin(*POST_OUTCOME_FEATURES), "post-outcome").when(name.isin(*MODEL_INPUT), "model input")
            .otherwise("not used"))
    reason = F.lit(None).cast("string")
    for feature, why in POST_OUTCOME_FEATURES.items():
        reason = F.when(name == feature, why).otherwise(reason)
    total = df.agg(F.count("*")).scalar()
    return null_counts(df).select(name.alias("feature"), role.alias("role"), reason.alias("reason"), (total - F.col("n")).alias("filled"))


def one_hot(product: Column, categories: list[str]) -> list[Column]:
    """0/1 columns; an unseen or NULL product is all zeros."""
    return [F.coalesce((product == c).cast("int"), F.lit(0)).alias(f"product_{c}") for c in categories]


def numeric_statistics(train: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, median, mean, std): exact median; mean and population std after imputing.

    A constant feature gets std 1.
    """
    long = train.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])))
    medians = exact_quantiles(long, "value", [0.5], by=["feature"], few_groups=True).select(
        "feature", F.get("quantiles", F.lit(0)).alias("median"))
    filled = long.join(F.broadcast(medians), "feature").withColumn("value", F.coalesce("value", "median"))
    std = F.stddev_pop("value")
    return filled.groupBy("feature", "median").agg(
        F.avg("value").alias("mean"), F.when(std > 0, std).otherwise(1.0).alias("std"))


def scaled(value: Column, median: Column, mean: Column, std: Column) -> Column:
    return (F.coalesce(value, median) - mean) / std


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c); few rows."""
    counts = train.groupBy(label).agg(F.count("*").alias("_n"))
    everything = W.partitionBy()
    return counts.select(label, (F.sum("_n").over(everything) / (F.count("*").over(everything) * F.col("_n"))).alias("weight"))


def label_codes(train: DataFrame, label: str) -> DataFrame:
    """(label, code): sorted labels to 0..k-1."""
    return train.select(label).distinct().withColumn(
        "code", F.row_number().over(W.partitionBy().orderBy(label)) - 1)


@dataclass(frozen=True)
class FeatureSpace:
    """Fitted statistics. ``vocabulary`` is a table; products and numbers are a handful."""

    vocabulary: DataFrame                       # term, idx, df, total, idf
    text_size: int
    products: tuple[str, ...]
    numbers: tuple[tuple[str, float, float, float], ...]   # feature, median, mean, std
    max_features: int

    @property
    def size(self) -> int:
        return self.text_size + len(self.products) + len(self.numbers)

    def names(self) -> DataFrame:
        """(idx, feature) of the whole space, in order."""
        spark = self.vocabulary.sparkSession
        tail = [(self.text_size + i, f"cat__product_{p}") for i, p in enumerate(self.products)]
        tail += [(self.text_size + len(self.products) + i, f"num__{n[0]}") for i, n in enumerate(self.numbers)]
        words = self.vocabulary.select(F.col("idx").cast("int").alias("idx"), F.concat(F.lit("text__"), "term").alias("feature"))
        return words.unionByName(spark.createDataFrame(tail, "idx int, feature string"))

    def other_entries(self) -> Column:
        """array<struct<idx, x>> of product and numbers for one row."""
        first = self.text_size
        products = F.array(*[F.lit(p) for p in self.products]) if self.products else F.array().cast("array<string>")
        place = F.array_position(products, F.col(CATEGORICAL_FEATURE)).cast("int")
        product = F.when(place > 0, F.array(F.struct((place + (first - 1)).alias("idx"), F.lit(1.0).alias("x"))))
        start = first + len(self.products)
        numbers = [F.struct(F.lit(start + i).alias("idx"),
                            scaled(F.col(n).cast("double"), F.lit(med), F.lit(mean), F.lit(std)).alias("x"))
                   for i, (n, med, mean, std) in enumerate(self.numbers)]
        empty = F.array().cast("array<struct<idx:int,x:double>>")
        return F.concat(F.coalesce(product, empty), F.array(*numbers) if numbers else empty)

    def text_entries(self, df: DataFrame, key: str = ROW_SEQ) -> DataFrame:
        """(key, text_vector array<struct<idx, x>>) for rows with a known term."""
        rows = df.select(F.col(key).alias("doc"), F.lit(1).cast("long").alias("copies"),
                         F.coalesce("ticket_text", F.lit("")).alias("text"))
        weighted = tf.weighted_terms(rows, self.vocabulary, self.max_features)
        return tf.unit_vectors(weighted).select(F.col("doc").alias(key), F.transform(
            "vector", lambda e: F.struct(e["idx"].cast("int").alias("idx"), e["w"].alias("x"))).alias("text_vector"))

    def transform(self, df: DataFrame, key: str = ROW_SEQ) -> DataFrame:
        """Add ``entries array<struct<idx, x>>``, ordered by idx."""
        joined = df.join(self.text_entries(df, key), key, "left")
        empty = F.array().cast("array<struct<idx:int,x:double>>")
        return joined.withColumn("entries", F.concat(F.coalesce("text_vector", empty), self.other_entries())).drop("text_vector")

    def save(self, path: str) -> None:
        spark = self.vocabulary.sparkSession
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        row = [(self.text_size, list(self.products), [list(n[1:]) for n in self.numbers], [n[0] for n in self.numbers],
                self.max_features)]
        spark.createDataFrame(row, "text_size int, products array<string>, stats array<array<double>>, "
                                   "numeric array<string>, max_features int").write.mode("overwrite").parquet(f"{path}/rest")


def load_space(spark: SparkSession, path: str) -> FeatureSpace:
    rest = spark.read.parquet(f"{path}/rest").first()
    numbers = tuple((n, *s) for n, s in zip(rest["numeric"], rest["stats"]))
    return FeatureSpace(spark.read.parquet(f"{path}/vocabulary"), rest["text_size"], tuple(rest["products"]), numbers,
                        rest["max_features"])


def fit_space(train: DataFrame, max_features: int = tf.MAX_FEATURES, numeric: list[str] | None = None) -> FeatureSpace:
    """Fit on train rows only. Post-outcome columns must be named explicitly to get in."""
    numeric = NUMERIC_FEATURES if numeric is None else numeric
    texts = tf.distinct_texts(train)
    fitted = tf.fit_vocabulary(tf.term_counts(texts), tf.document_total(texts), max_features)
    vocabulary = write_out(fitted, "vocabulary")
    products = tuple(r[0] for r in train.select(CATEGORICAL_FEATURE).filter(F.col(CATEGORICAL_FEATURE).isNotNull())
                     .distinct().orderBy(CATEGORICAL_FEATURE).collect())
    stats = {r["feature"]: r for r in numeric_statistics(train, numeric).collect()}
    numbers = tuple((n, stats[n]["median"], stats[n]["mean"], stats[n]["std"]) for n in numeric if n in stats)
    return FeatureSpace(vocabulary, vocabulary.count(), products, numbers, max_features)
