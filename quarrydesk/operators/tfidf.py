"""TF-IDF as long and array tables.

Copies are collapsed first: distinct texts carry their number of copies, so a
text that fills a third of the table is tokenised once. Distinct texts are then
laid out by document; counting terms, weighting and gathering a document's
vector all keep that layout and need no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarrydesk.functions.text import terms, tokens
from quarrydesk.schema import ROW_SEQ
from quarrydesk.session import write_out

# --- fixed values -----------------------------------------------------------
MAX_FEATURES = 15_000
MAX_FEATURES_SIMILARITY = 5_000
MIN_DF = 2
# ----------------------------------------------------------------------------
BROADCAST_ROWS = 1_000_000


def distinct_texts(df: DataFrame, text: str = "ticket_text", id_col: str = ROW_SEQ) -> DataFrame:
    """One row per distinct text: ``doc`` (its lowest id), ``text``, ``copies``. NULL counts as empty."""
    return (df.groupBy(F.coalesce(F.col(text), F.lit("")).alias("text"))
              .agg(F.min(id_col).alias("doc"), F.count("*").alias("copies")))


def by_document(df: DataFrame, *keys: str) -> DataFrame:
    """Hash layout over all shuffle partitions.

    The number is explicit because terms take many times the bytes of the text
    they come from: sizing partitions by the text would leave too few tasks.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _occurrences(texts: DataFrame) -> DataFrame:
    """(doc, copies, term): one row per term occurrence, laid out by document."""
    laid_out = by_document(texts, "doc").withColumn("_tokens", tokens(F.col("text")))
    return laid_out.select("doc", "copies", F.explode(terms(F.col("_tokens"))).alias("term"))


def term_counts(texts: DataFrame) -> DataFrame:
    """(doc, copies, term, tf) for texts with columns ``doc, copies, text``."""
    return _occurrences(texts).groupBy("doc", "copies", "term").agg(F.count("*").alias("tf"))


def known_term_counts(texts: DataFrame, vocabulary: DataFrame, max_features: int) -> DataFrame:
    """(doc, copies, <numeric vocabulary columns>, tf), terms outside the vocabulary left out.

    Occurrences meet the vocabulary before they are counted: most n-grams drop
    out there, and the rest are counted by number instead of by text.
    """
    numbers = [c for c in vocabulary.columns if c != "term"]
    known = _occurrences(texts).join(bounded_broadcast(vocabulary, max_features), "term")
    return known.groupBy("doc", "copies", *numbers).agg(F.count("*").alias("tf"))


def document_total(texts: DataFrame) -> Column:
    """Number of documents, copies included, as a scalar subquery."""
    return texts.agg(F.sum("copies")).scalar()


def smooth_idf(documents: Column, containing: Column) -> Column:
    return F.log((documents + 1) / (containing + 1)) + 1


def fit_vocabulary(counts: DataFrame, documents: Column, max_features: int = MAX_FEATURES,
                   min_df: int = MIN_DF) -> DataFrame:
    """(term, idx, df, total, idf): frequent enough terms, capped by total count, ties by term.

    ``idx`` is alphabetical; that window sees at most ``max_features`` rows.
    """
    stats = counts.groupBy("term").agg(F.sum("copies").alias("df"), F.sum(F.col("tf") * F.col("copies")).alias("total"))
    kept = (stats.filter(F.col("df") >= min_df).orderBy(F.desc("total"), "term").limit(max_features))
    index = (F.row_number().over(W.partitionBy().orderBy("term")) - 1).alias("idx")
    return kept.select("term", index, "df", "total", smooth_idf(documents, F.col("df")).alias("idf"))


def bounded_broadcast(vocabulary: DataFrame, max_features: int) -> DataFrame:
    """A vocabulary has at most ``max_features`` rows; beyond the bound the optimiser decides."""
    return F.broadcast(vocabulary) if max_features <= BROADCAST_ROWS else vocabulary


def weighted_terms(texts: DataFrame, vocabulary: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """(doc, copies, idx, tf, raw): sublinear tf times idf, not yet normalised."""
    counts = known_term_counts(texts, vocabulary.select("term", "idx", "idf"), max_features)
    return counts.select("doc", "copies", "idx", "tf", ((F.log("tf") + 1) * F.col("idf")).alias("raw"))


def unit_vectors(weighted: DataFrame) -> DataFrame:
    """(doc, copies, vector array<struct<idx, w>>) of unit length, ordered by idx."""
    gathered = weighted.groupBy("doc", "copies").agg(
        F.sort_array(F.collect_list(F.struct("idx", "raw"))).alias("_terms"),
        F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("_norm"))
    return gathered.select("doc", "copies", F.transform(
        "_terms", lambda t: F.struct(t["idx"].alias("idx"), (t["raw"] / F.col("_norm")).alias("w"))).alias("vector"))


def normalised_terms(weighted: DataFrame) -> DataFrame:
    """(doc, copies, idx, weight) with unit length per document."""
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy("doc")))
    return weighted.select("doc", "copies", "idx", (F.col("raw") / norm).alias("weight"))


def tfidf(df: DataFrame, max_features: int = MAX_FEATURES, min_df: int = MIN_DF, text: str = "ticket_text",
          id_col: str = ROW_SEQ) -> tuple[DataFrame, DataFrame]:
    """Fit on ``df``: (vocabulary, weighted terms of its distinct texts)."""
    texts = distinct_texts(df, text, id_col)
    vocabulary = fit_vocabulary(term_counts(texts), document_total(texts), max_features, min_df)
    vocabulary = write_out(vocabulary, "vocabulary")
    return vocabulary, weighted_terms(texts, vocabulary, max_features)


def pair_similarity(pairs: DataFrame, ids: list[str], left: str, right: str) -> DataFrame:
    """Lexical cosine of two text columns, each pair its own two-document corpus.

    Adds ``similarity`` and ``shared_words`` (sorted white-space words of both).
    Pairs are laid out by id once; counting and summing keep that layout, and
    the cost is linear in the text lengths.
    """
    def sided(column: str, side: int) -> Column:
        found = terms(F.col(column))
        return F.transform(found, lambda t: F.struct(t.alias("term"), F.lit(side).alias("side")))

    laid_out = (by_document(pairs, *ids).withColumn("_a", tokens(F.col(left), accents=False))
                     .withColumn("_b", tokens(F.col(right), accents=False)))
    counted = (laid_out.select(*ids, F.inline(F.concat(sided("_a", 0), sided("_b", 1))))
                       .groupBy(*ids, "term")
                       .agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b")))
    seen_in = F.when((F.col("a") > 0) & (F.col("b") > 0), 2).otherwise(1)
    idf = smooth_idf(F.lit(2), seen_in)
    weigh = {side: F.when(F.col(side) > 0, (F.log(side) + 1) * idf).otherwise(0.0) for side in ("a", "b")}
    sums = counted.withColumns(weigh).groupBy(*ids).agg(
        F.sum(F.col("a") * F.col("b")).alias("_ab"), F.sum(F.col("a") * F.col("a")).alias("_aa"),
        F.sum(F.col("b") * F.col("b")).alias("_bb"))
    norm = F.sqrt("_aa") * F.sqrt("_bb")
    cosines = sums.select(*ids, F.when(norm > 0, F.col("_ab") / norm).otherwise(0.0).alias("similarity"))

    def words(column: str) -> Column:
        return F.regexp_extract_all(F.col(column), F.lit(r"\S+"), F.lit(0))

    shared = F.array_sort(F.array_intersect(words(left), words(right)))
    return (pairs.withColumn("shared_words", shared).join(cosines, ids, "left")
                 .withColumn("similarity", F.coalesce("similarity", F.lit(0.0))))
