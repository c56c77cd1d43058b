"""I-Match document fingerprints, in Spark SQL functions alone.

A lexicon holds the terms whose inverse document frequency lies in a band. A document's fingerprint hashes its distinct
lexicon terms once for each of several randomised lexicon subsets. A term's 64-bit code stands for the term, and the
codes of a subset are combined by XOR: like hashing a sorted list of distinct terms, that does not depend on
their order or number of occurrences, and it needs no sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The band: a term is in this share of all documents at least, and at most. The lower end bounds the lexicon: with d
#: distinct terms in a mean document there are at most d / LEAST terms, however many documents there are.
LEAST, MOST = 0.0005, 0.2
#: The subsets: the whole lexicon, and for each further rate r ``SUBSETS`` disjoint random subsets that each hold 1 / r of
#: it. Partly changed short texts are told by the larger ones, long texts by the smaller ones.
RATES = [1, 16, 64, 256, 1024]
SUBSETS = 16
#: A lexicon beyond so many terms is joined by a shuffle instead of a broadcast.
BROADCAST_TERMS = 2_000_000
_SPACE = r"[\x20\x09-\x0D]+"


def term_codes(text: Column) -> Column:
    """Distinct 64-bit codes of a text's lower-cased words."""
    return F.array_distinct(F.transform(F.filter(F.split(F.lower(text), _SPACE), lambda w: w != ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text_col: str = "text", least: float = LEAST, most: float = MOST) -> DataFrame:
    """``term``: codes of the terms in the band over all documents. Null texts count as documents without terms."""
    total = docs.count()
    terms = docs.select(F.explode(term_codes(F.col(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return terms.where((F.col("df") >= F.greatest(F.lit(2), F.lit(least * total))) & (F.col("df") <= most * total)).select("term")


def _subsets() -> list[tuple[int, int]]:
    return [(rate, k) for rate in RATES for k in range(SUBSETS if rate > 1 else 1)]


def fingerprints(texts: DataFrame, terms: DataFrame, key: list[str], text_col: str = "text") -> DataFrame:
    """``key`` columns and ``prints``: one code for each subset, 0 for a subset without terms.

    A row's words are dealt out and summed up again in the same task, so only one row of codes for each text is
    shuffled. Rows with equal keys are one text: keys must tell texts apart. Texts without lexicon terms keep a row.
    """
    spark = texts.sparkSession
    small = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    listed = F.broadcast(terms.withColumn("known", F.lit(True))) if small else terms.withColumn("known", F.lit(True))
    words = texts.select(*key, F.explode_outer(term_codes(F.col(text_col))).alias("term")).join(listed, "term", "left")
    # which subset of a rate a term is in is read from its code for that rate
    folded = [F.coalesce(F.bit_xor(F.when(F.pmod(F.col(f"code_{rate}"), F.lit(rate)) == k, F.col(f"code_{rate}"))), F.lit(0)).alias(
        f"p{rate}_{k}") for rate, k in _subsets()]
    coded = words.withColumns({f"code_{rate}": F.when(F.col("known"), F.xxhash64(F.lit(rate), "term")) for rate in RATES})
    summed = coded.groupBy(*key).agg(*folded)
    return summed.select(*key, F.array(*[F.col(f"p{rate}_{k}") for rate, k in _subsets()]).alias("prints"))


def shown(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda p: F.lpad(F.lower(F.hex(p)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal codes among the subsets that hold a term of either text; 1 for two texts without any."""
    pairs = F.arrays_zip(a.alias("x"), b.alias("y"))
    held = F.filter(pairs, lambda p: (p["x"] != 0) | (p["y"] != 0))
    same = F.size(F.filter(held, lambda p: p["x"] == p["y"]))
    return F.when(F.size(held) == 0, F.lit(1.0)).otherwise(same.cast("double") / F.size(held))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", guests: bool = False) -> DataFrame:
    """``doc_id, text, next_id, next_text, repeat, copy, range``: the next document by descending id; after the last comes the first.

    ``repeat`` is a row's place in its range and tells rows of one id apart, ``copy`` marks a row whose id and text an
    earlier row has. With ``guests`` the texts that stand before a range stay as rows, marked by a column ``guest``.

    Ids are cut into ranges; each text moves once, and the last text of a range also goes to the following one. Rows of
    one id are ordered by their text. Rows with a null id are left out, and null texts are empty.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where(
        "doc_id IS NOT NULL")
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2000)
    marks = rows.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)] or [1.0], 10_000).alias("m")).first()["m"]
    marks = sorted(set(marks or []))
    bounds = F.array(*[F.lit(m).cast("long") for m in marks]) if marks else F.array().cast("array<bigint>")
    ranged = rows.withColumn("range", F.size(F.filter(bounds, lambda m: m < F.col("doc_id"))))
    ends = ranged.groupBy("range").agg(F.max("doc_id").alias("top")).orderBy("range").collect()
    if not ends:
        alone = rows.withColumns({"next_id": F.col("doc_id"), "next_text": F.col("text"), "repeat": F.lit(1), "copy": F.lit(False),
                                  "range": F.lit(0)})
        return alone.withColumn("guest", F.lit(False)) if guests else alone
    # the greatest id of a range goes on to the next filled range, that of the last range to the first one
    onward = {r["top"]: ends[(k + 1) % len(ends)]["range"] for k, r in enumerate(ends)}
    goes = spark.createDataFrame(list(onward.items()), "doc_id long, onward int")
    copies = ranged.join(F.broadcast(goes), "doc_id", "left").select(
        "doc_id", "text", F.explode(F.when(F.col("onward").isNull(), F.array(F.struct("range", F.lit(False).alias("guest")))).otherwise(
            F.array(F.struct("range", F.lit(False).alias("guest")), F.struct(F.col("onward").alias("range"), F.lit(True).alias("guest"))))).alias("at"))
    copies = copies.select("doc_id", "text", F.col("at.range").alias("range"), F.col("at.guest").alias("guest"))
    # a guest stands before its range, whatever its id
    order = Window.partitionBy("range").orderBy(F.col("guest").desc(), "doc_id", "text")
    placed = copies.select("doc_id", "text", "guest", F.lag("doc_id").over(order).alias("next_id"),
                           F.lag("text").over(order).alias("next_text"), F.row_number().over(order).alias("repeat"),
                           F.coalesce(~F.lag("guest").over(order) & (F.lag("doc_id").over(order) == F.col("doc_id"))
                                      & (F.lag("text").over(order) == F.col("text")), F.lit(False)).alias("copy"), "range")
    return placed if guests else placed.where(~F.col("guest")).drop("guest")


def half_edited(text: Column, next_text: Column) -> Column:
    """The last half of the text's code points replaced by the first as many (or all) of the next text."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))
