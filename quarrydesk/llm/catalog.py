"""Registered queries of the operators: whole tables, production parameters, digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrydesk.llm import (byte_bpe, decontaminate, imatch, language_id, parity_join, pii, prefix_trie, quality,
                            sharding, substring_dedup, suffix_dedup, token_counts, vector_codes)
from quarrydesk.llm.oracles import ORACLES
from quarrydesk.session import write_out

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def fold_of(doc_id: str | Column, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def vocabulary() -> tuple[str, str]:
    """Path and split pattern of the rank file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op1_parity_join(spark, sf_dir):
    return parity_join.near_duplicate_components(documents(spark, sf_dir))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.section_token_counts(documents(spark, sf_dir), *vocabulary())


@query
def op3_quality_rules(spark, sf_dir):
    docs, held = documents(spark, sf_dir), fold_of("doc_id", 3) == 1
    model = quality.fit_rules(docs, table(spark, sf_dir, "labels").where(~held))
    return quality.score_quality(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


@query
def op4_byte_bpe(spark, sf_dir):
    return byte_bpe.encode_documents(documents(spark, sf_dir), *vocabulary(), with_ids=False).drop("ids")


@query
def op5_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(documents(spark, sf_dir), with_text=False).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op6_imatch_fingerprints(spark, sf_dir):
    docs = documents(spark, sf_dir)
    terms = write_out(imatch.lexicon(docs), "lexicon")
    pairs = imatch.with_next(docs, guests=True)
    edited = imatch.half_edited(F.col("text"), F.col("next_text"))
    # prints are summed up and meet their neighbours' in the ranges of the texts, which are placed and moved once
    whose = ["range", "repeat", "guest", "doc_id", "n_chars"]
    both = pairs.withColumn("n_chars", F.length("text")).select(*whose, F.inline(F.array(
        F.struct(F.lit(0).alias("kind"), "text", F.lit(None).cast("string").alias("edited_sha256")),
        F.struct(F.lit(1).alias("kind"), edited.alias("text"), F.sha2(edited, 256).alias("edited_sha256")))))
    prints = imatch.fingerprints(both, terms, [*whose, "kind", "edited_sha256"])
    # two rows a text: an edited text's print stands after the text's own, which stands after both of the next document
    order = Window.partitionBy("range").orderBy("repeat", "kind")
    met = prints.select("*", F.lag("prints", 1).over(order).alias("own"), F.lag("prints", 3).over(order).alias("following"))
    out = write_out(met.where("kind = 1 AND NOT guest").select(
        "doc_id", "n_chars", "edited_sha256", "own", F.col("prints").alias("edited"),
        imatch.likeness(F.col("own"), F.col("prints")).alias("near_edited"),
        imatch.likeness(F.col("own"), F.col("following")).alias("near_next")), "prints")
    return out.select("doc_id", "n_chars", "edited_sha256", imatch.shown(F.col("own")).alias("fingerprint"),
                      imatch.shown(F.col("edited")).alias("edited_fingerprint"), "near_edited", "near_next")


@query
def op7_personal_data(spark, sf_dir):
    seen = write_out(pii.candidates(documents(spark, sf_dir)).drop("text"), "candidates")
    found = pii.find_personal_data(seen, pii.train_spans(seen))
    counts = [F.size(F.filter("pii_base", _of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("pii_base")), 256).alias("base_sha256"),
                        pii.listed(F.col("pii_spans")).alias("spans"))


def _of_kind(k: int):
    return lambda span: span["kind"] == k


@query
def op8_exact_shards(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).withColumns({"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text.cast("binary"))})
    shards = sharding.shard_exactly(rows, ["doc_id", "size", "text_crc32"], 8)
    moved = F.coalesce("text", F.lit(""))
    return shards.select("doc_id", (F.octet_length(moved) + 1).cast("long").alias("size"), F.crc32(moved.cast("binary")).alias("text_crc32"),
                         F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_nearest_centroid(spark, sf_dir):
    held = fold_of("doc_id", 4) == 2
    model = language_id.fit_centroids(table(spark, sf_dir, "documents").where(~held).select("lang", "text"))
    found = language_id.identify_languages(documents(spark, sf_dir), model)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op10_benchmark_leaks(spark, sf_dir):
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op11_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeated_bytes(documents(spark, sf_dir), with_text=False).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op12_vector_codes(spark, sf_dir):
    codes, books = vector_codes.encode_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.branched_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
