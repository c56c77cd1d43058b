"""The pipeline's stages on small rows: what goes, what stays, and which columns each stage returns."""

import corpus_pipeline as P


def test_stages(spark, sf_dir, tmp_path):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = given.unionByName(given.limit(5).selectExpr("doc_id + 100000 AS doc_id", "text", "lang", "source", "n_chars"))
    docs = docs.unionByName(spark.createDataFrame([(200000, None, "en", "s", 0), (200001, "123 !!", "en", "s", 6)], docs.schema))
    kept = {"in": {r["doc_id"] for r in docs.select("doc_id").collect()}}
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != P.STAGES[-1][0]:
            assert out.columns == P.COLUMNS
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert kept["in"] - kept["language_id"] == {200000, 200001}
    assert not any(100000 <= i < 200000 for i in kept["near_duplicates"])
    assert kept["personal_data"] == kept["decontamination"] == kept["byte_bpe"]
    leaks = {r["doc_id"] for r in given.join(spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr("text AS item"),
                                            on=given["text"].contains(P.F.col("item"))).select("doc_id").collect()}
    assert not leaks & kept["decontamination"] and kept["near_duplicates"] - kept["decontamination"] <= leaks | kept["in"]
