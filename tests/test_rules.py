"""Golden rows for the semantic traps."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarrydesk.functions import numeric, text
from quarrydesk.functions.encoders import load_hashing_encoder
from quarrydesk.operators import (audit, calibration, cleaning, dedupe, explain, features, metrics, reports, retrieval,
                                  routing)
from quarrydesk.operators import tfidf as tf
from quarrydesk.sources import tickets


def one(df):
    return df.first()[0]


def column(df, name):
    return [r[name] for r in df.collect()]


def test_text_keeps_blank_drops_null_and_strips_all_white_space(spark):
    df = spark.createDataFrame([(1, "\t Hello \n\n WORLD\x1c "), (2, "   "), (3, None)], "i int, ticket_text string")
    assert column(cleaning.clean_text(df).orderBy("i"), "ticket_text") == ["hello world", ""]


@pytest.mark.parametrize("bad", ["13/32/2023 10:00:00", "2023/99/01 00:00", "not-a-date", "Jan 2023", "", "2023-02-30 10:00:00", "2023", None])
def test_bad_timestamps(spark, bad):
    df = spark.createDataFrame([(bad,)], "created_at string")
    assert cleaning.fix_timestamps(df).count() == 0


def test_monday_is_zero(spark):
    row = cleaning.fix_timestamps(spark.createDataFrame([("2024-01-01 23:59:59",)], "created_at string")).first()
    assert (row["created_at"], row["hour_of_day"], row["day_of_week"], row["month"]) == (datetime(2024, 1, 1, 23, 59, 59), 23, 0, 1)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (9999.0,), (3.0,)], "resolution_time double")
    assert column(cleaning.cap_hours(df), "resolution_time") == [None, 0.0, 8760.0, 3.0]


def test_median_interpolates_over_resolved_rows_only(spark):
    rows = [(1.0, True), (2.0, True), (3.0, True), (10.0, True), (500.0, False), (None, True), (None, False)]
    got = cleaning.impute_hours(spark.createDataFrame(rows, "resolution_time double, resolved boolean"))
    assert column(got, "resolution_time") == [1.0, 2.0, 3.0, 10.0, 500.0, 2.5, None]


def test_dedupe_keeps_first_and_treats_nulls_as_equal(spark):
    rows = [(3, "c", "x", None), (1, "a", "x", None), (2, "b", "x", 1.0)]
    df = spark.createDataFrame(rows, "row_seq long, ticket_id string, ticket_text string, previous_tickets double")
    once = dedupe.drop_exact_copies(df)
    assert sorted(column(once, "ticket_id")) == ["a", "b"]
    assert sorted(column(dedupe.drop_exact_copies(once), "ticket_id")) == ["a", "b"]
    assert one(audit.exact_duplicates(df)) == 1


@pytest.mark.parametrize("gap,flagged", [(15, True), (16, False)])
def test_length_band_is_inclusive(spark, gap, flagged):
    rows = [("c", "x" * 10), ("c", "x" * (10 + gap)), ("d", "x" * 10)]
    got = dedupe.flag_near_duplicates(spark.createDataFrame(rows, "customer_id string, ticket_text string"))
    assert {r["customer_id"]: r["is_near_duplicate"] for r in got.collect()} == {"c": flagged, "d": False}


def test_lexical_pair_score(spark):
    pairs = spark.createDataFrame([(1, "i was charged twice for the same order.",
                                    "my credit card was billed twice for a single purchase."), (2, "", "x")],
                                  "i int, a string, b string")
    rows = {r["i"]: r for r in tf.pair_similarity(pairs, ["i"], "a", "b").collect()}
    assert round(rows[1]["similarity"], 4) == 0.1573
    assert rows[1]["shared_words"] == ["for", "twice", "was"]
    assert rows[2]["similarity"] == 0.0


def test_accent_forms_agree(spark):
    df = spark.createDataFrame([("Überraß Señor naïve été",)], "t string")
    row = df.select(text.strip_accents(F.col("t")), text.strip_accents_nfkd(F.col("t"))).first()
    assert row[0] == row[1] == "Uberraß Senor naive ete"


def test_accents_of_every_character(spark):
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    rows = [(codes[k], "".join(map(chr, codes[k:k + 400]))) for k in range(0, len(codes), 400)]
    rows += [(-k, t) for k, t in enumerate(["", "ab", "\ufb01n", "x\uac01\u0301y\U0001d400", "\u0301", None])]
    df = spark.createDataFrame(rows, "k int, t string")
    got = df.select("k", text.strip_accents(F.col("t")).alias("ours"), text.strip_accents_nfkd(F.col("t")).alias("full")).collect()
    assert len(got) == len(rows) and [r["k"] for r in got if r["ours"] != r["full"]] == []


def test_bigrams_guard_short_lists(spark):
    df = spark.createDataFrame([(["a"],), ([],), (["a", "b", "c"],)], "t array<string>")
    assert column(df.select(text.bigrams(F.col("t")).alias("b")), "b") == [[], [], ["a b", "b c"]]


def test_unseen_product_is_all_zeros(spark):
    df = spark.createDataFrame([("p",), ("q",), (None,)], "product string")
    assert [sum(r) for r in df.select(*features.one_hot(F.col("product"), ["p"])).collect()] == [1, 0, 0]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    row = features.numeric_statistics(df, ["x"]).first()
    assert (row["median"], row["mean"], row["std"]) == (2.0, 2.0, 1.0)


def test_leakage_guard_raises():
    with pytest.raises(ValueError):
        features.leakage_guard(["month", "resolved"])


def test_macro_f1_counts_labels_of_truth_and_prediction(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "b")], "label string, prediction string")
    counts = metrics.confusion_counts(df)
    assert round(metrics.summary(counts).first()["macro_f1"], 6) == round((2 / 3 + 1 + 0) / 3, 6)
    assert metrics.confusion_matrix(counts).count() == 9


def test_constant_probability_is_one_bin_and_perfect_is_no_error(spark):
    rows = [("c", float(i % 2), 0.5) for i in range(10)]
    flat = spark.createDataFrame(rows, "label string, hit double, p double")
    curve = calibration.reliability_curve(calibration.quantile_bins(flat))
    assert curve.count() == 1
    perfect = spark.createDataFrame([("c", float(i % 2), float(i % 2)) for i in range(10)], "label string, hit double, p double")
    assert calibration.adaptive_error(calibration.reliability_curve(calibration.quantile_bins(perfect))).first()["ece"] == 0.0


def test_half_is_accepted(spark):
    df = spark.createDataFrame([("x", 0.5), ("y", 0.4999)], "prediction string, confidence double")
    assert column(routing.ood_guard(df), "predicted_category") == ["x", None]


def test_scenarios_against_expected_flags(spark):
    # Six scenarios with their published top confidence and expected flag.
    cases = [("weather", 0.455, True), ("recipe", 0.371, True), ("sports", 0.388, True),
             ("ban", 0.973, False), ("purchase", 0.988, False), ("crash", 0.594, False)]
    scored = spark.createDataFrame([(n, "c", p) for n, p, _ in cases], "name string, prediction string, confidence double")
    expected = spark.createDataFrame([(n, e) for n, _, e in cases], "name string, expected_uncertain boolean")
    got = routing.ood_benchmark(routing.ood_guard(scored), expected, "name")
    assert set(column(got, "result")) == {"PASSED"}


@pytest.mark.parametrize("length,ends", [(80, False), (81, True)])
def test_preview_ellipsis(spark, length, ends):
    df = spark.createDataFrame([("x" * length,)], "t string")
    assert one(df.select(text.shorten(F.col("t"), 80, 80))).endswith("...") is ends


def test_one_decimal_rounds_the_binary_value(spark):
    values = [69.05, 0.25, 0.35, 12.45, 99.95, 100.0, 0.0, 98.8]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert column(df.select(numeric.one_decimal(F.col("v")).alias("t")), "t") == [f"{v:.1f}" for v in values]


def test_requests_are_split(spark):
    rows = [("  hi  ", None, None, None, None), ("   ", "p", 1, 5, 5), ("x", "p", -1, 5, 5), ("x", "p", 0, 51, 5), ("x", "p", 0, 5, 0)]
    df = spark.createDataFrame(rows, "ticket_text string, product string, previous_tickets int, top_k int, top_n int")
    checked = routing.validate_requests(df, "general")
    good = routing.valid_requests(checked).first()
    assert (good["ticket_text"], good["product"], good["previous_tickets"], good["top_k"], good["top_n"]) == ("hi", "general", 0, 5, 5)
    assert routing.rejected_requests(checked).count() == 4


def test_empty_month_counts_zero_and_empty_hour_is_absent(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-05 03:00:00' AS created_at, 3 AS hour_of_day UNION ALL SELECT timestamp_ntz'2024-03-01 05:00:00', 5")
    months = {r["label"]: r["n"] for r in reports.monthly_volume(df).collect()}
    assert months == {"Jan 2024": 1, "Feb 2024": 0, "Mar 2024": 1}
    assert sorted(column(reports.hourly_volume(df), "hour_of_day")) == [3, 5]


def test_absent_priority_is_null(spark):
    df = spark.createDataFrame([("LOW",), ("LOW",)], "priority string")
    assert {r["priority"]: r["n"] for r in reports.ordered_frequency(df).collect()} == {"LOW": 2, "MEDIUM": None, "HIGH": None}


def test_backfill_follows_active_features(spark):
    vectors = spark.createDataFrame([(1, "text__a", 0.5), (1, "text__b", 0.5)], "row_seq int, feature string, x double")
    predicted = spark.createDataFrame([(1, "k"), (2, "k")], "row_seq int, prediction string")
    weights = spark.createDataFrame([("k", "text__a", 0.2), ("k", "text__b", -1.0), ("k", "text__c", 3.0)], "label string, feature string, w double")
    got = {r["row_seq"]: [(f["feature"], f["contribution"]) for f in r["top_features"]]
           for r in explain.explanations(vectors, predicted, weights, "row_seq", 3).collect()}
    assert got == {1: [("text__a", 0.1), ("text__c", 0.0)], 2: [("text__c", 0.0), ("text__a", 0.0)]}


def test_csv_reader_keeps_corrupt_lines_and_missing_path_raises(spark, tmp_path):
    (tmp_path / "t.csv").write_text("ticket_id,customer_id,ticket_text,product,created_at,previous_tickets,resolution_time,priority,category,resolved\n"
                                    'A,c,"two\nlines",p,2024-01-01 00:00:00,1,NaN,LOW,x,true\nB,c,t,p,2024-01-01 00:00:00,oops,2,LOW,x,true\n')
    good, bad = tickets.split_corrupt(tickets.read_raw_csv(spark, str(tmp_path / "t.csv"), multi_line=True))
    row = good.collect()
    assert [(r["ticket_text"], r["resolution_time"]) for r in row] == [("two\nlines", None)]
    assert bad.count() == 1
    with pytest.raises(Exception):
        tickets.read_raw_csv(spark, str(tmp_path / "nothing.csv")).count()


def test_encoder_feeds_the_index(spark):
    df = spark.createDataFrame([("a", "login fails"), ("b", "refund please"), ("c", None)], "ticket_id string, ticket_text string")
    index = retrieval.build_index(retrieval.encode_texts(df, load_hashing_encoder, batch=2))
    assert {r["product"] for r in index.collect()} == {"Unknown"}
    asked = retrieval.encode_texts(spark.createDataFrame([("q", "login fails"), ("blank", "  ")], "query_id string, query_text string"),
                                   load_hashing_encoder, text="query_text")
    found = retrieval.similar_tickets(index, asked, 50).collect()
    assert len(found) == 3 and {r["query_id"] for r in found} == {"q"}
    assert min(found, key=lambda r: r["rank"])["ticket_id"] == "a"


def test_accents_are_looked_for_beyond_ascii_only(spark):
    samples = ["plain", "caf\u00e9 \ufb01ne \u00bd", "\ud55c\uad6d \u1100", "\u0130x \u00df", "a\u0301b", "\U0001d400 \U0001f389", "", None]
    df = spark.createDataFrame([(t,) for t in samples], "t string")
    out = df.select(text.strip_accents(F.col("t")).alias("a"), text.strip_accents_nfkd(F.col("t")).alias("b"))
    assert all(r["a"] == r["b"] for r in out.collect())
    plan = df.select(text.strip_accents(F.col("t")).alias("a"))._jdf.queryExecution().analyzed().toString()
    assert r"[[^\x00-\x7F]&&[" in plan
