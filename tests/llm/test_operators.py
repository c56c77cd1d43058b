"""Operators against brute force on awkward rows: nulls, empty and long texts, copies, clashing extra columns."""

import base64
import hashlib
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrydesk.llm import (byte_bpe, catalog, components, decontaminate, imatch, language_id, parity_join, pii, quality,
                            sharding, substring_dedup, token_counts)

WORD = r"[^\x20\x09-\x0D]+"
BASE = [f"w{i}" for i in range(60)]


def near(k):
    return " ".join(x if i % 60 != k else f"z{k}" for i, x in enumerate(BASE))


TEXTS = {
    1: " ".join(BASE), 2: " ".join(BASE), 3: near(5), 4: near(40), 5: None, 6: "", 7: " \t\n", 8: "one two", 9: "ONE  two",
    10: "Ünïcode 🎉 text\nwith lines\n\n", 11: " ".join(BASE[:30] + [f"q{i}" for i in range(40)]),
    12: "long " * 20000, 13: "long " * 20001, 14: " ".join(f"w{i}" for i in range(7, 90)), 15: "!!! 123",
    16: "mail a.b@c.de or +1 (988) 555-2485, 10.0.0.1 and 4111 1111 1111 1111, 999.1.1.1", 17: "a@b.c_d@e.f"}


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 3 else "en", "src0", 1, "n", 0) for i, t in TEXTS.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string, part int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_near_duplicate_components(docs, empty):
    sets = {}
    for i, t in TEXTS.items():
        words = re.findall(WORD, (t or "").lower() if t is None or t.isascii() else t.lower())
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[b] = min(label[b], label[a])
    got = by_id(parity_join.near_duplicate_components(docs))
    assert {i: r["component_id"] for i, r in got.items()} == label
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert parity_join.near_duplicate_components(empty).count() == 0


def test_split_unit_does_not_hide_a_whole_one():
    """Both units hold the sets 1 and 2 on side 0; only the second one, which is no split, compares them."""
    units = pa.table({"component": [1, 2, 1, 2], "node": [1, 2, 1, 2], "side": [0, 0, 0, 0], "unit": [5, 5, 9, 9],
                      "split": [True, True, False, False]})
    grams = np.arange(50, dtype=np.uint64).tobytes()
    held = pa.table({"node": [1, 2], "grams": pa.array([grams, grams], pa.binary())})
    assert parity_join._link_blocks(80)(units, held).to_pylist() == [{"a": 1, "b": 2}]


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(parity_join, "BLOCK", 4)
    monkeypatch.setattr(parity_join, "_sketch_filter", _nothing_is_near)     # all links are left to the blocks
    held = spark.conf.get("spark.sql.shuffle.partitions")
    rng, rows = np.random.default_rng(4), []
    for i in range(60):
        words = [f"w{k}" for k in range(120)]
        words[rng.integers(120)] = f"z{i}"
        rows.append((i, " ".join(words[:rng.integers(90, 121)])))
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    label = {i: i for i in sets}
    for _ in range(10):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = by_id(parity_join.near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert {i: r["component_id"] for i, r in got.items()} == label


def _nothing_is_near(percent):
    def run(batches):
        for batch in batches:
            yield batch.select([0, 1]).slice(0, 0).rename_columns(["a", "b"])
    return run


def test_sketch_distance_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 700, dtype=np.uint64)
    b = np.concatenate([a[:600], rng.integers(0, 2**63, 50, dtype=np.uint64)])
    x, y = (parity_join.fold_sketch(parity_join.parity_sketch(s), 64) for s in (a, b))
    assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 49), (None, 3), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(31)}, 49: 49, 50: 49}


def test_remove_repeats(docs, empty):
    words = {i: re.findall(WORD, t or "") for i, t in TEXTS.items()}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(words[i][k:k + 13]), i)
    got = by_id(substring_dedup.remove_repeats(docs))
    for i, own in words.items():
        gone = [False] * len(own)
        for k in range(len(own) - 12):
            if first[tuple(own[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        kept = " ".join(w for w, x in zip(own, gone) if not x)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == (len(own), sum(gone), kept)
        assert got[i]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        assert sum(s["words"] for s in got[i]["spans"]) == sum(gone)
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_byte_bpe_equals_the_rank_merges(docs, empty):
    import tiktoken

    path, pattern = catalog.vocabulary()
    with open(path, "rb") as f:
        ranks = byte_bpe.parse_ranks(f.read())
    want = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = by_id(byte_bpe.encode_documents(docs, path, pattern))
    for i, t in TEXTS.items():
        assert got[i]["ids"] == want.encode_ordinary(t or "")
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.encode_documents(empty, path, pattern).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_section_counts_add_up(docs, rule):
    rows = token_counts.section_token_counts(docs, *catalog.vocabulary(), rule=rule).collect()
    for i, t in TEXTS.items():
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["section"])
        assert sum(r["n_tokens"] for r in own) == own[0]["doc_tokens"]
        assert "".join((t or "")[r["start"]:r["end"]] for r in own) == (t or "")
        assert len(own) == max(1, len(re.findall(r"[^\n]*\n|[^\n]+", t or "")))


def test_allocation_rules():
    tokens, sections = np.array([2, 7, 9]), np.array([3, 9])
    assert token_counts.allocate(tokens, sections, "start")[0].tolist() == [0, 0, 1]
    assert token_counts.allocate(tokens, sections, "end")[0].tolist() == [0, 1, 1]
    assert token_counts.allocate(tokens, sections, "most")[0].tolist() == [0, 1, 1]
    with pytest.raises(ValueError):
        token_counts.allocate(tokens, sections, "never")


def test_personal_data_equals_the_patterns(docs, empty):
    seen = pii.candidates(docs)
    found = pii.find_personal_data(seen, pii.train_spans(seen)).withColumn("base", pii.listed(F.col("pii_base")))
    found = by_id(pii.masked(found).select("doc_id", "base", "text"))
    assert found[16]["base"] == "email:5:13,phone:17:34,ip:36:44,card:49:68"
    assert found[17]["base"] == "email:0:5,email:5:11"
    assert found[16]["text"] == "mail [EMAIL] or [PHONE], [IP] and [CARD], 999.1.1.1"
    assert found[5]["text"] is None and all(not found[i]["base"] for i in TEXTS if i not in (16, 17))
    assert pii.find_personal_data(pii.candidates(empty), pii.train_spans(pii.candidates(empty))).count() == 0


def test_shards_are_exact_and_repeatable(spark, empty):
    rows = spark.range(1003).selectExpr("id AS doc_id", "id % 7 AS size", "id % 3 AS text_crc32")
    got = sharding.shard_exactly(rows, rows.columns, 8).collect()
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(map(len, slots.values())) == [125] * 5 + [126] * 3
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(tuple, got)) == sorted(map(tuple, sharding.shard_exactly(rows.repartition(5), rows.columns, 8).collect()))
    assert sharding.shard_exactly(empty, ["doc_id"], 8).count() == 0


def test_large_hypergeometric_draws():
    rng = np.random.default_rng(3)
    n = 2 * 10**9
    draws = [sharding.hypergeometric(rng, n // 4, n - n // 4, 10_000) for _ in range(300)]
    assert abs(np.mean(draws) - 2500) < 12 and 30 < np.std(draws) < 58


def test_fingerprints(docs, spark, empty):
    many = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(100 + i, " ".join(f"t{(i * 7 + k) % 90}" for k in range(30))) for i in range(60)], "doc_id long, text string"))
    pairs = imatch.with_next(many).collect()
    ids = sorted(r["doc_id"] for r in pairs)
    following = {a: b for a, b in zip(ids[1:], ids)} | {ids[0]: ids[-1]}
    assert {r["doc_id"]: r["next_id"] for r in pairs} == following
    terms = imatch.lexicon(many)
    prints = {r["doc_id"]: r["prints"] for r in imatch.fingerprints(many, terms, ["doc_id"]).collect()}
    assert set(prints) == set(ids) and prints[1] == prints[2] and set(prints[5]) == {0}
    assert imatch.with_next(empty).count() == 0


def test_language_and_rejection(spark, docs, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.fit_centroids(given.where("doc_id % 4 <> 0"))
    held = given.where("doc_id % 4 = 0")
    right = language_id.identify_languages(held, model).join(held.select("doc_id", "lang"), "doc_id").where("lang = lang_pred")
    assert right.count() >= 0.95 * held.count()
    got = by_id(language_id.identify_languages(docs, model))
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {5, 6, 7, 15}
    assert all(got[i]["rejected"] and got[i]["score"] == 0 for i in (5, 6, 7, 15))
    none = language_id.fit_centroids(docs.where("lang = 'xx'"))
    assert {r["lang_pred"] for r in language_id.identify_languages(docs, none).collect()} == {"und"}


def test_paragraphs_of_no_learned_language_are_rejected(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.fit_centroids(given.where("doc_id % 4 <> 0"))
    rng = np.random.default_rng(3)
    letters = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz   "), n)) for n in (200, 1000, 5000)]
    foreign = ["".join(map(chr, rng.integers(0x4E00, 0x9FFF, 3000))), base64.b64encode(rng.bytes(2000)).decode(),
               "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja "
               "omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
               "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem "
               "i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
               "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и "
               "должны поступать в отношении друг друга в духе братства."]
    strange = spark.createDataFrame(list(enumerate(letters + foreign)), "doc_id long, text string")
    got = language_id.identify_languages(strange, model).collect()
    assert len(got) == 8 and all(r["rejected"] and r["lang_pred"] != "und" for r in got)
    found = language_id.identify_languages(given, model)
    assert found.where("rejected").count() <= 0.01 * found.count()


def test_a_language_of_copies_is_learned(spark):
    rows = [(f"le chat numero {chr(97 + i % 3) * 4}", "fr") for i in range(3000)] + [(f"the dog {i:b}".translate(
        {48: "o", 49: "i"}), "en") for i in range(300)]
    model = language_id.fit_centroids(spark.createDataFrame(rows, "text string, lang string"), per_language=3)
    assert set(model.languages) == {"en", "fr"} and model.languages.count("fr") == 3


def test_few_labelled_texts_reject_none_of_their_own(spark):
    own = spark.createDataFrame([(1, "one two three", "en"), (2, "un deux trois", "fr")], "doc_id long, text string, lang string")
    got = language_id.identify_languages(own, language_id.fit_centroids(own)).collect()
    assert {(r["lang_pred"], r["rejected"]) for r in got} == {("en", False), ("fr", False)}


def test_quality_rules(spark, docs, sf_dir):
    given, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    model = quality.fit_rules(given, labels.where("doc_id % 3 <> 1"))
    held = labels.where("doc_id % 3 = 1")
    right = quality.score_quality(given, model).join(held, "doc_id").where("predicted = quality").count()
    assert model.rules and right >= 0.9 * held.count()
    got = by_id(quality.score_quality(docs, model))
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1]["score"] == got[2]["score"] and len(got) == len(TEXTS)
    assert quality.fit_rules(docs, labels.limit(0)).rules == []


def test_benchmark_items_are_found(spark, docs, empty):
    rng = np.random.default_rng(5)
    vocabulary = [f"v{k}" for k in range(400)]
    items = [" ".join(rng.choice(vocabulary, 30)) for _ in range(40)]
    rows = [(i, " ".join([*rng.choice(vocabulary, 200), *items[i].upper().split(), *rng.choice(vocabulary, 90)])) for i in range(40)]
    rows += [(100 + i, " ".join(rng.choice(vocabulary, 300))) for i in range(40)] + [(200, None), (201, ""), (7, rows[7][1])]
    table = spark.createDataFrame(list(enumerate(items)) + [(90, ""), (91, None), (None, "v1 v2")], "item_id long, text string")
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), table)
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == sorted([*((i, i) for i in range(40)), (7, 7)])
    assert decontaminate.contaminated(empty, table).count() == 0
    assert decontaminate.contaminated(docs, table.limit(0)).count() == 0


def test_the_number_of_indexes_changes_no_score(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vocabulary = [f"v{k}" for k in (400 * rng.random(600) ** 2).astype(int)]
    items = [" ".join(rng.choice(vocabulary, n)) for n in rng.integers(6, 40, 60)]
    rows = []
    for i, item in enumerate(items):
        words = item.split()
        words[:i % 4] = ["changed"] * (i % 4)                # partial hits, near the limits
        rows.append((i, " ".join([*rng.choice(vocabulary, 80), *words, *rng.choice(vocabulary, 50)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([*enumerate(items), (3, items[3])], "item_id long, text string")
    one = sorted(map(tuple, decontaminate.contaminated(docs, table).collect()))
    monkeypatch.setattr(decontaminate, "INDEX_ITEMS", 12)
    assert len(one) > 20 and sorted(map(tuple, decontaminate.contaminated(docs, table).collect())) == one


@pytest.mark.parametrize("items,low,high", [(80, 12, 13), (400, 3, 30), (1, 5, 6)])
def test_cursors_find_what_scoring_every_item_finds(items, low, high):
    rng = np.random.default_rng(9)
    words = [f"v{k}" for k in (150 * rng.random(900) ** 2).astype(int)]
    index = decontaminate.build_index(list(range(items)), [" ".join(rng.choice(words, rng.integers(low, high))) for _ in range(items)])
    searcher = decontaminate.Searcher(index)
    passages = [np.unique(rng.choice(index.terms, 25)) for _ in range(60)]
    rare = [t[~index.common[t]] for t in (np.searchsorted(index.terms, p) for p in passages)]
    found = list(zip(*(x.tolist() for x in searcher.candidates(np.repeat(np.arange(60), [len(t) for t in rare]), np.concatenate(rare)))))
    exact = {(p, i) for p, terms in enumerate(rare) for i in range(items)
             if sum(searcher.shares[k] for t in terms for k in range(index.first[t], index.first[t + 1]) if index.items[k] == i) + 1e-9 >= 1}
    assert len(found) == len(set(found)) and set(found) == exact
    wanted = {(p, i) for p in range(60) for i in range(items) if searcher.score(passages[p], i) >= decontaminate.SCORE_SHARE}
    assert wanted <= exact


def plain_spans(text):
    """The four base patterns by Python's ``re``, from the contract's words."""
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    out = []
    for k, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_base_spans_of_whole_tables_equal_plain_patterns(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = [(10**6, "🎉 a@b.co é x@y.de,+1 (988) 555-2485 1.2.3.4.5 256.1.1.1 4111-1111-1111-1111 0004111 1111 1111 1111"), (10**6 + 1, None),
           (10**6 + 2, "++1 2345678901 +12345678901234567 1..2.3.4 a@b a@b.c@d.e.f @x.y"), (None, "a@b.c"), (None, "a@b.c")]
    docs = given.unionByName(spark.createDataFrame(odd, given.schema)).withColumn("pii_base", F.lit("clash"))
    rows = pii.candidates(docs).select("doc_id", "text", pii.listed(F.col("pii_base")).alias("base")).collect()
    assert len(rows) == docs.count()
    assert [r["base"] for r in rows] == [plain_spans(r["text"]) for r in rows]


def test_a_long_list_of_addresses(spark):
    """Fifty thousand matches in one text; a plan that looks back at all of them would take hours."""
    many = " ".join(f"u{i}@mail.org" for i in range(50_000))
    docs = spark.createDataFrame([(1, many), (2, "call (212) 555-1234 or 212-555-9999 +1 212 555 7777")], "doc_id long, text string")
    began = time.time()
    seen = pii.candidates(docs)
    found = pii.find_personal_data(seen, pii.fit_votes([]))
    got = by_id(pii.masked(found).select("doc_id", "text", F.size("pii_base").alias("n")))
    assert got[1]["n"] == 50_000 and got[1]["text"] == " ".join(["[EMAIL]"] * 50_000)
    assert got[2]["text"].endswith("[PHONE]")
    assert time.time() - began < 60


def test_loose_spans_beside_base_spans_stay_apart(spark):
    texts = [(1, "4111 1111 1111 1111 4111 1111 1111 1112 +1 212 555 7777 (212) 555-1234"), (2, "a(at)b.de c@d.de (212) 555-1234 10.0.0.1")]
    for r in pii.candidates(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        for s in r["pii_loose"]:
            assert all(s["end"] <= b["start"] or b["end"] <= s["start"] for b in r["pii_base"])
            assert r["text"][s["start"]:s["end"]] == s["value"]


def test_prints_of_repeated_rows(spark, tmp_path):
    words = [f"t{i % 40}" for i in range(400)]
    rows = [(i, " ".join(words[i * 3:i * 3 + 60])) for i in range(60)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (7, rows[9][1]), (70, rows[5][1]), (71, None), (72, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.op6_imatch_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    prints, texts = {}, sorted(((i, t or "") for i, t in rows))
    for r in got:
        prints.setdefault((r["doc_id"], r["n_chars"]), set()).add(r["fingerprint"])
    for i in (5, 70):
        assert prints[(i, len(rows[5][1]))] == {next(iter(prints[(5, len(rows[5][1]))]))}
    want = []
    for k, (i, t) in enumerate(texts):
        after = texts[k - 1][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert {r["near_next"] for r in got if r["doc_id"] == 5} >= {1.0}


def test_prints_place_the_texts_once(spark, tmp_path):
    spark.createDataFrame([(i, f"a b{i % 3} c{i % 5}") for i in range(30)], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    plan = catalog.op6_imatch_fingerprints(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "doc_id" in plan      # the result is joined from the written prints alone


def test_prints_meet_their_neighbours_without_another_shuffle(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, f"a b{i % 3} c{i % 5}") for i in range(30)], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    plans, write = {}, catalog.write_out
    monkeypatch.setattr(catalog, "write_out", lambda df, name: (
        plans.update({name: df._jdf.queryExecution().executedPlan().toString()}), write(df, name))[1])
    out = catalog.op6_imatch_fingerprints(spark, str(tmp_path))
    assert plans["prints"].count("Exchange hashpartitioning") == 1
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["doc_id"]: r for r in out.collect()}
    prints = {i: r["fingerprint"] for i, r in got.items()}
    assert len(got) == 30 and all((r["near_next"] == 1) == (prints[i] == prints[(i - 1) % 30]) for i, r in got.items())


def test_shards_hold_whole_rows(spark):
    rows = spark.createDataFrame([(i % 30, f"text {i}", 9, "x") for i in range(200)], "doc_id long, text string, slot int, shard string")
    got = sharding.shard_exactly(rows, ["doc_id", "text"], 8)
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    held = got.collect()
    assert sorted((r["doc_id"], r["text"]) for r in held) == sorted((i % 30, f"text {i}") for i in range(200))
    for s in range(8):
        assert sorted(r["slot"] for r in held if r["shard"] == s) == list(range(25))


def test_language_columns_pass_through(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.fit_centroids(given.select("lang", "text"))
    clash = given.withColumn("score", F.lit("s")).withColumn("lang_pred", F.lit(3))
    got = language_id.with_language(clash, model)
    assert got.columns == [*given.columns, "lang_pred", "score", "rejected"]
    both = got.join(language_id.identify_languages(given, model).select("doc_id", F.col("lang_pred").alias("l"), F.col("score").alias("s")), "doc_id")
    assert both.where("lang_pred <> l OR score <> s").count() == 0 and both.count() == given.count()
    assert got.select(*given.columns).exceptAll(given).count() == 0
