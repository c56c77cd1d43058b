"""The plans that avoid one-task keys and all-pairs work equal brute force on skewed fixtures."""

import random
from collections import Counter
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarrydesk.functions import ranking
from quarrydesk.functions.quantiles import exact_quantiles
from quarrydesk.operators import dedupe, neardup, retrieval, splits
from quarrydesk.operators import tfidf as tf
from quarrydesk.plans import cleaning as cleaning_plan
from quarrydesk.sources import metrics_store, tables, tickets


def test_bucketed_quantiles_equal_numpy(spark):
    rng = random.Random(7)
    rows = [("hot", rng.choice([0.5, rng.random()])) for _ in range(4000)] + [("one", 3.25)] + [("few", float(i)) for i in range(7)]
    df = spark.createDataFrame(rows + [("hot", None)], "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.98, 1.0]
    for bits in (2, 8):
        got = {r["g"]: (r["n"], r["quantiles"]) for r in exact_quantiles(df, "v", probs, ["g"], bits=bits).collect()}
        for g in ("hot", "one", "few"):
            values = [v for k, v in rows if k == g]
            assert got[g][0] == len(values)
            assert np.allclose(got[g][1], np.quantile(values, probs))
        whole = exact_quantiles(df, "v", probs, bits=bits).first()
        assert np.allclose(whole["quantiles"], np.quantile([v for _, v in rows], probs))


def test_running_count_with_one_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else f"c{i % 5}", f"2024-01-{rng.randint(1, 3):02d} 00:00:{rng.randint(0, 9):02d}", f"t{i:04d}")
            for i in range(600)]
    df = spark.createDataFrame(rows, "k string, at string, id string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = {r["id"]: r["n"] for r in ranking.running_count(df, "k", "at", "id", "n").collect()}
    seen, want = Counter(), {}
    for k, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        want[i] = seen[k]
        seen[k] += 1
    assert got == want


def test_split_sizes_and_disjoint_customers(spark):
    rows = [(f"t{i}", "hot" if i % 3 == 0 else f"c{i % 17}") for i in range(203)]
    df = spark.createDataFrame(rows, "ticket_id string, customer_id string")
    assert splits.test_rows(splits.random_split(df)).count() == 41
    split = splits.customer_split(df)
    assert splits.test_rows(split).select("customer_id").distinct().count() == 3
    splits.assert_disjoint(split)
    again = {r["ticket_id"]: r["split"] for r in splits.customer_split(df).collect()}
    assert again == {r["ticket_id"]: r["split"] for r in split.collect()}


def test_length_flag_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, "hot" if rng.random() < 0.5 else f"c{i % 9}", "x" * rng.randint(0, 900)) for i in range(300)]
    got = dedupe.flag_near_duplicates(spark.createDataFrame(rows, "i int, customer_id string, ticket_text string"))
    want = {i: any(j != i and c == d and abs(len(t) - len(u)) <= 15 for j, d, u in rows) for i, c, t in rows}
    assert {r["i"]: r["is_near_duplicate"] for r in got.collect()} == want


def _tickets(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choices(words, k=12)) for _ in range(12)]
    rows = []
    for i in range(90):
        if i % 3 == 0:
            t = base[0]                                     # a third of the table is one text
        else:
            t = base[rng.randrange(12)].split()
            if rng.random() < 0.5:
                t[rng.randrange(12)] = rng.choice(words)
            if rng.random() < 0.3:
                t.append(f"only{i}")                        # outside the vocabulary: same vector
            t = " ".join(t)
        rows.append((i, f"T{i:03d}", f"C{i % 4}", t))
    rows += [(90, "T090", "C0", ""), (91, "T091", "C1", None)]
    return rows, spark.createDataFrame(rows, "row_seq long, ticket_id string, customer_id string, ticket_text string")


def _brute(rows, threshold, limit=5000):
    def grams(t):
        k = [w for w in (t or "").split() if len(w) > 1]
        return Counter(k + [a + " " + b for a, b in zip(k, k[1:])])
    docs = [grams(t) for _, _, _, t in rows]
    df, total = Counter(), Counter()
    for d in docs:
        df.update(d.keys())
        total.update(d)
    kept = set(sorted((t for t in df if df[t] >= 2), key=lambda t: (-total[t], t))[:limit])
    vectors = []
    for d in docs:
        v = {t: (1 + log(c)) * (log((1 + len(docs)) / (1 + df[t])) + 1) for t, c in d.items() if t in kept}
        norm = sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / norm for t, x in v.items()})
    out = {}
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            s = sum(x * vectors[j].get(t, 0.0) for t, x in vectors[i].items())
            if s >= threshold - 1e-9:
                out[(rows[i][1], rows[j][1])] = (round(s, 4), rows[i][2] == rows[j][2])
    return out


def test_near_duplicates_equal_brute_force(spark):
    rows, df = _tickets(spark)
    for threshold, block in ((0.6, 3), (0.85, 4096)):       # block 3 splits nearly every posting list
        found = neardup.find_near_duplicates(df, threshold, block=block)
        want = _brute(rows, threshold)
        got = {(r["ticket_id_1"], r["ticket_id_2"]): (r["similarity_score"], r["same_customer"])
               for r in neardup.pairs_of_tickets(found, df).collect()}
        assert got == want
        summary = {r["same_customer"]: int(r["pairs"]) for r in neardup.customer_relation_summary(found).collect()}
        assert summary == {flag: sum(same == flag for _, same in want.values()) for flag in (True, False)}
        top = [(r["ticket_id_1"], r["ticket_id_2"]) for r in neardup.top_pairs(found, df, 7).collect()]
        assert sorted(top) == sorted(sorted(want, key=lambda k: (-want[k][0], k))[:7])
        split = splits.random_split(df)
        side = {r["ticket_id"]: r["split"] for r in split.collect()}
        crossing = {r["same_customer"]: int(r["pairs"]) for r in neardup.split_contamination(found, split).collect()}
        assert crossing == {flag: sum(same == flag and side[a] != side[b] for (a, b), (_, same) in want.items()) for flag in (True, False)}


def test_tiled_retrieval_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(120, 8))
    vectors[:40] = vectors[0]                                # a third of the index is one vector
    index = spark.createDataFrame([(f"t{i:03d}", [float(x) for x in v]) for i, v in enumerate(vectors)], "ticket_id string, embedding array<double>")
    index = retrieval.build_index(index.withColumn("ticket_text", F.lit("x")))
    asked = index.select(F.col("ticket_id").alias("query_id"), "embedding")

    def hits(**how):
        return {(r["query_id"], r["rank"]): r["ticket_id"] for r in retrieval.nearest(index, asked, **how).collect()}
    monkeypatch.setattr(retrieval, "QUERY_ROWS", 7)
    whole, tiled = hits(k=5), hits(k=5, tile_rows=10)
    assert whole == tiled and len(whole) == 600
    assert hits(k=3).items() <= whole.items()
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 9)
    for q in (0, 39, 40, 119):
        best = sorted(range(120), key=lambda i: (-scores[q, i], f"t{i:03d}"))[:5]
        assert [whole[(f"t{q:03d}", r + 1)] for r in range(5)] == [f"t{i:03d}" for i in best]
    assert len(hits(k=500)) == 120 * 120
    other = spark.createDataFrame([("short", [1.0, 2.0]), ("none", None)], "query_id string, embedding array<double>")
    assert retrieval.nearest(index, other, 5).count() == 0
    assert retrieval.nearest(index.limit(0), asked, 5).count() == 0


def test_candidate_pairs_stay_few(spark):
    """Texts of rare words: candidates are the true pairs and few others, not the square of a posting list."""
    rng = random.Random(5)
    rows = [(i, f"T{i:04d}", "C", " ".join(rng.choices([f"w{k}" for k in range(400)], k=30))) for i in range(400)]
    rows += [(400 + i, f"U{i:04d}", "C", t + " extra") for i, (_, _, _, t) in enumerate(rows[:40])]
    df = spark.createDataFrame(rows, "row_seq long, ticket_id string, customer_id string, ticket_text string")
    groups = neardup._group_vectors(neardup.vector_groups(tf.distinct_texts(df), 5000)).cache()
    pairs = neardup.candidate_pairs(groups, 0.85)
    found = pairs.collect()
    assert len(found) == len(set(found)) <= 400
    assert {(i, 400 + i) for i in range(40)} <= {(r["gid_1"], r["gid_2"]) for r in found}


def test_csv_rows_keep_file_order_however_files_are_split(spark, tmp_path):
    header = "ticket_id,customer_id,ticket_text,product,created_at,previous_tickets,resolution_time,priority,category,resolved\n"
    n = 0
    for name in ("a", "b", "c"):
        lines = []
        for _ in range(200):
            lines.append(f"{n},c,text {n % 50},p,2024-01-01 00:00:00,1,2,LOW,x,true\n")
            n += 1
        (tmp_path / f"{name}.csv").write_text(header + "".join(lines))
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    kept = {}
    for size in ("1000", held):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        good, _ = tickets.split_corrupt(tickets.read_raw_csv(spark, str(tmp_path), with_place=True))
        rows = tickets.in_file_order(good, "row_seq").select("row_seq", "ticket_id").collect()
        assert sorted(r["row_seq"] for r in rows) == list(range(600)) and all(r["row_seq"] == int(r["ticket_id"]) for r in rows)
        out = cleaning_plan.clean_csv(spark, str(tmp_path / "*.csv"), str(tmp_path / f"out{size}"))
        kept[size] = sorted(int(r["ticket_id"]) for r in out.collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert kept["1000"] == kept[held] == list(range(50))      # the first of each copy


def test_cells_are_compared_piece_by_piece():
    rng = np.random.default_rng(4)

    def cell(rows, sides, j):
        rks = [sorted(rng.choice(12, 6, replace=False).tolist()) for _ in range(rows)]
        rks = [sorted({0, *r}) for r in rks]
        ws = [(w := np.float32(rng.random(len(r)) + 0.2)) / np.linalg.norm(w) for r in rks]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in (
            ([0] * rows, pa.int32()), ([0] * rows, pa.int32()), ([j] * rows, pa.int32()), (sides, pa.int32()), (range(rows), pa.int64()),
            (rks, pa.list_(pa.int32())), (ws, pa.list_(pa.float32())), ([0.05] * rows, pa.float64()))],
            names=["rk", "i", "j", "side", "gid", "rks", "ws", "rest"])

    for sides, j in ([0] * 60, 0), ([0, 1, 1] * 20, 1):
        batch = cell(60, sides, j)
        whole, pieces = ([(int(min(p)), int(max(p))) for a, b in neardup._cell_pairs([batch.slice(0, 25), batch.slice(25)], 0.85, piece)
                          for p in zip(a, b)] for piece in (1_024, 7))
        assert whole and sorted(whole) == sorted(pieces) and len(set(whole)) == len(whole)


def test_a_posting_is_sent_to_a_bounded_number_of_cells(spark):
    rows = spark.createDataFrame([(m,) for m in (2, 32_768, 32_769, 500_000, 4_000_000, 40_000_000)], "m long")
    assert [r[0] for r in rows.select(neardup.block_count(F.col("m"))).collect()] == [1, 1, 2, 16, 16, 153]


def test_queries_and_tiles_meet_in_a_grid(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = [(f"t{i:05d}", [float(x) for x in rng.integers(-3, 4, 5)]) for i in range(9_000)]
    index = retrieval.build_index(spark.createDataFrame([(i, "", v) for i, v in vectors if any(v)],
                                                        "ticket_id string, ticket_text string, embedding array<double>"))
    asked = spark.createDataFrame([v for v in vectors[:40] if any(v[1])], "query_id string, embedding array<double>")
    # a task for each of 4 shuffle partitions: two tiles by two groups, where each query went to four tiles
    dealt = retrieval.nearest(index, asked, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in dealt and ", 4\n" in dealt
    found = {(r["query_id"], r["rank"]): (r["ticket_id"], r["score"]) for r in retrieval.nearest(index, asked, 3).collect()}
    known = {r["ticket_id"]: np.array(r["embedding"]) for r in index.collect()}
    names = sorted(known)
    table = np.stack([known[n] for n in names])
    for name, v in (v for v in vectors[:40] if any(v[1])):
        scores = np.round(table @ (np.array(v) / np.linalg.norm(v)), 9)
        best = sorted(range(len(names)), key=lambda i: (-scores[i], names[i]))[:3]
        assert [found[name, k + 1][0] for k in range(3)] == [names[i] for i in best]
        assert np.allclose([found[name, k + 1][1] for k in range(3)], scores[best])

    def arrivals(k):
        def run(batches):
            for b in batches:
                asked_here = b.filter(pa.array(b.column(1).to_numpy() == 1))
                yield pa.RecordBatch.from_arrays([asked_here.column(2), asked_here.column(0).cast(pa.string()), pa.array([0.0] * asked_here.num_rows)],
                                                 names=["query_id", "ticket_id", "score"])
        return run
    monkeypatch.setattr(retrieval, "_tile_hits", arrivals)
    # a task for each of 4 shuffle partitions: two tiles by two groups, so a query is sent twice and not four times
    assert retrieval.nearest(index, asked, 9).groupBy("query_id").count().agg(F.max("count")).first()[0] == 2


def test_a_run_written_twice_has_one_set_of_metrics(spark, tmp_path):
    row = spark.createDataFrame([("m", 0.5, 7)], "model string, accuracy double, n long")
    for run in ("1", "2", "1"):
        metrics_store.append_metrics(row, str(tmp_path / "m"), run)
    got = metrics_store.read_metrics(spark, str(tmp_path / "m")).collect()
    assert sorted((r["run_id"], r["metric"]) for r in got) == [("1", "accuracy"), ("1", "n"), ("2", "accuracy"), ("2", "n")]


def test_tickets_are_numbered_without_their_texts(spark, sf_dir):
    plan = tables.derive_raw_tickets(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    windows = [k for k, line in enumerate(plan) if line.lstrip(" :+-").startswith("Window ")]
    assert windows
    for k in windows:
        below = [line for line, d in zip(plan[k + 1:], depth[k + 1:]) if d > depth[k]]
        assert not any("text#" in line for line in below if "Project [" in line)


def test_blocks_of_groups_meet_in_pieces_of_any_size(monkeypatch):
    rng = np.random.default_rng(6)

    def tile(gids):
        rks = [np.sort(rng.choice(40, rng.integers(1, 30), replace=False)).astype(np.int32) for _ in gids]
        ws = [(w := np.float32(rng.random(len(r)) + 0.1)) / np.linalg.norm(w) for r in rks]
        for k in range(0, len(gids) - 1, 7):                    # near copies
            rks[k + 1], ws[k + 1] = rks[k], ws[k]
        vectors.update({g: (r, w) for g, r, w in zip(gids, rks, ws)})
        return np.array(gids), np.array([len(r) for r in rks]), np.concatenate(rks), np.concatenate(ws)

    def cosine(a, b):
        dense = np.zeros((2, 40))
        for k, g in enumerate((a, b)):
            dense[k, vectors[g][0]] = vectors[g][1]
        return dense[0] @ dense[1]

    vectors = {}
    arrays = [tile([3 * k + s for k in range(50)]) for s in range(2)]
    for one, two in ((0, 0), (0, 1)):
        pairs = {(a, b) for a in arrays[one][0] for b in arrays[two][0] if (a < b if one == two else a != b)}
        want = {p for p in pairs if cosine(*p) >= 0.8 - neardup.SINGLE_SLACK}
        assert want
        for piece, profile, dense in ((1_024, 256, 32), (7, 4, 32), (9, 4, 1)):
            for name, value in (("PIECE", piece), ("PROFILE", profile), ("DENSE", dense)):
                monkeypatch.setattr(neardup, name, value)
            first = neardup._Tile(*arrays[one])
            found = [tuple(sorted(p)) if one == two else p for a, b in neardup._near_rows(
                first, first if one == two else neardup._Tile(*arrays[two]), 0.8) for p in zip(a.tolist(), b.tolist())]
            assert len(found) == len(set(found)) and set(found) == want


def test_pairs_of_groups_are_the_same_by_blocks_and_by_terms(spark):
    """Blocks let the true pairs out and hardly any other, whatever the lists of the terms; no block is met twice."""
    _, df = _tickets(spark)
    groups = neardup._group_vectors(neardup.vector_groups(tf.distinct_texts(df), 5000)).cache()
    by_terms = neardup.verified_pairs(neardup.candidate_pairs(groups, 0.6), groups, 0.6).collect()
    for block in (3, 20, neardup.TILE):
        dealt = neardup.tiled_pairs(groups, 0.6, block)
        assert sorted(map(tuple, dealt.collect())) == sorted((r["gid_1"], r["gid_2"]) for r in by_terms)
        assert sorted(neardup.verified_pairs(dealt, groups, 0.6).collect()) == sorted(by_terms)
    assert neardup.tiled_pairs(groups.limit(0), 0.6).count() == 0


def test_a_group_is_sent_to_a_bounded_number_of_blocks():
    assert [neardup.tile_count(n) for n in (0, 8_192, 8_193, 470_000, 1_048_576, 2_800_000)] == [1, 1, 2, 16, 16, 43]
