"""Trained models keep their invariants; streams equal batch."""

import tracemalloc
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrydesk.catalog import derived as D
from quarrydesk.catalog import queries as Q
from quarrydesk.functions.encoders import load_hashing_encoder
from quarrydesk.operators import boosting, features, linear_fit, models, splits
from quarrydesk.plans import training, triage
from quarrydesk.schema import ROW_SEQ
from quarrydesk.sources import tables
from quarrydesk.streaming import jobs


def test_calibrated_probabilities_sum_to_one_and_reload_scores_alike(spark, sf_dir, tmp_path):
    trained = training.train_category_model(D.customer_split(spark, sf_dir), "svm", iterations=5, max_features=500, folds=3)
    total = F.aggregate("scores", F.lit(0.0), lambda a, s: a + s["p"])
    assert trained.predictions.filter(F.abs(total - 1) > 1e-9).count() == 0
    models.save_linear(trained.model, str(tmp_path / "m"))
    trained.space.save(str(tmp_path / "s"))
    space, model = features.load_space(spark, str(tmp_path / "s")), models.load_linear(spark, str(tmp_path / "m"))
    test = splits.test_rows(D.customer_split(spark, sf_dir))
    again = models.score_linear(space.transform(test).select(ROW_SEQ, "entries"), model, [ROW_SEQ])
    joined = again.alias("a").join(trained.predictions.alias("b"), ROW_SEQ)
    assert joined.filter(F.abs(F.col("a.scores")[0]["p"] - F.col("b.scores")[0]["p"]) > 1e-9).count() == 0
    answered = triage.categorise(test, trained, 4)
    assert answered.count() == test.count()
    assert answered.filter(F.size("explanation") == 0).count() == 0


def test_space_is_fitted_on_train_rows_only(spark, sf_dir):
    split = D.customer_split(spark, sf_dir)
    changed = split.withColumn("ticket_text", F.when(F.col("split") == "test", F.lit("zzz zzz")).otherwise(F.col("ticket_text")))
    a, b = (features.fit_space(splits.train_rows(s), 300) for s in (split, changed))
    assert a.numbers == b.numbers and a.products == b.products
    assert a.vocabulary.exceptAll(b.vocabulary).count() == 0


def test_forest_scores_every_test_ticket(spark, sf_dir):
    split = D.customer_split(spark, sf_dir)
    trained = training.train_priority_model(split, "forest", components=5, max_features=300, trees=3, depth=3)
    assert trained.predictions.count() == splits.test_rows(split).count()


def test_registered_models_run_the_default_settings(spark, sf_dir, monkeypatch):
    calls = []
    for name in ("train_category_model", "train_priority_model"):
        monkeypatch.setattr(training, name, lambda split, *kind, **settings: calls.append((*kind, settings)))
    monkeypatch.setattr(Q, "_once", lambda spark, sf, name, build: build())
    for fit in (Q._logistic, Q._svm, Q._forest, Q._boosted):
        fit(spark, sf_dir)
    assert calls == [("lr", {}), ("svm", {}), ("forest", {}), ("boosted", {})]


def test_triage_and_explanations_answer_every_ticket(spark, sf_dir, monkeypatch):
    split = D.customer_split(spark, sf_dir)
    svm = training.train_category_model(split, "svm", iterations=3, max_features=300, folds=2)
    forest = training.train_priority_model(split, "forest", components=5, max_features=300, trees=3, depth=3)
    monkeypatch.setattr(Q, "_svm", lambda *_: svm)
    monkeypatch.setattr(Q, "_forest", lambda *_: forest)
    everyone = sorted(r[0] for r in tables.clean_tickets(spark, sf_dir).select(ROW_SEQ).collect())
    assert sorted(r[0] for r in Q.model_explanations(spark, sf_dir).select(ROW_SEQ).collect()) == everyone
    raw = tables.raw_tickets(spark, sf_dir)
    batch = Q.batch_triage(spark, sf_dir).collect()
    rejected = {r["ticket_id"] for r in Q.triage_rejects(spark, sf_dir).collect()}
    assert sorted([*(r["ticket_id"] for r in batch), *rejected]) == sorted(r[0] for r in raw.select("ticket_id").collect())
    assert all(r["similar_tickets"] is not None and r["queue"] and r["sla"] for r in batch)
    assert sorted(map(tuple, Q.streaming_triage(spark, sf_dir).select(batch[0].__fields__).collect()), key=str) == sorted(map(tuple, batch), key=str)


def _platt_brute(rows):
    """Plain Newton with halving on one cell, from the definition."""
    f, y = np.array([m for *_, m, _ in rows]), np.array([h for *_, h in rows])
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))

    def loss(ab):
        z = ab[0] * f + ab[1]
        return (t * z + np.maximum(-z, 0) + np.log1p(np.exp(-abs(z)))).sum()
    ab = np.array([0.0, np.log(((1 - y).sum() + 1) / (y.sum() + 1))])
    for _ in range(200):
        p = 1 / (1 + np.exp(ab[0] * f + ab[1]))
        g = np.array([((t - p) * f).sum(), (t - p).sum()])
        h = np.array([[(p * (1 - p) * f * f).sum(), (p * (1 - p) * f).sum()], [(p * (1 - p) * f).sum(), (p * (1 - p)).sum()]]) + 1e-12 * np.eye(2)
        d, size = -np.linalg.solve(h, g), 1.0
        while loss(ab + size * d) > loss(ab) and size > 1e-12:
            size /= 2
        ab = ab + size * d
    return ab


def test_sigmoids_converge_also_on_separable_margins(spark, monkeypatch):
    mixed = [(0, "a", m / 10, int(m + (m % 3) > 5)) for m in range(-20, 20)]
    apart = [(1, "a", float(m), int(m > 0)) for m in range(-40, 40)]
    none = [(2, "a", float(m), 0) for m in range(30)]
    held = spark.createDataFrame(mixed + apart + none, "fold int, label string, margin double, hit int")
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        got = models.fit_platt(held, [(0, "a"), (1, "a"), (2, "a"), (3, "a")])
    for k, rows in enumerate((mixed, apart)):
        assert np.allclose(got[(k, "a")], _platt_brute(rows), rtol=1e-4)
    assert got[(3, "a")][0] == 0.0                          # no row at all
    monkeypatch.setattr(models, "PLATT_STEPS", 2)
    with pytest.warns(UserWarning, match="not converged after 2 steps"):
        models.fit_platt(held.where("fold = 0"), [(0, "a")])


def _sparse_rows(spark, seed=3, n=300, features=40, classes=3, folds=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, features)) * (rng.random((n, features)) < 0.2)
    code = (x[:, :classes] + 0.1 * rng.normal(size=(n, classes))).argmax(axis=1)
    fold = np.arange(n) % folds
    table = [(i, int(fold[i]), int(code[i]), [(int(j), float(v)) for j, v in enumerate(x[i]) if v]) for i in range(n)]
    df = spark.createDataFrame(table, "row_seq long, fold int, code int, entries array<struct<idx: int, x: double>>")
    return x, code, fold, linear_fit.packed_rows(df, features, 3)


def test_squared_hinge_fits_reach_the_minimum(spark, monkeypatch):
    monkeypatch.setattr(linear_fit, "BLOCK_ROWS", 32)
    monkeypatch.setattr("quarrydesk.operators.scans.FAN_IN", 2)         # sums go through the second level
    x, code, fold, rows = _sparse_rows(spark)
    folds, codes, weights = np.array([0, 0, 1]), np.array([0, 2, 1]), np.array([2.0, 1.0, 0.5])
    fit = linear_fit.minimise(rows, linear_fit.SquaredHinge(folds, codes, weights, 1.0), 500, 1e-7)
    wide = np.hstack([x, np.ones((len(x), 1))])
    for k in range(3):
        own = fold != folds[k]
        sign, c = np.where(code == codes[k], 1.0, -1.0)[own], np.where(code == codes[k], weights[k], 1.0)[own]
        w = fit.weights[:, k]
        short = np.maximum(1 - sign * (wide[own] @ w), 0)
        assert np.abs(w - 2 * wide[own].T @ (c * sign * short)).max() < 1e-4
    assert (fit.gradient_share <= 1e-7).all()
    with pytest.warns(UserWarning, match="still move after 2 steps"):
        linear_fit.minimise(rows, linear_fit.SquaredHinge(folds, codes, weights, 1.0), 2, 1e-7)


def test_softmax_fit_reaches_the_minimum(spark):
    x, code, _, rows = _sparse_rows(spark)
    weights = np.array([1.0, 2.0, 0.5])
    fit = linear_fit.minimise(rows, linear_fit.Softmax(np.arange(3), weights, 1.0), 500, 1e-7)
    margins = x @ fit.weights[:-1] + fit.weights[-1]
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    slope = weights[code][:, None] * (p - np.eye(3)[code])
    assert np.abs(fit.weights[:-1] + x.T @ slope).max() < 1e-4 and np.abs(slope.sum(axis=0)).max() < 1e-4


def test_projection_spans_the_leading_directions(spark):
    x, _, _, rows = _sparse_rows(spark)
    basis, values, whole = linear_fit.leading_directions(rows, 5, 1)
    _, s, v = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(values, s[:5], rtol=1e-2) and np.isclose(whole, (x * x).sum())
    assert np.allclose(basis.T @ basis, np.eye(5), atol=1e-9)
    assert (values ** 2).sum() >= 0.98 * (s[:5] ** 2).sum()


def test_margins_row_by_row_equal_the_join(spark, sf_dir, monkeypatch):
    split = D.customer_split(spark, sf_dir)
    trained = training.train_category_model(split, "lr", max_features=300)
    entries = trained.space.transform(splits.test_rows(split)).select(ROW_SEQ, "entries")
    here = models.margins(entries, trained.model, [ROW_SEQ])
    assert "Exchange" not in here._jdf.queryExecution().toString().split("MapInArrow")[0]      # nothing moves above the product
    near = {r[0]: r["fold_margins"] for r in here.collect()}
    monkeypatch.setattr("quarrydesk.operators.scans.MATRIX_BYTES", 1)
    joined = {r[0]: r["fold_margins"] for r in models.margins(entries, trained.model, [ROW_SEQ]).collect()}
    assert near.keys() == joined.keys() and all(np.allclose(near[k], joined[k]) for k in near)


def test_boosted_trees_by_hand(spark, tmp_path):
    """One tree for each class on one feature: cut, leaves and loss from the definition."""
    x = [0.0, 0.0, 1.0, 1.0, 2.0, 2.0] * 10
    code = [0, 0, 0, 1, 1, 1] * 10
    rows = spark.createDataFrame([(i, c, 1.0, [(0, v), (1, 5.0)]) for i, (v, c) in enumerate(zip(x, code))],
                                 "row_seq long, code int, weight double, entries array<struct<idx: int, x: double>>")
    model = boosting.fit(rows, 2, 2, 2, 3, 2, 0.5)
    assert np.isclose(model.losses[0], np.log(2)) and (np.diff(model.losses) < 0).all()
    first = model.rounds[0][0]
    # derivatives at the start: first +-0.5, second 0.5; the left side of the first cut has 20 rows of class 0
    assert first.feature[0] == 0 and np.isclose(first.value[1], 0.5 * 10 / (10 + 1))
    boosting.save(model, spark, str(tmp_path / "b"))
    again = boosting.load(spark, str(tmp_path / "b"))
    scores = [boosting.raw_scores(rows, m).orderBy("row_seq").select("raw").collect() for m in (model, again)]
    assert scores[0] == scores[1]
    assert [int(r["raw"][1] > r["raw"][0]) for r in scores[0]][:2] == [0, 0] and scores[0][4]["raw"][1] > scores[0][4]["raw"][0]


def test_boosting_sends_few_sets_of_histograms(spark, monkeypatch):
    class Stop(Exception):
        pass

    def fit(rows, features, classes, parts, *rest):
        raise Stop(parts)
    rows = [(i, f"C-{i % 9}", f"w{i % 5} w{i % 3} other", "web", float(i % 4), ("LOW", "HIGH")[i % 2], "train" if i % 4 else "test")
            for i in range(40)]
    split = spark.createDataFrame(rows, "row_seq long, customer_id string, ticket_text string, product string, "
                                        "previous_tickets double, priority string, split string")
    monkeypatch.setattr(training, "ROWS_PER_PARTITION", 5)
    monkeypatch.setattr(training, "_check_inputs", lambda *a: ["previous_tickets"])
    monkeypatch.setattr(boosting, "fit", fit)
    with pytest.raises(Stop) as seen:
        training.train_priority_model(split, "boosted", max_features=20, components=2)
    assert seen.value.args == (1,)


def test_trees_lead_rows_to_the_same_nodes_as_step_by_step():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, boosting.BINS, (200, 4)).astype(np.uint8)
    tree = boosting.Tree(np.array([2, 0, -1, 3, -1, -1, -1] + [-1] * 8), np.array([30, 63, 0, 5, 0, 0, 0] + [0] * 8), np.zeros(15))
    for depth in range(4):
        want = []
        for row in bins:
            at = 0
            for _ in range(depth):
                at = at if tree.feature[at] < 0 else 2 * at + 1 + int(row[tree.feature[at]] > tree.cut[at])
            want.append(at)
        assert tree.nodes(bins, depth).tolist() == want


def test_boosting_is_the_same_with_and_without_rewritten_scores(spark, monkeypatch):
    rng = np.random.default_rng(0)
    table = [(i, int(rng.integers(3)), float(rng.integers(1, 3)), [(j, float(v)) for j, v in enumerate(rng.normal(size=4))]) for i in range(200)]
    rows = spark.createDataFrame(table, "row_seq long, code int, weight double, entries array<struct<idx: int, x: double>>")
    plain = boosting.fit(rows, 4, 3, 2, 6, 3, 0.3)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    assert np.allclose(plain.losses, boosting.fit(rows, 4, 3, 2, 6, 3, 0.3).losses)
    assert (np.diff(plain.losses) <= 1e-12).all()


def test_blocks_of_boosting_come_back_to_their_partition(spark, monkeypatch):
    """A level is as many tasks as there are partitions, each with the rows of one; their trees are added on the way."""
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(8)
    table = [(i, i % 3, 1.0, [(j, float(v)) for j, v in enumerate(rng.normal(size=3))]) for i in range(900)]
    rows = spark.createDataFrame(table, "row_seq long, code int, weight double, entries array<struct<idx: int, x: double>>")
    edges = boosting.bin_edges(rows, 3)
    laid_out = rows.repartition(3, "row_seq").sortWithinPartitions("row_seq")
    packed = boosting._blocks(laid_out, edges, 3).cache()
    kept = boosting._kept(packed, 3)
    held = dict(kept.mapPartitionsWithIndex(lambda part, blocks: [(part, sum(len(b[1]) // 4 for b in blocks))]).collect())
    assert held == {r["part"]: r["n"] for r in packed.groupBy("part").agg((F.sum(F.length("code")) / 4).cast("int").alias("n")).collect()}
    tree = boosting.Tree(np.array([1, -1, -1]), np.array([30, 0, 0]), np.array([0.0, -1.0, 2.0]))
    model = boosting.BoostedTrees(edges, ((tree,) * 3,), (), 1, 3)
    whole = [np.frombuffer(b[3]).reshape(-1, 3) for b in boosting._with_round(kept, model).collect()]
    bins = [np.frombuffer(b[0], np.uint8).reshape(-1, 3) for b in kept.collect()]
    assert all((s == np.where(b[:, 1] > 30, 2.0, -1.0)[:, None]).all() for s, b in zip(whole, bins)) and sum(map(len, whole)) == 900


def test_histograms_feature_by_feature():
    rng = np.random.default_rng(9)
    bins, node = rng.integers(0, boosting.BINS, (500, 3)).astype(np.uint8), rng.integers(0, 4, 500)
    derivatives = rng.normal(size=500), rng.random(500)
    found, want = np.ones((2, 3, 4, boosting.BINS)), np.ones((2, 3, 4, boosting.BINS))
    boosting._histograms(found, bins, node, derivatives)
    for c, d in enumerate(derivatives):
        for f in range(3):
            np.add.at(want[c, f], (node, bins[:, f]), d)
    assert np.allclose(found, want)


def test_cleaned_stream_equals_batch(spark, sf_dir, tmp_path):
    stream = jobs.clean_stream(Q._stream_of_raw(spark, sf_dir))
    jobs.append_batches(stream, str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch_id")
    want = jobs.clean_stream(tables.raw_tickets(spark, sf_dir))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_sliding_windows_count_each_ticket_in_every_window(spark, sf_dir, tmp_path):
    counts = jobs.volume_windows(jobs.clean_stream(Q._stream_of_raw(spark, sf_dir)), ["category"], "1 day", "2 days", "1 day")
    jobs.append_batches(counts, str(tmp_path / "w"), mode="update").awaitTermination()
    final = jobs.latest_counts(spark, str(tmp_path / "w"), ["window_start", "category"])
    rows = jobs.clean_stream(tables.raw_tickets(spark, sf_dir)).count()
    assert final.agg(F.sum("n")).first()[0] == 2 * rows


def test_state_of_windows_expires_and_late_rows_are_dropped(spark, sf_dir, tmp_path):
    stream = jobs.clean_stream(Q._stream_of_raw(spark, sf_dir, files=6, late=True))
    run = jobs.append_batches(jobs.volume_windows(stream, ["product"], "1 day"), str(tmp_path / "w"), mode="update")
    run.awaitTermination()
    states = [p["stateOperators"][0] for p in run.recentProgress if p["stateOperators"]]
    held = [s["numRowsTotal"] for s in states]
    assert sum(s["numRowsRemoved"] for s in states) > 0
    assert sum(s["numRowsDroppedByWatermark"] for s in states) > 0
    windows = spark.read.parquet(str(tmp_path / "w")).select("window_start", "product").distinct().count()
    assert max(held) < windows                              # the state never holds all windows


def test_a_lot_of_the_stream_is_many_files_and_one_batch(spark, sf_dir, tmp_path, monkeypatch):
    raw = tables.raw_tickets(spark, sf_dir).where("created_at like '2024-%'")
    raw.repartition(6).write.parquet(str(tmp_path / "raw"))
    monkeypatch.setattr(Q, "_raw", lambda spark, sf: spark.read.parquet(str(tmp_path / "raw")))
    monkeypatch.setattr(Q, "scratch_path", lambda spark, name: str(tmp_path / name))
    stream = Q._stream_of_raw(spark, sf_dir, files=3)
    jobs.append_batches(stream, str(tmp_path / "out")).awaitTermination()
    files = spark.read.parquet(str(tmp_path / "stream_in")).groupBy(F.input_file_name()).count().collect()
    lots = spark.read.parquet(str(tmp_path / "out")).groupBy("batch_id").agg(
        F.min("created_at").alias("low"), F.max("created_at").alias("high"), F.count("*").alias("n")).orderBy("batch_id").collect()
    assert len(lots) == 3 and sum(r["n"] for r in lots) == raw.count()
    assert all(a["high"] < b["low"] for a, b in zip(lots, lots[1:]))
    assert len(files) > 6 and max(r["count"] for r in files) < min(r["n"] for r in lots)


def test_index_stream_appends_a_ticket_once(spark, sf_dir, tmp_path):
    raw = tables.raw_tickets(spark, sf_dir)
    source = str(tmp_path / "in")
    for _ in range(2):                                       # the same tickets arrive twice
        raw.coalesce(1).write.mode("append").parquet(source)
    stream = jobs.clean_stream(jobs.ticket_stream(spark, source, raw.schema, files_per_batch=1))
    jobs.index_stream(stream, str(tmp_path / "out"), D.index(spark, sf_dir), load_hashing_encoder).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == got.select("ticket_id").distinct().count() == jobs.clean_stream(raw).select("ticket_id").distinct().count()


def test_partitions_of_a_fit_follow_its_rows(spark, monkeypatch):
    """Each scan sends a set of sums for each partition, so a large table has few; the sums are the same in two levels."""
    assert [training._parts(n) for n in (0, 999, 8_000, 32_000, 400_000, 2_400_000)] == [1, 1, 8, 32, 32, 150]
    x, code, _, rows = _sparse_rows(spark)
    loss, at = linear_fit.Softmax(np.arange(3), np.array([1.0, 2.0, 0.5]), 1.0), np.full((x.shape[1] + 1, 3), 0.1)
    straight = linear_fit._loss_and_gradient(rows, loss, at)
    monkeypatch.setattr(linear_fit, "DRIVER_BYTES", 1)
    merged = linear_fit._loss_and_gradient(rows, loss, at)
    assert all(np.allclose(a, b, rtol=1e-12) for a, b in zip(straight, merged))


def test_products_hold_one_column_at_a_time():
    rng = np.random.default_rng(2)
    n, per_row, cells = 200, 300, 20
    idx, x, begin = rng.integers(0, 500, n * per_row).astype(np.int32), rng.normal(size=n * per_row), np.arange(n + 1) * per_row
    block = linear_fit.Block(np.zeros(n, np.int32), np.zeros(n, np.int32), begin, idx, x, np.argsort(idx, kind="stable"))
    weights, values, into = rng.normal(size=(501, cells)), rng.normal(size=(n, cells)), np.zeros((501, cells))
    tracemalloc.start()
    got = block.times(weights)
    block.add_transposed(values, into)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    dense = np.zeros((n, 500))
    np.add.at(dense, (np.repeat(np.arange(n), per_row), idx), x)
    assert np.allclose(got, dense @ weights[:-1] + weights[-1])
    assert np.allclose(into, np.vstack([dense.T @ values, values.sum(axis=0)]))
    assert peak < 8 * len(idx) * 8                          # some numbers for each entry, not ``cells`` of them


def test_explanations_row_by_row_equal_the_join(spark, sf_dir, monkeypatch):
    split = D.customer_split(spark, sf_dir)
    trained = training.train_category_model(split, "lr", max_features=300)
    tickets = splits.test_rows(split)
    near = triage.categorise(tickets, trained)
    scan = near._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in scan and "SortMergeJoin" not in scan       # tickets are not taken apart
    twice = tickets.unionByName(tickets.limit(3))                       # rows that share a number are explained together
    shown = [triage.categorise(twice, trained).drop("category_confidence")]
    monkeypatch.setattr("quarrydesk.operators.scans.MATRIX_BYTES", 1)
    joined = triage.categorise(tickets, trained)
    shown.append(triage.categorise(twice, trained).drop("category_confidence"))
    counts = [df.select(ROW_SEQ, "category", F.size("explanation")).groupBy(ROW_SEQ).count().orderBy(ROW_SEQ).collect() for df in shown]
    assert counts[0] == counts[1] and max(r["count"] for r in counts[0]) > 1
    rows = [{r[ROW_SEQ]: r for r in df.collect()} for df in (near, joined)]
    assert rows[0].keys() == rows[1].keys() and len(rows[0]) == tickets.count()
    for key, r in rows[0].items():
        other = rows[1][key]
        assert r["category"] == other["category"] and [f["feature"] for f in r["explanation"]] == [f["feature"] for f in other["explanation"]]
        for name in ("weight", "contribution"):
            assert np.allclose([f[name] for f in r["explanation"]], [f[name] for f in other["explanation"]], atol=1.1e-4)
