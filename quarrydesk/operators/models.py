"""Models for category and priority, and their scoring.

Linear models are fitted by ``linear_fit`` and boosted trees by ``boosting``; both score rows where they are. A forest is a
table of its own (``forest``), which rows meet in groups of trees.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field, replace
from functools import reduce
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrydesk.operators import boosting, forest, linear_fit, scans
from quarrydesk.schema import ROW_SEQ
from quarrydesk.session import write_out

# --- fixed values -----------------------------------------------------------
C = 1.0
LR_ITERATIONS = 1000
SVM_ITERATIONS = 2000
TREES_BOOSTED, BOOST_RATE, BOOST_DEPTH = 300, 0.05, 5
TREES_FOREST, FOREST_DEPTH = 200, 30
FOLDS = 5
SEED = 42
COMPONENTS = 50
# ----------------------------------------------------------------------------
PLATT_STEPS = 100
PLATT_TOLERANCE = 1e-8


@dataclass(frozen=True)
class LinearModel:
    """One or more linear scorers per class (``fold``), optionally with sigmoids.

    ``weights``: (fold, label, idx, w); ``bias`` and ``sigmoids`` per (fold, label)
    are a handful of numbers. ``kind`` is ``softmax`` or ``platt``.
    """

    weights: DataFrame
    labels: tuple[str, ...]
    bias: dict[tuple[int, str], float]
    kind: str
    folds: int = 1
    sigmoids: dict[tuple[int, str], tuple[float, float]] = field(default_factory=dict)
    gradient_shares: dict[tuple[int, str], float] = field(default_factory=dict)   # of a fit, by cell


def labelled(df: DataFrame, label: str, labels: tuple[str, ...], weights: dict[str, float] | None = None) -> DataFrame:
    """Add numeric ``label_code`` and ``weight`` for the estimators."""
    code, weight = F.lit(None).cast("double"), F.lit(1.0)
    for i, name in enumerate(labels):
        code = F.when(F.col(label) == name, F.lit(float(i))).otherwise(code)
        if weights:
            weight = F.when(F.col(label) == name, F.lit(weights[name])).otherwise(weight)
    return df.withColumns({"label_code": code, "weight": weight})


def weight_table(spark: SparkSession, cells: dict[tuple[int, str], np.ndarray]) -> DataFrame:
    """(fold, label, idx, w) of the non-zero coefficients, as a stored table."""
    parts = []
    for (fold, label), values in cells.items():
        idx = np.flatnonzero(values).astype("int32")
        parts.append(pa.table({"fold": pa.array(np.full(len(idx), fold, dtype="int32")), "label": pa.array([label] * len(idx), pa.string()),
                               "idx": pa.array(idx), "w": pa.array(values[idx].astype("float64"))}))
    return write_out(spark.createDataFrame(pa.concat_tables(parts)), "linear_weights")


def fit_logistic(rows: linear_fit.Rows, labels: tuple[str, ...], weights: dict[str, float],
                 iterations: int = LR_ITERATIONS) -> LinearModel:
    """Balanced multinomial logistic regression, penalised by half the squared coefficients."""
    loss = linear_fit.Softmax(np.arange(len(labels)), np.array([weights[n] for n in labels]), C)
    fit = linear_fit.minimise(rows, loss, iterations)
    cells = [(0, name) for name in labels]
    return _linear_model(rows, cells, labels, fit, np.zeros(len(cells), dtype=int), "softmax", 1)


def _linear_model(rows: linear_fit.Rows, cells: list[tuple[int, str]], labels: tuple[str, ...], fit: linear_fit.Fit,
                  group: np.ndarray, kind: str, folds: int) -> LinearModel:
    weights = weight_table(rows.blocks.sparkSession, {cell: fit.weights[:-1, i] for i, cell in enumerate(cells)})
    bias = {cell: float(fit.weights[-1, i]) for i, cell in enumerate(cells)}
    shares = {cell: float(fit.gradient_share[group[i]]) for i, cell in enumerate(cells)}
    return LinearModel(weights, labels, bias, kind, folds, gradient_shares=shares)


def weight_matrix(model: LinearModel, cells: list[tuple[int, str]]) -> np.ndarray | None:
    """(features, cells); None if that takes more than ``MATRIX_BYTES``. Features are counted before they reach the driver."""
    last = model.weights.agg(F.max("idx")).first()[0]
    features = 0 if last is None else last + 1
    if features * len(cells) * 8 > scans.MATRIX_BYTES:
        return None
    out, place = np.zeros((features, len(cells))), {cell: i for i, cell in enumerate(cells)}
    held = model.weights.toArrow()
    at = np.array([place[f, n] for f, n in zip(held.column("fold").to_pylist(), held.column("label").to_pylist())], dtype=np.int64)
    if len(at):
        out[held.column("idx").to_numpy(), at] = held.column("w").to_numpy()
    return out


def margins(entries: DataFrame, model: LinearModel, keys: list[str], with_entries: bool = False) -> DataFrame:
    """``keys`` + ``fold_margins array<array<double>>`` (fold, class), before it the ``entries`` if asked for.

    The coefficients travel to the rows and each row is multiplied where it is; a matrix beyond ``MATRIX_BYTES`` stays
    a table, and entries meet it in a join.
    """
    cells = [(f, name) for f in range(model.folds) for name in model.labels]
    if (matrix := weight_matrix(model, cells)) is None:
        return _joined_margins(entries, model, keys, cells, with_entries)
    product = scans.with_product(entries.select(*keys, "entries"), matrix, "_product")
    total = [F.get("_product", F.lit(i)) + F.lit(model.bias[cell]) for i, cell in enumerate(cells)]
    return product.select(*keys, *["entries"] * with_entries, _per_fold(total, model))


def _per_fold(total: list[Column], model: LinearModel) -> Column:
    k = len(model.labels)
    return F.array(*[F.array(*total[f * k:(f + 1) * k]) for f in range(model.folds)]).alias("fold_margins")


def _joined_margins(entries: DataFrame, model: LinearModel, keys: list[str], cells: list[tuple[int, str]],
                    with_entries: bool) -> DataFrame:
    """The same by one join with one row of weights for each feature and one grouped sum."""
    wide = model.weights.groupBy("idx").agg(*[
        F.coalesce(F.sum(F.when((F.col("fold") == f) & (F.col("label") == name), F.col("w"))), F.lit(0.0)).alias(f"_w{i}")
        for i, (f, name) in enumerate(cells)])
    products = entries.select(*keys, F.inline("entries")).join(wide, "idx")
    sums = products.groupBy(*keys).agg(*[F.sum(F.col("x") * F.col(f"_w{i}")).alias(f"_s{i}") for i in range(len(cells))])
    with_all = entries.select(*keys, *["entries"] * with_entries).join(sums, keys, "left")
    total = [F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) + F.lit(model.bias[cell]) for i, cell in enumerate(cells)]
    return with_all.select(*keys, *["entries"] * with_entries, _per_fold(total, model))


def fit_platt(held_out: DataFrame, cells: list[tuple[int, str]]) -> dict[tuple[int, str], tuple[float, float]]:
    """Sigmoids P(y=1|f) = 1 / (1 + exp(A f + B)) for every (fold, label) at once.

    ``held_out``: (fold, label, margin, hit). Newton steps on the likelihood of Platt's smoothed targets; a step that does
    not raise it is halved. Each step is one grouped sum over the table and brings back seven numbers a cell. A sigmoid
    is done when its gradient is ``PLATT_TOLERANCE`` a row; those that are not after ``PLATT_STEPS`` are named in a warning.
    """
    counts = {(r["fold"], r["label"]): (r["pos"], r["neg"]) for r in held_out.groupBy("fold", "label").agg(
        F.count_if(F.col("hit") == 1).alias("pos"), F.count_if(F.col("hit") == 0).alias("neg")).collect()}
    params = {cell: (0.0, log((counts.get(cell, (0, 0))[1] + 1.0) / (counts.get(cell, (0, 0))[0] + 1.0))) for cell in cells}
    spark = held_out.sparkSession
    targets = {cell: ((pos + 1.0) / (pos + 2.0), 1.0 / (neg + 2.0)) for cell, (pos, neg) in counts.items()}
    trial, state = {cell: params[cell] for cell in counts}, {}
    for _ in range(PLATT_STEPS):
        rows = [(f, name, *ab, *targets[(f, name)]) for (f, name), ab in trial.items()]
        current = spark.createDataFrame(rows, "fold int, label string, a double, b double, t1 double, t0 double")
        f, t = F.col("margin"), F.when(F.col("hit") == 1, F.col("t1")).otherwise(F.col("t0"))
        z = F.col("a") * f + F.col("b")
        p = 1.0 / (1.0 + F.exp(z))
        # -t log p - (1 - t) log(1 - p), written so that no exponential overflows
        loss = t * z + F.greatest(-z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        sums = (held_out.join(F.broadcast(current), ["fold", "label"])      # one row per fold and class
                .withColumns({"d": t - p, "h": p * (1 - p), "loss": loss}).groupBy("fold", "label")
                .agg(F.sum("loss").alias("loss"), F.sum(F.col("d") * f).alias("ga"), F.sum("d").alias("gb"),
                     F.sum(F.col("h") * f * f).alias("haa"), F.sum(F.col("h") * f).alias("hab"), F.sum("h").alias("hbb")).collect())
        for r in sums:
            cell = (r["fold"], r["label"])
            if cell in state and r["loss"] > state[cell][0] + 1e-12 * abs(state[cell][0]):
                loss_at, (a, b), (da, db), size = state[cell]
                state[cell] = (loss_at, (a, b), (da, db), size / 2)
                trial[cell] = (a + da * size / 2, b + db * size / 2)
                continue
            a, b = params[cell] = trial[cell]
            if max(abs(r["ga"]), abs(r["gb"])) <= PLATT_TOLERANCE * max(sum(counts[cell]), 1):
                del trial[cell]
                continue
            haa, hbb, hab = r["haa"] + 1e-12, r["hbb"] + 1e-12, r["hab"]
            det = haa * hbb - hab * hab
            da, db = -(hbb * r["ga"] - hab * r["gb"]) / det, -(haa * r["gb"] - hab * r["ga"]) / det
            state[cell] = (r["loss"], (a, b), (da, db), 1.0)
            trial[cell] = (a + da, b + db)
        if not trial:
            return params
    warnings.warn(f"sigmoids not converged after {PLATT_STEPS} steps: {sorted(trial)}")
    return params


def fit_calibrated_svm(table: DataFrame, rows: linear_fit.Rows, labels: tuple[str, ...], label: str, folds: int = FOLDS,
                       iterations: int = SVM_ITERATIONS) -> LinearModel:
    """Squared-hinge SVM per class on the other folds, sigmoid per class on the held-out margins.

    ``table`` (``fold``, label, entries) are the rows behind ``rows``. All folds and classes are fitted in the same scans; a
    class weighs n / (k * n_c) of the rows that its fold is fitted on.
    """
    counts = {(r["fold"], r[label]): r["n"] for r in table.groupBy("fold", label).agg(F.count("*").alias("n")).collect()}
    cells = [(f, name) for f in range(folds) for name in labels]
    others = {f: {n: sum(c for (g, m), c in counts.items() if g != f and m == n) for n in labels} for f in range(folds)}
    balance = [sum(others[f].values()) / (len(labels) * max(others[f][name], 1)) for f, name in cells]
    loss = linear_fit.SquaredHinge(np.array([f for f, _ in cells]), np.array([labels.index(n) for _, n in cells]),
                                   np.array(balance), C)
    fit = linear_fit.minimise(rows, loss, iterations)
    base = _linear_model(rows, cells, labels, fit, np.arange(len(cells)), "margin", folds)
    scored = margins(table, base, [ROW_SEQ, "fold", label])
    own = F.element_at("fold_margins", F.col("fold") + 1)
    held = scored.select("fold", F.col(label).alias("_truth"), F.posexplode(own).alias("_i", "margin")).select(
        "fold", F.element_at(F.array(*[F.lit(n) for n in labels]), F.col("_i") + 1).alias("label"), "_truth", "margin")
    held = held.withColumn("hit", (F.col("_truth") == F.col("label")).cast("int")).drop("_truth")
    held = write_out(held, "held_out_margins")
    return replace(base, kind="platt", sigmoids=fit_platt(held, cells))


def _score_array(labels: tuple[str, ...], p: list[Column], margin: list[Column]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("label"), p[i].alias("p"), margin[i].alias("margin"))
                     for i, n in enumerate(labels)])


def score_linear(entries: DataFrame, model: LinearModel, keys: list[str], with_entries: bool = False) -> DataFrame:
    """``keys`` + ``scores``: softmax, or fold sigmoids normalised over classes and averaged; ``entries`` stay if asked for.

    ``margin`` in the scores is the first fold's, which the raw softmax uses.
    """
    table = margins(entries, model, keys, with_entries)
    keys = [*keys, *["entries"] * with_entries]
    count = len(model.labels)
    first = [F.col("fold_margins")[0][i] for i in range(count)]
    if model.kind == "softmax":
        top = F.greatest(*first)
        shifted = [F.exp(m - top) for m in first]
        total = reduce(lambda a, b: a + b, shifted)
        return table.select(*keys, _score_array(model.labels, [s / total for s in shifted], first).alias("scores"))
    averaged: list[Column] = [F.lit(0.0)] * count
    for f in range(model.folds):
        raw = []
        for i, name in enumerate(model.labels):
            a, b = model.sigmoids[(f, name)]
            raw.append(1.0 / (1.0 + F.exp(F.lit(a) * F.col("fold_margins")[f][i] + F.lit(b))))
        total = reduce(lambda x, y: x + y, raw)
        averaged = [averaged[i] + F.when(total > 0, raw[i] / total).otherwise(1.0 / count) / model.folds for i in range(count)]
    return table.select(*keys, _score_array(model.labels, averaged, first).alias("scores"))


def feature_weights(model: LinearModel, names: DataFrame) -> DataFrame:
    """(label, feature, w): mean over folds, with feature names. A fold without an entry counts 0."""
    mean = model.weights.groupBy("label", "idx").agg((F.sum("w") / model.folds).alias("w"))
    return mean.join(names, "idx").select("label", "feature", "w")


def mean_weights(model: LinearModel) -> np.ndarray | None:
    """(features, classes): the weights of ``feature_weights``; None if the folds' take more than ``MATRIX_BYTES``."""
    matrix = weight_matrix(model, [(f, name) for f in range(model.folds) for name in model.labels])
    return None if matrix is None else matrix.reshape(len(matrix), model.folds, len(model.labels)).sum(axis=1) / model.folds


def save_linear(model: LinearModel, path: str) -> None:
    spark = model.weights.sparkSession
    model.weights.write.mode("overwrite").parquet(f"{path}/weights")
    rows = [(f, n, model.bias[(f, n)], *model.sigmoids.get((f, n), (None, None))) for f in range(model.folds) for n in model.labels]
    spark.createDataFrame(rows, "fold int, label string, bias double, a double, b double").withColumn(
        "kind", F.lit(model.kind)).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")


def load_linear(spark: SparkSession, path: str) -> LinearModel:
    cells = spark.read.parquet(f"{path}/cells").orderBy("fold", "label").collect()   # folds x classes
    labels = tuple(sorted({r["label"] for r in cells}))
    return LinearModel(spark.read.parquet(f"{path}/weights"), labels, {(r["fold"], r["label"]): r["bias"] for r in cells},
                       cells[0]["kind"], max(r["fold"] for r in cells) + 1,
                       {(r["fold"], r["label"]): (r["a"], r["b"]) for r in cells if r["a"] is not None})


def score_trees(ml: DataFrame, model, labels: tuple[str, ...], keys: list[str]) -> DataFrame:
    """``keys`` + ``scores`` of a forest (its probabilities) or of boosted trees (softmax of their margins)."""
    if isinstance(model, boosting.BoostedTrees):
        out = boosting.raw_scores(ml.select(*keys, "entries"), model).withColumn("_raw", F.col("raw"))
        margin = [F.get("_raw", F.lit(i)) for i in range(len(labels))]
        shifted = [F.exp(m - F.array_max("_raw")) for m in margin]
        total = reduce(lambda a, b: a + b, shifted)
        return out.select(*keys, _score_array(labels, [s / total for s in shifted], margin).alias("scores"))
    out = forest.raw_votes(ml, model, keys)
    votes = [F.get("raw", F.lit(i)) for i in range(len(labels))]
    total = reduce(lambda a, b: a + b, votes)
    return out.select(*keys, _score_array(labels, [v / total for v in votes], votes).alias("scores"))


@dataclass(frozen=True)
class Projection:
    """Leading right singular vectors: (idx, v array<double>), one row per term; ``energy`` is their share of the squares."""

    basis: DataFrame
    components: int
    terms: int
    energy: float


def fit_projection(rows: linear_fit.Rows, components: int = COMPONENTS) -> Projection:
    """Truncated SVD of the uncentred text rows."""
    basis, values, whole = linear_fit.leading_directions(rows, components, SEED)
    table = pa.table({"idx": pa.array(range(len(basis)), pa.int32()), "v": pa.array(basis.tolist(), pa.list_(pa.float64()))})
    stored = write_out(rows.blocks.sparkSession.createDataFrame(table), "projection")
    return Projection(stored, basis.shape[1], len(basis), float((values ** 2).sum() / whole) if whole else 0.0)


def project(entries: DataFrame, projection: Projection, text_size: int) -> DataFrame:
    """Replace text entries by their projection, row by row: ``entries`` becomes dense and short.

    The basis travels to the rows; it has ``max_features`` rows of ``components`` numbers at most.
    """
    n = projection.components
    basis = np.zeros((text_size, n))
    for r in projection.basis.select("idx", "v").toLocalIterator():
        basis[r["idx"]] = r["v"]
    out = scans.with_product(entries, basis, "_text")
    rest = F.transform(F.filter("entries", lambda e: e["idx"] >= text_size), lambda e: F.struct(
        (e["idx"] - text_size + n).cast("int").alias("idx"), e["x"].alias("x")))
    head = F.transform("_text", lambda x, i: F.struct(i.cast("int").alias("idx"), x.alias("x")))
    return out.withColumn("entries", F.concat(head, rest)).drop("_text")
