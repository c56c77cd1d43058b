"""Linear classifiers for all folds and classes at once: every step of the fit is one scan of the rows.

Rows are packed into blocks of sparse rows once. A step multiplies every block with the coefficients of all models that
still move (a model is a *cell*: one fold and class, or one class of a softmax), and adds up losses and gradients; the
driver gets a few sums, whatever the number of rows. The driver holds
``features x cells`` numbers and a short history of them, which the vocabulary bounds.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrydesk.operators.scans import block_sums, times

#: Rows of a block; a task holds one block and a few numbers for each of its entries at a time.
BLOCK_ROWS = 512
#: Sums of this size together go to the driver at once; more are added up by tasks before.
DRIVER_BYTES = 32 << 20
#: Steps that the search direction remembers.
HISTORY = 8
#: A fit ends when its gradient is this small a share of the one at its start.
TOLERANCE = 1e-3

#: The arrays of a block travel as bytes, which need no conversion on either side.
_KINDS = {"fold": np.int32, "code": np.int32, "begin": np.int64, "idx": np.int32, "x": np.float64, "by_feature": np.int32}
_BLOCK = pa.schema([(name, pa.binary()) for name in _KINDS])
_BLOCK_DDL = ", ".join(f"{name} binary" for name in _KINDS)


def to_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of ``fold int, code int, entries array<struct<idx, x>>`` rows; zero entries are left out."""
    plain = rows.select(F.col("fold").cast("int").alias("fold"), F.col("code").cast("int").alias("code"),
                        F.filter("entries", lambda e: e["x"] != 0).alias("entries"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                fold, code, entries = batch.slice(at, BLOCK_ROWS).columns
                begin, flat = np.append(0, np.cumsum(entries.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))), entries.flatten()
                idx = flat.field("idx").to_numpy(zero_copy_only=False)
                cells = (fold, code, begin, idx, flat.field("x"), np.argsort(idx, kind="stable"))
                yield pa.RecordBatch.from_pydict(
                    {name: [np.asarray(c).astype(kind).tobytes()] for (name, kind), c in zip(_KINDS.items(), cells)}, schema=_BLOCK)

    return plain.mapInArrow(run, _BLOCK_DDL)


@dataclass(frozen=True)
class Block:
    """Sparse rows as arrays; entry e of row r lies at ``begin[r] <= e < begin[r + 1]``, ``by_feature`` sorts them by feature."""

    fold: np.ndarray
    code: np.ndarray
    begin: np.ndarray
    idx: np.ndarray
    x: np.ndarray
    by_feature: np.ndarray

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Rows x cells; the last row of ``weights`` is the intercept."""
        return times(self.begin, self.idx, self.x, weights) + weights[-1]

    def add_transposed(self, values: np.ndarray, into: np.ndarray) -> None:
        """``into[feature] += sum of x * values[row]`` and the intercept's sum in the last row."""
        into[-1] += values.sum(axis=0)
        if not len(self.idx):
            return
        row = np.repeat(np.arange(len(self.code)), np.diff(self.begin))[self.by_feature]
        idx = self.idx[self.by_feature]
        x, first = self.x[self.by_feature], np.flatnonzero(np.append(True, idx[1:] != idx[:-1]))
        found = np.empty((values.shape[1], len(first)))
        for c, column in enumerate(np.ascontiguousarray(values.T)):
            found[c] = np.add.reduceat(column.take(row) * x, first)
        into[idx[first]] += found.T


def _block(row: tuple[pa.Scalar, ...]) -> Block:
    return Block(*(np.frombuffer(cell.as_buffer(), kind) for cell, kind in zip(row, _KINDS.values())))


@dataclass(frozen=True)
class SquaredHinge:
    """One model for each (fold, class): the class against the rest, over the rows of the other folds.

    Rows of the class weigh ``weights[cell]``, others 1; the intercept is penalised like the coefficients.
    """

    folds: np.ndarray
    codes: np.ndarray
    weights: np.ndarray
    cost: float
    curve: float = 2.0
    penalises_intercept: bool = True

    def groups(self) -> np.ndarray:
        return np.arange(len(self.codes))

    def only(self, cells: np.ndarray) -> SquaredHinge:
        return SquaredHinge(self.folds[cells], self.codes[cells], self.weights[cells], self.cost)

    def row_weights(self, block: Block) -> np.ndarray:
        own = block.code[:, None] == self.codes
        return self.cost * np.where(own, self.weights, 1.0) * (block.fold[:, None] != self.folds)

    def loss_and_slope(self, block: Block, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sign, weight = np.where(block.code[:, None] == self.codes, 1.0, -1.0), self.row_weights(block)
        short = np.maximum(1 - sign * margins, 0)
        return (weight * short * short).sum(axis=0), -2 * weight * sign * short


@dataclass(frozen=True)
class Softmax:
    """One multinomial model over all rows; a row weighs ``weights`` of its class, the intercepts are free."""

    codes: np.ndarray
    weights: np.ndarray
    cost: float
    curve: float = 0.25
    penalises_intercept: bool = False

    def groups(self) -> np.ndarray:
        return np.zeros(len(self.codes), dtype=np.int64)

    def only(self, cells: np.ndarray) -> Softmax:
        return self if len(cells) == len(self.codes) else Softmax(self.codes[cells], self.weights[cells], self.cost)

    def row_weights(self, block: Block) -> np.ndarray:
        return np.repeat(self.cost * self.weights[block.code][:, None], len(self.codes), axis=1)

    def loss_and_slope(self, block: Block, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shifted = np.exp(margins - margins.max(axis=1, keepdims=True))
        p, own = shifted / shifted.sum(axis=1, keepdims=True), block.code[:, None] == self.codes
        weight = self.row_weights(block)
        each = -np.log(np.maximum((p * own).sum(axis=1), 1e-300)) * weight[:, 0]
        # the loss is the group's; it stands in the column of the row's own class
        return (own * each[:, None]).sum(axis=0), weight * (p - own)


@dataclass(frozen=True)
class Rows:
    """Blocks kept by the executors, and in how many partitions."""

    blocks: DataFrame
    parts: int
    features: int

    def sums(self, work: Callable[[Block, np.ndarray, np.ndarray], None], shape: tuple[int, int], cells: int) -> tuple:
        direct = max(1, DRIVER_BYTES // (8 * shape[0] * shape[1]))
        return block_sums(self.blocks, self.parts, lambda row, short, long: work(_block(row), short, long), shape, cells, direct)


def packed_rows(table: DataFrame, features: int, parts: int) -> Rows:
    """``table`` has ``row_seq, fold, code, entries``; rows are placed and ordered by ``row_seq`` alone."""
    laid_out = table.repartition(parts, "row_seq").sortWithinPartitions("row_seq")
    return Rows(to_blocks(laid_out).cache(), parts, features)


@dataclass(frozen=True)
class Fit:
    """Coefficients (features + 1, cells), and for each group of cells its steps and last share of the first gradient."""

    weights: np.ndarray
    steps: np.ndarray
    gradient_share: np.ndarray


def _curvature(rows: Rows, loss) -> np.ndarray:
    """(features + 1, cells): an upper bound of the second derivatives' diagonal, without the penalty."""
    def work(block: Block, _: np.ndarray, into: np.ndarray) -> None:
        squared = replace(block, x=block.x * block.x)
        squared.add_transposed(loss.row_weights(block), into)

    cells = len(loss.codes)
    return loss.curve * rows.sums(work, (rows.features + 1, cells), 1)[1]


def _loss_and_gradient(rows: Rows, loss, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shared = rows.blocks.sparkSession.sparkContext.broadcast(weights)

    def work(block: Block, losses: np.ndarray, gradient: np.ndarray) -> None:
        values, slopes = loss.loss_and_slope(block, block.times(shared.value))
        losses += values
        block.add_transposed(slopes, gradient)

    losses, gradient = rows.sums(work, weights.shape, weights.shape[1])
    shared.unpersist()
    return losses, gradient


def minimise(rows: Rows, loss, steps: int, tolerance: float = TOLERANCE) -> Fit:
    """Limited-memory quasi-Newton steps with backtracking; groups of cells move independently of each other.

    The objective is half the squared coefficients plus the summed losses. A group stops when its gradient norm is
    ``tolerance`` of the one at zero. A group that still moves after ``steps`` scans is named in a warning.
    """
    group = loss.groups()
    groups, shape = int(group.max()) + 1, (rows.features + 1, len(group))
    penalty = np.ones((shape[0], 1))
    penalty[-1] = float(loss.penalises_intercept)
    scale = 1 / np.maximum(penalty + _curvature(rows, loss), 1e-12)

    def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bincount(group, np.einsum("ij,ij->j", a, b), minlength=groups)

    def evaluate(at: np.ndarray, cells: np.ndarray, value: np.ndarray, slope: np.ndarray) -> None:
        part = at[:, cells]
        losses, gradient = _loss_and_gradient(rows, loss.only(cells), part)
        slope[:, cells] = gradient + penalty * part
        whole = np.zeros(len(group))
        whole[cells] = losses + 0.5 * (penalty * part * part).sum(axis=0)
        value[np.unique(group[cells])] = np.bincount(group, whole, minlength=groups)[np.unique(group[cells])]

    weights, value, gradient = np.zeros(shape), np.zeros(groups), np.zeros(shape)
    evaluate(weights, np.arange(len(group)), value, gradient)
    start = np.sqrt(dot(gradient, gradient))
    share, taken = np.where(start > 0, 1.0, 0.0), np.zeros(groups, dtype=np.int64)
    active, step, gamma = start > 0, np.ones(groups), np.ones(groups)
    past: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def towards() -> np.ndarray:
        q, used = gradient.copy(), []
        for s, y, rho in reversed(past):
            alpha = rho * dot(s, q)
            q -= alpha[group] * y
            used.append(alpha)
        q *= gamma[group] * scale
        for (s, y, rho), alpha in zip(past, reversed(used)):
            q += (alpha - rho * dot(y, q))[group] * s
        return -q

    direction = towards()
    for _ in range(steps):
        if not active.any():
            break
        cells = np.flatnonzero(active[group])
        trial = weights + step[group] * direction
        new_value, new_gradient = value.copy(), gradient.copy()
        evaluate(trial, cells, new_value, new_gradient)
        slope = dot(gradient, direction)
        good = active & (new_value <= value + 1e-4 * step * slope + 1e-12 * np.abs(value))
        taken += active
        if good.any():
            moved = good[group]
            s, y = (trial - weights) * moved, (new_gradient - gradient) * moved
            curve = dot(s, y)
            rho = np.where(curve > 0, 1 / np.where(curve > 0, curve, 1), 0.0)
            bent = dot(y, scale * y)
            gamma = np.where((curve > 0) & (bent > 0), curve / np.where(bent > 0, bent, 1), gamma)
            past = [*past, (s, y, rho)][-HISTORY:]
            weights[:, moved], gradient[:, moved] = trial[:, moved], new_gradient[:, moved]
            value = np.where(good, new_value, value)
            share = np.where(good, np.sqrt(dot(gradient, gradient)) / np.where(start > 0, start, 1), share)
        back = active & ~good
        rise = 2 * (new_value - value - step * slope)
        shorter = np.where(rise > 0, -slope * step * step / np.where(rise > 0, rise, 1), 0)
        step = np.where(back, np.clip(shorter, 0.1 * step, 0.5 * step), 1.0)
        active &= (share > tolerance) & (step > 1e-12)
        fresh = towards()
        direction = np.where(back[group], direction, fresh)
        # a direction that does not descend gives way to the scaled gradient
        uphill = (dot(gradient, direction) >= 0)[group]
        direction = np.where(uphill, -scale * gradient, direction)
    if (share > tolerance).any():
        warnings.warn(f"{int((share > tolerance).sum())} of {groups} linear models still move after {steps} steps, "
                      f"gradient at most {share.max():.1e} of the first")
    return Fit(weights, taken, share)


def leading_directions(rows: Rows, wanted: int, seed: int, rounds: int = 5, spare: int = 10) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, wanted) leading right singular vectors, their singular values, and the rows' whole squared norm.

    Randomised range finder (Halko, Martinsson, Tropp 2011): each of ``rounds`` scans multiplies a block of directions by
    the rows and back, the driver makes it orthonormal; a last scan gives the small matrix of the directions' products.
    """
    width = min(wanted + spare, rows.features)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((rows.features, width)))[0]
    spark = rows.blocks.sparkSession.sparkContext
    for _ in range(rounds):
        shared = spark.broadcast(np.vstack([basis, np.zeros((1, width))]))

        def work(block: Block, whole: np.ndarray, into: np.ndarray) -> None:
            block.add_transposed(block.times(shared.value), into)
        basis = np.linalg.qr(rows.sums(work, (rows.features + 1, width), 1)[1][:-1])[0]
        shared.unpersist()
    shared = spark.broadcast(np.vstack([basis, np.zeros((1, width))]))

    def gram(block: Block, whole: np.ndarray, into: np.ndarray) -> None:
        found = block.times(shared.value)
        into += found.T @ found
        whole += (block.x * block.x).sum()
    whole, small = rows.sums(gram, (width, width), 1)
    values, vectors = np.linalg.eigh(small)
    order = np.argsort(values)[::-1][:wanted]
    out = basis @ vectors[:, order]
    # a direction's sign is free; the largest component of each becomes positive
    out *= np.where(out[np.abs(out).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    return out, np.sqrt(np.maximum(values[order], 0)), float(whole[0])
