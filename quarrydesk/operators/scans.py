"""Sums over blocks of rows in one scan, and products of sparse rows with a small matrix where the rows are."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Sums of so many tasks are added up by one task of the second level.
FAN_IN = 64
#: The largest matrix that travels to the rows.
MATRIX_BYTES = 256 << 20
#: Rows multiplied at a time.
PRODUCT_ROWS = 512

Work = Callable[[tuple[pa.Scalar, ...], np.ndarray, np.ndarray], None]


def block_sums(blocks: DataFrame, parts: int, work: Work, shape: tuple[int, ...], cells: int,
               direct: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """What ``work`` adds to a vector of ``cells`` and an array of ``shape`` for every row of ``blocks``.

    Tasks add up their rows, a second level adds up some tasks each, ``FAN_IN`` at most, and the driver the rest. Without
    that level ``direct`` partitions may send their sums to the driver, ``FAN_IN`` if it is not given. All are added in
    the order of the partitions.
    """
    fan = FAN_IN if direct is None or parts > FAN_IN else max(1, ceil(sqrt(parts)))
    schema = pa.schema([("slot", pa.int32()), ("part", pa.int32()), ("short", pa.binary()), ("long", pa.binary())])
    ddl = "slot int, part int, short binary, long binary"

    def sent(part: int, short: np.ndarray, long: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"slot": [part // fan], "part": [part], "short": [short.tobytes()], "long": [long.tobytes()]},
                                          schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long = np.zeros(cells), np.zeros(shape)
        for batch in batches:
            for row in zip(*batch.columns):
                work(row, short, long)
        yield sent(TaskContext.get().partitionId(), short, long)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long, slot = np.zeros(cells), np.zeros(shape), None
        for batch in batches:
            for at, part, a, b in zip(*batch.columns):
                if slot not in (None, at.as_py()):       # a task may have several slots
                    yield sent(slot * fan, short, long)
                    short, long = np.zeros(cells), np.zeros(shape)
                slot = at.as_py()
                short += np.frombuffer(a.as_buffer())
                long += np.frombuffer(b.as_buffer()).reshape(shape)
        if slot is not None:
            yield sent(slot * fan, short, long)

    rows = blocks.mapInArrow(add, ddl)
    if parts > (FAN_IN if direct is None else min(direct, FAN_IN)):
        rows = rows.repartition(-(-parts // fan), "slot").sortWithinPartitions("slot", "part").mapInArrow(merge, ddl)
    short, long = np.zeros(cells), np.zeros(shape)
    for r in sorted(rows.collect(), key=lambda r: r["part"]):
        short += np.frombuffer(r["short"])
        long += np.frombuffer(r["long"]).reshape(shape)
    return short, long


def times(begin: np.ndarray, idx: np.ndarray, x: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Sparse rows times a matrix: entry e of row r lies at ``begin[r] <= e < begin[r + 1]``. One column at a time."""
    out = np.zeros((len(begin) - 1, matrix.shape[1]))
    full = np.flatnonzero(np.diff(begin))
    if len(full):
        for c, column in enumerate(np.ascontiguousarray(matrix.T)):
            out[full, c] = np.add.reduceat(column.take(idx) * x, begin[full])
    return out


def with_product(df: DataFrame, matrix: np.ndarray, name: str, entries: str = "entries") -> DataFrame:
    """``df`` with ``name array<double>``: the ``entries array<struct<idx, x>>`` of a row times ``matrix``.

    No row moves. Entries beyond the matrix count nothing; a row without entries gets zeros.
    """
    shared = df.sparkSession.sparkContext.broadcast(matrix)
    given = df.columns
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{name}` array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, PRODUCT_ROWS):
                piece = batch.slice(at, PRODUCT_ROWS)
                listed = piece.column(given.index(entries))
                begin = np.append(0, np.cumsum(listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
                flat = listed.flatten()
                idx, x = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("idx", "x"))
                known = idx < len(weights)
                found = times(begin, np.where(known, idx, 0), np.where(known, x, 0.0), weights)
                ends = pa.array(np.arange(0, found.size + 1, max(found.shape[1], 1)), pa.int32())
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.ListArray.from_arrays(ends, pa.array(found.ravel()))],
                                                 names=[*given, name])

    return df.mapInArrow(run, ddl)
