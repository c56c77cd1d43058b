"""Product codes of vectors, with Orchard's search for the nearest codebook entry.

A vector is cut into equal parts; each part position has a codebook. Every entry of a codebook keeps the list of all
others, sorted by distance. A part's search walks the list of its current entry; a nearer entry takes over and its list
is walked instead, entries seen before are passed over, and the search stops where the list goes beyond twice the
current distance: by the triangle inequality nothing further on can be nearer. The result is exact.

Vectors are assigned inside tasks against the broadcast codebooks; training sends one row for each entry and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrydesk.session import write_out

#: Components are taken as integers floor(SCALE * x), held within +-LIMIT so that all sums of squares fit 64 bits.
SCALE, LIMIT = 256, 1 << 24
#: Vectors searched side by side; a task holds so many times PARTS * ENTRIES flags.
ROWS = 4096


@dataclass(frozen=True)
class Codebooks:
    """``entries``: (parts, entries, components) integers."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


class Orchard:
    """Neighbour lists of one codebook, and the search for many points at once."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        np.fill_diagonal(gaps, -1)                     # first in its own list, before entries equal to it
        self.lists = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(gaps, self.lists, axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each point, ties to the lower index, and the squared distance."""
        n, size = len(points), len(self.entries)
        best = np.zeros(n, dtype=np.int64)
        error = ((points - self.entries[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, size), dtype=bool)
        seen[:, 0] = True
        place = np.zeros(n, dtype=np.int64)
        left = np.arange(n) if size > 1 else np.zeros(0, np.int64)
        while len(left):
            now, at = best[left], place[left]
            # beyond twice the distance: of squares, beyond four times; equal distances go on for the ties
            going = self.gaps[now, at] <= 4 * error[left]
            left, now, at = left[going], now[going], at[going]
            other = self.lists[now, at]
            place[left] += 1
            new = ~seen[left, other]
            asked, other = left[new], other[new]
            seen[asked, other] = True
            found = ((points[asked] - self.entries[other]) ** 2).sum(axis=1)
            better = (found < error[asked]) | ((found == error[asked]) & (other < best[asked]))
            moved = asked[better]
            best[moved], error[moved], place[moved] = other[better], found[better], 0
            left = left[place[left] < size - 1]
        return best, error


def kept_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, label, vector`` of the rows with an id and a vector without null or non-finite components."""
    vector = F.col(vector_col).cast("array<double>")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), vector.alias("vector")).where(
        "vec_id IS NOT NULL AND size(vector) > 0").where(F.forall("vector", finite))


def _integers(column: pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.clip(np.floor(SCALE * flat.flatten().to_numpy(zero_copy_only=False)), -LIMIT, LIMIT).astype(np.int64).reshape(-1, width)


def _assigned(books: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and squared distances, (rows, parts) each."""
    parts, _, size = books.shape
    found = [Orchard(books[p]).nearest(vectors[:, p * size:(p + 1) * size]) for p in range(parts)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _sums(shared):
    """One row for each part and entry that a task's vectors chose: their number and their sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        parts, entries, size = books.shape
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                vectors = _integers(batch.column(0).slice(at, ROWS), parts * size)
                codes, _ = _assigned(books, vectors)
                for p in range(parts):
                    count[p] += np.bincount(codes[:, p], minlength=entries)
                    np.add.at(total[p], codes[:, p], vectors[:, p * size:(p + 1) * size])
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry), pa.array(count[part, entry]), pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "total"])
    return run


def _codes(shared):
    schema = pa.schema([("vec_id", pa.int64()), ("code", pa.string()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        width = books.shape[0] * books.shape[2]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                codes, errors = _assigned(books, _integers(piece.column(1), width))
                text = codes.astype(np.uint8).tobytes().hex()
                step = 2 * books.shape[0]
                label = piece.column(2)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([text[k:k + step] for k in range(0, len(text), step)], pa.string()),
                     pa.array(errors.sum(axis=1)), label],
                    schema=schema.append(pa.field("label", label.type)))
    return run


def train_codebooks(kept: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> Codebooks:
    """Codebooks that start as the parts of the ``entries`` smallest ids and move to their parts' means, rounded down.

    Rows of one id are ordered by their vectors. The driver holds ``parts * entries`` rows of sums at most.
    """
    spark = kept.sparkSession
    first = kept.orderBy("vec_id", "vector").limit(entries).select("vector").collect()
    if not first:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    width = len(first[0]["vector"])
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    start = _integers(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), width)
    books = np.ascontiguousarray(start.reshape(len(first), parts, width // parts).transpose(1, 0, 2))
    rows = kept.select("vector")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        sums = rows.mapInArrow(_sums(shared), "part long, entry long, n long, total array<long>").groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(width // parts)])
        books = books.copy()
        for r in sums.collect():
            books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width // parts)]
    return Codebooks(books)


def encode_vectors(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks]:
    """``vec_id, code, error, label, label_error`` of every kept vector, and the codebooks.

    A code has two hex digits a part; error is the squared distance summed over parts, label_error its sum over equal
    labels, nulls together. Rows with a null id, a null or empty vector or a null or non-finite component are left out, and so
    are those of another length than the vector with the least id; a length that ``parts`` does not divide is an error.
    Components beyond 2 ** 24 in size count as that. With fewer kept rows than ``entries`` a codebook has as many entries as
    rows. Repeated rows are coded each. No kept row gives no row.
    """
    if entries > 256:
        raise ValueError("two hex digits name 256 entries at most")
    kept = kept_vectors(vectors, id_col, vector_col, label_col)
    width = kept.orderBy("vec_id", "vector").limit(1).select(F.size("vector").alias("n")).collect()
    if width:
        kept = kept.where(F.size("vector") == width[0]["n"])
    kind = kept.schema["label"].dataType.simpleString()
    books = train_codebooks(kept, parts, entries, rounds)
    shared = kept.sparkSession.sparkContext.broadcast(books.entries)
    codes = write_out(kept.select("vec_id", "vector", "label").mapInArrow(
        _codes(shared), f"vec_id long, code string, error long, label {kind}"), "codes")
    by_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(by_label, codes["label"].eqNullSafe(by_label["of"])).drop("of"), books
