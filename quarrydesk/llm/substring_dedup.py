"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

Windows of ``k`` words are equal only if they hold the same least gram, so each document is cut into stretches of windows
with one least gram, and stretches meet under it. A gram that one document alone has ends there, and copies of a stretch
count as one, of the smallest document. The differing stretches of a gram are its reference block: in the order of their
documents each is parsed greedily into the longest factors that start in the block so far, found in its sorted suffixes,
and then joins the block. A factor of ``k`` words or more is a duplicate span; windows over a factor's end are looked up too.

A gram with more than ``MOST`` differing stretches has windows as its blocks: each is one factor, known by its hash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrydesk.llm.suffix_dedup import sliding_least
from quarrydesk.llm.words import mix, slices, words_of
from quarrydesk.session import write_out

#: Words of a gram, below those of a window.
GRAM = 5
#: Words of a text cut into stretches at a time; longer texts are taken in pieces that overlap by a window.
PIECE = 1 << 20
#: Stretches handed over at a time on average, and differing stretches of one gram that are parsed.
BLOCK, MOST = 512, 1024
_ODD = np.uint64(0x9E3779B97F4A7C15)
_CELL = 8

_SEGMENTS = pa.schema([("doc_id", pa.int64()), ("text_k", pa.int64()), ("start", pa.int64()), ("n", pa.int32()),
                       ("gram", pa.int64()), ("content", pa.int64())])
_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(
    pa.struct([("start", pa.int64()), ("words", pa.int64())]))), ("kept", pa.string()), ("kept_sha256", pa.string())])
_OUT_DDL = ("doc_id long, n_words long, n_removed long, spans array<struct<start: long, words: long>>, kept string, "
            "kept_sha256 string")


def stretches(hashes: np.ndarray, text: np.ndarray, k: int, gram: int):
    """First word, windows, least gram and content hash of all runs of windows with one least gram within a text."""
    none = np.zeros(0, np.int64)
    if len(hashes) < k:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    width, span = k - gram + 1, len(hashes) - gram + 1
    values = np.zeros(span, np.uint64)
    for step in range(gram):
        values = values * _ODD + hashes[step:step + span]
    at = np.flatnonzero(text[:len(hashes) - k + 1] == text[k - 1:])
    least = sliding_least(mix(values), width)[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[at[1:]] != text[at[:-1]])
    begin = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
    cut = np.flatnonzero(since % width == 0)
    n, start, own = np.diff(np.append(cut, len(at))), at[cut], least[cut]
    size = n + k - 1
    content = size.astype(np.uint64)
    for step in range(int(size.max(initial=0))):
        some = step < size
        content[some] = content[some] * _ODD + hashes[start[some] + step]
    return start, n, own, mix(content)


def _segments(k: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                words = words_of(piece.column(2))
                hashes, text = words.hashes(), words.text_of()
                for low in range(0, max(len(hashes) - k + 1, 0), PIECE):
                    part = slice(low, low + PIECE + k - 1)
                    start, n, own, content = stretches(hashes[part], text[part], k, gram)
                    row = text[start + low]
                    yield pa.RecordBatch.from_arrays(
                        [piece.column(0).take(pa.array(row)), piece.column(1).take(pa.array(row)),
                         pa.array(start + low - words.first[row]), pa.array(n.astype(np.int32)),
                         pa.array(own.view(np.int64)), pa.array(content.view(np.int64))], schema=_SEGMENTS)
    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's words, joined and compressed, with their number and digest."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_k", pa.int64()), ("n_words", pa.int64()), ("whole_sha256", pa.string()),
                        ("packed", pa.binary())])
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for piece in slices(batch):
            words = words_of(piece.column(2))
            texts = _joined(words, np.ones(len(words.starts), bool))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(words.counts.astype(np.int64)),
                 pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                 pa.array([press.compress(x) for x in texts], pa.binary())], schema=schema)


def _unpacked(cell) -> pa.Array:
    return pa.array([zstandard.ZstdDecompressor().decompress(cell.as_py())], pa.large_binary()).view(pa.large_string())


def _joined(words, stays: np.ndarray) -> list[bytes]:
    """The words that stay, joined by one space, by text."""
    starts, sizes = words.starts[stays], (words.ends - words.starts)[stays]
    begin = np.append(0, np.cumsum(sizes + 1))
    out = np.full(begin[-1], 0x20, dtype=np.uint8)
    inner = np.arange(sizes.sum()) - np.repeat(np.append(0, np.cumsum(sizes))[:-1], sizes)
    out[inner + np.repeat(begin[:-1], sizes)] = words.data[inner + np.repeat(starts, sizes)]
    cut = begin[np.append(0, np.cumsum(stays))[words.first]]
    whole = out.tobytes()
    return [whole[a:max(a, b - 1)] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def _cut(k: int):
    """The word hashes of the wanted stretches of each document."""
    schema = pa.schema([("gram", pa.int64()), ("content", pa.int64()), ("least_id", pa.int64()), ("kinds", pa.int64()),
                        ("words", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, wants in zip(batch.column(0), batch.column(1)):
                text, wants = words_of(_unpacked(cell)).hashes().tobytes(), wants.values
                start, n = (wants.field(f).to_numpy(zero_copy_only=False) for f in ("start", "n"))
                parts = [text[a:b] for a, b in zip((_CELL * start).tolist(), (_CELL * (start + n + k - 1)).tolist())]
                yield pa.RecordBatch.from_arrays([*(wants.field(f) for f in ("gram", "content", "least_id", "kinds")),
                                                  pa.array(parts, pa.binary())], schema=schema)
    return run


class Reference:
    """An indexed reference block: the sorted suffixes, of k words or more, of the stretches in it."""

    def __init__(self, k: int):
        self.least, self.suffixes = _CELL * k, []

    def add(self, words: bytes) -> None:
        for at in range(0, len(words) - self.least + 1, _CELL):
            insort(self.suffixes, words[at:])

    def longest(self, words: bytes) -> int:
        """Words of the longest prefix of ``words`` that starts in the block; a neighbour in the order has it."""
        place, best = bisect_left(self.suffixes, words), 0
        for near in self.suffixes[max(place - 1, 0):place + 1]:
            size = min(len(near), len(words))
            while best < size and near[:best + _CELL] == words[:best + _CELL]:
                best += _CELL
        return best // _CELL


def duplicate_windows(words: bytes, reference: Reference, k: int) -> list[bool]:
    """For each window of a stretch whether it starts in the block: within a long factor, or looked up at a factor's end."""
    n = len(words) // _CELL - k + 1
    hit, at = [False] * n, 0
    while at < n:
        size = reference.longest(words[at * _CELL:])
        inner = max(size - k + 1, 0)
        hit[at:min(at + inner, n)] = [True] * min(inner, n - at)
        over = at + max(inner, 1)                      # windows from here to the factor's end reach over it
        at += max(size, 1)
        for window in range(over, min(at, n)):
            hit[window] = reference.longest(words[window * _CELL:(window + k) * _CELL]) == k
    return hit


def _parsed(k: int):
    """Duplicate windows of the distinct stretches of some grams, parsed in the order of their smallest documents."""
    schema = pa.schema([("gram", pa.int64()), ("content", pa.int64()), ("ranges", _RANGES)])

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(set(zip(*(table.column(c).to_pylist() for c in ("gram", "least_id", "content", "words")))))
        out: list[list] = [[], [], []]
        for gram, own in groupby(rows, key=lambda row: row[0]):
            block = Reference(k)
            for _, same in groupby(own, key=lambda row: row[1]):
                same = list(same)
                for _, _, content, words in same if block.suffixes else []:
                    edge = np.diff(np.array([0, *duplicate_windows(words, block, k), 0], np.int8))
                    ranges = [{"a": a, "b": b} for a, b in zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist())]
                    if ranges:
                        for column, value in zip(out, (gram, content, ranges)):
                            column.append(value)
                for row in same:
                    block.add(row[3])
        return pa.table([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)
    return run


def _single(k: int):
    """The windows of crowded grams' stretches by their hash."""
    schema = pa.schema([("gram", pa.int64()), ("content", pa.int64()), ("least_id", pa.int64()), ("a", pa.int32()),
                        ("window", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [np.frombuffer(c, np.uint64) for c in batch.column(3).to_pylist()]
            n = np.array([len(c) - k + 1 for c in cells], np.int64)
            total = np.zeros(n.sum(), np.uint64)
            for step in range(k if len(cells) else 0):
                total = total * _ODD + np.concatenate([c[step:step + m] for c, m in zip(cells, n)])
            row = pa.array(np.repeat(np.arange(len(n)), n))
            first = np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(row) for c in range(3)), pa.array((np.arange(len(total)) - first).astype(np.int32)),
                 pa.array(mix(total).view(np.int64))], schema=schema)
    return run


def _repeats(items: DataFrame, k: int) -> DataFrame:
    """``gram, content, ranges``: the windows of each distinct stretch that start in a smaller document than its own."""
    few = items.where(F.col("kinds") <= MOST)
    blocks = max(1, -(-few.count() // BLOCK))
    parsed = few.select(F.pmod(F.xxhash64("gram"), F.lit(blocks)).alias("block"), "gram", "content", "least_id", "words").groupBy(
        "block").applyInArrow(_parsed(k), "gram long, content long, ranges array<struct<a: int, b: int>>")
    crowded = items.where(F.col("kinds") > MOST)
    if not crowded.limit(1).count():
        return parsed
    single = crowded.select("gram", "content", "least_id", "words").mapInArrow(
        _single(k), "gram long, content long, least_id long, a int, window long")
    single = write_out(single, "windows")
    first = single.groupBy("window").agg(F.min("least_id").alias("first_id"))
    later = single.join(first, "window").where("first_id < least_id").groupBy("gram", "content").agg(
        F.collect_set(F.struct("a", (F.col("a") + 1).alias("b"))).alias("ranges"))
    return parsed.unionByName(later)


def _applied(k: int, with_text: bool):
    """Documents without their marked words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in _OUT.names]
            for doc_id, n_words, digest, cell, marks in zip(*(batch.column(c) for c in range(5))):
                spans, rest, digest, gone = [], None, digest.as_py(), 0
                if with_text or marks.is_valid:
                    words = words_of(_unpacked(cell))
                    steps = np.zeros(len(words.starts) + 1, np.int64)
                    if marks.is_valid:
                        start, n = (marks.values.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "n"))
                        np.add.at(steps, start, 1)
                        np.add.at(steps, start + n + k - 1, -1)
                    stays = np.cumsum(steps[:-1]) == 0
                    rest = _joined(words, stays)[0]
                    if marks.is_valid:
                        edge = np.diff(np.concatenate([[0], ~stays, [0]]).astype(np.int8))
                        begin = np.flatnonzero(edge > 0)
                        sizes = np.flatnonzero(edge < 0) - begin
                        spans = [{"start": s, "words": m} for s, m in zip(begin.tolist(), sizes.tolist())]
                        gone, digest = int(sizes.sum()), hashlib.sha256(rest).hexdigest()
                values = (doc_id.as_py(), n_words.as_py(), gone, spans, rest.decode(errors="replace") if with_text else None, digest)
                for column, value in zip(rows, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, _OUT.types)], schema=_OUT)
    return run


def remove_repeats(docs: DataFrame, k: int = 13, with_text: bool = True, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept, kept_sha256``: words in windows that start in a smaller document go.

    A window is k consecutive words, compared unchanged; the smallest document of a phrase keeps it, also within
    itself. ``spans`` are the duplicate spans in words; overlapping or touching factors are one span. Null or empty
    texts have no words and an empty rest. Rows with a null id are left out; rows of one id count as one document
    for the reference and are parsed each. Columns beyond the two named are not read. An empty table gives none.
    """
    key = ["doc_id", "text_k"]
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_k"), text.alias("text")).where(
        "doc_id IS NOT NULL")
    # cut twice rather than written: most stretches meet no other, and their table would be as large as the texts
    segments = source.mapInArrow(_segments(k, min(GRAM, k)), "doc_id long, text_k long, start long, n int, gram long, content long")
    met = segments.groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    kept = write_out(segments.join(met.select("gram"), "gram", "left_semi"), "met")
    contents = write_out(kept.groupBy("gram", "content").agg(
        F.min("doc_id").alias("least_id"), *[F.first(c).alias(c) for c in (*key, "start", "n")]), "contents")
    kinds = contents.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("least_id").alias("low"), F.max("least_id").alias("high"))
    wanted = contents.join(kinds.where("low < high"), "gram").select(
        *key, F.struct("start", "n", "gram", "content", "least_id", "kinds").alias("want"))
    touched = kept.select(*key, F.lit(None).cast(wanted.schema["want"].dataType).alias("want")).distinct().unionByName(wanted)
    touched = touched.groupBy(*key).agg(F.collect_list("want").alias("wants"))
    packed = source.select(*key, "text").mapInArrow(
        _packed, "doc_id long, text_k long, n_words long, whole_sha256 string, packed binary")
    held = F.col("packed") if with_text else F.when(F.col("wants").isNotNull(), F.col("packed"))
    placed = write_out(packed.join(touched, key, "left").withColumn("packed", held), "placed")
    items = write_out(placed.where("size(wants) > 0").select("packed", "wants").mapInArrow(
        _cut(k), "gram long, content long, least_id long, kinds long, words binary"), "items")
    judged = contents.select("gram", "content", "least_id").join(_repeats(items, k), ["gram", "content"], "left")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b")))
    marks = kept.join(judged, ["gram", "content"]).select(
        *key, "start", F.inline(F.when(F.col("doc_id") > F.col("least_id"), whole).otherwise(F.col("ranges"))))
    marks = marks.select(*key, F.struct((F.col("start") + F.col("a")).alias("start"), (F.col("b") - F.col("a")).alias("n")).alias("mark"))
    marks = marks.groupBy(*key).agg(F.collect_list("mark").alias("marks"))
    return placed.drop("wants").join(marks, key, "left").select(
        "doc_id", "n_words", "whole_sha256", "packed", "marks").mapInArrow(_applied(k, with_text), _OUT_DDL)
