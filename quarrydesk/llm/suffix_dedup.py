"""Removal of repeated byte strings by threshold-bounded interval expansion on Burrows-Wheeler transforms.

Two equal strings of ``length`` bytes (windows) hold the same least gram hash, so every document is cut into stretches of
windows with one least gram, and stretches meet under that gram. Grams met once, most of them, end there; copies of a
stretch count as one with a multiplicity. The differing stretches of a gram go to one block. A block is a text: its suffix
array gives the Burrows-Wheeler transform, and intervals are expanded backward breadth first, so common prefixes come out by
increasing length; after ``length`` rounds the suffixes still unseparated share ``length`` bytes or more.

A gram with more than ``MOST`` differing stretches is dealt anew by longer and longer context around the gram, until few
are left or one window is all the context: then its strings are equal and count as one. So no block is unbounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrydesk.llm.words import mix, slices, text_bytes
from quarrydesk.session import write_out

#: Bytes of a gram; shorter ones than windows by far, so that stretches are long, but rare in unrelated texts.
GRAM = 64
#: Bytes of text hashed at a time; longer texts are taken in pieces that overlap by a window.
PIECE = 1 << 20
#: Stretches of a block on average, and differing stretches that a gram may bring to it.
BLOCK, MOST = 512, 1024
#: Stretches looked at together for a second occurrence of their gram.
_TOGETHER = 2048
_ODD = np.uint64(0x9E3779B97F4A7C15)

_SEGMENTS = "doc_k long, text_k long, start int, n int, gram long, content long, again boolean"
_SEGMENT_SCHEMA = pa.schema([("doc_k", pa.int64()), ("text_k", pa.int64()), ("start", pa.int32()), ("n", pa.int32()),
                             ("gram", pa.int64()), ("content", pa.int64()), ("again", pa.bool_())])


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two, 8 at least) from each byte on."""
    if len(data) < gram:
        return np.zeros(0, np.uint64)
    out = mix(np.ndarray(len(data) - 7, "<u8", buffer=np.ascontiguousarray(data), strides=(1,)))
    size = 8
    while size < gram:
        out = out[:-size] * _ODD + (out[size:] ^ (out[size:] >> np.uint64(29)))
        size *= 2
    return mix(out)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    rows = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    rows[:n] = values
    rows = rows.reshape(-1, width)
    right = np.minimum.accumulate(rows, axis=1).ravel()
    left = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n - width + 1], right[width - 1:n])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Text number, first byte in the text, windows, gram, content hash and whether the gram occurs twice, of all
    maximal runs of windows with one least gram, cut to as many windows as may hold one occurrence."""
    values, width = gram_hashes(data, gram), length - gram + 1
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(counts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none.astype(bool)
    first = np.cumsum(counts) - counts
    where = np.arange(total) + np.repeat(offsets[:-1] - first, counts)
    text = np.repeat(np.arange(len(counts)), counts)
    least = sliding_least(values, width)[where]
    new = np.append(True, (least[1:] != least[:-1]) | (text[1:] != text[:-1]))
    begin = np.flatnonzero(new)
    since = np.arange(total) - np.repeat(begin, np.diff(np.append(begin, total)))
    at = np.flatnonzero(since % width == 0)
    n, start, own = np.diff(np.append(at, total)), where[at], least[at]
    size = n + length - 1
    content = mix(size.astype(np.uint64))
    for step in range(0, int(size.max()), gram):
        some = step < size
        content[some] = content[some] * _ODD + values[(start + np.minimum(step, size - gram))[some]]
    reach = 2 * width - 1
    padded = np.append(values, np.zeros(reach, np.uint64))
    views, column = np.lib.stride_tricks.sliding_window_view(padded, reach), np.arange(reach)
    again = np.zeros(len(at), bool)
    for k in range(0, len(at), _TOGETHER):
        part = slice(k, k + _TOGETHER)
        equal = (views[start[part]] == own[part, None]) & (column < (n[part] + width - 1)[:, None])
        again[part] = equal.sum(axis=1) > 1
    return text[at], start - offsets[text[at]], n, own, mix(content), again


def _segments(length: int, gram: int):
    def pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, int]]:
        for piece in slices(batch, limit=PIECE):
            data, offsets = text_bytes(piece.column(2))
            for at in range(0, max(len(data) - length + 1, 1), PIECE) if piece.num_rows == 1 else [0]:
                part = data[at:at + PIECE + length - 1] if piece.num_rows == 1 else data
                yield piece, part, np.array([0, len(part)]) if piece.num_rows == 1 else offsets, at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets, base in pieces(batch):
                text, start, n, own, content, again = stretches(data, offsets, length, gram)
                row = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(row), piece.column(1).take(row), pa.array((start + base).astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(own.view(np.int64)), pa.array(content.view(np.int64)), pa.array(again)],
                    schema=_SEGMENT_SCHEMA)
    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text compressed, with its size and digest."""
    schema = pa.schema([("doc_k", pa.int64()), ("text_k", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                        ("whole_sha256", pa.string()), ("packed", pa.binary())])
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for piece in slices(batch, limit=PIECE):
            texts = [x.encode() if x else b"" for x in piece.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), piece.column(3), pa.array([len(x) for x in texts], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                 pa.array([press.compress(x) for x in texts], pa.binary())], schema=schema)


def _unpacked(cell: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(cell)


def _cut(length: int):
    """The bytes of the wanted stretches of each document."""
    schema = pa.schema([("gram", pa.int64()), ("content", pa.int64()), ("copies", pa.int64()), ("kinds", pa.int64()),
                        ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, wants in zip(batch.column(0), batch.column(1)):
                text, wants = _unpacked(cell.as_py()), wants.values
                start, n = (wants.field(f).to_numpy(zero_copy_only=False) for f in ("start", "n"))
                parts = [text[a:b] for a, b in zip(start.tolist(), (start + n + length - 1).tolist())]
                yield pa.RecordBatch.from_arrays([*(wants.field(f) for f in ("gram", "content", "copies", "kinds")),
                                                  pa.array(parts, pa.binary())], schema=schema)
    return run


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and its inverse of symbols below 512 that end in their only 0, by doubling the compared prefix."""
    n, packed = len(text), 7
    key = np.zeros(n, np.int64)
    padded = np.append(text, np.zeros(packed, np.int64))
    for k in range(packed):
        key = key << 9 | padded[k:k + n]
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order[1:]] != key[order[:-1]])
    rank, size = np.empty(n, np.int64), packed
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while True:
        single = new & np.append(new[1:], True)
        at = np.flatnonzero(~single)
        if not len(at):
            return order, rank
        mine = order[at]
        key = rank[mine] * n + rank[mine + size]
        by = np.argsort(key, kind="stable")
        mine, key = mine[by], key[by]
        order[at] = mine
        new[at] = np.append(True, key[1:] != key[:-1])
        rank[mine] = np.maximum.accumulate(np.where(new[at], at, 0))
        size *= 2


def separated(text: np.ndarray, order: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix, in order, shares fewer than ``length`` symbols with the one before it.

    Backward extension of intervals of the Burrows-Wheeler transform, breadth first: in round r the intervals of strings
    of r symbols are extended by every symbol before them, and the right ends found for the first time are the places where
    neighbours share r symbols. Only intervals that found such a place are extended further.
    """
    n = len(text)
    back = rank[(order - 1) % n]                       # where the suffix one symbol longer is
    forth = rank[(order + 1) % n]
    first = text[order]
    joint = np.append(False, np.append(first[1:] == first[:-1], False))   # joint[j]: suffixes j - 1 and j begin alike
    after = np.where(joint[back + 1], forth[np.minimum(back + 1, n - 1)], n)   # next place with the same symbol before it
    before = np.where(joint[back], forth[back - 1], -1)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        sizes = high - low
        places = np.arange(sizes.sum()) + np.repeat(low - np.cumsum(sizes) + sizes, sizes)
        opens = places[before[places] < np.repeat(low, sizes)]
        closes = places[after[places] >= np.repeat(high, sizes)]
        low, high = np.sort(back[opens]), np.sort(back[closes]) + 1
        found = ~known[high]
        low, high = low[found], high[found]
        if not len(low):
            break
        known[high] = True
    return known[:n]


def repeated_windows(contents: list[bytes], copies: np.ndarray, length: int) -> list[list[dict]]:
    """For each content the runs of windows, from ``a`` up to ``b``, that start more than once over all copies."""
    sizes = np.array([len(c) for c in contents])
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.ones(int((sizes + 1).sum()) + 1, np.int64)
    text[-1] = 0
    inside = np.arange(sizes.sum()) + np.repeat(np.arange(len(sizes)), sizes)
    text[inside] = np.frombuffer(b"".join(contents), np.uint8).astype(np.int64) + 2
    windows = np.maximum(sizes - length + 1, 0)
    starts = np.arange(windows.sum()) + np.repeat(begin - np.cumsum(windows) + windows, windows)
    weight = np.zeros(len(text))
    weight[starts] = np.repeat(copies, windows)
    order, rank = suffix_array(text)
    group = np.cumsum(separated(text, order, rank, length)) - 1
    twice = np.bincount(group, weight[order])[group[rank[starts]]] > 1
    owner = np.repeat(np.arange(len(sizes)), windows)
    edge = np.append(True, owner[1:] != owner[:-1]) if len(owner) else np.zeros(0, bool)
    opens = np.flatnonzero(twice & (edge | ~np.append(False, twice[:-1])))
    closes = np.flatnonzero(twice & (np.append(edge[1:], True) | ~np.append(twice[1:], False)))
    out: list[list[dict]] = [[] for _ in contents]
    base = np.cumsum(windows) - windows
    for a, b in zip(opens.tolist(), closes.tolist()):
        out[owner[a]].append({"a": a - int(base[owner[a]]), "b": b + 1 - int(base[owner[a]])})
    return out


_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _repeated(length: int):
    """Repeated windows of the distinct contents of a block."""
    schema = pa.schema([("gram", pa.int64()), ("content", pa.int64()), ("ranges", _RANGES)])

    def run(table: pa.Table) -> pa.Table:
        rows = {}
        for gram, content, copies, cell in zip(*(table.column(c).to_pylist() for c in ("gram", "content", "copies", "bytes"))):
            rows[gram, content] = (copies, cell)
        found = repeated_windows([c for _, c in rows.values()], np.array([n for n, _ in rows.values()]), length)
        some = [(*key, ranges) for key, ranges in zip(rows, found) if ranges]
        columns = list(zip(*some)) or [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)
    return run


def _refined(length: int, gram: int, level: int):
    """Each stretch cut where the place of its gram in a window changes class; the context that all windows of a class
    share is the new gram. ``level`` halves the classes; in the last one a class is one place."""
    schema = pa.schema([("gram", pa.int64()), ("content", pa.int64()), ("of_gram", pa.int64()), ("of_content", pa.int64()),
                        ("at", pa.int32()), ("copies", pa.int64()), ("bytes", pa.binary())])
    width = length - gram + 1
    step = -(-width // (1 << level))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema.names]
            for of_gram, of_content, at, copies, own, cell in zip(*(c.to_pylist() for c in batch.columns)):
                values = gram_hashes(np.frombuffer(cell, np.uint8), gram).view(np.int64)
                hits = np.flatnonzero(values == own)
                windows = np.arange(len(cell) - length + 1)
                anchor = hits[np.searchsorted(hits, windows)]          # the first one in the window
                kind = (anchor - windows) // step
                new = np.flatnonzero(np.append(True, (kind[1:] != kind[:-1]) | (anchor[1:] != anchor[:-1])))
                for a, b in zip(new.tolist(), np.append(new[1:], len(windows)).tolist()):
                    least = int(kind[a]) * step
                    most = min(least + step, width) - 1
                    core = cell[max(int(anchor[a]) - least, 0):int(anchor[a]) - most + length]
                    part = cell[a:b + length - 1]
                    digest = hashlib.blake2b(core, digest_size=8, person=f"{level}:{least}".encode()).digest()
                    row = (int.from_bytes(digest, "little", signed=True),
                           int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little", signed=True),
                           of_gram, of_content, at + a, copies, part)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)
    return run


def _in_blocks(items: DataFrame, length: int) -> DataFrame:
    """``gram, content, ranges`` of the distinct ``gram, content, copies, bytes``, a block of grams at a time."""
    blocks = max(1, -(-items.count() // BLOCK))
    return items.select(F.pmod(F.xxhash64("gram"), F.lit(blocks)).alias("block"), "gram", "content", "copies", "bytes").groupBy(
        "block").applyInArrow(_repeated(length), "gram long, content long, ranges array<struct<a: int, b: int>>")


def _repeats(items: DataFrame, length: int, gram: int) -> DataFrame:
    """``gram, content, a, b``: repeated windows of all items, those of crowded grams by their refined grams."""
    few = items.where(F.col("kinds") <= MOST)
    found = [_in_blocks(few, length).select("gram", "content", F.inline("ranges"))]
    rows = items.where(F.col("kinds") > MOST).select(
        F.col("gram").alias("of_gram"), F.col("content").alias("of_content"), F.lit(0).alias("at"), "copies",
        F.col("gram").alias("own"), "bytes").dropDuplicates(["of_gram", "of_content"])
    level, last = 0, int(np.ceil(np.log2(length - gram + 1)))
    while level < last and rows.limit(1).count():
        level += 1
        ddl = "gram long, content long, of_gram long, of_content long, at int, copies long, bytes binary"
        parts = write_out(rows.mapInArrow(_refined(length, gram, level), ddl), "refined")
        # a window lies in one part of its stretch, so parts of one stretch are different places as well
        distinct = parts.groupBy("gram", "content").agg(F.sum("copies").alias("copies"), F.first("bytes").alias("bytes"))
        kinds = distinct.groupBy("gram").agg(F.count("*").alias("kinds"))
        distinct = write_out(distinct.join(kinds, "gram"), "distinct")
        ready = distinct if level == last else distinct.where(F.col("kinds") <= MOST)
        ranges = _in_blocks(ready, length).select("gram", "content", F.inline("ranges"))
        found.append(parts.drop("bytes", "copies").join(ranges, ["gram", "content"]).select(
            F.col("of_gram").alias("gram"), F.col("of_content").alias("content"), (F.col("a") + F.col("at")).alias("a"),
            (F.col("b") + F.col("at")).alias("b")))
        crowded = distinct.where(F.col("kinds") > MOST).select("gram").distinct()
        rows = parts.join(crowded, "gram", "left_semi").select(
            "of_gram", "of_content", "at", "copies", F.col("of_gram").alias("own"), "bytes")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _applied(with_text: bool):
    """Documents without their marked bytes."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("spans", pa.list_(
        pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in schema.names]
            for doc_id, size, digest, cell, marks in zip(*(batch.column(k) for k in range(5))):
                spans, text, digest = [], None, digest.as_py()
                if with_text or marks.is_valid:
                    text = _unpacked(cell.as_py())
                if marks.is_valid:
                    start, end = (marks.values.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("start", "end"))
                    by = np.argsort(start, kind="stable")
                    start, end = start[by], np.maximum.accumulate(end[by])
                    new = np.append(True, start[1:] > end[:-1])
                    spans = list(zip(start[new].tolist(), end[np.append(new[1:], True)].tolist()))
                    text = b"".join(text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)]))
                    digest = hashlib.sha256(text).hexdigest()
                values = (doc_id.as_py(), size.as_py(), sum(e - s for s, e in spans), len(spans),
                          [{"start": s, "end": e} for s, e in spans], digest, text if with_text else None)
                for column, value in zip(rows, values):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types)], schema=schema)
    return run


def remove_repeated_bytes(docs: DataFrame, length: int = 200, gram: int = GRAM, with_text: bool = True, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256, kept``: bytes in strings of ``length`` that start twice go.

    Texts are UTF-8 bytes, a null is empty; matches lie within one document and every occurrence goes, also of strings
    that overlap themselves. ``kept`` are the remaining bytes, which need not be UTF-8 any more. Each row is a document:
    equal rows are copies of each other, and rows of one id or without one are judged each. Columns beyond the two named
    are not read. An empty table gives none. ``gram`` is a power of two from 8 and below ``length``.
    """
    if gram < 8 or gram & (gram - 1) or gram >= length:
        raise ValueError("gram must be a power of two, at least 8 and below length")
    doc, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    key = ["doc_k", "text_k"]
    source = docs.select(F.coalesce(doc, F.lit(0)).alias("doc_k"), F.xxhash64(doc.isNull(), text).alias("text_k"),
                         text.alias("text"), doc.alias("doc_id"))
    segments = write_out(source.where(F.octet_length("text") >= length).select(*key, "text").mapInArrow(
        _segments(length, gram), _SEGMENTS), "segments")
    met = segments.groupBy("gram").agg(F.count("*").alias("n"), F.max("again").alias("again")).where("n > 1 OR again")
    kept = write_out(segments.join(met.select("gram"), "gram", "left_semi"), "met")
    contents = kept.groupBy("gram", "content").agg(
        F.count("*").alias("copies"), *[F.first(c).alias(c) for c in (*key, "start", "n")])
    contents = write_out(contents, "contents")
    kinds = contents.groupBy("gram").agg(F.count("*").alias("kinds"))
    contents = contents.join(kinds, "gram")
    whole = contents.where("kinds = 1 AND copies > 1").select("gram", "content", F.lit(0).alias("a"), F.col("n").alias("b"))
    wanted = contents.where("kinds > 1 OR copies = 1").select(*key, F.struct("start", "n", "gram", "content", "copies", "kinds").alias("want"))
    touched = kept.select(*key, F.lit(None).cast(wanted.schema["want"].dataType).alias("want")).distinct().unionByName(wanted)
    touched = touched.groupBy(*key).agg(F.collect_list("want").alias("wants"))
    packed = source.select(*key, "text", "doc_id").mapInArrow(
        _packed, "doc_k long, text_k long, doc_id long, n_bytes long, whole_sha256 string, packed binary")
    held = F.col("packed") if with_text else F.when(F.col("wants").isNotNull(), F.col("packed"))
    placed = write_out(packed.join(touched, key, "left").withColumn("packed", held), "placed")
    items = write_out(placed.where("size(wants) > 0").select("packed", "wants").mapInArrow(
        _cut(length), "gram long, content long, copies long, kinds long, bytes binary"), "items")
    ranges = _repeats(items, length, gram).unionByName(whole)
    marks = kept.join(ranges, ["gram", "content"]).select(*key, F.struct(
        (F.col("start") + F.col("a")).alias("start"), (F.col("start") + F.col("b") + (length - 1)).alias("end")).alias("mark"))
    marks = marks.groupBy(*key).agg(F.collect_list("mark").alias("marks"))
    return placed.drop("wants").join(marks, key, "left").select(
        "doc_id", "n_bytes", "whole_sha256", "packed", "marks").mapInArrow(
        _applied(with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, "
        "spans array<struct<start: long, end: long>>, kept_sha256 string, kept binary")
