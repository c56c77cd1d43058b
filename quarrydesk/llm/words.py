"""Words, word hashes and n-gram hashes of a whole Arrow batch of texts, vectorised over its bytes.

A word is a run of bytes other than space and ``\\x09-\\x0D``. Hashes are 64 bits wide, the same on every
machine, and stand for the words in every comparison.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken in slices of about so many bytes, so a task's memory does not depend on the batch size. An executor holds
#: the largest slice's arrays for each core, also while its Python workers wait.
SLICE_BYTES = 1 << 20
#: Bytes hashed at a time.
HASH_BYTES = 1 << 18

_MULTIPLIER = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _byte_codes(lower: bool) -> np.ndarray:
    codes = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_MULTIPLIER))
    if lower:
        codes[ord("A"):ord("Z") + 1] = codes[ord("a"):ord("z") + 1]
    codes[_SPACE] = 0
    return codes


_CODES = {flag: _byte_codes(flag) for flag in (False, True)}


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _MULTIPLIER, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and n + 1 offsets; a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each of about ``limit`` bytes of text or of one row."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield batch.slice(at, to - at)
        at = to


class Words:
    """Where the words of some texts are: ``starts``, ``ends`` (bytes) and ``first``, n + 1 word offsets by text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = ~_SPACE[data]
        before = np.zeros(len(data), dtype=bool)
        before[1:] = inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), dtype=bool)
        after[:-1] = inside[1:] & before[1:]
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        codes, out = _CODES[lower], np.zeros(len(self.starts), dtype=np.uint64)
        longest = int((self.ends - self.starts).max(initial=1))
        powers = _powers(longest)
        at = 0
        while at < len(out):
            to = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + HASH_BYTES)))
            low, high = self.starts[at], self.ends[to - 1]
            begin = self.starts[at:to] - low
            inner = np.arange(high - low) - np.repeat(begin, np.diff(np.append(begin, high - low)))
            np.minimum(inner, longest - 1, out=inner)
            out[at:to] = np.add.reduceat(codes[self.data[low:high]] * powers[inner], begin)
            at = to
        return mix(out + (self.ends - self.starts).astype(np.uint64))

    def grams(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words within a text, and the word number at which each starts."""
        if len(hashes) < n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        span = len(hashes) - n + 1
        total = np.zeros(span, dtype=np.uint64)
        for k, power in enumerate(_powers(n + 1)[1:]):
            total += hashes[k:k + span] * power
        text = self.text_of()
        at = np.flatnonzero(text[:span] == text[n - 1:])
        return mix(total[at]), at


def words_of(column: pa.Array) -> Words:
    return Words(*text_bytes(column))


def fold(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash for each run ``first[i]:first[i + 1]`` of hashes, in order; 0 for an empty run."""
    out = np.zeros(len(first) - 1, dtype=np.uint64)
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    if len(full):
        place = np.arange(first[0], first[-1]) - np.repeat(first[:-1], sizes)
        powers = _powers(int(sizes.max()))
        parts = (hashes[first[0]:first[-1]] + np.uint64(1)) * powers[place]
        out[full] = mix(np.add.reduceat(parts, first[:-1][full] - first[0]))
    return out
