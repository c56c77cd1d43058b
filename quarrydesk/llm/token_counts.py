"""Token counts of sections by offset-mapped attribution.

A document is encoded once, as a whole. The byte lengths of its tokens give their character spans, which are joined
as intervals to the spans of its sections; a token over a boundary is allocated by a rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrydesk.llm.byte_bpe import parse_ranks, read_ranks
from quarrydesk.llm.words import slices, text_bytes

#: Where a token over a boundary counts: the section of its first byte, of its last byte, or of most of its bytes
#: (the first of equals).
RULES = ("start", "end", "most")

_OUT = pa.schema([("doc_id", pa.int64()), ("section", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                  ("n_tokens", pa.int64()), ("n_crossing", pa.int64()), ("doc_tokens", pa.int64())])
_OUT_DDL = "doc_id long, section long, start long, end long, n_tokens long, n_crossing long, doc_tokens long"


def line_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte ends of the sections of all texts: lines, each with its newline; an empty text is one empty section."""
    ends = np.flatnonzero(data == 0x0A) + 1
    closed = np.isin(offsets[1:], ends) & (np.diff(offsets) > 0)
    return np.sort(np.concatenate([ends, offsets[1:][~closed]]), kind="stable")


def allocate(token_ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """For each token of one text its section, and whether it lies in several. Both are intervals end to end."""
    starts = np.append(0, token_ends)[:-1]
    head = np.searchsorted(section_ends, starts, side="right")
    tail = np.searchsorted(section_ends, token_ends, side="left")
    where = {"start": head, "end": tail}.get(rule)
    if rule == "most":
        where = head.copy()
        for t in np.flatnonzero(head != tail):
            edges = np.concatenate([[starts[t]], section_ends[head[t]:tail[t]], [token_ends[t]]])
            where[t] = head[t] + int(np.argmax(np.diff(edges)))
    if where is None:
        raise ValueError(f"rule must be one of {RULES}")
    return where, head != tail


def _counter(lines, pattern: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = parse_ranks(lines.value)
        encode = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        width = np.zeros(len(ranks), np.int64)
        for token, rank in ranks.items():
            width[rank] = len(token)
        for batch in batches:
            for piece in slices(batch, limit=1 << 20):
                data, offsets = text_bytes(piece.column(1))
                char = np.append(0, np.cumsum((data & 0xC0) != 0x80))
                ends = line_ends(data, offsets)
                ids = piece.column(0)
                rows = [[] for _ in _OUT.names]
                at = 0
                for k, text in enumerate(piece.column(1).fill_null("").to_pylist()):
                    low, high = offsets[k], offsets[k + 1]
                    n = 1 if low == high else int(np.searchsorted(ends[at:], high, side="left")) + 1
                    own = ends[at:at + n] - low
                    at += n
                    tokens = encode(text)
                    where, crossing = allocate(np.cumsum(width[tokens]) if tokens else np.zeros(0, np.int64), own, rule)
                    places = char[own + low] - char[low]
                    for held, x in zip(rows, (
                            np.full(n, k), np.arange(n), np.append(0, places[:-1]), places, np.bincount(where, minlength=n),
                            np.bincount(where[crossing], minlength=n), np.full(n, len(tokens)))):
                        held.append(x)
                rows = [np.concatenate(x) for x in rows]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[0])), *map(pa.array, rows[1:])], schema=_OUT)
    return run


def section_token_counts(docs: DataFrame, vocabulary: str, pattern: str, rule: str = "start", id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One row for each line of each whole text: its character span, its tokens, those over a boundary; the text's tokens.

    The sections' tokens add up to the text's, whatever the rule (see ``RULES``). A null or empty text is one empty
    section without tokens. A null id stays null; repeated rows are counted each; an empty table gives none.
    """
    spark = docs.sparkSession
    lines = spark.sparkContext.broadcast(read_ranks(spark, vocabulary))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _counter(lines, pattern, rule), _OUT_DDL)
