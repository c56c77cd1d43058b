"""Byte-level BPE encoding and decoding with a sentencepiece model written from the vocabulary.

A rank file lists byte strings by merge order. Each becomes a piece, one character for each byte, scored by its
negative rank, so sentencepiece merges pairs in the same order; normalisation is the identity. Texts are cut into
pre-tokens by a pattern, and each distinct pre-token is encoded once per load.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrydesk.llm.words import slices

#: The character of byte b is chr(BYTE_BASE + b): letters that no normaliser or pre-tokeniser touches.
BYTE_BASE = 0x0400
#: Pre-tokens remembered by a task, and bytes of text encoded at a time.
MEMORY, PIECE_BYTES = 50_000, 1 << 18

_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("ids_sha256", pa.string()),
                  ("decoded_sha256", pa.string())])
_OUT_DDL = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"


def parse_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The rank file through Spark's reader, so any store works; a vocabulary is small by nature."""
    url = path if re.match(r"\w+:", path) else f"file://{path}"
    return bytes(spark.read.format("binaryFile").load(url).first()["content"])


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, kind: int, payload: bytes) -> bytes:
    return _varint(number << 3 | kind) + (_varint(len(payload)) if kind == 2 else b"") + payload


def byte_chars(token: bytes) -> str:
    return "".join(chr(BYTE_BASE + b) for b in token)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised BPE model. Piece 0 is the unknown piece, which the 256 bytes never need; rank r is piece r + 1.

    Field numbers and enum values are those of the public sentencepiece_model.proto.
    """
    by_rank = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must run from 0 without a gap")
    normal, unknown, bpe = 1, 2, 2
    parts = [_field(1, 2, _field(1, 2, b"<unk>") + _field(2, 5, np.float32(0).tobytes()) + _field(3, 0, _varint(unknown)))]
    for rank, token in enumerate(by_rank):
        parts.append(_field(1, 2, _field(1, 2, byte_chars(token).encode()) + _field(2, 5, np.float32(-rank).tobytes())
                            + _field(3, 0, _varint(normal))))
    trainer = _field(3, 0, _varint(bpe)) + _field(4, 0, _varint(len(by_rank) + 1)) + _field(40, 0, _varint(0))
    normaliser = _field(1, 2, b"identity") + b"".join(_field(k, 0, _varint(0)) for k in (3, 4, 5))
    return b"".join(parts) + _field(2, 2, trainer) + _field(3, 2, normaliser)


class Codec:
    """Encoder and decoder of one vocabulary, for use inside a task."""

    def __init__(self, lines: bytes, pattern: str):
        import regex
        import sentencepiece

        ranks = parse_ranks(lines)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.split: Callable[[str], list[str]] = regex.compile(pattern).findall
        self.tokens = sorted(ranks, key=ranks.get)
        self.chars = str.maketrans({chr(b): chr(BYTE_BASE + b) for b in range(256)})
        self.known: dict[str, tuple[list[int], str]] = {}

    def encode(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """Ids, and the ids as decimal text joined by commas, of each text."""
        cut = [self.split(text) for text in texts]
        known, get = self.known, self.known.get
        if len(known) > MEMORY:
            known.clear()
        fresh = list({word for words in cut for word in words if word not in known})
        mapped = [word.encode().decode("latin-1").translate(self.chars) for word in fresh]
        for word, ids in zip(fresh, self.model.encode(mapped, out_type=int, num_threads=1)):
            ids = [i - 1 for i in ids]
            known[word] = ids, ",".join(map(str, ids))
        out = []
        for words in cut:
            pairs = [get(word) for word in words]
            out.append(([i for ids, _ in pairs for i in ids], ",".join([shown for _, shown in pairs])))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _coder(lines, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(lines.value, pattern)
        for batch in batches:
            for piece in slices(batch, limit=PIECE_BYTES):
                coded = codec.encode(piece.column(1).fill_null("").to_pylist())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column(0), "n_tokens": [len(ids) for ids, _ in coded],
                    "ids": [ids if with_ids else None for ids, _ in coded],
                    "ids_sha256": [hashlib.sha256(shown.encode()).hexdigest() for _, shown in coded],
                    "decoded_sha256": [hashlib.sha256(codec.decode(ids)).hexdigest() for ids, _ in coded]}, schema=_OUT)
    return run


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, with_ids: bool = True, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of whole texts; ``vocabulary`` is a rank file's path.

    Special tokens are ordinary text. A null or empty text has no ids; a null id stays null; repeated rows give
    repeated rows; an empty table gives none. Long texts are encoded whole. The vocabulary is broadcast: one file,
    whose size does not depend on the data.
    """
    spark = docs.sparkSession
    lines = spark.sparkContext.broadcast(read_ranks(spark, vocabulary))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _coder(lines, pattern, with_ids), _OUT_DDL)
