"""A deterministic stand-in encoder; a sentence encoder plugs in the same way."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import numpy as np

DIMENSION = 64


def load_hashing_encoder(dimension: int = DIMENSION) -> Callable[[list[str]], np.ndarray]:
    """Signed hashed words of a text as a dense vector; called once per worker task."""
    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimension))
        for row, text in enumerate(texts):
            for word in text.lower().split():
                code = crc32(word.encode())
                out[row, code % dimension] += 1.0 if code & 0x10000 else -1.0
        return out
    return encode
