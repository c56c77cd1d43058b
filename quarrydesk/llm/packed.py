"""A shuffle of many small (key, value) pairs as few large rows: keys by range, sorted, as bytes that compress well."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from quarrydesk.llm.words import mix

#: Pairs gathered by a map task before it sends them.
FLUSH = 2_000_000
#: A key with more values in one such load sends only the least of them through the join; the others go past it.
LOCAL_HOT = 64

SCHEMA = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("place", pa.binary()),
                    ("values", pa.binary()), ("hot", pa.binary()), ("extra", pa.binary())])
DDL = "part int, n long, keys binary, place binary, values binary, hot binary, extra binary"


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def scattered(ids: np.ndarray, parts: int) -> np.ndarray:
    return part_of(mix(ids.astype(np.int64).view(np.uint64)), parts)


def _planes(keys: np.ndarray) -> bytes:
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _keys(planes: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(planes, np.uint8).reshape(8, n).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)


def distinct_pairs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    if not len(keys):
        return keys, values
    new = np.append(True, (keys[1:] != keys[:-1]) | (values[1:] != values[:-1]))
    return keys[new], values[new]


def pack(parts: int, keys: np.ndarray, values: np.ndarray, extra: np.ndarray | None = None) -> pa.RecordBatch:
    """One row for each part. ``extra``: rows of integers that travel along, spread by the first of each column."""
    keys, values = distinct_pairs(keys, values)
    at = run_starts(keys)
    runs = np.diff(np.append(at, len(keys)))
    past = np.repeat(runs > LOCAL_HOT, runs)
    past[at] = False
    hot = np.stack([keys.view(np.int64), values, np.repeat(values[at], runs)])[:, past]
    keys, values = keys[~past], values[~past]
    bounds = np.searchsorted(part_of(keys, parts), np.arange(parts + 1))
    extra = np.zeros((1, 0), np.int64) if extra is None else extra
    loose = []
    for block, ids in ((hot, hot[1]), (extra, extra[0])):
        share = scattered(ids, parts)
        order = np.argsort(share, kind="stable")
        loose.append((block[:, order], np.searchsorted(share[order], np.arange(parts + 1))))
    rows: dict[str, list] = {name: [] for name in SCHEMA.names}
    for p in range(parts):
        mine = slice(bounds[p], bounds[p + 1])
        (over, along) = (block[:, cut[p]:cut[p + 1]] for block, cut in loose)
        if mine.start == mine.stop and not over.size and not along.size:
            continue
        names, place = np.unique(values[mine], return_inverse=True)
        cells = (p, mine.stop - mine.start, _planes(keys[mine]),
                 place.astype(np.uint32 if len(names) > 65535 else np.uint16).tobytes(), names.tobytes(), over.tobytes(),
                 along.tobytes())
        for name, cell in zip(SCHEMA.names, cells):
            rows[name].append(cell)
    return pa.RecordBatch.from_pydict(rows, schema=SCHEMA)


def unpack(table: pa.Table, extra_rows: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, value) pairs by key, then value; the (key, value, least value) that went past; the extra rows."""
    keys, values, hot, extra = [], [], [], []
    for row in table.select(SCHEMA.names[1:]).to_pylist():
        n, place = row["n"], row["place"]
        keys.append(_keys(row["keys"], n))
        names = np.frombuffer(row["values"], np.int64)
        values.append(names[np.frombuffer(place, np.uint16 if len(place) == 2 * n else np.uint32)])
        hot.append(np.frombuffer(row["hot"], np.int64).reshape(3, -1))
        extra.append(np.frombuffer(row["extra"], np.int64).reshape(extra_rows, -1))
    keys, values = distinct_pairs(np.concatenate(keys), np.concatenate(values))
    return keys, values, np.concatenate(hot, axis=1), np.concatenate(extra, axis=1)
