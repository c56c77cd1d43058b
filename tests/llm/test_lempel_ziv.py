"""Relative Lempel-Ziv parsing against plain window look-ups, on few words so that windows repeat in every way."""

import numpy as np
import pytest

from quarrydesk.llm import substring_dedup

K = 13


def _texts(seed, n=120):
    rng = np.random.default_rng(seed)
    passage = [f"p{i}" for i in range(70)]
    out = []
    for i in range(n):
        words = [f"w{x}" for x in rng.integers(0, 400, rng.integers(0, 60))]
        at = rng.integers(0, 40)
        words[at:at] = passage[at:at + rng.integers(0, 31)]
        for _ in range(rng.integers(0, 3)):
            place = rng.integers(0, len(words) + 1)
            words[place:place] = ["a", "b", "a"] * int(rng.integers(0, 12))
        out.append((i, " ".join(words)))
    return out


def _brute(rows):
    first = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = text.split()
        for at in range(len(words) - K + 1):
            first.setdefault(tuple(words[at:at + K]), i)
    out = []
    for i, text in rows:
        words = text.split()
        gone = [False] * len(words)
        for at in range(len(words) - K + 1):
            if first[tuple(words[at:at + K])] < i:
                gone[at:at + K] = [True] * K
        out.append((i, len(words), sum(gone), " ".join(w for w, x in zip(words, gone) if not x)))
    return sorted(out)


def _found(spark, rows):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, start int, gram string")
    return sorted(tuple(r) for r in substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept").collect())


@pytest.mark.parametrize("most, gram", [(1024, 5), (2, 5), (1024, 2)])
def test_windows_of_smaller_documents_go(spark, monkeypatch, most, gram):
    monkeypatch.setattr(substring_dedup, "MOST", most)
    monkeypatch.setattr(substring_dedup, "GRAM", gram)
    rows = _texts(most + gram)
    rows += [(-3, rows[5][1]), (7, rows[5][1]), (7, rows[7][1]), (7, rows[7][1]), (500, "")]   # ids that repeat
    want = _brute(rows)
    assert sum(r[2] for r in want) > 500
    assert _found(spark, rows) == want


def test_null_ids_and_texts_and_no_rows(spark):
    schema = "doc_id long, text string"
    text = " ".join(f"w{i}" for i in range(20))
    got = substring_dedup.remove_repeats(spark.createDataFrame([(None, text), (4, text), (5, None), (6, text)], schema)).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in got) == [(4, 20, 0), (5, 0, 0), (6, 20, 20)]
    assert substring_dedup.remove_repeats(spark.createDataFrame([], schema)).count() == 0


def test_stretches_cover_each_window_once():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 5, 3000).astype(np.uint64)
    text = np.sort(rng.integers(0, 90, 3000))
    start, n, gram, content = substring_dedup.stretches(hashes, text, K, 3)
    windows = np.concatenate([np.arange(s, s + m) for s, m in zip(start, n)])
    assert windows.tolist() == [at for at in range(3000 - K + 1) if text[at] == text[at + K - 1]]
    assert n.max() <= K - 3 + 1
    of = {}
    for s, m, g, c in zip(start, n, gram, content):
        assert of.setdefault(c, (hashes[s:s + m + K - 1].tolist(), g)) == (hashes[s:s + m + K - 1].tolist(), g)
        for at in range(s, s + m):                             # equal windows meet under one gram
            assert of.setdefault(tuple(hashes[at:at + K]), g) == g


def test_factors_and_their_ends():
    rng = np.random.default_rng(8)
    for _ in range(200):
        reference = substring_dedup.Reference(4)
        stretches = [rng.integers(0, 3, rng.integers(4, 14)).astype(np.uint64) for _ in range(rng.integers(0, 6))]
        known = {tuple(s[at:at + 4]) for s in stretches for at in range(len(s) - 3)}
        for s in stretches:
            reference.add(s.tobytes())
        asked = rng.integers(0, 3, 20).astype(np.uint64)
        got = substring_dedup.duplicate_windows(asked.tobytes(), reference, 4)
        assert got == [tuple(asked[at:at + 4]) in known for at in range(17)]
