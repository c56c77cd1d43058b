"""Suffix dedup, vector codes and the prefix trie against brute force, with awkward rows."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarrydesk.llm import prefix_trie, suffix_dedup, vector_codes


# --- suffix dedup --------------------------------------------------------------------------------------------------------

def kept_bytes(texts, length):
    """``n_removed, n_spans, kept`` of each text by counting every string."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((gone & ~np.append(False, gone[:-1])[:len(d)]).sum())
        out.append((int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def awkward_texts(rng):
    common = "".join(rng.choice(list("abcdef "), 90))
    rows = [(i, "".join(rng.choice(list("abcdef "), 60)) + common + "".join(rng.choice(list("abcdef "), 60))) for i in range(60)]
    rows += [(100 + i, common[:70 + i % 9] + str(i)) for i in range(30)]
    rows += [(200, None), (201, ""), (202, "é🎉" * 40), (203, "x" * 500), (204, "xy" * 300), (205, "short"), (206, rows[0][1]),
             (206, rows[0][1]), (206, rows[1][1]), (None, rows[2][1]), (None, rows[2][1]), (207, "é🎉" * 40 + "é")]
    return rows


@pytest.mark.parametrize("most", [1024, 3])
def test_repeated_bytes(spark, monkeypatch, most):
    """With ``MOST`` at 3 nearly every gram is crowded, so results come from the refined grams."""
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 8)
    rows = awkward_texts(np.random.default_rng(3))
    docs = spark.createDataFrame([(i, t, 1, "n", 2) for i, t in rows], "doc_id long, text string, gram int, start string, n int")
    got = suffix_dedup.remove_repeated_bytes(docs, length=40, gram=8).collect()
    want = [(i, len((t or "").encode()), *k) for (i, t), k in zip(rows, kept_bytes([t for _, t in rows], 40))]
    have = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    assert all(r["kept_sha256"] == hashlib.sha256(r["kept"]).hexdigest() for r in got)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("abcd"), 4000)) for _ in range(3)]
    texts.append(texts[0][500:1900] + "!" + texts[1][2000:2040])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeated_bytes(docs, length=40, gram=16).collect()}
    assert [got[i] for i in range(4)] == [k[2] for k in kept_bytes(texts, 40)]


def test_repeated_bytes_of_no_rows(spark):
    assert suffix_dedup.remove_repeated_bytes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_interval_expansion_finds_common_prefixes():
    rng = np.random.default_rng(2)
    for _ in range(50):
        text = np.append(rng.integers(1, 4, int(rng.integers(1, 80))), 0)
        order, rank = suffix_dedup.suffix_array(text)
        plain = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert order.tolist() == plain and rank[order].tolist() == list(range(len(text)))
        for length in (1, 3, 9):
            want = [True] + [text[a:a + length].tolist() != text[b:b + length].tolist() for a, b in zip(plain, plain[1:])]
            assert suffix_dedup.separated(text, order, rank, length).tolist() == want


# --- vector codes --------------------------------------------------------------------------------------------------------

def coded(rows, parts, entries, rounds):
    """Codes, errors and codebooks by comparing every piece with every entry."""
    kept = sorted(rows)
    ints = [np.floor(256 * np.array(v, np.float64)).astype(np.int64) for _, v in kept]
    pieces = np.stack([x.reshape(parts, -1) for x in ints])
    books = pieces[:entries].transpose(1, 0, 2).copy()

    def assign():
        d = ((pieces[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2)
    for _ in range(rounds):
        near, _ = assign()
        for p in range(parts):
            for e in range(books.shape[1]):
                if len(own := pieces[near[:, p] == e, p]):
                    books[p, e] = own.sum(axis=0) // len(own)
    near, error = assign()
    return [("".join(f"{c:02x}" for c in n), int(e.sum())) for n, e in zip(near, error)], books


def test_vector_codes(spark):
    rng = np.random.default_rng(1)
    grid = rng.integers(-3, 4, (90, 8)) / 4                          # many ties and equal entries
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(grid)] + [(40, [0.25] * 8), (41, [float(x) for x in grid[41]])]
    bad = [(5000, None), (5001, [1.0] * 7 + [None]), (5002, [float("nan")] * 8), (5003, [float("inf")] * 8), (5004, []),
           (5005, [1.0] * 4), (None, [1.0] * 8)]
    labels = [None, 1, 2]
    given = [(i, v, labels[(i or 0) % 3], "c", 7) for i, v in rows + bad]
    table = spark.createDataFrame(given, "vec_id long, embedding array<float>, label int, code string, vector int").repartition(3)
    got, books = vector_codes.encode_vectors(table, parts=4, entries=16, rounds=2)
    want, plain = coded(rows, 4, 16, 2)
    assert (books.entries == plain).all()
    assert books.sha256() == hashlib.sha256(",".join(str(x) for x in plain.ravel()).encode()).hexdigest()
    have = sorted((r["vec_id"], r["code"], r["error"]) for r in got.collect())
    assert have == sorted((i, *c) for (i, _), c in zip(sorted(rows), want))
    sums = defaultdict(int)
    for (i, _), (_, e) in zip(sorted(rows), want):
        sums[labels[i % 3]] += e
    assert {(r["label"], r["label_error"]) for r in got.collect()} == set(sums.items())


def test_few_and_no_vectors(spark):
    ddl = "vec_id long, embedding array<float>, label string"
    got, books = vector_codes.encode_vectors(spark.createDataFrame([(3, [1.0, 2.0], None)], ddl), parts=2, entries=64)
    assert [tuple(r) for r in got.select("vec_id", "code", "error", "label_error").collect()] == [(3, "0000", 0, 0)]
    assert books.entries.tolist() == [[[256]], [[512]]]
    got, books = vector_codes.encode_vectors(spark.createDataFrame([], ddl))
    assert got.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError):
        vector_codes.encode_vectors(spark.createDataFrame([(3, [1.0, 2.0, 3.0], None)], ddl), parts=2)


def test_orchard_is_exact_and_looks_at_few():
    rng = np.random.default_rng(8)
    entries = np.concatenate([rng.integers(-9, 9, (40, 3)), rng.integers(-9, 9, (8, 3)).repeat(3, axis=0)])
    points = rng.integers(-12, 12, (500, 3))
    near, error = vector_codes.Orchard(entries).nearest(points)
    d = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (near == d.argmin(axis=1)).all() and (error == d.min(axis=1)).all()


# --- prefix trie ---------------------------------------------------------------------------------------------------------

def trie(rows):
    """Every node by listing all prefixes of the rebuilt conversations."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append(((turn is not None, turn or 0), name, len(text.encode()), (role, text)))
    own = {c: [x[-1] for x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children, leaves, saved = Counter(p[:-1] for p in nodes if p), Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(built[c]) == len(p)).encode()).hexdigest())
                  for p, m in nodes.items()) if nodes else []


@pytest.fixture
def talks():
    rng = np.random.default_rng(6)
    rows = []
    for c in range(60):
        for turn in range(int(rng.integers(0, 7))):
            rows.append((c, turn if rng.random() > 0.1 else None, "user" if turn % 2 else None, str(rng.integers(2)) * int(rng.integers(3))))
    long = [(70 + k, turn, "a", f"{turn}é" if turn < 60 + k else "z") for k in range(5) for turn in range(100)]
    ties = [(80, 1, "r", t) for t in ("b", "a", "a", None)] + [(81, 1, "r", "a")] * 9 + [(None, 1, "r", "x")]
    return rows + long + ties


@pytest.mark.parametrize("stretch", [512, 2])
def test_prefix_trie(spark, monkeypatch, talks, stretch):
    monkeypatch.setattr(prefix_trie, "STRETCH", stretch)
    monkeypatch.setattr(prefix_trie, "LIST_BITS", 3)
    ddl = "conv_id long, turn long, role string, text string, depth int, pos string, hi long"
    table = spark.createDataFrame([(*r, 1, "p", 2) for r in talks], ddl).repartition(5)
    got = prefix_trie.branched_trie(table).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                  "saved_tokens", "ends_sha256")
    assert sorted(tuple(r) for r in got.collect()) == trie(talks)


def test_turnless_and_no_conversations(spark):
    ddl = "conv_id long, turn long, role string, text string"
    alone = [(c, 0, "u", "hi") for c in range(6, 30) if c % 5]           # their first conversations are absent
    got = prefix_trie.branched_trie(spark.createDataFrame(alone, ddl)).drop("x")
    assert sorted(tuple(r) for r in got.collect()) == trie(alone)
    assert prefix_trie.branched_trie(spark.createDataFrame([], ddl)).count() == 0
