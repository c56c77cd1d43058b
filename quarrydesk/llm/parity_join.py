"""N-gram Jaccard join through parity sketches.

A document is its set of word shingles. Shingles are XORed into a sketch: each one flips one bit, so the
Hamming distance of two sketches is at most the size of the symmetric difference of the sets. For a size band
that difference is at most D; the sketch is cut into m > D chunks, so two linked documents agree on at least
m - D whole chunks (pigeonhole). A chunk is kept as the XOR of 64-bit codes of its set bits. Chunks are equi-joined;
what meets is compared by whole sketches, and at last by the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrydesk.llm import packed
from quarrydesk.llm.components import connected_components
from quarrydesk.llm.words import Words, fold, mix, slices, words_of
from quarrydesk.session import write_out

#: A set that may differ in D shingles sends D / SPARE signatures more than one partner needs to meet it once; in return
#: sets that share less than so many signatures with others are left out.
SPARE = 5
#: So many set ids at most are broadcast to fetch their texts; beyond that the texts are shuffled.
BROADCAST_NODES = 2_000_000
#: Sets of one chunk that are compared in one block.
BLOCK = 4096
#: Shingles gathered at a time when one set is compared with many.
GATHER = 2_000_000

_MET = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("sig", pa.int64())])
_MET_DDL = "doc_id long, n_shingles long, node long, sig long"


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All sets end to end, each sorted, and their offsets; fewer than n words are one shingle, no words none."""
    hashes = words.hashes(lower=True)
    grams, at = words.grams(hashes, n)
    text = words.text_of()
    owner = text[at] if len(at) else np.zeros(0, np.int64)
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        whole = fold(hashes, words.first)[short] ^ mix(words.counts[short].astype(np.uint64))
        grams, owner = np.concatenate([grams, whole]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    if len(grams):
        new = np.ones(len(grams), dtype=bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(words.counts) + 1))


def _bands(sizes: np.ndarray, ratio: float) -> np.ndarray:
    """Band k holds the sizes from ratio^-k up to ratio^-(k + 1): linked sets lie in one band or in neighbours."""
    return np.floor(np.log(np.maximum(sizes, 1)) / -np.log(ratio) + 1e-9).astype(np.int64)


def _chunk_signatures(grams: np.ndarray, first: np.ndarray, above: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of each set's chunks in the family of its band (``above`` 0) or the next one (1), with owners.

    A family joins sets whose larger one lies in its band. A set may differ by D from a partner, so of its filled chunks
    at most D differ, and as both ends order them alike, of its D + k lowest signatures the partner has k (see
    ``must_share``). The chunks are many enough that D + k of a set's are filled (else with a chance below 1e-12).
    The lowest bit of a signature tells a set's own family from the next one.
    """
    sizes, ratio = np.diff(first), percent / 100
    family = _bands(sizes, ratio) + above
    top = np.floor((1 / ratio) ** (family + 1) + 1e-6)
    differ = np.floor((sizes + np.minimum(sizes / ratio, top)) * (1 - ratio) / (1 + ratio) + 1e-9).astype(np.int64)
    chunks = np.where(top <= 100, 1 << 20, np.where(top <= 512, top, top / 2.5)).astype(np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    start = (family.astype(np.uint64) << np.uint64(32))[owner]
    chunk = (grams >> np.uint64(16)) % chunks[owner] + start
    order = np.lexsort((chunk, owner))
    chunk, bits, owner = chunk[order], mix(grams[order] ^ np.uint64(0x5851F42D4C957F2D)), owner[order]
    if not len(chunk):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    new = np.ones(len(chunk), dtype=bool)
    new[1:] = (chunk[1:] != chunk[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    sig, owner = mix(np.bitwise_xor.reduceat(bits, at) ^ mix(chunk[at])), owner[at]
    sig = sig >> np.uint64(1) << np.uint64(1) | (family & 1).astype(np.uint64)[owner]
    order = np.lexsort((sig, owner))
    sig, owner = sig[order], owner[order]
    rank = np.arange(len(owner)) - np.searchsorted(owner, np.arange(len(sizes)))[owner]
    keep = (rank < (differ + 1 + differ // SPARE)[owner]) & (differ[owner] > 0)
    return sig[keep], owner[keep]


def _sketcher(n: int, percent: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sigs, nodes, docs = [], [], []
        for batch in batches:
            for piece in slices(batch):
                grams, first = shingle_sets(words_of(piece.column(1)), n)
                node = fold(grams, first).view(np.int64)
                docs.append(np.stack([piece.column(0).to_numpy(zero_copy_only=False), node, np.diff(first)]))
                for above in (0, 1):
                    sig, owner = _chunk_signatures(grams, first, above, percent)
                    sigs.append(sig)
                    nodes.append(node[owner])
                if sum(map(len, sigs)) >= packed.FLUSH:
                    yield packed.pack(parts, np.concatenate(sigs), np.concatenate(nodes), np.concatenate(docs, axis=1))
                    for x in held:
                        x.clear()
        if docs:
            yield packed.pack(parts, np.concatenate(sigs), np.concatenate(nodes), np.concatenate(docs, axis=1))
    return run


def _meet(table: pa.Table) -> pa.Table:
    """The documents that came along, and each chunk signature that several sets have, with these."""
    sigs, nodes, hot, docs = packed.unpack(table, 3)
    at = packed.run_starts(sigs)
    runs = np.diff(np.append(at, len(sigs)))
    many = np.repeat(runs > 1, runs)
    # a set whose chunk mates all went past this join is still one of the chunk's sets
    met = np.concatenate([np.stack([nodes, sigs.view(np.int64)])[:, many], hot[[1, 0]], np.unique(hot[[2, 0]], axis=1)], axis=1)
    docs = [*map(pa.array, docs[[0, 2, 1]]), pa.nulls(docs.shape[1], pa.int64())]
    met = [*[pa.nulls(met.shape[1], pa.int64())] * 2, *map(pa.array, met)]
    return pa.concat_tables([pa.Table.from_arrays(x, schema=_MET) for x in (docs, met)])


def must_share(size: Column, percent: int) -> Column:
    """Signatures of one family that a set of this size shares with a partner, whose size is smaller by the ratio at most."""
    ratio = percent / 100
    return 1 + F.floor(F.floor(2 * ratio * size * ((1 - ratio) / (1 + ratio)) - 1e-9) / SPARE)


_SETS = pa.schema([("node", pa.int64()), ("grams", pa.binary()), ("sketch", pa.binary())])


def _sketch_bits(size: int) -> int:
    return max(256, 1 << int(np.ceil(np.log2(max(2 * size, 1)))))


def parity_sketch(grams: np.ndarray) -> np.ndarray:
    """Each shingle flips one bit of two to four bits a shingle, at least 256, packed in bytes."""
    bits = _sketch_bits(len(grams))
    flips = np.bincount((mix(grams) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8))


def fold_sketch(sketch: np.ndarray, length: int) -> np.ndarray:
    """A sketch over fewer bytes: bits whose places agree modulo the new length cancel, so the bound still holds."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, length), axis=0)


def _set_maker(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                grams, first = shingle_sets(words_of(piece.column(1)), n)
                own = [grams[a:b] for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fold(grams, first).view(np.int64)), pa.array([x.tobytes() for x in own], pa.binary()),
                     pa.array([parity_sketch(x).tobytes() for x in own], pa.binary())], schema=_SETS).filter(
                         pc.equal(piece.column(0), pa.array(fold(grams, first).view(np.int64))))
    return run


def _verifier(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(linked, pa.bool_()))
    return run


def _near(sketches, a: np.ndarray, b: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may be linked by their sketches: Hamming distance and sizes as a bound on the common part."""
    out = np.zeros(len(a), dtype=bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        low = min(len(sketches[x]), len(sketches[y]))
        apart = int(np.bitwise_count(fold_sketch(sketches[x], low) ^ fold_sketch(sketches[y], low)).sum())
        out[k] = apart * (100 + percent) <= total[k] * (100 - percent)
    return out


def _sketch_filter(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            both = [np.frombuffer(x.as_buffer(), np.uint8) for c in (2, 3) for x in batch.column(c)]
            near = _near(both, np.arange(n), np.arange(n) + n, batch.column(4).to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near))
    return run


_UNIT_COLUMNS = ("component", "node", "side", "unit", "split")


def _units(table: pa.Table) -> tuple[Iterator[np.ndarray], list[np.ndarray]]:
    """The rows of each different unit of a task, and its columns; units of one kind that hold the same sets count once."""
    columns = [table.column(c).to_numpy() for c in _UNIT_COLUMNS]
    _, node, side, unit, split = columns

    def each() -> Iterator[np.ndarray]:
        seen = set()
        order = np.lexsort((node, unit))
        for rows in np.split(order, np.flatnonzero(np.diff(unit[order])) + 1) if len(order) else []:
            if (same := (node[rows].tobytes(), side[rows].tobytes(), split[rows].tobytes())) not in seen:
                seen.add(same)
                yield rows
    return each(), columns


def _partners(k: int, rows: np.ndarray, side: np.ndarray, split: np.ndarray) -> np.ndarray:
    """Which rows of a unit row k is compared with: those after it, or the other block's."""
    if not split[rows[k]]:
        return np.arange(k + 1, len(rows))
    return np.flatnonzero(side[rows] == 1) if side[rows[k]] == 0 else np.zeros(0, np.int64)


def _find_near(percent: int):
    """Sets of a task that have a partner in another component whose sketch is close enough."""
    def run(table: pa.Table, drawn: pa.Table) -> pa.Table:
        units, (comp, node, side, _, split) = _units(table)
        place = {x: k for k, x in enumerate(drawn.column("node").to_pylist())}
        sizes = drawn.column("size").to_numpy()
        sketches = [np.frombuffer(x.as_buffer(), np.uint8) for x in drawn.column("sketch")]
        found = set()
        for rows in units:
            at = [place[x] for x in node[rows].tolist()]
            low, size, hit = min(len(sketches[k]) for k in at), sizes[at], np.zeros(len(at), dtype=bool)
            bits = np.stack([fold_sketch(sketches[k], low) for k in at]).view(np.uint64)
            for k, r in enumerate(rows):
                later = _partners(k, rows, side, split)
                later = later[comp[rows[later]] != comp[r]]
                apart = np.bitwise_count(bits[later] ^ bits[k]).sum(axis=1, dtype=np.int64)
                near = later[apart * (100 + percent) <= (size[later] + size[k]) * (100 - percent)]
                hit[near] = True
                hit[k] |= len(near) > 0
            found.update(node[rows[hit]].tolist())
        part = table.column("part")[0] if table.num_rows else 0
        return pa.table({"part": pa.array([part] * len(found), pa.int64()), "node": pa.array(sorted(found), pa.int64())})
    return run


def _count_marked(marked: np.ndarray, ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many of ids[start:start + size] are marked, for each start; all sizes are above 0."""
    begin = np.cumsum(size) - size
    if not len(size):
        return begin
    return np.add.reduceat(marked[ids[np.arange(size.sum()) + np.repeat(start - begin, size)]].astype(np.int64), begin)


def _link_blocks(percent: int):
    """Links between sets of a task, by the sets themselves: enough to join all that are linked, no more."""
    def run(table: pa.Table, held: pa.Table) -> pa.Table:
        units, (comp, node, side, _, split) = _units(table)
        place = {x: k for k, x in enumerate(held.column("node").to_pylist())}
        grams = [np.frombuffer(x.as_buffer(), np.uint64) for x in held.column("grams")]
        first = np.append(0, np.cumsum([len(x) for x in grams]))
        names, ids = np.unique(np.concatenate(grams) if grams else np.zeros(0, np.uint64), return_inverse=True)
        marked, links = np.zeros(len(names), dtype=bool), []
        for rows in units:
            at = np.array([place[x] for x in node[rows].tolist()])
            size, label = first[at + 1] - first[at], comp[rows].copy()
            for k in range(len(rows)):
                later = _partners(k, rows, side, split)
                # a set may only be linked to one whose size differs by the ratio at most
                later = later[(label[later] != label[k]) & (100 * np.minimum(size[later], size[k]) >= percent * np.maximum(
                    size[later], size[k]))]
                if not len(later):
                    continue
                mine = ids[first[at[k]]:first[at[k] + 1]]
                marked[mine] = True
                common = [_count_marked(marked, ids, first[at[x]], size[x]) for x in np.array_split(
                    later, 1 + size[later].sum() // GATHER)]
                common, marked[mine] = np.concatenate(common), False
                for j in later[100 * common >= percent * (size[later] + size[k] - common)]:
                    if label[j] != label[k]:
                        links.append((node[rows[k]], node[rows[j]]))
                        label[label == label[j]] = label[k]
        pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    own = sets.select("node", "grams")
    both = pairs.join(own.toDF("a", "left_grams"), "a").join(own.toDF("b", "right_grams"), "b").select(
        "a", "b", "left_grams", "right_grams")
    return both.mapInArrow(_verifier(percent), "a long, b long")


def near_duplicate_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
                              text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: components of documents whose shingle sets have Jaccard >= percent / 100.

    Words are lower-cased (A-Z). Equal sets are one node, so copies never meet as pairs. Every set meets the
    first set of most of its shared chunks; what that does not join is compared chunk by chunk, in blocks.
    Null, empty or blank texts have no shingles and stay alone. Rows with a null id are left out; repeated ids
    give repeated rows, and one id with several texts links them as those texts do. An empty table gives none.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(
        "doc_id IS NOT NULL")
    sent = source.mapInArrow(_sketcher(n, percent, parts), packed.DDL)
    met = write_out(sent.groupBy("part").applyInArrow(_meet, _MET_DDL), "met")
    members = met.where("doc_id IS NOT NULL").select("doc_id", "n_shingles", "node")
    nodes = members.where("n_shingles > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_doc"), F.max("n_shingles").alias("size"))

    # sets that share too few signatures of a family with others have no partner; a set may come with two pivots
    shared = met.where("sig IS NOT NULL").select("sig", "node").withColumn("parity", F.col("sig").bitwiseAND(F.lit(1)))
    rich = shared.groupBy("node", "parity").agg(F.count_distinct("sig").alias("together")).join(nodes, "node").where(
        F.col("together") >= must_share(F.col("size"), percent)).select("node", "parity")
    shared = shared.join(rich, ["node", "parity"]).select("sig", "node").distinct()
    pivots = shared.groupBy("sig").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    shared = write_out(shared.join(pivots, "sig"), "shared")

    wanted = write_out(shared.select("node").distinct().join(nodes, "node"), "wanted")
    picked = wanted.select(F.col("first_doc").alias("doc_id"), "node")
    if wanted.count() <= BROADCAST_NODES:
        picked = F.broadcast(picked)
    texts = source.join(picked, "doc_id").select("node", "text")
    sets = write_out(texts.mapInArrow(_set_maker(n), "node long, grams binary, sketch binary"), "sets")
    drawn = sets.select("node", "sketch").join(wanted.select("node", "size"), "node")

    by_pivot = shared.where("node <> pivot").groupBy("node", "pivot").agg(F.count("*").alias("together"))
    best = by_pivot.groupBy("node").agg(F.max(F.struct("together", "pivot")).alias("best")).select(
        F.col("best.pivot").alias("a"), F.col("node").alias("b"))
    sided = best.join(drawn.toDF("a", "left_sketch", "left_size"), "a").join(drawn.toDF("b", "right_sketch", "right_size"), "b")
    likely = sided.select("a", "b", "left_sketch", "right_sketch", (F.col("left_size") + F.col("right_size")).alias("total"))
    likely = likely.mapInArrow(_sketch_filter(percent), "a long, b long")
    first_links = write_out(_verify(likely, sets, percent), "links")
    grouped = connected_components(first_links)

    labelled = shared.join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_sigs = labelled.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low <> high").select("sig")
    blocks = F.ceil(F.col("n") / BLOCK)
    units = labelled.join(open_sigs, "sig").withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("node"), blocks))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    # chunks with one first set go to one task, as they are likely to hold the same sets
    units = units.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.pmod(F.xxhash64("pivot", low, high), F.lit(8 * parts)).alias("part"), F.xxhash64("sig", low, high).alias("unit"),
        (low != high).alias("split"), (F.col("mine") > F.col("other")).cast("int").alias("side"), "node", "component")
    units = write_out(units, "units")
    needed = units.select(F.col("part").alias("to"), F.col("node").alias("node")).distinct().join(drawn, "node")
    near = write_out(units.groupBy("part").cogroup(needed.groupBy("to")).applyInArrow(
        _find_near(percent), "part long, node long"), "near")
    held = near.select(F.col("part").alias("to"), F.col("node").alias("node")).join(sets.select("node", "grams"), "node")
    more_links = write_out(units.join(near, ["part", "node"]).groupBy("part").cogroup(held.groupBy("to")).applyInArrow(
        _link_blocks(percent), "a long, b long").distinct(), "links")
    comps = connected_components(first_links.unionByName(more_links))

    named = members.where("n_shingles > 0").join(comps, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    linked = named.join(least, "component").select("doc_id", "n_shingles", "component_id")
    alone = members.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
