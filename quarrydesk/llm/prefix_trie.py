"""The trie of conversation prefixes by ROLLUP over positional turn-id columns.

A row holds one block of ``WIDTH`` turns of a conversation as columns ``t1 .. tN``; ROLLUP over them with
``grouping_id`` aggregates all prefixes of the block at once. The next block of a longer conversation is a further row,
keyed by the node in which the block before it ended, so all blocks of all lengths go through the same ROLLUP.
A node is named by the exclusive or of 128-bit hashes of (depth, turn) along its path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrydesk.session import write_out

#: Turns of a block.
WIDTH = 8
#: Running values along a conversation are taken within so many blocks, then over the sums of those.
STRETCH = 512
#: Ids of ended conversations are listed in ranges of 2 ** LIST_BITS ids.
LIST_BITS = 12

_SLOTS = range(1, WIDTH + 1)
_KEYS = {"hi": 7, "lo": 11}


def turn_id(role: Column, text: Column) -> Column:
    """MD5 of role and text, then the bytes of the text: 20 bytes that name a turn and order equal turn numbers."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    size = F.octet_length(text)
    name = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return F.unhex(F.concat(name, F.lpad(F.hex(size), 8, "0")))


def turn_bytes(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("long")


def positions(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, turn_id`` with pos from 1, and ``conv_id, n``.

    Rows are dealt by ranges of (conversation, turn), so that a conversation of any length spreads over tasks; a range
    numbers its rows, and the counts of the ranges before it are added. A conversation has a row for each range at most.
    """
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_id")]
    dealt = turns.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = write_out(dealt.select("conv_id", "turn_id", F.monotonically_increasing_id().alias("at")), "turns")
    dealt = dealt.withColumn("range", F.shiftright("at", 33))
    ranges = dealt.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = dealt.join(ranges, ["conv_id", "range"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "turn_id")
    return placed, ranges.groupBy("conv_id").agg(F.sum("n").alias("n"))


def branch(turns: DataFrame, sizes: DataFrame, every: int = 5, longest: int = 9) -> DataFrame:
    """Each conversation c anew: the first h turns of c - c % every, then its own turns after its first h.

    h is crc32 of the decimal id modulo ``longest``; a shorter or absent first conversation gives what it has.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    own = sizes.select("conv_id", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("root_id"))
    short = own.join(sizes.select(F.col("conv_id").alias("root_id"), F.col("n").alias("root_n")), "root_id", "left")
    short = short.select("conv_id", "h", (F.least("h", F.coalesce("root_n", F.lit(0))) - F.col("h")).alias("shift"))
    tail = turns.where(F.col("pos") > head).join(short.select("conv_id", "shift"), "conv_id").select(
        "conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "turn_id")
    heads = turns.where((F.col("pos") < longest) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "root_id")
    return heads.join(own, "root_id").where("pos <= h").select("conv_id", "pos", "turn_id").union(tail)


def _blocks(turns: DataFrame) -> DataFrame:
    """``conv_id, block, t1..tN`` and the node that the block starts from (``hi``, ``lo``) and ends in (``to_*``)."""
    slot = (F.col("pos") - 1) % WIDTH + 1
    keyed = turns.select("conv_id", F.floor((F.col("pos") - 1) / WIDTH).alias("block"), slot.alias("slot"), "turn_id",
                         *[_step(seed, F.col("pos"), F.col("turn_id")).alias(k) for k, seed in _KEYS.items()])
    rows = keyed.groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("turn_id"))).alias(f"t{i}") for i in _SLOTS],
        *[F.bit_xor(k).alias(f"_{k}") for k in _KEYS])
    rows = _running(rows, {k: (F.bit_xor, f"_{k}") for k in _KEYS}, forward=True)
    return rows.select("conv_id", "block", *[f"t{i}" for i in _SLOTS], *_KEYS,
                       *[F.col(k).bitwiseXOR(F.col(f"_{k}")).alias(f"to_{k}") for k in _KEYS])


def _step(seed: int, pos: Column, turn: Column) -> Column:
    return F.xxhash64(F.lit(seed), pos.cast("long"), turn)


def _running(rows: DataFrame, values: dict, forward: bool) -> DataFrame:
    """Adds, for each name, the aggregate of a column over the blocks before (or after) a row's block; 0 without any.

    ``values``: name -> (aggregate, column). Long conversations are cut into stretches, so no window holds more than
    ``STRETCH`` blocks or one row a stretch.
    """
    rows = rows.withColumn("stretch", F.floor(F.col("block") / STRETCH))
    way = (lambda c: F.col(c).asc()) if forward else (lambda c: F.col(c).desc())
    near = Window.partitionBy("conv_id", "stretch").orderBy(way("block")).rowsBetween(Window.unboundedPreceding, -1)
    far = Window.partitionBy("conv_id").orderBy(way("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv_id", "stretch").agg(*[agg(c).alias(f"all_{n}") for n, (agg, c) in values.items()])
    sums = sums.select("conv_id", "stretch", *[F.coalesce(agg(f"all_{n}").over(far), F.lit(0)).alias(f"far_{n}")
                                               for n, (agg, _) in values.items()])
    rows = rows.select("*", *[F.coalesce(agg(c).over(near), F.lit(0)).alias(f"near_{n}") for n, (agg, c) in values.items()])
    joined = rows.join(sums, ["conv_id", "stretch"])
    for n, (agg, _) in values.items():
        a, b = F.col(f"near_{n}"), F.col(f"far_{n}")
        joined = joined.withColumn(n, a.bitwiseXOR(b) if agg is F.bit_xor else a + b)
    return joined.drop("stretch", *[f"{side}_{n}" for n in values for side in ("near", "far")])


def _rolled(blocks: DataFrame, sums: list[str]) -> DataFrame:
    """A row for each node but those that end a block before: keys of the node and its parent, depth, the last turn's
    bytes, members, least member, and the sums of columns over the members; ``level`` is the depth in the block."""
    names = ", ".join(f"t{i}" for i in _SLOTS)
    adds = "".join(f", sum({c}) AS {c}" for c in sums)
    # the key columns are in every grouping set, so grouping_id has bits for rolled-up turns only
    rolled = blocks.sparkSession.sql(
        f"SELECT block, hi, lo, {names}, grouping_id() AS mask, min(conv_id) AS conv_id, count(*) AS n_convs{adds} "
        f"FROM {{blocks}} GROUP BY block, hi, lo, ROLLUP({names})", blocks=blocks)
    level = F.lit(WIDTH) - F.bit_count("mask")
    rolled = rolled.withColumn("level", level).withColumn(
        "turn_id", F.get(F.array(*[f"t{i}" for i in _SLOTS]), F.col("level") - 1)).where(
        "turn_id IS NOT NULL OR (level = 0 AND block = 0)")
    depth = F.col("block") * WIDTH + F.col("level")
    keys = []
    for k, seed in _KEYS.items():
        own = up = F.col(k)
        for i in _SLOTS:
            step = _step(seed, F.col("block") * WIDTH + i, F.col(f"t{i}"))
            own = own.bitwiseXOR(F.when(F.col("level") >= i, step).otherwise(F.lit(0).cast("long")))
            up = up.bitwiseXOR(F.when(F.col("level") > i, step).otherwise(F.lit(0).cast("long")))
        keys += [own.alias(f"own_{k}"), F.when(depth > 0, up).alias(f"up_{k}")]
    return rolled.select(*keys, depth.alias("depth"), "level", F.coalesce(turn_bytes(F.col("turn_id")), F.lit(0)).alias("bytes"),
                         "conv_id", "n_convs", *sums)


def _ends(blocks: DataFrame) -> DataFrame:
    """``own_hi, own_lo, ends_sha256``: ids of the conversations that end in a node, in order, hashed as a stream.

    Ids come in lists of bounded ranges; a task holds one list at a time, however many conversations end in a node.
    """
    last = blocks.groupBy("conv_id").agg(F.max_by(F.struct("to_hi", "to_lo"), "block").alias("node"))
    listed = last.groupBy(F.col("node.to_hi").alias("hi"), F.col("node.to_lo").alias("lo"),
                          F.shiftright("conv_id", LIST_BITS).alias("range")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    dealt = listed.repartition(F.col("hi"), F.col("lo")).sortWithinPartitions("hi", "lo", "range").select("hi", "lo", "ids")
    return dealt.mapInArrow(_hashed, "own_hi long, own_lo long, ends_sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("own_hi", pa.int64()), ("own_lo", pa.int64()), ("ends_sha256", pa.string())])
    key, digest = None, hashlib.sha256()
    for batch in batches:
        done = []
        for *now, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if now != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], schema=schema)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, digest.hexdigest())], schema=schema)


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """A row for each distinct sequence of first turns: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    ``turns``: ``conv_id, pos, turn_id``, positions 1, 2, ... without gaps; ``members``: the ids, those without turns
    included. A node's ``conv_id`` is its least member. What a node adds to its ancestors (its saved bytes, being a leaf)
    is booked to the path of its least member, so a second ROLLUP sums whole subtrees of any depth. No member gives no row.
    """
    blocks = _blocks(turns)
    bare = members.select("conv_id").join(turns.select("conv_id").distinct(), "conv_id", "left_anti")
    zero = F.lit(0).cast("long")
    bare = bare.select("conv_id", zero.alias("block"), *[F.lit(None).cast("binary").alias(f"t{i}") for i in _SLOTS],
                       *[zero.alias(f"{side}{k}") for side in ("", "to_") for k in _KEYS])
    blocks = write_out(blocks.unionByName(bare), "blocks")
    nodes = write_out(_rolled(blocks, []), "nodes")
    children = nodes.where("depth > 0").groupBy("up_hi", "up_lo").agg(F.count("*").alias("n_children"))
    on_node = (F.col("own_hi") == F.col("c.up_hi")) & (F.col("own_lo") == F.col("c.up_lo"))
    nodes = nodes.join(children.alias("c"), on_node, "left").drop(F.col("c.up_hi"), F.col("c.up_lo")).fillna(0, ["n_children"])
    nodes = write_out(nodes, "nodes")

    saved = ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")
    booked = nodes.where("depth > 0").select("conv_id", F.floor((F.col("depth") - 1) / WIDTH).alias("block"),
                                             ((F.col("depth") - 1) % WIDTH + 1).alias("slot"), saved).where("saved > 0")
    booked = booked.groupBy("conv_id", "block").agg(
        *[F.coalesce(F.sum(F.when(F.col("slot") == i, F.col("saved"))), F.lit(0)).alias(f"v{i}") for i in _SLOTS])
    leaves = nodes.where("n_children = 0").select("conv_id", F.lit(1).alias("n_leaves"))
    paid = blocks.join(booked, ["conv_id", "block"], "left").join(leaves, "conv_id", "left").fillna(
        0, ["n_leaves", *[f"v{i}" for i in _SLOTS]])
    paid = _running(paid.withColumn("v_all", sum((F.col(f"v{i}") for i in _SLOTS), F.lit(0))), {"after": (F.sum, "v_all")},
                    forward=False)
    due = F.col("after")
    for i in reversed(_SLOTS):
        due = due + F.col(f"v{i}")
        paid = paid.withColumn(f"w{i}", due)
    weights = [f"w{i}" for i in _SLOTS]
    whole = _rolled(paid.select("conv_id", "block", "hi", "lo", *[f"t{i}" for i in _SLOTS], *weights, "n_leaves"),
                    [*weights, "n_leaves"])
    whole = whole.select("conv_id", "depth", "n_leaves", F.get(F.array(*weights), F.greatest(F.col("level") - 1, F.lit(0))).alias("saved_tokens"))

    above = nodes.select(F.col("own_hi").alias("up_hi"), F.col("own_lo").alias("up_lo"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return nodes.join(above, ["up_hi", "up_lo"], "left").join(whole, ["conv_id", "depth"]).join(
        _ends(blocks), ["own_hi", "own_lo"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def branched_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``prefix_trie`` of the conversations as ``branch`` rebuilds them.

    Turns are ordered by number, null first; equal numbers, repeated rows included, by ``turn_id``. Null roles and texts are
    empty. Rows with a null id are left out; columns beyond the four named are not read. An empty table gives no row.
    """
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                turn_id(F.col(role_col), F.col(text_col)).alias("turn_id")).where("conv_id IS NOT NULL")
    placed, sizes = positions(rows)
    placed, sizes = write_out(placed, "placed"), write_out(sizes, "sizes")
    return prefix_trie(write_out(branch(placed, sizes), "branched"), sizes.select("conv_id"))
