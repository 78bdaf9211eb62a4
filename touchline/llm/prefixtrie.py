"""Conversation prefix trie: one row per distinct beginning of conversations, with its totals.

A conversation is a sequence of turn codes; a code is a digest of role and text and the text's
length in bytes. Equal conversations are put together first, whatever their number. Distinct
sequences are dealt to shards by ranges of their order, so that each shard holds what begins alike
and none grows with a popular beginning. A shard packs a double-array trie over dense numbers of
its turns and walks it. Only the beginnings of a shard's first and last sequence can lie in another
shard too: these upper nodes leave the shard as parts, which are merged by their key. Sums over
subtrees of upper nodes are carried along the first and last sequences: each upper node counts
for one sequence that holds it, and a node gets from each sequence what follows on it.

The ranges go by the first ``head`` turns, so that what the driver samples for them is bounded;
sequences that only differ later are dealt by hash, and their nodes count as upper ones where a
range ends among them.

Defined results: rows without conversation id are left out; a NULL role or text counts as empty;
turns without number come first, turns of one number are ordered by role, then by text; equal rows
are turns each; other columns are not carried. Without conversations there is no node; a
conversation without turns is a member of the root alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.doublearray import DoubleArray, number_turns
from touchline.sources.workspace import pinned

#: Bytes of a turn's code: 16 of a digest, 8 of the length of its text.
CODE = 24
NO_ENDS = hashlib.sha256(b"").hexdigest()

PATHS = "path binary, path_key string, n long, first long, ends_sha256 string"
#: ``parent`` is the parent's smallest member where the shard knows it, otherwise ``parent_key`` is set.
#: Rows with a ``node_key`` are parts of upper nodes, one per sequence and depth.
SHARD = (
    "shard int, depth long, first long, parent long, parent_key string, n long, children long, leaves long, saved long, "
    "ends_sha256 string, node_key string, path_key string, size long, passes boolean"
)


def turn_code(role: Column, text: Column) -> Column:
    """Tells apart all roles and texts; the length of the text can be read from it."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.octet_length(role), role, text), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))


def ordered_codes(turns: DataFrame) -> DataFrame:
    """``conv_id, codes``: the turn codes of every conversation in order."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), turn_code(F.col("role"), F.col("text")).alias("code"))
    return (
        turns.filter(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
        .groupBy("conv_id")
        .agg(F.transform(F.sort_array(F.collect_list("turn")), lambda t: t["code"]).alias("codes"))
    )


def path_of(codes: Column) -> Column:
    """The codes as one binary value, whose order puts equal beginnings side by side."""
    return F.unhex(F.array_join(F.transform(codes, F.hex), ""))


def distinct_paths(sequences: DataFrame, block_bits: int = 12) -> DataFrame:
    """One row per distinct ``path`` of ``sequences(conv_id, path)``: how many conversations have it,
    the smallest, and the digest of all their ids. Ids meet in blocks of ascending ranges, so the
    members of a popular path are never held at once."""
    block = F.shiftright("conv_id", block_bits).alias("block")
    pieces = sequences.groupBy("path", block).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, n, first, digest = None, 0, None, None
        for batch in batches:
            done = []
            for found, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
                if found != path:
                    if path is not None:
                        done.append((path, hashlib.sha256(path).hexdigest(), n, first, digest.hexdigest()))
                    path, n, first, digest = found, 0, ids[0], hashlib.sha256()
                digest.update(("," * (n > 0) + ",".join(map(str, ids))).encode())
                n += len(ids)
            if done:
                yield _batch(done, PATHS)
        if path is not None:
            yield _batch([(path, hashlib.sha256(path).hexdigest(), n, first, digest.hexdigest())], PATHS)

    return pieces.repartition("path").sortWithinPartitions("path", "block").mapInArrow(run, PATHS)


ARROW = {"binary": pa.binary(), "string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[kind]) for c, (_, kind) in zip(zip(*rows), fields)], [name for name, _ in fields])


def _prefix_keys(path: bytes) -> list[str]:
    """The key of every beginning, the empty one and the whole included."""
    digest = hashlib.sha256()
    keys = [digest.hexdigest()]
    for at in range(0, len(path), CODE):
        digest.update(path[at : at + CODE])
        keys.append(digest.copy().hexdigest())
    return keys


def shard_rows(shard: int, paths: list[bytes], keys: list[str], n: np.ndarray, first: np.ndarray, ends: list[str], head: int) -> Iterator[tuple]:
    """Rows of ``SHARD`` for the distinct paths of one shard."""
    lengths = np.array([len(p) // CODE for p in paths], dtype=np.int64)
    joined = b"".join(paths)
    turns = np.frombuffer(joined, dtype=f"S{CODE}")
    labels, _ = number_turns(turns, lengths)
    trie = DoubleArray(labels, lengths)
    reached = trie.walk()
    slots, root = len(trie.check), trie.root
    convs, smallest = np.zeros(slots, dtype=np.int64), np.full(slots, np.iinfo(np.int64).max)
    per_turn = np.repeat(np.arange(len(paths)), lengths)
    np.add.at(convs, reached, n[per_turn])
    np.minimum.at(smallest, reached, first[per_turn])
    convs[root], smallest[root] = n.sum(), first.min()
    depth, size = np.zeros(slots, dtype=np.int64), np.zeros(slots, dtype=np.int64)
    depth[reached] = np.arange(len(labels)) - trie.starts[per_turn] + 1
    size[reached] = np.frombuffer(joined, dtype=">u8").reshape(-1, 3)[:, 2]
    last = np.where(lengths > 0, reached[np.maximum(trie.starts + lengths - 1, 0)] if len(reached) else root, root)
    ends_of = dict(zip(last.tolist(), ends))

    heads = [p[: head * CODE] for p in paths]
    shared = {min(heads), max(heads)}
    outer = [i for i, h in enumerate(heads) if h in shared]
    upper = np.zeros(slots, dtype=bool)
    upper[root] = True
    for i in outer:
        upper[reached[trie.starts[i] : trie.starts[i] + lengths[i]]] = True

    children, leaves = np.zeros(slots, dtype=np.int64), np.zeros(slots, dtype=np.int64)
    saved = np.where(upper, 0, (convs - 1) * size)
    used = np.flatnonzero((trie.check != -1) & ~upper)
    np.add.at(children, trie.check[used], 1)
    leaves[used] = children[used] == 0
    used = used[np.argsort(depth[used], kind="stable")]
    edges = np.searchsorted(depth[used], np.arange(1, depth[used].max(initial=0) + 2))
    for a, b in zip(edges[-2::-1].tolist(), edges[:0:-1].tolist()):
        level = used[a:b]
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])

    key_of = {}
    for i in outer:
        for k, (key, slot) in enumerate(zip(_prefix_keys(paths[i]), [root, *reached[trie.starts[i] : trie.starts[i] + lengths[i]].tolist()])):
            seen = slot in key_of
            key_of[slot] = key
            parts = (0, 0, 0, 0) if seen else (int(convs[slot]), int(children[slot]), int(leaves[slot]), int(saved[slot]))
            parent_key = key_of[int(trie.check[slot])] if k else None
            passes = k < int(lengths[i])
            yield (shard, k, int(smallest[slot]), None, parent_key, *parts, ends_of.get(slot), key, keys[i], int(size[slot]), passes)
    columns = [a[used].tolist() for a in (depth, smallest, trie.check, convs, children, leaves, saved)]
    for slot, d, f, up, c, ch, lv, sv in zip(used.tolist(), *columns):
        known = not upper[up]
        yield (shard, d, f, int(smallest[up]) if known else None, None if known else key_of[up], c, ch, lv, sv, ends_of.get(slot), None, None, None, None)


def pack_shards(paths: DataFrame, shards: int, head: int) -> DataFrame:
    """The nodes of every shard, as rows of ``SHARD``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        n, first = (table.column(c).to_numpy() for c in ("n", "first"))
        values = [table.column(c).to_pylist() for c in ("path", "path_key", "ends_sha256")]
        rows = []
        for row in shard_rows(TaskContext.get().partitionId(), *values[:2], n, first, values[2], head):
            rows.append(row)
            if len(rows) == 1 << 14:
                yield _batch(rows, SHARD)
                rows = []
        if rows:
            yield _batch(rows, SHARD)

    dealt = paths.repartitionByRange(shards, F.substring("path", 1, head * CODE), F.xxhash64("path"))
    return dealt.mapInArrow(run, SHARD)


def _upper_nodes(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Upper nodes from their parts, and ``shard, parent_key, parent`` to look them up by."""
    merged = pinned(
        parts.groupBy("node_key").agg(
            F.min("depth").alias("depth"), F.min("first").alias("first"), F.max("parent_key").alias("parent_key"), F.sum("n").alias("n"),
            F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
            F.max("ends_sha256").alias("ends_sha256"), F.max("size").alias("size"), F.max("passes").alias("passes"), F.min("path_key").alias("owner"),
        ),
        "upper",
    )
    own = merged.select(
        "node_key",
        "owner",
        (F.col("leaves") + (~F.col("passes") & (F.col("children") == 0)).cast("long")).alias("own_leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("own_saved"),
    )
    along = parts.select("node_key", "path_key", "depth").join(own, "node_key").withColumn("owns", F.col("owner") == F.col("path_key"))
    below = Window.partitionBy("path_key").orderBy(F.desc("depth"))
    carried = along.select(
        "node_key",
        F.sum(F.when(F.col("owns"), F.col("own_leaves")).otherwise(0)).over(below).alias("leaves"),
        F.sum(F.when(F.col("owns"), F.col("own_saved")).otherwise(0)).over(below).alias("saved"),
        F.coalesce(F.lag("owns").over(below).cast("long"), F.lit(0)).alias("more"),
    )
    totals = carried.groupBy("node_key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.sum("more").alias("more"))
    parents = merged.select(F.col("node_key").alias("parent_key"), F.col("first").alias("parent"))
    nodes = (
        merged.drop("leaves", "saved")
        .join(totals, "node_key")
        .join(parents, "parent_key", "left")
        .withColumn("children", F.col("children") + F.col("more"))
    )
    places = parts.select("shard", "node_key").distinct()
    return nodes, places.join(merged.select("node_key", F.col("first").alias("parent")), "node_key").withColumnRenamed("node_key", "parent_key")


def prefix_trie(sequences: DataFrame, shard_turns: int = 20_000, head: int = 32) -> DataFrame:
    """One row per node of ``sequences(conv_id, path)``: ``conv_id``, the smallest member, ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, and ``n_leaves`` and ``saved_tokens`` over its
    subtree; ``ends_sha256`` is the digest of the ids of the conversations that end there.

    A shard holds about ``shard_turns`` turns of distinct sequences."""
    spark = sequences.sparkSession
    paths = pinned(distinct_paths(sequences), "paths")
    turns = paths.agg(F.sum(F.octet_length("path"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), turns // CODE // shard_turns + 1)
    rows = pinned(pack_shards(paths, shards, head), "shards")
    upper, places = _upper_nodes(rows.filter(F.col("node_key").isNotNull()))
    inner = rows.filter(F.col("node_key").isNull())
    names = ["first", "depth", "parent", "n", "children", "leaves", "saved", "ends_sha256"]
    below_upper = inner.filter(F.col("parent_key").isNotNull()).drop("parent").join(places, ["shard", "parent_key"])
    every = inner.filter(F.col("parent_key").isNull()).select(*names).unionByName(below_upper.select(*names)).unionByName(upper.select(*names))
    return every.select(
        F.col("first").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
