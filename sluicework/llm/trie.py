"""The prefix trie of conversations, with totals over every subtree.

A node is a distinct sequence of first turns.  Conversations are put in order by
one range shuffle, however long one of them is: a conversation that crosses from
one partition to the next gets its places and prefixes from a table with at most
two rows per partition.  A prefix is told by its length and the XOR of two 64-bit
hashes of (place, role, text) over its turns, 128 bits in all; a node's identity
after that is exact: its smallest member and its depth.  Totals come from parallel
tree contraction (see contraction.py).

Defined results: null roles and texts are empty; turns go by number, null first,
then role, then text; repeated rows are repeated turns; rows without a
conversation id take no part; an id's remainder has the id's sign; other columns
are ignored; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.common import SPACE_CLASS, crc32_mod
from sluicework.llm.contraction import subtree_sums
from sluicework.session import ship_package, through_storage

WORD = rf"[^{SPACE_CLASS}]+"
# Conversation ids joined to one row on the way to a digest.
CHUNK_IDS = 10_000
LANES = ("lane1", "lane2")


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column, with how many of the same key came before in this partition."""
    last, count = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy()
        new = np.concatenate([[last is None or keys[0] != last], keys[1:] != keys[:-1]])
        starts = np.where(new, np.arange(len(keys)), 0)
        nth = np.arange(len(keys)) - np.maximum.accumulate(starts)
        still = np.cumsum(new) == 0
        nth[still] += count
        last, count = keys[-1], int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], [*batch.schema.names, "nth"])


def before_in_parts(rows: DataFrame, *sums: Column) -> tuple[DataFrame, list[str]]:
    """(conv_id, part, *sums) of the conversations that cross partitions, and the names of the sums.

    Such a conversation is the first one of some partition, so there are as many as partitions at most, and
    twice as many rows.
    """
    first = rows.groupBy("part").agg(F.min("conv_id").alias("conv_id")).select("conv_id").distinct()
    names = [f"sum{i}" for i in range(len(sums))]
    parts = rows.join(F.broadcast(first), "conv_id", "left_semi").groupBy("conv_id", "part").agg(
        *[s.alias(n) for s, n in zip(sums, names, strict=True)])
    return parts, names


def ordered_turns(table: DataFrame) -> DataFrame:
    """(conv_id, part, pos, lane1, lane2, words): every turn's place in its conversation, from 0, and what it says."""
    empty = F.lit("")
    rows = table.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"), F.monotonically_increasing_id().alias("spread"))
    order = ("conv_id", "turn", "role", "text", "spread")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ship_package(table.sparkSession)
    narrow = ranged.select(
        "conv_id", F.spark_partition_id().cast("long").alias("part"), F.xxhash64(F.lit(1), "role", "text").alias("lane1"),
        F.xxhash64(F.lit(2), "role", "text").alias("lane2"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    counted = through_storage(narrow.mapInArrow(
        numbered, "conv_id long, part long, lane1 long, lane2 long, words long, nth long"), "turns")
    parts, (size,) = before_in_parts(counted, F.count(F.lit(1)))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("conv_id", "part", F.sum(size).over(earlier).alias("before"))
    return counted.join(F.broadcast(before), ["conv_id", "part"], "left").select(
        "conv_id", "part", (F.col("nth") + F.coalesce("before", F.lit(0))).alias("pos"), *LANES, "words")


def rebuilt_turns(turns: DataFrame, group: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after each took its first turns from the first conversation of its group.

    Conversation c takes the first crc32(c) % heads turns of c - c % group in place of its own.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    taken = crc32_mod(F.col("conv_id"), heads)
    convs = turns.where("pos = 0").select("conv_id", "part", base.alias("base"), taken.alias("h"))
    given = turns.where((F.col("pos") < heads - 1) & (F.col("conv_id") % group == 0)).select(
        F.col("conv_id").alias("base"), "pos", *LANES, "words")
    lent = convs.join(given, "base").where("pos < h").select("conv_id", "part", "pos", *LANES, "words")
    held = given.groupBy("base").agg(F.count(F.lit(1)).alias("held"))
    own = turns.withColumns({"base": base, "h": taken}).where("pos >= h").join(held, "base", "left").select(
        "conv_id", "part", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("held", F.lit(0)))).alias("pos"), *LANES, "words")
    return convs.select("conv_id"), lent.unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key1, key2, up1, up2, words): the prefix that ends with each turn, and the one before."""
    said = through_storage(turns.select(
        "conv_id", "part", "pos", F.xxhash64(F.lit(1), "pos", *LANES).alias("say1"),
        F.xxhash64(F.lit(2), "pos", *LANES).alias("say2"), "words"), "said")
    parts, names = before_in_parts(said, F.bit_xor("say1"), F.bit_xor("say2"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("conv_id", "part", *[F.bit_xor(n).over(earlier).alias(f"before{i}") for i, n in enumerate(names, 1)])
    running = Window.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    here = said.select("*", *[F.bit_xor(f"say{i}").over(running).alias(f"run{i}") for i in (1, 2)])
    keys = [F.col(f"run{i}").bitwiseXOR(F.coalesce(f"before{i}", F.lit(0))) for i in (1, 2)]
    return through_storage(here.join(F.broadcast(before), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), keys[0].alias("key1"), keys[1].alias("key2"),
        keys[0].bitwiseXOR(F.col("say1")).alias("up1"), keys[1].bitwiseXOR(F.col("say2")).alias("up2"), "words"), "prefixes")


def digests(members: DataFrame) -> DataFrame:
    """(depth, key1, key2, ends_sha256): the ids of the conversations that end at a node, ascending, comma-joined, hashed.

    Ids are joined to rows of bounded size where they are sorted, and only those rows come together for a node.
    """
    node = ("depth", "key1", "key2")
    ship_package(members.sparkSession)

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            out = []
            for key, group in groupby(rows, key=lambda row: row[:3]):
                ids = [row[3] for row in group]
                out += [(*key, ids[at], ",".join(map(str, ids[at:at + CHUNK_IDS]))) for at in range(0, len(ids), CHUNK_IDS)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip((*node, "first", "ids"), row, strict=True)) for row in out],
                pa.schema([*((name, pa.int64()) for name in (*node, "first")), ("ids", pa.string())]))

    def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        names = pa.schema([*((name, pa.int64()) for name in node), ("ends_sha256", pa.string())])
        told = lambda: dict(zip(names.names, (*at, digest.hexdigest()), strict=True))
        for batch in batches:
            out = []
            for *key, _, ids in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if key == at:
                    digest.update(b"," + ids.encode())
                    continue
                if at is not None:
                    out.append(told())
                at, digest = key, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist(out, names)
        if at is not None:
            yield pa.RecordBatch.from_pylist([told()], names)

    order = (*node, "conv_id")
    chunks = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        join_ids, "depth long, key1 long, key2 long, first long, ids string")
    return chunks.repartition(*node).sortWithinPartitions(*node, "first").mapInArrow(
        hash_ids, "depth long, key1 long, key2 long, ends_sha256 string")


def prefix_trie(table: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``: the node's
    smallest member and depth, its parent's smallest member, its members, children and leaves below, the words that
    sharing saves in its subtree, and the digest of the members that end here.
    """
    convs, turns = rebuilt_turns(ordered_turns(table), group, heads)
    convs = through_storage(convs, "convs")
    rows = prefixes(turns)
    # One number each.
    smallest, deepest = convs.agg(F.min("conv_id")).first()[0], rows.agg(F.max("depth")).first()[0]
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(k) for k in ("key1", "key2", "up1", "up2")],
        "n_convs", "conv_id", F.lit(0).cast("long").alias("words"))
    found = through_storage(rows.groupBy("depth", "key1", "key2").agg(
        F.min("up1").alias("up1"), F.min("up2").alias("up2"), F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"), F.max("words").alias("words")).unionByName(root), "nodes")
    # Every node of depth 1 hangs on the root, so only deeper ones look their parent up.
    above = found.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("key1").alias("up1"),
                                            F.col("key2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    high = found.where("depth <= 1").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(smallest)).cast("long"))
    linked = high.unionByName(found.where("depth > 1").join(above, ["depth", "up1", "up2"]))
    children = linked.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = through_storage(linked.join(children, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "key1", "key2", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "words"), "trie")
    sums = subtree_sums(tree.select(
        F.struct("conv_id", "depth").alias("id"),
        F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")))
        .alias("parent"), F.col("depth").alias("rank"), (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), ["n_leaves", "saved_tokens"],
        max(1, int(deepest or 0).bit_length())).select("id.conv_id", "id.depth", "n_leaves", "saved_tokens")
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "key1", "key2")).alias("last"))
    zero = F.lit(0).cast("long")
    members = convs.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"last.{name}", zero).alias(name) for name in ("depth", "key1", "key2")])
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return tree.join(sums, ["conv_id", "depth"]).join(digests(members), ["depth", "key1", "key2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"))
