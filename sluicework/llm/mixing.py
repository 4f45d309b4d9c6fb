"""Mixing sources to target weights by drawing blocks.

Texts of a source, in the order of their hashed ids, form one stream of words
that is cut into blocks of ``BLOCK`` words (the last may be shorter).  A mix is a
number of slots, each one block, dealt to output shards.  Every shard draws how
many of its slots each source gets from a multinomial with the target weights.
What sources draw beyond their quota goes to those that drew less, so the totals
meet the targets exactly while shards stay random.  A source's slots run through
its blocks by a pseudorandom permutation of the block numbers, one permutation
per pass, so a block comes up again only when all others have.  The last slot of
a source may take only the first words of its block.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a source without words gets target 0; an empty table gives an
empty mix; repeated rows are separate documents; documents with null ids take
part; other columns pass through where they do not clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluicework.llm.common import SPACE_CLASS, map_slices
from sluicework.session import ship_package, through_storage

BLOCK = 256
SHARD_SLOTS = 16_384
SEED = 11
# Rows whose running sum one task takes, about.
RUN_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")), F.lit(0)).cast("long")


def targets(sizes: np.ndarray, weights: np.ndarray, share: float = 1.5, most: float = 2.0) -> np.ndarray:
    """Words each source should give: ``share`` of all by weight, at most ``most`` times its size.

    What a capped source cannot give is shared out again by weight.
    """
    sizes = sizes.astype(float)
    limit = most * sizes
    capped = limit <= 0
    given = np.where(capped, limit, 0.0)
    total = share * sizes.sum()
    while not capped.all():
        rest = total - limit[capped].sum()
        given = np.where(capped, limit, rest * weights / weights[~capped].sum())
        over = ~capped & (given > limit)
        if not over.any():
            break
        capped |= over
        given = np.where(capped, limit, given)
    return given


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def feistel(values: np.ndarray, half: np.ndarray, key: np.ndarray, rounds: tuple[int, ...]) -> np.ndarray:
    """A keyed permutation of the numbers of 2 * half bits; rounds in falling order undo it."""
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = values >> half, values & mask
    backwards = rounds[0] > rounds[-1]
    for step in rounds:
        if backwards:
            left, right = right ^ (mix64(left + key + np.uint64(step << 40)) & mask), left
        else:
            left, right = right, left ^ (mix64(right + key + np.uint64(step << 40)) & mask)
    return left << half | right


FORWARD, BACK = (0, 1, 2, 3), (3, 2, 1, 0)


def permuted(index: np.ndarray, count: np.ndarray, key: np.ndarray, rounds: tuple[int, ...] = FORWARD) -> np.ndarray:
    """Pseudorandom permutation of range(count) at ``index``; values outside walk on until they are inside."""
    count, key = count.astype(np.uint64), key.astype(np.uint64)
    bits = np.ceil(np.log2(np.maximum(count, np.uint64(2)).astype(float))).astype(np.uint64)
    half = np.maximum((bits + np.uint64(1)) // np.uint64(2), np.uint64(1))
    found = index.astype(np.uint64)
    walk = np.arange(len(found))
    while len(walk):
        found[walk] = feistel(found[walk], half[walk], key[walk], rounds)
        walk = walk[found[walk] >= count[walk]]
    return found.astype(np.int64)


def pass_key(source: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    return mix64(source.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + turn.astype(np.uint64) + np.uint64(seed << 32))


@dataclass
class Plan:
    """What a mix takes of each source, in the order of the sources."""

    sizes: np.ndarray
    targets: np.ndarray
    blocks: np.ndarray
    quotas: np.ndarray
    last: np.ndarray  # words of a source's last slot


def plan(sizes: np.ndarray, weights: np.ndarray, block: int = BLOCK, seed: int = SEED) -> Plan:
    """Quotas in slots so that a source's slots hold its target, rounded to words."""
    wanted = targets(sizes, weights)
    words = np.rint(wanted).astype(np.int64)
    blocks = -(-sizes // block)
    source = np.arange(len(sizes))
    turns = np.where(sizes > 0, words // np.maximum(sizes, 1), 0)
    rest = words - turns * sizes
    short = sizes - (blocks - 1) * block
    has = sizes > 0
    where = np.full(len(sizes), -1, dtype=np.int64)
    where[has] = permuted(blocks[has] - 1, blocks[has], pass_key(source[has], turns[has], seed), BACK)
    # Slots of the last turn: all are full but the one with the short block.
    full = -(-rest // block)
    before = full * block - (block - short) * ((where < full) & (full > 0))
    slots = np.where(before >= rest, full, full + 1)
    held = slots * block - (block - short) * ((where < slots) & (slots > 0))
    final = np.where(where == slots - 1, short, block)
    last = np.where(slots > 0, final - (held - rest), np.where(blocks > 0, block, 0))
    # A turn that ends with a whole pass ends with the block at the last place of it.
    ends = (slots == 0) & (turns > 0)
    if ends.any():
        at = permuted(blocks[ends] - 1, blocks[ends], pass_key(source[ends], turns[ends] - 1, seed))
        last[ends] = np.where(at == blocks[ends] - 1, short[ends], block)
    return Plan(sizes, wanted, blocks, turns * blocks + slots, last)


def long_rows(**columns) -> pa.RecordBatch:
    """A batch of long columns."""
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns.values()], list(columns))


def by_source(spark: SparkSession, **column) -> DataFrame:
    """One row per source: its number and one column of what is known of it.

    From Arrow, as a list of rows would be turned by Python workers in tasks, of a pool of their own.
    """
    (name, values), = column.items()
    return spark.createDataFrame(pa.table({"source": pa.array(range(len(values)), pa.int64()), name: values}))


def draws(spark: SparkSession, mix: Plan, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, source, first, count): the range of its source's slots that each shard takes.

    One row per shard and source at most; shards draw on their own, in tasks.
    """
    ship_package(spark)
    quotas = mix.quotas
    total = int(quotas.sum())
    shards = -(-total // shard_slots)

    def draw(batches):
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                slots = min(shard_slots, total - shard * shard_slots)
                counts = np.random.default_rng([seed, shard]).multinomial(slots, quotas / total)
                source = np.flatnonzero(counts)
                yield long_rows(shard=np.full(len(source), shard), source=source, n=counts[source])

    drawn = spark.range(shards).mapInArrow(draw, "shard long, source long, n long")
    drawn = through_storage(drawn, "draws")
    up_to = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.withColumn("first", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
    limits = by_source(spark, quota=quotas)
    placed = placed.join(limits, "source")
    inside = placed.withColumn("n", F.greatest(F.lit(0), F.least("n", F.col("quota") - F.col("first"))))
    # Draws beyond a quota, in the order of (source, shard), fill the quotas that are not met, in the order of sources.
    drawn_by = {r.source: r.n for r in drawn.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    had = np.array([drawn_by.get(i, 0) for i in range(len(quotas))])
    lacking, extra = np.maximum(quotas - had, 0), np.maximum(had - quotas, 0)
    gaps = [(int(e - n), int(e), i, int(h)) for i, (n, e, h) in enumerate(zip(lacking, np.cumsum(lacking), had, strict=True)) if n]
    offsets = by_source(spark, ahead=np.cumsum(extra) - extra)
    over = placed.join(offsets, "source").withColumn("cut", F.greatest("first", "quota")).withColumn(
        "more", F.col("first") + F.col("n") - F.col("cut")).where("more > 0").select(
        "shard", (F.col("ahead") + F.col("cut") - F.col("quota")).alias("a"), F.col("more").alias("m"))

    def refill(batches):
        ends, names = np.array([high for _, high, _, _ in gaps]), ("shard", "source", "first", "n")
        for batch in batches:
            rows = []
            for shard, at, more in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                gap = int(np.searchsorted(ends, at, side="right"))
                while more > 0:
                    low, high, source, start = gaps[gap]
                    count = min(more, high - at)
                    rows.append((shard, source, start + at - low, count))
                    at, more, gap = at + count, more - count, gap + 1
            yield long_rows(**dict(zip(names, zip(*rows, strict=True) if rows else [[]] * 4, strict=True)))

    refilled = over.mapInArrow(refill, "shard long, source long, first long, n long")
    return inside.where("n > 0").select("shard", "source", "first", "n").unionByName(refilled)


def slots(spark: SparkSession, mix: Plan, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(shard, slot, source, block, words): the blocks of the mix, one row per slot."""
    # Stored, so that no stage has two Python passes, each with a worker of its own in an executor's memory.
    each = through_storage(draws(spark, mix, seed=seed), "ranges").select(
        "shard", "source", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)).alias("slot"))
    blocks, quotas, last, sizes = mix.blocks, mix.quotas, mix.last, mix.sizes

    def place(batches):
        for batch in batches:
            shard, source, slot = (column.to_numpy() for column in batch.columns)
            count = blocks[source]
            turn, at = slot // count, slot % count
            number = permuted(at, count, pass_key(source, turn, seed))
            words = np.where(number == count - 1, sizes[source] - (count - 1) * block, block)
            words = np.where(slot == quotas[source] - 1, last[source], words)
            yield long_rows(shard=shard, source=source, slot=slot, block=number, words=words)

    return each.mapInArrow(place, "shard long, source long, slot long, block long, words long")


def stream_places(docs: DataFrame, rows: int) -> DataFrame:
    """Add ``start``, the place of a document's first word in its source's stream.

    The running sum has two levels, so no task sees a whole source: documents
    fall into runs by hash, and only the runs' totals are summed along a source.
    """
    runs = max(1, -(-rows // RUN_ROWS))
    cut = docs.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)))
    totals = cut.groupBy("source", "run").agg(F.sum("size").alias("words"))
    along = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    heads = totals.select("source", "run", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("head"))
    within = Window.partitionBy("source", "run").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inner = cut.withColumn("start", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return inner.join(heads, ["source", "run"]).withColumn("start", F.col("start") + F.col("head")).drop("run", "head")


def mixed(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), key: str = "doc_id", text: str = "text",
          source: str = "source", block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, Plan, DataFrame]:
    """Documents with what a mix takes of them, the plan, and the mix's slots.

    Document rows: key, name (source), size, source (its number), start, taken.
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("name"), word_count(F.col(text)).alias("size"),
        F.xxhash64(key, text, source).alias("row"))
    sized = through_storage(sized, "sizes")
    # One row per source, named one by one in a mix's weights.
    found = sorted(sized.groupBy("name").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect(),
                   key=lambda r: (r.name is None, r.name or ""))
    sizes = np.array([r.size for r in found], dtype=np.int64)
    mix = plan(sizes, np.array([weights[i % len(weights)] for i in range(len(found))], dtype=float), block, seed)
    numbers = by_source(spark, name=pa.array([r.name for r in found], pa.string()))
    named = sized.join(F.broadcast(numbers), sized["name"].eqNullSafe(numbers["name"])).drop(numbers["name"])
    placed = stream_places(named, sum(r.n for r in found))
    chosen = through_storage(slots(spark, mix, block, seed), "slots") if mix.quotas.sum() else None
    if chosen is None:
        return placed.withColumn("taken", F.lit(0).cast("long")), mix, spark.createDataFrame(
            [], "shard long, source long, slot long, block long, words long")
    # A block counts with the words taken of it each time; only a source's last slot can be cut short.
    placed = through_storage(placed, "placed")
    spans = placed.where("size > 0").select(
        "key", "source", "start", "size", F.explode(F.sequence(
            F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"))
    begin = F.greatest("start", F.col("block") * block)
    overlap = lambda words: F.greatest(
        F.lit(0), F.least(F.col("start") + F.col("size"), F.col("block") * block + words) - begin)
    uses = chosen.groupBy("source", "block").agg(F.collect_list("words").alias("uses"))
    taken = spans.join(uses, ["source", "block"]).select(
        "source", "start", F.aggregate("uses", F.lit(0).cast("long"), lambda a, w: a + overlap(w)).alias("t"))
    taken = taken.groupBy("source", "start").agg(F.sum("t").alias("taken"))
    # Two documents share a start only if the first is empty.
    some = placed.where("size > 0").join(taken, ["source", "start"], "left")
    none = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return some.withColumn("taken", F.coalesce("taken", F.lit(0))).unionByName(none), mix, chosen


def mixed_texts(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), key: str = "doc_id", text: str = "text",
                source: str = "source", block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mix as documents: each one as often as the mix repeats it, cut to the blocks that were drawn.

    The n-th row of a document holds the stretches of its words that are taken n
    times or more; a document taken whole keeps its text.
    """
    placed, _, chosen = mixed(docs, weights, key, text, source, block, seed)
    # The longest use of a block first, so its n-th use belongs to the document's n-th row.
    uses = chosen.groupBy("source", "block").agg(F.reverse(F.array_sort(F.collect_list("words"))).alias("uses"))
    spans = placed.where("size > 0").select(
        "row", "source", "start", "size",
        F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))).alias("block"))
    parts = spans.join(uses, ["source", "block"]).select(
        "row", "source", "start", "size", (F.col("block") * block).alias("at"), F.posexplode("uses").alias("turn", "words"))
    low = F.greatest("start", "at") - F.col("start")
    high = F.least(F.col("start") + F.col("size"), F.col("at") + F.col("words")) - F.col("start")
    pieces = parts.select("row", "start", "turn", low.alias("low"), high.alias("high")).where("high > low")
    pieces = pieces.groupBy("row", "start", "turn").agg(F.collect_list(F.struct("low", "high")).alias("pieces"))
    pieces = pieces.groupBy("row", "start").agg(F.collect_list("pieces").alias("rows"))
    # Equal rows share a hash; the n-th of them takes the n-th place.
    nth = lambda order: F.row_number().over(Window.partitionBy("row").orderBy(order))
    placed_rows = pieces.select(F.col("row").alias("place"), "rows", F.row_number().over(
        Window.partitionBy("row").orderBy("start")).alias("place_nth"))
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.xxhash64(key, text, source).alias("row"))
    held = held.withColumn("nth", nth(F.lit(0)))
    both = held.join(placed_rows, (F.col("row") == F.col("place")) & (F.col("nth") == F.col("place_nth")))
    each = both.select("doc", F.col(f"doc.`{text}`").alias("whole"), F.explode("rows").alias("pieces"))
    cut = cut_texts(each.select("doc", "whole", "pieces"))
    return cut.select(*(F.col("shown").alias(c) if c == text else F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def cut_texts(rows: DataFrame) -> DataFrame:
    """Add ``shown`` to rows (doc, whole, pieces): the stretches of words, from the first to the last character of each."""

    def start():
        word = re.compile(r"[^\x20\x09-\x0D]+")

        def shown(text: str, pieces: list[dict]) -> str:
            places = [m.span() for m in word.finditer(text)]
            merged: list[list[int]] = []
            for low, high in sorted((p["low"], p["high"]) for p in pieces):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = high
                else:
                    merged.append([low, high])
            if merged == [[0, len(places)]]:
                return text
            return "\n".join(text[places[low][0]:places[high - 1][1]] for low, high in merged)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [shown(t or "", p) for t, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc", "shown"])

        return work

    return map_slices(rows, StructType([rows.schema["doc"], StructField("shown", StringType())]), start)
