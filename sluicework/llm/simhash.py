"""SimHash fingerprints linked through Golay-code keys.

A fingerprint bit is the majority of that bit over the XXH64 values of a text's
word shingles.  Fingerprints are cut into 23-bit segments.  A segment decodes to
the indices of its near codewords (one or six), and two segments that differ in
at most two bits share an index.

``linked`` finds every pair of 64-bit fingerprints up to two differing bits: by
the pigeonhole one of three segments has no error, and the next segment has at
most two, so the exact segment with one codeword index of the next is a shared
key.  Within a key all pairs are compared.

``near_groups`` finds near copies.  Wider fingerprints propose pairs: keys are
pairs of codeword indices of neighbouring segments, and texts that share a key
join the first text of the key within a threshold of bits.  Every pair is then
verified on the sets of shingles.  The fingerprints miss some pairs, so an exact
prefix join proposes all other pairs between the components found, which are
verified alike.  Before a pair is proposed or its sets are sent, the parities of the
two sets (for each of 128 classes of hashes, whether a set holds an odd number) are
compared: sets differ in at least as many shingles as their parities do in bits, so
texts that are only half alike are dropped early and none that is near.

Defined results: a null text is the empty text; a text without words has
fingerprint zero and is linked like any other; one with fewer words than a
shingle is one shingle; repeated rows and equal texts fall into one component;
a component's id is its smallest document id, null if it has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from sluicework.llm import golay
from sluicework.llm.common import fresh, map_slices, regrouped, small_batches, texts_of
from sluicework.llm.components import components
from sluicework.session import ship_package, through_storage

SEED = 42
# Odd constants that turn one hash into independent lanes.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
# Above this many fingerprints in a key, all flips of two bits are looked up instead of all pairs compared.
PAIRWISE = 2048


def mixed(values: np.ndarray, lane: int) -> np.ndarray:
    """A finalised copy of 64-bit hashes for a lane; lane 0 is the hash itself."""
    if lane == 0:
        return values
    x = values + np.uint64(MIX[0]) * np.uint64(lane)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each shingle of a text's lower-case words."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:count].tolist(), ends[-count:].tolist(), strict=True)],
        dtype=np.uint64)


def majority(hashes: np.ndarray, lanes: int) -> list[int]:
    """Fingerprint lanes as signed 64-bit numbers."""
    found = []
    for lane in range(lanes):
        bits = np.unpackbits(mixed(hashes, lane).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = bits.sum(axis=0, dtype=np.int64)
        found.append(int(np.packbits(2 * ones > len(hashes)).view("<i8")[0]))
    return found


def fingerprints(df: DataFrame, column: str = "text", shingle: int = 3, lanes: int = 1,
                 output: str = "fingerprint", keep: bool = True, distinct: bool = False) -> DataFrame:
    """Add a text's fingerprint as an array of 64-bit lanes.

    ``keep=False`` leaves the text out; ``distinct`` counts a repeated shingle once.
    """
    given = np.unique if distinct else (lambda hashes: hashes)
    place = df.columns.index(column)
    kept = [i for i in range(len(df.columns)) if keep or i != place]
    added = StructField(output, ArrayType(LongType()))

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints = [majority(given(shingle_hashes(text, shingle)), lanes) for text in texts_of(batch, place)]
            rest = batch.select(kept)
            return pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(prints, pa.list_(pa.int64()))], [*rest.schema.names, "p"])

        return work

    return map_slices(df, StructType([*(df.schema.fields[i] for i in kept), added]), start)


def segment(lanes: np.ndarray, at: int) -> np.ndarray:
    """The 23-bit segment ``at`` of fingerprints, an (n, lanes) array; the last may be shorter."""
    bit = at * golay.LENGTH
    lane, shift = divmod(bit, 64)
    words = lanes.view(np.uint64)
    found = words[:, lane] >> np.uint64(shift)
    if shift + golay.LENGTH > 64 and lane + 1 < lanes.shape[1]:
        found = found | (words[:, lane + 1] << np.uint64(64 - shift))
    return (found & np.uint64((1 << golay.LENGTH) - 1)).astype(np.int64)


# -- up to two differing bits of 64 ------------------------------------------------------------------------------------


def exact_keys(prints: np.ndarray) -> list[np.ndarray]:
    """Keys of 64-bit fingerprints: an exact segment and a codeword index of the next one."""
    lanes = prints.reshape(-1, 1)
    parts = [segment(lanes, at) for at in range(3)]
    rows = []
    for at in range(3):
        near, count = golay.keys(parts[(at + 1) % 3])
        key = (at << 40 | parts[at] << golay.MESSAGE)[:, None] | near
        rows.append([k[:n] for k, n in zip(key, count.tolist(), strict=True)])
    return [np.unique(np.concatenate(keys)) for keys in zip(*rows, strict=True)]


def roots_within(prints: np.ndarray, bits: int = 2) -> np.ndarray:
    """For each distinct fingerprint the first one of its component under links up to ``bits`` differing bits."""
    count = len(prints)
    root = np.arange(count)
    if count <= PAIRWISE:
        links = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= bits)
    else:
        order = np.argsort(prints)
        ordered = prints[order]
        one = [np.uint64(1 << b) for b in range(64)]
        masks = [*one, *(a ^ b for i, a in enumerate(one) for b in one[:i] if bits > 1)]
        pairs = []
        for mask in masks:
            wanted = ordered ^ mask
            place = np.minimum(np.searchsorted(ordered, wanted), count - 1)
            hit = np.flatnonzero(ordered[place] == wanted)
            pairs.append((order[hit], order[place[hit]]))
        links = tuple(np.concatenate(side) for side in zip(*pairs, strict=True))
    while True:
        low = root.copy()
        np.minimum.at(low, links[0], root[links[1]])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def linked(prints: DataFrame, column: str = "fingerprint") -> DataFrame:
    """(a, b) links between distinct 64-bit fingerprints: a spanning forest of those up to two bits apart."""
    distinct = prints.select(F.col(column).alias("p")).where("p is not null").distinct()

    def give_keys():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            keys = exact_keys(values) if len(values) else []
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.list_(pa.int64()))], ["p", "keys"])

        return work

    keyed = map_slices(distinct, "p long, keys array<long>", give_keys).select("p", F.explode("keys").alias("key"))
    # A bucket holds distinct fingerprints that agree in 23 bits and a codeword, not documents.
    buckets = keyed.groupBy("key").agg(F.collect_list("p").alias("p")).where(F.size("p") > 1).select("p")

    def link():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            a, b = [], []
            for values in batch.column(0):
                prints = np.sort(values.values.to_numpy())
                root = roots_within(prints.view(np.uint64))
                moved = np.flatnonzero(root != np.arange(len(root)))
                a.append(prints[moved])
                b.append(prints[root[moved]])
            join = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
            return pa.RecordBatch.from_arrays([join(a), join(b)], ["a", "b"])

        return work

    return map_slices(buckets, "a long, b long", link)


def with_components(df: DataFrame, key: str, output: str = "component_id") -> DataFrame:
    """Add to rows (key, fingerprint long) the smallest key reachable over links of at most two bits."""
    by_print = df.groupBy("fingerprint").agg(F.min(key).alias("first"))
    roots = components(linked(df)).withColumnRenamed("node", "fingerprint")
    rooted = by_print.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = through_storage(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("first").alias(output))
    named = rooted.join(ids, "root").select("fingerprint", output)
    return df.join(named, "fingerprint")


# -- near copies -------------------------------------------------------------------------------------------------------

LANES = 4
SEGMENT_PAIRS = 2
# Differing bits of the two compared lanes: shingle sets of similarity 0.8 differ in 19.5 of 128 bits, give or take 4.
NEAR_BITS = 24
# The least Jaccard similarity of near copies, as a fraction.
NEAR = (4, 5)
# Bits of a shingle's hash that name its cell in the table of counts, and those of them that name a block of the table.
CELL_BITS, BLOCK_BITS = 20, 6
# Above this many rows of a key, the key's largest component is not compared with itself.
WIDE = 256
# Bits of a shingle's hash that are shipped to find common ones; chance meetings only cost a comparison.
KEY_MASK = (1 << 40) - 1
# A set's size and a place in it, as one number that sorts by size.
SIZE = 32


def pair_keys(lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): both codeword indices of each pair of neighbouring segments."""
    rows, keys = [], []
    grid = np.arange(6)
    for pair in range(SEGMENT_PAIRS):
        left, m = golay.keys(segment(lanes, 2 * pair))
        right, n = golay.keys(segment(lanes, 2 * pair + 1))
        key = pair << 24 | left[:, :, None] << golay.MESSAGE | right[:, None, :]
        used = (grid < m[:, None])[:, :, None] & (grid < n[:, None])[:, None, :]
        rows.append(np.nonzero(used)[0])
        keys.append(key[used])
    return np.concatenate(rows), np.concatenate(keys)


def lead(key: np.ndarray, rep: np.ndarray, first: np.ndarray, second: np.ndarray):
    """Leaders of rows sorted by key: (indices of leaders, indices of followers, their leaders).

    In each round the first row left of every key leads; rows within the
    threshold of it follow, the others go on to the next round.
    """
    left = np.arange(len(key))
    leaders, followers, led = [], [], []
    while len(left):
        begins = np.concatenate([[True], key[left][1:] != key[left][:-1]])
        head = left[np.flatnonzero(begins)][np.cumsum(begins) - 1]
        apart = np.bitwise_count((first[left] ^ first[head]).view(np.uint64)).astype(np.int64) + np.bitwise_count(
            (second[left] ^ second[head]).view(np.uint64))
        follows = (apart <= NEAR_BITS) & ~begins
        leaders.append(left[begins])
        followers.append(left[follows])
        led.append(head[follows])
        left = left[~begins & ~follows]
    empty = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate(x) if x else empty for x in (leaders, followers, led))


def link_rows(key, rep, first, second, to) -> pa.RecordBatch:
    """Rows of the link stages: a key row has no ``to``, a link has only ``rep`` and ``to``."""
    return pa.RecordBatch.from_arrays(
        [pa.array(x, pa.int64()) for x in (key, rep, first, second, to)], ["key", "rep", "first", "second", "to"])


LINK_ROWS = "key long, rep long, first long, second long, to long"


def near_links(prints: DataFrame) -> DataFrame:
    """(a, b) proposed links between rows (rep long, fingerprint array<long>) of near copies."""
    ship_package(prints.sparkSession)

    def links_of(rep, followers, led) -> pa.RecordBatch:
        none = pa.nulls(len(followers), pa.int64())
        return link_rows(none, rep[followers], none, none, rep[led])

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regrouped(batches, 4096):
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                rep = part.column(0).to_numpy()
                lanes = part.column(1).flatten().to_numpy().reshape(-1, LANES)
                row, key = pair_keys(lanes)
                order = np.lexsort((rep[row], key))
                row, key = row[order], key[order]
                rep, first, second = rep[row], lanes[row, 0], lanes[row, 1]
                leaders, followers, led = lead(key, rep, first, second)
                leaders = np.sort(leaders)
                yield link_rows(key[leaders], rep[leaders], first[leaders], second[leaders], pa.nulls(len(leaders), pa.int64()))
                yield links_of(rep, followers, led)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = [np.zeros(0, dtype=np.int64)] * 4
        for batch in regrouped(batches, 32_768):
            key, rep, first, second = (
                np.concatenate([c, batch.column(i).to_numpy()]) for i, c in enumerate(carried))
            if not len(key):
                continue
            leaders, followers, led = lead(key, rep, first, second)
            # Leaders of the last key also lead what the next batch holds of it.
            last = np.sort(leaders[key[leaders] == key[-1]])
            carried = [x[last] for x in (key, rep, first, second)]
            yield links_of(rep, followers, led)

    staged = through_storage(prints.select("rep", "fingerprint").mapInArrow(give, LINK_ROWS), "keys")
    keys = staged.where("to is null").select("key", "rep", "first", "second")
    pairs = keys.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(gather, LINK_ROWS)
    return staged.where("to is not null").union(pairs).select(F.col("rep").alias("a"), F.col("to").alias("b")).distinct()


def set_maker(shingle: int):
    """Distinct shingle hashes of a text, sorted."""
    return lambda text: np.unique(shingle_hashes(text, shingle))


def cells_of(hashes: np.ndarray) -> np.ndarray:
    """The cell of the table of counts that each hash falls into."""
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def cell_counts(docs: DataFrame, shingle: int) -> np.ndarray:
    """How many texts, of all, hold a shingle of each cell of hashes; the counts only set an order.

    A task counts its texts in a table of bounded size, and tables are added up block by block.
    """
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    wide = 1 << CELL_BITS - BLOCK_BITS

    def block_rows(blocks: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for block, held in blocks.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([held.astype("<i8").tobytes()], pa.binary())], ["block", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, held = set_maker(shingle), np.zeros(1 << CELL_BITS, dtype=np.int64)
        for batch in batches:
            for text in texts_of(batch, 0):
                np.add.at(held, cells_of(make(text)), 1)
        yield from block_rows({at: part for at, part in enumerate(held.reshape(-1, wide)) if part.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held[block] = held.get(block, 0) + np.frombuffer(counts.as_py(), "<i8")
        yield from block_rows(held)

    rows = "block int, counts binary"
    # One table of bounded size comes to the driver and goes to the tasks.
    found = np.zeros(1 << CELL_BITS, dtype=np.int64)
    for block, counts in docs.select("text").mapInArrow(count, rows).repartition("block").mapInArrow(add, rows).collect():
        found[block * wide:(block + 1) * wide] = np.frombuffer(counts, "<i8")
    return found


def rare_first(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set in one order that holds for all sets, rare hashes first."""
    return hashes[np.lexsort((hashes, counts[cells_of(hashes)]))]


def parity_of(hashes: np.ndarray) -> tuple[int, int]:
    """Bit i: whether a set has an odd number of hashes whose top seven bits are i."""
    odd = np.bincount((hashes >> np.uint64(57)).astype(np.int64), minlength=128) & 1
    return tuple(np.packbits(odd.astype(bool)).view("<i8").tolist())


def near_prints(docs: DataFrame, shingle: int, counts: np.ndarray) -> DataFrame:
    """(id, node, fingerprint, size, even, odd, prefix): of each row of (id, node, text) its set's size, parity and rarest hashes.

    Two sets of the wanted similarity share one of the n - ceil(0.8 n) + 1 rarest hashes of either.
    """

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [set_maker(shingle)(text) for text in texts_of(batch, 2)]
            prefixes = [rare_first(h, counts)[:len(h) - -(-NEAR[0] * len(h) // NEAR[1]) + 1].view(np.int64)
                        if len(h) else np.zeros(1, np.int64) for h in sets]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([majority(h, LANES) for h in sets], pa.list_(pa.int64())),
                 pa.array([len(h) for h in sets], pa.int64()),
                 *(pa.array(half, pa.int64()) for half in (zip(*map(parity_of, sets), strict=True) if sets else ([], []))),
                 pa.array(prefixes, pa.list_(pa.int64()))],
                ["id", "node", "fingerprint", "size", "even", "odd", "prefix"])

        return work

    kind = docs.schema["id"].dataType.simpleString()
    return map_slices(docs.select("id", "node", "text"),
                      f"id {kind}, node long, fingerprint array<long>, size long, even long, odd long, prefix array<long>", start)


def reaching(own, other, own_at, other_at) -> np.ndarray:
    """Whether sets of these sizes that first meet at these places can have the wanted similarity."""
    a, b = NEAR
    return (a + b) * np.minimum(own - own_at, other - other_at) >= a * (own + other)


def alike(own, other, evens, odds) -> np.ndarray:
    """Whether sets of these sizes with these pairs of parities can have the wanted similarity."""
    a, b = NEAR
    differ = sum(np.bitwise_count((x ^ y).view(np.uint64)).astype(np.int64) for x, y in (evens, odds))
    return (a + b) * differ <= (b - a) * (own + other)


def cross_pairs(key, node, comp, size, at, even, odd) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes of one key and two components that can be similar; rows are sorted by key and size."""
    none = np.zeros(0, dtype=np.int64)
    if not len(key):
        return none, none
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(begins, len(key)))
    mixed_comps = np.minimum.reduceat(comp, begins) != np.maximum.reduceat(comp, begins)
    pairs = [(none, none)]
    for begin, count in zip(begins[mixed_comps & (counts > WIDE)], counts[mixed_comps & (counts > WIDE)], strict=True):
        # Rows of the key's largest component are not compared with each other.
        rows = np.arange(begin, begin + count)
        names, place, many = np.unique(comp[rows], return_inverse=True, return_counts=True)
        largest = place == many.argmax()
        rest, done = rows[~largest], rows[largest]
        for k, row in enumerate(rest):
            others = np.concatenate([done, rest[k + 1:]])
            low, high = np.minimum(size[others], size[row]), np.maximum(size[others], size[row])
            good = (NEAR[0] * high <= NEAR[1] * low) & (comp[others] != comp[row])
            good &= reaching(size[row], size[others], at[row], at[others])
            good &= alike(size[row], size[others], (even[others], even[row]), (odd[others], odd[row]))
            pairs.append((np.full(good.sum(), row), others[good]))
    rows = np.flatnonzero(np.repeat(mixed_comps & (counts <= WIDE), counts))
    left, step = rows, 1
    while len(left):
        left = left[left + step < len(key)]
        other = left + step
        near = (key[left] == key[other]) & (NEAR[0] * size[other] <= NEAR[1] * size[left])
        left, other = left[near], other[near]
        good = (comp[left] != comp[other]) & reaching(size[left], size[other], at[left], at[other])
        good &= alike(size[left], size[other], (even[left], even[other]), (odd[left], odd[other]))
        pairs.append((left[good], other[good]))
        step += 1
    a, b = (node[np.concatenate(x)] for x in zip(*pairs, strict=True))
    found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
    return found[0], found[1]


def missing_links(prints: DataFrame, roots: DataFrame) -> DataFrame:
    """(a, b): all pairs of nodes in two components of ``roots`` whose prefixes and parities allow the wanted similarity."""
    named = prints.join(roots, "node", "left").select("node", "root", "size", "prefix", "even", "odd")
    names = ["key", "node", "root", "sized", "even", "odd"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Equal texts give equal rows; a task gives them once.
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                nodes = part.column(0).to_pylist()
                part = part.take(pa.array([i for i, n in enumerate(nodes) if not (n in seen or seen.add(n))], pa.int64()))
                long = part.column(3).value_lengths().to_numpy()
                row = np.repeat(np.arange(part.num_rows), long)
                place = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
                sizes = part.column(2).to_numpy()[row] << SIZE | place
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part.column(3).flatten().to_numpy() & KEY_MASK), *(part.column(i).take(pa.array(row)) for i in range(2)),
                     pa.array(sizes), *(part.column(i).take(pa.array(row)) for i in (4, 5))], names)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(rows: list[np.ndarray]) -> pa.RecordBatch:
            key, node, comp, sized, even, odd = rows
            found = cross_pairs(key, node, comp, sized >> SIZE, sized & ((1 << SIZE) - 1), even, odd)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

        held = [np.zeros(0, dtype=np.int64)] * 6
        for batch in regrouped(batches, 32_768):
            batch = batch.set_column(2, "root", pc.coalesce(batch.column(2), batch.column(1)))
            held = [np.concatenate([c, batch.column(i).to_numpy()]) for i, c in enumerate(held)]
            if len(held[0]):
                # The last key may go on in the next batch.
                cut = np.searchsorted(held[0], held[0][-1])
                yield given([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        yield given(held)

    rows = ", ".join(f"{name} long" for name in names)
    return named.mapInArrow(spread, rows).repartition("key").sortWithinPartitions("key", "sized").mapInArrow(
        gather, "a long, b long").distinct()


def verified(docs: DataFrame, prints: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """The (a, b) pairs of nodes of (node, text) whose shingle sets have a Jaccard similarity of 0.8 or more."""
    facts = prints.select("node", "size", "even", "odd").dropDuplicates(["node"])
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(*[F.col(name).alias(f"{side}_{name}") for name in facts.columns]), F.col(side) == F.col(f"{side}_node"))
    differ = sum((F.bit_count(F.col(f"a_{half}").bitwiseXOR(F.col(f"b_{half}"))) for half in ("even", "odd")), F.lit(0))
    can_be = (NEAR[0] + NEAR[1]) * differ <= (NEAR[1] - NEAR[0]) * (F.col("a_size") + F.col("b_size"))
    pairs = through_storage(pairs.where((F.col("a") != F.col("b")) & can_be).select("a", "b"), "pairs")
    nodes = through_storage(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "nodes")

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [set_maker(shingle)(text).view(np.int64) for text in texts_of(batch, 1)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "set"])

        return work

    # Both sides of the join below read one shuffle of the sets.
    wanted = docs.select("node", "text").join(nodes, "node", "left_semi")
    sets = map_slices(wanted, "node long, set array<long>", start).dropDuplicates(["node"])
    own = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    other = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    shared, a, b = F.size(F.array_intersect("x", "y")), F.size("x"), F.size("y")
    near = (NEAR[0] + NEAR[1]) * shared >= NEAR[0] * (a + b)
    return through_storage(pairs.join(own, "a").join(other, "b").where(near).select("a", "b"), "verified")


def near_groups(df: DataFrame, key: str, column: str = "text", shingle: int = 5) -> DataFrame:
    """(id, node, first, first_node) of each row: its key, its text's hash, and those of the row its group keeps.

    Groups are the components of all pairs of texts of a similarity of 0.8 or
    more; a group keeps its row with the smallest key, nulls last.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    docs = df.select(F.col(key).alias("id"), F.xxhash64(text).alias("node"), text.alias("text"))
    prints = through_storage(near_prints(docs, shingle, cell_counts(docs, shingle)), "prints")
    reps = prints.groupBy("fingerprint").agg(F.min("node").alias("rep"))
    equal = prints.join(reps, "fingerprint").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    near = verified(docs, prints, near_links(reps).union(equal), shingle)
    more = verified(docs, prints, missing_links(prints, components(near)), shingle)
    roots = components(near.union(more))
    named = prints.select("id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = through_storage(named.select("id", "node", "root").distinct(), "named")
    smallest = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "node")).alias("least")
    leasts = named.groupBy("root").agg(smallest)
    return named.join(leasts, "root").select(
        "id", "node", F.col("least.id").alias("first"), F.col("least.node").alias("first_node"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """Documents without near copies: of each group the one with the smallest key stays, with all its columns.

    Of equal rows (key and text) one stays.
    """
    groups = near_groups(docs, key, text, shingle)
    same = F.col("id").eqNullSafe(F.col("first")) & (F.col("node") == F.col("first_node"))
    gone = groups.where(~same).select(F.col("id").alias("gone_key"), F.col("node").alias("gone_node"))
    nth, node = fresh("nth", docs.columns), fresh("node", docs.columns)
    named = docs.withColumn(node, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    kept = named.join(gone, (F.col(node) == F.col("gone_node")) & F.col(key).eqNullSafe(F.col("gone_key")), "left_anti")
    # Only rows of which there are several are numbered, so texts do not move for the others.
    several = kept.groupBy(F.col(node).alias("gone_node"), F.col(key).alias("gone_key")).agg(F.count(F.lit(1)).alias("n")).where(
        "n > 1").drop("n")
    repeated = through_storage(several, "repeated")
    same = (F.col(node) == F.col("gone_node")) & F.col(key).eqNullSafe(F.col("gone_key"))
    order = Window.partitionBy(node, key).orderBy(F.lit(1))
    first = kept.join(repeated, same, "left_semi").withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1)
    return kept.join(repeated, same, "left_anti").select(*docs.columns).unionByName(first.select(*docs.columns))
