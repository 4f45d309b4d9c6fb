"""An interpolated modified Kneser-Ney model of order 2 or 3 over hashed words.

Counting.  Words are hashed to 48 bits.  Map tasks count distinct bigrams of a
large stretch of text and send each reducer one block per stretch: the block's
words, and the bigrams as places among these words, which need far fewer bits than
hashes.  Columns are sorted, told as differences, cut into byte planes and compressed.
A reducer adds up its bigrams, keeps them as a hash table in a file of the
shared folder and passes on, packed alike, what each word and each context gets:
distinct left neighbours, occurrences, successors seen once, twice or more.  A
second round adds these up to a table of words.
With order 3 the blocks hold trigrams, dealt by their last two words, so that a
reducer also has the distinct left neighbours of each bigram; the second round
adds up what each context of two words gets, and keeps it for contexts that are
followed more than once: any other bigram has one successor, seen once.

Files.  A table is its sorted hashes: a directory over their highest bits, and 40
bits of each after those.  A value takes half a byte or one; larger ones are listed
with their places.

Scoring.  Workers map the files into memory (from a folder that is not on a
local mount they fetch them once, map them and unlink them) and look bigrams up
by binary search below the directory.  With discounts D1, D2, D3+ from the counts of counts,

    P(w | u) = max(c(uw) - D, 0) / c(u) + g(u) * P(w)
    P(w)     = max(N(.w) - D', 0) / N(..) + g' / (V + 1)

where g spends what the discounts save; unseen words share the last term.  With
order 3, P(w | tu) is the upper line over c(tuw) and P(w | u), in which c(uw) is
then the number of words before uw; after the start of a text it stays the count.

Each text is its words and one end token, after a start context.

Defined results: a null or empty text is its end token; without any training
text P is 1 for every token; repeated rows count each time; other columns pass
through.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from sluicework.llm.common import map_slices, small_batches, texts_of
from sluicework.llm.wordhash import scramble, word_hashes
from sluicework.session import shared_dir, ship_package

WORD_BITS = np.uint64((1 << 48) - 1)
WORD_SHIFT = np.uint64(16)
# Contexts of two words are known by the upper bits of a hash, as many as a table tells apart.
CONTEXT_SHIFT = np.uint64(8)
CONTEXT_BITS = np.uint64(~0xFF & (1 << 64) - 1)
END, START = np.uint64(1), np.uint64(2)
PAIR, TRIPLE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
# Tokens a map task counts at a time, about.
STRETCH = 4_000_000
# Bits of a hash that a table keeps after those its directory stands for, and hashes to an entry of the directory.
REST_BITS, ENTRY_KEYS = 40, 64
# Bytes of text a reducer's share should stand for.
SHARE = 24_000_000


def pack(columns: list[np.ndarray]) -> bytes:
    """Equal columns of unsigned numbers, of which the first ascends: a count, and byte planes compressed one by one."""
    ascending, *rest = columns
    planes = [
        pa.compress(plane.tobytes(), codec="zstd", asbytes=True) if plane.any() else b""
        for c in (np.diff(ascending.astype(np.uint64), prepend=np.uint64(0)), *rest)
        for plane in np.ascontiguousarray(c, dtype=np.uint64).view(np.uint8).reshape(len(c), 8).T]
    return np.array([len(ascending), *map(len, planes)], dtype=np.uint32).tobytes() + b"".join(planes)


def unpack(block: bytes, columns: int) -> list[np.ndarray]:
    count, *sizes = np.frombuffer(block, dtype=np.uint32, count=1 + 8 * columns).tolist()
    found, at = np.zeros((columns, count, 8), dtype=np.uint8), 4 + 32 * columns
    for place, size in enumerate(sizes):
        if size:
            plane = pa.decompress(block[at:at + size], decompressed_size=count, codec="zstd", asbytes=True)
            found[place // 8, :, place % 8] = np.frombuffer(plane, dtype=np.uint8)
            at += size
    first, *rest = found.view(np.uint64).reshape(columns, count)
    return [np.cumsum(first, dtype=np.uint64), *rest]


def summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct key rows, sorted, and the sums of their values."""
    if not len(keys[0]):
        return keys, [v.astype(np.uint64) for v in values]
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    keys = [k[order] for k in keys]
    new = np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)])
    heads = np.flatnonzero(new)
    return [k[heads] for k in keys], [np.add.reduceat(v[order], heads, dtype=np.uint64) for v in values]


def joined(places: list[np.ndarray], words: int) -> list[np.ndarray]:
    """Columns of places among so many words as one column of the same order, if they fit one number."""
    bits = words.bit_length()
    if bits * len(places) > 64:
        return places
    whole = places[0]
    for column in places[1:]:
        whole = (whole << np.uint64(bits)) | column
    return [whole]


def parted(keys: list[np.ndarray], columns: int, words: int) -> list[np.ndarray]:
    """The columns that :func:`joined` put together."""
    if len(keys) == columns:
        return keys
    bits = words.bit_length()
    return [(keys[0] >> np.uint64(bits * at)) & np.uint64((1 << bits) - 1) for at in reversed(range(columns))]


def shard_of(first: np.ndarray, second: np.ndarray | None, shards: int) -> np.ndarray:
    mixed = scramble(first * np.uint64(3) + (second * np.uint64(5) if second is not None else np.uint64(0)))
    return ((mixed >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def bigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, tokens of each text): each text's words and end, each after its left neighbour."""
    hashes, counts = word_hashes(texts)
    sizes = counts + 1
    ends = np.cumsum(sizes) - 1
    words = np.empty(int(sizes.sum()), dtype=np.uint64)
    inner = np.ones(len(words), dtype=bool)
    inner[ends] = False
    words[inner] = np.maximum(hashes & WORD_BITS, np.uint64(3))
    words[ends] = END
    context = np.concatenate([[START], words[:-1]])
    context[ends[:-1] + 1] = START
    return context, words, sizes


def before(context: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The words two places before each token, given those one place before."""
    found = np.concatenate([[START], context[:-1]])
    found[np.cumsum(sizes) - sizes] = START
    return found


def rows_by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each shard that has any, in their order."""
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for at in range(shards):
        rows = order[cuts[at]:cuts[at + 1]]
        if len(rows):
            yield at, rows


def by_shard(shard: np.ndarray, shards: int, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """Packed blocks of columns by shard; rows keep their order."""
    for at, rows in rows_by_shard(shard, shards):
        yield at, pack([c[rows] for c in columns])


def store(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """Write arrays one after the other under a name; a repeated task replaces its file whole."""
    files, root = arrow_fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        arrow_fs.LocalFileSystem(), folder)
    files.create_dir(root)
    part = f"{root}/{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        for array in arrays:
            out.write(np.ascontiguousarray(array).data)
    files.move(part, f"{root}/{name}")


def mapped(folder: str, name: str) -> np.ndarray:
    """The bytes of a stored file, mapped into memory."""
    files, root = arrow_fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        arrow_fs.LocalFileSystem(), folder)
    path = f"{root}/{name}"
    if isinstance(files, arrow_fs.LocalFileSystem):
        return np.memmap(path, dtype=np.uint8, mode="r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    with tempfile.NamedTemporaryFile() as copy, files.open_input_stream(path) as source:
        while chunk := source.read(1 << 24):
            copy.write(chunk)
        copy.flush()
        return np.memmap(copy.name, dtype=np.uint8, mode="r")  # the map outlives the name


def table_arrays(keys: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """What :class:`Table` reads, of distinct hashes that use their highest bits and of a row of numbers for each."""
    order = np.argsort(keys)
    keys, values = keys[order], [v[order].astype(np.uint64) for v in values]
    bits = min(max((len(keys) // ENTRY_KEYS).bit_length(), 64 - REST_BITS - 16), 24)
    heads = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
    rest = (keys << np.uint64(bits)) >> np.uint64(64 - REST_BITS)
    # Half a byte or one for each, whichever takes less.
    limits = [15 if len(v) > 32 * ((v >= 15) & (v < 255)).sum() else 255 for v in values]
    large = [np.flatnonzero(v >= limit) for v, limit in zip(values, limits, strict=True)]
    small = [np.minimum(v, limit).astype(np.uint8) for v, limit in zip(values, limits, strict=True)]
    return [
        np.array([len(keys), bits, len(values), *limits, *map(len, large)], np.uint64),
        *(x.astype(np.uint64) for places, v in zip(large, values, strict=True) for x in (places, v[places])),
        heads.astype(np.uint32), (rest >> np.uint64(8)).astype(np.uint32), rest.astype(np.uint8),
        *(v if limit == 255 else v[::2] | np.append(v[1::2], np.zeros(len(v) % 2, np.uint8)) << np.uint8(4)
          for v, limit in zip(small, limits, strict=True))]


class Table:
    """Rows of numbers by hash, in the bytes of :func:`table_arrays`."""

    def __init__(self, data: np.ndarray) -> None:
        count, bits, width = data[:24].view(np.uint64).tolist()
        facts = data[24:24 + 16 * width].view(np.uint64).tolist()
        at = 24 + 16 * width

        def take(kind: type, size: int) -> np.ndarray:
            nonlocal at
            at += size * np.dtype(kind).itemsize
            return data[at - size * np.dtype(kind).itemsize:at].view(kind)

        self.count, self.bits = count, bits
        self.limits = facts[:width]
        self.large = [(take(np.uint64, n), take(np.uint64, n)) for n in facts[width:]]
        self.heads = take(np.uint32, (1 << bits) + 1)
        self.upper, self.lower = take(np.uint32, count), take(np.uint8, count)
        self.values = [take(np.uint8, count if limit == 255 else (count + 1) // 2) for limit in self.limits]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The rows of hashes as columns, zero where a hash is absent."""
        head = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        low, stop = self.heads[head].astype(np.int64), self.heads[head + 1].astype(np.int64)
        high, last = stop, self.count - 1
        wanted = (keys << np.uint64(self.bits)) >> np.uint64(64 - REST_BITS)

        def kept(at: np.ndarray) -> np.ndarray:
            at = np.minimum(at, last)
            return (self.upper[at].astype(np.uint64) << np.uint64(8)) | self.lower[at]

        for _ in range(int((stop - low).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            less = (low < high) & (kept(middle) < wanted)
            high = np.where(less, high, middle)
            low = np.where(less, np.minimum(middle + 1, high), low)
        hit = np.flatnonzero((low < stop) & (kept(low) == wanted))
        at, found = low[hit], np.zeros((len(self.values), len(keys)), dtype=np.int64)
        for row, limit, small, (places, values) in zip(found, self.limits, self.values, self.large, strict=True):
            number = small[at].astype(np.int64) if limit == 255 else small[at >> 1].astype(np.int64) >> 4 * (at & 1) & 15
            over = np.flatnonzero(number == limit)
            number[over] = values[np.searchsorted(places, at[over].astype(np.uint64))]
            row[hit] = number
        return found


@dataclass
class Level:
    """Discounts for counts of one, two, and more."""

    one: float = 0.0
    two: float = 0.0
    more: float = 0.0

    @classmethod
    def of(cls, n1: int, n2: int, n3: int, n4: int) -> Level:
        """Chen and Goodman's estimates; where a count of counts is missing, the plain absolute discount."""
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
        y = min(max(y, 0.05), 0.95)
        rest = [1 - 2 * y * n2 / n1 if n1 else y, 2 - 3 * y * n3 / n2 if n2 else y, 3 - 4 * y * n4 / n3 if n3 else y]
        return cls(*(min(max(d, 0.05), k - 0.05) for k, d in enumerate(rest, 1)))

    def discount(self, count: np.ndarray) -> np.ndarray:
        return np.select([count == 0, count == 1, count == 2], [0.0, self.one, self.two], self.more)


WORD_COLUMNS = ("left", "count", "follow", "one", "two", "more")


@dataclass
class Model:
    """Where the files are and the numbers that go with them."""

    folder: str
    shards: int
    pairs: tuple[int, ...]
    words: tuple[int, ...]
    bigram: Level
    unigram: Level
    distinct_pairs: int
    tokens: int
    vocabulary: int
    unigram_weight: float
    order: int = 2
    contexts: tuple[int, ...] = ()
    trigram: Level = field(default_factory=Level)
    distinct_triples: int = 0


def count_model(texts: DataFrame, size: int, column: str = "text", order: int = 2) -> Model:
    """Count a model over a frame's texts; ``size`` is the bytes of text, about, and sets the number of shards."""
    if order not in (2, 3):
        raise ValueError(f"order must be 2 or 3, not {order}")
    spark = texts.sparkSession
    ship_package(spark)
    small_batches(spark)
    shards = max(4, -(-size // SHARE))
    folder = shared_dir(spark, "ngrams")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        held_tokens = 0

        def flush() -> pa.RecordBatch:
            tokens, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            heads = np.cumsum(sizes) - sizes
            words, places = np.unique(np.append(tokens, START), return_inverse=True)
            start, columns = places[-1], [places[:-1].astype(np.uint64)]
            for _ in range(order - 1):
                # What stands before a token is that of the token before, or a start.
                column = np.concatenate([columns[-1][:1], columns[-1][:-1]])
                column[heads] = start
                columns.append(column)
            w, u, *first = columns
            keys = joined([u, w, *first], len(words))
            if len(keys) == 1:
                keys, ones = (lambda k, n: ([k], n))(*np.unique(keys[0], return_counts=True))
            else:
                keys, (ones,) = summed(keys, [np.ones(len(w), np.uint8)])
            places = parted(keys, order, len(words))
            u, w = (words[x.astype(np.int64)] for x in places[:2])
            rows = []
            for at, those in rows_by_shard(shard_of(u, w, shards), shards):
                own = [x[those].astype(np.int64) for x in places]
                used = np.zeros(len(words), dtype=bool)
                for x in own:
                    used[x] = True
                number = np.cumsum(used).astype(np.uint64) - np.uint64(1)
                known = words[used]
                rows.append((at, pack([known]), pack([*joined([number[x] for x in own], len(known)), ones[those]])))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))],
                ["shard", "words", "block"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                _, words, sizes = bigrams(texts_of(batch.slice(at, 512), 0))
                if held and held_tokens + len(words) > STRETCH:
                    yield flush()
                    held, held_tokens = [], 0
                held.append((words, sizes))
                held_tokens += len(words)
        if held:
            yield flush()

    def store_counts(name: str, key: np.ndarray, *values: np.ndarray) -> None:
        store(folder, name, table_arrays(key, list(values)))

    def add_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list] = {}
        for batch in batches:
            for shard, *block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks.setdefault(shard, []).append(block)
        for shard in list(blocks):
            own = [(unpack(told, 1)[0], *unpack(block, 2)) for told, block in blocks.pop(shard)]
            words, places = np.unique(np.concatenate([x[0] for x in own]), return_inverse=True)
            places, parts, start = places.astype(np.uint64), [], 0
            for told, keys, n in own:
                number = places[start:start + len(told)]
                start += len(told)
                parts.append((*joined([number[x.astype(np.int64)] for x in parted([keys], order, len(told))], len(words)), n))
            *keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            del own, parts
            keys, (n,) = summed(keys, [n])
            keys, rows, triples = parted(keys, order, len(words)), [], [0] * 5
            u, w = (words[x.astype(np.int64)] for x in keys[:2])
            used = raw = n
            if order == 3:
                t = words[keys[2].astype(np.int64)]
                context = scramble(t * PAIR + u)
                store_counts(f"triples-{shard}", scramble(context * TRIPLE + w), n)
                triples = [len(n), *((n == k).sum() for k in (1, 2, 3, 4))]
                (c,), sums = summed([context & CONTEXT_BITS], [n, n == 1, n == 2, n > 2])
                rows += [(4, at, block) for at, block in by_shard(
                    shard_of(c, None, shards), shards, [c >> CONTEXT_SHIFT, *sums])]
                # Sorted by pair: nothing comes before a start.
                heads = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (w[1:] != w[:-1])]))
                used = np.add.reduceat(np.where(u == START, n, np.uint64(1)), heads)
                raw, u, w = np.add.reduceat(n, heads), u[heads], w[heads]
                n = used
            store_counts(f"pairs-{shard}", scramble(u * PAIR + w), n)
            one = np.ones(len(n), np.uint32)
            (left,), sums = summed([w], [one, raw])
            (right,), more = summed([u], [n, (n == 1).astype(np.uint32), (n == 2).astype(np.uint32), (n > 2).astype(np.uint32)])
            rows += [(0, at, block) for at, block in by_shard(shard_of(left, None, shards), shards, [left, *sums])]
            rows += [(1, at, block) for at, block in by_shard(shard_of(right, None, shards), shards, [right, *more])]
            rows.append((2, shard, np.array([len(n), *((n == k).sum() for k in (1, 2, 3, 4)), *triples], dtype=np.int64).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.binary())], ["kind", "shard", "block"])

    def add_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, list] = {}
        contexts: dict[int, list] = {}
        facts = []
        for batch in batches:
            for kind, shard, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == 2:
                    facts.append((2, shard, block))
                    continue
                if kind == 4:
                    contexts.setdefault(shard, []).append(unpack(block, 5))
                    continue
                if kind == 0:
                    word, left, n = unpack(block, 3)
                    zero = np.zeros(len(word), np.int64)
                    row = (word, left.astype(np.int64), n.astype(np.int64), zero, zero, zero, zero)
                else:
                    word, *four = unpack(block, 5)
                    zero = np.zeros(len(word), np.int64)
                    row = (word, zero, zero, *(x.astype(np.int64) for x in four))
                blocks.setdefault(shard, []).append(row)
        for shard, parts in blocks.items():
            word, *values = (np.concatenate(x) for x in zip(*parts, strict=True))
            (word,), values = summed([word], values)
            values = [v.astype(np.int64) for v in values]
            store_counts(f"words-{shard}", word << WORD_SHIFT, *values)
            left, count = values[0], values[1]
            facts.append((3, shard, np.array(
                [len(word), (left > 0).sum(), left.sum(), count.sum(), *((left == k).sum() for k in (1, 2, 3, 4)),
                 (left > 2).sum()], dtype=np.int64).tobytes()))
        for shard in list(contexts):
            key, *values = (np.concatenate(x) for x in zip(*contexts.pop(shard), strict=True))
            (key,), values = summed([key], values)
            # A pair that is followed once needs no row; the start of a text is no pair.
            key <<= CONTEXT_SHIFT
            several = (values[0] > 1) | (key == scramble(START * PAIR + START) & CONTEXT_BITS)
            if several.any():
                store_counts(f"contexts-{shard}", key[several], *(v[several] for v in values))
                facts.append((4, shard, b""))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in facts], pa.int32()), pa.array([r[1] for r in facts], pa.int64()),
             pa.array([r[2] for r in facts], pa.binary())], ["kind", "shard", "block"])

    packed = texts.select(column).mapInArrow(count, "shard long, words binary, block binary")
    kind = "kind int, shard long, block binary"
    partial = packed.repartitionById(int(shards), F.col("shard").cast("int")).mapInArrow(add_pairs, kind)
    facts = partial.repartitionById(int(shards), F.col("shard").cast("int")).mapInArrow(add_words, kind).collect()  # one row per file
    pair_facts = {r.shard: np.frombuffer(r.block, np.int64) for r in facts if r.kind == 2}
    word_facts = {r.shard: np.frombuffer(r.block, np.int64) for r in facts if r.kind == 3}
    sums = np.sum(list(pair_facts.values()), axis=0).tolist() if pair_facts else [0] * 10
    (distinct, *ns), (triples, *ms) = sums[:5], sums[5:]
    _, known, lefts, tokens, n1, n2, n3, n4, more = np.sum(list(word_facts.values()), axis=0).tolist() if word_facts else [0] * 9
    unigram = Level.of(n1, n2, n3, n4)
    saved = unigram.one * n1 + unigram.two * n2 + unigram.more * more
    return Model(folder, int(shards), tuple(sorted(pair_facts)), tuple(sorted(word_facts)), Level.of(*ns), unigram,
                 int(distinct), int(tokens), int(known), saved / lefts if lefts else 1.0, order,
                 tuple(sorted(r.shard for r in facts if r.kind == 4)), Level.of(*ms), int(triples))


class Reader:
    """A model's files, mapped as they are first needed."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.tables: dict[str, Table] = {}

    def table(self, name: str) -> Table:
        if name not in self.tables:
            self.tables[name] = Table(mapped(self.model.folder, name))
        return self.tables[name]

    def look_up(self, kind: str, keys: np.ndarray, shard: np.ndarray, there: tuple[int, ...], width: int = 1) -> np.ndarray:
        """Values of sorted distinct keys, zero where a key is absent."""
        found = np.zeros((width, len(keys)), dtype=np.int64)
        for at, rows in rows_by_shard(shard, self.model.shards):
            if at in there:
                found[:, rows] = self.table(f"{kind}-{at}").find(keys[rows])
        return found

    def logs(self, texts: list[str]):
        """log10 P of each token, its count, its number of left neighbours, and tokens by text."""
        model = self.model
        context, word, sizes = bigrams(texts)
        key = scramble(context * PAIR + word)
        distinct, first, back = np.unique(key, return_index=True, return_inverse=True)
        counts = self.look_up("pairs", distinct, shard_of(context[first], word[first], model.shards), model.pairs)[0][back]
        names, place = np.unique(np.concatenate([word, context]), return_inverse=True)
        facts = self.look_up(
            "words", names << WORD_SHIFT, shard_of(names, None, model.shards), model.words, len(WORD_COLUMNS))
        own, ahead = facts[:, place[:len(word)]], facts[:, place[len(word):]]
        left, known = own[0], own[1]
        lefts = max(model.distinct_pairs, 1)
        lower = np.maximum(left - model.unigram.discount(left), 0) / lefts + model.unigram_weight / (model.vocabulary + 1)
        follow, one, two, more = ahead[2:]
        saved = model.bigram.one * one + model.bigram.two * two + model.bigram.more * more
        seen = np.maximum(follow, 1)
        upper = np.maximum(counts - model.bigram.discount(counts), 0) / seen
        p = np.where(follow > 0, upper + saved / seen * lower, lower)
        if model.order == 3:
            first = before(context, sizes)
            seen_before = np.concatenate([[0], counts[:-1]]) > 0
            seen_before[np.cumsum(sizes) - sizes] = False
            pair = scramble(first * PAIR + context)
            distinct, at, back = np.unique(scramble(pair * TRIPLE + word), return_index=True, return_inverse=True)
            counts = self.look_up("triples", distinct, shard_of(context[at], word[at], model.shards), model.pairs)[0][back]
            distinct, back = np.unique(pair & CONTEXT_BITS, return_inverse=True)
            follow, one, two, more = self.look_up(
                "contexts", distinct, shard_of(distinct, None, model.shards), model.contexts, 4)[:, back]
            once = seen_before & (follow == 0)
            follow, one = follow + once, one + once
            saved = model.trigram.one * one + model.trigram.two * two + model.trigram.more * more
            seen = np.maximum(follow, 1)
            upper = np.maximum(counts - model.trigram.discount(counts), 0) / seen
            p = np.where(follow > 0, upper + saved / seen * p, p)
        return np.log10(np.maximum(p, 1e-300)), known, sizes


_readers: dict[str, Reader] = {}


def reader_of(model: Model) -> Reader:
    """One reader per model in a worker."""
    if model.folder not in _readers:
        _readers.clear()
        _readers[model.folder] = Reader(model)
    return _readers[model.folder]


def score(df: DataFrame, model: Model, column: str = "text", keep: bool = True) -> DataFrame:
    """Add ``n_tokens``, ``n_known``, ``base_score`` (add-half unigrams) and ``score``, all in log10."""
    place = df.columns.index(column)
    kept = [i for i in range(len(df.columns)) if keep or i != place]
    added = [StructField("n_tokens", LongType()), StructField("n_known", LongType()),
             StructField("base_score", DoubleType()), StructField("score", DoubleType())]

    def start():
        files = reader_of(model)
        bottom = model.tokens + 0.5 * (model.vocabulary + 1)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            logs, known, sizes = files.logs(texts_of(batch, place))
            heads = np.cumsum(sizes) - sizes
            base = np.log10((known + 0.5) / bottom)
            columns = [sizes, np.add.reduceat((known > 0).astype(np.int64), heads), np.add.reduceat(base, heads),
                       np.add.reduceat(logs, heads)]
            rest = batch.select(kept)
            return pa.RecordBatch.from_arrays(
                [*rest.columns, *(pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.float64()] * 2, strict=True))],
                [*rest.schema.names, "a", "b", "c", "d"])

        return work

    return map_slices(df, StructType([*(df.schema.fields[i] for i in kept), *added]), start)
