"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

A text is cut by the vocabulary's pattern; each piece is merged on its own.
The leaves of a piece's segment tree are its byte positions.  A leaf holds the
rank of the pair that starts at that position together with the position, so
the root is the lowest rank and, among equals, the leftmost pair.  A merge
removes one position from a linked list of live ones and updates the two leaves
whose pair changed: O(log n) work for a merge, O(n log n) for a piece however
long it is.

Defined results: a null text is the empty text and has no ids; repeated rows
stay repeated; other columns pass through; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from sluicework.llm.common import map_slices, texts_of

# Above any packed (rank, position); ranks stay below 2**30, positions below 2**32.
NOTHING = 1 << 62
# Distinct pieces a worker remembers; beyond it the memory starts anew, results do not change.
REMEMBERED = 150_000
# Characters, about, that are cut into pieces at a time; bounds a worker's memory, not its result.
CUT_TOGETHER = 200_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: merge the leftmost pair of lowest rank until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    count = len(piece)
    width = 1
    while width < count:
        width *= 2
    # ends[i]: where the live token that starts at i ends; before[i]: the live start left of it.
    ends = list(range(1, count + 1))
    before = list(range(-1, count - 1))
    tree = [NOTHING] * (2 * width)
    for at in range(count - 1):
        rank = ranks.get(piece[at:at + 2])
        if rank is not None:
            tree[width + at] = rank << 32 | at
    for node in range(width - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right

    def put(at: int, key: int) -> None:
        node = width + at
        tree[node] = key
        while node > 1:
            other = tree[node ^ 1]
            low = key if key < other else other
            node >>= 1
            if tree[node] == low:
                return
            tree[node] = key = low

    def pair_key(at: int) -> int:
        middle = ends[at]
        if middle >= count:
            return NOTHING
        rank = ranks.get(piece[at:ends[middle]])
        return NOTHING if rank is None else rank << 32 | at

    while tree[1] != NOTHING:
        at = tree[1] & 0xFFFFFFFF
        gone = ends[at]
        ends[at] = ends[gone]
        if ends[at] < count:
            before[ends[at]] = at
        put(gone, NOTHING)
        put(at, pair_key(at))
        if before[at] >= 0:
            put(before[at], pair_key(before[at]))
    ids = []
    at = 0
    while at < count:
        ids.append(ranks[piece[at:ends[at]]])
        at = ends[at]
    return ids


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys (left id, right id) of all pairs that make a token, and that token's rank."""
    keys, values = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                keys.append(left << 32 | right)
                values.append(rank)
    order = np.argsort(np.array(keys, dtype=np.int64))
    return np.array(keys, dtype=np.int64)[order], np.array(values, dtype=np.int64)[order]


def merge_rows(texts: list[bytes], byte_ids: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """``merge_piece`` for many short pieces at once: one segment tree in each row of a matrix.

    Every step takes the root of each row that still has a pair to merge, merges
    it and climbs from the three leaves it touched, level by level.
    """
    keys, values = table

    def leaf(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[place] == wanted, values[place] << 32 | at, NOTHING)

    count, longest = len(texts), max(map(len, texts))
    width = 1 << max(1, (longest - 1).bit_length())
    sizes = np.array([len(t) for t in texts])
    inside = np.arange(width) < sizes[:, None]
    ids = np.full((count, width), -1, dtype=np.int64)
    ids[inside] = byte_ids[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    # Column ``width`` stands for "none" on either side.
    after = np.minimum(np.arange(width) + 1, sizes[:, None])
    after[after == sizes[:, None]] = width
    before = np.tile(np.arange(-1, width), (count, 1))
    tree = np.full((count, 2 * width), NOTHING, dtype=np.int64)
    row, at = np.nonzero(after < width)
    tree[row, width + at] = leaf(ids[row, at], ids[row, at + 1], at)
    for node in range(width - 1, 0, -1):
        np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
    row = np.arange(count)
    while True:
        root = tree[row, 1]
        row, root = row[root != NOTHING], root[root != NOTHING]
        if not len(row):
            break
        at = root & 0xFFFFFFFF
        gone = after[row, at]
        follows, leads = after[row, gone], before[row, at]
        ids[row, at], ids[row, gone] = root >> 32, -1
        after[row, at] = follows
        before[row, follows] = at
        tree[row, width + gone] = NOTHING
        has = follows < width
        tree[row, width + at] = np.where(has, leaf(ids[row, at], ids[row, np.where(has, follows, 0)], at), NOTHING)
        has = leads >= 0
        there, left = row[has], leads[has]
        tree[there, width + left] = leaf(ids[there, left], ids[there, at[has]], left)
        climb, nodes = np.concatenate([row, row, there]), np.concatenate([gone, at, left]) + width
        while nodes[0] > 1:
            nodes >>= 1
            tree[climb, nodes] = np.minimum(tree[climb, 2 * nodes], tree[climb, 2 * nodes + 1])
    kept = ids >= 0
    return np.split(ids[kept].astype(np.int32), np.cumsum(kept.sum(1))[:-1])


def stretches(texts: list[str], chars: int) -> Iterator[list[str]]:
    """The texts in order, in lists that end once they have so many characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


@lru_cache(maxsize=2)
def shared_encoder(path: str, pattern: str) -> Encoder:
    """One encoder for all tasks a worker runs, so that what it has learnt stays."""
    return Encoder(path, pattern)


class Encoder:
    """Texts to ids; remembers the pieces it has met.  Pieces up to ``TOGETHER`` bytes merge side by side."""

    TOGETHER = 32

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = load_ranks(path)
        self.table = pair_table(self.ranks)
        self.pieces = regex.compile(pattern)
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            text = piece.encode()
            rank = self.ranks.get(text)
            if rank is not None:
                self.known[piece] = np.int32(rank).tobytes()
            elif len(text) > self.TOGETHER:
                self.known[piece] = np.array(merge_piece(text, self.ranks), dtype=np.int32).tobytes()
            else:
                by_width.setdefault((len(text) - 1).bit_length(), []).append((piece, text))
        for group in by_width.values():
            for (piece, _), ids in zip(group, merge_rows([t for _, t in group], self.byte_ids, self.table), strict=True):
                self.known[piece] = ids.tobytes()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [ids for some in stretches(texts, CUT_TOGETHER) for ids in self.ids_of(some)]

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.pieces.findall(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.learn({piece for pieces in cut for piece in pieces} - self.known.keys())
        return [np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), dtype=np.int32) for pieces in cut]


def with_list(batch: pa.RecordBatch, lists: list[np.ndarray]) -> pa.RecordBatch:
    """A batch with one more column of id lists."""
    offsets = np.zeros(len(lists) + 1, dtype=np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.concatenate(lists) if lists else np.zeros(0, dtype=np.int32)
    column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int32()))
    return pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "ids"])


def encode(df: DataFrame, column: str, rank_file: str, pattern: str, output: str = "token_ids",
           keep: bool = True) -> DataFrame:
    """Add the token ids of a text column.  ``rank_file`` must exist on every worker.

    ``keep=False`` leaves the text out of the result.
    """
    place = df.columns.index(column)
    kept = [i for i in range(len(df.columns)) if keep or i != place]

    def start():
        ids_of = shared_encoder(rank_file, pattern)
        return lambda batch: with_list(batch.select(kept), ids_of(texts_of(batch, place)))

    return map_slices(df, StructType([*(df.schema.fields[i] for i in kept), StructField(output, ArrayType(IntegerType()))]), start)


@lru_cache(maxsize=2)
def shared_tokens(path: str) -> pa.Array:
    """The bytes of every token by rank, once for all tasks a worker runs."""
    ranks = load_ranks(path)
    token = [b""] * (max(ranks.values(), default=-1) + 1)
    for text, rank in ranks.items():
        token[rank] = text
    return pa.array(token, type=pa.binary())


def with_bytes(batch: pa.RecordBatch, place: int, tokens: pa.Array) -> pa.RecordBatch:
    """A batch with one more column: the bytes of a column of id lists."""
    lists = batch.column(place)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    # The taken tokens lie one after the other: a text is a stretch of them.
    taken = tokens.take(lists.flatten())
    ends = np.frombuffer(taken.buffers()[1], dtype=np.int32, count=len(taken) + 1)
    cuts = ends[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])].astype(np.int32)
    texts = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(cuts), taken.buffers()[2]])
    return pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "bytes"])


def decode(df: DataFrame, column: str, rank_file: str, output: str = "decoded") -> DataFrame:
    """Add the bytes that a column of token ids stands for; null ids give no bytes."""
    place = df.columns.index(column)

    def start():
        tokens = shared_tokens(rank_file)
        return lambda batch: with_bytes(batch, place, tokens)

    return map_slices(df, StructType([*df.schema.fields, StructField(output, BinaryType())]), start)


def round_trip(df: DataFrame, column: str, rank_file: str, pattern: str, output: str = "token_ids",
               decoded: str = "decoded", keep: bool = True) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass: a task has one Python worker, not two with a vocabulary each."""
    place = df.columns.index(column)
    kept = [i for i in range(len(df.columns)) if keep or i != place]
    added = [StructField(output, ArrayType(IntegerType())), StructField(decoded, BinaryType())]

    def start():
        ids_of, tokens = shared_encoder(rank_file, pattern), shared_tokens(rank_file)
        return lambda batch: with_bytes(with_list(batch.select(kept), ids_of(texts_of(batch, place))), len(kept), tokens)

    return map_slices(df, StructType([*(df.schema.fields[i] for i in kept), *added]), start)
