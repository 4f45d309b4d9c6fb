"""Removal of long repeated byte strings, by bucket-pointer refinement.

A bucket is a set of places that start with the same bytes, and its identifier
stands for those bytes.  The first buckets are of 8 bytes, exactly.  Pairing a
place's identifier with the one at a later offset gives the identifier of twice
the length, and the pairs are reused for the next step: 8, 16, 32, 64 bytes, then
any length up to the window by overlapping identifiers.  Identifiers are 64-bit
hashes of such pairs, so they mean the same in every task without a global sort.

Not every place goes through the shuffle.  In a window of 200 bytes the 64-byte
string with the smallest identifier (leftmost among equals) is its anchor; equal
windows have equal anchors at equal offsets, and windows next to one another mostly
share one, so one row stands for a run of windows (about 69).  Buckets are then
refined in three rounds:

1. runs by their anchor's bucket; buckets with one place are finished;
2. what is left, in pieces of 16 windows, by the 185 bytes that all windows of a piece share;
3. what is left, single windows, by all their 200 bytes.

In every round, places of a bucket whose whole stretch is equal (two identifiers, 128
bits) are repeats and finished; a bucket in which stretches differ goes on to the
next round with one place for each distinct stretch.  So long copies are settled by
few rows, and only the edges of repeats are looked at window by window.

Defined results: a null text is empty; texts shorter than the window lose nothing;
equal texts are repeats of one another; repeated rows likewise; other columns pass
through, names the operator adds are refused if taken; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from sluicework.llm.common import SLICE_ROWS, small_batches
from sluicework.session import ship_package, through_storage

# Bytes of the first buckets that are shuffled, and windows of a piece in the second round.
SEED = 64
PIECE = 16
# Odd constants of the pairing hash; any would do.
PAIRING = tuple(np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
PLACES = (1 << 31) - 1
ROWS = "bucket long, region long, key long, place long"
ADDED = ("n_bytes", "n_removed", "n_spans", "kept")
# A place: 24 bits of a second hash of the text, where a stretch of windows starts, how many windows it has.
TAG, START, COUNT = 40, 8, (1 << 8) - 1


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The identifier of two identifiers in a row."""
    out = left * PAIRING[0] + (right ^ (right >> np.uint64(32))) * PAIRING[1]
    out ^= out >> np.uint64(29)
    out *= PAIRING[2]
    out ^= out >> np.uint64(32)
    return out


def seed_ids(data: np.ndarray) -> np.ndarray:
    """The identifier of the ``SEED`` bytes at every place of a text of at least as many bytes."""
    ids = np.empty(len(data) - 7, dtype=np.uint64)
    for at in range(8):
        count = (len(data) - at) // 8
        ids[at::8] = data[at:at + 8 * count].view("<u8")
    width = 8
    while width < SEED:
        ids = pair(ids[:-width], ids[width:])
        width *= 2
    return ids


def stretch_ids(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, longest: int, lane: int = 0) -> np.ndarray:
    """The identifiers of stretches of ``SEED`` to ``longest`` bytes, from the identifiers at offsets that cover them."""
    out = lengths.astype(np.uint64) + np.uint64(lane << 32)
    for at in range(0, longest, SEED):
        out = pair(out, ids[starts + np.minimum(at, lengths - SEED)])
    return out


def anchored(ids: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` places, the place of its smallest identifier, the leftmost among equals."""
    low = (ids & ~np.uint64(PLACES)) | np.arange(len(ids), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
    return (low & np.uint64(PLACES)).astype(np.int64)


def row_block(bucket: np.ndarray, region: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple:
    return bucket.view(np.int64), region.view(np.int64), starts << START | (counts - 1)


def anchor_runs(ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows) of every run of windows with one anchor."""
    anchors = anchored(ids, window - SEED + 1)
    starts = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    return anchors[starts], starts, np.diff(np.append(starts, len(anchors)))


def first_round(ids: np.ndarray, window: int, _: np.ndarray) -> tuple:
    """Rows of the runs of a text."""
    anchors, starts, counts = anchor_runs(ids, window)
    stretch = pair(stretch_ids(ids, starts, counts - 1 + window, 2 * window - SEED),
                   ((anchors - starts) << 8 | counts).astype(np.uint64))
    return row_block(ids[anchors], stretch, starts, counts)


def second_round(ids: np.ndarray, window: int, places: np.ndarray) -> tuple:
    """Rows of the pieces of runs: pieces are cut by their distance from the anchor, whatever the run's ends."""
    starts, counts = places >> START, (places & COUNT) + 1
    anchors, firsts, _ = anchor_runs(ids, window)
    anchors = anchors[np.searchsorted(firsts, starts, side="right") - 1]
    low, high = (anchors - starts - counts + 1) // PIECE, (anchors - starts) // PIECE
    times = high - low + 1
    of = np.repeat(np.arange(len(starts)), times)
    block = low[of] + np.arange(len(of)) - (np.cumsum(times) - times)[of]
    core = anchors[of] - block * PIECE
    begin = np.maximum(starts[of], core - PIECE + 1)
    count = np.minimum(starts[of] + counts[of] - 1, core) - begin + 1
    shared = np.full(len(of), window - PIECE + 1)
    bucket = pair(stretch_ids(ids, core, shared, window), block.astype(np.uint64))
    stretch = pair(stretch_ids(ids, begin, count - 1 + window, window + PIECE), ((core - begin) << 8 | count).astype(np.uint64))
    return row_block(bucket, stretch, begin, count)


def third_round(ids: np.ndarray, window: int, places: np.ndarray) -> tuple:
    """Rows of single windows."""
    starts, counts = places >> START, (places & COUNT) + 1
    of = np.repeat(np.arange(len(starts)), counts)
    each = starts[of] + np.arange(len(of)) - (np.cumsum(counts) - counts)[of]
    whole = np.full(len(each), window)
    return row_block(stretch_ids(ids, each, whole, window), stretch_ids(ids, each, whole, window, 1), each, np.ones_like(each))


def refined(texts: DataFrame, window: int, rows_of: Callable[..., tuple]) -> DataFrame:
    """(bucket, region, key, place) of (key, tag, text, places): the rows of one round."""
    ship_package(texts.sparkSession)
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS // 4):
                batch = whole.slice(at, SLICE_ROWS // 4)
                keys, tags = (batch.column(i).to_numpy() for i in (0, 1))
                lists = batch.column(3) if batch.num_columns > 3 else None
                out = []
                for i, text in enumerate(batch.column(2)):
                    data = np.frombuffer(text.as_py() or b"", dtype=np.uint8)
                    if len(data) < window:
                        continue
                    places = lists[i].values.to_numpy() & ((1 << TAG) - 1) if lists is not None else None
                    bucket, region, place = rows_of(seed_ids(data), window, places)
                    out.append((bucket, region, np.full(len(place), keys[i]), place | tags[i] << TAG))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["bucket", "region", "key", "place"])

    return texts.mapInArrow(run, ROWS)


def settled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((key, place) of repeats, (key, place) that go on): one round's rows, compared.

    ``rows`` is read twice: once for the buckets' sizes, once for the rows of buckets with more than one place.
    """
    several = through_storage(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "buckets")
    alike = through_storage(rows.join(several, "bucket"), "bucket-rows")
    regions = through_storage(alike.groupBy("bucket", "region").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("one")), "regions")
    repeats = alike.join(regions.where("n > 1").select("bucket", "region"), ["bucket", "region"]).select("key", "place")
    mixed = regions.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("bucket")
    return repeats, regions.join(mixed, "bucket").select("one.key", "one.place")


def per_text(places: DataFrame) -> DataFrame:
    """(key, tag, places): the places of a text together; a text has as many as it has windows at most."""
    return places.groupBy("key", F.shiftrightunsigned("place", TAG).alias("tag")).agg(F.collect_list("place").alias("places"))


def keyed_texts(df: DataFrame, column: str, *others: Column) -> DataFrame:
    text = F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")
    return df.select(F.xxhash64(text).alias("key"), F.shiftrightunsigned(F.xxhash64(F.lit(1), text), TAG).alias("tag"),
                     text.alias("text"), *others)


def repeated_places(df: DataFrame, column: str, window: int = 200) -> DataFrame:
    """(key, place): stretches of windows that also start elsewhere, by the hashes of their text."""
    texts = keyed_texts(df, column)
    repeats, left = settled(refined(texts, window, first_round))
    # Texts with something left to compare, stored once for both rounds.
    few = through_storage(texts.join(per_text(left), ["key", "tag"]).select("key", "tag", "text", "places"), "texts")
    more, left = settled(through_storage(refined(few, window, second_round), "pieces"))
    last = through_storage(refined(few.drop("places").join(per_text(left), ["key", "tag"]).select(
        "key", "tag", "text", "places"), window, third_round), "windows")
    rest, _ = settled(last)
    return repeats.unionByName(more).unionByName(rest)


def without_repeats(df: DataFrame, column: str, window: int = 200) -> DataFrame:
    """Replace a text column by what stays of it: ``n_bytes, n_removed, n_spans`` and ``kept`` (binary).

    Every byte that lies in a string of ``window`` bytes that also starts elsewhere, in this text or another, goes;
    ``n_spans`` counts the runs removed.  All is judged on the texts as given.  ``window`` is 80 to 319.
    """
    if not SEED + PIECE <= window <= SEED + COUNT:
        raise ValueError(f"windows have {SEED + PIECE} to {SEED + COUNT} bytes")
    rest = [name for name in df.columns if name != column]
    if taken := {name.lower() for name in rest} & set(ADDED):
        raise ValueError(f"columns exist already: {', '.join(sorted(taken))}")
    found = through_storage(per_text(repeated_places(df, column, window)), "repeats")
    texts = keyed_texts(df, column, F.struct(F.lit(0).alias("_"), *[F.col(f"`{name}`") for name in rest]).alias("row"))
    joined = texts.join(found, ["key", "tag"], "left").select("row", "text", "places")
    schema = StructType([joined.schema["row"], *(StructField(name, LongType()) for name in ADDED[:3]), StructField("kept", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS // 4):
                batch = whole.slice(start, SLICE_ROWS // 4)
                cuts = [cut(text.as_py(), places.values.to_numpy() if places.is_valid else None, window)
                        for text, places in zip(batch.column(1), batch.column(2), strict=True)]
                numbers = np.array([c[:3] for c in cuts], dtype=np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(numbers[:, i]) for i in range(3)), pa.array([c[3] for c in cuts], pa.binary())],
                    schema.names)

    return joined.mapInArrow(run, schema).select(*[f"row.`{name}`" for name in rest], *ADDED)


def cut(data: bytes, places: np.ndarray | None, window: int) -> tuple[int, int, int, bytes]:
    """(bytes, bytes removed, runs removed, what stays) of a text and the windows in it that repeat."""
    if places is None or not len(places):
        return len(data), 0, 0, data
    places = np.sort(places & ((1 << TAG) - 1))
    starts = places >> START
    ends = np.maximum.accumulate(starts + (places & COUNT) + window)
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    begin, end = starts[new], ends[np.append(np.flatnonzero(new)[1:], len(ends)) - 1]
    kept = b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(data)], strict=True))
    return len(data), int((end - begin).sum()), len(begin), kept
