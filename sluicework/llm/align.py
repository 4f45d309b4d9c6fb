"""Alignment of two tokenizers over the same texts, by diagonal run skipping.

Both encodings of a text tile the same bytes, so each is an increasing array of
token ends, and a group closes wherever both arrays hold the same end.  The walk
keeps two indexes; their difference is the current shift.  While ends agree at
that shift, a probe that doubles compares ever longer slices of both arrays and
jumps them whole; the slice that no longer agrees is halved until the first end
that differs.  There the walk goes token by token to the next common end, which
closes one irregular group and gives the new shift.

A link is a pair of tokens whose bytes overlap; the bytes between neighbouring ends
of either array are of one token on each side, which are linked.  The walk gives the
irregular groups; the text of the groups and the links are then written for all tokens
of a text at once.  How common a pair of ids is, is counted in Spark: every
text keeps its distinct pairs, texts are dealt into slices of a bounded number
of pairs as they are written, pairs are counted per slice and summed over all,
and each slice gets back the sums of its own pairs only.

Defined results: a null or empty text, and a text that either tokenizer does not
give back byte by byte, has no tokens: counts are zero and its groups are the empty
text.  Repeated rows are texts of their own; other columns pass through, and a
column that already bears the name of the output is refused; an empty table gives
an empty one.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from sluicework.llm.common import SLICE_ROWS, small_batches
from sluicework.session import ship_package, through_storage

# Pairs a slice of texts holds, about; bounds the memory of the tasks that count and look up, not the result.
SLICE_PAIRS = 1_000_000
# A pair of ids as one number.
SHIFT = 32
# Stretches of text a worker remembers the tokens of; beyond it the memory starts anew, results do not change.
REMEMBERED = 400_000
# Where both kinds of vocabulary always cut: before a space between anything but white space and more text.
CUT = re.compile(r"(?<=\S) (?!\Z)")
# In a text without it, every space but one at either end is a cut.
AFTER_SPACE = re.compile(r"\s ")

ALIGNED = StructType([
    *(StructField(name, LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")), StructField("groups", StringType()),
    StructField("pairs", ArrayType(LongType())), StructField("times", ArrayType(IntegerType())),
    StructField("slice", LongType())])

# What with_counts adds.
SCORED = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteLevel:
    """A byte-level vocabulary file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        splits = told.get("pre_tokenizer") or {}
        self.cuts = not told.get("normalizer") and splits.get("type") == "ByteLevel" and splits.get("use_regex") is True
        letters = byte_letters()
        entries = self.model.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(entries.values(), default=-1) + 1)
        for entry, place in entries.items():
            self.bytes[place] = bytes(map(letters.__getitem__, entry)) if all(c in letters for c in entry) else entry.encode()

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model; it puts the space before a text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.model.get_piece_size())]
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.cuts = not any("▁" in piece.lstrip("▁") for piece in pieces) and self.plain()

    def plain(self) -> bool:
        """True if the model is known to leave texts as they are before it cuts them."""
        try:
            from sentencepiece import sentencepiece_model_pb2
        except ImportError:
            return False
        told = sentencepiece_model_pb2.ModelProto.FromString(self.model.serialized_model_proto()).normalizer_spec
        return not told.precompiled_charsmap and not told.remove_extra_whitespaces and told.add_dummy_prefix

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Encodings:
    """The ids of texts by both tokenizers; no ids where either does not give a text back.

    Where both are known never to join what a cut parts, each part is encoded alone and remembered.
    """

    def __init__(self, a_file: str, b_file: str) -> None:
        self.a, self.b = ByteLevel(a_file), Pieces(b_file)
        self.cuts = self.a.cuts and self.b.cuts
        self.sizes = tuple(np.array([len(t) for t in side.bytes], dtype=np.int64) for side in (self.a, self.b))
        self.forget()

    def forget(self) -> None:
        # The number of a part, and by either tokenizer the ids of all parts in that order and where those of each stop.
        self.known: dict[str, int] = {}
        self.ids = [np.zeros(0, dtype=np.int32)] * 2
        self.stops = [np.zeros(1, dtype=np.int64)] * 2
        # Parts that one tokenizer does not give back.
        self.lost: set[str] = set()

    def remember(self, parts: list[str], found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts)), strict=True))
        for side, (ids, stops) in enumerate(found):
            self.ids[side] = np.concatenate([self.ids[side], ids])
            self.stops[side] = np.concatenate([self.stops[side], self.stops[side][-1] + stops])

    def together(self, side: int, parts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of parts that stand in one text, and where each part's stop; None if they do not tile it.

        One call is faster than one for each.
        """
        encoder, text = (self.a, self.b)[side], " ".join(parts)
        ids = np.array(encoder([f" {text}" if side == 0 else text])[0], dtype=np.int32)
        ends = np.concatenate([[0], np.cumsum(self.sizes[side][ids])])
        wanted = np.cumsum([len(part.encode()) + 1 for part in parts])
        stops = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
        if (ends[stops] != wanted).any() or b"".join(map(encoder.bytes.__getitem__, ids.tolist())) != f" {text}".encode():
            return None
        return ids, stops

    def learn(self, parts: set[str]) -> None:
        new = list(parts - self.known.keys())
        # A cut divides these from what follows.
        inner = [part for part in new if self.cuts and part and not part[-1].isspace() and "▁" not in part]
        found = [self.together(side, inner) if inner else None for side in (0, 1)]
        if found[0] is not None and found[1] is not None:
            self.remember(inner, found)
            new = list(parts - self.known.keys())
        if not new:
            return
        alone = self.a([f" {part}" for part in new]), self.b(new)
        for part, ids_a, ids_b in zip(new, *alone, strict=True):
            source = f" {part}".encode()
            if not b"".join([self.a.bytes[i] for i in ids_a]) == source == b"".join([self.b.bytes[i] for i in ids_b]):
                self.lost.add(part)
        self.remember(new, [
            (np.array([*chain.from_iterable(x)], dtype=np.int32), np.cumsum([len(ids) for ids in x])) for x in alone])

    def parts(self, text: str) -> list[str]:
        if not text or not self.cuts:
            return [text] if text else []
        return CUT.split(text) if text[0] == " " or text[-1] == " " or AFTER_SPACE.search(text) else text.split(" ")

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(self.known) > REMEMBERED:
            self.forget()
        cut = [self.parts(text) for text in texts]
        self.learn(set(chain.from_iterable(cut)))
        if self.lost:
            cut = [[] if not self.lost.isdisjoint(parts) else parts for parts in cut]
        stops = np.cumsum([0, *map(len, cut)])
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=int(stops[-1]))
        sides = []
        for ids, ends in zip(self.ids, self.stops, strict=True):
            sizes = ends[numbers + 1] - ends[numbers]
            before = np.concatenate([[0], np.cumsum(sizes)])
            whole = ids[np.repeat(ends[numbers] - before[:-1], sizes) + np.arange(before[-1])]
            sides.append((whole, before[stops].tolist()))
        (ids_a, at_a), (ids_b, at_b) = sides
        for i in range(len(texts)):
            yield ids_a[at_a[i]:at_a[i + 1]], ids_b[at_b[i]:at_b[i + 1]]


@lru_cache(maxsize=1)
def shared_encodings(a_file: str, b_file: str) -> Encodings:
    """One pair of encoders for all tasks a worker runs, so that what it has learnt stays."""
    return Encodings(a_file, b_file)


def diagonal_groups(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(a, b, a_stop, b_stop) of each stretch of one-to-one groups and of each irregular group, in order.

    Both arrays increase and have the same last end.  An irregular group has more
    than one token on a side; a stretch has as many on either.
    """
    a = b = 0
    count = len(ends_a)
    while a < count:
        if ends_a[a] == ends_b[b]:
            at, shift, step = a + 1, b - a, 1
            last = min(count, len(ends_b) - shift)
            # The first probe is of one end; most stretches are short.
            if at < last and ends_a[at] == ends_b[at + shift]:
                at += 1
                step = 2
                while at + step <= last and ends_a[at:at + step] == ends_b[at + shift:at + shift + step]:
                    at += step
                    step *= 2
                # Somewhere in the next ``step`` ends the arrays part, or one of them ends.
                while step > 1:
                    step //= 2
                    if at + step <= last and ends_a[at:at + step] == ends_b[at + shift:at + shift + step]:
                        at += step
            yield a, b, at, at + shift
            a, b = at, at + shift
        else:
            p, q = a, b
            while ends_a[p] != ends_b[q]:
                if ends_a[p] < ends_b[q]:
                    p += 1
                else:
                    q += 1
            yield a, b, p + 1, q + 1
            a, b = p + 1, q + 1


def names_of(count_a: int, count_b: int) -> np.ndarray:
    """How each id is written in the text of the groups, inside its group and as the last of its side: rows of bytes."""
    names = np.array(
        [f"{i}{mark}" for count, last in ((count_a, "|"), (count_b, ";")) for i in range(count) for mark in (",", last)], dtype="S")
    return names.view(np.uint8).reshape(len(names), -1)


def lasts(starts: np.ndarray, stops: np.ndarray, count: int) -> np.ndarray:
    """True for the tokens that close a group: all but those inside the given irregular ones."""
    steps = np.zeros(count + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, stops - 1, -1)
    return np.cumsum(steps[:count]) == 0


def align_ids(
    ids: tuple[np.ndarray, np.ndarray], sizes: tuple[np.ndarray, np.ndarray], names: np.ndarray,
) -> tuple[int, str, np.ndarray, np.ndarray]:
    """(groups, the groups as text, the A id and the B id of every link) of two encodings of the same bytes."""
    ids_a, ids_b = ids
    if not len(ids_a):
        return 0, "", ids_a, ids_b
    ends_a, ends_b = (np.cumsum(size[x]) for size, x in zip(sizes, ids, strict=True))
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    irregular = np.array(
        [walked for walked in diagonal_groups(list_a, list_b) if list_a[walked[0]] != list_b[walked[1]]],
        dtype=np.int64).reshape(-1, 4)
    last_a = lasts(irregular[:, 0], irregular[:, 2], len(ids_a))
    last_b = lasts(irregular[:, 1], irregular[:, 3], len(ids_b))
    # A group is its A ids, then its B ids: before a token of B stand the A ids of its group too.
    closed_a, closed_b = np.flatnonzero(last_a) + 1, np.concatenate([[0], np.flatnonzero(last_b) + 1])
    written = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    written[np.arange(len(ids_a)) + closed_b[np.cumsum(last_a) - last_a]] = 2 * ids_a.astype(np.int64) + last_a
    written[np.arange(len(ids_b)) + closed_a[np.cumsum(last_b) - last_b]] = 2 * (ids_b.astype(np.int64) + len(sizes[0])) + last_b
    letters = names[written]
    ended = np.zeros(list_a[-1] + 1, dtype=bool)
    ended[ends_a] = ended[ends_b] = True
    ends = np.flatnonzero(ended)
    return (len(closed_a), letters[letters != 0][:-1].tobytes().decode(),
            ids_a[np.searchsorted(ends_a, ends)], ids_b[np.searchsorted(ends_b, ends)])


def align(df: DataFrame, column: str, a_file: str, b_file: str, output: str = "aligned", keep: bool = True) -> DataFrame:
    """Add a struct with the alignment of each text by tokenizers A (byte-level) and B (pieces).

    ``n_a, n_b, n_groups, n_links``; ``groups`` is ``a1,a2|b1;a3|b2,b3``; ``pairs`` are the distinct linked pairs of
    ids (``a << 32 | b``) with how often they are linked (``times``); ``slice`` is for :func:`with_counts`.
    Both files must exist on every worker.  ``keep=False`` leaves the text out.
    """
    if output.lower() in {name.lower() for name in df.columns}:
        raise ValueError(f"column {output} exists already")
    place = df.columns.index(column)
    kept = [i for i in range(len(df.columns)) if keep or i != place]
    schema = StructType([*(df.schema.fields[i] for i in kept), StructField(output, ALIGNED)])
    ship_package(df.sparkSession)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encodings = shared_encodings(a_file, b_file)
        names = names_of(*map(len, encodings.sizes))
        # A slice belongs to one task: its number is the task's and a running one.
        number, held = TaskContext.get().partitionId() << 32, 0
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                texts = [t or "" for t in batch.column(place).to_pylist()]
                counts, told, pairs, times = [], [], [], []
                for ids in encodings(texts):
                    groups, text_of, left, right = align_ids(ids, encodings.sizes, names)
                    found, often = np.unique(
                        left.astype(np.int64) << SHIFT | right.astype(np.int64), return_counts=True)
                    counts.append((len(ids[0]), len(ids[1]), groups, len(left)))
                    told.append(text_of)
                    pairs.append(found)
                    times.append(often)
                held += sum(map(len, pairs))
                numbers = np.array(counts, dtype=np.int64).reshape(-1, 4)
                stops = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32))
                values = [
                    *(pa.array(numbers[:, i]) for i in range(4)), pa.array(told, type=pa.string()),
                    pa.ListArray.from_arrays(stops, pa.array(np.concatenate([np.zeros(0, np.int64), *pairs]))),
                    pa.ListArray.from_arrays(stops, pa.array(np.concatenate([np.zeros(0, np.int64), *times]).astype(np.int32))),
                    pa.array(np.full(len(texts), number))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in kept), pa.StructArray.from_arrays(values, ALIGNED.names)], schema.names)
                if held >= SLICE_PAIRS:
                    number, held = number + 1, 0

    return df.mapInArrow(run, schema)


def pairs_per_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slice, pair, n) of (slice, pairs): in how many texts of a slice a pair is linked; a slice may come in parts."""
    def counted(number: int, held: list[np.ndarray]) -> pa.RecordBatch:
        found, often = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(found), number)), pa.array(found), pa.array(often.astype(np.int64))], ["slice", "pair", "n"])

    at, held, size = None, [], 0
    for batch in batches:
        numbers, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        for number in dict.fromkeys(numbers.tolist()):
            if held and (number != at or size > SLICE_PAIRS):
                yield counted(at, held)
                held, size = [], 0
            at = number
            held.append(lists.filter(pa.array(numbers == number)).flatten().to_numpy().astype(np.int64))
            size += len(held[-1])
    if held:
        yield counted(at, held)


def pair_totals(aligned: DataFrame, output: str = "aligned") -> tuple[DataFrame, DataFrame]:
    """((slice, pair, n), (pair, count, best)): counts of texts per slice, and over all; best is the A id's highest.

    ``aligned`` is read once; it should be stored.
    """
    counted = through_storage(
        aligned.select(f"{output}.slice", f"{output}.pairs").mapInArrow(pairs_per_slice, "slice long, pair long, n long"),
        "pairs")
    totals = through_storage(counted.groupBy("pair").agg(F.sum("n").alias("count")), "pair-totals")
    a_id = F.shiftright("pair", SHIFT)
    highest = totals.groupBy(a_id.alias("a")).agg(F.max("count").alias("highest"))
    # One row per id of A's vocabulary at most.
    return counted, totals.join(F.broadcast(highest), a_id == F.col("a")).select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def with_counts(aligned: DataFrame, output: str = "aligned") -> DataFrame:
    """Replace the struct of :func:`align` by ``n_a, n_b, n_groups, n_links, groups, n_best, count_sum``.

    A pair's count is the number of texts that link it; ``count_sum`` adds it up over a text's links and ``n_best``
    counts the links whose pair is the most common one of its A id, ties included.  Takes the stored result of align.
    """
    counted, totals = pair_totals(aligned, output)
    known = counted.select("slice", "pair").distinct().join(totals, "pair").select("slice", "pair", "count", "best")
    rest = [name for name in aligned.columns if name != output]
    if taken := {name.lower() for name in rest} & set(SCORED):
        raise ValueError(f"columns exist already: {', '.join(sorted(taken))}")
    keyed = aligned.select(F.struct(*[F.col(f"`{name}`") for name in rest]).alias("row"), F.struct(
        *[F.col(f"{output}.{name}").alias(name) for name in ALIGNED.names if name != "slice"]).alias("told"),
        F.col(f"{output}.slice").alias("slice"))
    schema = StructType([
        keyed.schema["row"], keyed.schema["told"], StructField("n_best", LongType()), StructField("count_sum", LongType())])

    def look_up(texts: pa.Table, table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("pair").to_numpy())
        keys, sums = table.column("pair").to_numpy()[order], table.column("count").to_numpy()[order]
        best = table.column("best").to_numpy()[order]
        told = pa.concat_arrays(texts.column("told").chunks)
        lists = told.field("pairs")
        stops = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        pairs, times = lists.flatten().to_numpy(), told.field("times").flatten().to_numpy().astype(np.int64)
        at = np.searchsorted(keys, pairs)
        if (at == len(keys)).any() or (keys[at] != pairs).any():
            raise LookupError("a slice holds pairs that were not counted")

        def per_text(values: np.ndarray) -> pa.Array:
            summed = np.concatenate([[0], np.cumsum(values)])
            return pa.array(summed[stops[1:]] - summed[stops[:-1]])

        return pa.Table.from_arrays(
            [texts.column("row"), texts.column("told"), per_text(times * best[at]), per_text(times * sums[at])], schema.names)

    scored = keyed.groupBy("slice").cogroup(known.groupBy("slice")).applyInArrow(look_up, schema)
    return scored.select("row.*", *[f"told.{name}" for name in SCORED[:5]], *SCORED[5:])
