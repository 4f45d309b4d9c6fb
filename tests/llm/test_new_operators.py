"""Trie, repeated bytes and aligned tokens over small frames, against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sluicework.llm import align, contraction, repeats, trie
from sluicework.llm.catalog import CATALOG

TURNS = "conv_id long, turn long, role string, text string"
A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- tree contraction and the trie ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["path", "star", "random", "caterpillar", "forest"])
def test_subtree_sums(spark, shape):
    draw = random.Random(3)
    parents = {0: None}
    for i in range(1, 40):
        parents[i] = {"path": i - 1, "star": 0, "random": draw.randrange(i), "caterpillar": i - 2 + i % 2,
                      "forest": None if i % 7 == 0 else i - 1}[shape]
    depth, values = {}, {i: draw.randrange(100) for i in parents}
    for i, up in parents.items():
        depth[i] = 0 if up is None else depth[up] + 1
    want = dict(values)
    for i in sorted(parents, key=depth.get, reverse=True):
        if parents[i] is not None:
            want[parents[i]] += want[i]
    nodes = spark.createDataFrame([(i, parents[i], depth[i], values[i]) for i in parents], "id long, parent long, rank long, v long")
    assert {r.id: r.v for r in contraction.subtree_sums(nodes, ["v"], 6).collect()} == want


def test_a_chain_contracts_in_logarithmic_rounds(spark, monkeypatch):
    rounds = []
    compress = contraction.compress
    monkeypatch.setattr(contraction, "compress", lambda *a: rounds.append(1) or compress(*a))
    nodes = spark.range(64).selectExpr("id", "nullif(id, 0) - 1 AS parent", "id AS rank", "1 AS v")
    assert sorted(r.v for r in contraction.subtree_sums(nodes, ["v"], 6).collect()) == list(range(1, 65))
    assert len(rounds) <= 8


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c > 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1].encode().split()) if node else 0
    return sorted(
        (min(who), len(node), min(members[node[:-1]]) if node else None, len(who), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, who in members.items())


def trie_rows(spark, rows):
    found = trie.prefix_trie(spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit(1)).withColumn("lane1", F.lit("x")))
    return sorted(tuple(r) for r in found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


ODD_TURNS = [
    (0, 0, "user", "hello there"), (0, 1, "assistant", "hi"), (0, 2, "user", "more words here"), (0, None, None, None),
    (1, 0, "user", "own first"), (1, 1, "assistant", "own second"), (1, 2, "user", "own third"), (1, 2, "user", "own third"),
    (3, 0, "user", ""), (5, 0, "user", "only turn"), (25, 0, "user", "no base"), (26, 0, "user", "no base"), (26, 1, "a", "\t b c"),
    (None, 0, "user", "no id"), (-7, 0, "user", "hello there"), (-20, 1, "user", "tie"), (-20, 1, "assistant", "tie"),
    (19, 3, "user", "z " * 4000), (2**40, 0, "x", "far"),
]


def test_trie_of_odd_conversations(spark):
    assert trie_rows(spark, ODD_TURNS) == brute_trie(ODD_TURNS)


def test_trie_of_a_conversation_over_many_partitions(spark):
    """One conversation holds most rows, equal rows among them, and crosses every partition."""
    rows = [(40, i // 2, "user", f"turn {i // 4}") for i in range(120)] + [(41, 0, "user", "turn 0"), (60, 0, "user", "x")]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_of_copies(spark):
    rows = [(c, t, "user", f"t {t}") for c in range(30) for t in range(3)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert trie_rows(spark, []) == []


# -- repeated bytes ------------------------------------------------------------------------------------------------------


def brute_repeats(texts, window):
    counts = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - window + 1):
            if counts[text[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        yield (len(text), sum(gone), sum(g and not p for p, g in zip(b"\0" + gone, gone, strict=False)),
               bytes(c for c, g in zip(text, gone, strict=True) if not g))


def repeat_texts(seed):
    draw = random.Random(seed)
    sources = ["".join(draw.choice("ab c") for _ in range(1500)) for _ in range(3)]
    texts = ["x" * 700, "xy" * 400, "x" * 199, "x" * 200, "", None, "é漢" * 90, "é漢" * 90, "wide " * 100]
    for _ in range(50):
        part = list(draw.choice(sources)[draw.randrange(1000):][:draw.randrange(20, 500)])
        for _ in range(draw.choice([0, 0, 1, 3])):
            part[draw.randrange(len(part))] = "z"
        texts.append("".join(draw.choice("pqrs") for _ in range(draw.randrange(200))) + "".join(part))
    return texts


@pytest.mark.parametrize("window", [80, 200, 319])
def test_repeats_are_those_of_brute_force(spark, window):
    texts = repeat_texts(window)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("key", F.lit("k")).withColumn(
        "places", F.lit(1)).withColumn("row", F.lit("r"))
    cut = repeats.without_repeats(frame, "text", window)
    assert cut.columns == ["doc_id", "key", "places", "row", "n_bytes", "n_removed", "n_spans", "kept"]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in cut.collect()}
    assert [got[i] for i in range(len(texts))] == list(brute_repeats([(t or "").encode() for t in texts], window))
    assert {tuple(r) for r in cut.select("key", "places", "row").distinct().collect()} == {("k", 1, "r")}


def test_repeats_of_repeated_and_no_rows(spark):
    long = "no word of this line is said elsewhere " * 3 + "".join(map(str, range(100)))
    frame = spark.createDataFrame([(1, long), (1, long), (None, "short")], "doc_id long, text string")
    got = sorted((r.n_bytes, r.n_removed, r.n_spans) for r in repeats.without_repeats(frame, "text").collect())
    assert got == [(5, 0, 0), (len(long), len(long), 1), (len(long), len(long), 1)]
    assert repeats.without_repeats(frame.where("false"), "text").collect() == []
    with pytest.raises(ValueError, match="kept"):
        repeats.without_repeats(frame.withColumn("Kept", F.lit(1)), "text")
    with pytest.raises(ValueError, match="bytes"):
        repeats.without_repeats(frame, "text", 50)


# -- aligned tokens ------------------------------------------------------------------------------------------------------


def test_diagonal_groups_are_the_common_ends():
    draw = random.Random(1)
    for _ in range(300):
        size = draw.randrange(1, 80)
        sides = [sorted(draw.sample(range(1, size), draw.randrange(size))) + [size] for _ in range(2)]
        if draw.random() < 0.3:
            sides[1] = list(sides[0])
        cuts = [(a, b) for a, b in ((sides[0].index(e), sides[1].index(e)) for e in sorted(set(sides[0]) & set(sides[1])))]
        got = []
        for a, b, a_stop, b_stop in align.diagonal_groups(*sides):
            if sides[0][a] == sides[1][b]:
                assert sides[0][a:a_stop] == sides[1][b:b_stop]
                got += [(a + i, b + i) for i in range(a_stop - a)]
            else:
                got.append((a_stop - 1, b_stop - 1))
        assert got == cuts


def brute_alignment(texts):
    left, right = align.ByteLevel(A_FILE), align.Pieces(B_FILE)
    told, holders = [], Counter()
    for text in texts:
        text = text or ""
        a, b = left([f" {text}"])[0], right([text])[0]
        bytes_a, bytes_b = [left.bytes[i] for i in a], [right.bytes[i] for i in b]
        if not text or not b"".join(bytes_a) == f" {text}".encode() == b"".join(bytes_b):
            told.append(None)
            continue
        owner_a = [i for i, t in enumerate(bytes_a) for _ in t]
        owner_b = [i for i, t in enumerate(bytes_b) for _ in t]
        links = sorted(set(zip(owner_a, owner_b, strict=True)))
        cuts = [k + 1 for k in range(len(owner_a)) if k + 1 == len(owner_a)
                or owner_a[k] != owner_a[k + 1] and owner_b[k] != owner_b[k + 1]]
        groups = []
        for start, stop in zip([0, *cuts], cuts, strict=False):
            sides = [dict.fromkeys(owner[start:stop]) for owner in (owner_a, owner_b)]
            groups.append("|".join(",".join(str(ids[i]) for i in side) for ids, side in zip((a, b), sides, strict=True)))
        pairs = [(a[i], b[j]) for i, j in links]
        told.append((len(a), len(b), len(groups), len(links), ";".join(groups), pairs))
        holders.update(set(pairs))
    highest = Counter()
    for (a, _), n in holders.items():
        highest[a] = max(highest[a], n)
    return [(0, 0, 0, 0, "", 0, 0) if t is None else
            (*t[:5], sum(holders[p] == highest[p[0]] for p in t[5]), sum(holders[p] for p in t[5])) for t in told]


def aligned(spark, frame):
    from sluicework.session import through_storage

    return align.with_counts(through_storage(align.align(frame, "text", A_FILE, B_FILE), "aligned"))


TEXTS = ["the quick brown fox", "the quick brown fox", None, "", " ", "two  spaces\n\nand lines ", "naïve façade 漢字 🎉", "▁ odd",
         "<|endoftext|> <s> </s> <unk> <0x41>", "internationalisation " * 300, "x" * 3000, "\x00\x01 control", "ÅÅ combining é"]


@pytest.mark.parametrize("pairs", [1_000_000, 5])
def test_alignment_is_that_of_brute_force(spark, monkeypatch, pairs):
    monkeypatch.setattr(align, "SLICE_PAIRS", pairs)
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("pair", F.lit("p"))
    rows = sorted(aligned(spark, frame).collect(), key=lambda r: r.doc_id)
    assert [tuple(r[c] for c in align.SCORED) for r in rows] == brute_alignment(TEXTS)
    assert {r.pair for r in rows} == {"p"}


def test_alignment_of_no_rows_and_taken_names(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert aligned(spark, frame).collect() == []
    with pytest.raises(ValueError, match="aligned"):
        align.align(frame.withColumn("Aligned", F.lit(1)), "text", A_FILE, B_FILE)
    with pytest.raises(ValueError, match="n_best"):
        align.with_counts(align.align(frame.withColumn("n_best", F.lit(1)), "text", A_FILE, B_FILE))


# -- the registered queries ----------------------------------------------------------------------------------------------


def test_registered_queries(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts = [text for _, text in docs]
    digest = lambda data: hashlib.sha256(data).hexdigest()
    got = {r.doc_id: r for r in CATALOG.queries["op12_repeated_bytes"](spark, sf).collect()}
    want = brute_repeats([(t or "").encode() for t in texts], 200)
    for (doc, _), (size, gone, spans, kept) in zip(docs, want, strict=True):
        assert tuple(got[doc][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) == (size, gone, spans, digest(kept))
    got = {r.doc_id: r for r in CATALOG.queries["op13_aligned_tokens"](spark, sf).collect()}
    names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    for (doc, _), row in zip(docs, brute_alignment(texts), strict=True):
        assert tuple(got[doc][c] for c in names) == (*row[:4], row[4] and digest(row[4].encode()), *row[5:])
