"""The plain functions of the operators against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sluicework.llm import ann, bpe, golay, licenses, mixing, simhash, toxicity
from sluicework.llm.wordhash import word_hashes

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(RANKS, public_tokenizers.PATTERN)


TEXTS = ["", " ", "\n\n  x", "a" * 3000, "Überfluß " * 40, "é" * 99, "🎉🎉漢字 " * 30, "don't 12345 --- \t end", "\x00\x01"]


def test_encoding_is_the_library_s(reference, encoder):
    for text, ids in zip(TEXTS, encoder(TEXTS), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)


def test_few_texts_are_cut_at_a_time(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CUT_TOGETHER", 100)
    one, most = bpe.Encoder(RANKS, public_tokenizers.PATTERN), []
    learn = one.learn
    monkeypatch.setattr(one, "learn", lambda pieces: (most.append(sum(map(len, pieces))), learn(pieces)))
    texts = [" ".join(str(i * 1000 + j) for j in range(10)) for i in range(50)] + ["", "x" * 500, ""]
    assert [ids.tolist() for ids in one(texts)] == [reference.encode_ordinary(text) for text in texts]
    # What is held at once: up to the bound and the text that reaches it.
    assert max(most) <= 100 + 500 and len(most) > 20
    assert [*bpe.stretches([], 5)] == [] and [*bpe.stretches(["", "abcdef", "", "g"], 5)] == [["", "abcdef"], ["", "g"]]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdefgéß漢 \n'1.,", max_size=60))
def test_both_merges_agree(text):
    one = bpe.shared_encoder(RANKS, public_tokenizers.PATTERN)
    piece = text.encode()
    if piece:
        alone = bpe.merge_piece(piece, one.ranks)
        names = {one.ranks[piece[a:b]]: piece[a:b] for a in range(len(piece)) for b in range(a, len(piece) + 1) if piece[a:b] in one.ranks}
        assert b"".join(names[i] for i in alone) == piece
        if piece not in one.ranks:
            assert bpe.merge_rows([piece], one.byte_ids, one.table)[0].tolist() == alone


def brute_segments(scores):
    found = []

    def split(low, high):
        best = None
        for i in range(low, high):
            total = 0.0
            for j in range(i, high):
                total += scores[j]
                if best is None or total > best[0] + 1e-12:
                    best = (total, i, j + 1)
        if best and best[0] > 1e-12:
            split(low, best[1])
            found.append(best[1:])
            split(best[2], high)

    split(0, len(scores))
    return found


def test_segments_are_the_maximal_ones():
    draw = random.Random(3)
    for _ in range(300):
        scores = [draw.choice([-1.0, -0.7, 0.31, 1.1, 0.57]) + draw.random() * 1e-3 for _ in range(draw.randint(0, 25))]
        assert sorted((a, b) for a, b, _ in toxicity.segments(np.array(scores))) == brute_segments(scores)


def test_decay_solves_its_equation():
    weights = [(1.0, 0.1), (2.0, 0.02), (-1.0, 0.88)]
    decay = toxicity.decay_of(weights)
    assert sum(p * math.exp(decay * s) for s, p in weights) == pytest.approx(1.0, abs=1e-6)


def test_words_two_bits_apart_share_a_codeword():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 1 << 23, 3000)
    for bits in range(3):
        other = words.copy()
        for i in range(len(words)):
            for b in draw.choice(23, bits, replace=False):
                other[i] ^= 1 << int(b)
        (a, m), (b, n) = golay.keys(words), golay.keys(other)
        for i in range(len(words)):
            assert set(a[i, :m[i]].tolist()) & set(b[i, :n[i]].tolist())


def test_flips_and_pairs_find_the_same_links(monkeypatch):
    draw = np.random.default_rng(2)
    prints = np.unique(np.concatenate([np.array([7, 11], np.uint64) << np.uint64(s) for s in range(40)] + [
        draw.integers(0, 1 << 62, 50, dtype=np.uint64)]))
    paired = simhash.roots_within(prints)
    monkeypatch.setattr(simhash, "PAIRWISE", 1)
    assert (simhash.roots_within(prints) == paired).all()


@pytest.mark.parametrize("count", [1, 2, 3, 10, 257, 1000])
def test_permutations_hit_every_number_and_can_be_undone(count):
    index, size, key = np.arange(count), np.full(count, count), np.full(count, 99, dtype=np.uint64)
    there = mixing.permuted(index, size, key)
    assert sorted(there.tolist()) == list(range(count))
    assert (mixing.permuted(there, size, key, mixing.BACK) == index).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=7))
def test_plans_take_their_targets_to_the_word(sizes):
    sizes = np.array(sizes)
    weights = np.array([(3.0, 1.0, 2.0)[i % 3] for i in range(len(sizes))])
    wanted = mixing.targets(sizes, weights)
    assert (wanted <= 2 * sizes + 1e-6).all() and wanted.sum() == pytest.approx(1.5 * sizes.sum())
    plan = mixing.plan(sizes, weights, block=64)
    for i, size in enumerate(sizes.tolist()):
        taken = 0
        for slot in range(int(plan.quotas[i])):
            n = int(plan.blocks[i])
            number = int(mixing.permuted(np.array([slot % n]), np.array([n]), mixing.pass_key(np.array([i]), np.array([slot // n]), mixing.SEED))[0])
            words = size - (n - 1) * 64 if number == n - 1 else 64
            taken += int(plan.last[i]) if slot == plan.quotas[i] - 1 else words
        assert taken == round(wanted[i])


def test_word_hashes_follow_the_words():
    texts = ["The the THE", "", " a\tb\x0bc ", "ß é", "x" * 5000]
    hashes, counts = word_hashes(texts)
    words = [w for t in texts for w in t.encode().lower().split()]
    assert counts.tolist() == [len(t.encode().split()) for t in texts]
    assert len(set(hashes.tolist())) == len(set(words))
    assert hashes[0] == hashes[1] == hashes[2]


def test_bounds_hold_and_the_nearest_are_exact():
    draw = np.random.default_rng(4)
    vectors = np.concatenate([draw.standard_normal((600, 32)), np.ones((50, 32)), np.full((1, 32), 0.5)])
    ids = np.arange(len(vectors))
    centre = vectors.mean(0)
    found = ann.best(ann.Codes(centre), ids, vectors, ids[:40], vectors[:40], 10)
    for q in range(40):
        distance = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        distance[q] = np.inf
        expected = np.lexsort((ids, distance))[:10]
        assert found[1][found[0] == q].tolist() == expected.tolist()


def brute_license(words, template):
    size = min(len(template.words), len(words))
    need = set(template.words)
    return any(len(need & set(words[i:i + size])) >= template.needed for i in range(len(words) - size + 1))


def test_the_filters_lose_no_window():
    draw = random.Random(5)
    template = licenses.notice("x", "a b c d e f g h i j", 0.8)
    other = licenses.phrase("y", "c d e")
    scanner = licenses.Scanner((template, other), {w: draw.randint(0, 9) for w in "abcdefghij"})
    texts = [" ".join(draw.choice("abcdefghijklm") for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += ["a b c d e f g h", "A b, C-d e.f g h x", ""]
    found, counts = scanner.matches(texts)
    for text, matches, count in zip(texts, found, counts.tolist(), strict=True):
        words = text.lower().replace(",", " ").replace("-", " ").replace(".", " ").split()
        assert count == len(words)
        assert any(m[0] == 0 for m in matches) == brute_license(words, template)
        places = [i for i in range(len(words)) if words[i:i + 3] == ["c", "d", "e"]]
        assert sorted(m[1] for m in matches if m[0] == 1) == places


def test_the_order_of_shingles_counts_every_text(spark):
    texts = [f"one two three four five {i} {i * 7} {i * 11}" for i in range(200)] + [None, "", "short"]
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, node long, text string").repartition(7)
    counts = simhash.cell_counts(docs, 5)
    sets = [simhash.set_maker(5)(t or "") for t in texts]
    assert counts.sum() == sum(map(len, sets))
    shared = sets[0][np.isin(sets[0], sets[1])]
    assert len(shared) == 1 and counts[simhash.cells_of(shared)[0]] >= 200
    for one in sets[:5]:
        ordered = simhash.rare_first(one, counts)
        assert sorted(ordered.tolist()) == one.tolist() and ordered[-1] == shared[0]
