"""Parts of texts and the text of aligned groups over small inputs."""

from __future__ import annotations

import itertools

import numpy as np
import public_tokenizers
import pytest

from sluicework.llm import align


@pytest.fixture(scope="module")
def encodings():
    return align.Encodings(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def test_parts_are_those_of_the_cuts(encodings):
    for letters in itertools.product(" a\n ", repeat=6):
        text = "".join(letters)
        assert encodings.parts(text) == align.CUT.split(text)
    assert encodings.parts("") == []


def test_remembered_ids_are_those_of_whole_texts(encodings, monkeypatch):
    texts = ["the quick brown fox", "", "the  quick\n fox ", "the ▁ odd one", "the quick fox", "naïve façade 漢字"]
    for most in (align.REMEMBERED, 2):  # beyond two parts the memory starts anew
        monkeypatch.setattr(align, "REMEMBERED", most)
        for batch in (texts, texts[::-1]):
            for text, (a, b) in zip(batch, encodings(batch), strict=True):
                whole = encodings.a([f" {text}"])[0], encodings.b([text])[0]
                given = [b"".join(map(side.bytes.__getitem__, ids)) for side, ids in zip((encodings.a, encodings.b), whole, strict=True)]
                kept = text and given == [f" {text}".encode()] * 2
                assert (a.tolist(), b.tolist()) == (whole if kept else ([], []))


def test_groups_and_links_are_written_for_all_tokens_at_once():
    # Tokens of A take 1, 2, 3 bytes, those of B 2, 1, 3, 4: an irregular group of two and two, then of two and one.
    sizes = np.array([1, 2, 3]), np.array([2, 1, 3, 4])
    ids = np.array([0, 1, 2, 0, 2], np.int32), np.array([0, 1, 2, 3], np.int32)
    groups, text, left, right = align.align_ids(ids, sizes, align.names_of(3, 4))
    assert (groups, text) == (3, "0,1|0,1;2|2;0,2|3")
    assert list(zip(left.tolist(), right.tolist(), strict=True)) == [(0, 0), (1, 0), (1, 1), (2, 2), (0, 3), (2, 3)]
    none = np.zeros(0, np.int32)
    assert align.align_ids((none, none), sizes, align.names_of(3, 4))[:2] == (0, "")
