"""Sizes and contents of the language model's tables over small frames."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import numpy as np

from sluicework.llm import kneserney


def test_trigram_files_take_a_few_bytes_a_row(spark):
    drawn = np.random.default_rng(5).zipf(1.3, (400, 60)) % 20_000
    texts = [" ".join(f"w{x}" for x in row) for row in drawn] + ["again and again"] * 300
    model = kneserney.count_model(spark.createDataFrame([(t,) for t in texts], "text string"), 1, order=3)
    padded = [["", "", *t.split(), "\n"] for t in texts]
    triples = Counter(x for s in padded for x in zip(s, s[1:], s[2:], strict=False))
    assert model.distinct_triples == len(triples)
    folder = model.folder.removeprefix("file:")
    held = {kind: sum(p.stat().st_size for p in Path(folder).glob(f"{kind}-*")) for kind in ("triples", "pairs", "contexts", "words")}
    several = Counter((t, u) for t, u, _ in triples.elements())
    # A directory of 256 entries a file at least, and a header.
    spare = 4 * 1_200
    assert held["triples"] < 6 * len(triples) + spare and held["pairs"] < 6.5 * model.distinct_pairs + spare
    assert held["contexts"] < 10 * sum(n > 1 for n in several.values()) + spare + 500
    assert held["words"] < 12 * model.vocabulary + 16 * 6 * 200 + spare


def test_tables_give_back_every_number():
    drawn = np.random.default_rng(3)
    keys = np.unique(np.append(drawn.integers(0, 1 << 64, 5_000, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)))
    values = [drawn.integers(0, 300, len(keys)), drawn.integers(0, 1 << 40, len(keys)), np.full(len(keys), 255), drawn.integers(0, 16, len(keys)) ** 2 // 15]
    arrays = kneserney.table_arrays(keys, values)
    table = kneserney.Table(np.frombuffer(b"".join(a.tobytes() for a in arrays), np.uint8))
    absent = keys + np.uint64(1 << 30)
    assert (table.find(keys) == values).all() and not table.find(absent).any() and not table.find(keys[:0]).size
    # More words than places that fit one number.
    places = [drawn.integers(0, 1 << 22, 9, dtype=np.uint64) for _ in range(3)]
    for words in (1 << 21, 1 << 22):
        kept = [p % np.uint64(words - 1) for p in places]
        assert np.array_equal(kneserney.parted(kneserney.joined(kept, words), 3, words), kept)
    block = [np.sort(keys), np.arange(len(keys), dtype=np.uint64)]
    assert np.array_equal(kneserney.unpack(kneserney.pack(block), 2), block)
