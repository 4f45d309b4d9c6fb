"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a window of as many consecutive words as a template has (the whole
text if it is shorter); it matches when it holds the template's threshold share
of distinct template words.  Template words are ordered by their frequency in
all texts, rarest first.  Two conditions leave few texts, and lose no match:

* prefix: of a template with n distinct words and o needed ones, a text with a
  match holds one of the n - o + 1 rarest;
* length: a window with fewer than o distinct words of the template cannot match.

In these texts all windows that end with a template word are counted exactly,
which replaces prefix and position filters on windows: made after the count, as
in ``windows``, those two tests can reject nothing.

A template that is a phrase asks for all
its words in order.  Templates are a short fixed list and travel with the code;
of the texts only counts of the template's own words are gathered.

Defined results: a null text is the empty text and matches nothing; overlapping
windows of one template are reported once, as the stretch they cover with the
highest containment; repeated rows each have their matches; other columns pass
through.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from sluicework.llm.common import map_slices, texts_of
from sluicework.llm.wordhash import word_spans

# Bytes that are not part of a word: ASCII other than digits and letters.
BREAKS = np.zeros(256, dtype=bool)
BREAKS[:0x80] = True
BREAKS[[*b"0123456789", *b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", *b"abcdefghijklmnopqrstuvwxyz"]] = False


@dataclass(frozen=True)
class Template:
    """Words of a license text, the label it gives, the share of distinct words needed, and whether in order."""

    label: str
    words: tuple[str, ...]
    threshold: float = 0.8
    phrase: bool = False

    @property
    def needed(self) -> int:
        return max(1, math.ceil(self.threshold * len(set(self.words)) - 1e-9))


def phrase(label: str, text: str) -> Template:
    return Template(label, tuple(text.split()), 1.0, True)


def notice(label: str, text: str, threshold: float = 0.8) -> Template:
    return Template(label, tuple(text.split()), threshold)


# Phrases and labels, fixed values.
PHRASES = (
    phrase("gpl", "gnu general public license"),
    phrase("apache", "apache license"),
    phrase("cc-by", "cc by"),
    phrase("mit", "mit license"),
)
# Sentences of well-known licenses, lower case, words only, fixed values.
NOTICES = (
    notice("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    notice("gpl", "this work is licensed under the gnu general public license version 3"),
    notice("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    notice("apache", "licensed under the apache license version 2 0"),
    notice("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    notice("mit", "released under the mit license"),
    notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    notice("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    notice("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    notice("cc-by", "licensed under cc by 4 0"),
    notice("unlicense", "this is free and unencumbered software released into the public domain"),
    notice("proprietary", "all rights reserved", 1.0),
)


def hashes_of(words: tuple[str, ...]) -> np.ndarray:
    return word_spans([" ".join(words)], BREAKS)[3]


def word_frequencies(df: DataFrame, column: str, templates: tuple[Template, ...]) -> dict[str, int]:
    """How often each template word comes up in all texts."""
    names = sorted({w for t in templates for w in t.words})
    wanted = hashes_of(tuple(names))
    order = np.argsort(wanted)

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            hashes = word_spans(texts_of(batch, 0), BREAKS)[3]
            place = np.minimum(np.searchsorted(wanted[order], hashes), len(wanted) - 1)
            hit = order[place[wanted[order][place] == hashes]]
            counts = np.bincount(hit, minlength=len(names))
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts, pa.int64())], ["word", "n"])

        return work

    counts = map_slices(df.select(column), "word string, n long", start).groupBy("word").agg(F.sum("n").alias("n"))
    return {**dict.fromkeys(names, 0), **{r.word: r.n for r in counts.collect()}}


class Scanner:
    """Finds matches in slices of texts; template words carry their place in the global order."""

    def __init__(self, templates: tuple[Template, ...], frequency: dict[str, int]) -> None:
        self.templates = templates
        names = sorted(frequency, key=lambda w: (frequency[w], w))
        self.rank = {w: i for i, w in enumerate(names)}
        hashes = hashes_of(tuple(names))
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        self.names = [n.encode() for n in names]
        self.ordered = [sorted({self.rank[w] for w in t.words}) for t in templates]
        self.prefixes = [ranks[:len(ranks) - t.needed + 1] for t, ranks in zip(templates, self.ordered, strict=True)]

    def matches(self, texts: list[str]) -> tuple[list[list[tuple]], np.ndarray]:
        """By text: (template number, first word, end word, containment), and the number of words."""
        data, starts, ends, hashes, counts = word_spans(texts, BREAKS)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        found = np.flatnonzero(self.hashes[place] == hashes)
        ids = self.ids[place[found]]
        # A hash is only a guess: compare the bytes.
        same = np.array([data[starts[p]:ends[p]].tobytes().lower() == self.names[i]
                         for p, i in zip(found.tolist(), ids.tolist(), strict=True)], dtype=bool) if len(found) else np.zeros(0, bool)
        found, ids = found[same], ids[same]
        borders = np.concatenate([[0], np.cumsum(counts)])
        results: list[list[tuple]] = [[] for _ in texts]
        for number, template in enumerate(self.templates):
            hits = np.flatnonzero(np.isin(ids, self.prefixes[number]))
            if not len(hits):
                continue
            documents = np.searchsorted(borders, found[hits], side="right") - 1
            for document in np.unique(documents).tolist():
                low, high = int(borders[document]), int(borders[document + 1])
                a, b = np.searchsorted(found, [low, high])
                where, which = found[a:b] - low, ids[a:b]
                member = np.isin(which, self.ordered[number])
                results[document] += [
                    (number, *m) for m in self.windows(number, where[member].tolist(), which[member].tolist(), high - low)]
        return results, counts

    def windows(self, number: int, where: list[int], which: list[int], count: int) -> list[tuple[int, int, float]]:
        """Matching stretches of one text: places and ranks of the template's words in it, in order."""
        template, ranks, prefix = self.templates[number], self.ordered[number], set(self.prefixes[number])
        if len(set(which)) < template.needed:  # length filter
            return []
        if template.phrase:
            at = dict(zip(where, which, strict=True))
            words = [self.rank[w] for w in template.words]
            # The rarest word leads to the phrase's start.
            offset = words.index(ranks[0])
            return [(p - offset, p - offset + len(words), 1.0) for p, w in zip(where, which, strict=True)
                    if w == ranks[0] and all(at.get(p - offset + k) == x for k, x in enumerate(words))]
        size = min(len(template.words), count)
        held: Counter = Counter()
        order = {r: i for i, r in enumerate(ranks)}
        stretches: list[list] = []
        left = 0
        # Windows that end with a template word; any other window holds no more than one of these.
        for right, word in enumerate(which):
            held[word] += 1
            while where[right] - where[left] >= size:
                held[which[left]] -= 1
                if not held[which[left]]:
                    del held[which[left]]
                left += 1
            if len(held) < template.needed or prefix.isdisjoint(held):
                continue
            rarest = min(order[w] for w in held)
            if len(ranks) - rarest < template.needed:  # position filter
                continue
            share = len(held) / len(ranks)
            begin, end = where[left], where[right] + 1
            if stretches and begin < stretches[-1][1]:
                stretches[-1][1], stretches[-1][2] = end, max(stretches[-1][2], share)
            else:
                stretches.append([begin, end, share])
        return [tuple(s) for s in stretches]


MATCH = StructType([
    StructField("label", StringType()), StructField("phrase", BooleanType()), StructField("start", LongType()),
    StructField("end", LongType()), StructField("containment", DoubleType())])


def scan(df: DataFrame, column: str = "text", templates: tuple[Template, ...] = PHRASES + NOTICES, keep: bool = True) -> DataFrame:
    """Add ``n_words`` and ``matches`` (label, phrase, first and end word, containment)."""
    frequency = word_frequencies(df, column, templates)
    place = df.columns.index(column)
    kept = [i for i in range(len(df.columns)) if keep or i != place]
    kind = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()),
                               ("containment", pa.float64())]))

    def start():
        scanner = Scanner(templates, frequency)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, counts = scanner.matches(texts_of(batch, place))
            rows = [[{"label": templates[n].label, "phrase": templates[n].phrase, "start": s, "end": e, "containment": c}
                     for n, s, e, c in text] for text in found]
            rest = batch.select(kept)
            return pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(counts, pa.int64()), pa.array(rows, kind)], [*rest.schema.names, "n", "m"])

        return work

    added = [StructField("n_words", LongType()), StructField("matches", ArrayType(MATCH))]
    return map_slices(df, StructType([*(df.schema.fields[i] for i in kept), *added]), start)
