"""Toxic passages by maximum-scoring segments of token log-odds.

Learning.  Words of labelled texts are counted by label, once in each text.  A word's toxic rate
has a Dirichlet prior whose mean is the rate of its five-letter prefix, whose
prior is the rate of its four-letter prefix, whose prior is the overall rate,
so an unseen word is judged by the prefix it shares with known ones.  A token's
score is the log-odds of its rate against the overall rate; only scores that
are several standard errors above zero are kept, every other token costs
``DRIFT``.

Scoring.  One pass over a text's token scores finds all maximal segments of
positive sum (each disjoint, each as long as pays).  By extreme-value theory a
background text of N tokens holds K*N*exp(-L*s) segments of score s or more,
with L from the scores of clean texts and K from their longest segments.  A text's
evidence is the summed significance of its segments; a logistic curve over the
labelled texts turns it into a probability.

Defined results: null and empty texts have no passage and get the curve's value
at no evidence; with labels of one kind only every score is
that label, without labels 0; labels other than 0 and 1 are left out;
repeated rows are scored alike; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from sluicework.llm.common import map_slices, texts_of

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (5, 4)
PRIOR = 4.0
DRIFT = 1.0
STANDARD_ERRORS = 4.0
# Labelled texts a model learns from, about; above it a hash of the text decides.
LABELLED = 200_000
# Segments that would appear this often or less in a clean text of the same length count as passages.
EXPECTED = 0.05
REMEMBERED = 150_000

PASSAGES = ArrayType(StructType([
    StructField("start", LongType()), StructField("end", LongType()),
    StructField("score", DoubleType()), StructField("expected", DoubleType())]))


@dataclass
class Model:
    """Token scores (words as they are, prefixes after a '<'), extreme-value constants, logistic curve."""

    scores: dict[str, float] = field(default_factory=dict)
    known: frozenset = frozenset()
    rate: float = 0.0
    decay: float = 1.0
    factor: float = 1.0
    curve: tuple[float, float] = (0.0, 0.0)

    def token(self, word: str) -> float:
        """Score of a lower-case word: its own, else of its longest counted prefix, else the drift."""
        if word in self.known:
            return self.scores.get(word, -DRIFT)
        for size in PREFIXES:
            if len(word) >= size and "<" + word[:size] in self.known:
                return self.scores.get("<" + word[:size], -DRIFT)
        return -DRIFT

    def evidence(self, passages: list[tuple[int, int, float]], count: int) -> float:
        """Summed significance of the segments that are not expected in clean text."""
        total = 0.0
        for _, _, score in passages:
            expected = self.expected(score, count)
            if expected <= EXPECTED:
                total -= math.log(expected)
        return min(total, 200.0)

    def expected(self, score: float, count: int) -> float:
        return max(self.factor * count * math.exp(-self.decay * min(score, 200.0 / self.decay)), 1e-80)

    def probability(self, evidence: float) -> float:
        slope, base = self.curve
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, slope * evidence + base))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score) in one pass.

    Runs of costs are summed first, so the loop runs over the gains only.  The
    stack holds segments with the sum left of them and up to their end; a new
    one is merged with the nearest one on the stack that starts lower, if it
    ends higher than that one.  A search skips what cannot hold the answer, so
    the scan stays linear.
    """
    gains = np.flatnonzero(scores > 0)
    if not len(gains):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[tuple[int, int, float, float, int]] = []
    for at in gains.tolist():
        start, left, right = at, sums[at], sums[at + 1]
        while True:
            below = len(stack) - 1
            while below >= 0 and stack[below][2] >= left:
                below = stack[below][4]
            if below < 0 or stack[below][3] >= right:
                stack.append((start, at + 1, left, right, below))
                break
            start, left = stack[below][0], stack[below][2]
            del stack[below:]
    return [(start, end, float(right - left)) for start, end, left, right, _ in stack]


def labelled_counts(texts: DataFrame) -> DataFrame:
    """(word, toxic texts with it, texts with it) over rows (text, label)."""

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            total: Counter = Counter()
            toxic: Counter = Counter()
            for text, label in zip(texts_of(batch, 0), batch.column(1).to_pylist(), strict=True):
                words = set(WORD.findall(text.lower()))
                total.update(words)
                if label:
                    toxic.update(words)
            words = list(total)
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()),
                 pa.array([total[w] for w in words], pa.int64())], ["word", "toxic", "total"])

        return work

    parts = map_slices(texts.select("text", "label"), "word string, toxic long, total long", start)
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("total").alias("total"))


def token_scores(counts: DataFrame, toxic: int, total: int, least: int) -> tuple[dict[str, float], set[str]]:
    """Scores of telling tokens, and the names of those that are telling or overrule a telling prefix."""
    if not 0 < toxic < total:
        return {}, set()
    base = toxic / total

    def rated(frame: DataFrame, prior) -> DataFrame:
        rate = (F.col("toxic") + F.lit(PRIOR) * prior) / (F.col("total") + F.lit(PRIOR))
        score = F.log(rate / (1 - rate)) - F.lit(math.log(base / (1 - base)))
        # Lower end of the score interval of the share of toxic texts.
        share, n, z = F.col("toxic") / F.col("total"), F.col("total"), STANDARD_ERRORS
        low = (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        return frame.withColumn("rate", rate).withColumn("score", score).withColumn("telling", low > base)

    sums = (F.sum("toxic").alias("toxic"), F.sum("total").alias("total"))
    short = rated(counts.where(F.length("word") >= 4).groupBy(F.substring("word", 1, 4).alias("four")).agg(*sums)
                  .where(F.col("total") >= least), F.lit(base))
    five = counts.where(F.length("word") >= 5).groupBy(F.substring("word", 1, 5).alias("five")).agg(*sums).where(
        F.col("total") >= least)
    five = rated(five.withColumn("four", F.substring("five", 1, 4)).join(
        short.select("four", F.col("rate").alias("above"), F.col("telling").alias("led")), "four", "left"),
        F.coalesce("above", F.lit(base)))
    words = counts.where(F.col("total") >= least).withColumn("five", F.substring("word", 1, 5)).withColumn(
        "four", F.substring("word", 1, 4))
    words = rated(
        words.join(five.select("five", F.col("rate").alias("above5"), F.col("telling").alias("led5")), "five", "left")
        .join(short.select("four", F.col("rate").alias("above4"), F.col("telling").alias("led4")), "four", "left"),
        F.coalesce("above5", "above4", F.lit(base)))
    none = F.lit(False)
    kept = (
        short.where("telling").select(F.concat(F.lit("<"), "four").alias("token"), "score", "telling")
        .union(five.where(F.col("telling") | F.coalesce("led", none)).select(
            F.concat(F.lit("<"), "five"), "score", "telling"))
        .union(words.where(F.col("telling") | F.coalesce("led5", none) | F.coalesce("led4", none)).select(
            "word", "score", "telling")))
    found = kept.collect()
    return {r.token: r.score - DRIFT for r in found if r.telling}, {r.token for r in found}


def scanned(df: DataFrame, model: Model, column: str, length: str, name: str, result: str = "score") -> DataFrame:
    """Add (token count, largest segment, segments as (start, end, score, expected), evidence)."""
    place = df.columns.index(column)
    kind = StructType([StructField(length, LongType()), StructField(name, PASSAGES), StructField(result, DoubleType())])

    def start():
        class Known(dict):
            def __missing__(self, word: str) -> float:
                if len(self) > REMEMBERED:
                    self.clear()
                self[word] = score = model.token(word)
                return score

        known = Known()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, lists, scores = [], [], []
            for text in texts_of(batch, place):
                words = WORD.findall(text.lower())
                found = segments(np.array([known[w] for w in words])) if words else []
                counts.append(len(words))
                lists.append([{"start": s, "end": e, "score": v, "expected": model.expected(v, len(words))}
                              for s, e, v in found])
                scores.append(model.probability(model.evidence(found, len(words))))
            added = [pa.array(counts, pa.int64()), pa.array(lists, pa.list_(pa.struct(
                [("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))),
                pa.array(scores, pa.float64())]
            return pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "a", "b", "c"])

        return work

    return map_slices(df, StructType([*df.schema.fields, *kind.fields]), start)


def decay_of(weights: list[tuple[float, float]]) -> float:
    """The positive root of the mean of exp(L * score) = 1 over background tokens (score, share)."""
    if not any(score > 0 for score, _ in weights):
        return 1.0
    low, high = 0.0, 1.0
    moment = lambda x: sum(share * math.exp(min(700.0, x * score)) for score, share in weights)
    while moment(high) < 1.0 and high < 64:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if moment(middle) < 1.0 else (low, middle)
    return max(high, 1e-3)


def logistic(points: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Slope and base of a logistic curve over (x, toxic, clean) counts, each side with one half added; never toxic without any."""
    if not points:
        return 0.0, -60.0
    x = np.array([p[0] for p in points] + [0.0, max(p[0] for p in points) + 1.0])
    yes = np.array([p[1] for p in points] + [0.0, 0.5])
    no = np.array([p[2] for p in points] + [0.5, 0.0])
    at = np.zeros(2)
    design = np.stack([x, np.ones(len(x))])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(at @ design, -40, 40)))
        gradient = design @ (yes - (yes + no) * p) - 1e-3 * at
        curvature = (design * ((yes + no) * p * (1 - p))) @ design.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 0.0), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        least: int = 5) -> Model:
    """Learn from the texts whose key has a label of 0 or 1, from about ``LABELLED`` of them at most.

    The labels used are a bounded number of (key, label) rows, so they go to the
    texts and the texts stay where they are.
    """
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(
        "label in (0, 1) and key is not null")
    sizes = marks.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    if not sizes.n:
        return Model(curve=(0.0, -60.0))
    if not 0 < sizes.t < sizes.n:
        return Model(rate=sizes.t / sizes.n, curve=(0.0, 60.0 if sizes.t else -60.0))
    if sizes.n > LABELLED:
        marks = marks.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < F.lit(int(1_000_000 * LABELLED / sizes.n)))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(marks), "key").select(
        "text", "label")
    counts = labelled_counts(rows).persist()
    scores, known = token_scores(counts, sizes.t, sizes.n, least)
    model = Model(scores, frozenset(known), sizes.t / sizes.n)
    counts.unpersist()
    scan = scanned(rows, model, "text", "n_tokens", "passages").select("label", "n_tokens", "passages").persist()
    clean = scan.where("label = 0")
    spread = clean.agg(F.sum("n_tokens").alias("n")).first().n or 0
    gains = background_tokens(rows.where("label = 0"), model)
    used = sum(n for _, n in gains)
    if spread and used:
        model.decay = decay_of([(s, n / spread) for s, n in gains] + [(-DRIFT, (spread - used) / spread)])
    best = F.coalesce(F.array_max(F.transform("passages", lambda p: p["score"])), F.lit(0.0))
    # K from the mean number of tokens a clean text needs for one segment of its largest score.
    held = clean.where((F.col("n_tokens") > 0) & (best > 0)).agg(
        F.count("*").alias("m"), F.avg(F.lit(model.decay) * best - F.log("n_tokens")).alias("mean")).first()
    if held.m:
        model.factor = min(1.0, max(1e-6, math.exp(held.mean - 0.5772156649)))
    binned = evidence_bins(scan, model)
    scan.unpersist()
    model.curve = logistic(binned)
    return model


def background_tokens(clean: DataFrame, model: Model) -> list[tuple[float, int]]:
    """How often each positive token score, in steps of 0.1, comes up in clean texts."""

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            steps: Counter = Counter()
            for text in texts_of(batch, 0):
                for word, n in Counter(WORD.findall(text.lower())).items():
                    score = model.token(word)
                    if score > 0:
                        steps[round(score * 10)] += n
            return pa.RecordBatch.from_arrays(
                [pa.array(list(steps), pa.int64()), pa.array(list(steps.values()), pa.int64())], ["step", "n"])

        return work

    parts = map_slices(clean.select("text"), "step long, n long", start)
    return [(r.step / 10, r.n) for r in parts.groupBy("step").agg(F.sum("n").alias("n")).collect()]


def evidence_bins(scan: DataFrame, model: Model) -> list[tuple[float, float, float]]:
    """(evidence rounded to halves, toxic, clean) over labelled texts."""
    expected = lambda p: F.greatest(
        F.lit(model.factor) * F.col("n_tokens") * F.exp(-F.lit(model.decay) * F.least(p["score"], F.lit(200 / model.decay))),
        F.lit(1e-80))
    total = F.aggregate("passages", F.lit(0.0), lambda a, p: a + F.when(expected(p) <= EXPECTED, -F.log(expected(p))).otherwise(0.0))
    bins = scan.select((F.round(F.least(total, F.lit(200.0)) * 2) / 2).alias("x"), "label").groupBy("x").agg(
        F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no"))
    return [(r.x, float(r.yes), float(r.no)) for r in bins.collect()]


def score(df: DataFrame, model: Model, column: str = "text",
          names: tuple[str, str, str] = ("n_tokens", "passages", "score")) -> DataFrame:
    """Add the number of tokens, the passages (token places, score, expected number in clean text) and the score."""
    return scanned(df, model, column, *names)
