"""The operators over small frames: odd rows, empty tables, clashing columns, brute force."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from sluicework.llm import ann, bpe, chat, components, kneserney, licenses, mixing, pii, simhash, toxicity, winnowing
from sluicework.llm.catalog import CATALOG
from tests.conftest import explained
from tests.llm.test_small_pieces import RANKS

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Extra columns whose names the operators use inside.
CLASHES = ["row", "key", "size", "score", "n_tokens", "passages", "ids", "label", "part", "nth", "spans", "start", "fingerprint"]

ODD = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (None, "a text without an id that is long enough", "en", "b", 9),
    (4, "   \t\n ", "en", None, 3),
    (5, "word " * 4000, "en", "a", 0),
    (6, "x" * 30000, "de", "c", 0),
    (7, "mail a.b@c.example.com now, +1 (234) 555-6789 or 10.0.0.255; 4111 1111 1111 1111. Gesperrt 🎉 10.0.0.256", "de", "c", 0),
    (8, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0. CC-BY", "en", "a", 0),
    (-9, "ß é 漢字 MIXED Case words, the quick brown fox jumps over", "fr", "z", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENTS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


def clashing(frame):
    for name in CLASHES:
        frame = frame.withColumn(name, F.lit(name))
    return frame


def words(text):
    return (text or "").encode().lower().split()


# -- op1 ---------------------------------------------------------------------------------------------------------------


def test_search_takes_odd_vectors(spark):
    rows = [(i, [float(i % 7), float(i % 3), 1.0]) for i in range(40)]
    rows += [(100, None), (101, [0.0, 0.0, 0.0]), (102, [float("nan"), 1.0, 1.0]), (103, [float("inf"), 1.0, 1.0]),
             (104, [1.0, None, 1.0]), (105, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (200, [1.0, 1.0, 1.0]), (300, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("q", F.lit(1))
    got = ann.search(table, F.col("vec_id") % 10 == 0).collect()
    good = [(i, np.array(v)) for i, v in rows if i is not None and v and len(v) == 3 and None not in v and np.isfinite(v).all() and any(v)]
    for i, v in good:
        if i % 10 == 0:
            expected = sorted((float(np.sqrt(((w - v) ** 2).sum())), j) for j, w in good if j != i)[:10]
            assert [(r.rank, r.vec_id, pytest.approx(r.score)) for r in sorted((r for r in got if r.query_id == i), key=lambda r: r.rank)] == [
                (k + 1, j, d) for k, (d, j) in enumerate(expected)]
    assert ann.search(table.limit(0), F.lit(True)).count() == 0
    assert ann.search(spark.createDataFrame(rows[:2], "vec_id long, embedding array<float>"), F.lit(True)).count() in (0, 2)


# -- op2 ---------------------------------------------------------------------------------------------------------------


def test_the_mix_meets_its_targets(spark, odd, none):
    docs, plan, slots = mixing.mixed(clashing(odd), block=64)
    got = docs.collect()
    assert len(got) == len(ODD)
    assert sorted(r["size"] for r in got) == sorted(len(words(t)) for _, t, *_ in ODD)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.taken <= 2 * r["size"]
    names = sorted({s for _, _, _, s, _ in ODD}, key=lambda s: (s is None, s or ""))
    assert [taken[i] for i in range(len(names))] == [round(t) for t in plan.targets]
    assert slots.select("source", "slot").distinct().count() == slots.count() == plan.quotas.sum()
    again = mixing.mixed(odd, block=64)[0].collect()
    assert sorted(map(str, (r.asDict() for r in again))) == sorted(map(str, (r.asDict() for r in got)))
    assert mixing.mixed(none)[0].count() == 0


def test_shards_share_out_all_slots(spark):
    plan = mixing.plan(np.array([5000, 700, 0, 90]), np.array([3.0, 1, 2, 3]), block=8)
    rows = mixing.draws(spark, plan, shard_slots=100).collect()
    per_shard, places = Counter(), defaultdict(list)
    for r in rows:
        per_shard[r.shard] += r.n
        places[r.source] += range(r["first"], r["first"] + r.n)
    assert all(n == 100 for s, n in per_shard.items() if s < max(per_shard))
    assert {s: sorted(p) for s, p in places.items()} == {i: list(range(q)) for i, q in enumerate(plan.quotas.tolist()) if q}


def test_a_stage_of_the_mix_has_one_python_pass(spark):
    plan = mixing.plan(np.array([5000, 700, 0, 90]), np.array([3.0, 1, 2, 3]), block=8)
    made = mixing.slots(spark, plan, block=8)
    text = explained(made)
    assert text.count(") MapInArrow") == 1 and "MapInPandas" not in text
    # Rows made from a list would go through Python workers of a pool of their own.
    assert "ExistingRDD" not in explained(mixing.draws(spark, plan, shard_slots=100))
    places = defaultdict(list)
    for r in made.collect():
        places[r.source].append(r.slot)
        assert 0 <= r.block < plan.blocks[r.source] and 0 < r.words <= 8
    assert {s: sorted(p) for s, p in places.items()} == {i: list(range(q)) for i, q in enumerate(plan.quotas.tolist()) if q}


def test_mixed_texts_hold_the_words_taken(odd):
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    taken = {r.key: r.taken for r in mixing.mixed(docs, block=16)[0].collect()}
    got = Counter()
    whole = {i: words(t) for i, t, *_ in ODD}
    for r in mixing.mixed_texts(clashing(docs), block=16).collect():
        got[r.doc_id] += len(words(r.text))
        assert not set(words(r.text)) - set(whole[r.doc_id])
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in taken.items() if v}
    assert mixing.mixed_texts(odd.limit(0)).count() == 0


# -- op3 ---------------------------------------------------------------------------------------------------------------


def brute_winnow(text):
    found = [xxhash.xxh64_intdigest(w, 42) for w in words(text)]
    hashes = [(h - (1 << 64) if h >> 63 else h) % winnowing.PRIME for h in found]
    size = min(winnowing.GRAM, len(hashes))
    grams = []
    for i in range(len(hashes) - size + 1 if hashes else 0):
        value = hashes[i]
        for h in hashes[i + 1:i + size]:
            value = (value * winnowing.BASE + h) % winnowing.PRIME
        grams.append(value)
    chosen = []
    for i in range(max(1, len(grams) - winnowing.WINDOW + 1) if grams else 0):
        window = grams[i:i + winnowing.WINDOW]
        low = min(window)
        place = i + max(k for k, g in enumerate(window) if g == low)
        if not chosen or chosen[-1] != (low, place):
            chosen.append((low, place))
    return chosen


def test_fingerprints_are_the_windows_minima(odd):
    for r in winnowing.fingerprints(odd).collect():
        assert [(p["hash"], p.place) for p in r.fingerprint] == brute_winnow(r.text)


def test_edits_take_the_next_document(odd, none):
    docs = sorted(((i, t or "") for i, t, *_ in ODD if i != 1), key=lambda r: (r[0] is not None, r[0] or 0))
    frame = odd.where("doc_id is null or doc_id <> 1")
    got = {r.doc_id: r for r in winnowing.compared(clashing(frame)).collect()}
    for k, (i, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        quarter = len(text) // 4
        assert got[i].edited == text[:len(text) - quarter] + following[:quarter]
        own, other = ({h for h, _ in brute_winnow(t)} for t in (text, following))
        assert got[i].near_next == pytest.approx(len(own & other) / len(own | other) if own | other else 1.0)
    assert winnowing.compared(odd).count() == len(ODD)
    assert winnowing.compared(none).count() == 0
    assert winnowing.compared(odd.where("doc_id = 5")).first().near_next == 1.0


# -- op4 ---------------------------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, found):
    figures = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(figures)))
        return 16 <= len(figures) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(figures) <= 15


def test_base_spans_are_the_plain_patterns(spark):
    import random

    draw = random.Random(8)
    pieces = ["a@b.c", "a@b.c_d@e.f", "@", ".", "..", "-", " ", "+1 ", "(", ")", "1.2.3.4", "1.2.3.4.5.6.7.8", "255", "0256.1.1.001", "4111 1111 1111 1111",
              "4111-1111-1111-1112", "x", "é", "🎉", "+49 (0) 123-456 78", "+1", "9", "\n", "a.b%c@d-e.fg."]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 14))) for _ in range(1500)]
    texts += [t or "" for _, t, *_ in ODD] + ["1" * 20000, "1." * 9000, "a" * 20000 + "@", "+1" + " " * 9000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.base] for r in pii.find(frame).collect()}
    for i, text in enumerate(texts):
        assert got[i] == [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if passes(k, m.group())], text[:200]


def test_contexts_find_unseen_identifiers(spark):
    texts = [f"please call +1 (234) 555-00{i:02d} today {i}" for i in range(12)] + ["please call (234) 555-9999 today or tomorrow"]
    texts += ["the number 1234567890 is a count", "nothing here"]
    frame = clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(frame).collect()}
    assert got[12] == [("phone", 12, 26)] and got[13] == [] and got[14] == []
    shown = {r.doc_id: r.text for r in pii.masked(frame).collect()}
    assert shown[12] == "please call <phone> today or tomorrow" and shown[0] == "please call <phone> today 0"


def test_masking_keeps_rows_and_columns(odd, none):
    shown = pii.masked(clashing(odd))
    assert shown.columns == clashing(odd).columns and shown.count() == len(ODD)
    assert shown.where("doc_id = 7").first().text == "mail <email> now, <phone> or <ip>; <card>. Gesperrt 🎉 10.0.0.256"
    assert pii.find(none).count() == 0


# -- op5 ---------------------------------------------------------------------------------------------------------------


def test_license_labels(odd, none):
    got = {r.doc_id: r for r in licenses.scan(odd).collect()}
    assert {m.label for m in got[8].matches if m.phrase} == {"mit", "apache", "cc-by"}
    assert [m.start for m in got[8].matches if m.phrase and m.label == "mit"] == [3]
    assert got[2].n_words == got[3].n_words == 0 and got[5].n_words == 4000 and not got[6].matches
    assert licenses.scan(none).count() == 0


# -- op6 ---------------------------------------------------------------------------------------------------------------


def test_toxic_words_are_learnt(spark, odd, none):
    rows = [(i, f"some plain words number{i} about the weather " * 3 + ("you horrid villain" if i % 5 == 0 else ""), int(i % 5 == 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs, docs.where("doc_id % 4 <> 2"))
    scored = toxicity.score(docs.drop("toxic"), model).join(docs.select("doc_id", "toxic"), "doc_id").collect()
    assert all((r.score >= 0.3) == bool(r.toxic) for r in scored)
    passage = next(r for r in scored if r.toxic).passages[-1]
    assert passage.end - passage.start in (2, 3)
    names = ("n_tokens_", "passages_", "score_")
    assert toxicity.score(clashing(odd), model, "text", names).where("score_ between 0 and 1").count() == len(ODD)
    assert toxicity.score(none, model).count() == 0


@pytest.mark.parametrize(("label", "expected"), [(None, 0.0), (0, 0.0), (1, 1.0)])
def test_labels_of_one_kind(spark, odd, label, expected):
    labels = spark.createDataFrame([] if label is None else [(1, label), (3, label), (None, label), (4, None)], "doc_id long, toxic int")
    scores = [r.score for r in toxicity.score(odd, toxicity.fit(odd, labels)).collect()]
    assert all(s == pytest.approx(expected, abs=1e-6) for s in scores)


# -- op7 ---------------------------------------------------------------------------------------------------------------


def test_scores_are_kneser_ney_s(spark, none, monkeypatch):
    texts = [t for _, t, *_ in ODD] + ["the fox jumps over the dog", "the dog jumps", "a fox and a dog and a fox"] * 2
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    model = kneserney.count_model(frame, 10 * kneserney.SHARE)
    sequences = [["START", *words(t), "END"] for t in texts]
    pairs = Counter(p for s in sequences for p in zip(s, s[1:], strict=False))
    single = Counter(w for s in sequences for w in s[1:])
    left, follow, kinds = Counter(), Counter(), defaultdict(Counter)
    for (u, w), n in pairs.items():
        left[w] += 1
        follow[u] += n
        kinds[u][min(n, 3)] += 1
    level = lambda counts: kneserney.Level.of(*(sum(n == k for n in counts) for k in (1, 2, 3, 4)))
    cut = lambda discounts, n: (0, discounts.one, discounts.two, discounts.more)[min(n, 3)]
    two, one = level(pairs.values()), level(left.values())
    rest = sum(cut(one, n) for n in left.values()) / len(pairs) / (len(left) + 1)
    lower = lambda w: max(left[w] - cut(one, left[w]), 0) / len(pairs) + rest
    queries = [*texts, "unseen words entirely", "the unseen fox"]
    got = kneserney.score(spark.createDataFrame([(i, t) for i, t in enumerate(queries)], "i int, text string"), model).collect()
    assert (model.tokens, model.vocabulary, model.distinct_pairs) == (sum(single.values()), len(single), len(pairs))
    for r in got:
        sequence = ["START", *words(queries[r.i]), "END"]
        total = base = 0.0
        for u, w in zip(sequence, sequence[1:], strict=False):
            p = lower(w)
            if follow[u]:
                saved = sum(cut(two, k) * n for k, n in kinds[u].items())
                p = (max(pairs[u, w] - cut(two, pairs[u, w]), 0) + saved * p) / follow[u]
            total += math.log10(p)
            base += math.log10((single[w] + 0.5) / (model.tokens + 0.5 * (len(single) + 1)))
        assert r.score == pytest.approx(total, rel=1e-9) and r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.n_tokens, r.n_known) == (len(sequence) - 1, sum(single[w] > 0 for w in sequence[1:]))
    empty = kneserney.count_model(none, 0)
    assert kneserney.score(frame, empty).where("n_known = 0").count() == len(texts)


def test_trigram_scores_are_kneser_ney_s(spark):
    texts = ["the fox jumps over the dog", "the dog jumps", "a fox and a dog and a fox", "the fox jumps over a dog", "", "the"] * 2 + [
        "over the fox jumps the dog", "a fox jumps over the dog and a fox"]
    model = kneserney.count_model(spark.createDataFrame([(t,) for t in texts], "text string"), 10 * kneserney.SHARE, order=3)
    padded = lambda t: ["START", "START", *words(t), "END"]
    triples = Counter(x for t in texts for x in zip(padded(t), padded(t)[1:], padded(t)[2:], strict=False))
    pairs, left = Counter(), Counter()
    for (_, u, w), n in triples.items():
        pairs[u, w] += n if u == "START" else 1
    for _, w in pairs:
        left[w] += 1
    level = lambda counts: kneserney.Level.of(*(sum(n == k for n in counts) for k in (1, 2, 3, 4)))
    cut = lambda d, n: (0, d.one, d.two, d.more)[min(n, 3)]
    three, two, one = level(triples.values()), level(pairs.values()), level(left.values())
    rest = sum(cut(one, n) for n in left.values()) / len(pairs) / (len(left) + 1)

    def above(table, discounts, context, w, lower):
        own = {x[-1]: n for x, n in table.items() if x[:-1] == context}
        if not own:
            return lower
        return (max(own.get(w, 0) - cut(discounts, own.get(w, 0)), 0) + sum(cut(discounts, n) for n in own.values()) * lower) / sum(own.values())

    queries = [*texts, "unseen words entirely", "the unseen fox jumps", "dog jumps over the fox"]
    got = kneserney.score(spark.createDataFrame(list(enumerate(queries)), "i int, text string"), model).collect()
    assert (model.distinct_triples, model.distinct_pairs, model.tokens) == (len(triples), len(pairs), sum(triples.values()))
    for r in got:
        s = padded(queries[r.i])
        total = 0.0
        for t, u, w in zip(s, s[1:], s[2:], strict=False):
            lower = max(left[w] - cut(one, left[w]), 0) / len(pairs) + rest
            total += math.log10(above(triples, three, (t, u), w, above(pairs, two, (u,), w, lower)))
        assert r.score == pytest.approx(total, rel=1e-9)



# -- op8 ---------------------------------------------------------------------------------------------------------------


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (60, 0), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_and_components(spark, odd, none):
    prints = simhash.fingerprints(odd.select("doc_id", "text"), "text", keep=False).withColumn("fingerprint", F.col("fingerprint")[0])
    for i, text in ((1, ODD[0][1]), (3, ""), (6, "x" * 30000), (-9, ODD[-1][1])):
        ws = words(text)
        hashes = [xxhash.xxh64_intdigest(b" ".join(ws[k:k + 3]), 42) for k in range(max(1, len(ws) - 2))] if ws else []
        value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert prints.where(F.col("doc_id") == i).first().fingerprint & (2**64 - 1) == value
    got = {(r.doc_id, r.component_id) for r in simhash.with_components(prints, "doc_id").collect()}
    assert {(2, 2), (3, 2), (4, 2), (1, 1), (5, 5), (None, None)} <= got and len(got) == 10
    values = [1, 3, 7, 1 << 40, 1 << 40 | 1 << 63, 0b1111 << 20]
    signed = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    linked = simhash.with_components(spark.createDataFrame(signed, "doc_id long, fingerprint long"), "doc_id")
    assert {r.doc_id: r.component_id for r in linked.collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 5}


def test_near_copies_go(spark, odd, none):
    import random

    draw = random.Random(6)
    base = [draw.choice("abcdefghijklmnopqrstuvwxyz") + str(draw.randint(0, 400)) for _ in range(300)]
    rows = []
    for i in range(40):
        copy = list(base)
        copy[draw.randrange(300)] = f"changed{i}"
        rows.append((i, " ".join(copy)))
    rows += [(100 + i, " ".join(draw.choice("abcdefg") + str(draw.randint(0, 4000)) for _ in range(200))) for i in range(40)]
    kept = simhash.one_of_each(clashing(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(100, 140)]
    left = [r.doc_id for r in simhash.one_of_each(odd).collect()]
    assert Counter(left) == Counter([1, 2, None, 5, 6, 7, 8, -9])
    assert simhash.one_of_each(none).count() == 0


def near_rows():
    """Pairs of a shingle similarity of 0.6, 0.7, 0.8 and 0.85, and chains of versions 0.8 apart."""
    rows, fresh_words = [], (f"w{i}" for i in range(10**6))
    draw = lambda n: [next(fresh_words) for _ in range(n)]
    for n, shared in ((80, 60), (85, 70), (90, 80), (74, 68)):
        for _ in range(25):
            head = draw(shared + 4)
            rows += [" ".join(head + draw(n - shared)) for _ in range(2)]
    for _ in range(5):
        long = draw(94 + 10 * 12)
        rows += [" ".join(long[at:at + 94]) for at in range(0, 121, 10)]
    return [(i * 7919 % 100_003, text, "en", "abc"[i % 3], len(text)) for i, text in enumerate(rows)]


def kept_by_brute_force(rows):
    """Ids of the smallest row of each component of pairs of similarity 0.8 or more."""
    sets = {}
    for i, text, *_ in rows:
        ws = text.split()
        sets[i] = {tuple(ws[k:k + 5]) for k in range(max(1, len(ws) - 4))}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if root[a] < root[b] and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                    root[b], changed = root[a], True
    return {i for i in sets if root[i] == i}


def test_near_copies_are_those_of_brute_force(spark):
    rows = near_rows()
    expected = kept_by_brute_force(rows)
    assert len(expected) == 2 * 50 + 50 + 5
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, DOCUMENTS), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_crowded_keys_give_the_same_pairs(monkeypatch):
    import random

    draw = random.Random(3)
    rows = sorted((draw.randrange(6), draw.randrange(50, 90), draw.randrange(30), k) for k in range(300))
    key, size, at, node = (np.array(x) for x in zip(*rows, strict=True))
    comp = np.where(node % 3 > 0, 0, node)
    even, odd = (np.array([draw.getrandbits(63) & draw.getrandbits(63) & draw.getrandbits(63) for _ in rows]) for _ in range(2))
    differ = lambda i, j: int(even[i] ^ even[j]).bit_count() + int(odd[i] ^ odd[j]).bit_count()
    even[:200] = odd[:200] = 0
    pairs = {(min(a, b), max(a, b)) for i, a in enumerate(node.tolist()) for j, b in enumerate(node.tolist())
             if i < j and 9 * differ(i, j) <= size[i] + size[j] and key[i] == key[j] and comp[i] != comp[j] and 4 * max(size[i], size[j]) <= 5 * min(size[i], size[j])
             and 9 * min(size[i] - at[i], size[j] - at[j]) >= 4 * (size[i] + size[j])}
    for wide in (2, 10**6):
        monkeypatch.setattr(simhash, "WIDE", wide)
        a, b = simhash.cross_pairs(key, node, comp, size, at, even, odd)
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == pairs and len(a) == len(pairs)


def test_parities_bound_how_far_sets_differ():
    import random

    draw = random.Random(4)
    for _ in range(200):
        common = {draw.getrandbits(64) for _ in range(draw.randrange(300))}
        sets = [common | {draw.getrandbits(64) for _ in range(draw.randrange(60))} for _ in range(2)]
        (a, b), (c, d) = (simhash.parity_of(np.array(sorted(s), dtype=np.uint64)) for s in sets)
        differ = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in ((a, c), (b, d)))
        assert differ <= len(sets[0] ^ sets[1])


def test_rows_go_by_key_and_text(spark):
    """Rows that share a key stay apart; rows without a key are near copies like others."""
    words = [f"w{i}" for i in range(300)]
    text = " ".join(words)
    rows = [(1, text), (2, text + " more"), (2, "another text of the same key, clean and long"), (3, "a"), (3, "b"), (3, "b"),
            (None, text + " end"), (None, "alone")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(
        [rows[0], rows[2], rows[3], rows[4], rows[7]], key=repr)


# -- op9 ---------------------------------------------------------------------------------------------------------------


def test_any_conversation_reads_back(spark):
    import random

    draw = random.Random(9)
    pieces = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\\\", "[", "<", "]", "a", " ", "\n", "[ROLE] ", "[/ROLE]", "[ANSW] ", "é🎉", "\\[INST]"]
    roles = ["user", "assistant", "system", "tool", "", None, "we[ird\\", "a\nb", "<s>[INST] x [/INST]"]
    rows = [(i, t, draw.choice(roles), draw.choice([None, "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))]))
            for i in range(200) for t in range(draw.randint(1, 5))]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (None, None, "user", "x"), (300, 0, "user", "y" * 50000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("key", F.lit(1))
    out = chat.format_turns(frame)
    assert out.where("not faithful").count() == 0
    source = defaultdict(list)
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or 0, r[2] or "", r[3] or "")):
        source[conv].append((role or "", text or ""))
    for r in out.select("conv_id", chat.parse(F.col("formatted")).alias("turns")).collect():
        assert [(t.role, t.text) for t in r.turns] == source[r.conv_id]
    assert chat.format_turns(frame.limit(0)).count() == 0


# -- op10 --------------------------------------------------------------------------------------------------------------


def test_round_trip(odd, none):
    ids = bpe.encode(clashing(odd), "text", RANKS, corpus_pipeline.public_tokenizers.PATTERN, "token_ids")
    got = bpe.decode(ids, "token_ids", RANKS, "decoded").collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in got) and len(got) == len(ODD)
    assert bpe.encode(none, "text", RANKS, corpus_pipeline.public_tokenizers.PATTERN).count() == 0


def test_one_pass_encodes_and_decodes(spark, odd, none):
    pattern = corpus_pipeline.public_tokenizers.PATTERN
    apart = bpe.decode(bpe.encode(clashing(odd), "text", RANKS, pattern, "token_ids"), "token_ids", RANKS, "decoded")
    once = bpe.round_trip(clashing(odd), "text", RANKS, pattern, "token_ids", "decoded")
    assert once.schema == apart.schema
    assert sorted(map(repr, once.collect())) == sorted(map(repr, apart.collect()))
    assert bpe.round_trip(none, "text", RANKS, pattern, keep=False).columns == [c for c in none.columns if c != "text"] + ["token_ids", "decoded"]
    # Every Python pass of a stage keeps a worker of its own in an executor's memory.
    assert explained(corpus_pipeline.encode_texts(spark, odd, "")).count(") MapInArrow") == 1


# -- queries and the pipeline ------------------------------------------------------------------------------------------


def test_every_operator_has_its_query(spark, sf):
    assert sorted(int(n[2:].split("_")[0]) for n in CATALOG.queries if n.startswith("op")) == list(range(1, 11))
    got = CATALOG.queries["op10_bpe_roundtrip"](spark, sf).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in got)


def test_stages_keep_the_columns(spark, odd, none, tmp_path):
    spark.createDataFrame([(1, 1, 0), (7, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = stage(spark, clashing(docs) if docs is odd else docs, str(tmp_path))
            if stage is not corpus_pipeline.encode_texts:
                assert set(before) <= set(docs.columns)
                docs = spark.createDataFrame(docs.select(*before).collect(), docs.select(*before).schema)


def test_token_ids_decode_to_the_text(spark, odd):
    got = corpus_pipeline.encode_texts(spark, odd, "").collect()
    assert len(got) == len(ODD)
    assert all(r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in got)


def test_full_run_keeps_one_of_each(spark, tmp_path):
    rows = near_rows()
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(rows[0][0], 1, 0), (-1, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert got and {r.doc_id for r in got} <= kept_by_brute_force(rows)
    assert all(r.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for r in got)
