r"""Personal data by patterns and by bootstrapped contexts, in SQL expressions only.

Base.  Each kind has a pattern; its leftmost non-overlapping matches that pass
the kind's check are spans.  A match's place is the summed length of what stands
before it: the text split at the pattern gives the gaps, extraction the matches.
The patterns are written so that they find what the plain ones find in time
linear in the text: runs are possessive and start where a run starts, or where
the match before ended.

Bootstrapping.  Base spans are seeds.  Strings that look like an identifier but
are no base span are candidates.  Each stands in lexical patterns: the two words
left of it, and the word on either side.  Patterns and identifiers form a graph.
In every round a pattern's confidence in a kind is the score of its identifiers
over their number plus one, where at least ``SUPPORT`` of them must be known, and
a candidate's score is the noisy-or of its patterns' confidences of at least
``CONFIDENT``.  After ``ROUNDS`` rounds the candidates of confident patterns that
have the kind's shape are spans too, unless they overlap a base span.

The graph holds one row per pattern and identifier, counted before anything else
is shuffled; texts are read once and never moved.

Defined results: a null text is the empty text and has no spans; rows with the
same key and text share their result; spans of one kind do not overlap, found
ones give way to base ones of any kind; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.llm.common import fresh, let
from sluicework.session import through_storage

# Kinds in output order.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without these has no match of the kind.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9][0-9]?)(?:\.(?!$)|$)){4}$"
# What may be an identifier though no pattern says so: a token with an at sign, or a run of seven digits or more.
LOOSE = r"(?<!\S)[^\s@]++@\S++|\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+"
SHAPES = {
    "email": r"^[^\s@]+@[^\s@]+$",
    "ip": r"^[0-9]+(?:[.][0-9]+){3,}$",
    "card": r"^(?:[0-9][\x20-]?){13,19}$",
    "phone": r"^\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}$",
}
ROUNDS = 3
CONFIDENT = 0.6
SUPPORT = 2
REACH = 48

SPAN = "array<struct<start:int,end:int,found:string,before:string,after:string>>"


def placed(text: Column, pattern: str, needs: str) -> Column:
    """All matches with their places and what stands next to them."""
    def around(found: Column) -> Column:
        def beside(gaps: Column) -> Column:
            both = F.zip_with(gaps, F.slice(gaps, 2, F.size(gaps)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
            return F.zip_with(found, F.slice(both, 1, F.size(found)), lambda m, g: F.struct(
                m.alias("m"), g["a"].alias("a"), g["b"].alias("b")))

        none = F.array().cast("array<struct<m:string,a:string,b:string>>")
        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), beside)).otherwise(none)

    def step(held: Column, x: Column) -> Column:
        start = held["at"] + F.length(x["a"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("found"),
                        F.right(x["a"], F.lit(REACH)).alias("before"), F.left(x["b"], F.lit(REACH)).alias("after"))
        return F.struct(end.alias("at"), F.array_append(held["out"], span).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    matches = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), around)
    spans = F.aggregate(matches, start, step, lambda held: held["out"])
    return F.when(text.rlike(needs), spans).otherwise(F.array().cast(SPAN))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.split(F.reverse(number), "")
    # Every second digit from the right doubles; a two-digit double loses 9.
    values = F.transform(places, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def passes(kind: str, found: Column) -> Column:
    """The check of a kind's match."""
    size = F.length(digits(found))
    if kind == "ip":
        return found.rlike(OCTETS)
    if kind == "card":
        return F.when(size.between(16, 19), luhn(digits(found))).otherwise(False)
    if kind == "phone":
        return size.between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(placed(text, PATTERNS[kind], NEEDS[kind]), lambda s: passes(kind, s["found"]))


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def contexts(span: Column) -> Column:
    """The lexical patterns a span stands in."""
    left = F.regexp_extract(F.lower(span["before"]), r"(\S+)\s*$", 1)
    two = F.regexp_extract(F.lower(span["before"]), r"(\S+\s+\S+)\s*$", 1)
    right = F.regexp_extract(F.lower(span["after"]), r"^\s*(\S+)", 1)
    both = F.when((left != "") & (right != ""), F.concat(left, F.lit(" _ "), right))
    return F.filter(F.array(both, F.when(two != "", F.concat(two, F.lit(" _")))), lambda p: p.isNotNull())


def extracted(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, row, one array of base spans per kind, candidates), stored; the only pass over the texts."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias(key), F.xxhash64(F.col(key), F.col(text)).alias("row"), whole.alias("whole"))
    rows = rows.select(key, "row", *(base_spans(F.col("whole"), k).alias(k) for k in KINDS),
                       placed(F.col("whole"), LOOSE, r"@|[0-9][\x20().-]{0,2}[0-9]").alias("loose"))
    taken = F.flatten(F.array(*(F.transform(k, lambda s: F.struct(s["start"], s["end"])) for k in KINDS)))
    free = F.filter("loose", lambda c: ~F.exists(
        taken, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])))
    return through_storage(rows.withColumn("loose", free), "spans")


def mentions(rows: DataFrame) -> DataFrame:
    """(row, start, end, found, kind or null, pattern): base spans and candidates in their patterns."""
    of = lambda column, kind: F.transform(column, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lower(s["found"]).alias("found"),
        F.lit(kind).cast("string").alias("kind"), contexts(s).alias("patterns")))
    every = F.concat(*(of(k, k) for k in KINDS), of("loose", None))
    spans = rows.select("row", F.inline(every))
    return spans.select("row", "start", "end", "found", "kind", F.explode("patterns").alias("pattern"))


def confident_patterns(seen: DataFrame) -> DataFrame:
    """(pattern, kind): what the rounds over the graph of patterns and identifiers end with."""
    graph = seen.groupBy("pattern", "found").agg(F.max("kind").alias("kind"))
    # A pattern needs SUPPORT known identifiers and something to find.
    useful = graph.groupBy("pattern").agg(F.count("*").alias("size")).where(F.col("size") >= SUPPORT)
    graph = through_storage(graph.join(useful, "pattern"), "graph")
    seeds = graph.where("kind is not null").select("found", "kind", F.lit(1.0).alias("score")).distinct()
    known = seeds
    for turn in range(ROUNDS):
        told = graph.select("pattern", "found", "size").join(known, "found")
        rated = told.groupBy("pattern", "kind").agg(
            (F.sum("score") / (F.first("size") + 1)).alias("trust"), F.count("*").alias("n")).where(
            (F.col("n") >= SUPPORT) & (F.col("trust") >= CONFIDENT))
        rated = through_storage(rated.select("pattern", "kind", "trust"), "patterns")
        if turn + 1 < ROUNDS:
            fresh = graph.where("kind is null").select("pattern", "found").join(rated, "pattern").groupBy(
                "found", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.least("trust", F.lit(0.99)))))).alias("score"))
            known = seeds.unionByName(through_storage(fresh, "found"))
    return rated.select("pattern", "kind")


def discovered(rows: DataFrame) -> DataFrame:
    """(row, new): spans (kind, start, end) that confident patterns add, by row."""
    seen = mentions(rows)
    patterns = confident_patterns(seen)
    shaped = F.lit(False)
    for kind, shape in SHAPES.items():
        shaped = shaped | ((F.col("p.kind") == kind) & F.col("found").rlike(shape))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    added = seen.alias("s").where("s.kind is null").join(patterns.alias("p"), "pattern").where(shaped).select(
        "row", F.col("p.kind").alias("kind"), "start", "end")
    # One kind per span, the first in output order.
    added = added.groupBy("row", "start", "end").agg(F.min_by("kind", order).alias("kind"))
    return added.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("new"))


def find_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, row, base, spans): ``find`` with the hash of (key, text) that tells rows of one key apart."""
    rows = extracted(docs, key, text)
    plain = lambda column, kind: F.transform(column, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    new = discovered(rows)
    every = rows.select(key, "row", *KINDS).join(new, "row", "left")
    more = F.coalesce("new", F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    both = [F.array_sort(F.concat(plain(k, k), of_kind(more, k))) for k in KINDS]
    return every.select(key, "row", F.concat(*(plain(k, k) for k in KINDS)).alias("base"), F.concat(*both).alias("spans"))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, spans): arrays of (kind, start, end) by kind and start; end is exclusive, places are code points."""
    return find_rows(docs, key, text).drop("row")


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents whose personal data is replaced by its kind in angle brackets; all rows and columns are kept."""
    row, spans = fresh("row", docs.columns), fresh("spans", docs.columns)
    found = find_rows(docs, key, text).where(F.size("spans") > 0).groupBy(F.col("row").alias(row)).agg(
        F.first("spans").alias(spans))
    joined = docs.withColumn(row, F.xxhash64(F.col(key), F.col(text))).join(found, row, "left")
    shown = F.when(F.col(spans).isNull(), F.col(text)).otherwise(redact(F.col(text), F.col(spans)))
    return joined.withColumn(text, shown).select(*docs.columns)


def redact(text: Column, spans: Column) -> Column:
    """A text with its spans replaced by their kinds; of overlapping spans the one that starts first counts."""
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(held: Column, s: Column) -> Column:
        piece = F.struct(F.concat(held["out"], F.substring(text, held["at"] + 1, s["start"] - held["at"]),
                                  F.lit("<"), s["kind"], F.lit(">")).alias("out"), s["end"].alias("at"))
        return F.when(s["start"] >= held["at"], piece).otherwise(held)

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(by_start, begin, step, lambda held: F.concat(
        held["out"], F.substring(text, held["at"] + 1, F.length(text))))
