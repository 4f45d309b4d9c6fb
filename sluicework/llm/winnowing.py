"""Document fingerprints by winnowing, in SQL expressions only.

A text is its words.  Each run of ``GRAM`` words has a hash, a polynomial in the
words' hashes modulo a prime: the value a rolling hash has at that place.  In
every window of ``WINDOW`` neighbouring hashes the smallest is chosen, of equal ones
the rightmost; the chosen (hash, place) pairs are the fingerprint.  Any run of
``WINDOW + GRAM - 1`` words that two texts share puts a common hash, with its places, into
both fingerprints, and runs shorter than ``GRAM`` never do.

The windows' minima come from log2(WINDOW) passes: the minimum over 2n hashes is
the smaller one of two neighbouring minima over n.  Hash and place are packed
into one number with the place counted down, so the smallest number is the
smallest hash at its rightmost place.

Defined results: a null text is the empty text; a text without words has an
empty fingerprint; one with fewer words than a gram has one hash, of all its
words; one with fewer hashes than a window has one window; two empty
fingerprints are alike (1), an empty and another are not (0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.common import SPACE_CLASS, ascii_lower, let
from sluicework.session import through_storage

GRAM = 3
WINDOW = 8
# A prime below 2**31 and a base below it: products stay within 64 bits.
PRIME = 2_147_483_647
BASE = 1_000_003
PLACE_BITS = 31
LAST_PLACE = (1 << PLACE_BITS) - 1


def gram_hashes(text: Column, gram: int = GRAM) -> Column:
    """Hashes of all word grams of a text, in order."""
    words = F.filter(F.split(ascii_lower(text), f"[{SPACE_CLASS}]+"), lambda w: w != "")

    def rolled(hashes: Column) -> Column:
        sums = hashes
        for step in range(1, gram):
            following = F.slice(hashes, step + 1, F.size(hashes))
            # Past the end the sum stays as it is, so a short text is one gram of all its words.
            sums = F.zip_with(sums, following, lambda a, b: F.coalesce((a * BASE + b) % PRIME, a))
        return F.slice(sums, 1, F.greatest(F.lit(1), F.size(hashes) - (gram - 1)))

    return let(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME))), rolled)


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Chosen (hash, place) pairs as packed numbers, in the order of places.  ``window`` is a power of two."""

    def lowest(low: Column, reach: int) -> Column:
        if reach == window:
            return F.slice(low, 1, F.greatest(F.lit(1), F.size(low) - (window - 1)))
        halves = F.zip_with(low, F.slice(low, reach + 1, F.size(low)), lambda a, b: F.least(a, b))
        return let(halves, lambda wider: lowest(wider, 2 * reach))

    packed = F.transform(gram_hashes(text, gram), lambda h, i: F.shiftleft(h, PLACE_BITS) + (F.lit(LAST_PLACE) - i))
    return F.array_distinct(let(packed, lambda first: lowest(first, 1)))


def hash_of(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def place_of(packed: Column) -> Column:
    return F.lit(LAST_PLACE) - packed.bitwiseAND(F.lit(LAST_PLACE))


def chosen_hashes(packed: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(packed, hash_of))


def written(packed: Column) -> Column:
    """A fingerprint as text: hash and place, hash in hex."""
    return F.array_join(F.transform(packed, lambda p: F.concat(
        F.lower(F.hex(hash_of(p))), F.lit("@"), place_of(p).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all of two arrays of distinct hashes."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, 1.0).otherwise(common / every)


def fingerprints(df: DataFrame, column: str = "text", output: str = "fingerprint") -> DataFrame:
    """Add a fingerprint as an array of (hash, place)."""
    packed = winnow(F.coalesce(F.col(column).cast("string"), F.lit("")))
    return df.withColumn(output, F.transform(packed, lambda p: F.struct(hash_of(p).alias("hash"), place_of(p).alias("place"))))


def neighbours(docs: DataFrame, key: str, text: str, parts: int = 64) -> DataFrame:
    """(key, nth, before, before_nth, need) for each row: the row it follows and how many characters that row takes.

    Rows are in the order of (key, hash of the text), null keys first, and the
    first follows the last.  ``nth`` numbers the rows of one key.  Ids alone are
    sorted into ranges and stored; a row looks left within its range, and a range's
    first row takes the last row of the range before it from a short table with
    one row per range.
    """
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    ids = docs.select(F.col(key).alias("key"), digest.alias("digest"), F.coalesce(F.length(text), F.lit(0)).alias("size"))
    ids = ids.repartitionByRange(parts, F.asc_nulls_first("key")).withColumn("part", F.spark_partition_id())
    # A key lies in one range, so its rows are numbered within the range.
    order = Window.partitionBy("part").orderBy(F.asc_nulls_first("key"), "digest")
    ids = through_storage(ids, "ids").withColumn("at", F.row_number().over(order))
    ids = ids.withColumn("nth", F.col("at") - F.min("at").over(Window.partitionBy("part", "key")) + 1)
    told = F.struct("key", "nth", "size")
    ids = ids.withColumn("left", F.lag(told).over(order))
    lasts = ids.groupBy("part").agg(F.max_by(told, "at").alias("end")).select(F.struct("part", "end").alias("e"))
    # One row per range, at most ``parts`` of them.
    lasts = lasts.agg(F.array_sort(F.collect_list("e")).alias("e")).select(
        F.explode(F.zip_with("e", F.concat(F.slice("e", -1, 1), F.slice("e", 1, F.greatest(F.lit(0), F.size("e") - 1))),
                             lambda a, b: F.struct(a["part"].alias("part"), b["end"].alias("end")))).alias("x"))
    lasts = lasts.select(F.col("x.part").alias("part"), F.col("x.end").alias("end"))
    left = F.coalesce("left", "end")
    return ids.join(lasts, "part").select(
        "key", "nth", left["key"].alias("before"), left["nth"].alias("before_nth"),
        F.floor(left["size"] / 4).cast("int").alias("need"))


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edit, and how alike they are.

    The edit replaces the last quarter of the characters by as many of the next
    document's first.  Returns key, n_chars, edited, fingerprint, edited_fingerprint (packed arrays),
    near_edited and near_next.  Each text moves once, to its key, and the first
    characters that its predecessor needs move on with its hashes.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # Structs with equal fields are equal, null or not, so a null key is a key like others.
    rows = docs.select(F.struct(F.col(key).alias("key")).alias("id"), whole.alias("text")).withColumn(
        "nth", F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("text"))))
    links = through_storage(neighbours(docs, key, text), "neighbours")
    links = links.select(F.struct("key").alias("link"), F.col("nth").alias("n"), F.struct(F.col("before").alias("key")).alias(
        "before"), "before_nth", "need")
    # Rows of one key are told apart after the join, so that it keeps the shuffle by key.
    ahead = rows.join(links, (F.col("id") == F.col("link")) & (F.col("nth") - F.col("n") == 0)).select(
        "before", "before_nth", F.left("text", "need").alias("start"), chosen_hashes(winnow(F.col("text"))).alias("next"))
    follows = (F.col("id") == F.col("before")) & (F.col("nth") - F.col("before_nth") == 0)
    size = F.length("text")
    edited = F.concat(F.left("text", (size - F.floor(size / 4)).cast("int")), "start")
    both = rows.join(ahead, follows).select(
        "id.key", size.cast("long").alias("n_chars"), edited.alias("edited"), winnow(F.col("text")).alias("fingerprint"),
        winnow(edited).alias("edited_fingerprint"), "next")
    own = chosen_hashes(F.col("fingerprint"))
    return both.select(
        F.col("key").alias(key), "n_chars", "edited", "fingerprint", "edited_fingerprint",
        likeness(own, chosen_hashes(F.col("edited_fingerprint"))).alias("near_edited"), likeness(own, F.col("next")).alias("near_next"))
