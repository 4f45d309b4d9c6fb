"""Nearest neighbours through randomly rotated one-bit codes.

Index.  A vector v is centred on the sample mean c and its direction
o = (v - c) / |v - c| is rotated by a random matrix with orthonormal columns, into at
least ``BITS`` dimensions.  Its code is the sign of each rotated component, packed into 64-bit words; with it
go |v - c| and <x, o>, where x is the unit vector of the signs.

Search.  A query's rotated direction q is rounded to ``PLANES`` bit planes, so
<x, q> is a weighted sum of popcounts.  <x, q> / <x, o> estimates <o, q> with a
standard error of sqrt((1 - <x, o>^2) / (D - 1)) / <x, o>; ``ERRORS`` standard errors on
either side bound the distance.  Vectors whose lower bound does not exceed the
k-th smallest upper bound are reranked on the original components.

All vectors are scanned, so that recall does not rest on clusters: blocks of
queries meet blocks of vectors, each pair of blocks is one group of bounded
size, and only a block's best k per query leave it.  Of equal vectors only the
k + 1 smallest ids can be an answer; the others are left out before anything moves.

Defined results: null vectors, zero vectors, vectors with null or non-finite
components and rows with a null id take no part, neither do vectors of another
length than the most frequent (the longest of those); ties go to the smaller id;
of rows with one id each counts; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.llm.common import quoted
from sluicework.session import ship_package

BITS = 256
PLANES = 6
ERRORS = 4.0
SEED = 7
# Vectors the centre is taken from.
SAMPLE = 10_000
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 1024


class Codes:
    """The rotation and what is computed from it; the same for a dimension, seed and centre anywhere."""

    def __init__(self, centre: np.ndarray, bits: int = BITS) -> None:
        size = len(centre)
        self.centre = centre
        self.width = -(-max(bits, size) // 64) * 64
        normal = np.random.default_rng(SEED).standard_normal((self.width, size))
        self.rotation = np.linalg.qr(normal)[0]

    def directions(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rotated unit directions and distances from the centre (a vector at the centre has direction zero)."""
        moved = vectors - self.centre
        norms = np.linalg.norm(moved, axis=1)
        return (moved / np.where(norms > 0, norms, 1.0)[:, None]) @ self.rotation.T, norms

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed sign bits, distances from the centre, and <x, o>."""
        rotated, norms = self.directions(vectors)
        packed = np.packbits(rotated > 0, axis=1, bitorder="little").view("<u8")
        return packed, norms, np.abs(rotated).sum(axis=1) / np.sqrt(self.width)

    def products(self, packed: np.ndarray, rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """<x, q> of each (query, vector) from bit planes of q, and the rounding error's length by query."""
        low, high = rotated.min(axis=1, keepdims=True), rotated.max(axis=1, keepdims=True)
        step = np.maximum((high - low) / ((1 << PLANES) - 1), 1e-300)
        steps = np.rint((rotated - low) / step).astype(np.uint8)
        ones = np.bitwise_count(packed).sum(axis=1, dtype=np.int64)
        total = np.zeros((len(rotated), len(packed)), dtype=np.int64)
        for plane in range(PLANES):
            bits = np.packbits(steps >> plane & 1, axis=1, bitorder="little").view("<u8")
            for word in range(packed.shape[1]):
                total += np.bitwise_count(bits[:, word, None] & packed[None, :, word]).astype(np.int64) << plane
        sums = steps.sum(axis=1, dtype=np.int64)[:, None]
        # A sign is 2 b - 1 and a component is low + step * s.
        product = low * (2 * ones[None, :] - self.width) + step * (2 * total - sums)
        error = np.linalg.norm(low + step * steps - rotated, axis=1)
        return product / np.sqrt(self.width), error


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null or non-finite component, not zero, not empty."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(numbers, lambda x: x != 0), F.lit(False))


def best(codes: Codes, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The k nearest of a block for each query: (query id, id, distance) arrays."""
    packed, norms, fit = codes.encode(vectors)
    rotated, lengths = codes.directions(queries)
    product, rounding = codes.products(packed, rotated)
    fit = np.maximum(fit, 1e-12)
    estimate = product / fit
    slack = ERRORS * (np.sqrt(np.maximum(1 - fit**2, 0) / (codes.width - 1)) / fit + rounding[:, None] / np.sqrt(codes.width) / fit)
    squares = norms[None, :] ** 2 + lengths[:, None] ** 2
    scale = 2 * norms[None, :] * lengths[:, None]
    lower, upper = squares - scale * np.minimum(estimate + slack, 1), squares - scale * np.maximum(estimate - slack, -1)
    own = query_ids[:, None] == ids[None, :]
    lower[own] = upper[own] = np.inf
    found = []
    for at in range(len(queries)):
        count = min(k, int(len(ids) - own[at].sum()))
        if count <= 0:
            continue
        limit = np.partition(upper[at], count - 1)[count - 1]
        chosen = np.flatnonzero(lower[at] <= limit * (1 + 1e-9) + 1e-12)
        distance = np.sqrt(((vectors[chosen] - queries[at]) ** 2).sum(axis=1))
        order = np.lexsort((ids[chosen], distance))[:k]
        found.append((np.full(len(order), query_ids[at]), ids[chosen][order], distance[order]))
    if not found:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def search(table: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other vectors of each row that ``is_query`` marks."""
    ship_package(table.sparkSession)
    rows = table.select(
        quoted(key).cast("long").alias("id"), quoted(vector).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q")).where(usable(F.col("v")) & F.col("id").isNotNull())
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    result = "query_id long, vec_id long, score double"
    size = sizes[0].n if sizes else 0
    rows = rows.where(F.size("v") == size)
    counts = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("q")).first()
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select(
        *(F.avg(F.col("v")[i]).alias(f"c{i}") for i in range(size))).first() if size else ()
    centre = np.array([x or 0.0 for x in sample])
    blocks = max(1, -(-counts.n // BLOCK_VECTORS))
    query_blocks = max(1, -(-counts.q // BLOCK_QUERIES))
    spread = lambda salt, parts: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts)).cast("int")
    queries = rows.where("q").select("id", "v", spread(1, query_blocks).alias("qb")).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    same = Window.partitionBy("v").orderBy("id")
    firsts = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1)
    vectors = firsts.select("id", "v", spread(2, blocks).alias("b")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            found = best(Codes(centre), right["id"].to_numpy(), np.stack(right["v"].to_numpy()),
                         left["id"].to_numpy(), np.stack(left["v"].to_numpy()), k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    pairs = queries.groupBy("b", "qb").cogroup(vectors.groupBy("b", "qb")).applyInPandas(meet, result)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
