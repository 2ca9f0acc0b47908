"""Exact top-k search over a bit-sliced index.

Vectors are quantised to integers and dealt into blocks. Of each block the index holds, for every component, one bitmap
per binary digit (two's complement), a bit per vector. A query's inner products with a whole block are a sum of slices:
each component adds its number, shifted by the set digits of the query's own component, and adders of three bitmaps
into two do all additions of a digit at once. The sum stands in slices too; the top rows are selected from its most
significant slice downward, keeping the rows surely in and those still tied, and ties at the boundary go to the smaller
ids, which lie first in the block. Blocks then merge their few best rows. All rows are indexed and all are scored.

The index side is dealt to its blocks once; the stated queries are sent to every block and streamed past its index, so a
task holds one block's slices and a batch of queries at a time. Only a table of fewer blocks than there are tasks is
dealt to several tasks a block, each with a part of the queries.

Defined results: null vectors and vectors with null or non-finite components take no part, as queries and as
candidates; neither do rows with a null id. A row is no candidate for itself; rows that repeat its id are, equal vectors
included, and each row whose id every divides asks. Equal rows are counted before they are dealt, and of more than k + 1
only so many can matter. Vectors of other lengths, empty ones too, count as filled up with zeros. Fewer candidates than k
give fewer rows, an empty table none. A row with components so large that a score might not fit 64 bits is left out of the
slices and scored by Python's integers; a score beyond 64 bits counts as the nearest long. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of a block's vectors as numbers (their slices take about a fifth), and queries of a task at least.
BLOCK_BYTES, PART = 1 << 25, 64
QUERY_EVERY, TOP, SCALE = 50, 5, 256


def slices(values: np.ndarray) -> list[np.ndarray]:
    """Bitmaps of the digits of integers in two's complement; the last is the sign, which counts negatively."""
    bits = max(int(values.max(initial=0)), int(-values.min(initial=0) - 1), 0).bit_length() + 1
    pad = -len(values) % 64
    padded = np.concatenate([values, np.zeros(pad, values.dtype)])
    return [np.packbits(((padded >> b) & 1).astype(np.uint8), bitorder="little").view(np.uint64) for b in range(bits)]


class BlockIndex:
    """Slices of a block's vectors, by component, with their ids in ascending order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        each = [slices(c) for c in self.vectors.T]
        self.words = -(-len(ids) // 64)
        # a row for each slice, those of a component from its first on, then their complements
        self.bits = [len(s) for s in each]
        self.first = [0, *accumulate(self.bits)]
        plain = np.array([bitmap for s in each for bitmap in s], np.uint64).reshape(-1, self.words)
        self.slices = np.concatenate([plain, ~plain])
        self.all = np.packbits(np.arange(64 * self.words) < len(ids), bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the inner products; the last is the sign."""
        # which slices count, each with its weight; negative parts are complemented: -x = ~x + 1
        rows, weights, constant, turned = [], [], 0, len(self.slices) // 2
        width = 2 + int(sum(abs(int(q)) << (n - 1) for q, n in zip(query, self.bits, strict=False))).bit_length()
        for q, first, n in zip(query.tolist(), self.first, self.bits, strict=False):
            for shift, sign in _digits(int(q)):
                # a negative weight: (1 - x) counts positively, less a constant
                constant -= (1 << (n - 1) if sign > 0 else (1 << (n - 1)) - 1) << shift
                lower, top = (0, turned) if sign > 0 else (turned, 0)
                rows += [*range(lower + first, lower + first + n - 1), top + first + n - 1]
                weights += range(shift, shift + n)
        constant &= (1 << width) - 1
        order = np.argsort(np.array(weights, np.int64), kind="stable")
        rows, weights = np.array(rows, np.int64)[order], np.array(weights, np.int64)[order]
        edges = np.searchsorted(weights, np.arange(width + 1))
        ones = np.full((1, self.words), ~np.uint64(0))
        out, carried = [], []
        for b in range(width):
            now = np.concatenate([self.slices[rows[edges[b] : edges[b + 1]]], *carried, ones[: constant >> b & 1]])
            carried = []
            while len(now) > 2:  # full adders, all of a digit at once: three bitmaps give a sum and a carry
                n, rest = divmod(len(now), 3)
                x, y, z = now[:n], now[n : 2 * n], now[2 * n : 3 * n]
                carry, either = x & y, x ^ y
                np.bitwise_xor(either, z, out=x)
                either &= z
                carry |= either
                carried.append(carry)
                now[n : n + rest] = now[3 * n :]
                now = now[: n + rest]
            if len(now) == 2:
                carried.append(now[:1] & now[1:])
                now = now[:1] ^ now[1:]
            out.append(now[0] if len(now) else np.zeros(self.words, np.uint64))
        return out

    def top(self, query: np.ndarray, k: int, own: int | None = None) -> list[tuple[int, int]]:
        """The k highest (score, id), ties to the smaller id, without one row that has the id own and the query's own vector."""
        score = self.scores(query)
        maybe = self.all
        if own is not None:
            a, b = np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, "right")
            same = np.flatnonzero((self.vectors[a:b] == query).all(1)) + a
            if len(same):
                maybe = maybe.copy()
                maybe[same[0] // 64] &= ~(np.uint64(1) << np.uint64(same[0] % 64))
        sure = np.zeros(self.words, np.uint64)
        for level, bitmap in enumerate(reversed(score)):
            higher = maybe & (~bitmap if level == 0 else bitmap)  # the sign's zeros are the higher ones
            n = int(np.bitwise_count(sure | higher).sum())
            if n > k:
                maybe = higher
            elif n < k:
                sure, maybe = sure | higher, maybe & ~higher
            else:
                sure, maybe = sure | higher, np.zeros(self.words, np.uint64)
                break
        rows = _positions(sure)
        rows = np.concatenate([rows, _positions(maybe)[: k - len(rows)]])
        value = np.zeros(len(rows), np.int64)
        for b, bitmap in enumerate(score):
            digit = ((bitmap[rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << b
            value += -digit if b == len(score) - 1 else digit
        return sorted(zip(value.tolist(), self.ids[rows].tolist(), strict=True), key=lambda x: (-x[0], x[1]))


def _digits(q: int) -> list[tuple[int, int]]:
    """Signed binary digits of q, no two of them neighbours: (shift, +1 or -1)."""
    out, shift = [], 0
    while q:
        if q & 1:
            d = 2 - (q & 3)
            out.append((shift, d))
            q -= d
        q >>= 1
        shift += 1
    return out


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def quantised(vectors: DataFrame) -> DataFrame:
    """(id, x, q): the rows that take part, and their components as integers, those beyond 62 bits as the extremes of 63."""
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("x")).where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
    most = float(1 << 62)
    return rows.select("id", "x", F.transform("x", lambda v: F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), v * SCALE))).cast("long")).alias("q"))


def _exact(x: list[float]) -> list[int]:
    """Components of any size as integers."""
    return [math.floor(v * SCALE) if abs(v) < 1e300 else int(v) * SCALE for v in x]


def _score(a: list[int], b: list[int]) -> int:
    """Inner product; beyond 64 bits the nearest long."""
    return max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b, strict=False))))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """A row for each list, filled up with zeros."""
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lists.value_lengths().to_numpy()[:, None]] = lists.flatten().to_numpy()
    return out


def top_k(vectors: DataFrame, every: int = QUERY_EVERY, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of vectors (vec_id, embedding) to each row whose id every divides."""
    rows = quantised(vectors)
    width = rows.agg(F.max(F.size("q"))).first()[0] or 0
    # rows whose scores might not fit 64 bits keep their components as they are
    limit = math.isqrt((1 << 62) // max(1, width))
    rows = rows.select("id", "q", F.when(F.exists("q", lambda v: F.abs(v) >= limit), F.col("x")).alias("x")).groupBy("id", "q", "x").agg(F.count(F.lit(1)).alias("times"))
    asks = F.col("id") % every == 0
    count, asking = rows.agg(F.count(F.lit(1)), F.count_if(asks)).first()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-8 * count * width // block_bytes))
    parts = max(1, min(-(-tasks // blocks), -(-asking // PART)))
    spread = F.xxhash64("id", "q")
    row = ("id", "q", "x", "times")
    # more than one part only where there are fewer blocks than tasks
    block, part = F.pmod(spread, F.lit(blocks)), F.pmod(F.xxhash64("q", "id"), F.lit(parts))
    each = lambda n, work: F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda x: work(x).cast("int"))).alias("work")
    indexed = rows.select(each(parts, lambda p: block * parts + p), F.lit(0).alias("kind"), *row)
    asked = rows.where(asks).select(each(blocks, lambda b: b * parts + part), F.lit(1).alias("kind"), *row)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each work item first the block's rows, then its queries."""
        now, held, far, index = None, [], [], None
        for batch in batches:
            out = []
            work, kind, ids, times = (batch.column(c).to_numpy() for c in ("work", "kind", "id", "times"))
            vectors, near = _matrix(batch.column("q"), width), batch.column("x").is_null().to_numpy(zero_copy_only=False)
            change = np.flatnonzero((work[1:] != work[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in pairwise([0, *change.tolist(), len(work)] if len(work) else []):
                if work[a] != now:
                    now, held, far, index = work[a], [], [], None
                if kind[a] == 0:
                    own = np.repeat(np.arange(a, b), np.minimum(times[a:b], k + 1))
                    held.append((ids[own[near[own]]], vectors[own[near[own]]]))
                    far += [(int(ids[j]), _exact(batch.column("x")[j].as_py())) for j in own[~near[own]].tolist()]
                    continue
                if index is None and sum(len(i) for i, _ in held):
                    index, held = BlockIndex(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held])), []
                for j in range(a, b):
                    i, exact = int(ids[j]), batch.column("q")[j].as_py() if near[j] else _exact(batch.column("x")[j].as_py())
                    others = [far[m] for m in range(len(far)) if m != next((m for m, y in enumerate(far) if not near[j] and y == (i, exact)), None)]
                    if not near[j] and index is not None:
                        others += zip(index.ids.tolist(), index.vectors.tolist(), strict=True)
                    best = [(_score(exact, v), m) for m, v in others]
                    if near[j] and index is not None:
                        best += index.top(vectors[j], k, i)
                    out += [(i, hash_of(exact), int(times[j]), v, s) for s, v in sorted(best, key=lambda y: (-y[0], y[1]))[:k]]
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(5)], ["query_id", "query", "times", "vec_id", "score"])

    def hash_of(query: list[int]) -> int:
        return int.from_bytes(hashlib.blake2b(repr(query).encode(), digest_size=8).digest(), "little", signed=True)

    dealt = indexed.union(asked).repartitionById(min(blocks * parts, 1 << 16), "work").sortWithinPartitions("work", "kind")
    found = dealt.mapInArrow(search, "query_id long, query long, times long, vec_id long, score long")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # equal rows ask alike
    copies = top.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy"))
    return copies.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS u, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.u, a.vec_id AS query_id, b.vec_id AS vec_id, CASE WHEN len(a.q) = len(b.q) AND len(a.q) > 0 THEN list_inner_product(a.q, b.q)
    ELSE coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0) END::BIGINT AS score
  FROM v a JOIN v b ON a.u <> b.u WHERE a.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
