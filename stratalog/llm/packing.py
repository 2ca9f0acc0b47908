"""Best-fit packing of token sequences by a grouping genetic algorithm.

Which documents share a bin matters only through their lengths, so a packing is a multiset of *patterns* (how many
pieces of each length stand in a bin), each with the number of bins that use it. The histogram of lengths has at most as
many entries as the capacity has tokens, whatever the corpus holds, and so have the chromosomes: the genetic search
runs on bounded data, while counting, ranking and placing the pieces stay distributed.

A crossover injects whole well-filled bins of one parent into another, drops the receiver's bins that would use pieces
twice, and best-fits the displaced pieces into the gaps, then into new bins. Islands evolve as separate Spark tasks and
send their best packing to the next island between rounds. Each piece is then ranked among those of its length and
takes the place that the pattern table gives to this rank.

Defined results: a null or empty text is the end token alone; a null id is packed as any other; repeated rows are
packed each for itself. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import random
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.llm._pretokens import id_bytes, kept, readable
from stratalog.functions.shared import cut, released

#: Tokens of a sequence, and the id that ends a document.
CAPACITY, END_ID = 1024, 2
#: Islands, rounds between migrations, generations of a round and packings of an island.
ISLANDS, ROUNDS, GENERATIONS, POPULATION = 4, 2, 6, 6
#: Bins at least so full are injected whole.
WELL_FILLED = 0.98


def token_pieces(docs: DataFrame, *encoder: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the pieces of each row's ids; only the first may be shorter. encoder: see id_bytes."""
    end = end_id.to_bytes(4, "little")

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept(("ids", *encoder), lambda: id_bytes(*encoder))
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist(), strict=True):
                ids = encode(readable(body)) + end
                n = len(ids) // 4
                start, piece = 0, 0
                while start < n:
                    stop = min(n, start + capacity) if start or n % capacity == 0 else n % capacity
                    rows.append((doc, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, piece = stop, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])
        released()

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("body"))
    return text.mapInArrow(tokenize, "doc_id long, piece int, start long, length long, ids_crc32 long")


# A packing: {pattern: bins}, a pattern being its lengths in descending order.
Packing = dict[tuple[int, ...], int]


def n_bins(packing: Packing) -> int:
    return sum(packing.values())


def _fitness(packing: Packing, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones."""
    return n_bins(packing), -sum(m * (sum(p) / capacity) ** 2 for p, m in packing.items())


def best_fit(counts: dict[int, int], capacity: int, rng: random.Random | None = None) -> Packing:
    """New bins for all of counts: the longest piece opens one, then what leaves the least gap. A bin's pattern is repeated while its pieces last."""
    left = Counter({k: n for k, n in counts.items() if n > 0})
    sizes = sorted(left)
    out: Packing = Counter()
    while sizes:
        pattern, room = [sizes[-1]], capacity - sizes[-1]
        used = Counter(pattern)
        while room >= sizes[0]:
            i = bisect_left(sizes, room + 1) - 1
            if rng and i > 0 and sizes[i] < room and rng.random() < 0.3:
                i = rng.randrange(i + 1)
            while i >= 0 and used[sizes[i]] >= left[sizes[i]]:
                i -= 1
            if i < 0:
                break
            pattern.append(sizes[i])
            used[sizes[i]] += 1
            room -= sizes[i]
        times = min(left[k] // n for k, n in used.items())
        out[tuple(sorted(pattern, reverse=True))] += times
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                sizes.pop(bisect_left(sizes, k))
    return out


def refit(packing: Packing, displaced: dict[int, int], capacity: int, rng: random.Random | None = None) -> Packing:
    """The displaced pieces, longest first, into the gap that each fills best, then into new bins."""
    packing = Counter(packing)
    gaps = sorted((capacity - sum(p), p) for p in packing if sum(p) < capacity)
    rest: Counter = Counter()
    for size in sorted(displaced, reverse=True):
        n = displaced[size]
        while n > 0:
            i = bisect_left(gaps, (size,))
            if i == len(gaps):
                rest[size] += n
                break
            gap, p = gaps[i]
            k = min(n, packing[p])
            packing[p] -= k
            n -= k
            if not packing[p]:
                del packing[p]
                gaps.pop(i)
            q = tuple(sorted((*p, size), reverse=True))
            if q not in packing and gap > size:
                insort(gaps, (gap - size, q))
            packing[q] += k
    packing.update(best_fit(rest, capacity, rng))
    return packing


def crossover(giver: Packing, taker: Packing, counts: dict[int, int], capacity: int, rng: random.Random) -> Packing:
    """Whole well-filled bins of giver, then taker's bins as far as their pieces are still free; the rest is refitted."""
    left, child = Counter(counts), Counter()

    def place(pattern: tuple[int, ...], most: int) -> None:
        need = Counter(pattern)
        n = min(most, *(left[k] // c for k, c in need.items()))
        if n > 0:
            child[pattern] += n
            for k, c in need.items():
                left[k] -= n * c

    for p, m in giver.items():
        if sum(p) >= WELL_FILLED * capacity and rng.random() < 0.5:
            place(p, m if rng.random() < 0.5 else rng.randint(1, m))
    for p, m in sorted(taker.items(), key=lambda x: -sum(x[0])):
        place(p, m)
    return refit(child, {k: n for k, n in left.items() if n}, capacity, rng)


def mutate(packing: Packing, capacity: int, rng: random.Random) -> Packing:
    """Opens the emptiest bins and a few others, and packs their pieces anew."""
    kept_bins, displaced = Counter(packing), Counter()
    worst = sorted(packing, key=sum)[: max(1, len(packing) // 10)]
    for p in {*worst, *rng.sample(list(packing), max(1, len(packing) // 20))}:
        n = rng.randint(1, kept_bins[p])
        kept_bins[p] -= n
        if not kept_bins[p]:
            del kept_bins[p]
        for k in p:
            displaced[k] += n
    return refit(kept_bins, displaced, capacity, rng)


def evolve(counts: dict[int, int], elites: list[Packing], seed: int, capacity: int, generations: int = GENERATIONS, size: int = POPULATION) -> Packing:
    """One island's round."""
    rng = random.Random(seed)
    least = -(-sum(k * n for k, n in counts.items()) // capacity)
    people = [*elites] or [best_fit(counts, capacity)]
    while len(people) < size:
        people.append(best_fit(counts, capacity, rng))
    people.sort(key=lambda p: _fitness(p, capacity))
    for _ in range(generations):
        if n_bins(people[0]) == least:
            break
        pick = lambda: min(rng.sample(people, min(3, len(people))), key=lambda p: _fitness(p, capacity))
        young = [crossover(pick(), pick(), counts, capacity, rng) for _ in range(size // 2)]
        young.append(mutate(people[0], capacity, rng))
        people = sorted([*people, *young], key=lambda p: _fitness(p, capacity))[:size]
    return people[0]


def _written(packing: Packing) -> str:
    return json.dumps([[list(p), m] for p, m in packing.items()])


def _read(text: str) -> Packing:
    return {tuple(p): m for p, m in json.loads(text)}


def _island(counts: dict[int, int], capacity: int, elites: list[str], r: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for i in (int(i) for batch in batches for i in batch.id):
            seen = [_read(x) for x in dict.fromkeys((elites[i], elites[i - 1])) if x]  # its own and its neighbour's
            yield pd.DataFrame({"island": [i], "packing": [_written(evolve(counts, seen, 1000 * r + i, capacity))]})

    return run


def search(spark: SparkSession, counts: dict[int, int], capacity: int = CAPACITY, islands: int = ISLANDS, rounds: int = ROUNDS) -> Packing:
    """The islands' best packing of a histogram of lengths (at most capacity entries)."""
    counts = {int(k): int(n) for k, n in counts.items() if n}
    if not counts:
        return {}
    full = {(capacity,): counts.pop(capacity)} if capacity in counts else {}
    if not counts:
        return full
    least = -(-sum(k * n for k, n in counts.items()) // capacity)
    elites = [""] * islands
    for r in range(rounds):
        tasks = spark.range(islands, numPartitions=islands)
        rows = tasks.mapInPandas(_island(counts, capacity, elites, r), "island long, packing string").collect()
        elites = [x.packing for x in sorted(rows, key=lambda x: x.island)]
        best = min(map(_read, elites), key=lambda p: _fitness(p, capacity))
        if n_bins(best) == least:
            break
    return full | best


def _slots(packing: Packing) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, pieces of the length in a bin, their first offset) of each pattern and length."""
    rows, next_rank, sequence = [], Counter(), 0
    for p, m in sorted(packing.items(), reverse=True):
        offset = 0
        for size, c in sorted(Counter(p).items(), reverse=True):
            rows.append((size, next_rank[size], next_rank[size] + c * m, sequence, c, offset))
            next_rank[size] += c * m
            offset += c * size
        sequence += m
    return rows


def place(pieces: DataFrame, packing: Packing) -> DataFrame:
    """pieces with sequence_id and offset."""
    spark = pieces.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # equal lengths are spread over buckets, ranked there, and shifted by what earlier buckets hold
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(4 * parts)))
    before = bucketed.groupBy("bucket", "length").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    ranked = bucketed.withColumn("rank", F.row_number().over(Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")) - 1).join(before, ["bucket", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    # a few thousand rows: as many patterns as the histogram has entries, times the generations that split them
    slots = F.broadcast(spark.createDataFrame(_slots(packing) or [(0, 0, 0, 0, 1, 0)], "length long, lo long, hi long, first long, each long, base long"))
    j = F.col("rank") - F.col("lo")
    return (
        ranked.join(slots, (ranked.length == slots.length) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
        .select("doc_id", "piece", "start", ranked.length, "ids_crc32", (F.col("first") + F.expr("(rank - lo) div each")).alias("sequence_id"), (F.col("base") + F.pmod(j, F.col("each")) * ranked.length).alias("offset"))
    )


def pack(docs: DataFrame, *encoder: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of docs (doc_id, text)."""
    pieces = cut(token_pieces(docs, *encoder, capacity=capacity, end_id=end_id))
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    return place(pieces, search(docs.sparkSession, counts, capacity))
