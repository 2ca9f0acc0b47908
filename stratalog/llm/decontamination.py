"""Benchmark decontamination by SimHash over item-sized windows, in DataFrame functions alone.

A document window has as many words as a benchmark item. A window whose weighted 5-word shingles are 80 % similar to the
item's can miss only a few of them (a fifth, if the window is a document shorter than the item), so of one more than that
few, chosen around the item's longest words, it must hold at least one. Documents are searched for those shingles; the
shingles within a window's reach of a hit are the only ones that move, one row for each place. Running sums of their bits
give the SimHash of every window there as a difference of two sums, so the work is linear in the item's length.

The 64-bit fingerprints of windows and items meet in a multi-index: cut into blocks of 12 or 13 bits, two fingerprints
within RADIUS differ in at most 3 bits of one block, or 4 of the first, as otherwise they would differ in more than RADIUS
in all. The index holds each item under all such values of its blocks; distinct fingerprints look their own blocks up.
Candidates within the radius are then verified by the exact weighted similarity (shared shingle occurrences over all): a
place counts towards the windows that it lies in and in which it is not one occurrence too many, which is a range of
starts, so a running sum over range ends gives the overlap of each candidate.

The anchors are broadcast in slices of a bounded size; a larger benchmark takes more passes over the documents. The index
is joined by sorting, as it grows with the benchmark; other joins are left to the planner, which broadcasts by measured
size.

Defined results: words are lower-cased runs between ASCII white space. An item of fewer than five words is one shingle;
an item without words matches nothing. A document shorter than an item is one window. Null and empty texts match nothing;
null ids are kept. Rows that repeat an id with other texts, or have none, are searched each by itself. Repeated rows of a
document or item give one row per pair of ids; of windows with equal similarity the first counts. Texts and items of any
length are searched whole. An empty table gives an empty result; columns other than ids and texts play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalog.functions.shared import cut

SHINGLE, PERCENT = 5, 80
#: Hamming radius: fingerprints of sets at the threshold differ in 10 bits on average, with a deviation of 3.
RADIUS = 20
#: (first bit, bits, most that may differ) of the index's blocks; the last add up to RADIUS less the other blocks.
BLOCKS = ((0, 13, 4), (13, 13, 3), (26, 13, 3), (39, 13, 3), (52, 12, 3))
#: Anchors of one broadcast: some 30 MB.
SLICE = 100_000

_SPACE = " \t\n\x0b\x0c\r"
#: Two counters of 32 bits in one sum: no text has 2**31 words.
_LANES = 0x0000000100000001


def words(text: str) -> Column:
    return F.split(F.btrim(F.lower(F.col(text)), F.lit(_SPACE)), "[ \\t\\n\\x0B\\f\\r]+")


def _shingles(of: Column, k: Column) -> Column:
    """Hashes of each k neighbours; empty if there are fewer."""
    n = F.size(of) - k + 1
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(of, i, k)))).otherwise(F.array().cast("array<bigint>"))


def items(benchmark: DataFrame) -> DataFrame:
    """item (a hash of the words), w (words), size, k (shingle length), hashes of each distinct text."""
    own = benchmark.select(words("text").alias("w")).where(F.col("w")[0] != "").distinct()
    own = own.withColumn("item", F.xxhash64("w")).withColumn("size", F.size("w")).withColumn("k", F.least(F.lit(SHINGLE), F.col("size")))
    return own.withColumn("hashes", _shingles(F.col("w"), F.col("k")))


def anchors(of: DataFrame) -> DataFrame:
    """Of each item one shingle more than a similar window can miss, those with the longest words: word, its offset, the shingle's words."""
    n = F.size("hashes")
    # the bound for windows of any size up to the item's: all of a shorter one can be shared
    missed = n - F.floor((F.lit(PERCENT) * n + 99) / F.lit(100)).cast("int")
    each = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.struct(
            (-F.array_max(F.transform(F.slice("w", i, F.col("k")), F.length))).alias("rank"),
            F.slice("w", i, F.col("k")).alias("shingle"),
        ),
    )
    some = of.select("size", "k", F.explode(F.slice(F.array_sort(each), F.lit(1), missed + 1)).alias("a")).select("size", "k", F.col("a.shingle").alias("shingle"), (-F.col("a.rank")).alias("longest"))
    offset = F.array_position(F.transform("shingle", F.length), F.col("longest")).cast("int") - 1
    return some.withColumn("offset", offset).select("size", "k", "offset", "shingle", F.element_at("shingle", F.col("offset") + 1).alias("word")).distinct()


def _lanes(h: Column) -> list[Column]:
    return [F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANES)) for k in range(32)]


def _print(sums: list[Column], n: Column) -> Column:
    """The fingerprint: a bit is set where more than half of n hashes have it."""
    bit = lambda at: F.when(F.shiftrightunsigned(sums[at % 32], 32 * (at // 32)).bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > n, F.lit(1 << at if at < 63 else -(1 << 63))).otherwise(F.lit(0))
    return reduce(lambda a, b: a.bitwiseOR(b), map(bit, range(64)))


def _item_prints(of: DataFrame) -> DataFrame:
    """item, size, print."""
    each = of.select("item", "size", F.explode("hashes").alias("h"))
    sums = [c.alias(f"s{k}") for k, c in enumerate(map(F.sum, _lanes(F.col("h"))))]
    counted = each.groupBy("item", "size").agg(F.count(F.lit(1)).alias("n"), *sums)
    return counted.select("item", "size", _print([F.col(f"s{k}") for k in range(32)], F.col("n")).alias("print"))


def _block(of: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(of, first).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def index(prints: DataFrame) -> DataFrame:
    """size, block, value, item, item_print: each item under the values of its blocks and all values near enough."""

    def entries(i: int, first: int, bits: int, most: int) -> Column:
        masks = F.filter(F.sequence(F.lit(0), F.lit((1 << bits) - 1)), lambda m: F.bit_count(m) <= most)
        return F.transform(masks, lambda m: F.struct(F.lit(i).alias("block"), _block(F.col("print"), first, bits).bitwiseXOR(m).alias("value")))

    each = prints.select("item", "size", F.col("print").alias("item_print"), F.explode_outer(F.concat(*(entries(i, *b) for i, b in enumerate(BLOCKS)))).alias("b"))
    return each.select("size", "b.block", "b.value", "item", "item_print")


def near(prints: DataFrame, of: DataFrame) -> DataFrame:
    """size, print, item of the distinct fingerprints (size, print) and items (item, size, print) that differ in at most RADIUS bits."""
    asked = prints.select("size", "print").distinct()
    asked = asked.select("size", "print", F.explode(F.array(*(F.struct(F.lit(i).alias("block"), _block(F.col("print"), first, bits).alias("value")) for i, (first, bits, _) in enumerate(BLOCKS)))).alias("b")).select("size", "print", "b.*")
    differ = F.col("print").bitwiseXOR(F.col("item_print"))
    # a pair that meets in several blocks is taken in the first of them
    first = F.coalesce(*(F.when(F.bit_count(_block(differ, at, bits)) <= most, F.lit(i)) for i, (at, bits, most) in enumerate(BLOCKS)))
    return asked.join(index(of).hint("merge"), ["size", "block", "value"]).where((F.bit_count(differ) <= RADIUS) & (first == F.col("block"))).select("size", "print", "item")


KEY = ["doc_id", "row", "size"]


def _places(text: DataFrame, at: DataFrame) -> DataFrame:
    """The shingles within a window's reach of an anchor: doc_id, row, size, place, h, starts (whether a window begins there), n (shingles of a window)."""
    # outer: else the optimizer would infer filters on the arrays' sizes and compute the arrays again for each row far below
    here = text.select("doc_id", "row", "w", F.posexplode_outer("w").alias("place", "word"))
    start = F.col("place") - F.col("offset")
    hits = here.join(F.broadcast(at), "word").where((start >= 0) & (F.slice("w", F.greatest(start, F.lit(0)) + 1, F.col("k")) == F.col("shingle")))
    last = F.greatest(F.lit(0), F.least(start, F.size("w") - F.col("size")))
    first = F.least(last, F.greatest(F.lit(0), start + F.col("k") - F.col("size")))
    # of the document only what the windows cover
    part = hits.select(*KEY, "k", first.alias("first"), last.alias("last"), F.slice("w", first + 1, last - first + F.col("size")).alias("part"))
    part = part.select(*KEY, "first", "last", F.least(F.col("size"), F.size("part")).alias("words"), "k", _shingles(F.col("part"), F.col("k")).alias("all"))
    each = part.select(*KEY, "first", "last", (F.col("words") - F.col("k") + 1).alias("n"), F.posexplode_outer("all").alias("i", "h")).where("h IS NOT NULL")
    place = F.col("first") + F.col("i")
    return each.groupBy(*KEY, place.alias("place")).agg(F.first("h").alias("h"), F.max(place <= F.col("last")).alias("starts"), F.first("n").alias("n"))


def _window_prints(places: DataFrame) -> DataFrame:
    """doc_id, row, size, n, start, print of each window: the running sums at its end less those before its start."""
    run = Window.partitionBy(*KEY).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = places.select(*KEY, "place", "starts", "n", *(F.sum(c).over(run).alias(f"s{k}") for k, c in enumerate(_lanes(F.col("h")))), *(c.alias(f"h{k}") for k, c in enumerate(_lanes(F.col("h")))))
    ends = sums.select(*KEY, "n", (F.col("place") - F.col("n") + 1).alias("start"), F.lit(0).alias("begins"), *(F.col(f"s{k}") for k in range(32)))
    begins = sums.where("starts").select(*KEY, "n", F.col("place").alias("start"), F.lit(1).alias("begins"), *((F.col(f"h{k}") - F.col(f"s{k}")).alias(f"s{k}") for k in range(32)))
    both = ends.union(begins).groupBy(*KEY, "n", "start").agg(F.sum("begins").alias("begins"), F.count(F.lit(1)).alias("ends"), *(F.sum(f"s{k}").alias(f"s{k}") for k in range(32)))
    return both.where("begins = 1 AND ends = 2").select(*KEY, "n", "start", _print([F.col(f"s{k}") for k in range(32)], F.col("n")).alias("print"))


def _verified(candidates: DataFrame, places: DataFrame, of: DataFrame) -> DataFrame:
    """doc_id, row, size, item, start, similarity of the candidates (doc_id, row, size, n, start, item)."""
    counts = of.select("item", F.size("hashes").alias("of"), F.explode("hashes").alias("h")).groupBy("item", "of", "h").agg(F.count(F.lit(1)).alias("times"))
    pairs = candidates.select(*(F.col(c).alias(f"c_{c}") for c in KEY), "n", "item").distinct()
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in KEY))
    shared = places.drop("n", "starts").join(pairs, same).join(counts, ["item", "h"])
    # occurrences of one shingle in order: each counts from the window that leaves out the one `times` before it
    lists = shared.groupBy(*KEY, "item", "h", "n", "times").agg(F.array_sort(F.collect_list("place")).alias("at"))
    each = lists.select(*KEY, "item", "n", "times", "at", F.posexplode("at").alias("i", "place"))
    before = F.when(F.col("i") >= F.col("times"), F.try_element_at("at", (F.col("i") - F.col("times") + 1).cast("int")))
    low, high = F.greatest(F.col("place") - F.col("n") + 1, F.coalesce(before + 1, F.lit(-(1 << 30)))), F.col("place") + 1
    change = lambda s, by: F.struct(s.cast("int").alias("start"), F.lit(by).alias("by"))
    changes = each.select(*KEY, "item", F.explode(F.array(change(low, 1), change(high, -1))).alias("x")).select(*KEY, "item", "x.start", "x.by", F.lit(None).cast("int").alias("n"))
    asked = candidates.select(*KEY, "item", F.col("start").cast("int"), F.lit(0).alias("by"), F.col("n").cast("int"))
    run = Window.partitionBy(*KEY, "item").orderBy("start", F.col("n").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = changes.union(asked).withColumn("both", F.sum("by").over(run)).where("n IS NOT NULL")
    sizes = of.select("item", F.size("hashes").alias("of"))
    return both.join(sizes, "item").select(*KEY, "item", "start", (F.col("both") / (F.col("n") + F.col("of") - F.col("both"))).alias("similarity")).where(F.col("similarity") >= PERCENT / 100)


def _pairs(text: DataFrame, of: DataFrame, at: DataFrame) -> DataFrame:
    # written once: the texts are read once, and each later plan is short
    places = cut(_places(text, at))
    windows = cut(_window_prints(places))
    met = near(windows, _item_prints(of))
    return _verified(cut(windows.join(met, ["size", "print"])), places, of)


def row_key() -> Column:
    """Tells rows with the same id, or with none, apart by their texts."""
    return F.xxhash64("text")


def _similar(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, row, size, item, start, similarity of the windows that are similar to an item."""
    of = cut(items(benchmark))
    text = docs.select("doc_id", row_key().alias("row"), words("text").alias("w")).where(F.col("w")[0] != "")
    slices = -(-of.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0] // SLICE) or 1
    found = []
    for i in range(slices):
        own = of if slices == 1 else of.where(F.pmod("item", F.lit(slices)) == i)
        found.append(_pairs(text, own, anchors(own)))
    return reduce(DataFrame.union, found)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity of the best window of each document and benchmark item that are similar."""
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "size")).alias("best")
    named = benchmark.select("item_id", F.xxhash64(words("text")).alias("item")).distinct()
    rows = _similar(docs, benchmark).groupBy("doc_id", "item").agg(best).join(named, "item")
    return rows.groupBy("doc_id", "item_id").agg(F.max("best").alias("best")).select("doc_id", "item_id", (-F.col("best.before")).cast("int").alias("start_word"), F.col("best.size").alias("n_words"), F.col("best.similarity").alias("similarity"))


#: All windows around each shared shingle, without fingerprints.
ORACLE = r"""
WITH raw AS (SELECT doc_id, md5(text) AS r, string_split_regex(trim(lower(text), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[ \t\n\x0B\f\r]+') AS w FROM documents WHERE text IS NOT NULL),
d AS (SELECT DISTINCT doc_id, r, w FROM raw WHERE w[1] <> ''),
b AS (SELECT DISTINCT item_id, string_split_regex(trim(lower(text), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[ \t\n\x0B\f\r]+') AS w FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item_id, w, len(w) AS size, least(5, len(w)) AS k FROM b WHERE w[1] <> ''),
ish AS (SELECT item_id, size, k, size - k + 1 AS n, unnest(list_transform(range(1, size - k + 2), lambda p: list_slice(w, p, p + k - 1))) AS h FROM i),
ic AS (SELECT item_id, size, k, n, h, count(*) AS c FROM ish GROUP BY ALL),
ks AS (SELECT DISTINCT k FROM i),
dsh AS (SELECT doc_id, r, k, len(w) - k + 1 AS total, unnest(range(0, len(w) - k + 1)) AS place, unnest(list_transform(range(1, len(w) - k + 2), lambda p: list_slice(w, p, p + k - 1))) AS h FROM d, ks WHERE len(w) >= k),
m AS (SELECT doc_id, r, item_id, size, n, c, h, place, least(n, total) AS m, total FROM dsh JOIN ic USING (k, h)),
s AS (SELECT doc_id, r, item_id, size, n, c, h, m, unnest(range(greatest(0, place - m + 1), least(place, total - m) + 1)) AS start FROM m),
g AS (SELECT doc_id, r, item_id, size, n, m, start, h, least(count(*), any_value(c)) AS shared FROM s GROUP BY doc_id, r, item_id, size, n, m, start, h),
t AS (SELECT doc_id, item_id, size, start, sum(shared) / (any_value(m) + any_value(n) - sum(shared)) AS similarity FROM g GROUP BY doc_id, r, item_id, size, start)
SELECT doc_id, item_id, start::INTEGER AS start_word, size::INTEGER AS n_words, similarity::DOUBLE AS similarity FROM t WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""
