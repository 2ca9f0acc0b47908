"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersections.

Which documents meet in a tile is found without emitting pairs. A sketch of the corpus, merged from sparse sketches of
document blocks, tells in how many documents each shingle occurs, never too few. A document that shares at least 80 %
of its shingles with another also shares one of the first n - ceil(0.8 n) + 1 in any common order; in the order from
rare to frequent, documents whose first shingles occur nowhere else drop out. The others are linked to the least
document that has one of these shingles, and the components of those links, far fewer and wider than the true ones,
are the tiles. Equal sets are represented by their least document.

In a tile documents are sorted by size; a document is held against those whose sizes allow a link (the size band) and
whose hashed bitmaps do: each bit that one set has and the other lacks stands for an element that isn't shared, so bit
counts bound the overlap from above. What passes is decided by intersecting the sorted sets. Documents already
connected are not compared again. A component too large for one tile is dealt by size bands, so wide that linked sets lie
in one band or in neighbours, and each band over chunks; the component's least document visits the chunks of its own and
the neighbouring bands. Only what isn't connected to it within its chunk then meets the other chunks of those bands.

The components are what is asked for: pairs that are connected already are not compared, so that links within a component
are not enumerated.

What links is sets, not ids: a node is a distinct set, named by the least id that has it and the set's tag (64 bits of its
digest), so rows of one id with different texts are different nodes, each with its own links.

Defined results: a null, empty or blank text has no shingles and is its own component; a null id has a null component and
links nothing; each row gives a row. Texts of any length are taken whole. An empty table gives an empty result; other
columns, whatever their names, play no part.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_intdigest

from stratalog.llm._blocks import dealt, layout, pack_gaps, shard_edges, unpack_gaps
from stratalog.llm._components import components
from stratalog.functions.shared import cut, lean
from stratalog.llm._words import ROLL_A, ROLL_B, hash_words, mix, rolling, split_words, window_starts

#: Words of a shingle; a link needs PERCENT of the union.
SHINGLE, PERCENT = 5, 80
#: Documents of a tile, and bits of a signature.
TILE, SIGNATURE_BITS = 256, 2048
#: Ratio of a band's ends: a little more than sizes of linked sets can have, whatever the rounding.
BAND = 1.26
SALTS = 64
NO_ID = np.iinfo(np.int64).max
MASK = (1 << 64) - 1


class _Sets:
    """The shingle sets of a block's texts: values in one row, each set sorted, and where each begins."""

    def __init__(self, table: pa.Table):
        ids = table.column("id").combine_chunks() if table.num_rows else pa.array([], pa.int64())
        self.ids = np.array(ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), np.int64)
        hashes, ends = hash_words(split_words(table.column("body").to_pylist(), lower=True))
        starts, owner = window_starts(ends, SHINGLE)
        values = rolling(hashes, SHINGLE, ROLL_A)[starts] if len(starts) else np.zeros(0, np.uint64)
        sizes = np.diff(ends)
        for n in range(1, SHINGLE):  # a shorter text is one shingle
            short = np.flatnonzero(sizes == n)
            if len(short):
                whole = mix(rolling(hashes, n, ROLL_A)[ends[:-1][short]] ^ np.uint64(int(ROLL_B) * n & MASK))
                values, owner = np.concatenate([values, whole]), np.concatenate([owner, short])
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        self.values, self.owner = values[new], owner[new]
        self.n = np.bincount(self.owner, minlength=len(self.ids)).astype(np.int64)
        self.cut = np.concatenate([[0], np.cumsum(self.n)])

    def of(self, i: int) -> np.ndarray:
        return self.values[self.cut[i] : self.cut[i + 1]]

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct digests (hi, lo) of sets that have an id, the least id of each, and each document's place among them (-1: none)."""
        place = np.full(len(self.ids), -1)
        at = np.flatnonzero((self.n > 0) & (self.ids != NO_ID))
        digest = [xxh3_128_intdigest(self.of(i).tobytes()) for i in at]
        hi = np.fromiter((d >> 64 for d in digest), np.uint64, len(at))
        lo = np.fromiter((d & MASK for d in digest), np.uint64, len(at))
        hi, lo, group, least = _grouped(hi, lo, self.ids[at])
        place[at] = group
        return hi, lo, least, place


def _least_first(posted: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct shingles posted by nodes (id, tag), the least node of each, and the links of its other nodes to that one."""
    order = np.lexsort((tags, ids, posted))
    posted, ids, tags = posted[order], ids[order], tags[order]
    new = np.ones(len(posted), bool)
    new[1:] = posted[1:] != posted[:-1]
    head = np.flatnonzero(new)
    least = head[np.cumsum(new) - 1] if len(head) else head
    other = (ids != ids[least]) | (tags != tags[least])
    links = np.unique(np.stack([ids, tags.view(np.int64), ids[least], tags[least].view(np.int64)], 1)[other], axis=0)
    return posted[head], ids[head], tags[head], [np.ascontiguousarray(c) for c in links.T]


def _grouped(hi: np.ndarray, lo: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (hi, lo) in order, each row's place among them, and the least id of each."""
    order = np.lexsort((lo, hi))
    a, b = hi[order], lo[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    heads = np.flatnonzero(new)
    group = np.empty(len(a), np.int64)
    group[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(ids[order], heads) if len(heads) else ids[:0]
    return a[heads], b[heads], group, least


def _table(schema: str, columns: dict) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.table({name: pa.array(columns[name], kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))})


SKETCH = "shard int, block int, cells binary, counts binary, hi binary, lo binary, ids binary"
ANSWER = "block int, shard int, classes binary, least binary"
FOUND = "kind int, shard int, block int, a binary, b binary, c binary, d binary, e binary"
DOCS, LINKS, POSTINGS = 0, 1, 2


def _sketch(shift: np.uint64, shards: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """To each shard: the block's cells of its range with their counts, and its set digests."""
        s = _Sets(table)
        cells, counts = np.unique(s.values >> shift, return_counts=True)
        counts = np.minimum(counts, 255).astype(np.uint8)
        hi, lo, least, _ = s.keys()
        at, ke = shard_edges(cells << shift, shards), shard_edges(hi, shards)
        used = np.flatnonzero(np.diff(at) + np.diff(ke))
        cells_of, keys_of = [slice(at[i], at[i + 1]) for i in used], [slice(ke[i], ke[i + 1]) for i in used]
        return _table(SKETCH, {"shard": used, "block": [key[0].as_py()] * len(used), "cells": [pack_gaps(cells[p]) for p in cells_of], "counts": [counts[p].tobytes() for p in cells_of], "hi": [hi[p].tobytes() for p in keys_of], "lo": [lo[p].tobytes() for p in keys_of], "ids": [least[p].tobytes() for p in keys_of]})

    return run


def _merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """To each block: a class for each of its cells (0: one document, else the count's magnitude), and the least id with each of its sets."""
    each = [unpack_gaps(b) for b in table.column("cells").to_pylist()]
    cells, place = np.unique(np.concatenate(each), return_inverse=True)
    total = np.bincount(place, weights=np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8), minlength=len(cells))
    classes = (np.frexp(total)[1] - 1).astype(np.uint8)[place] if len(cells) else np.zeros(0, np.uint8)
    hi, lo, ids = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("hi", np.uint64), ("lo", np.uint64), ("ids", np.int64)))
    _, _, group, least = _grouped(hi, lo, ids)
    at, ke = np.cumsum([0, *map(len, each)]), np.cumsum([0, *(len(b) // 8 for b in table.column("hi").to_pylist())])
    return _table(ANSWER, {"block": table.column("block").to_pylist(), "shard": [key[0].as_py()] * len(each), "classes": [classes[i:j].tobytes() for i, j in pairwise(at)], "least": [least[group[i:j]].tobytes() for i, j in pairwise(ke)]})


def _find(shift: np.uint64, shards: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        """The block's documents with their representatives, links within the block, and to each shard the prefix shingles with the least id of the block."""
        s, block = _Sets(table), key[0].as_py()
        answers = answers.sort_by("shard")
        classes, least = (np.frombuffer(b"".join(answers.column(c).to_pylist()), t) for c, t in (("classes", np.uint8), ("least", np.int64)))
        hi, _, _, place = s.keys()
        has = place >= 0
        rep, tag = s.ids.copy(), np.zeros(len(s.ids), np.uint64)
        rep[has], tag[has] = least[place[has]], hi[place[has]]
        cls = classes[np.unique(s.values >> shift, return_inverse=True)[1]] if len(s.values) else np.zeros(0, np.uint8)
        order = np.lexsort((s.values, cls, s.owner))  # rare first within each document
        rank = np.arange(len(order)) - s.cut[:-1][s.owner]
        prefix = s.n - (PERCENT * s.n + 99) // 100 + 1
        own, cls = s.owner[order], cls[order]
        use = order[(rank < prefix[own]) & (cls > 0) & (rep[own] == s.ids[own]) & (s.ids[own] != NO_ID)]
        posted, ids, tags, links = _least_first(s.values[use], s.ids[s.owner[use]], tag[s.owner[use]])
        edges = shard_edges(posted, shards)
        used = np.flatnonzero(np.diff(edges))
        part = [slice(edges[i], edges[i + 1]) for i in used]
        keys = table.column("c0").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64) if table.num_rows else np.zeros(0, np.int64)
        head = [(DOCS, -1, block, s.ids.tobytes(), s.n.tobytes(), rep.tobytes(), tag.tobytes(), keys.tobytes()), (LINKS, -1, block, *(c.tobytes() for c in links), None)]
        rows = head + [(POSTINGS, i, block, posted[p].tobytes(), ids[p].tobytes(), tags[p].tobytes(), None, None) for i, p in zip(used.tolist(), part, strict=True)]
        return _table(FOUND, dict(zip(("kind", "shard", "block", *"abcde"), map(list, zip(*rows, strict=True)), strict=True)))

    return run


def _meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Links from the blocks' least nodes with a shingle to the least of all."""
    posted, ids, tags = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("a", np.uint64), ("b", np.int64), ("c", np.uint64)))
    links = _least_first(posted, ids, tags)[3]
    return pa.table({c: pa.array(x, pa.int64()) for c, x in zip("abcd", links, strict=True)})


def _unpacked(found: DataFrame, kind: int, names: list[str]) -> DataFrame:
    """Rows of the packed 64-bit columns a, b and so on, with their block."""
    import pandas as pd

    def run(batches):
        for batch in batches:
            for block, *row in zip(batch["block"], *(batch[c] for c in "abcde"[: len(names)]), strict=True):
                yield pd.DataFrame({n: np.frombuffer(x, np.int64) for n, x in zip(names, row, strict=True)}).assign(block=block)

    return found.where(F.col("kind") == kind).mapInPandas(run, ", ".join([*(f"{n} long" for n in names), "block int"]))


def _node(id_: str, tag: str, name: str):
    """A set: the least id that has it, and its tag; ordered by id."""
    return F.struct(F.col(id_).alias("id"), F.col(tag).alias("tag")).alias(name)


NODE = "struct<id: long, tag: long>"
SET_ROW = f"tile {NODE}, large int, id {NODE}, body binary"
CHUNK = ["tile", "band", "sub"]


def _fetch(key: tuple[pa.Scalar, ...], table: pa.Table, wanted: pa.Table) -> pa.Table:
    """The sorted sets that tiles ask for."""
    nodes = [(x["id"], x["tag"]) for x in wanted.column("id").to_pylist()]
    want = {i for i, _ in nodes}
    s = _Sets(table.take(pa.array([k for k, i in enumerate(table.column("id").to_pylist()) if i in want], pa.int64())))
    hi, _, _, place = s.keys()
    tags = hi.view(np.int64).tolist()
    at = {(i, tags[p]): k for k, (i, p) in enumerate(zip(s.ids.tolist(), place.tolist(), strict=True)) if p >= 0}
    return pa.table({c: wanted.column(c) for c in ("tile", "large", "id")} | {"body": pa.array([s.of(at[x]).tobytes() for x in nodes], pa.binary())})


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), SIGNATURE_BITS), bool)
    for row, x in zip(out, sets, strict=True):
        row[(x >> np.uint64(7)) % np.uint64(SIGNATURE_BITS)] = True
    return np.packbits(out, axis=1).view(np.uint64)


def link_tile(sets: list[np.ndarray], labels: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Connects sets (sorted, without repeats) of which one has asks set. labels: what is connected already; returned anew, with the links that connected more."""
    size = np.array([len(x) for x in sets])
    order = np.argsort(size, kind="stable")
    signs = _signatures(sets)
    labels, links = labels.copy(), []
    for k, i in enumerate(order):
        near = order[:k][size[order[:k]] * 100 >= PERCENT * size[i]]  # the size band below i
        near = near[(asks[near] | asks[i]) & (labels[near] != labels[i])]
        if not len(near) or not size[i]:
            continue
        most = np.minimum(size[near] - np.bitwise_count(signs[near] & ~signs[i]).sum(1), size[i] - np.bitwise_count(signs[i] & ~signs[near]).sum(1))
        near = near[most * (100 + PERCENT) >= PERCENT * (size[near] + size[i])]
        near = near[np.argsort(labels[near], kind="stable")]
        while len(near):
            j, near = near[0], near[1:]
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both * (100 + PERCENT) >= PERCENT * (size[i] + size[j]):
                links.append((int(i), int(j)))
                a, b = sorted((labels[i], labels[j]))
                labels[labels == b] = a
                near = near[labels[near] != labels[i]]
    return labels, links


def _ranked(nodes: list[dict]) -> tuple[np.ndarray, list[dict]]:
    """The place of each node among the distinct ones, and those in order."""
    distinct = sorted({(x["id"], x["tag"]) for x in nodes})
    place = {x: k for k, x in enumerate(distinct)}
    return np.array([place[x["id"], x["tag"]] for x in nodes], np.int64), [{"id": i, "tag": t} for i, t in distinct]


def _tile(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Each of a chunk's sets with the least one that it is connected to there."""
    own, nodes = _ranked(table.column("id").to_pylist())
    sets = [np.frombuffer(b, np.uint64) for b in table.column("body").to_pylist()]
    labels, _ = link_tile(sets, own, np.ones(len(own), bool))
    return pa.table({c: table.column(c) for c in (*CHUNK, "id")} | {"label": pa.array([nodes[i] for i in labels.tolist()], table.schema.field("id").type)})


def _cross(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Links between a chunk's sets (role 0) and others' unconnected ones (role 1)."""
    ids, kind = table.column("id").to_pylist(), table.schema.field("id").type
    sets = [np.frombuffer(b, np.uint64) for b in table.column("body").to_pylist()]
    _, links = link_tile(sets, _ranked(table.column("label").to_pylist())[0], np.array(table.column("role").to_pylist()) == 1)
    return pa.table({"a": pa.array([ids[i] for i, _ in links], kind), "b": pa.array([ids[j] for _, j in links], kind)})


def _labels(text: DataFrame, tiles: DataFrame, homes: DataFrame, tile: int) -> DataFrame:
    """(id, component) of the sets of tiles (id, component), by exact links; homes: (id, block) of a text with each set."""
    total = tiles.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    wanted = tiles.join(total, "component").join(homes, "id").select("block", F.col("component").alias("tile"), (F.col("n") > tile + 1).cast("int").alias("large"), "id")
    raw = cut(text.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(lean(_fetch), SET_ROW))
    band = F.floor(F.log(F.octet_length("body") / 8) / F.log(F.lit(BAND))).cast("int")
    raw = raw.withColumn("band", F.when(F.col("large") == 1, band).otherwise(0))
    large, least = raw.where("large = 1"), F.col("id") == F.col("tile")
    # chunks of each band of a large component
    subs = large.groupBy("tile", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("subs"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    around = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    # bands of one large component hold most rows: joins that carry sets are spread over salts of the small side
    salted = lambda rows, small: rows.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(SALTS)).cast("int")).join(small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["tile", "band", "salt"]).drop("salt")
    own = salted(large.where(~least), subs).select("tile", "band", F.pmod(F.xxhash64("id"), F.col("subs")).cast("int").alias("sub"), "id", "body")
    visits = large.where(least).select("tile", around.alias("band"), "id", "body").join(subs, ["tile", "band"]).select("tile", "band", upto("subs").alias("sub"), "id", "body")
    sets = raw.where("large = 0").select("tile", "band", F.lit(0).alias("sub"), "id", "body").union(own).union(visits)
    done = cut(sets.groupBy(*CHUNK).applyInArrow(lean(_tile), f"tile {NODE}, band int, sub int, id {NODE}, label {NODE}"))
    base = own.join(done, [*CHUNK, "id"])
    asks = cut(base.where("label <> tile"))
    if asks.isEmpty():
        return done.select("id", F.col("label").alias("component")).distinct()
    parts = asks.select("tile", around.alias("band")).groupBy("tile", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("parts"))
    targets = subs.join(parts, ["tile", "band"])
    held = salted(base, targets).select(*CHUNK, upto("parts").alias("part"), F.lit(0).alias("role"), "id", "label", "body")
    asking = salted(asks.select("tile", F.col("band").alias("from"), F.col("sub").alias("home"), around.alias("band"), "id", "label", "body"), targets)
    asking = asking.select("tile", "band", upto("subs").alias("sub"), F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), "id", "label", "body", "from", "home")
    asking = asking.where((F.col("band") != F.col("from")) | (F.col("sub") != F.col("home"))).drop("from", "home")
    links = held.union(asking).groupBy(*CHUNK, "part").applyInArrow(lean(_cross), f"a {NODE}, b {NODE}")
    return components(done.select(F.col("id").alias("a"), F.col("label").alias("b")).union(links))


def jaccard_groups(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """doc_id, text_key (xxhash64 of text), n_shingles, component_id, tag (of the row's set) and leads (whether the set is its component's least node) of each row of docs (doc_id, text)."""
    plan = layout(docs)
    blocks, shards, shift = plan.blocks, plan.shards, np.uint64(64 - plan.bits)
    text = dealt(docs.select("doc_id", "text", F.xxhash64("text").alias("key")), blocks, ("key",))
    sketches = text.groupBy("block").applyInArrow(lean(_sketch(shift, shards)), SKETCH)
    answers = sketches.repartition(shards, "shard").groupBy("shard").applyInArrow(lean(_merge), ANSWER)
    found = cut(text.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lean(_find(shift, shards)), FOUND))
    met = found.where(F.col("kind") == POSTINGS).repartition(shards, "shard").groupBy("shard").applyInArrow(lean(_meet), "a long, b long, c long, d long")
    links = _unpacked(found, LINKS, list("abcd")).drop("block").union(met)
    tiles = components(links.select(_node("a", "b", "a"), _node("c", "d", "b")))
    rows = _unpacked(found, DOCS, ["id", "n", "rep", "tag", "key"])
    homes = rows.where("id = rep AND n > 0").select(_node("id", "tag", "id"), "block").groupBy("id").agg(F.min("block").alias("block"))
    labels = _labels(text, tiles, homes, tile)
    known = rows.withColumn("set", _node("rep", "tag", "set")).join(labels.select(F.col("id").alias("set"), "component"), "set", "left")
    null = F.col("id") == NO_ID
    return known.select(
        F.when(~null, F.col("id")).alias("doc_id"),
        F.col("key").alias("text_key"),
        F.col("n").alias("n_shingles"),
        F.when(~null, F.coalesce("component.id", "rep")).alias("component_id"),
        "tag",
        ((F.col("id") == F.col("rep")) & F.coalesce(F.col("component") == F.col("set"), F.lit(True))).alias("leads"),
    )


def jaccard_components(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of docs (doc_id, text)."""
    return jaccard_groups(docs, tile).select("doc_id", "n_shingles", "component_id")


#: Pairs of distinct sets over shared shingles, and their transitive closure.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END)) AS s FROM d),
c AS (SELECT md5(array_to_string(s, chr(10))) AS k, min(doc_id) AS least, any_value(s) AS s, len(any_value(s)) AS n FROM t WHERE len(s) > 0 GROUP BY 1),
h AS (SELECT k, n, unnest(s) AS x FROM c),
e AS (SELECT a.k AS a, b.k AS b FROM h a JOIN h b ON a.x = b.x AND a.k <> b.k AND a.n >= 0.8 * b.n AND b.n >= 0.8 * a.n GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(k, least) AS (SELECT k, least FROM c UNION SELECT e.b, r.least FROM r JOIN e ON e.a = r.k),
m AS (SELECT k, min(least) AS component FROM r GROUP BY k)
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN doc_id IS NULL THEN NULL ELSE coalesce(component, doc_id) END AS component_id FROM t LEFT JOIN m ON len(s) > 0 AND m.k = md5(array_to_string(s, chr(10)))
"""
