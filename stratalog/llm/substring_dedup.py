"""Substring deduplication by a count-min prefilter.

Every window of ``span`` words is hashed to a cell of a sketch that is as wide as the corpus is long. Blocks of
documents send their sketches, kept sparse as sorted cells, to the shards of the cell space, where they are merged; a
cell that two blocks filled, or that one block filled twice, holds windows *estimated* to repeat. Counts are only ever
too high, so no repeated window is lost. The second pass groups just those windows exactly, by 96 bits of two
independent hashes of their words, for the smallest document id that starts them, and the third removes the words that
windows of smaller documents cover.

Defined results: a null text has no words; a null id is never smaller than another id, and nothing is removed from its
document; rows with the same id do not remove words from each other; the other columns of the input, whatever their
names, play no part. A text shorter than the span keeps all its words. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.functions.shared import lean
from stratalog.llm._blocks import dealt, layout, pack_gaps, shard_edges, unpack_gaps
from stratalog.llm._words import ROLL_A, ROLL_B, hash_words, mix, rolling, split_words, window_starts

#: Words of a window.
SPAN = 13
NO_ID = np.iinfo(np.int64).max


class _Windows:
    """The windows of a block's texts."""

    def __init__(self, table: pa.Table, span: int):
        ids = table.column("id").combine_chunks() if table.num_rows else pa.array([], pa.int64())
        self.ids = np.array(ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), np.int64)
        self.words = split_words(table.column("body").to_pylist())
        self.hashes, self.ends = hash_words(self.words)
        self.starts, self.owner = window_starts(self.ends, span)
        self.first = rolling(self.hashes, span, ROLL_A)[self.starts] if len(self.starts) else np.zeros(0, np.uint64)

    def digest(self, span: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of the windows numbered at: 64 from a second rolling hash, 32 from the first."""
        second = rolling(mix(self.hashes ^ ROLL_B), span, ROLL_B)
        return second[self.starts[at]], (self.first[at] >> np.uint64(13)).astype(np.uint32)


def _ordered(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by (hi, lo), and where each group of equals begins in it."""
    order = np.argsort(hi, kind="stable")
    a, b = hi[order], lo[order]
    if len(a) and ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((lo, hi))
        a, b = hi[order], lo[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


def _repeat_table(docs: DataFrame, span: int, removed, carried: tuple[str, ...] = ()) -> DataFrame:
    """The three passes; removed(windows, mask of removed words) makes the rows of a block."""
    plan = layout(docs)
    blocks, shards, shift = plan.blocks, plan.shards, np.uint64(64 - plan.bits)
    text = dealt(docs, blocks, carried)

    def sketch(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        cells = np.unique(_Windows(table, span).first >> shift)
        edges = shard_edges(cells << shift, shards)
        used = np.flatnonzero(np.diff(edges))
        return pa.table({"shard": pa.array(used, pa.int32()), "block": pa.array([key[0].as_py()] * len(used), pa.int32()), "cells": pa.array([pack_gaps(cells[edges[s] : edges[s + 1]]) for s in used], pa.binary())})

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """A bit for each cell of each block: whether another block has it too."""
        each = [unpack_gaps(b) for b in table.column("cells").to_pylist()]
        cells = np.sort(np.concatenate(each))
        shared = np.unique(cells[1:][cells[1:] == cells[:-1]])
        bits = []
        for own in each:
            at = np.minimum(np.searchsorted(shared, own), max(0, len(shared) - 1))
            bits.append(np.packbits(shared[at] == own).tobytes() if len(shared) else b"")
        return pa.table({"block": table.column("block"), "shard": pa.array([key[0].as_py()] * len(each), pa.int32()), "n": pa.array([len(x) for x in each], pa.int32()), "bits": pa.array(bits, pa.binary())})

    def repeated(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        """The windows estimated to repeat: digest, smallest id of the block, whether another id of it has them too."""
        w = _Windows(table, span)
        cells, place, count = np.unique(w.first >> shift, return_inverse=True, return_counts=True)
        flags = [np.zeros(0, bool)]
        for n, bits in zip(*(answers.sort_by("shard").column(c).to_pylist() for c in ("n", "bits")), strict=True):
            flags.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool) if bits else np.zeros(n, bool))
        at = np.flatnonzero((np.concatenate(flags) | (count > 1))[place] & (w.ids[w.owner] != NO_ID))
        hi, lo = w.digest(span, at)
        ids = w.ids[w.owner[at]]
        order, heads = _ordered(hi, lo)
        ids = ids[order]
        low = np.minimum.reduceat(ids, heads) if len(heads) else ids
        many = np.maximum.reduceat(ids, heads) > low if len(heads) else np.zeros(0, bool)
        hi, lo = hi[order][heads], lo[order][heads]
        edges = shard_edges(hi, shards)
        used = np.flatnonzero(np.diff(edges))
        part = [slice(edges[s], edges[s + 1]) for s in used]
        return pa.table({"shard": pa.array(used, pa.int32()), "block": pa.array([key[0].as_py()] * len(used), pa.int32())} | {name: pa.array([x[p].tobytes() for p in part], pa.binary()) for name, x in (("hi", hi), ("lo", lo), ("ids", low), ("many", many))})

    def smallest(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """For each block the digests of its windows that a smaller id of any block has, with that id."""
        hi, lo, ids, many = ([np.frombuffer(b, t) for b in table.column(c).to_pylist()] for c, t in (("hi", np.uint64), ("lo", np.uint32), ("ids", np.int64), ("many", bool)))
        cut = np.cumsum([0, *map(len, hi)])
        hi, lo, ids, many = map(np.concatenate, (hi, lo, ids, many))
        order, heads = _ordered(hi, lo)
        least = np.empty(len(ids), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(ids[order], heads), np.diff(heads, append=len(ids)))
        keep = (least < ids) | many
        rows = []
        for block, a, b in zip(table.column("block").to_pylist(), cut, cut[1:], strict=False):
            k = np.flatnonzero(keep[a:b]) + a
            if len(k):
                rows.append((block, key[0].as_py(), hi[k].tobytes(), lo[k].tobytes(), least[k].tobytes()))
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["block", "shard", "hi", "lo", "ids"])

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        w = _Windows(table, span)
        gone = np.zeros(len(w.hashes) + 1, np.int32)
        if answers.num_rows and len(w.starts):
            answers = answers.sort_by("shard")
            hi, lo, least = (np.frombuffer(b"".join(answers.column(c).to_pylist()), t) for c, t in (("hi", np.uint64), ("lo", np.uint32), ("ids", np.int64)))
            mine, tail = w.digest(span, slice(None))
            at = np.searchsorted(hi, mine)
            hit = np.flatnonzero((at < len(hi)) & (hi[np.minimum(at, len(hi) - 1)] == mine))
            at = at[hit]
            while len(hit):  # a further step only where two digests share their first 64 bits
                same = lo[at] == tail[hit]
                good = hit[same & (least[at] < w.ids[w.owner[hit]]) & (w.ids[w.owner[hit]] != NO_ID)]
                np.add.at(gone, w.starts[good], 1)
                np.add.at(gone, w.starts[good] + span, -1)
                hit, at = hit[~same], at[~same] + 1
                more = (at < len(hi)) & (hi[np.minimum(at, len(hi) - 1)] == mine[hit])
                hit, at = hit[more], at[more]
        return removed(w, np.cumsum(gone[:-1]) > 0, table)

    sketches = text.groupBy("block").applyInArrow(lean(sketch), "shard int, block int, cells binary")
    shared = sketches.repartition(shards, "shard").groupBy("shard").applyInArrow(lean(merge), "block int, shard int, n int, bits binary")
    windows = text.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(lean(repeated), "shard int, block int, hi binary, lo binary, ids binary, many binary")
    least = windows.repartition(shards, "shard").groupBy("shard").applyInArrow(lean(smallest), "block int, shard int, hi binary, lo binary, ids binary")
    return text.groupBy("block").cogroup(least.groupBy("block")).applyInArrow(lean(cut), removed.schema)


def _report(w: _Windows, gone: np.ndarray):
    """(words, words removed, what is kept) of each text."""
    for words, a, b in zip(w.words, w.ends, w.ends[1:], strict=False):
        lost = gone[a:b]
        n = int(lost.sum())
        yield len(words), n, b" ".join([x for x, y in zip(words, lost.tolist(), strict=True) if not y] if n else words)


def remove_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row of docs (doc_id, text)."""

    def removed(w, gone, table):
        n, lost, digests = [], [], []
        for a, b, kept in _report(w, gone):
            n.append(a)
            lost.append(b)
            digests.append(hashlib.sha256(kept).hexdigest())
        return pa.table({"doc_id": table.column("id"), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(lost, pa.int64()), "kept_sha256": pa.array(digests, pa.string())})

    removed.schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _repeat_table(docs, span, removed)


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """docs with its repeats taken out of text, and n_chars, if there is one, counted anew where that changed it.

    A text that loses nothing stays as it is, white space included; a document that loses every word goes.
    """
    carried = tuple(c for c in docs.columns if c not in ("doc_id", "text"))

    def removed(w, gone, table):
        lost, texts = [], []
        for (_, n, kept), body in zip(_report(w, gone), table.column("body").to_pylist(), strict=True):
            lost.append(n)
            texts.append(kept if n else body)
        columns = {"id": table.column("id"), "lost": pa.array(lost, pa.int64()), "body": pa.array(texts, pa.binary())}
        return pa.table(columns | {c: table.column(c) for c in table.column_names if c[0] == "c"})

    kinds = {f.name: f.dataType for f in docs.schema.fields}
    removed.schema = ", ".join(["id long, lost long, body binary", *(f"c{i} {kinds[c].simpleString()}" for i, c in enumerate(carried))])
    out = _repeat_table(docs, span, removed, carried)
    names = {c: F.col(f"c{i}") for i, c in enumerate(carried)} | {"doc_id": F.col("id").cast(kinds["doc_id"]), "text": F.col("body").cast("string")}
    if "n_chars" in names:
        names["n_chars"] = F.when(F.col("lost") > 0, F.length(names["text"]).cast(kinds["n_chars"])).otherwise(names["n_chars"])
    return out.where((F.col("lost") == 0) | (F.octet_length("body") > 0)).select(*(names[c].alias(c) for c in docs.columns))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT u, doc_id, unnest(range(0, len(w) - 12)) AS place, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(list_slice(w, i, i + 12), ' '))) AS k FROM d WHERE len(w) >= 13),
f AS (SELECT k, min(doc_id) AS first FROM p GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT u, i FROM (SELECT u, unnest(range(place, place + 13)) AS i FROM p JOIN f USING (k) WHERE first < doc_id)),
w AS (SELECT u, unnest(range(0, len(w))) AS i, unnest(w) AS x FROM d),
k AS (SELECT w.u, string_agg(x, ' ' ORDER BY w.i) FILTER (gone.i IS NULL) AS kept, count(gone.i) AS n FROM w LEFT JOIN gone ON w.u = gone.u AND w.i = gone.i GROUP BY w.u)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (u)
"""
