"""Substring deduplication over suffixes, by distributed prefix doubling.

Which strings of ``span`` bytes also start in a document with a smaller id is read off the order of the corpus's
suffixes, sorted no deeper than the span. Suffixes are compared where they are spread by content: the least hash among
the substrings of half a span that a window holds is its *mark*, equal windows have equal marks, and Spark shuffles by
mark. Neighbouring windows mostly share a mark and travel as one piece of text, so a position costs a few bytes.

1. A sketch of the marks, merged over all blocks of documents, retires the suffixes whose mark is unique.
2. Each shard of marks gets the other pieces, sorts its positions by their first eight bytes, and then by pairs of ranks
   at growing offsets (8, 16, and the rest of the span), reranking each time; positions that have become unique drop out,
   and a window all of whose parts are not unique goes on until it is ranked by the whole span. Ranks are of the bytes
   themselves, so the result is exact, without hash collisions.
3. For each piece of each block, a bit a window goes back: whether a document with a smaller id has it.

Messages are between blocks and shards, packed (see _blocks), and a block sends each distinct piece once, so neither a
frequent string nor a large group of copies makes a task large.

Defined results: a null or empty text has no bytes and loses none; a null id is never smaller than another id, and
nothing is removed from its row; rows with the same id do not remove bytes from each other; a text shorter than the span
stays whole; long texts are taken whole, in chunks; an empty table gives an empty result; other columns, whatever their
names, play no part. What is kept need not be UTF-8 and is binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.llm._blocks import dealt, layout, pack_gaps, shard_edges, unpack_gaps
from stratalog.llm._words import ROLL_A, mix

#: Bytes of a string.
SPAN = 50
#: Bytes of the first ranks, windows of a piece at most (bits of an answer), and positions looked at in one go.
WORD, PIECE, CHUNK = 8, 32, 1 << 17
#: Bytes of text whose suffixes are ranked at once (texts of one mark always are).
SLAB = 1 << 21
NO_ID = np.iinfo(np.int64).max
_OF_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * ROLL_A)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(ROLL_A), n, 1 << 64))


def _marks(body: np.ndarray, span: int) -> np.ndarray:
    """The mark of the window at each position: the least hash of its substrings of half a span."""
    one = _OF_BYTE[body]
    gram, done, out, size = span // 2, 0, None, 1
    doubled = one
    while True:  # polynomial hashes of 1, 2, 4, ... bytes, joined as the bits of the length say
        if gram & size:
            n = len(body) - done - size + 1
            out = doubled if out is None else doubled[:n] * _power(done) + out[size : size + n]
            done += size
        if 2 * size > gram:
            break
        doubled = doubled[:-size] * _power(size) + doubled[size:]
        size *= 2
    hashes = mix(out)
    width, reach = span - gram + 1, 1
    while 2 * reach <= width:
        hashes = np.minimum(hashes[:-reach], hashes[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(hashes[: len(hashes) - rest], hashes[rest:]) if rest else hashes


class _Pieces:
    """The windows of a block's texts in pieces of neighbours that share a mark: start, windows and text of each."""

    def __init__(self, table: pa.Table, span: int):
        # shuffles don't keep the order of rows, and the passes must see the same pieces in the same order
        table = table.sort_by([("id", "ascending"), ("body", "ascending")])
        ids = table.column("id").combine_chunks() if table.num_rows else pa.array([], pa.int64())
        self.table, self.ids = table, np.array(ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), np.int64)
        texts = [b or b"" for b in table.column("body").to_pylist()]
        self.bytes = b"".join(texts)
        self.ends = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(b) for b in texts], out=self.ends[1:])
        body = np.frombuffer(self.bytes, np.uint8)
        starts, counts, marks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for a in range(0, len(body) - span + 1, CHUNK):
            mark = _marks(body[a : a + CHUNK + span - 1], span)
            whole = np.ones(len(mark), bool)
            for end in self.ends[np.searchsorted(self.ends, a, "right") : np.searchsorted(self.ends, a + len(mark) + span)].tolist():
                whole[max(0, end - span + 1 - a) : max(0, end - a)] = False
            turn = np.flatnonzero((mark[1:] != mark[:-1]) | (whole[1:] != whole[:-1])) + 1
            head = np.concatenate([[0], turn])
            size = np.diff(np.append(head, len(mark)))
            head, size = head[whole[head]], size[whole[head]]
            parts = -(-size // PIECE)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            starts.append(np.repeat(head, parts) + PIECE * nth + a)
            counts.append(np.minimum(np.repeat(size, parts) - PIECE * nth, PIECE))
            marks.append(np.repeat(mark[head], parts))
        self.starts, self.counts, self.marks = np.concatenate(starts), np.concatenate(counts), mix(np.concatenate(marks))
        self.owner = np.searchsorted(self.ends, self.starts, "right") - 1
        if (has := self.ids[self.owner] != NO_ID).size and not has.all():
            self.starts, self.counts, self.marks, self.owner = (x[has] for x in (self.starts, self.counts, self.marks, self.owner))

    def repeated(self, answers: pa.Table, shift: np.uint64, shards: int, span: int) -> _Sent:
        """The pieces whose marks are estimated to repeat, in the corpus or in the block."""
        _, place, count = np.unique(self.marks >> shift, return_inverse=True, return_counts=True)
        flags = [np.zeros(0, bool)]
        for n, bits in zip(*(answers.sort_by("shard").column(c).to_pylist() for c in ("n", "bits")), strict=True):
            flags.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool) if bits else np.zeros(n, bool))
        at = np.flatnonzero((np.concatenate(flags) | (count > 1))[place]) if len(place) else np.zeros(0, np.int64)
        return _Sent(self, at, shards, span)


class _Sent:
    """Distinct texts of pieces, by shard, with the smallest id that has each."""

    def __init__(self, pieces: _Pieces, at: np.ndarray, shards: int, span: int):
        starts = pieces.starts[at]
        ends = starts + pieces.counts[at] + (span - 1)
        seen: dict[bytes, int] = {}
        of = np.fromiter((seen.setdefault(pieces.bytes[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(at))
        ids, texts = pieces.ids[pieces.owner[at]], list(seen)
        least, shard = np.full(len(texts), NO_ID), np.zeros(len(texts), np.int64)
        np.minimum.at(least, of, ids)
        shard[of] = np.minimum(pieces.marks[at] // np.uint64((1 << 64) // shards), np.uint64(shards - 1)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.at, self.of, self.ids = at, place[of], ids
        self.texts, self.least, self.shard = [texts[i] for i in order.tolist()], least[order], shard[order]


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each key among the distinct ones, and how many keys have it."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, np.bincount(rank)[rank] if len(keys) else rank


def _repeats(body: np.ndarray, windows: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows whose strings start at another window too, and their final ranks, by prefix doubling.

    body: all texts in a row; windows: the positions where a string of span bytes starts.
    """
    steps, size = [], WORD
    while size < span:
        steps.append(min(size, span - size))
        size += steps[-1]
    # the offsets within a window of which each step's ranks are made
    needs = [{0}]
    for step in reversed(steps):
        needs.append(needs[-1] | {x + step for x in needs[-1]})
    needs.reverse()
    padded = np.concatenate([body, np.zeros(WORD, np.uint8)])
    key_at = np.zeros(len(body) + 1, np.uint64)
    for k in range(WORD):
        key_at[:-1] = (key_at[:-1] << np.uint64(8)) | padded[k : k + len(body)]
    rank = np.zeros(len(body) + 1, np.int64)
    used = np.zeros(len(body) + 1, bool)
    for level, need in enumerate(needs):
        used[:] = False
        for x in need:
            used[windows + x] = True
        at = np.flatnonzero(used)
        keys = key_at[at] if level == 0 else (rank[at] << 32) | rank[at + steps[level - 1]]
        mine, count = _ranks(keys)
        rank[at] = mine
        used[at[count < 2]] = False
        for x in need:  # a part that is unique makes the window unique
            windows = windows[used[windows + x]]
        if not len(windows):
            break
    return windows, rank[windows]


def _settled(texts: list[bytes], least: np.ndarray, span: int) -> np.ndarray:
    """For each distinct text a bit for each of its windows: whether a text with a smaller id than its own has it."""
    out = np.zeros(len(texts), np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    body = np.frombuffer(b"".join(texts), np.uint8)
    marks = np.concatenate([_marks(body[a : a + CHUNK + span - 1], span) for a in range(0, len(body) - span + 1, CHUNK)])
    _, group, count = np.unique(marks[ends - sizes], return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(count[group] > 1)  # the only text with its mark shares no window with another
    mixed = mixed[np.argsort(group[mixed], kind="stable")]
    # texts of one mark meet in one slab, whole marks as long as they fit
    before = np.cumsum(sizes[mixed]) - sizes[mixed]
    head = np.flatnonzero(np.diff(group[mixed], prepend=-1))
    slab = np.repeat(before[head], np.diff(np.append(head, len(mixed)))) // SLAB
    cuts = np.flatnonzero(np.diff(slab, prepend=-1)).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(mixed)], strict=True):
        _mask_slab(out, mixed[a:b], texts, sizes, least, span)
    return out


def _mask_slab(out: np.ndarray, mixed: np.ndarray, texts: list[bytes], sizes: np.ndarray, least: np.ndarray, span: int) -> None:
    """Sets the bits of the texts numbered mixed."""
    body = np.frombuffer(b"".join([texts[i] for i in mixed.tolist()]), np.uint8)
    ends = np.cumsum(sizes[mixed])
    counts = sizes[mixed] - (span - 1)
    owner = np.repeat(mixed, counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(ends - sizes[mixed], counts) + nth
    where = np.full(len(body) + 1, -1, np.int64)
    where[starts] = np.arange(len(starts))
    found, rank = _repeats(body, starts, span)
    if len(found):
        own = owner[where[found]]
        order = np.argsort(rank, kind="stable")
        head = np.flatnonzero(np.diff(rank[order], prepend=-1))
        first = np.empty(len(order), np.int64)
        first[order] = np.repeat(np.minimum.reduceat(least[own][order], head), np.diff(np.append(head, len(order))))
        lost = first < least[own]
        out += np.bincount(own[lost], weights=2.0 ** nth[where[found]][lost], minlength=len(out)).astype(np.int64)


def repeated_bytes(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_bytes, spans (the maximal stretches covered by strings of smaller ids) and kept (the other bytes) of each row of docs (doc_id, text)."""
    plan = layout(docs)
    blocks, shards, shift = plan.blocks, plan.shards, np.uint64(64 - plan.bits)
    text = dealt(docs, blocks)

    def sketch(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        cells = np.unique(_Pieces(table, span).marks >> shift)
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

    def send(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        sent = _Pieces(table, span).repeated(answers, shift, shards, span)
        used, head = np.unique(sent.shard, return_index=True)
        parts = [slice(a, b) for a, b in zip(head.tolist(), [*head.tolist()[1:], len(sent.texts)], strict=True)] if len(used) else []
        sizes = [np.array([len(t) for t in sent.texts[p]], np.uint16).tobytes() for p in parts]
        return pa.table({"shard": pa.array(used, pa.int32()), "block": pa.array([key[0].as_py()] * len(used), pa.int32()), "texts": pa.array([b"".join(sent.texts[p]) for p in parts], pa.binary()), "sizes": pa.array(sizes, pa.binary()), "ids": pa.array([sent.least[p].tobytes() for p in parts], pa.binary())})

    def settle(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        seen: dict[bytes, int] = {}
        rows = []
        for blob, sizes, ids in zip(*(table.column(c).to_pylist() for c in ("texts", "sizes", "ids")), strict=True):
            ends = np.cumsum(np.frombuffer(sizes, np.uint16), dtype=np.int64).tolist()
            of = np.fromiter((seen.setdefault(blob[a:b], len(seen)) for a, b in zip([0, *ends], ends, strict=False)), np.int64, len(ends))
            rows.append((of, np.frombuffer(ids, np.int64)))
        least = np.full(len(seen), NO_ID)
        for of, ids in rows:
            least[of] = np.minimum(least[of], ids)
        own = _settled(list(seen), least, span)
        masks = [np.where(ids > least[of], (1 << PIECE) - 1, own[of]).astype(np.uint32).tobytes() for of, ids in rows]
        return pa.table({"block": table.column("block"), "shard": pa.array([key[0].as_py()] * len(rows), pa.int32()), "masks": pa.array(masks, pa.binary())})

    def cut(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        pieces = _Pieces(table, span)
        told = answers.column("masks").is_valid()
        sent = pieces.repeated(answers.filter(pa.compute.invert(told)), shift, shards, span)
        masks = np.frombuffer(b"".join(answers.filter(told).sort_by("shard").column("masks").to_pylist()), np.uint32)
        # in a block too, a text is known from a smaller id as a whole
        mask = np.where(sent.ids > sent.least[sent.of], np.uint32((1 << PIECE) - 1), masks[sent.of]) if len(sent.of) else np.zeros(0, np.uint32)
        hit = np.flatnonzero(mask)
        counts = pieces.counts[sent.at[hit]]
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        lost = (np.repeat(mask[hit], counts) >> nth.astype(np.uint32)) & 1 == 1
        starts = (np.repeat(pieces.starts[sent.at[hit]], counts) + nth)[lost]
        edge = np.bincount(starts, minlength=len(pieces.bytes) + 1).astype(np.int32)
        edge[span:] -= edge[: max(0, len(edge) - span)].copy()
        gone = np.cumsum(edge[:-1]) > 0
        body, spans, kept = np.frombuffer(pieces.bytes, np.uint8), [], []
        for a, b in zip(pieces.ends.tolist(), pieces.ends.tolist()[1:], strict=False):
            mine = gone[a:b]
            turns = np.flatnonzero(np.diff(mine, prepend=False, append=False)).tolist()
            spans.append([{"start": s, "length": e - s} for s, e in zip(turns[::2], turns[1::2], strict=True)])
            kept.append(body[a:b][~mine].tobytes() if turns else pieces.bytes[a:b])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        return pa.table({"doc_id": pieces.table.column("id"), "n_bytes": pa.array(np.diff(pieces.ends), pa.int64()), "spans": pa.array(spans, kind), "kept": pa.array(kept, pa.binary())})

    def flags() -> DataFrame:
        sketches = text.groupBy("block").applyInArrow(sketch, "shard int, block int, cells binary")
        return sketches.repartition(shards, "shard").groupBy("shard").applyInArrow(merge, "block int, shard int, n int, bits binary")

    sent = text.groupBy("block").cogroup(flags().groupBy("block")).applyInArrow(send, "shard int, block int, texts binary, sizes binary, ids binary")
    masks = sent.repartition(shards, "shard").groupBy("shard").applyInArrow(settle, "block int, shard int, masks binary")
    answers = flags().unionByName(masks, allowMissingColumns=True)
    return text.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start: long, length: long>>, kept binary")


def summary(found: DataFrame) -> DataFrame:
    """One row of numbers and a digest for each row of repeated_bytes."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS u, doc_id, coalesce(hex(encode(text)), '') AS h FROM documents),
o AS (SELECT u, doc_id, h, unnest(range(0, len(h) // 2 - 49, 4000)) AS a FROM d),
c AS (SELECT u, doc_id, a, substr(h, 2 * a + 1, 8098) AS s FROM o),
q AS (SELECT u, doc_id, a, s, unnest(range(0, len(s) // 2 - 49)) AS i FROM c),
p AS (SELECT u, doc_id, a + i AS place, substr(s, 2 * i + 1, 100) AS k FROM q),
f AS (SELECT k, min(doc_id) AS first FROM p GROUP BY k HAVING count(*) > 1),
hit AS (SELECT DISTINCT u, place FROM p JOIN f USING (k) WHERE first < doc_id),
run AS (SELECT u, place, place - lag(place) OVER (PARTITION BY u ORDER BY place) AS gap FROM hit),
isl AS (SELECT u, place, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY u ORDER BY place) AS n FROM run),
span AS (SELECT u, n, min(place) AS a, max(place) + 50 AS b FROM isl GROUP BY u, n),
cut AS (SELECT u, a, b, coalesce(lag(b) OVER (PARTITION BY u ORDER BY a), 0) AS from_, lead(a) OVER (PARTITION BY u ORDER BY a) AS next FROM span),
g AS (SELECT d.u, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
             string_agg(substr(h, 2 * from_::BIGINT + 1, 2 * (a - from_)::BIGINT) || CASE WHEN next IS NULL THEN substr(h, 2 * b::BIGINT + 1) ELSE '' END, '' ORDER BY a) AS kept
      FROM cut JOIN d USING (u) GROUP BY d.u)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN g USING (u)
"""
