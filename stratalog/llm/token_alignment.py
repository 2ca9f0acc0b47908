"""Alignment of two tokenizers over the same bytes.

Every byte of a text has an owner in each tokenization: token numbers repeated by their lengths in bytes. Read side by
side, the two owner arrays change where a token ends; each stretch between changes is one pair of tokens that overlap (a
link), and where both change at once the text falls apart into groups that no token of either side crosses.

How often each pair of ids is linked in the whole corpus needs all texts, and each text needs those counts back. A task
aligns its texts block by block as it reads them, and writes each text's links as places in its block's list of distinct
pairs. Spark sums the blocks' pairs, takes each B id's highest count, and joins back by pair and then by block. So a pair,
however frequent, is one row a block, texts aren't shuffled, and the vocabularies' product is never broadcast. B's ids
come from a table of pieces that a worker keeps, emptied when full.

Defined results: a text that is null, empty, or whose tokens' bytes differ from a space and the text has no tokens on
either side, zeros and an empty string of groups; a null id stays null and its links count; rows that repeat an id, or
are equal, count one by one; texts of any length are taken whole, other columns, whatever their names, play no part; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from stratalog.functions.shared import spread, written
from stratalog.llm._pretokens import kept, readable, sentence_pieces

#: Entries of a worker's piece table, characters of text that are aligned in one go (a longer text alone), and of a block.
PIECES, SLAB, BLOCK = 200_000, 1 << 20, 8 << 20
MARK = "▁"
_HEX = re.compile(r"<0x([0-9A-F]{2})>")


def byte_side(ranks: str, pattern: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder of plain text and the bytes of each id, of a byte-level vocabulary given as ranks."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    entries = [b""] * (max(table.values()) + 1)
    for entry, i in table.items():
        entries[i] = entry
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary, entries


def piece_side(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """The same of several texts by a sentencepiece model: a mark stands for a space, <0xHH> for a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = _HEX.fullmatch(piece)
        entries.append(bytes([int(byte[1], 16)]) if byte else piece.replace(MARK, " ").encode())
    return lambda texts: model.encode(texts, num_threads=1), entries


class _Pieces:
    """Ids of the pieces that a worker has met, each encoded once."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], entries: list[bytes]):
        self.encode, self.entries = encode, entries
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.same = [], [0], []

    def learn(self, pieces: Iterable[str]) -> None:
        """Each piece stands for a space and itself; whether its tokens spell that is kept."""
        new = [p for p in pieces if p not in self.known]
        for piece, ids in zip(new, self.encode(new), strict=True):
            self.known[piece] = len(self.same)
            self.ids += ids
            self.starts.append(len(self.ids))
            self.same.append(b"".join([self.entries[i] for i in ids]) == f" {piece}".encode())

    def tokens(self, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some pieces, and how many each piece has."""
        ids, starts, at = np.array(self.ids, np.int32), np.array(self.starts, np.int64), np.array(numbers, np.int64)
        size = starts[at + 1] - starts[at]
        return ids[np.repeat(starts[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())], size


class Aligner:
    """A: encoder of a text and entries by id; B: encoder of texts that begin at a space, and entries."""

    def __init__(self, a: tuple, b: tuple):
        (self.encode, self.entries), self.pieces = a, _Pieces(*b)
        self.sizes = [np.array([len(e) for e in entries], np.int32) for entries in (a[1], b[1])]
        # each id's number and what may follow it
        self.names = np.array([f"{i}{x}" for n in (len(a[1]), len(b[1])) for i in range(n) for x in ",|;"], object)

    def encoded(self, texts: list[str]) -> list[tuple[np.ndarray, list[int]] | None]:
        """A's ids of space and text, and the pieces of B's text; None where the tokens of either spell another text, or there is none."""
        if len(self.pieces.known) > PIECES:
            self.pieces.clear()
        known, same, spelt = self.pieces.known, self.pieces.same, self.entries.__getitem__
        cut = [sentence_pieces(t) for t in texts]
        self.pieces.learn({p for pieces in cut for p in pieces if p not in known})
        out = []
        for t, pieces in zip(texts, cut, strict=True):
            b = list(map(known.__getitem__, pieces))
            if not t or not all(map(same.__getitem__, b)):
                out.append(None)
                continue
            a = self.encode(f" {t}")
            out.append((np.array(a, np.int32), b) if b"".join(map(spelt, a)) == f" {t}".encode() else None)
        return out

    def slab(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Of each text: tokens of A, of B, groups, links and digest of its groups; and all links' codes (A id << 32 | B id)."""
        both = self.encoded(texts)
        each, some = [x for x in both if x], np.array([x is not None for x in both], bool)
        n = np.zeros((4, len(texts)), np.int64)
        a = np.concatenate([np.zeros(0, np.int32), *(x for x, _ in each)])
        b, size = self.pieces.tokens([i for _, x in each for i in x])
        n[0, some] = [len(x) for x, _ in each]
        n[1, some] = np.diff(np.append(0, np.cumsum(size))[np.cumsum([0, *(len(x) for _, x in each)])])
        if not len(a):
            return *n, np.zeros(0, np.int64), [""] * len(texts)
        own_a, own_b = (np.repeat(np.arange(len(ids), dtype=np.int32), sizes[ids]) for ids, sizes in zip((a, b), self.sizes, strict=True))
        new_a, new_b = np.ones(len(own_a), bool), np.ones(len(own_b), bool)
        new_a[1:], new_b[1:] = own_a[1:] != own_a[:-1], own_b[1:] != own_b[:-1]
        first = np.flatnonzero(new_a | new_b)  # where a pair of owners begins
        links = a[own_a[first]].astype(np.int64) << 32 | b[own_b[first]]
        cut = (new_a & new_b)[first]  # a text's first byte begins a group
        group = np.cumsum(cut, dtype=np.int64) - 1
        group_a, group_b = group[new_a[first]], group[new_b[first]]
        n_groups = int(group[-1]) + 1
        # the groups as text: A's tokens of a group, then B's; what follows a token depends on whether it is the last
        count_a, count_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        upto_a, upto_b = np.cumsum(count_a), np.cumsum(count_b)
        place_a = np.arange(len(a)) + (upto_b - count_b)[group_a]
        place_b = np.arange(len(b)) + upto_a[group_b]
        end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        end_a[upto_a - 1], end_b[upto_b - 1] = 1, 2
        name = np.empty(len(a) + len(b), np.int64)
        name[place_a], name[place_b] = 3 * a.astype(np.int64) + end_a, 3 * (b.astype(np.int64) + len(self.entries)) + end_b
        names = self.names[name].tolist()
        edge = np.append(0, np.cumsum(n[0]))
        byte = np.append(np.flatnonzero(new_a), len(own_a))[edge]
        link_edge = np.searchsorted(first, byte)
        n[3] = np.diff(link_edge)
        n[2] = np.diff(np.append(group_a, n_groups)[edge])
        ends = np.cumsum(n[0] + n[1]).tolist()
        digests = [hashlib.sha256("".join(names[lo:hi])[:-1].encode()).hexdigest() if hi > lo else "" for lo, hi in zip([0, *ends], ends, strict=False)]
        return *n, links, digests


def _slabs(texts: list[str], most: int) -> Iterator[list[str]]:
    some, size = [], 0
    for t in texts:
        if some and size + len(t) > most:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def _packed(places: np.ndarray) -> bytes:
    """Numbers under 2 ** 32, byte by byte, the higher bytes being mostly zeros, and compressed."""
    import zstandard

    return zstandard.compress(np.ascontiguousarray(places.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(blob: bytes) -> np.ndarray:
    import zstandard

    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


TEXT, PAIRS = 0, 1
ROW = "kind int, block long, doc_id long, n_a long, n_b long, n_groups long, links binary, groups_sha256 string, pairs binary, counts binary"


def aligned(docs: DataFrame, ranks: str, pattern: str, model: str) -> DataFrame:
    """A row (kind 0) for each row of docs (doc_id, text) with its links as places in its block's pairs, and one (kind 1) for each block with those pairs and how often it has each."""

    def rows(aligner: Aligner, block: int, ids: list, texts: list[str]) -> pa.RecordBatch:
        parts = [aligner.slab(some) for some in _slabs(texts, SLAB)]
        a, b, groups, n, codes = (np.concatenate([p[k] for p in parts]) for k in range(5))
        digests = [x for p in parts for x in p[5]]
        pairs, place, counts = np.unique(codes, return_inverse=True, return_counts=True)
        edge = np.append(0, np.cumsum(n))
        links = [_packed(place[i:j]) for i, j in zip(edge, edge[1:], strict=False)]
        text = len(ids)
        columns = {
            "kind": pa.array([TEXT] * text + [PAIRS], pa.int32()),
            "block": pa.array([block] * (text + 1), pa.int64()),
            "doc_id": pa.array([*ids, None], pa.int64()),
            **{name: pa.array([*x.tolist(), None], pa.int64()) for name, x in (("n_a", a), ("n_b", b), ("n_groups", groups))},
            "links": pa.array([*links, None], pa.binary()),
            "groups_sha256": pa.array([*digests, None], pa.string()),
            "pairs": pa.array([None] * text + [pairs.tobytes()], pa.binary()),
            "counts": pa.array([None] * text + [counts.astype(np.int64).tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(("aligner", ranks, model), lambda: Aligner(byte_side(ranks, pattern), piece_side(model)))
        block, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for i, body in zip(batch.column("doc_id"), batch.column("body"), strict=True):
                ids.append(i.as_py())
                texts.append(readable(body.as_py()))
                size += len(texts[-1])
                if size >= BLOCK:
                    yield rows(aligner, block, ids, texts)
                    block, ids, texts, size = block + 1, [], [], 0
        if ids:
            yield rows(aligner, block, ids, texts)

    return spread(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("body"))).mapInArrow(align, ROW)


def align_tokens(docs: DataFrame, ranks: str, pattern: str, model: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of docs.

    A link counts as often as its pair of ids is linked in all of docs; n_best counts the links that no other A id of
    their B id beats.
    """
    table = written(aligned(docs, ranks, pattern, model), "alignment")

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "counts")), strict=True):
                codes = np.frombuffer(pairs, np.int64)
                place = np.arange(len(codes), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), block)), pa.array(place), pa.array((codes >> 32).astype(np.int32)), pa.array((codes & 0xFFFFFFFF).astype(np.int32)), pa.array(np.frombuffer(counts, np.int64))], ["block", "place", "a", "b", "n"])

    def counted(key: tuple[pa.Scalar, ...], rows: pa.Table, told: pa.Table) -> pa.Table:
        n, best = np.zeros(told.num_rows, np.int64), np.zeros(told.num_rows, np.int64)
        place = told.column("place").to_numpy()
        n[place], best[place] = told.column("n").to_numpy(), told.column("best").to_numpy()
        sizes, good, sums = [], [], []
        for blob in rows.column("links").to_pylist():
            at = _unpacked(blob)
            sizes.append(len(at))
            good.append(int(best[at].sum()))
            sums.append(int(n[at].sum()))
        columns = {name: pa.array(x, pa.int64()) for name, x in (("n_links", sizes), ("n_best", good), ("count_sum", sums))}
        return pa.table({c: rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")} | columns | {"groups_sha256": rows.column("groups_sha256")})

    of_block = table.where(F.col("kind") == PAIRS).select("block", "pairs", "counts").mapInArrow(unpacked, "block long, place int, a int, b int, n long")
    counts = of_block.groupBy("a", "b").agg(F.sum("n").alias("n"))
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))
    scored = counts.join(highest, "b").select("a", "b", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    told = of_block.select("block", "place", "a", "b").join(scored, ["a", "b"]).select("block", "place", "n", "best")
    texts = table.where(F.col("kind") == TEXT).drop("kind", "pairs", "counts")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(counted, schema)
