"""Blocks of documents that ask questions of hash-range shards.

An operator that must know how often a window occurs in the whole corpus does not shuffle windows as rows. Documents
are dealt once into blocks of a few megabytes. A block removes its own repeats and sends each shard of the hash space
one packed message; the shard merges the messages of all blocks and sends each block its packed answer. Every row that
travels is a (block, shard) message, so no window, however frequent, makes a task large: it costs one entry for each
block that holds it. The text exchange is the same plan node in each pass and Spark reuses it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.functions.shared import trimmed

#: Words per block and entries per shard, which bound a Python worker's memory.
BLOCK_WORDS, SHARD_ENTRIES = 700_000, 3_000_000
#: Words per byte of text, from above, to size blocks: prose has some 0.17, one-letter words 0.5.
WORDS_PER_BYTE = 0.25


@dataclass(frozen=True)
class Layout:
    blocks: int
    shards: int
    #: Bits of a sketch cell's number.
    bits: int


def layout(docs: DataFrame, text: str = "text") -> Layout:
    """Block and shard counts in proportion to the input. They change speed and memory, never results."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    trimmed(docs.sparkSession)
    words = max(1, int(size * WORDS_PER_BYTE))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(2 * parts, -(-words // BLOCK_WORDS))
    shards = max(parts, -(-words // SHARD_ENTRIES))
    return Layout(blocks, shards, min(62, max(16, (16 * words).bit_length())))


def dealt(docs: DataFrame, blocks: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """Columns block, id, body (UTF-8), nulls kept, dealt by block; carried columns come along as c0, c1 and so on.

    Rows are dealt by id and text, so that rows without an id, or of one id, lie in many blocks.
    """
    key = F.col("doc_id").cast("long")
    return docs.select(F.pmod(F.xxhash64(key, "text"), F.lit(blocks)).cast("int").alias("block"), key.alias("id"), F.col("text").cast("binary").alias("body"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried))).repartition(max(1, blocks // 2), "block")


def shard_edges(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range begins in a sorted array of 64-bit hashes; shards + 1 entries."""
    # the shards in use, so that the work grows with the hashes and not with the shards
    own = np.minimum(hashes // np.uint64((1 << 64) // shards), np.uint64(shards - 1)).astype(np.int64)
    edges = np.zeros(shards + 1, np.int64)
    used, count = np.unique(own, return_counts=True)
    edges[used + 1] = count
    return np.cumsum(edges)


def pack_gaps(cells: np.ndarray) -> bytes:
    """Sorted distinct cell numbers as gaps, plane by plane of their bytes: the higher planes hold few values and compress."""
    if not len(cells):
        return b""
    gaps = np.diff(cells, prepend=np.uint64(0))
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    return bytes([width]) + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_gaps(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(blob[0], -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, : blob[0]] = planes.T
    return np.cumsum(gaps.reshape(-1).view("<u8"), dtype=np.uint64)
