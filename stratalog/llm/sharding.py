"""Sharding by a permutation-filled lookup table, in DataFrame functions alone.

Each shard orders the slots of a prime-sized table by its own permutation, offset + i * skip modulo the size. Shards
take turns; at its turn a shard claims the first slot of its order that is still free, until all are claimed. Shares
then differ by one slot at most, and when a shard leaves, nearly all other slots keep theirs. A key's slot is its hash
modulo the size, and its shard is a constant-time lookup in the broadcast table.

The table has SLOTS rows whatever the data; its filling depends on the shard names alone.

Defined results: a null key takes the slot of the empty text; equal keys share a shard, in every run and under any
partitioning. Each row gives a row.
"""

from __future__ import annotations

import json
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A prime. More than a hundred times the shards, so that shares differ by under one percent.
SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """The number of the shard that claimed each slot."""
    if slots < 2 or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} is not a prime")
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct, and there must be one")
    spot = [_number(f"offset {s}") % slots for s in shards]
    skip = [_number(f"skip {s}") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while free:
        for i in range(min(len(shards), free)):
            while table[spot[i]] >= 0:
                spot[i] = (spot[i] + skip[i]) % slots
            table[spot[i]] = i
            free -= 1
    return table


def table_frame(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(slot, shard) as rows of a folded literal."""
    names = F.from_json(F.lit(json.dumps(list(shards))), "array<string>")
    rows = spark.range(1).select(F.posexplode(F.from_json(F.lit(json.dumps(lookup_table(shards, slots))), "array<int>")).alias("slot", "number"))
    return rows.select("slot", F.element_at(names, F.col("number") + 1).alias("shard"))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots)).cast("int")


def assign(rows: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """rows with columns slot and shard, which replace columns of these names."""
    own = [c for c in rows.columns if c.lower() not in ("slot", "shard")]
    placed = rows.withColumn("__slot", slot_of(F.col(key), slots)).select(*own, F.col("__slot").alias("slot"))
    return placed.join(F.broadcast(table_frame(rows.sparkSession, shards, slots)), "slot", "left").select(*own, "slot", "shard")


def oracle() -> str:
    """The registered query's SQL, over the filled table as a list."""
    slot = f"((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT) % {SLOTS})::INTEGER"
    return f"""
WITH filled AS (SELECT {lookup_table()} AS shards), d AS (SELECT doc_id, source, {slot} AS slot FROM documents)
SELECT doc_id, source, slot, printf('shard-%03d', shards[slot + 1]) AS shard FROM d, filled
"""
