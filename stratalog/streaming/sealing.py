"""Batches of evidence that stay open across micro-batches: sealed when full, or when their first event is old enough.

Evidence is dealt to lanes, and a lane's open batch is state of the stream: at most size - 1 hashes, kept by the state
store, so that a restart goes on where it stopped. A full batch leaves the state as one row with its leaves; a timer
seals what has waited too long. The chain over the sealed batches, a thousandth of the events, is folded behind the
ledger's last root once a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stratalog.operators import integrity

SIZE, WAIT_MS, LANES = 1000, 10_000, 16
SEALED = "lane int, number long, reason string, uids array<string>, leaves array<string>"


class OpenBatch(StatefulProcessor):
    """A lane's open batch. Events of a micro-batch join it in the order of (ingest_time_ns, event_uid)."""

    def __init__(self, size: int = SIZE, wait_ms: int = WAIT_MS):
        self.size, self.wait_ms = size, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "event_uid string, raw_hash string")
        self.number = handle.getValueState("number", "number long")
        self.due = handle.getValueState("due", "due long")

    def _sealed(self, lane: int, rows: list[tuple[str, str]], reason: str) -> Row:
        number = self.number.get()[0] if self.number.exists() else 0
        self.number.update((number + 1,))
        return Row(lane=lane, number=number, reason=reason, uids=[u for u, _ in rows], leaves=[h for _, h in rows])

    def _waits(self, rows: list[tuple[str, str]], now: int, fresh: bool) -> None:
        """Keeps the open batch; a fresh one gets a timer of its own."""
        if fresh:
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
                self.due.clear()
            if rows:
                self.handle.registerTimer(now + self.wait_ms)
                self.due.update((now + self.wait_ms,))
        self.open.put(rows) if rows else self.open.clear()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        pending = [(r[0], r[1]) for r in self.open.get()] if self.open.exists() else []
        fresh = not pending
        arrived = sorted((r.ingest_time_ns, r.event_uid, r.raw_hash) for r in rows)
        pending += [(u, h) for _, u, h in arrived]
        whole = len(pending) // self.size * self.size
        for a in range(0, whole, self.size):
            yield self._sealed(key[0], pending[a : a + self.size], "size")
        self._waits(pending[whole:], timerValues.getCurrentProcessingTimeInMs(), fresh or whole > 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rows = [(r[0], r[1]) for r in self.open.get()] if self.open.exists() else []
        self.open.clear()
        self.due.clear()
        if rows:
            yield self._sealed(key[0], rows, "timeout")

    def close(self) -> None:
        pass


def sealed_batches(events: DataFrame, lanes: int = LANES, size: int = SIZE, wait_ms: int = WAIT_MS, lane=None) -> DataFrame:
    """SEALED rows of a stream of evidence (event_uid, raw_hash, ingest_time_ns). The state store must be the one on files (ingest.STATE_STORE)."""
    dealt = F.pmod(F.xxhash64("event_uid"), F.lit(lanes)) if lane is None else lane
    return events.select(dealt.cast("int").alias("lane"), "event_uid", "raw_hash", "ingest_time_ns").groupBy("lane").transformWithState(OpenBatch(size, wait_ms), SEALED, "Append", "ProcessingTime")


def roots(sealed: DataFrame, size: int = SIZE) -> DataFrame:
    """lane, number, reason, leaf_count, batch_root, uids of SEALED rows."""
    return integrity.merkle_root(sealed, "leaves", most=size).select("lane", "number", "reason", F.size("leaves").cast("bigint").alias("leaf_count"), "batch_root", "uids")


#: The stream's ledger: as the ledger of batch jobs, with the lane and the number of each batch in it.
LEDGER = integrity.LEDGER + ", lane int, number long, reason string"


def append_sealed(spark: SparkSession, sealed: DataFrame, root: str, seed: bytes | None = None, now_ns: int | None = None, size: int = SIZE) -> int:
    """Chains sealed batches behind the ledger at root, and returns how many were new.

    The index is complete before the ledger has a batch; a micro-batch that comes again adds nothing to the ledger.
    """
    ledger = read_ledger(spark, root)
    last = ledger.agg(F.max(F.struct("seq", "chained_root")).alias("x")).first().x
    begin, head = (last.seq + 1, last.chained_root) if last else (0, integrity.GENESIS)
    new = roots(sealed, size).join(ledger.select("lane", "number"), ["lane", "number"], "left_anti")
    own = integrity.cut(integrity.numbered(new, ["lane", "number"], "seq").withColumn("seq", F.col("seq") + begin))
    n = own.count()
    if n:
        at = F.lit(now_ns).cast("long") if now_ns is not None else F.unix_micros(F.current_timestamp()) * 1000
        own.select(F.posexplode("uids").alias("leaf_index", "event_uid"), "seq").select("event_uid", F.col("seq").alias("ledger_seq"), "leaf_index").write.mode("append").parquet(f"{root}/index")
        rows = own.select("seq", "batch_root", "leaf_count", F.element_at("uids", 1).alias("first_event_uid"), F.element_at("uids", -1).alias("last_event_uid"), at.alias("sealed_at_ns"), "lane", "number", "reason")
        integrity.cut(integrity.chained(rows, head, seed)).select(*(x.split()[0] for x in LEDGER.split(", "))).write.mode("append").json(f"{root}/ledger")
    return n


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return integrity._stored(spark, f"{root}/ledger", LEDGER, "json")


def start(events: DataFrame, root: str, checkpoint: str, seed: bytes | None = None, lanes: int = LANES, size: int = SIZE, wait_ms: int = WAIT_MS, interval: str | None = None, after: Callable[[int], None] | None = None):
    """Seals a stream of evidence into the ledger at root, until it is stopped, or once over what is there if there is no interval."""
    spark = events.sparkSession

    def one(batch: DataFrame, _: int) -> None:
        n = append_sealed(spark, batch, root, seed, size=size)
        if after:
            after(n)

    from stratalog.streaming.ingest import NO_IDLE, on_files

    with on_files(spark, None if interval else NO_IDLE):
        writer = sealed_batches(events, lanes, size, wait_ms).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
