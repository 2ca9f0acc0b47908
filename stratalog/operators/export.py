"""Bodies for external stores, and delivery with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.functions.times import date_of_ns
from stratalog.operators.crosswalk import cim, ecs

RETRYABLE = (429, *range(500, 600))


def opensearch_lines(prefix: str) -> Column:
    """Action and document of the bulk API; the event's id makes a repeat harmless."""
    index = F.concat(F.lit(f"{prefix}-"), F.replace(date_of_ns(F.coalesce("ocsf.time", "ingest_time_ns")), F.lit("-"), F.lit(".")))
    action = F.to_json(F.struct(F.struct(index.alias("_index"), F.col("event_uid").alias("_id")).alias("index")))
    return F.concat(action, F.lit("\n"), F.to_json(ecs()), F.lit("\n"))


def hec_envelope(index: str = "main") -> Column:
    at = F.coalesce("ocsf.time", "ingest_time_ns") / F.lit(1_000_000_000)
    return F.to_json(F.struct(F.round(at, 6).alias("time"), F.lit(index).alias("index"), F.col("source_type").alias("sourcetype"), cim().alias("event")))


def clickhouse_rows(silver: DataFrame) -> DataFrame:
    """The row form of a replacing table: core columns and the two JSON ones, one row of (time, source_type, event_uid)."""
    from stratalog.operators.schema import CORE

    return silver.select(*CORE, "unmapped_json", "enrichments_json").dropDuplicates(["time", "source_type", "event_uid"]).select(F.to_json(F.struct("*")).alias("row"))


def delays(attempts: int, base: float, most: float) -> list[float]:
    return [min(base * 2**n, most) for n in range(attempts)]


def deliver(send: Callable[[bytes], int], body: bytes, attempts: int = 5, base: float = 0.5, most: float = 30.0, sleep=time.sleep) -> bool:
    """Sends until a success or a fatal answer; true on success."""
    for wait in delays(attempts, base, most):
        try:
            status = send(body)
        except OSError:
            status = 503
        if status < 300:
            return True
        if status not in RETRYABLE:
            return False
        sleep(wait)
    return False


def sink(column: Column, send: Callable[[bytes], int], size: int = 500):
    """A foreachBatch handler that sends the column's texts in bodies of size rows, from the executors.

    A body that is refused, or fails to the last, makes its task fail once the others are sent, so that the batch is
    repeated and never counted as done; the bodies' ids make repeats harmless.
    """

    def run(rows: Iterator) -> Iterator:
        part, lost = [], 0
        for r in rows:
            part.append(r[0])
            if len(part) == size:
                lost += 0 if deliver(send, "".join(part).encode()) else len(part)
                part = []
        if part:
            lost += 0 if deliver(send, "".join(part).encode()) else len(part)
        if lost:
            raise RuntimeError(f"{lost} rows were not delivered")
        return iter(())

    return lambda batch, *_: batch.select(column.alias("x")).foreachPartition(run)
