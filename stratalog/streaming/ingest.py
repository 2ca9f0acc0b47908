"""Continuous ingest by Structured Streaming: files of lines to evidence, events and dead letters."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.functions.shared import deleted, shared_folder
from stratalog.operators.definition import Registry
from stratalog.plans import jobs


def line_stream(spark: SparkSession, folder: str, per_trigger: int = 1000) -> DataFrame:
    """Lines of arriving files; the checkpoint keeps what was read, and a trigger takes a bounded number of files."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", per_trigger).load(folder).where("trim(value) <> ''")


def start(lines: DataFrame, registry: Registry, root: str, checkpoint: str, uid=None, interval: str | None = None, seed: bytes | None = None):
    """Starts the ingest of a stream (value), sealed if there is a key. Definitions are reloaded between batches; a bad file keeps the former ones."""
    stamp = F.unix_micros(F.current_timestamp()) * 1000
    uid = F.expr("uuid()") if uid is None else uid

    def one(batch: DataFrame, _: int) -> None:
        if registry.folder:
            registry.reload()
        # of tailed files the place of a line is kept with it
        place = [F.concat_ws(":", "path", "position").alias("locator")] if "position" in batch.columns else []
        rows = batch.select(uid.alias("event_uid"), F.col("value").cast("binary").alias("raw"), stamp.alias("ingest_time_ns"), F.lit("stream").alias("source_id"), *place).persist()
        try:
            jobs.ingest(rows, registry.definitions, root, seed=seed)
        finally:
            rows.unpersist()

    writer = lines.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def fan_out(batch: DataFrame, required: dict, optional: dict) -> dict[str, str]:
    """Sends a batch to all sinks: a required one that fails raises, an optional one's failure is returned."""
    failed = {}
    for sink in required.values():
        sink(batch)
    for name, sink in optional.items():
        try:
            sink(batch)
        except Exception as e:  # noqa: BLE001  an optional sink must not stop the others
            failed[name] = str(e)
    return failed


def deduplicated(events: DataFrame, time: str, key: str, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def tumbling(events: DataFrame, time: str, width: str, *keys: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return events.withWatermark(time, late).groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, time: str, gap: str, *keys: str, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))


#: State that outgrows a heap: it lies in files, of which only some blocks are held in memory.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true"}


#: A query with timers would otherwise run batches without data for ever, although it should end once it has read all.
NO_IDLE = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}


@contextmanager
def on_files(spark: SparkSession, more: dict[str, str] | None = None):
    """Queries that start within keep their state in files, and have the other settings of more."""
    settings = STATE_STORE | (more or {})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


#: Later than any event: it moves the watermark past all of them. Its own windows stay open and give nothing.
END = "9999-12-31 00:00:00"


def drained(source: DataFrame, make: Callable[[DataFrame], DataFrame], name: str, time: str | None = None, settings: dict[str, str] | None = None) -> DataFrame:
    """All that make of a bounded stream gives, as a table in the shared folder: neither rows nor state pass through the driver or stay in a heap.

    time: the event time of make's watermark. When the source is drained, the query goes on once more, from its
    checkpoint, over a row that says only that time is past END, so that the windows still open close too.
    """
    spark = source.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    rows = source
    if time:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}-end")
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
        rows = source.unionByName(spark.readStream.schema(source.schema).parquet(f"{path}-end"))

    def run() -> DataFrame:
        out = make(rows)
        with on_files(spark, settings):
            q = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start(path)
        q.awaitTermination()
        return out

    out = run()
    if time:
        last = spark.range(1).select(*(F.lit(END if f.name == time else None).cast(f.dataType).alias(f.name) for f in source.schema.fields))
        last.write.mode("append").parquet(f"{path}-end")
        out = run()
        deleted(spark, f"{path}-end")
    deleted(spark, f"{path}-state")
    return spark.read.schema(out.schema).parquet(path)
