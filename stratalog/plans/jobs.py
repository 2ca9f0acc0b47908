"""Batch jobs over the lake: ingest, reprocess and compare, replay, round trips, inspection."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.functions.shared import cut, removed, written
from stratalog.operators import integrity
from stratalog.operators.definition import Definition
from stratalog.operators.enrich import enriched
from stratalog.operators.normalize import normalized, parsed
from stratalog.operators.validate import routed, validated
from stratalog.plans import lake
from stratalog.plans.commits import Commits


def process(lines: DataFrame, definitions: list[Definition], reference: Column | None = None, indicators: DataFrame | None = None, log_version: str | dict[str, str] | None = None, hold: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) of evidence rows (event_uid, raw, raw_hash, ingest_time_ns)."""
    good, dead = routed(normalized(lines, definitions, reference, log_version), {d.name: d.on_failure for d in definitions}, hold)
    return enriched(good, indicators), dead


@contextmanager
def held() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Keeps rows as tables of the shared folder for as long as it is open: what several writes need is worked out once."""
    tables: list[DataFrame] = []

    def hold(rows: DataFrame) -> DataFrame:
        tables.append(written(rows, "held"))
        return tables[-1]

    try:
        yield hold
    finally:
        for t in tables:
            removed(t)


def staged(commits: Commits, events: DataFrame, dead: DataFrame) -> dict[str, list[str]]:
    """Files of events and dead letters, for a commit."""
    dead = dead.withColumn("date", lake.date_of_ns(F.col("ts_ns")))
    return {"silver": commits.stage(lake.silver(events), "silver", "parquet", "date", "source_type", compression="zstd"), "deadletters": commits.stage(dead, "deadletters", "json", "date")}


def ingest(lines: DataFrame, definitions: list[Definition], root: str, reference: Column | None = None, seed: bytes | None = None) -> None:
    """Evidence first, sealed if there is a key to sign with, then events and dead letters in one commit; a failing definition never loses a line."""
    commits = Commits(lines.sparkSession, root)
    commits.commit({"bronze": commits.stage(lake.bronze_rows(lines), "bronze", "json", "date", compression="gzip")})
    if seed:
        integrity.seal(lines.sparkSession, lake.bronze(lines), root, seed)
    commits.commit(staged(commits, *process(lake.bronze(lines), definitions, reference)))


def verify(spark: SparkSession, root: str, public: bytes | None = None) -> tuple[tuple[int, str] | None, DataFrame]:
    """The ledger's first fault, None if its chain is sound, and (event_uid, seq, leaf_index, reason) of each piece of evidence."""
    ledger = integrity.read_ledger(spark, root)
    fault = integrity.first_fault(integrity.verify_chain(ledger, public))
    return fault, integrity.verify_events(lake.read_bronze(spark, f"{root}/bronze"), integrity.read_index(spark, root), ledger)


def version_rank(version: Column) -> Column:
    """Order of log versions: plain ones first, then reprocessed ones by their time stamp."""
    return F.coalesce(F.regexp_extract(version, r"\+reprocess-(\d+)", 1), F.lit(""))


def latest(rows: DataFrame, version: str = "log_version", tie: str = "written") -> DataFrame:
    """One row of each event: the highest version, of equals the last written."""
    w = Window.partitionBy("event_uid").orderBy(F.desc(version_rank(F.col(version))), F.desc(tie))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def compare(new: DataFrame, old: DataFrame, ignored: tuple[str, ...] = ("event_uid", "log_version", "written", "completeness")) -> DataFrame:
    """Counts of changed, unchanged and new events, and mean completeness before and after, over events that both have."""
    own = [c for c in new.columns if c not in ignored and c in old.columns]
    digest = lambda d: F.to_json(F.struct(*(d[c] for c in own)))
    a = new.select("event_uid", digest(new).alias("a"), F.col("completeness").alias("ca"))
    b = old.select("event_uid", digest(old).alias("b"), F.col("completeness").alias("cb"))
    j = a.join(b, "event_uid", "left")
    n = lambda c: F.sum(c.cast("bigint")).alias
    both = F.col("b").isNotNull()
    return j.agg(n(both & (F.col("a") != F.col("b")))("changed"), n(both & (F.col("a") == F.col("b")))("unchanged"), n(~both)("no_previous"), F.avg(F.when(both, F.col("cb"))).alias("completeness_before"), F.avg(F.when(both, F.col("ca"))).alias("completeness_after"))


def reprocess(spark: SparkSession, root: str, definitions: list[Definition], stamp: str, date: str | None = None, source: str | None = None, dry_run: bool = False, reference: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) of the evidence under today's definitions, each event marked as a later version of its own definition.

    source: only lines that are routed to it count. Unless dry_run, both are added in one commit, and returned as stored.
    """
    lines = lake.read_bronze(spark, f"{root}/bronze", date)
    versions = {d.name: f"{d.version}+reprocess-{stamp}" for d in definitions}
    if source:
        routed_to = parsed(lines.select("event_uid", "raw"), definitions).where(F.col("source_type") == source).select("event_uid")
        lines = lines.join(routed_to, "event_uid", "left_semi")
    events, dead = process(lines.drop("raw_b64", "locator"), definitions, reference, log_version=versions)
    if not dry_run:
        commits = Commits(spark, root)
        commits.commit(staged(commits, events, dead))
    return events, dead


def replay(spark: SparkSession, root: str, definitions: list[Definition], now_ns: int, reason: str | None = None, since_ns: int | None = None, dry_run: bool = False, reference: Column | None = None) -> dict[str, int]:
    """Outstanding dead letters once more, by the evidence where it has them; counts of candidates, succeeded and still_failing.

    Events that pass, their marks as resolved, and new dead letters of those that fail again are one commit, so a replay
    that is cut short leaves nothing behind, and the next one starts from the same dead letters. An event with several
    dead letters is replayed once.
    """
    dead, done = lake.read_dead_letters(spark, f"{root}/deadletters"), lake.read_resolved(spark, f"{root}/resolved")
    open_ = cut(lake.unresolved(dead, done, reason, since_ns).groupBy("event_uid").agg(*(F.max_by(c, "ts_ns").alias(c) for c in ("raw", "raw_hash", "reason", "stage")), F.max("ts_ns").alias("ts_ns")))
    evidence = lake.read_bronze(spark, f"{root}/bronze").select("event_uid", F.col("raw_b64").alias("kept"), F.col("ingest_time_ns").alias("first_ns"))
    # repeated evidence is only told apart where it is open; decoding and parsing cost far more than the join's bytes tell,
    # by which Spark would give them few tasks, so the lines are dealt anew
    found = open_.join(evidence, "event_uid", "left").dropDuplicates(["event_uid"]).repartition(8 * spark.sparkContext.defaultParallelism)
    lines = found.select("event_uid", F.unbase64(F.coalesce("kept", "raw")).alias("raw"), "raw_hash", F.coalesce("first_ns", "ts_ns").alias("ingest_time_ns"))
    with held() as hold:
        events, failed = process(lines, definitions, reference, hold=hold)
        failed = failed.withColumn("ts_ns", F.lit(now_ns).cast("long"))
        counts = {"candidates": open_.count(), "succeeded": events.count(), "still_failing": failed.count()}
        if not dry_run:
            commits = Commits(spark, root)
            marks = events.select("event_uid").join(open_, "event_uid").select("event_uid", F.lit(now_ns).cast("long").alias("resolved_ts_ns"), F.col("reason").alias("original_reason"), F.col("stage").alias("original_stage"))
            commits.commit(staged(commits, events, failed) | {"resolved": commits.stage(marks, "resolved", "json")})
    return counts


def roundtrip(lines: DataFrame, definitions: list[Definition], reference: Column) -> DataFrame:
    """Shares, in percent, of lines whose bytes, parse and record come out the same twice; 100 where there is nothing to compare."""
    first, second = (validated(normalized(lines, definitions, reference)).select("event_uid", F.sha2("raw", 256).alias("h"), "raw_hash", F.sha2(F.to_json("fields"), 256).alias("f"), F.sha2(F.to_json("ocsf"), 256).alias("o"), "error", "source_type") for _ in range(2))
    j = first.join(second.select("event_uid", F.col("f").alias("f2"), F.col("o").alias("o2")), "event_uid")
    share = lambda ok, of: F.coalesce(100.0 * F.sum((ok & of).cast("int")) / F.nullif(F.sum(of.cast("int")), F.lit(0)), F.lit(100.0))
    known = F.col("source_type") != "unknown"
    parsed = known & F.col("f").isNotNull()
    good = parsed & F.col("error").isNull()
    return j.agg(share(F.col("h") == F.col("raw_hash"), F.lit(True)).alias("byte_lossless"), share(F.col("f") == F.col("f2"), parsed).alias("reparse_stable"), share(F.col("o") == F.col("o2"), good).alias("renormalize_stable"), F.sum((known & ~good).cast("bigint")).alias("dead_letters"), F.sum((~known).cast("bigint")).alias("no_match"))


def inspect(spark: SparkSession, line: bytes, definitions: list[Definition], reference: Column | None = None) -> DataFrame:
    """One row with all that the stages make of a line."""
    from stratalog.operators.crosswalk import cim, ecs
    from stratalog.operators.decode import sniff_layered

    one = spark.createDataFrame([("inspected", bytearray(line), 0)], "event_uid string, raw binary, ingest_time_ns long").withColumn("raw_hash", F.sha2("raw", 256))
    rows = enriched(validated(normalized(one, definitions, reference)))
    return rows.withColumn("sniffed", sniff_layered(F.col("text"))).withColumn("ecs", F.to_json(ecs())).withColumn("cim", F.to_json(cim()))


def rolling_rate(outcomes: DataFrame, order: str, key: str, ok: str, width: int = 1000) -> DataFrame:
    """Share of successes among the last width outcomes of each key."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(1 - width, 0)
    return outcomes.withColumn("rate", F.avg(F.col(ok).cast("double")).over(w))
