"""The lake: evidence, events and dead letters as tables, and read-only questions over them."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.functions.times import date_of_ns
from stratalog.operators import schema
from stratalog.operators.normalize import core_columns, leaf_paths
from stratalog.plans.commits import Commits, Conflict, live_files

MAX_LIMIT = 10_000
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}
#: Buckets are counted from Monday 2000-01-03, in seconds (a fixed value).
ORIGIN = 946_857_600
BRONZE = "event_uid string, raw_b64 string, raw_hash string, raw_len int, ingest_time_ns long, source_id string, transport string, peer string, locator string"
DEAD = "event_uid string, raw string, raw_hash string, reason string, stage string, detail string, ts_ns long"
SEARCH = (*schema.CORE, "date", "severity", "action")


def bronze(lines: DataFrame) -> DataFrame:
    """Evidence rows of lines (event_uid, raw, ingest_time_ns, source_id): hash, length, ingest date."""
    return lines.withColumn("raw_hash", F.sha2("raw", 256)).withColumn("raw_len", F.octet_length("raw")).withColumn("date", date_of_ns(F.col("ingest_time_ns")))


def bronze_rows(lines: DataFrame) -> DataFrame:
    """Evidence as it is stored."""
    own = bronze(lines)
    keep = [c for c in ("event_uid", "raw_hash", "raw_len", "ingest_time_ns", "source_id", "transport", "peer", "locator", "date") if c in own.columns]
    return own.select(*keep, F.base64("raw").alias("raw_b64"))


def write_bronze(lines: DataFrame, path: str) -> None:
    bronze_rows(lines).write.mode("append").partitionBy("date").option("compression", "gzip").json(path)


def read_bronze(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    rows = _live_json(spark, path, BRONZE + ", date string").withColumn("raw", F.unbase64("raw_b64")).withColumn("locator", F.coalesce("locator", F.input_file_name()))
    return rows.where(F.col("date") == date) if date else rows


def _live_json(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """A table of JSON lines: the live files of a lake with a log, else all of the folder."""
    files = live_files(spark, path)
    if files is None:
        return spark.read.schema(schema).options(**options).json(path)
    return spark.read.schema(schema).option("basePath", path).json(files) if files else spark.createDataFrame([], schema)


def silver(events: DataFrame) -> DataFrame:
    """Core columns, the record's other leaves under their dotted names, and the rests as JSON; date is the event's, or else the ingest's."""
    drift = leaf_paths(events.schema["ocsf"].dataType)
    rest = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("unmapped"))))
    more = [F.when(F.size("unmapped") > 0, rest).alias("unmapped_json"), (F.to_json("enrichment") if "enrichment" in events.columns else F.lit(None).cast("string")).alias("enrichments_json")]
    o = lambda p: F.col(f"ocsf.{p}")
    when = F.coalesce(o("time"), F.col("ingest_time_ns"))
    return events.select(*core_columns(), *(o(p).alias(p) for p in drift if "." in p), *more, date_of_ns(when).alias("date"))


def write_silver(events: DataFrame, path: str) -> None:
    silver(events).write.mode("append").partitionBy("date", "source_type").option("compression", "zstd").parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """All parts by column name; an empty lake gives an empty, typed table."""
    files = live_files(spark, path)
    try:
        found = spark.read.option("mergeSchema", True).option("basePath", path).parquet(*([path] if files is None else files))
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e) and files != []:
            raise
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in schema.CORE.items()) + ", unmapped_json string, enrichments_json string, date string")
    return found.withColumn("date", F.col("date").cast("string"))


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters; in a folder without a log those files that are named so."""
    if live_files(spark, path) is None:
        return spark.read.schema(DEAD).option("pathGlobFilter", "*deadletters*").option("recursiveFileLookup", True).json(path)
    return _live_json(spark, path, DEAD)


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    """Which dead letters were resolved, and when; none yet gives none."""
    schema = "event_uid string, resolved_ts_ns long, original_reason string, original_stage string"
    try:
        return _live_json(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def recent(events: DataFrame, limit: int = 100, tie: str = "event_uid") -> DataFrame:
    """The newest events; of equal times those with the smaller tie."""
    return events.orderBy(F.desc_nulls_last("time"), *([tie] if tie in events.columns else [])).limit(max(1, min(MAX_LIMIT, limit)))


def search(events: DataFrame, since_ns: int | None = None, until_ns: int | None = None, limit: int = 100, tie: str = "event_uid", **equal) -> DataFrame:
    """Newest first: equality on event columns and an inclusive time range."""
    if unknown := set(equal) - set(SEARCH):
        raise ValueError(f"unknown filters {sorted(unknown)}")
    for k, v in equal.items():
        events = events.where(F.col(k) == F.lit(v))
    if since_ns is not None:
        events = events.where(F.col("time") >= since_ns)
    if until_ns is not None:
        events = events.where(F.col("time") <= until_ns)
    return recent(events, limit, tie)


def stats_by_source(events: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum(F.coalesce("bytes_in", F.lit(0)) + F.coalesce("bytes_out", F.lit(0))), F.lit(0))
    return events.groupBy("source_type").agg(F.count(F.lit(1)).alias("events"), F.min("time").alias("first_time_ns"), F.max("time").alias("last_time_ns"), total.cast("bigint").alias("total_bytes"), F.count_distinct("src_ip").alias("distinct_src_ip")).orderBy(F.desc("events"), "source_type")


def seconds(text: str) -> int:
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day|week)s?\s*", text)
    if not m or not int(m[1]):
        raise ValueError(f"{text!r} is not an interval")
    return int(m[1]) * UNITS[m[2]]


def timeseries(events: DataFrame, interval: str, window: str) -> DataFrame:
    """Counts by bucket and source over the last window of data, measured back from the newest bucket."""
    width, span = seconds(interval), seconds(window)
    at = F.floor(F.col("time") / F.lit(1_000_000_000)).cast("bigint")
    bucket = (F.floor((at - ORIGIN) / F.lit(width)) * width + ORIGIN).cast("bigint")
    counts = events.where("time is not null").groupBy(bucket.alias("__b"), "source_type").agg(F.count(F.lit(1)).alias("events"))
    newest = events.agg(F.max(bucket).alias("__newest"))
    kept = counts.join(F.broadcast(newest), F.col("__b") >= F.col("__newest") - span)
    return kept.select(F.concat(date_of_ns(F.col("__b") * 1_000_000_000), F.lit("T"), F.date_format(F.timestamp_seconds(F.pmod("__b", F.lit(86_400))), "HH:mm:ss")).alias("bucket"), "source_type", "events").orderBy("bucket", "source_type")


def dead_letter_stats(dead: DataFrame, resolved: DataFrame) -> DataFrame:
    """Counts by reason, by stage, and in all, with how many are resolved."""
    own = dead.join(resolved.select("event_uid").distinct().withColumn("done", F.lit(1)), "event_uid", "left")
    return own.groupingSets([["reason"], ["stage"], []], "reason", "stage").agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("done"), F.lit(0)).cast("bigint").alias("resolved"))


def recent_dead_letters(dead: DataFrame, limit: int = 100) -> DataFrame:
    return dead.orderBy(F.desc("ts_ns"), "event_uid").limit(max(0, limit))


def dead_letter_counts(dead: DataFrame) -> DataFrame:
    """Counts by reason and stage, the most frequent first."""
    return dead.groupBy("reason", "stage").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason", "stage")


def dead_letter_sample(dead: DataFrame, each: int = 5) -> DataFrame:
    """The newest few of each reason. Partial top lists are merged, so a frequent reason makes no task large."""
    rows = Window.partitionBy("reason").orderBy(F.desc("ts_ns"), "event_uid")
    return dead.withColumn("__n", F.row_number().over(rows)).where(F.col("__n") <= each).drop("__n")


def read_by_uid(bronze: DataFrame, event_uid: str) -> DataFrame:
    """The evidence of one event, with intact: whether its bytes still have the recorded hash."""
    return bronze.where(F.col("event_uid") == event_uid).withColumn("intact", F.sha2("raw", 256) == F.col("raw_hash"))


def dead_letter_examples(dead: DataFrame, reason: str, limit: int = 5) -> DataFrame:
    """The oldest dead letters of one reason."""
    return dead.where(F.col("reason") == reason).orderBy("ts_ns", "event_uid").limit(max(0, limit))


def unresolved(dead: DataFrame, resolved: DataFrame, reason: str | None = None, since_ns: int | None = None) -> DataFrame:
    """Outstanding dead letters, of a reason and from a time on if these are given."""
    dead = dead.where(F.col("reason") == reason) if reason is not None else dead
    dead = dead.where(F.col("ts_ns") >= since_ns) if since_ns is not None else dead
    return dead.join(resolved.select("event_uid").distinct(), "event_uid", "left_anti")


def unify(parts: list[DataFrame]) -> DataFrame:
    """Union by name; a column whose types differ becomes JSON text in all parts."""
    kinds: dict[str, set[str]] = {}
    for p in parts:
        for f in p.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
    text = lambda c: F.when(F.col(f"`{c}`").isNotNull(), F.regexp_extract(F.to_json(F.struct(F.col(f"`{c}`").alias("x"))), r'(?s)^\{"x":(.*)\}$', 1))
    same = [p.select(*(text(c).alias(c) if len(kinds[c]) > 1 else F.col(f"`{c}`") for c in p.columns)) for p in parts]
    out = same[0]
    for p in same[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def compact(spark: SparkSession, path: str, target_bytes: int = 128 << 20, min_files: int = 2) -> dict:
    """Merges the live files of each partition with min_files or more into files of about target_bytes, a commit for each partition.

    Readers see a partition's files before or after, never both. A partition that another commit changes meanwhile stays
    as it is and is counted as skipped; what else fails is raised. Old files stay for readers until Commits.vacuum; only
    in a folder that had no log until now, whose readers take all files, they go at once.
    """
    root, _, table = path.rstrip("/").rpartition("/")
    commits = Commits(spark, root)
    plain = not commits.exists()
    commits.adopt(table)
    live = commits.version()[1].get(table, {})
    size = {name: n for name, n, _ in commits._data(table)}
    folders: dict[str, list[str]] = {}
    for f in live:
        if f.endswith(".parquet"):
            folders.setdefault(f.rpartition("/")[0], []).append(f)
    report = {"merged": 0, "skipped": 0, "files_before": 0, "files_after": 0}
    for folder, files in folders.items():
        if len(files) < min_files:
            continue
        n = max(1, -(-sum(size.get(f, 0) for f in files) // target_bytes))
        merged = unify([spark.read.parquet(f"{root}/{f}") for f in files]).repartition(n)
        made = commits.stage(merged, folder, "parquet", compression="zstd")
        try:
            commits.commit({table: made}, {table: files})
        except Conflict:
            report["skipped"] += 1
            continue
        if plain:
            commits.delete(files)
        report["merged"] += 1
        report["files_before"] += len(files)
        report["files_after"] += len(made)
    return report
