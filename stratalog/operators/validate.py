"""Checks of normalized records, as arrays of messages, and the share of attributes they fill."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.functions.net import ip_key
from stratalog.operators import schema
from stratalog.operators.normalize import leaf_paths


def _exists(record, path: str) -> bool:
    for part in path.split("."):
        if not hasattr(record, "fields") or part not in record.names:
            return False
        record = record[part].dataType
    return True


def populated(record, path: str, name: str = "ocsf", unmapped: str = "unmapped") -> Column:
    """Whether an attribute says something: of an object, any leaf; 0 and false do, empty text doesn't."""
    if path == "unmapped":
        return F.coalesce(F.size(unmapped) > 0, F.lit(False))
    if not _exists(record, path):
        return F.lit(False)
    kind = record[path].dataType
    leaves = [f"{path}.{p}" for p in leaf_paths(kind)] if hasattr(kind, "fields") else [path]
    full = lambda p: F.coalesce(F.col(f"{name}.{p}").cast("string") != "", F.lit(False))
    return reduce(lambda a, b: a | b, map(full, leaves))


def validated(rows: DataFrame) -> DataFrame:
    """rows with errors, warnings, valid and completeness."""
    record = rows.schema["ocsf"].dataType
    at = lambda p: F.col(f"ocsf.{p}")
    cls = at("class_uid")
    say = lambda bad, *text: F.when(bad, F.concat(*(F.lit(t) if isinstance(t, str) else F.coalesce(t.cast("string"), F.lit("None")) for t in text)))
    per_class, score = F, F
    for c, (category, objects, recommended) in schema.SHAPES.items():
        missing = [say(at(s).isNull(), f"{s} is absent, though required") for s in schema.SCALARS]
        missing += [say(~populated(record, o), f"{o} is absent, though required") for o in objects]
        missing += [say(F.coalesce(at("metadata.uid") == "", at("metadata.uid").isNull()), "metadata.uid is required")]
        missing += [say(at("category_uid") != category, f"category_uid must be {category}, got ", at("category_uid"))]
        missing += [say(~at("activity_id").isin(*schema.ACTIVITIES[c]), "activity_id ", at("activity_id"), f" is not a {c} activity")]
        if c == 4001:
            missing += [say(~at("action_id").isin(*schema.ACTIONS), "action_id ", at("action_id"), " is not an action")]
        if c == 4003 and _exists(record, "rcode_id"):
            missing += [say(~at("rcode_id").isin(*schema.RCODES), "rcode_id ", at("rcode_id"), " is not a response code")]
        per_class = per_class.when(cls == c, F.array_compact(F.array(*missing)))
        names = list(dict.fromkeys((*schema.SCALARS, *objects, *recommended)))
        score = score.when(cls == c, reduce(lambda a, b: a + b, (populated(record, n).cast("int") for n in names)) / F.lit(float(len(names))))
    unknown = cls.isNull() | ~cls.isin(*schema.SHAPES)
    leaves = leaf_paths(record)
    common = [say(at("type_uid") != cls * 100 + at("activity_id"), "type_uid ", at("type_uid"), " is not class and activity, ", cls * 100 + at("activity_id")), say(at("time") <= 0, "time is before 1970 or zero: ", at("time"))]
    common += [say(at(p).isNotNull() & ip_key(at(p)).isNull(), "not an address: ", at(p)) for p in leaves if p.split(".")[-1] == "ip"]
    common += [say(~at(p).between(0, 65535), "not a port: ", at(p)) for p in leaves if p.split(".")[-1] == "port"]
    errors = F.when(unknown, F.array(F.concat(F.lit("unknown or missing class_uid: "), F.coalesce(cls.cast("string"), F.lit("None"))))).otherwise(F.concat(per_class, F.array_compact(F.array(*common))))
    warnings = F.when(unknown, F.array().cast("array<string>")).otherwise(F.array_compact(F.array(say(F.coalesce(at("metadata.version") == "", at("metadata.version").isNull()), "metadata.version is not set"), say(at("activity_id") == 0, "activity_id is 0 (Unknown)"), say(at("severity_id") == 0, "severity_id is 0 (Unknown)"))))
    return rows.withColumn("errors", errors).withColumn("warnings", warnings).withColumn("completeness", F.coalesce(score.otherwise(0.0), F.lit(0.0))).withColumn("valid", F.size("errors") == 0)


def routed(rows: DataFrame, policies: dict[str, str] | None = None, hold: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters) of normalized rows. Nothing is dropped: each row is in just one of them.

    policies: source type to "warn" where invalid records are kept; unknown sources pass. hold: keeps the checked rows, so
    that both parts come from one evaluation.
    """
    warn = [k for k, v in (policies or {}).items() if v == "warn"]
    known = F.col("source_type") != "unknown"
    invalid = known & ~F.col("valid") & (~F.col("source_type").isin(*warn) if warn else F.lit(True))
    failed = known & F.col("error").isNotNull()
    # a filter below which no predicate is pushed: substituted into the projections beneath, it would multiply them
    checked = (hold or (lambda x: x))(validated(rows)).withColumn("__barrier", F.monotonically_increasing_id())
    held = F.col("__barrier") >= 0
    reason = F.when(failed, F.col("error.reason")).otherwise("validation_failed")
    stage = F.when(failed, F.col("error.stage")).otherwise("validate")
    detail = F.to_json(F.struct(F.when(failed, F.col("error.target")).alias("target"), F.when(~failed, F.col("errors")).alias("errors"), F.col("fields").alias("parsed_fields"), F.col("ocsf").alias("partial_ocsf")))
    dead = checked.where((failed | invalid) & held).select("event_uid", F.base64("raw").alias("raw"), "raw_hash", reason.alias("reason"), stage.alias("stage"), detail.alias("detail"), F.col("ingest_time_ns").alias("ts_ns"))
    return checked.where(~(failed | invalid) & held).drop("__barrier"), dead
