"""From a parsed map to the normalized record.

All definitions compile into one projection: each target is a CASE over the source type, so the input is read once,
however many definitions there are. Failures are a column, not an exception.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.functions.net import apart, canonical_ip, let
from stratalog.functions.times import any_ns
from stratalog.operators import schema
from stratalog.operators.decode import bom_stripped, decoded, enveloped, sniff_layered
from stratalog.operators.definition import Definition, Rule, route
from stratalog.operators.engines import compile_engine

TRUE, FALSE = ("true", "t", "yes", "y", "1", "on"), ("false", "f", "no", "n", "0", "off", "")
ERROR = "struct<stage: string, reason: string, target: string>"
KINDS = {"int": "bigint", "timestamp": "bigint", "float": "double", "bool": "boolean"}


def present(fields: Column, name: str) -> Column:
    return F.nullif(F.try_element_at(fields, F.lit(name)), F.lit(""))


def coerce(text: Column, kind: str, reference: Column, fmt: str | None = None, tz: str = "UTC") -> Column:
    """The value, null where the text isn't one."""
    t = F.trim(text)
    if kind == "int":
        number = t.try_cast("double")
        return F.coalesce(F.when(t.rlike(r"^[+-]?\d+$"), t.try_cast("bigint")), F.when(t.rlike(r"^[+-]?[\d.]+([eE][+-]?\d+)?$") & (number == F.floor(number)), number.try_cast("bigint")))
    if kind == "float":
        return t.try_cast("double")
    if kind == "bool":
        return F.when(F.lower(t).isin(*TRUE), True).when(F.lower(t).isin(*FALSE), False)
    if kind == "ip":
        return canonical_ip(t)
    if kind == "timestamp":
        return any_ns(text, reference, fmt, tz)
    return text


def _literal(value: Any, kind: str) -> Column:
    return F.lit(value).cast(kind)


def lookup(text: Column, table: dict[str, Any], default: Any, kind: str) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(text == k, _literal(v, kind))
    return out.otherwise(_literal(default, kind)) if table else _literal(default, kind)


def _kind(rule: Rule) -> str:
    if rule.map is None:
        return KINDS.get(rule.type, "string")
    values = [v for v in (*rule.map.values(), rule.default) if v is not None]
    return "bigint" if values and all(isinstance(v, int) and not isinstance(v, bool) for v in values) else "string"


def source_value(rule: Rule, at) -> Column:
    """What the rule's sources give; at(source) gives a field's column."""
    each = [F.when(at(s) != "", at(s)) for s in rule.sources]
    if rule.join is not None and len(each) > 1:
        return F.nullif(F.concat_ws(rule.join, *each), F.lit(""))
    return F.coalesce(*each)


def typed(rule: Rule) -> bool:
    return rule.map is None and rule.type != "str"


def read_as(rule: Rule, raw: Column, reference: Column) -> Column:
    """A source's value by the rule's table or as its type, null where it isn't one."""
    if rule.map is not None:
        return lookup(raw, rule.map, rule.default, _kind(rule))
    return coerce(raw, rule.type, reference, rule.format, rule.tz) if typed(rule) else raw


def mapped(rule: Rule, raw: Column, got: Column, kind: str) -> tuple[Column, Column]:
    """The rule's value, as kind, and the reason of its error, null if there is none; got: read_as of raw."""
    default = _literal(rule.default, _kind(rule)).cast(kind)
    value = F.when(raw.isNull(), default).otherwise(got) if rule.default is not None else F.when(raw.isNotNull(), got)
    bad = F.when(raw.isNotNull() & got.isNull(), f"invalid_{rule.type}") if typed(rule) else F
    return value, bad.when(value.isNull(), "required_unresolved").otherwise(None) if rule.required else bad.otherwise(None) if typed(rule) else F.lit(None).cast("string")


def unused(definition: Definition, fields: Column) -> Column:
    """The entries of fields that stay as unmapped: no rule takes its value from them and the definition keeps them.

    A present key that a rule tries first, or joins, is used whatever else there is; so only the later sources of a rule
    depend on other keys, and their winners are found once a row.
    """
    chains = [r for r in definition.rules if r.join is None and len(r.sources) > 1]
    first = {s for r in definition.rules for s in (r.sources[:1] if r in chains else r.sources)} | ({definition.activity["from"]} if isinstance(definition.activity, dict) else set())
    listed = definition.unmapped if isinstance(definition.unmapped, list) else None

    def kept(won: Column | None):
        def keep(k: Column, v: Column) -> Column:
            used = k.isin(*sorted(first)) if won is None else k.isin(*sorted(first)) | F.array_contains(won, k)
            open_ = ~used | F.coalesce(v, F.lit("")).eqNullSafe("")
            return open_ if definition.unmapped == "keep_all" else k.isin(*listed) & open_ if listed else F.lit(False)

        return F.map_filter(fields, keep)

    later = [r for r in chains if not first.issuperset(r.sources)]
    if not later:
        return kept(None)
    return let(F.array_compact(F.array(*(F.coalesce(*(F.when(present(fields, s).isNotNull(), s) for s in r.sources)) for r in later))), kept)


def target_types(definitions: list[Definition]) -> dict[str, str]:
    """Type of each target path over all definitions; text where they differ."""
    kinds: dict[str, set[str]] = {}
    for d in definitions:
        for path, v in d.constants.items():
            kinds.setdefault(path, set()).add("bigint" if isinstance(v, int) else "string")
        for r in d.rules:
            kinds.setdefault(r.target, set()).add(_kind(r))
    for path in ("class_uid", "category_uid", "activity_id", "type_uid", "severity_id", "time", "action_id", "status_id", "src_endpoint.port", "dst_endpoint.port", "traffic.bytes", "traffic.bytes_in", "traffic.bytes_out", "traffic.packets", "connection_info.protocol_num", "connection_info.direction_id"):
        kinds.setdefault(path, set()).add("bigint")
    for path in ("class_name", "category_name", "type_name", "activity_name", "severity", "action", "disposition", "metadata.uid", "metadata.log_hash", "metadata.version", "metadata.log_version", "src_endpoint.ip", "dst_endpoint.ip", "connection_info.protocol_name", "connection_info.direction", "firewall_rule.uid", "firewall_rule.name", "finding_info.uid", "finding_info.title", "finding_info.types", "src_endpoint.hostname", "dst_endpoint.hostname", "http_request.http_method", "query.hostname"):
        kinds.setdefault(path, set()).add("string")
    return {p: next(iter(k)) if len(k) == 1 else "bigint" if k == {"bigint"} else "string" for p, k in sorted(kinds.items())}


def nested(leaves: dict[str, Column]) -> Column:
    """A struct from dotted paths."""
    tree: dict = {}
    for path, c in leaves.items():
        at = tree
        *parents, leaf = path.split(".")
        for p in parents:
            at = at.setdefault(p, {})
        at[leaf] = c

    def build(node: dict) -> Column:
        return F.struct(*((build(v) if isinstance(v, dict) else v).alias(k) for k, v in node.items()))

    return build(tree)


def leaf_paths(kind, prefix: str = "") -> list[str]:
    out = []
    for f in kind.fields:
        out += leaf_paths(f.dataType, f"{prefix}{f.name}.") if hasattr(f.dataType, "fields") else [prefix + f.name]
    return out


def parsed(lines: DataFrame, definitions: list[Definition]) -> DataFrame:
    """lines (raw binary and more) with text, bom_stripped, source_type, envelope, fields and parse_reason (why there are none)."""
    out = lines.withColumn("bom_stripped", bom_stripped(F.col("raw"))).withColumn("text", decoded(F.col("raw")))
    out, header = enveloped(out, "text")
    out = out.withColumn("payload", header["message"]).withColumn("kind", sniff_layered(F.col("text"))["inner"])
    out = out.withColumn("source_type", route(F.col("text"), definitions)).drop("payload", "kind")
    fields, reason = F, F
    for d in definitions:
        own = F.when(F.col("source_type") == d.name, header["message"] if d.envelope == "syslog" and d.engine not in ("cef", "leef") else F.col("text"))
        engine = compile_engine(d.engine, d.options)
        got, reason = engine(own), reason.when(F.col("source_type") == d.name, engine.why(own))
        if d.envelope == "syslog":
            names = ("timestamp", "hostname", "app_name", "procid", "msgid", "tag", "pri", "facility", "facility_name", "severity", "severity_name")
            extra = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(f"envelope.{h}").alias("k"), F.when(header["format"] != "none", header[h].cast("string")).alias("v")) for h in names)), lambda e: e["v"].isNotNull()))
            got = F.map_concat(got, extra)
        fields = fields.when(F.col("source_type") == d.name, got)
    out = out.withColumn("fields", fields.otherwise(F.lit(None).cast("map<string,string>")) if definitions else F.lit(None).cast("map<string,string>"))
    out = out.withColumn("parse_reason", F.when(F.col("fields").isNull(), reason.otherwise(None)) if definitions else F.lit(None).cast("string"))
    return out.drop(*(c for c in out.columns if c.startswith("__envelope_")))


def normalized(lines: DataFrame, definitions: list[Definition], reference: Column | None = None, log_version: str | dict[str, str] | None = None) -> DataFrame:
    """lines (event_uid, raw, raw_hash and more) with source_type, mapping_version, ocsf, unmapped and error.

    reference: the time that yearless timestamps are read against; log_version: of all events, or by source.
    """
    reference = F.current_timestamp() if reference is None else reference
    rows = parsed(lines, definitions)
    kinds = target_types(definitions)
    by_source = lambda pick: _case(definitions, pick)
    f = F.col("fields")
    rules = {d.name: {r.target: r for r in d.rules} for d in definitions}
    # each step's results are columns, so that later ones refer to them: the fields that rules name, what each target's
    # rule takes from them, and that as the rule's type
    users: dict[str, list[str]] = {}
    for d in definitions:
        for n in dict.fromkeys([x for r in d.rules for x in r.sources] + ([d.activity["from"]] if isinstance(d.activity, dict) else [])):
            users.setdefault(n, []).append(d.name)
    own = [c for c in rows.columns if c not in ("error", "parse_reason")]
    rows = rows.select(*(apart(F.col(c)).alias(c) if c == "source_type" else c for c in rows.columns), *(F.when(F.col("source_type").isin(*of), F.try_element_at(f, F.lit(n))).alias(f"__f_{n}") for n, of in users.items()))
    paths = [p for p in kinds if any(p in rules[d.name] for d in definitions)]
    ruled = lambda p, of: by_source(lambda d: of(rules[d.name][p]) if p in rules[d.name] else None)
    field, raw, got = (lambda p, x=x: F.col(f"`__{x}_{p}`") for x in "fst")
    rows = rows.select("*", *(ruled(p, lambda r: source_value(r, field)).alias(f"__s_{p}") for p in paths))
    rows = rows.select("*", *(ruled(p, lambda r, p=p: read_as(r, raw(p), reference).cast(kinds[p])).alias(f"__t_{p}") for p in paths))
    result = lambda r: mapped(r, raw(r.target), got(r.target), kinds[r.target])

    def value(path: str) -> Column:
        def of(d: Definition):
            if path in rules[d.name]:
                return result(rules[d.name][path])[0]
            return _literal(d.constants[path], kinds[path]) if path in d.constants else None

        return by_source(of).cast(kinds[path])

    def activity(d: Definition):
        if isinstance(d.activity, int):
            return F.lit(d.activity).cast("bigint")
        return lookup(F.when(field(d.activity["from"]) != "", field(d.activity["from"])), {str(k): v for k, v in d.activity["map"].items()}, d.activity.get("default"), "bigint")

    leaves = {p: value(p) for p in kinds if p not in ("class_uid", "category_uid", "activity_id", "type_uid")}
    leaves |= {"class_uid": apart(by_source(lambda d: F.lit(d.class_uid).cast("bigint"))), "category_uid": by_source(lambda d: F.lit(d.category_uid).cast("bigint")), "activity_id": by_source(activity)}
    leaves |= {"metadata.uid": F.col("event_uid"), "metadata.log_hash": F.col("raw_hash"), "metadata.version": F.lit(schema.VERSION), "metadata.log_version": by_source(lambda d: F.lit(log_version.get(d.name))) if isinstance(log_version, dict) else F.lit(log_version).cast("string")}
    flat = rows.select("*", *(c.alias(f"__{p}") for p, c in leaves.items()))
    at = lambda p: F.col(f"`__{p}`")
    derived = finalized(at)
    problem = lambda r: result(r)[1]
    failed = lambda r: F.when(problem(r).isNotNull(), F.struct(F.lit("normalize").alias("stage"), problem(r).alias("reason"), F.lit(r.target).alias("target")))
    first_error = by_source(lambda d: F.coalesce(*(failed(r) for r in d.rules if typed(r) or r.required), F.lit(None).cast(ERROR)))
    parse_error = F.when((F.col("source_type") != "unknown") & F.col("fields").isNull(), F.struct(F.lit("parse").alias("stage"), F.coalesce("parse_reason", F.lit("parse_failed")).alias("reason"), F.lit(None).cast("string").alias("target")))
    # of two references to fields none is inlined, so the map is built once
    rest = F.when(f.isNotNull(), by_source(lambda d: unused(d, f))).cast("map<string,string>")
    return flat.select(
        *own, by_source(lambda d: F.lit(d.version)).alias("mapping_version"),
        F.when(F.col("source_type") != "unknown", nested({p: derived.get(p, at(p)) for p in kinds} | {"class_uid": apart(at("class_uid"))})).alias("ocsf"),
        rest.alias("unmapped"), F.coalesce(parse_error, first_error).alias("error"),
    )


def _case(definitions: list[Definition], pick) -> Column:
    out, any_ = F, False
    for d in definitions:
        c = pick(d)
        if c is not None:
            out, any_ = out.when(F.col("source_type") == d.name, c), True
    return out if any_ else F.lit(None)


def _named(of: Column, table: dict[int, str]) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(of == k, v)
    return out.otherwise(F.lit(None).cast("string"))


def finalized(at) -> dict[str, Column]:
    """Names that follow from numbers; at(path) gives a path's column."""
    cls, act = at("class_uid"), at("activity_id")
    activity = F
    for c, names in schema.ACTIVITIES.items():
        activity = activity.when(cls == c, _named(act, names))
    activity = activity.otherwise(F.lit(None).cast("string"))
    name = _named(cls, schema.CLASSES)
    return {
        "class_name": name, "category_name": _named(at("category_uid"), schema.CATEGORIES), "type_uid": cls * 100 + act,
        "activity_name": F.coalesce(F.nullif(at("activity_name"), F.lit("")), activity),
        "type_name": F.when(act.isNotNull(), F.when(activity.isNotNull(), F.concat(name, F.lit(": "), activity)).otherwise(name)),
        "severity": F.coalesce(_named(at("severity_id"), schema.SEVERITIES), at("severity")),
    }


def core_columns() -> list[Column]:
    """The 17 columns that every event of the lake has."""
    o = lambda p: F.col(f"ocsf.{p}")
    where = {
        "event_uid": F.col("event_uid"), "raw_hash": F.col("raw_hash"), "source_type": F.col("source_type"), "src_ip": o("src_endpoint.ip"), "src_port": o("src_endpoint.port"), "dst_ip": o("dst_endpoint.ip"),
        "dst_port": o("dst_endpoint.port"), "bytes_in": o("traffic.bytes_in"), "bytes_out": o("traffic.bytes_out"),
        "protocol": F.coalesce(F.nullif(o("connection_info.protocol_name"), F.lit("")), o("connection_info.protocol_num").cast("string")),
    }
    return [(where[c] if c in where else o(c)).cast(t).alias(c) for c, t in schema.CORE.items()]


def core(rows: DataFrame) -> DataFrame:
    return rows.select(*core_columns())


def flattened(rows: DataFrame, record: str = "ocsf") -> DataFrame:
    """rows with the record's leaves as dotted columns."""
    return rows.select(*[c for c in rows.columns if c != record], *(F.col(f"{record}.{p}").alias(p) for p in leaf_paths(rows.schema[record].dataType)))
