"""Lines from captures and request bodies."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest frame, and longest body (fixed values).
MAX_FRAME, MAX_BODY = 1 << 20, 8 << 20


def raw_events(lines: DataFrame, raw: str, uid: Column, time_ns: Column, source_id: str = "unknown", transport: str = "file", peer: str | None = None) -> DataFrame:
    """Evidence columns of lines."""
    return lines.select(uid.alias("event_uid"), F.col(raw).cast("binary").alias("raw"), F.sha2(F.col(raw).cast("binary"), 256).alias("raw_hash"), F.octet_length(raw).alias("raw_len"), time_ns.alias("ingest_time_ns"), F.lit(source_id).alias("source_id"), F.lit(transport).alias("transport"), F.lit(peer).cast("string").alias("peer"))


def frames(capture: bytes, max_frame: int = MAX_FRAME) -> Iterator[bytes]:
    """RFC 6587 frames: an octet count where a message starts with digits and a space, else up to a line feed. A too long count ends the stream; at its end a line without a feed counts, a short counted frame doesn't."""
    at = 0
    while at < len(capture):
        space = capture.find(b" ", at, at + 12)
        head = capture[at:space] if space > at else b""
        if head.isdigit():
            n = int(head)
            if n > max_frame:
                return
            if space + 1 + n > len(capture):
                return
            frame, at = capture[space + 1 : space + 1 + n], space + 1 + n
        else:
            end = capture.find(b"\n", at)
            stop = len(capture) if end < 0 else end
            frame, at = capture[at:stop].removesuffix(b"\r"), stop + 1
        if frame:
            yield frame


def deframed(captures: DataFrame, content: str = "content") -> DataFrame:
    """A row (position, raw) for each frame of each capture; captures stay whole, their frames are streamed."""
    import pandas as pd

    keep = [c for c in captures.columns if c != content]

    def run(batches):
        for b in batches:
            for row in b.itertuples(index=False):
                d = row._asdict()
                body = d.pop(content)
                out = [{**d, "position": i, "raw": f} for i, f in enumerate(frames(bytes(body)) if body is not None else ())]
                if out:
                    yield pd.DataFrame(out)

    kinds = ", ".join(f"`{c}` {captures.schema[c].dataType.simpleString()}" for c in keep)
    return captures.mapInPandas(run, (kinds + ", " if kinds else "") + "position int, raw binary")


def _json_parts(body: str) -> tuple[Column, Column]:
    """Elements of an array body, keys sorted and compact, or null; lines of a body of JSON lines, or null."""
    t = F.trim(F.col(body))
    elements = F.transform(F.try_variant_get(F.try_parse_json(t), "$", "array<variant>"), lambda v: F.to_json(v))
    lines = F.filter(F.split(t, "\r?\n", -1), lambda x: F.trim(x) != "")
    return F.when(t.startswith("["), elements), F.when(~t.startswith("[") & F.forall(lines, lambda x: F.try_parse_json(x).isNotNull()), lines)


def refused_bodies(bodies: DataFrame, body: str, kind: str = "raw") -> DataFrame:
    """Bodies that give no events, without the body, with its bytes and the reason: body_too_large, or of kind json body_invalid.

    Beside raw_body_lines, json_body_events and hec_events, so that each body is accepted or refused. A body of HEC objects
    that breaks off is refused whole too, but only known by having no events.
    """
    size = F.coalesce(F.octet_length(body), F.lit(0))
    elements, lines = _json_parts(body)
    broken = F.coalesce(elements, lines).isNull() & F.col(body).isNotNull() if kind == "json" else F.lit(False)
    reason = F.when(size > MAX_BODY, "body_too_large").when(broken, "body_invalid")
    return bodies.select(*[c for c in bodies.columns if c != body], size.cast("long").alias("n_bytes"), reason.alias("reason")).where("reason IS NOT NULL")


def raw_body_lines(bodies: DataFrame, body: str) -> DataFrame:
    """Lines of bodies, without carriage returns and blanks."""
    lines = F.transform(F.split(body, "\n", -1), lambda x: F.regexp_replace(x, "\r$", ""))
    return bodies.where(F.octet_length(body) <= MAX_BODY).select(*[c for c in bodies.columns if c != body], F.posexplode(F.filter(lines, lambda x: F.trim(x) != "")).alias("position", "line"))


def json_body_events(bodies: DataFrame, body: str) -> DataFrame:
    """Elements of an array body, keys sorted and compact, or the lines of a body of JSON lines; an invalid body gives none."""
    elements, lines = _json_parts(body)
    return bodies.where(F.octet_length(body) <= MAX_BODY).select(*[c for c in bodies.columns if c != body], F.posexplode(F.coalesce(elements, lines)).alias("position", "line"))


def hec_events(bodies: DataFrame, body: str) -> DataFrame:
    """Events of concatenated HEC objects: the event, as text, and its source type."""
    import json

    import pandas as pd

    keep = [c for c in bodies.columns if c != body]

    def run(batches):
        decode = json.JSONDecoder().raw_decode
        for b in batches:
            for row in b.itertuples(index=False):
                d = row._asdict()
                text, out, at = d.pop(body) or "", [], 0
                try:
                    while at < len(text):
                        if text[at].isspace():
                            at += 1
                            continue
                        o, at = decode(text, at)
                        e = o["event"]
                        out.append({**d, "position": len(out), "line": e if isinstance(e, str) else json.dumps(e, sort_keys=True, separators=(",", ":")), "source_id": o.get("sourcetype")})
                except (ValueError, KeyError, TypeError):
                    out = []  # the whole body is refused
                if out:
                    yield pd.DataFrame(out)

    kinds = ", ".join(f"`{c}` {bodies.schema[c].dataType.simpleString()}" for c in keep)
    return bodies.where(F.octet_length(body) <= MAX_BODY).mapInPandas(run, (kinds + ", " if kinds else "") + "position int, line string, source_id string")


def zeek_tsv(lines: DataFrame, stream: str, position: str, line: str) -> DataFrame:
    """Rows of Zeek TSV streams with the header in force at each: directives yield no row, later rows use the last ones before them."""
    from pyspark.sql import Window

    text = F.col(line)
    w = Window.partitionBy(stream).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    directive = lambda name: F.last(F.when(text.startswith(f"#{name}"), F.regexp_replace(text, rf"^#{name}\s", "")), ignorenulls=True).over(w)
    rows = lines.withColumn("__fields", directive("fields")).withColumn("__types", directive("types")).withColumn("__unset", F.coalesce(directive("unset_field"), F.lit("-"))).withColumn("__empty", F.coalesce(directive("empty_field"), F.lit("(empty)"))).withColumn("__set", F.coalesce(directive("set_separator"), F.lit(",")))
    names, kinds, cells = F.split("__fields", "\t"), F.split("__types", "\t"), F.split(text, "\t", -1)
    is_list = lambda i: F.coalesce(F.try_element_at(kinds, i + 1), F.lit("")).rlike(r"^(set|vector|table)")
    split = lambda c: F.to_json(F.split(c, F.concat(F.lit("\\Q"), F.col("__set"), F.lit("\\E")), -1))
    value = lambda c, i: F.when(c == F.col("__unset"), None).when(c == F.col("__empty"), F.when(is_list(i), "[]")).when(is_list(i), split(c)).otherwise(c)
    entries = F.transform(cells, lambda c, i: F.struct(F.coalesce(F.try_element_at(names, i + 1), F.concat(F.lit("_extra."), (i - F.size(names)).cast("string"))), value(c, i)))
    good = (F.size(names) == F.size(kinds)) | F.col("__types").isNull()
    return rows.where(~text.startswith("#") & F.col("__fields").isNotNull() & good).withColumn("fields", F.map_from_entries(entries)).drop("__fields", "__types", "__unset", "__empty", "__set")
