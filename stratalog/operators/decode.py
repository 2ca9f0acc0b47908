"""From bytes to a payload: byte order marks, format sniffing, syslog envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.functions.net import apart, let

#: Names by number (fixed values).
FACILITIES = ("kernel", "user", "mail", "daemon", "auth", "syslog", "lpr", "news", "uucp", "cron", "authpriv", "ftp", "ntp", "audit", "alert", "cron2", *(f"local{i}" for i in range(8)))
SEVERITIES = ("Emergency", "Alert", "Critical", "Error", "Warning", "Notice", "Informational", "Debug")

_PRI = r"^<(\d{1,3})>"
_RFC5424 = r"(?s)^<\d{1,3}>(\d{1,2}) (\S+) (\S+) (\S+) (\S+) (\S+) (-|(?:\[(?:[^\]\\\"]|\\.|\"(?:[^\"\\]|\\.)*\")*\])+)(?: (.*))?$"
_RFC3164 = r"(?s)^<\d{1,3}>([A-Z][a-z]{2} [ \d]\d \d\d:\d\d:\d\d) (\S+) (.*)$"
_TAG = r"(?s)^([^\s:\[]{1,32})(?:\[([^\]]*)\])?: ?(.*)$"


def decoded(raw: Column) -> Column:
    """Text of the bytes without a byte order mark; malformed parts become replacement characters."""
    head = F.hex(F.substring(raw, 1, 3))
    rest = lambda n: F.substring(raw, n, 1 << 30)
    return F.when(head == "EFBBBF", F.make_valid_utf8(rest(4).cast("string"))).when(head.startswith("FFFE"), F.decode(rest(3), "UTF-16LE")).when(head.startswith("FEFF"), F.decode(rest(3), "UTF-16BE")).otherwise(F.make_valid_utf8(raw.cast("string")))


def bom_stripped(raw: Column) -> Column:
    head = F.hex(F.substring(raw, 1, 3))
    return (head == "EFBBBF") | head.startswith("FFFE") | head.startswith("FEFF")


def sniff(text: Column) -> Column:
    """The first format whose test the text passes."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    start = F.ltrim(text)
    return (
        F.when(text.rlike(r"^<\d+>"), "syslog")
        .when(F.substring(text, 1, 200).contains("CEF:"), "cef")
        .when(F.substring(text, 1, 200).contains("LEEF:"), "leef")
        .when((start.startswith("{") | start.startswith("[")) & F.try_parse_json(text).isNotNull(), "json")
        .when(count("\t") >= 3, "tsv")
        .when(count(r"[^\s=]+=") >= 3, "kv")
        .when(count(",") >= 8, "csv")
        .otherwise("unknown")
    )


def _number(text: Column) -> Column:
    pri = F.regexp_extract(text, _PRI, 1)
    return F.when(pri != "", pri.cast("int"))


def _words(text: Column, is5424: Column) -> Column:
    """The first words of an RFC 5424 header, which hold no spaces, and the rest."""
    return F.when(is5424, F.split(text, " ", 8))


def _parts(text: Column, is5424: Column, is3164: Column, number: Column, words: Column, body: Column, tagged: Column) -> dict[str, Column]:
    """The envelope's parts; is3164 doesn't hold where is5424 does."""
    field = lambda i: F.nullif(words[i], F.lit("-"))
    tag = F.when(tagged, F.regexp_extract(body, _TAG, 1))
    name = lambda table, i: F.coalesce(F.try_element_at(F.array(*map(F.lit, table)), i + 1), i.cast("string"))
    facility, severity = F.floor(number / 8).cast("int"), F.pmod(number, F.lit(8))
    message = F.when(is5424, F.coalesce(F.regexp_extract(text, _RFC5424, 8), F.lit(""))).when(tagged, F.regexp_extract(body, _TAG, 3)).when(is3164, body).when(number.isNotNull(), F.regexp_replace(text, _PRI, "")).otherwise(text)
    return {
        "format": F.when(is5424, "rfc5424").when(is3164, "rfc3164").when(number.isNotNull(), "pri_only").otherwise("none"),
        "pri": number, "facility": facility, "facility_name": name(FACILITIES, facility), "severity": severity, "severity_name": name(SEVERITIES, severity),
        "version": F.when(is5424, F.regexp_extract(words[0], r">(\d+)$", 1)).cast("int"), "timestamp": F.when(is5424, field(1)).when(is3164, F.regexp_extract(text, _RFC3164, 1)),
        "hostname": F.when(is5424, field(2)).when(is3164, F.regexp_extract(text, _RFC3164, 2)), "app_name": F.when(is5424, field(3)).otherwise(tag),
        "procid": F.when(is5424, field(4)).otherwise(F.nullif(F.when(tagged, F.regexp_extract(body, _TAG, 2)), F.lit(""))), "msgid": F.when(is5424, field(5)),
        "structured_data": F.when(is5424, F.nullif(F.regexp_extract(text, _RFC5424, 7), F.lit("-"))), "tag": tag, "message": message,
    }


def _struct(parts: dict[str, Column]) -> Column:
    return F.struct(*(c.alias(k) for k, c in parts.items()))


def envelope(text: Column) -> Column:
    """Struct of the syslog header's parts and the message; format is rfc5424, rfc3164, pri_only or none."""
    is5424 = text.rlike(_RFC5424)
    is3164, body = ~is5424 & text.rlike(_RFC3164), F.regexp_extract(text, _RFC3164, 3)
    return _struct(_parts(text, is5424, is3164, _number(text), _words(text, is5424), body, is3164 & body.rlike(_TAG)))


def enveloped(rows: DataFrame, text: str) -> tuple[DataFrame, dict[str, Column]]:
    """rows with the envelope of a text column, and the envelope's parts, as columns __envelope_<part>.

    What the parts share is worked out once a row, and parts that nobody reads aren't worked out.
    """
    t, at = F.col(text), lambda k: F.col(f"__envelope_{k}")
    bind = lambda df, columns: df.select("*", *(c.alias(f"__envelope_{k}") for k, c in columns.items()))
    out = bind(rows, {"is5424": apart(t).rlike(_RFC5424), "number": _number(t)})
    out = bind(out, {"is3164": ~at("is5424") & t.rlike(_RFC3164), "words": _words(t, at("is5424"))})
    out = bind(out, {"body": F.when(at("is3164"), F.regexp_extract(t, _RFC3164, 3))})
    out = bind(out, {"tagged": at("is3164") & at("body").rlike(_TAG)})
    parts = _parts(t, *map(at, ("is5424", "is3164", "number", "words", "body", "tagged")))
    out, own = bind(out, parts), {k: at(k) for k in parts}
    return out.withColumn("envelope", _struct(own)), own


def structured_data(text: Column) -> Column:
    """Map of element ids to maps of parameters, unescaped."""
    elements = F.regexp_extract_all(text, F.lit(r'\[([^\s\]="]+)((?:\s+[^\s=\]"]+="(?:[^"\\]|\\.)*")*)\s*\]'), F.lit(0))
    params = lambda e: F.regexp_extract_all(e, F.lit(r'\s([^\s=\]"]+)="((?:[^"\\]|\\.)*)"'), F.lit(0))
    pair = lambda p: F.struct(F.regexp_extract(p, r'^\s([^=]+)=', 1), F.regexp_replace(F.regexp_extract(p, r'(?s)="(.*)"$', 1), r'\\(["\\\]])', "$1"))
    return F.map_from_entries(F.transform(elements, lambda e: F.struct(F.regexp_extract(e, r"^\[([^\s\]]+)", 1), F.map_from_entries(F.transform(params(e), pair)))))


def sniff_layered(text: Column) -> Column:
    """Struct (outer, inner): within a syslog envelope the payload is sniffed too, with its tag where that helps."""
    def within(e: Column) -> Column:
        again = F.when(e["tag"].isNotNull(), sniff(F.concat(e["tag"], F.lit(":"), e["message"]))).otherwise("unknown")
        return let(sniff(e["message"]), lambda inner: F.when(inner == "unknown", again).otherwise(inner))

    return let(sniff(text), lambda outer: F.struct(outer.alias("outer"), F.when(outer == "syslog", let(envelope(text), within)).otherwise(outer).alias("inner")))
