"""Timestamps as epoch nanoseconds (BIGINT), from the forms that log lines use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog.functions.net import let

#: strptime directives and their Java patterns (fixed values).
DIRECTIVES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%f": "SSSSSS", "%y": "yy", "%b": "MMM", "%B": "MMMM", "%z": "xx", "%Z": "z", "%p": "a", "%I": "hh", "%j": "DDD", "%%": "%"}


def java_pattern(fmt: str) -> str:
    """A strptime format as a Java one; letters outside directives are quoted."""
    out, i = "", 0
    while i < len(fmt):
        if fmt[i] == "%":
            if fmt[i : i + 2] not in DIRECTIVES:
                raise ValueError(f"unsupported directive {fmt[i : i + 2]!r}")
            out += DIRECTIVES[fmt[i : i + 2]]
            i += 2
        else:
            out += f"'{fmt[i]}'" if fmt[i].isalpha() else fmt[i]
            i += 1
    return out


def _nanos(ts: Column) -> Column:
    return F.unix_micros(ts) * 1000


def epoch_ns(text: Column) -> Column:
    """Digits with an optional fraction: seconds, or milliseconds from 1e11 up; exact, half to even."""
    number = F.when(text.rlike(r"^[+-]?\d{1,18}(\.\d*)?$"), text.cast("decimal(38,12)"))
    scaled = F.when(F.abs(number) >= 100_000_000_000, number * 1_000_000).otherwise(number * 1_000_000_000)
    return F.bround(scaled, 0).cast("bigint")


def format_ns(text: Column, fmt: str, tz: str = "UTC") -> Column:
    pattern = java_pattern(fmt)
    zone = "" if any(x in fmt for x in ("%z", "%Z")) else f" {tz}"
    return _nanos(F.try_to_timestamp(F.concat(F.trim(text), F.lit(zone)), F.lit(pattern + (" VV" if zone else ""))))


def rfc3164_ns(text: Column, reference: Column) -> Column:
    """Mmm d hh:mm:ss in the reference's year; a year earlier where that lies in its future or isn't a date."""
    squeezed = F.regexp_replace(F.trim(text), " +", " ")
    year = F.year(reference)
    at = lambda y: F.try_to_timestamp(F.concat(y.cast("string"), F.lit(" "), squeezed, F.lit(" UTC")), F.lit("yyyy MMM d HH:mm:ss VV"))
    return let(at(year), lambda this: _nanos(F.when(this <= reference, this).otherwise(at(year - 1))))


def iso_ns(text: Column, tz: str = "UTC") -> Column:
    """ISO 8601 and a few more forms; a naive time is in tz."""
    t = F.trim(text)
    clean = F.regexp_replace(t, r"^(\d{4}-\d\d-\d\d)[ tT](\d\d:\d\d(:\d\d)?)", "$1T$2")
    clean = F.regexp_replace(clean, r"([+-]\d\d)(\d\d)$", "$1:$2")
    zoned = clean.rlike(r"T.*(Z|z|[+-]\d\d:\d\d)$")
    iso = F.when(zoned, F.try_to_timestamp(F.upper(clean))).when(clean.rlike(r"^\d{4}-\d\d-\d\d(T\d\d:\d\d(:\d\d(\.\d+)?)?)?$"), F.try_to_timestamp(F.concat(F.when(clean.contains("T"), clean).otherwise(F.concat(clean, F.lit("T00:00"))), F.lit(tz if tz != "UTC" else "Z"))))
    plain = F.regexp_replace(t, "^[A-Z][a-z]{2}, ", "")  # without a weekday
    more = [F.try_to_timestamp(plain, F.lit(p)) for p in ("dd/MMM/yyyy:HH:mm:ss xx", "d MMM yyyy HH:mm:ss xx")]
    more += [F.try_to_timestamp(F.concat(t, F.lit(f" {tz}")), F.lit(f"{p} VV")) for p in ("yyyy/MM/dd HH:mm:ss", "d MMM yyyy HH:mm:ss", "MMM d yyyy HH:mm:ss")]
    return _nanos(F.coalesce(iso, *more))


def any_ns(text: Column, reference: Column, fmt: str | None = None, tz: str = "UTC") -> Column:
    """By the format where one is given, else epoch numbers, then yearless syslog times, then ISO and the like."""
    if fmt:
        return format_ns(text, fmt, tz)
    yearless = r"^[A-Z][a-z]{2} +\d{1,2} \d\d:\d\d:\d\d$"
    return let(F.trim(text), lambda t: F.when(t.rlike(r"^[+-]?[\d.]+$"), epoch_ns(t)).when(t.rlike(yearless), rfc3164_ns(t, reference)).otherwise(iso_ns(t, tz)))


def date_of_ns(ns: Column) -> Column:
    """UTC date of epoch nanoseconds, as text, whatever the session's zone."""
    days = F.floor(ns / F.lit(86_400_000_000_000)).cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), "yyyy-MM-dd")


def iso_of_ns(ns: Column) -> Column:
    """2026-01-02T03:04:05.000006Z, whatever the session's zone."""
    micros = F.expr("0L") + F.floor(ns / F.lit(1000)).cast("bigint")
    second = F.pmod(F.floor(micros / F.lit(1_000_000)).cast("bigint"), F.lit(86_400))
    part = lambda x, n: F.lpad(x.cast("int").cast("string"), n, "0")
    return F.concat(date_of_ns(ns), F.lit("T"), part(F.floor(second / 3600), 2), F.lit(":"), part(F.floor(F.pmod(second, F.lit(3600)) / 60), 2), F.lit(":"), part(F.pmod(second, F.lit(60)), 2), F.lit("."), part(F.pmod(micros, F.lit(1_000_000)), 6), F.lit("Z"))
