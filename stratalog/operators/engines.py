"""Parse engines: options compile, on the driver, to a function from a text column to a map of strings.

All but grok expressions that may run away, and JSON that is said to be deep, stay in Catalyst expressions. A null result
means that the text doesn't have the engine's form; why(text) then gives the reason.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog.functions.net import let
from stratalog.operators.deep import walk
from stratalog.operators.patience import NO_MATCH, risky, timed_match


@dataclass(frozen=True)
class Engine:
    """A text column's fields, and the reason for which a text has none."""

    run: Callable[[Column], Column]
    why: Callable[[Column], Column] = lambda text: F.lit("parse_failed")

    def __call__(self, text: Column) -> Column:
        return self.run(text)


ENGINES: dict[str, Callable[..., Engine]] = {}


def engine(name: str):
    """Registers a factory: options -> engine. A name is given once."""

    def register(factory):
        if name in ENGINES:
            raise ValueError(f"engine {name} exists")
        ENGINES[name] = factory
        return factory

    return register


def compile_engine(name: str, options: dict | None = None) -> Engine:
    if name not in ENGINES:
        raise ValueError(f"unknown engine {name}")
    return ENGINES[name](**(options or {}))


def last_wins(keys: Column, values: Column) -> Column:
    """Map of two arrays; of equal keys the last counts, whatever the session's policy."""
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

    def build(x: Column) -> Column:
        kept = F.filter(F.sequence(F.lit(1), F.size(x["k"])), lambda i: ~F.array_contains(F.slice(x["k"], i + 1, F.size(x["k"])), F.element_at(x["k"], i)))
        once = F.size(F.array_distinct(x["k"])) == F.size(x["k"])
        return F.when(once, F.map_from_arrays(x["k"], x["v"])).when(F.size(x["k"]) > 0, F.map_from_entries(F.transform(kept, lambda i: F.struct(F.element_at(x["k"], i), F.element_at(x["v"], i))))).otherwise(none)

    return let(F.struct(keys.alias("k"), values.alias("v")), build)


def named(columns: list[str], values: Column, skip_empty: bool = True) -> Column:
    """Map of positional values: surplus ones become _extra.<i>, a shortage adds _truncated."""
    names = F.array(*map(F.lit, columns))
    name = lambda i: F.coalesce(F.try_element_at(names, i + 1), F.concat(F.lit("_extra."), (i - len(columns)).cast("string")))
    value = lambda v: F.nullif(v, F.lit("")) if skip_empty else v
    short = F.array(F.struct(F.lit("_truncated").alias("k"), F.lit("true").alias("v")))

    def build(x: Column) -> Column:
        entries = F.transform(x, lambda v, i: F.struct(name(i).alias("k"), value(v).alias("v")))
        odd = F.map_from_entries(F.when(F.size(x) < len(columns), F.concat(entries, short)).otherwise(entries))
        return F.when(F.size(x) == len(columns), F.map_from_arrays(names, F.transform(x, value))).otherwise(odd)

    return let(values, build)


def _class(text: str) -> str:
    """A character class of one literal character."""
    return "\\t" if text == "\t" else f"\\{text}" if text in "\\^]-[&~" else text


def _literal(text: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", text)


@engine("kv")
def kv(pair_separator: str = " ", kv_separator: str = "=", strip_quotes: bool = True) -> Engine:
    """key=value pairs; quoted values may hold separators and \\-escapes; bare words are skipped; of equal keys the last counts."""
    p, k = _class(pair_separator), _class(kv_separator)
    quoted = r'"(?:[^"\\]|\\.)*"?' if strip_quotes else r"(?!)"
    pattern = rf"(?s)(?:^|{_literal(pair_separator)})([^{p}{k}]*){_literal(kv_separator)}({quoted}[^{p}]*|[^{p}]*)"

    def run(text: Column) -> Column:
        t = F.trim(text)
        keys = F.regexp_extract_all(t, F.lit(pattern), F.lit(1))
        values = F.regexp_extract_all(t, F.lit(pattern), F.lit(2))
        bare = lambda v: F.regexp_replace(F.regexp_extract(v, r'(?s)^"((?:[^"\\]|\\.)*)', 1), r"(?s)\\(.)", "$1")
        return last_wins(keys, F.transform(values, lambda v: F.when(v.startswith('"'), bare(v)).otherwise(v)) if strip_quotes else values)

    return Engine(run)


@engine("csv")
def csv(columns: list[str] | None = None, column_map: dict | None = None, delimiter: str = ",", quotechar: str = '"', skip_empty: bool = True) -> Engine:
    """One record; a quote within quotes is doubled."""
    from stratalog.operators.columns import COLUMN_MAPS

    names = columns or COLUMN_MAPS[column_map["product"], str(column_map["version"])]
    d, q = _literal(delimiter), _literal(quotechar)
    pattern = rf"(?s){d}({q}(?:[^{_class(quotechar)}]|{q}{q})*{q}[^{_class(delimiter)}]*|[^{_class(delimiter)}]*)"

    def run(text: Column) -> Column:
        cells = F.regexp_extract_all(F.concat(F.lit(delimiter), text), F.lit(pattern), F.lit(1))
        plain = F.transform(cells, lambda c: F.when(c.startswith(quotechar), F.replace(F.regexp_replace(c, rf"(?s)^{q}(.*){q}", "$1"), F.lit(quotechar * 2), F.lit(quotechar))).otherwise(c))
        return named(names, plain, skip_empty)

    return Engine(run)


@engine("tsv")
def tsv(columns: list[str], separator: str = "\t", set_separator: str = ",", unset_field: str = "-", empty_field: str = "(empty)", list_fields: list[str] | None = None) -> Engine:
    """Positional columns; unset and empty values are null, list columns become JSON arrays, empty ones []."""

    def run(text: Column) -> Column:
        lists = F.array(*map(F.lit, list_fields or [""]))
        names = F.array(*map(F.lit, columns))
        cells = F.split(text, _literal(separator), -1)
        is_list = lambda i: F.array_contains(lists, F.coalesce(F.try_element_at(names, i + 1), F.lit(" ")))
        value = lambda c, i: F.when(c == unset_field, None).when(c == empty_field, F.when(is_list(i), "[]")).when(is_list(i), F.to_json(F.split(c, _literal(set_separator), -1))).otherwise(c)
        return F.when(~text.startswith("#"), named(columns, F.transform(cells, value)))

    return Engine(run, lambda text: F.lit("tsv_header_line"))


#: Extension keys whose label field names them (fixed values).
CEF_LABELS = tuple(f"cs{i}" for i in range(1, 7)) + tuple(f"cn{i}" for i in range(1, 4)) + tuple(f"cfp{i}" for i in range(1, 5)) + ("deviceCustomDate1", "deviceCustomDate2")
CEF_HEADER = ("CEFVersion", "deviceVendor", "deviceProduct", "deviceVersion", "deviceEventClassId", "name", "severity")


@engine("cef")
def cef() -> Engine:
    """Seven header fields and an extension whose values end where the next key begins; labelled custom fields appear under their labels too."""
    part = r"((?:[^|\\]|\\.)*)"
    header = r"(?s)^.*?CEF:" + r"\|".join([part] * 7) + r"(?:\|(.*))?$"
    pair = r"(?s)(?:^| +)([^= \\|]+)=((?:\\[\\=nr]|(?! +[^= \\|]+=).)*)"

    def run(text: Column) -> Column:
        plain = lambda c: F.regexp_replace(c, r"\\([|\\])", "$1")
        heads = F.transform(F.array(*(F.regexp_extract(text, header, i) for i in range(1, 8))), plain)
        rest = F.trim(F.regexp_extract(text, header, 8))
        keys = F.regexp_extract_all(rest, F.lit(pair), F.lit(1))
        unescaped = lambda v: F.regexp_replace(F.regexp_replace(F.regexp_replace(F.trim(v), r"(?<!\\)((?:\\\\)*)\\n", "$1\n"), r"(?<!\\)((?:\\\\)*)\\r", "$1\r"), r"\\([\\=])", "$1")
        values = F.transform(F.regexp_extract_all(rest, F.lit(pair), F.lit(2)), unescaped)
        whole = last_wins(F.concat(F.array(*map(F.lit, CEF_HEADER)), keys), F.concat(heads, values))

        def labelled(body: Column) -> Column:
            labels = F.filter(F.array(*map(F.lit, CEF_LABELS)), lambda c: F.map_contains_key(body, F.concat(c, F.lit("Label"))) & F.map_contains_key(body, c))
            names, over = F.transform(labels, lambda c: F.element_at(body, F.concat(c, F.lit("Label")))), F.transform(labels, lambda c: F.element_at(body, c))
            return last_wins(F.concat(F.map_keys(body), names), F.concat(F.map_values(body), over))

        return F.when(text.rlike(header), let(whole, labelled))

    return Engine(run, lambda text: F.when(~text.contains("CEF:"), "cef_no_marker").otherwise("cef_header_incomplete"))


@engine("leef")
def leef() -> Engine:
    """LEEF 1.0 with tabs, or 2.0 with a delimiter field: a character, 0xNN or xNN, or empty for a tab."""
    head = ("leefVersion", "vendor", "product", "productVersion", "eventId")
    rest = lambda text: F.regexp_extract(text, r"(?s)LEEF:(.*)$", 1)

    def run(text: Column) -> Column:
        body = rest(text)
        version = F.substring_index(body, "|", 1)
        cut = lambda n: F.split(body, r"\|", n)
        two = version == "2.0"
        mark = F.coalesce(F.try_element_at(cut(7), F.lit(6)), F.lit(""))
        code = F.regexp_extract(mark, r"^0?x([0-9A-Fa-f]{1,4})$", 1)
        delimiter = F.when(two & (code != ""), F.char(F.conv(code, 16, 10).cast("int"))).when(two & (mark != ""), mark).otherwise("\t")
        pairs = F.filter(F.split(F.coalesce(F.try_element_at(F.when(two, cut(7)).otherwise(cut(6)), F.when(two, F.lit(7)).otherwise(F.lit(6))), F.lit("")), F.concat(F.lit("\\Q"), delimiter, F.lit("\\E")), -1), lambda x: x.contains("="))
        keys = F.concat(F.array(*map(F.lit, head)), F.when(two, F.array(F.lit("delimiter"))).otherwise(F.array().cast("array<string>")), F.transform(pairs, lambda x: F.trim(F.substring_index(x, "=", 1))))
        heads = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.try_element_at(cut(7), i))
        values = F.concat(heads, F.when(two, F.array(mark)).otherwise(F.array().cast("array<string>")), F.transform(pairs, lambda x: F.regexp_replace(x, r"(?s)^[^=]*=", "")))
        good = version.isin("1.0", "2.0") & (F.size(cut(7)) >= 5) & (~two | (F.length(mark) <= 1) | (code != ""))
        return F.when(good, last_wins(keys, values))

    def why(text: Column) -> Column:
        version, parts = F.substring_index(rest(text), "|", 1), F.size(F.split(rest(text), r"\|", -1))
        known = F.when(parts < F.when(version == "2.0", 6).otherwise(5), "leef_header_incomplete").otherwise("leef_invalid_delimiter")
        return F.when(~text.contains("LEEF:"), "leef_no_marker").when(~version.isin("1.0", "2.0"), "leef_unsupported_version").otherwise(known)

    return Engine(run, why)


@engine("dissect")
def dissect(pattern: str, append_separator: str = "") -> Engine:
    """%{a} fields between literal delimiters, left to right; %{} skips, %{+a} appends, %{a->} swallows repeats of the delimiter."""
    parts = re.split(r"%\{([^}]*)\}", pattern)
    regex, names = "(?s)^" + _literal(parts[0]), []
    for i in range(1, len(parts), 2):
        name, after = parts[i], parts[i + 1]
        if not after and i + 2 < len(parts):
            raise ValueError("two fields need a delimiter between them")
        padded = name.endswith("->")
        names.append(name.removesuffix("->"))
        regex += "(.*)" if not after else f"(.*?)(?:{_literal(after)})" + ("++" if padded else "")
    regex += "$" if not parts[-1] else ""
    order = list(dict.fromkeys(n.lstrip("+") for n in names if n.lstrip("+")))

    def run(text: Column) -> Column:
        group = lambda n: [F.regexp_extract(text, regex, i + 1) for i, x in enumerate(names) if x.lstrip("+") == n]
        return F.when(text.rlike(regex), F.map_from_arrays(F.array(*map(F.lit, order)), F.array(*(F.concat_ws(append_separator, *group(n)) for n in order))))

    return Engine(run, lambda text: F.when(~text.startswith(parts[0]), "dissect_prefix_mismatch").otherwise("dissect_delimiter_missing"))


def expand_grok(pattern: str, patterns: dict[str, str] | None = None, depth: int = 20) -> tuple[str, list[str]]:
    """A Java expression with numbered groups, and the fields of the groups in order."""
    from stratalog.operators.patterns import PATTERNS

    library, fields = PATTERNS | (patterns or {}), []

    def expand(text: str, level: int) -> str:
        if level > depth:
            raise ValueError("patterns nest too deeply")

        def one(m: re.Match) -> str:
            name, _, field = m[1].partition(":")
            field = field.partition(":")[0]
            if name not in library:
                raise ValueError(f"unknown pattern {name}")
            if field:
                fields.append(field)
            return ("(" if field else "(?:") + expand(library[name], level + 1) + ")"

        # plain groups don't capture; within a character class, or escaped, a parenthesis is itself
        plain = re.sub(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|\((?!\?)", lambda m: "(?:" if m[0] == "(" else m[0], text, flags=re.S)
        return re.sub(r"%\{([^}]+)\}", one, plain)

    return expand(pattern, 0), fields


@engine("grok")
def grok(pattern: str, patterns: dict[str, str] | None = None, grok_timeout_ms: int = 100) -> Engine:
    """A searched expression; a field that several alternatives name takes the one that matched. All groups come from one match.

    An expression that may run away is matched under the limit of grok_timeout_ms in Arrow batches, others in the JVM.
    """
    regex, fields = expand_grok(pattern, patterns)
    names = list(dict.fromkeys(fields))

    def entries(groups: Column) -> Column:
        if not fields:
            return F.when(groups.isNotNull(), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
        value = lambda g, n: F.coalesce(*(F.nullif(g[i], F.lit("")) for i, f in enumerate(fields) if f == n))
        pairs = lambda g: F.filter(F.array(*(F.struct(F.lit(n).alias("k"), value(g, n).alias("v")) for n in names)), lambda p: p["v"].isNotNull())
        return let(groups, lambda g: F.when(g.isNotNull(), F.map_from_entries(pairs(g))))

    if risky(regex):
        return Engine(lambda text: entries(timed_match(text, regex, grok_timeout_ms)["groups"]), lambda text: timed_match(text, regex, grok_timeout_ms)["reason"])
    # a match is replaced by its groups, each after a mark; a text that holds the mark itself has its groups extracted
    mark = "\x01"
    record, whole = "".join(f"{mark}${i}" for i in range(1, len(fields) + 1)) or mark, f"(?s)^.*?(?-s:{regex}).*$"

    def run(text: Column) -> Column:
        replaced = lambda r: F.when(r.startswith(mark), F.slice(F.split(r, mark, -1), 2, max(1, len(fields))))
        each = F.when(text.rlike(regex), F.array(*(F.regexp_extract(text, regex, i) for i in range(1, len(fields) + 1))) if fields else F.array(F.lit("")))
        return entries(F.when(text.contains(mark), each).otherwise(let(F.regexp_replace(text, whole, record), replaced)))

    return Engine(run, lambda text: F.lit(NO_MATCH))


def lint_grok(pattern: str) -> list[str]:
    """Warnings about expressions that may take very long."""
    return [w for w, bad in (("nested quantifier", r"\([^()]*[+*][^()]*\)[+*]"), ("quantified reference", r"%\{[^}]*\}[+*]"), ("leading greedy match", r"^(\.\*|%\{GREEDYDATA)")) if re.search(bad, pattern)]


def json_leaves(variant: Column, size: Column, sep: str = ".") -> Column:
    """Array of (k: dotted path, v: variant) of all scalars, empty objects and empty arrays of an object, however deep, with their types.

    size: a number that no row's depth exceeds. Each turn opens one level; what was found to be a leaf isn't looked at again,
    so a value costs its own children only, however deep it lies, and a row without anything left to open waits cheaply.
    """
    struct = lambda k, v, left: F.struct(k.alias("k"), v.alias("v"), F.lit(left).alias("left"))

    def opened(e: Column) -> Column:
        inner = F.transform(F.map_entries(F.try_variant_get(e["v"], "$", "map<string,variant>")), lambda x: struct(F.concat(e["k"], F.lit(sep), x["key"]), x["value"], True))
        items = F.transform(F.try_variant_get(e["v"], "$", "array<variant>"), lambda x, i: struct(F.concat(e["k"], F.lit(sep), i.cast("string")), x, True))
        # an empty object or array stays as it is
        one = F.array(struct(e["k"], e["v"], False))
        return F.when(e["left"], let(F.coalesce(inner, items), lambda x: F.when(F.size(x) > 0, x).otherwise(one))).otherwise(one)

    def turn(state: Column, _: Column) -> Column:
        more = let(F.flatten(F.transform(state["e"], opened)), lambda e: F.struct(e.alias("e"), F.exists(e, lambda x: x["left"]).alias("open")))
        return F.when(state["open"], more).otherwise(state)

    def whole(v: Column) -> Column:
        top = F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), lambda e: struct(e["key"], e["value"], True))
        start = F.struct(top.alias("e"), F.lit(True).alias("open"))
        return F.when(v.isNotNull(), F.aggregate(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), start, turn, lambda s: F.transform(s["e"], lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v")))))

    return let(variant, whole)


def json_size(text: Column) -> Column:
    """A bound of the nesting of a JSON text: its opening brackets."""
    return F.length(text) - F.length(F.translate(text, "{[", ""))


def deep_leaves(text: Column, sep: str = ".") -> Column:
    """json_leaves of a JSON text, walked once by Python workers, so not for use in a lambda; those that they leave out are opened level by level."""
    variant = F.try_parse_json(text)
    found = F.transform(walk(F.when(variant.isNotNull(), text), sep), lambda e: F.struct(e["k"].alias("k"), F.try_parse_json(e["t"]).alias("v")))
    return F.coalesce(found, json_leaves(variant, json_size(text), sep))


def leaf_map(leaves: Column) -> Column:
    """Map of dotted paths to scalars as text; empty objects and arrays stay as they are."""
    plain = lambda v: F.coalesce(F.try_variant_get(v, "$", "string"), F.when(~F.is_variant_null(v), F.to_json(v)))
    return let(leaves, lambda all_: F.when(all_.isNotNull(), last_wins(F.transform(all_, lambda e: e["k"]), F.transform(all_, lambda e: plain(e["v"])))))


def flatten_json(variant: Column, text: Column, sep: str = ".") -> Column:
    """leaf_map of a variant. text: what it was parsed from."""
    return leaf_map(json_leaves(variant, json_size(text), sep))


@engine("json")
def json(array_mode: str = "index", sep: str = ".", deep: bool = False) -> Engine:
    """An object, or an array of exactly one, by dotted paths; array_mode=join puts lists of scalars into one text. deep: for sources of deeply nested texts, see deep_leaves."""

    def run(text: Column) -> Column:
        only = F.from_json(text, "array<string>")
        root = F.when(F.ltrim(text).startswith("["), F.when(F.size(only) == 1, only[0])).otherwise(text)
        whole = lambda r: F.when(F.ltrim(r).startswith("{"), r)
        flat = leaf_map(deep_leaves(whole(root), sep)) if deep else let(root, lambda r: F.when(F.ltrim(r).startswith("{"), flatten_json(F.try_parse_json(r), r, sep)))
        return let(flat, lambda m: F.when(m.isNotNull(), _joined(m, sep))) if array_mode == "join" else flat

    return Engine(run, lambda text: F.when(F.try_parse_json(text).isNull(), "json_invalid").otherwise("json_not_one_object"))


def _joined(flat: Column, sep: str) -> Column:
    """Paths that end in a number are put together, in order, with commas."""
    stem = lambda k: F.regexp_replace(k, rf"{_literal(sep)}\d+$", "")
    keys = F.array_distinct(F.transform(F.map_keys(flat), stem))
    mine = lambda k: F.filter(F.map_keys(flat), lambda x: stem(x) == k)
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k, F.array_join(F.transform(mine(k), lambda x: F.element_at(flat, x)), ",", "null"))))
