"""Source definitions: how a vendor's lines are told apart, parsed and mapped.

A definition is data, a dict as YAML files give it, checked here. It compiles to Column expressions on the driver; the
data plane never sees it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_
from pathlib import Path
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog.operators.engines import ENGINES, compile_engine

TYPES = ("str", "int", "float", "bool", "ip", "timestamp")
DETECTORS = ("contains", "starts_with", "regex", "all", "any", "field_count", "field_equals")


class DefinitionError(ValueError):
    pass


@dataclass(frozen=True)
class Rule:
    """One target's mapping."""

    target: str
    sources: tuple[str, ...]
    type: str | None = None
    join: str | None = None
    map: dict[str, Any] | None = None
    default: Any = None
    required: bool = False
    format: str | None = None
    tz: str = "UTC"


@dataclass(frozen=True)
class Definition:
    name: str
    version: str
    priority: int
    detect: dict
    engine: str
    options: dict
    envelope: str
    class_uid: int
    category_uid: int
    activity: Any
    constants: dict[str, Any]
    rules: tuple[Rule, ...]
    unmapped: Any = "keep_all"
    on_failure: str = "dead_letter"
    enabled: bool = True
    extra: dict = field(default_factory=dict)


def _known(given: dict, names: set[str], where: str) -> None:
    if unknown := set(given) - names:
        raise DefinitionError(f"{where}: unknown {sorted(unknown)}")


def _check_detect(d: dict, where: str) -> None:
    if not isinstance(d, dict) or len(d) != 1 or next(iter(d)) not in DETECTORS:
        raise DefinitionError(f"{where}: give exactly one of {', '.join(DETECTORS)}")
    kind, value = next(iter(d.items()))
    if kind in ("all", "any"):
        if not value:
            raise DefinitionError(f"{where}: {kind} is empty")
        for x in value:
            _check_detect(x, where)
    if kind == "regex":
        try:
            re.compile(value)
        except re.error as e:
            raise DefinitionError(f"{where}: {e}") from None


def read(d: dict) -> Definition:
    """A checked definition."""
    name = d.get("name", "")
    if not re.fullmatch(r"[a-z0-9][a-z0-9_]*", name):
        raise DefinitionError(f"{name!r} is not a name of lower-case letters, digits and _")
    _known(d, {"name", "version", "vendor", "product", "product_version", "priority", "enabled", "detect", "parse", "normalize", "validate"}, name)
    _check_detect(d["detect"], name)
    parse, norm, valid = d["parse"], d["normalize"], d.get("validate", {})
    _known(parse, {"envelope", "engine", "options"}, name)
    _known(norm, {"class_uid", "category_uid", "activity_id", "constants", "fields", "unmapped"}, name)
    options = parse.get("options") or {}
    if parse["engine"] not in ENGINES:
        raise DefinitionError(f"{name}: unknown engine {parse['engine']}")
    if parse["engine"] in ("grok", "dissect") and not options.get("pattern"):
        raise DefinitionError(f"{name}: {parse['engine']} needs a pattern")
    rules = []
    for target, f in norm["fields"].items():
        _known(f, {"from", "type", "join", "map", "default", "required", "format", "tz"}, f"{name}.{target}")
        sources = (f["from"],) if isinstance(f["from"], str) else tuple(f["from"])
        if f.get("join") is not None and isinstance(f["from"], str):
            raise DefinitionError(f"{name}.{target}: join needs a list of sources")
        if (f.get("format") or f.get("tz")) and f.get("type") != "timestamp":
            raise DefinitionError(f"{name}.{target}: format and tz go with timestamps")
        if f.get("type", "str") not in TYPES:
            raise DefinitionError(f"{name}.{target}: unknown type {f['type']}")
        texts = {str(k): v for k, v in f["map"].items()} if f.get("map") is not None else None
        rules.append(Rule(target, sources, f.get("type", "str"), f.get("join"), texts, f.get("default"), bool(f.get("required")), f.get("format"), f.get("tz", "UTC")))
    return Definition(name, str(d.get("version", "1.0.0")), int(d.get("priority", 100)), d["detect"], parse["engine"], options, parse.get("envelope", "none"), norm["class_uid"], norm["category_uid"], norm["activity_id"], norm.get("constants") or {}, tuple(rules), norm.get("unmapped", "keep_all"), valid.get("on_failure", "dead_letter"), d.get("enabled", True))


def load(folder: str) -> list[Definition]:
    """All definitions of a folder of YAML files; a bad one fails the load, so that a caller can keep the former ones."""
    import yaml

    found = [read(yaml.safe_load(p.read_text())) for p in sorted(Path(folder).glob("*.y*ml"))]
    names = [x.name for x in found]
    if len(set(names)) != len(names):
        raise DefinitionError("two definitions have one name")
    return found


class Registry:
    """The definitions in force, in the order of (priority, name); reload() swaps them only if all are valid."""

    def __init__(self, definitions: list[Definition], folder: str | None = None):
        self.folder, self.error = folder, None
        self.definitions = self._ordered(definitions)

    @staticmethod
    def _ordered(definitions):
        return sorted((d for d in definitions if d.enabled), key=lambda d: (d.priority, d.name))

    def reload(self) -> bool:
        try:
            self.definitions = self._ordered(load(self.folder))
            self.error = None
        except (DefinitionError, OSError, KeyError, ValueError) as e:
            self.error = e
        return self.error is None


def field_of_line(name: str, kind: str = "kind", payload: str = "payload") -> Column:
    """A field as a best-effort parse of self-describing lines gives it; kind and payload name the columns of the inner format and the message."""
    k, p = F.col(kind), F.col(payload)
    quoted = name.replace("'", "\\'")
    out = F.when(k == "json", F.coalesce(F.get_json_object(p, f"$['{quoted}']"), F.get_json_object(p, f"$.{name}")))
    for e in ("kv", "cef", "leef"):
        out = out.when(k == e, F.try_element_at(compile_engine(e)(p), F.lit(name)))
    return out


def detector(d: dict, text: Column) -> Column:
    """The rule as a predicate; absent fields are false. field_equals reads the columns kind and payload."""
    kind, v = next(iter(d.items()))
    if kind == "contains":
        return text.contains(v)
    if kind == "starts_with":
        return text.startswith(v)
    if kind == "regex":
        return text.rlike(v)
    if kind in ("all", "any"):
        return reduce(and_ if kind == "all" else or_, [detector(x, text) for x in v])
    if kind == "field_count":
        n = (F.length(text) - F.length(F.replace(text, F.lit(v["delimiter"]), F.lit("")))) / F.lit(len(v["delimiter"])) + 1
        tests = [n == v["equals"]] if "equals" in v else []
        tests += [n >= v["min"]] if "min" in v else []
        tests += [n <= v["max"]] if "max" in v else []
        return reduce(and_, tests, F.lit(True))
    return F.coalesce(field_of_line(v["name"]) == str(v["value"]), F.lit(False))


def route(text: Column, definitions: list[Definition]) -> Column:
    """Name of the first definition whose rule fits, else unknown."""
    out = F
    for d in definitions:
        out = out.when(detector(d.detect, text), d.name)
    return out.otherwise("unknown") if definitions else F.lit("unknown")
