"""Leaves of deeply nested JSON, in time that grows with a text's length only.

A variant's children are copies of all that lies below them, so opening level after level costs the square of the depth.
Here Arrow batches of texts go to Python workers, which walk each text once; what a valid text is stays for Spark to say.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LEAVES = "array<struct<k: string, t: string>>"
_TYPE = pa.list_(pa.struct([("k", pa.string()), ("t", pa.string())]))
_WORDS = {True: "true", False: "false", None: "null"}
_quoted = json.JSONEncoder().encode


class _Number(str):
    """A number as it was written."""

    __slots__ = ()


_read = json.JSONDecoder(parse_int=_Number, parse_float=_Number, parse_constant=_Number).raw_decode


def walked(text: str, sep: str) -> list[tuple[str, str]] | None:
    """(dotted path, JSON text) of each leaf of an object, keys in order; None for other values. What follows the value isn't read, as in Spark."""
    root = _read(text.lstrip(" \t\r\n"))[0]
    if type(root) is not dict:
        return None
    found, left = [], [("", root)] if root else []  # a path ends with sep until its leaf is found
    while left:
        at, x = left.pop()
        run = []
        while type(x) is dict and len(x) == 1:
            ((k, x),) = x.items()
            run.append(k)
        if run:
            at += sep.join(run) + sep
        kind = type(x)
        if kind is dict and x:
            left += [(f"{at}{k}{sep}", x[k]) for k in sorted(x, reverse=True)]
        elif kind is list and x:
            left += [(f"{at}{i}{sep}", x[i]) for i in range(len(x) - 1, -1, -1)]
        else:
            found.append((at[: len(at) - len(sep)], x if kind is _Number else _quoted(x) if kind is str else "{}" if kind is dict else "[]" if kind is list else _WORDS[x]))
    return found


def _strings(texts: list[str]) -> pa.Array:
    try:
        return pa.array(texts, pa.string())
    except UnicodeEncodeError:  # half a surrogate pair
        return pa.array([t.encode("utf-8", "replace") for t in texts], pa.binary()).cast(pa.string())


def walk(text: Column, sep: str, room: int = 1 << 26) -> Column:
    """LEAVES of a text; null for no text, no object, one that Python can't read, and once a batch's leaves have room characters: paths may be far longer than texts."""

    @F.arrow_udf(LEAVES)
    def walk_json(texts: pa.Array) -> pa.Array:
        ends, keys, values, none, left = [0], [], [], [], room
        for text in texts.to_pylist():
            try:
                found = None if text is None or left <= 0 else walked(text, sep)
            except (ValueError, RecursionError):
                found = None
            none.append(found is None)
            if found:
                k, v = zip(*found)
                keys += k
                values += v
                left -= sum(map(len, k)) + sum(map(len, v))
            ends.append(len(keys))
        entries = pa.StructArray.from_arrays([_strings(keys), _strings(values)], fields=list(_TYPE.value_type))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries, type=_TYPE, mask=pa.array(none, pa.bool_()))

    return walk_json(text)
