"""Expressions whose matching may take very long, and matching within a time limit.

The JVM's matcher can't be stopped. An expression without nested repetition takes at most a low power of a line's length
there; one that has it goes to Python workers in Arrow batches, where the matcher gives up at its limit.
"""

from __future__ import annotations

from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unlimited wildcards of an expression that the JVM may match: a line of n characters takes at most n to that power.
WILDCARDS = 4
TIMEOUT, NO_MATCH = "grok_timeout", "grok_no_match"
MATCH = "struct<groups: array<string>, reason: string>"


def _quantifier(regex: str, i: int) -> tuple[int, bool, bool]:
    """What follows an atom at i: where it ends, whether it repeats without limit, and whether it may give back."""
    unlimited = False
    if i < len(regex) and regex[i] in "*+?":
        unlimited, i = regex[i] != "?", i + 1
    elif i < len(regex) and regex[i] == "{" and (end := regex.find("}", i)) > 0 and regex[i + 1 : end].replace(",", "").isdigit():
        unlimited, i = regex[i + 1 : end].endswith(","), end + 1
    else:
        return i, False, False
    possessive = i < len(regex) and regex[i] == "+"
    return i + (i < len(regex) and regex[i] in "+?"), unlimited, not possessive


def risky(regex: str) -> bool:
    """Whether an expression repeats a part that itself repeats or has alternatives, and may give either back, or has many wildcards."""
    i, groups, wildcards = 0, [[False, False]], 0  # of each open group: whether it holds such a part, whether it is atomic
    while i < len(regex):
        c, wild, inner = regex[i], False, False
        if c == "\\":
            i += 2
        elif c == "[":
            i += 1 + (regex[i + 1 : i + 2] == "^")
            i += regex[i : i + 1] == "]"
            while i < len(regex) and regex[i] != "]":
                i += 2 if regex[i] == "\\" else 1
            i += 1
        elif c == "(":
            groups.append([False, regex.startswith("(?>", i)])
            if regex.startswith("(?", i):
                i += 2
                while i < len(regex) and regex[i] not in ":>=!)":
                    i += 1
                if i < len(regex) and regex[i] == ")":  # only flags
                    groups.pop()
            i += 1
            continue
        elif c == "|":
            groups[-1][0] = True
            i += 1
            continue
        elif c == ")":
            holds, atomic = groups.pop() if len(groups) > 1 else (False, False)
            inner = holds and not atomic
            i += 1
        else:
            wild, i = c == ".", i + 1
        i, unlimited, gives = _quantifier(regex, i)
        if unlimited and gives:
            if inner:
                return True
            wildcards += wild
            groups[-1][0] = True
        elif inner and not (unlimited and not gives):
            groups[-1][0] = True
    return wildcards > WILDCARDS


@cache
def _compiled(expression: str):
    import regex

    return regex.compile(expression, regex.ASCII)


def timed_match(text: Column, expression: str, timeout_ms: int) -> Column:
    """MATCH of the first match in a text: its groups, or why there is none. A null text gives null."""

    @F.arrow_udf(MATCH)
    def match(texts: pa.Array) -> pa.Array:
        out, search = [], _compiled(expression).search
        for t in texts.to_pylist():
            if t is None:
                out.append(None)
                continue
            try:
                found = search(t, timeout=timeout_ms / 1000)
                out.append({"groups": None if found is None else list(found.groups("")), "reason": NO_MATCH if found is None else None})
            except TimeoutError:
                out.append({"groups": None, "reason": TIMEOUT})
        return pa.array(out, pa.struct([("groups", pa.list_(pa.string())), ("reason", pa.string())]))

    return match(text)
