"""URL filters: pattern rules found by their rarest literal token.

A rule is a regular expression with the literal tokens that any URL it fits must hold. Each rule is filed under the one
of its tokens that the fewest rules share; a URL's own tokens fetch the rules filed under them, and only those run their
expressions. The index is as large as the rule list, not as the data, and is checked against a bound before it goes to
the workers with the code; URLs stream through a map and nothing is shuffled.

Verdicts: of the host rules that fit, the longest decides. Where none fits, the method's own pattern rules decide: the
first of them that fits blocks; else the URL is allowed.

Defined results: a null URL or one without "://" has an empty host and path; no rule fits it and it is allowed, unless
a pattern rule fits the text itself. Each row gives a row; a null page_id stays null.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules that one worker holds: an index of so many takes some hundred MB.
MAX_RULES = 200_000

#: The query's host rules (fixed values).
HOST_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: The method's own rules (fixed values): hosts that name themselves junk.
PATTERN_RULES = (
    (r"://([^/?#]*\.)?spam-[a-z0-9-]+\.", ("spam",)),
    (r"://([^/?#]*\.)?adserver\.", ("adserver",)),
    (r"/wp-login\.php([?#]|$)", ("wp", "login", "php")),
    (r"[?&]sessionid=", ("sessionid",)),
)

_TOKEN = re.compile(r"[a-z0-9]+")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)


@dataclass(frozen=True)
class Rule:
    pattern: re.Pattern
    tokens: tuple[str, ...]
    name: str | None
    verdict: str
    order: int


def parts(url: str | None) -> tuple[str, str]:
    """Host, lower-cased in A-Z, and path."""
    m = _URL.search(url) if url else None
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


def host_rule(name: str, verdict: str, order: int = 0) -> Rule:
    """example.net/en/ as an expression over host + path: the host or a subdomain, and a path that begins so."""
    host, slash, path = name.partition("/")
    host = host.translate(_UPPER)
    # only tokens bounded within the rule itself must be whole tokens of a URL
    bounded = _TOKEN.findall(host) + _TOKEN.findall((slash + path).lower())[: -1 if path[-1:].isalnum() else None]
    return Rule(re.compile(r"(?:[^/?#]*\.)?" + re.escape(host + slash + path), re.S), tuple(bounded), name, verdict, order)


class RuleIndex:
    """Rules by their rarest literal token; those without one are tried on each URL."""

    def __init__(self, rules: Iterable[Rule]):
        rules = list(rules)
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; a worker holds {MAX_RULES}. Split the list by host and chain the results.")
        seen = Counter(t for r in rules for t in set(r.tokens))
        self.by_token: dict[str, list[Rule]] = {}
        self.always: list[Rule] = []
        for r in rules:
            rarest = min(r.tokens, key=lambda t: (seen[t], -len(t), t), default=None)
            (self.always if rarest is None else self.by_token.setdefault(rarest, [])).append(r)

    def candidates(self, url: str) -> list[Rule]:
        found = list(self.always)
        for t in dict.fromkeys(_TOKEN.findall(url.translate(_UPPER))):
            found += self.by_token.get(t, ())
        return found


def judge(url: str | None, index: RuleIndex) -> tuple[str, str, str | None, str]:
    host, path = parts(url)
    fits, own = None, None
    for r in index.candidates(url or ""):
        if r.name is not None:
            if host and r.pattern.match(host + path) and (fits is None or (len(r.name), r.name) > (len(fits.name), fits.name)):
                fits = r
        elif r.pattern.search((url or "").translate(_UPPER)) and (own is None or r.order < own.order):
            own = r
    r = fits or own
    return host, path, fits.name if fits else None, r.verdict if r else "allow"


def default_index() -> RuleIndex:
    return RuleIndex([*(host_rule(n, v, i) for i, (n, v) in enumerate(HOST_RULES)), *(Rule(re.compile(p), t, None, "block", i) for i, (p, t) in enumerate(PATTERN_RULES))])


def filter_urls(pages: DataFrame, index: RuleIndex | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of each row of pages (page_id, url)."""
    index = index or default_index()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge(u, index) for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *(pa.array([r[i] for r in rows], pa.string()) for i in range(4))], ["page_id", "host", "path", "rule", "verdict"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")


ORACLE = r"""
WITH u AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule, rh, rp, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow'))
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
  (SELECT max_by(rule, length(rule)) FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule,
  coalesce((SELECT max_by(v, length(rule)) FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
    CASE WHEN regexp_matches(lower(url), '://([^/?#]*\.)?spam-[a-z0-9-]+\.|://([^/?#]*\.)?adserver\.|/wp-login\.php([?#]|$)|[?&]sessionid=')
      THEN 'block' ELSE 'allow' END) AS verdict
FROM h
"""
