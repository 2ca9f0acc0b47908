"""Enrichment: network context, indicators, technique tags. Small tables compile into expressions; larger ones join."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.functions.net import apart, ip_key, key_flags, let, lpm, lpm_join, masked
from stratalog.operators.normalize import leaf_paths

#: Zones, rules and techniques shipped with the library (fixed values).
ZONES = (
    ("10.0.0.0/8", "corp", "medium"), ("10.10.0.0/16", "corp-servers", "high"), ("10.10.20.0/24", "crown-jewels", "critical"), ("172.16.0.0/12", "lab", "low"), ("192.168.1.0/24", "dmz", "high"),
    ("192.168.100.0/24", "management", "critical"), ("203.0.113.0/24", "edge-nat-pool", "medium"), ("fd00:1234::/32", "corp-v6", "medium"), ("2001:db8:aa::/48", "dmz-v6", "high"),
)
INDICATORS = ("192.0.2.66", "192.0.2.123", "198.51.100.23", "203.0.113.99", "2001:db8:dead:beef::1")
TECHNIQUES = {"T1046": ("Network Service Discovery", ("discovery",)), "T1110": ("Brute Force", ("credential-access",)), "T1571": ("Non-Standard Port", ("command-and-control",)), "T1048": ("Exfiltration Over Alternative Protocol", ("exfiltration",)), "T1190": ("Exploit Public-Facing Application", ("initial-access",))}
KILL_CHAIN = ("reconnaissance", "resource-development", "initial-access", "execution", "persistence", "privilege-escalation", "defense-evasion", "credential-access", "discovery", "lateral-movement", "collection", "command-and-control", "exfiltration", "impact")


@dataclass(frozen=True)
class TechniqueRule:
    id: str
    techniques: tuple[str, ...]
    tactics: tuple[str, ...] = ()
    class_uid: int | None = None
    actions: tuple[str, ...] = ()
    dst_ports: tuple[int, ...] = ()
    dst_port_min: int | None = None
    dst_port_max: int | None = None
    min_bytes_out: int | None = None
    direction: str | None = None
    categories: tuple[str, ...] = ()
    signature_contains: tuple[str, ...] = ()


RULES = (
    TechniqueRule("scan-suricata-signature", ("T1046",), signature_contains=("scan", "sweep", "nmap", "portscan", "masscan", "port scan")),
    TechniqueRule("scan-suricata-category", ("T1046",), categories=("Attempted Information Leak", "Detection of a Network Scan", "Potentially Bad Traffic")),
    TechniqueRule("bruteforce-ssh-rdp-denied", ("T1110",), class_uid=4001, actions=("Denied",), dst_ports=(22, 3389)),
    TechniqueRule("bruteforce-suricata-signature", ("T1110",), signature_contains=("brute force", "bruteforce", "login attempt", "password guess", "hydra", "credential stuffing")),
    TechniqueRule("c2-known-bad-ports", ("T1571",), class_uid=4001, actions=("Allowed",), dst_ports=(1080, 4444, 5555, 6666, 6667, 8081, 9001, 12345, 31337, 65535)),
    TechniqueRule("c2-suricata-signature", ("T1571",), ("command-and-control",), signature_contains=("command and control", "cobalt strike", "beacon", "trojan", "covenant", "sliver c2")),
    TechniqueRule("exfil-large-outbound-transfer", ("T1048",), class_uid=4001, min_bytes_out=50_000_000),
    TechniqueRule("exfil-large-outbound-confirmed-direction", ("T1048",), class_uid=4001, direction="Outbound", min_bytes_out=10_000_000),
    TechniqueRule("exploit-suricata-categories", ("T1190",), categories=("Web Application Attack", "Attempted Administrator Privilege Gain", "Attempted User Privilege Gain", "Successful Administrator Privilege Gain", "A Network Trojan was detected")),
    TechniqueRule("exploit-suricata-signature", ("T1190",), signature_contains=("exploit", "cve-", "sql injection", "remote code execution", "shellcode", "directory traversal", "deserialization", "arbitrary file")),
)


def key_context(key: Column, zones=ZONES) -> Column:
    """network_context of an address's key, a column or a bound value."""
    found = lpm(key, {c: F.struct(F.lit(z).alias("zone"), F.lit(x).alias("criticality")) for c, z, x in zones})
    kinds = key_flags(key)
    return F.when(key.isNotNull(), F.struct(*(c.alias(n) for n, c in kinds.items()), found["zone"].alias("zone"), found["criticality"].alias("criticality")))


def network_context(ip: Column, zones=ZONES) -> Column:
    """Struct of an address's kinds, zone and criticality; null if it isn't one."""
    return let(ip_key(ip), lambda key: key_context(key, zones))


def keyed_contexts(rows: DataFrame, zones=ZONES, record: str = "ocsf") -> Column:
    """Map of the context of every address that a record holds: by path of its ip attributes, and by key of its unmapped entries."""
    paths = [p for p in leaf_paths(rows.schema[record].dataType) if p.split(".")[-1] == "ip"]
    struct = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    # one look-up for all of them, whatever their number
    own = F.array(*(struct(F.lit(p), F.col(f"{record}.{p}")) for p in paths))
    rest = F.transform(F.map_entries(F.coalesce("unmapped", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))), lambda e: struct(F.concat(F.lit("unmapped."), e["key"]), e["value"]))
    found = F.transform(F.filter(F.concat(own, rest), lambda e: e["value"].isNotNull()), lambda e: F.struct(e["key"].alias("key"), network_context(e["value"], zones).alias("value")))
    return F.map_from_entries(F.filter(found, lambda e: e["value"].isNotNull()))


#: Names of attributes that hold hosts, and digests of files.
HOSTS, HASHES = ("hostname", "domain"), ("hash", "md5", "sha1", "sha256")


def indicator_candidates(rows: DataFrame, record: str = "ocsf") -> list[tuple[str, str, Column]]:
    """All of a record's attributes that indicators may name, in the order in which hits count: source, destination, other addresses, hosts, digests."""
    first = ("src_endpoint.ip", "dst_endpoint.ip", "query.hostname")
    paths = leaf_paths(rows.schema[record].dataType)
    kind = lambda p: next((k for k, names in (("ip", ("ip",)), ("domain", HOSTS), ("hash", HASHES)) if p.split(".")[-1] in names), None)
    some = [p for k in ("ip", "domain", "hash") for p in sorted(paths, key=lambda p: (first.index(p) if p in first else len(first), p)) if kind(p) == k]
    return [(p, kind(p), F.col(f"{record}.{p}").cast("string")) for p in some]


def way(a: Column, b: Column) -> Column:
    """The direction by whether source and destination are private."""
    return F.when(a & b, "internal").when(a & ~b, "outbound").when(~a & b, "inbound").when(~a & ~b, "transit")


def direction(src: Column, dst: Column) -> Column:
    """outbound, inbound, internal or transit, by which end is private."""
    private = lambda ip: let(ip_key(ip), lambda k: key_flags(k)["is_private"])
    return let(F.struct(private(src).alias("a"), private(dst).alias("b")), lambda p: way(p["a"], p["b"]))


def domain_suffixes(host: Column) -> Column:
    """The host and its parents, never a bare top level unless that is all; lower case, without a trailing dot."""
    labels = F.split(F.regexp_replace(F.lower(F.trim(host)), r"\.$", ""), r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.array_join(F.slice(labels, i + 1, n), "."))


def indicator_hits(rows: DataFrame, candidates: list[tuple[str, str, Column]], indicators: DataFrame) -> DataFrame:
    """rows with ioc: the first hit among candidates (matched_on, type, value), in their order.

    indicators: (type, indicator, source, confidence); types ip (addresses and networks), domain, hash. Each distinct
    candidate value is looked up once by an equi join, which Spark broadcasts where the list is small; networks are looked
    up by the prefixes of the lengths that the list has, at most 160, an address before the networks and longer ones first.
    """
    bits = F.split("indicator", "/")
    network = (F.col("type") == "ip") & F.col("indicator").contains("/")
    length = F.try_element_at(bits, F.lit(2)).try_cast("int")
    lengths = sorted((r.n for r in indicators.where(network).select(length.alias("n")).distinct().collect() if r.n is not None), reverse=True)
    prefix = lambda k, n: F.concat(masked(k, n), F.lit("/"), n.cast("string"))
    key = {"ip": lambda v: F.array(ip_key(v), *(prefix(ip_key(v), F.lit(n)) for n in lengths)), "domain": domain_suffixes, "hash": lambda v: F.array(F.lower(v))}
    norm = F.when(network, prefix(ip_key(bits[0]), length)).when(F.col("type") == "ip", ip_key(F.col("indicator"))).when(F.col("type") == "domain", F.regexp_replace(F.lower("indicator"), r"\.$", "")).otherwise(F.lower("indicator"))
    table = indicators.select(F.col("type").alias("__t"), norm.alias("__k"), F.struct("indicator", F.col("type").alias("ioc_type"), F.col("source").alias("ioc_source"), "confidence").alias("__hit")).where("__k is not null").groupBy("__t", "__k").agg(F.min("__hit").alias("__hit"))
    values = F.struct(*(v.cast("string").alias(f"v{i}") for i, (_, _, v) in enumerate(candidates)))
    # rows without any value find nothing; they are spread by what they are, so that they don't meet under one key
    own = F.col("event_uid") if "event_uid" in rows.columns else F.to_json(F.struct(*rows.columns))
    spread = F.concat(F.lit("none-"), F.pmod(F.xxhash64(own), F.lit(4096)).cast("string"))
    numbered = rows.withColumn("__row", F.when(reduce(or_, (v.isNotNull() for _, _, v in candidates)), F.to_json(values)).otherwise(spread))

    def attempts(i: int, matched_on: str, kind: str, value: Column) -> Column:
        return F.transform(key[kind](value), lambda k, j: F.struct((F.lit(1000 * i) + j).alias("order"), F.lit(kind).alias("t"), k.alias("k"), F.lit(matched_on).alias("matched_on")))

    # each combination of values is expanded once, after they are made distinct
    tries = [attempts(i, matched_on, kind, F.col(f"v{i}")) for i, (matched_on, kind, _) in enumerate(candidates)]
    distinct = numbered.where(reduce(or_, (v.isNotNull() for _, _, v in candidates))).select("__row", *(v.cast("string").alias(f"v{i}") for i, (_, _, v) in enumerate(candidates))).distinct()
    distinct = distinct.select("__row", F.filter(F.concat(*(F.coalesce(x, F.array().cast("array<struct<order:int,t:string,k:string,matched_on:string>>")) for x in tries)), lambda x: x["k"].isNotNull()).alias("__tries"))
    best = distinct.select("__row", F.explode_outer("__tries").alias("x")).join(table, (F.col("x.t") == F.col("__t")) & (F.col("x.k") == F.col("__k"))).groupBy("__row").agg(F.min(F.struct("x.order", "x.matched_on", "__hit")).alias("b"))
    hit = F.when(F.col("b").isNotNull(), F.struct(F.lit(True).alias("matched"), F.col("b.__hit.indicator").alias("indicator"), F.col("b.__hit.ioc_type").alias("ioc_type"), F.col("b.__hit.ioc_source").alias("ioc_source"), F.col("b.__hit.confidence").alias("confidence"), F.col("b.matched_on").alias("matched_on")))
    return numbered.join(best, "__row", "left").withColumn("ioc", hit).drop("__row", "b")


def located(rows: DataFrame, ip: str, networks: DataFrame, name: str = "location") -> DataFrame:
    """rows with a struct of what the longest network of networks (cidr and more: country, city, asn, ...) says of the address; null without one."""
    more = [c for c in networks.columns if c != "cidr"]
    found = lpm_join(rows.withColumn("__ip", ip_key(F.col(ip))), "__ip", networks.select("cidr", F.struct(*more).alias(name)), name)
    return found.drop("__ip")


def technique_hit(rule: TechniqueRule, at) -> Column:
    """The rule's conditions, all of them; at(path) gives a record's column."""
    signature = F.lower(at("finding_info.title"))
    tests = [at("class_uid") == rule.class_uid] if rule.class_uid else []
    tests += [at("action").isin(*rule.actions)] if rule.actions else []
    tests += [at("dst_endpoint.port").isin(*rule.dst_ports)] if rule.dst_ports else []
    tests += [at("dst_endpoint.port") >= rule.dst_port_min] if rule.dst_port_min is not None else []
    tests += [at("dst_endpoint.port") <= rule.dst_port_max] if rule.dst_port_max is not None else []
    tests += [at("traffic.bytes_out") >= rule.min_bytes_out] if rule.min_bytes_out is not None else []
    tests += [at("connection_info.direction") == rule.direction] if rule.direction else []
    tests += [F.lower(at("finding_info.types")).isin(*(c.lower() for c in rule.categories))] if rule.categories else []
    tests += [reduce(lambda a, b: a | b, (signature.contains(s.strip().lower()) for s in rule.signature_contains))] if rule.signature_contains else []
    return F.coalesce(reduce(and_, tests), F.lit(False))


def techniques(at, rules=RULES) -> Column:
    """Struct of sorted technique ids, their names, tactics in kill-chain order and rule ids; null if no rule fits."""
    hits = [(r, technique_hit(r, at)) for r in rules]
    ids = F.array_sort(F.array_distinct(F.flatten(F.array(*(F.when(h, F.array(*map(F.lit, r.techniques))).otherwise(F.array().cast("array<string>")) for r, h in hits)))))
    tactics_of = lambda r: r.tactics or tuple(t for x in r.techniques for t in TECHNIQUES.get(x, ("", ()))[1])
    tactics = F.array_distinct(F.flatten(F.array(*(F.when(h, F.array(*map(F.lit, tactics_of(r)))).otherwise(F.array().cast("array<string>")) for r, h in hits))))
    names = F.transform(ids, lambda i: F.coalesce(*(F.when(i == k, n) for k, (n, _) in TECHNIQUES.items()), i))
    return F.when(F.size(ids) > 0, F.struct(ids.alias("technique_ids"), names.alias("technique_names"), F.filter(F.array(*map(F.lit, KILL_CHAIN)), lambda t: F.array_contains(tactics, t)).alias("tactics"), F.array_compact(F.array(*(F.when(h, r.id) for r, h in hits))).alias("rules")))


def enriched(rows: DataFrame, indicators: DataFrame | None = None, zones=ZONES, rules=RULES) -> DataFrame:
    """rows with enrichment, and the direction promoted into the record where it has none. All parts see the record as it was."""
    at = lambda p: F.col(f"ocsf.{p}")
    # the keys and what is private are columns, as many parts refer to them
    own = rows.columns
    rows = rows.select("*", apart(ip_key(at("src_endpoint.ip"))).alias("__src"), ip_key(at("dst_endpoint.ip")).alias("__dst"))
    rows = rows.select("*", key_context(F.col("__src"), zones).alias("__from"), apart(key_context(F.col("__dst"), zones)).alias("__to"))
    a, b = F.col("__from.is_private"), F.col("__to.is_private")
    parts = [F.col("__from").alias("src"), F.col("__to").alias("dst"), way(a, b).alias("direction"), techniques(at, rules).alias("attack")]
    out = rows.select(*(F.col(c) for c in own), F.struct(*parts).alias("enrichment"))
    if indicators is not None:
        out = indicator_hits(out, indicator_candidates(out), indicators)
    got = F.col("enrichment.direction")
    unset = F.coalesce(at("connection_info.direction").isin("", "Unknown"), F.lit(True)) & got.isin("inbound", "outbound")
    info = F.col("ocsf.connection_info").withField("direction", F.when(unset, F.initcap(got)).otherwise(at("connection_info.direction"))).withField("direction_id", F.when(unset, F.when(got == "inbound", 1).otherwise(2).cast("bigint")).otherwise(at("connection_info.direction_id")))
    return out.withColumn("ocsf", F.when(F.col("ocsf").isNotNull(), F.col("ocsf").withField("connection_info", info)))
