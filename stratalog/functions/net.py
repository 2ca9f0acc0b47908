"""IP addresses as sortable keys: "4" and 8 hex digits, or "6" and 32, so that prefixes and ranges are string operations."""

from __future__ import annotations

import ipaddress
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
V4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
#: Compiled look-ups hold so many networks; larger tables are joined.
MAX_COMPILED = 512

#: Ranges of the address kinds (fixed values, from the IANA registries). Documentation ranges count as public here.
PRIVATE = ("0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/29", "192.0.0.170/31", "192.168.0.0/16", "198.18.0.0/15", "240.0.0.0/4", "255.255.255.255/32", "::/128", "::1/128", "::ffff:0:0/96", "100::/64", "fc00::/7", "fe80::/10")
DOCUMENTATION = ("192.0.2.0/24", "198.51.100.0/24", "203.0.113.0/24", "2001:db8::/32")
SHARED = ("100.64.0.0/10",)
LOOPBACK = ("127.0.0.0/8", "::1/128")
MULTICAST = ("224.0.0.0/4", "ff00::/8")
RESERVED = ("240.0.0.0/4", "::/8", "100::/8", "200::/7", "400::/6", "800::/5", "1000::/4", "4000::/3", "6000::/3", "8000::/3", "a000::/3", "c000::/3", "e000::/4", "f000::/5", "f800::/6", "fe00::/9")


def let(value: Column, of) -> Column:
    """of(value), with value evaluated, and written into the plan, once."""
    return F.transform(F.array(value), of)[0]


def apart(c: Column) -> Column:
    """c, in a projection that Spark's code generator doesn't fuse with others: fused, those of many rules make methods beyond the size that the JVM compiles."""
    return let(c, lambda x: x)


def _groups(text: Column) -> Column:
    """The eight groups of an IPv6 text, unpadded; null if it isn't one."""
    # a dotted tail stands for two groups
    octet = lambda tail, i: F.split(tail, "\\.")[i].cast("int")
    pair = lambda tail, i: F.lower(F.hex((octet(tail, i) * 256 + octet(tail, i + 1)).cast("bigint")))
    plain = lambda low: let(F.regexp_extract(low, r":(\d{1,3}(?:\.\d{1,3}){3})$", 1), lambda tail: F.when(tail.rlike(V4), F.concat(F.regexp_replace(low, r"\d{1,3}(\.\d{1,3}){3}$", ""), pair(tail, 0), F.lit(":"), pair(tail, 2))).otherwise(low))
    cut = lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, ":", -1))
    ends = lambda halves: F.struct(F.size(halves).alias("n"), cut(halves[0]).alias("head"), cut(F.coalesce(F.try_element_at(halves, F.lit(2)), F.lit(""))).alias("rear"))

    def whole(e: Column) -> Column:
        missing = 8 - F.size(e["head"]) - F.size(e["rear"])
        return F.when(e["n"] == 1, e["head"]).when((e["n"] == 2) & (missing >= 1), F.concat(e["head"], F.array_repeat(F.lit("0"), missing), e["rear"]))

    good = lambda full: F.when((F.size(full) == 8) & F.forall(full, lambda g: g.rlike("^[0-9a-f]{1,4}$")), F.transform(full, lambda g: F.regexp_replace(g, "^0+(?=.)", "")))
    return let(let(let(plain(F.lower(text)), lambda low: F.split(low, "::", -1)), lambda h: let(ends(h), whole)), good)


def ip_key(text: Column) -> Column:
    """The sortable key of an address; null if it isn't one."""
    t = F.trim(text)
    parts = F.split(t, "\\.")
    number = reduce(lambda n, i: n * 256 + parts[i].cast("bigint"), (1, 2, 3), parts[0].cast("bigint"))
    v6 = lambda t: F.concat(F.lit("6"), F.array_join(F.transform(_groups(t), lambda g: F.lpad(g, 4, "0")), ""))
    return F.when(t.rlike(V4), F.concat(F.lit("4"), F.lpad(F.lower(F.hex(number)), 8, "0"))).when(t.contains(":"), let(t, v6))


def canonical_ip(text: Column) -> Column:
    """The usual short form of an address; null if it isn't one."""

    def short(joined: Column) -> Column:
        out = F  # the longest run of zeros, of equals the first, gives way to ::
        for n in range(8, 1, -1):
            out = out.when(joined.rlike(rf"(^|:)0(:0){{{n - 1}}}(:|$)"), F.regexp_replace(joined, rf"^(.*?)(^|:)0(?::0){{{n - 1}}}(?::|$)", "$1::"))
        return out.otherwise(joined)

    t = F.trim(text)
    return F.when(t.rlike(V4), t).when(t.contains(":"), let(F.array_join(_groups(t), ":"), short))


@dataclass(frozen=True)
class Network:
    length: int
    low: str
    high: str


def network(cidr: str) -> Network:
    n = ipaddress.ip_network(cidr, strict=False)
    key = lambda a: f"{n.version}{int(a):0{8 if n.version == 4 else 32}x}"
    return Network(n.prefixlen, key(n.network_address), key(n.broadcast_address))


def _between(k: Column, cidrs: tuple[str, ...]) -> Column:
    return reduce(or_, (k.between(n.low, n.high) for n in map(network, cidrs)))


def within(key: Column, cidrs: tuple[str, ...]) -> Column:
    return let(key, lambda k: _between(k, cidrs))


def key_flags(key: Column) -> dict[str, Column]:
    """version and the kinds of an address, null for none; key: a column or bound value, as it is written many times."""
    private = _between(key, PRIVATE) & ~_between(key, DOCUMENTATION)
    return {
        "ip_version": F.substring(key, 1, 1).cast("int"), "is_private": private, "is_loopback": _between(key, LOOPBACK), "is_multicast": _between(key, MULTICAST),
        "is_reserved": _between(key, RESERVED), "is_global": ~private & ~_between(key, SHARED),
    }


def flags(key: Column) -> dict[str, Column]:
    """key_flags of any expression."""
    one = lambda n: let(key, lambda k: key_flags(k)[n])
    return {n: one(n) for n in key_flags(key)}


def lpm(key: Column, networks: dict[str, Column]) -> Column:
    """The value of the longest network that holds the key, as one compiled expression over a small table; key: as for key_flags."""
    if len(networks) > MAX_COMPILED:
        raise ValueError(f"{len(networks)} networks; join them with lpm_join")
    ordered = sorted(((network(c), v) for c, v in networks.items()), key=lambda x: -x[0].length)
    out = F
    for n, v in ordered:
        out = out.when(key.between(n.low, n.high), v)
    return out if ordered else F.lit(None)


def masked(key: Column, length: Column) -> Column:
    """The address family and the first length bits of a key, as text."""
    bits = F.array_join(F.transform(F.split(F.substring(key, 2, 32), ""), lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), "")
    return F.concat(F.substring(key, 1, 1), F.substring(bits, 1, length))


def lpm_join(rows: DataFrame, key: str, networks: DataFrame, value: str) -> DataFrame:
    """rows with value of the longest network (cidr, value) that holds the key: an equi join on (length, masked key).

    For tables of any size. Only the distinct prefix lengths, at most 162, are known to the driver; each distinct key
    is looked up once, however often it occurs.
    """
    bits = F.split("cidr", "/")
    own = networks.withColumn("__k", ip_key(bits[0])).withColumn("__n", F.coalesce(F.try_element_at(bits, F.lit(2)).cast("int"), F.when(F.col("__k").startswith("4"), 32).otherwise(128)))
    lengths = sorted(((r.v, r.n) for r in own.where("__k is not null").select(F.substring("__k", 1, 1).alias("v"), F.col("__n").alias("n")).distinct().collect()), reverse=True)
    table = own.where("__k is not null").select(masked(F.col("__k"), F.col("__n")).alias("__m"), F.col("__n"), F.col(value).alias("__v")).groupBy("__m", "__n").agg(F.max("__v").alias("__v"))
    if not lengths:
        return rows.withColumn(value, F.lit(None).cast(networks.schema[value].dataType))
    keys = rows.select(F.col(key).alias("__key")).where("__key is not null").distinct()
    tries = F.array(*(F.struct(F.lit(n).alias("n"), F.lit(v).alias("v")) for v, n in lengths))
    each = keys.withColumn("t", F.explode(tries)).where(F.substring("__key", 1, 1) == F.col("t.v")).select("__key", F.col("t.n").alias("__n"), masked(F.col("__key"), F.col("t.n")).alias("__m"))
    best = each.join(table, ["__m", "__n"]).groupBy("__key").agg(F.max_by("__v", "__n").alias(value))
    # rows without an address never enter the join, where they would all meet in one task
    found = rows.where(F.col(key).isNotNull()).join(best, F.col(key) == F.col("__key"), "left").drop("__key")
    return found.unionByName(rows.where(F.col(key).isNull()).withColumn(value, F.lit(None).cast(networks.schema[value].dataType)))
