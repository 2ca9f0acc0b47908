"""Read-only SQL by its plan, bounded matching, and forms that once parsed wrongly."""

import ipaddress
import random
import time

import pytest
import regex
from pyspark.sql import functions as F

from stratalog.operators.engines import compile_engine, expand_grok
from stratalog.operators.patience import risky
from stratalog.plans import readonly

REFUSED = (
    "select reflect('java.lang.System', 'setProperty', 'zz', 'written')",
    "select java_method('java.lang.System', 'currentTimeMillis')",
    "select 1 where try_reflect('java.lang.System', 'currentTimeMillis') is not null",
    "with a as (select ReFlect('java.lang.System', 'currentTimeMillis') as x) select * from a",
    "select (select max(reflect('java.lang.System', 'currentTimeMillis')) from known)",
    "select * from known where id in (select java_method('java.lang.Math', 'abs', 1))",
    "select transform(id) using 'cat' as (x) from known",
    "select * from parquet.`/root/testdata/sf0.001/nation.parquet`",
    "select * from text.`/etc/passwd`",
    "select * from nowhere",
    "select own_udf(id) from known",
    "select input_file_name() from known",
    "select raise_error('x')",
    "select * from read_files('/etc')",
    "select * from identifier('known')",
    "select identifier('reflect')('java.lang.System', 'currentTimeMillis')",
    "select sum(x) from (from known insert into t select id)",
    "insert into known select 1",
    "show tables",
    "set a = b",
    "explain select 1",
    "select 1; select 2",
    "cache table known",
    "describe known",
    "",
    "select spark_catalog.default.reflect('java.lang.System', 'currentTimeMillis')",
    "select explode(array(reflect('java.lang.System', 'currentTimeMillis')))",
    "select aggregate(array(1), 0L, (a, x) -> cast(java_method('java.lang.Math', 'abs', x) as bigint)) from known",
    "select * from known lateral view reflect('java.lang.System', 'currentTimeMillis') e",
)
PASSED = (
    "select id, count(*) filter (where id > 1) as n, sum(id) over () as s from known group by id having count(*) > 0 order by 2 limit 3",
    "with r as (select 1 as a union all select 2) select * from r join known on a = id left join lateral (select max(id) as z from known k where k.id = r.a) on true",
    "select 'reflect(1); drop table x' as a, replace('a', 'a', 'b') as insert_ from known -- delete",
    "with recursive r(n) as (select 1 union all select n + 1 from r where n < 5) select sum(n) from r",
    "select case when id > 1 then cast(id as string) end, array(1, 2)[0], id between 1 and 2, exists(array(1), x -> x > 0), map('a', 1)['a'], interval 1 day, extract(year from date '2020-01-01') from known lateral view explode(array(1)) e as y",
    "select * from values (1, 'a'), (2, 'b') as t(a, b) union select id, 'c' from known except select 1, 'a' intersect select 1, 'a'",
    "select id, grouping(id) from known group by cube(id)",
    "select * from known tablesample (50 percent);",
    "select * from (select id, id % 2 as k from known) pivot (sum(id) for k in (0, 1))",
    "select percentile_cont(0.5) within group (order by id), max_by(id, id), row_number() over (order by max(id)) from known group by id",
)


@pytest.fixture(scope="module")
def known(spark):
    spark.range(4).createOrReplaceTempView("known")
    spark.udf.register("own_udf", lambda x: x)
    return spark


@pytest.mark.parametrize("sql", REFUSED)
def test_what_is_not_known_to_read_is_refused(known, sql):
    with pytest.raises(readonly.ReadOnlyViolation):
        readonly.query(known, sql)
    assert known._jvm.java.lang.System.getProperty("zz") is None


@pytest.mark.parametrize("sql", PASSED)
def test_ordinary_selects_pass(known, sql):
    assert readonly.query(known, sql).collect() is not None


def test_only_the_given_tables(known):
    known.range(2).createOrReplaceTempView("secret")
    assert readonly.query(known, "with secret_too as (select 1 as id) select * from known join secret_too using (id)", tables=["known"]).count() == 1
    with pytest.raises(readonly.ReadOnlyViolation):
        readonly.query(known, "select * from known where id in (select id from secret)", tables=["known"])
    assert readonly.query(known, "select :a as a", args={"a": 5}).first().a == 5


def test_a_function_that_hides_a_built_in_one_is_refused(spark):
    other = spark.newSession()
    other.range(4).createOrReplaceTempView("known")
    assert readonly.query(other, "select sqrt(id) as x from known").count() == 4
    other.udf.register("sqrt", lambda x: x)
    with pytest.raises(readonly.ReadOnlyViolation):
        readonly.query(other, "select sqrt(id) as x from known")


def test_expressions_that_may_run_away():
    bad = ["(a+)+$", "(?:a|ab)*c", "((a|b)?c)*", "(a{2,}){3,}", "(.*)(.*)(.*)(.*)(.*)x", "%{WORD:a}(?: %{WORD:b})*"]
    good = ["(?>a+)+b", "(a+)++b", "[a+]*", "a*b*c*", "(?:x[0-9]+)?y", r"\(a+\)+", "(?i)x+", "%{IP:ip} %{TIMESTAMP_ISO8601:t} %{DATA:d} %{GREEDYDATA:g}", "%{QUOTEDSTRING:q} %{HOSTNAME:h}"]
    assert all(risky(expand_grok(p)[0]) for p in bad) and not any(risky(expand_grok(p)[0]) for p in good)


def test_a_runaway_match_ends_within_its_budget(spark):
    e = compile_engine("grok", {"pattern": "^(?:(a|aa)+)+ %{WORD:w}$", "grok_timeout_ms": 50})
    rows = spark.createDataFrame([("a" * 80 + "!",), ("aaa tail",), ("b",), (None,)], "t string").coalesce(1)
    began = time.time()
    got = {r.t: (r.m, r.w) for r in rows.select("t", e(F.col("t")).alias("m"), e.why(F.col("t")).alias("w")).collect()}
    assert time.time() - began < 20
    assert got == {"a" * 80 + "!": (None, "grok_timeout"), "aaa tail": ({"w": "tail"}, None), "b": (None, "grok_no_match"), None: (None, None)}


def test_values_may_hold_any_character(spark):
    e = compile_engine("grok", {"pattern": "^%{WORD:x} %{DATA:y} (?:%{INT:n}|%{WORD:z})$"})
    rows = spark.createDataFrame([("a b\x01c d",), ("a b 7",), ("\x01a b c",), ("no",), ("a \\1 $2 z",), ("a \n z",)], "t string")
    got = {r.t: r.m for r in rows.select("t", e(F.col("t")).alias("m")).collect()}
    assert got == {"a b\x01c d": {"x": "a", "y": "b\x01c", "z": "d"}, "a b 7": {"x": "a", "y": "b", "n": "7"}, "\x01a b c": None, "no": None, "a \\1 $2 z": {"x": "a", "y": "\\1 $2", "z": "z"}, "a \n z": None}


def test_ipv6_texts_are_taken_whole():
    find, rng = regex.compile(expand_grok("%{IPV6:x}")[0], regex.ASCII), random.Random(1)
    for _ in range(3000):
        n = rng.randrange(2**128)
        for _ in range(rng.randrange(9)):
            n &= ~(0xFFFF << (16 * rng.randrange(8)))
        a = ipaddress.IPv6Address(n)
        groups = a.exploded.split(":")
        for text in (str(a), a.exploded, ":".join(groups[:6]) + ":" + str(ipaddress.IPv4Address(n & 0xFFFFFFFF))):
            for around in ("src {} dst", "src={},", "addr:{}: x", "[{}]"):
                assert find.search(around.format(text))[0] == text
    for text in ("12:34:56", "a:b", "1:2:3:4:5:6:7", "12345::1"):
        assert find.fullmatch(text) is None
    for text, want in (("src 1:2::3:4", "1:2::3:4"), ("2001:db8::a:b:c", "2001:db8::a:b:c"), ("::", "::"), ("::ffff:1.2.3.4", "::ffff:1.2.3.4")):
        assert find.search(text)[0] == want


def test_json_of_any_depth(spark):
    deep = "1"
    for i in range(60):
        deep = f'{{"k{i}":{deep},"l{i}":[{i},{{"x":true}}]}}'
    rows = spark.createDataFrame([(deep,), ('{"a":{"b":1.5,"c":[],"d":{}},"e":[1,[2,{"f":null}]],"g":"{[x"}',), ('[{"a":1}]',), ("[1]",), ("no",), ("{}",), (None,)], "t string")
    e = compile_engine("json")
    got = {r.t: r.m for r in rows.select("t", e(F.col("t")).alias("m")).collect()}
    assert len(got[deep]) == 121 and got[deep][".".join(f"k{i}" for i in range(59, -1, -1))] == "1" and got[deep][".".join(f"k{i}" for i in range(59, 0, -1)) + ".l0.1.x"] == "true"
    assert got['{"a":{"b":1.5,"c":[],"d":{}},"e":[1,[2,{"f":null}]],"g":"{[x"}'] == {"a.b": "1.5", "a.c": "[]", "a.d": "{}", "e.0": "1", "e.1.0": "2", "e.1.1.f": None, "g": "{[x"}
    assert got['[{"a":1}]'] == {"a": "1"} and got["[1]"] is None and got["no"] is None and got["{}"] == {} and got[None] is None
