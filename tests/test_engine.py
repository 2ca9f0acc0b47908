"""The log engine: engines, time and address functions against Python, the lake, integrity, streaming."""

import hashlib
import ipaddress
import json
import os
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalog import queries
from stratalog.functions import ed25519, net, shared, times
from stratalog.functions.shared import shared_folder, spread
from stratalog.operators import decode, export, integrity, normalize, validate
from stratalog.operators.definition import DefinitionError, Registry, read
from stratalog.operators.engines import compile_engine, expand_grok, lint_grok
from stratalog.plans import builtin, jobs, lake, readonly
from stratalog.sources import readers
from stratalog.streaming import ingest



def ref():
    return F.lit("2026-11-26 00:00:00").cast("timestamp")


FORTI = '<189>date=2026-01-02 time=03:04:05 logid="1" type="traffic" level="notice" srcip=10.0.0.1 srcport=1 dstip=8.8.8.8 dstport=53 sessionid=5 proto=17 action="{}" sentbyte=5 rcvdbyte=7'


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_addresses_match_python(spark):
    texts = ["10.0.0.1", "256.1.1.1", "01.2.3.4", "::", "::1", "2001:DB8::0:0:1", "1:0:0:2:0:0:0:3", "1:2:3:4:5:6:7:8", "1::2::3", "::ffff:1.2.3.4", "fe80::", "1:2:3:4:5:6:7::", "12345::", "", "x", " 1.2.3.4 ", "0:0:0:0:0:0:0:0", "1:0:2:0:3:0:4:0"]

    def want(t):
        try:
            a = ipaddress.ip_address(t.strip())
            return str(ipaddress.IPv6Address(int(a))) if a.version == 6 else str(a)
        except ValueError:
            return None

    fix = lambda t: None if t is None else str(ipaddress.ip_address(t))
    got = column(spark, texts, net.canonical_ip)
    assert [fix(g) for g in got] == [fix(want(t)) for t in texts]
    assert got[5] == "2001:db8::1" and got[6] == "1:0:0:2::3" and got[3] == "::"


def test_times(spark):
    got = column(spark, ["1700000000", "1700000000123", "1700000000.5", "-5", "Nov 27 00:00:00", "Jan  2 03:04:05", "2026-01-02T03:04:05Z", "2026-01-02 03:04:05.25+0200", "2026-01-02", "x", "Feb 29 00:00:00"], lambda c: times.any_ns(c, ref()))
    day = 86_400 * 10**9
    assert got[:4] == [1700000000 * 10**9, 1700000000123 * 10**6, 17000000005 * 10**8, -5 * 10**9]
    assert got[4] == got[5] + 329 * day - 365 * day + (0 - 11045) * 10**9 and got[6] == got[5] and got[9] is None and got[10] is None
    assert times.java_pattern("%Y-%m-%dT%H:%M") == "yyyy-MM-dd'T'HH:mm"


@pytest.mark.parametrize(("name", "options", "text", "want"), [
    ("kv", {}, 'a=1 b="x \\"y\\" =z" bare c= a=2', {"a": "2", "b": 'x "y" =z', "c": ""}),
    ("csv", {"columns": ["a", "b"]}, 'x,"y ""q"", z",more', {"a": "x", "b": 'y "q", z', "_extra.0": "more"}),
    ("csv", {"columns": ["a", "b", "c"]}, "x,", {"a": "x", "b": None, "_truncated": "true"}),
    ("json", {}, '[{"a":{"b":[1,{"c":null}]},"d":{},"e":"{x"}]', {"a.b.0": "1", "a.b.1.c": None, "d": "{}", "e": "{x"}),
    ("json", {}, "[1,2]", None),
    ("tsv", {"columns": ["a", "b", "c"], "list_fields": ["c"]}, "-\t(empty)\tx,y", {"a": None, "b": None, "c": '["x","y"]'}),
    ("leef", {}, "LEEF:2.0|v|p|1|e|0x5E|a=1^b=c=d", {"leefVersion": "2.0", "vendor": "v", "product": "p", "productVersion": "1", "eventId": "e", "delimiter": "0x5E", "a": "1", "b": "c=d"}),
    ("leef", {}, "LEEF:3.0|v|p|1|e|a=1", None),
    ("dissect", {"pattern": "%{a->} %{b} %{+a}", "append_separator": "/"}, "x   y z", {"a": "x/z", "b": "y"}),
    ("grok", {"pattern": "%{WORD:w} (%{INT:n}|%{IP:ip})"}, "say 1.2.3.4", {"w": "say", "n": "1"}),
    ("grok", {"pattern": "^%{INT:n}$"}, "x", None),
    ("cef", {}, r"CEF:0|a\|b|c|d|e|f|9|x=1 \= 2 cs1=v cs1Label=L y=z", {"CEFVersion": "0", "deviceVendor": "a|b", "deviceProduct": "c", "deviceVersion": "d", "deviceEventClassId": "e", "name": "f", "severity": "9", "x": "1 = 2", "cs1": "v", "cs1Label": "L", "L": "v", "y": "z"}),
])
def test_engines(spark, name, options, text, want):
    assert column(spark, [text], compile_engine(name, options)) == [want]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.dictionaries(st.sampled_from("abcdef"), st.text("xyz \\\"=é", max_size=6), min_size=1), min_size=1, max_size=20))
def test_kv_round_trip(spark, rows):
    quote = lambda v: '"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"'
    lines = [" ".join(f"{k}={quote(v)}" for k, v in r.items()) for r in rows]
    assert column(spark, lines, compile_engine("kv")) == rows


def test_grok_expansion():
    assert expand_grok("%{INT:n}")[1] == ["n"] and lint_grok("(a+)+") and not lint_grok("a")
    with pytest.raises(ValueError, match="unknown"):
        expand_grok("%{NOPE:x}")
    with pytest.raises(ValueError, match="deeply"):
        expand_grok("%{A}", {"A": "%{A}"})


def test_definitions_are_checked():
    good = builtin.RAW[0]
    assert read(good).name == "suricata_eve_alert"
    for bad in ({**good, "name": "No Good"}, {**good, "color": 1}, {**good, "detect": {"regex": "("}}, {**good, "detect": {"all": []}}, {**good, "parse": {"engine": "grok"}}):
        with pytest.raises(DefinitionError):
            read(bad)


def test_registry_keeps_the_last_good(tmp_path):
    import yaml

    (tmp_path / "a.yaml").write_text(yaml.safe_dump(builtin.RAW[2]))
    r = Registry([], str(tmp_path))
    assert r.reload() and [d.name for d in r.definitions] == ["zeek_conn"]
    (tmp_path / "a.yaml").write_text("name: Bad Name\ndetect: {}\nparse: {}\nnormalize: {}")
    assert not r.reload() and [d.name for d in r.definitions] == ["zeek_conn"] and r.error


def test_every_line_is_an_event_or_a_dead_letter(spark):
    lines = [FORTI.format("accept"), FORTI.format("accept").replace("10.0.0.1", "10.0.0.x"), "nothing"]
    rows = lake.bronze(spark.createDataFrame([(str(i), bytearray(t.encode()), 0) for i, t in enumerate(lines)], "event_uid string, raw binary, ingest_time_ns long"))
    events, dead = jobs.process(rows, [d for d in builtin.definitions() if d.name == "fortigate_traffic"], ref())
    e, x = {r.event_uid: r for r in events.collect()}, dead.collect()
    assert set(e) == {"0", "2"} and [(r.event_uid, r.stage, r.reason) for r in x] == [("1", "normalize", "invalid_ip")]
    assert e["0"].ocsf.connection_info.direction == "Outbound" and e["0"].unmapped["type"] == "traffic" and e["2"].source_type == "unknown"
    assert json.loads(x[0].detail)["parsed_fields"]["srcip"] == "10.0.0.x"


def test_lake_guard_and_unify(spark, tmp_path):
    for bad in ("delete from x", "select 1; select 2", "with a as (select 1) insert into b select * from a", "create table x (a int)"):
        with pytest.raises(readonly.ReadOnlyViolation):
            readonly.query(spark, bad)
    assert readonly.query(spark, "select 'drop table x; --' as a, replace('a', 'a', 'b') as b -- c").first().b == "b"
    with pytest.raises(ValueError, match="unknown filters"):
        lake.search(spark.range(1), nope=1)
    assert lake.read_silver(spark, str(tmp_path / "none")).count() == 0
    path = str(tmp_path / "s/date=1")
    for part in (spark.range(3).select("id"), spark.range(2).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("n"))):
        part.coalesce(1).write.mode("append").parquet(path)
    assert lake.compact(spark, str(tmp_path / "s"))["merged"] == 1
    assert spark.read.parquet(path).count() == 5


def test_merkle_and_chain(spark):
    def root(hs):
        while len(hs) > 1:
            hs = [hashlib.sha256(hs[i] + hs[min(i + 1, len(hs) - 1)]).digest() for i in range(0, len(hs), 2)]
        return hs[0]

    n = 23
    rows = spark.createDataFrame([(i, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(n)], "event_uid long, raw_hash string")
    b = integrity.batches(integrity.numbered(rows, ["event_uid"]), "ordinal", 7).cache()
    ledger = integrity.chained(integrity.sealed(b, size=7)).drop("signature").orderBy("seq").collect()
    prev = bytes(32)
    for r in ledger:
        own = root([hashlib.sha256(str(i).encode()).digest() for i in range(7 * r.seq, min(n, 7 * r.seq + 7))])
        prev = hashlib.sha256(prev + own).digest()
        assert (r.batch_root, r.chained_root) == (own.hex(), prev.hex())
    p = integrity.proofs(b, size=7)
    assert p.where(integrity.proof_root(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0 and p.count() == n
    broken = spark.createDataFrame(ledger).withColumn("chained_root", F.when(F.col("seq") == 1, F.lit("00" * 32)).otherwise(F.col("chained_root")))
    assert {r.seq: r.reason for r in integrity.verify_chain(broken).collect()} == {0: None, 1: "root", 2: "link", 3: None}


@pytest.mark.parametrize("parts", [1, 3, 8, 50])
def test_numbers_are_dense_under_any_partitioning(spark, parts):
    e = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id").repartition(5)
    got = integrity.numbered(e, ["event_id"], parts=parts).orderBy("event_id").collect()
    assert [r.ordinal for r in got] == list(range(len(got))) and len(got) == 10_000
    assert integrity.numbered(e.where("false"), ["event_id"]).collect() == []


def test_signatures_agree_with_the_jvm(spark):
    seed, message = bytes(range(32)), b"root"
    j = spark.sparkContext._jvm
    decode = j.java.util.Base64.getMimeDecoder().decode
    body = lambda pem: decode("".join(pem.split("\n")[1:-2]))
    private = j.java.security.KeyFactory.getInstance("Ed25519").generatePrivate(j.java.security.spec.PKCS8EncodedKeySpec(body(ed25519.private_pem(seed))))
    signer = j.java.security.Signature.getInstance("Ed25519")
    signer.initSign(private)
    signer.update(bytearray(message))
    signature = bytes(signer.sign())
    public = ed25519.read_pem(ed25519.public_pem(ed25519.public_key(seed)))
    assert signature == ed25519.sign(ed25519.read_pem(ed25519.private_pem(seed)), message)
    assert ed25519.verify(public, message, signature) and not ed25519.verify(public, b"other", signature)
    assert not ed25519.verify(public, message, signature[:-1] + b"\xff") and not ed25519.verify(bytes(31), message, signature)


def test_sealed_ingest_and_verification(spark, tmp_path):
    root, seed = str(tmp_path / "lake"), bytes(range(32))
    public = ed25519.public_key(seed)
    lines = lambda ids: spark.createDataFrame([(f"u{i:03}", bytearray(f"line {i}".encode()), i) for i in ids], "event_uid string, raw binary, ingest_time_ns long")
    assert integrity.seal(spark, lake.bronze(lines(range(25))), root, seed, now_ns=7, size=10) == 3
    assert integrity.seal(spark, lake.bronze(lines(range(25, 30))), root, seed, size=10) == 1
    ledger = integrity.read_ledger(spark, root).orderBy("seq").collect()
    assert [(r.seq, r.leaf_count, r.first_event_uid, r.last_event_uid) for r in ledger] == [(0, 10, "u000", "u009"), (1, 10, "u010", "u019"), (2, 5, "u020", "u024"), (3, 5, "u025", "u029")]
    assert ledger[0].sealed_at_ns == 7 and integrity.first_fault(integrity.verify_chain(spark.createDataFrame(ledger), public)) is None
    forged = spark.createDataFrame(ledger).withColumn("signature", F.when(F.col("seq") == 2, F.lit("00" * 64)).otherwise(F.col("signature")))
    assert integrity.first_fault(integrity.verify_chain(forged, public)) == (2, "signature")
    assert integrity.first_fault(integrity.verify_chain(forged.where("seq <> 1"), public)) == (2, "sequence")
    index, bronze = integrity.read_index(spark, root), lake.bronze(lines(range(30)))
    assert integrity.verify_events(bronze, index, spark.createDataFrame(ledger), 10).where("reason is not null").count() == 0
    bad = bronze.withColumn("raw", F.when(F.col("event_uid") == "u012", F.lit("x").cast("binary")).otherwise(F.col("raw")))
    one = lambda uid: [r.reason for r in integrity.verify_event(bad, index, spark.createDataFrame(ledger), uid, 10).collect()]
    assert [one("u003"), one("u012"), one("u013"), one("none")] == [[None], ["hash"], ["proof"], []]
    jobs.ingest(lines(range(40, 45)), [d for d in builtin.definitions() if d.name == "fortigate_traffic"], root, seed=seed)
    assert integrity.read_ledger(spark, root).count() == 5
    fault, events = jobs.verify(spark, root, public)
    assert fault is None and {r.event_uid: r.reason for r in events.collect()} == {f"u{i:03}": None for i in range(40, 45)}


def test_frames():
    assert list(readers.frames(b"5 hello3 a\nbline one\r\n\nlast")) == [b"hello", b"a\nb", b"line one", b"last"]
    assert list(readers.frames(b"9 short")) == [] and list(readers.frames(b"99999999 x")) == []


def test_bodies(spark):
    one = lambda text: spark.createDataFrame([(text,)], "body string")
    assert [r.line for r in readers.raw_body_lines(one("a\r\n\n b\n"), "body").collect()] == ["a", " b"]
    assert [r.line for r in readers.json_body_events(one('[{"b":1,"a":2}]'), "body").collect()] == ['{"a":2,"b":1}']
    assert readers.json_body_events(one('{"a":1}\n{bad'), "body").count() == 0
    got = readers.hec_events(one('{"event":"x","sourcetype":"s"} {"event":{"b":1,"a":2}}'), "body").collect()
    assert [(r.line, r.source_id) for r in got] == [("x", "s"), ('{"a":2,"b":1}', None)]


def test_delivery():
    answers, waits = iter([503, 429, 200]), []
    assert export.deliver(lambda _: next(answers), b"", sleep=waits.append) and waits == [0.5, 1.0]
    assert not export.deliver(lambda _: 400, b"", sleep=waits.append)
    failed = ingest.fan_out(None, {"lake": lambda b: None}, {"index": lambda b: 1 / 0})
    assert list(failed) == ["index"]


def test_stream_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.log").write_text(FORTI.format("deny") + "\n\nother\n")
    q = ingest.start(ingest.line_stream(spark, str(tmp_path / "in")), Registry([d for d in builtin.definitions() if d.name == "fortigate_traffic"]), str(tmp_path / "lake"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = lake.read_silver(spark, str(tmp_path / "lake/silver"))
    assert sorted(r.source_type for r in got.collect()) == ["fortigate_traffic", "unknown"]
    assert lake.read_bronze(spark, str(tmp_path / "lake/bronze")).count() == 2


def test_structured_data_and_bom(spark):
    assert column(spark, ['[a@1 x="1\\"2" y="]"][b z=""]'], decode.structured_data) == [{"a@1": {"x": '1"2', "y": "]"}, "b": {"z": ""}}]
    assert validate.populated is not None and normalize.TRUE[0] == "true"


def test_spread_uses_all_cores_of_small_inputs_only(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(0, 100, 1, 1), spark.range(0, 100, 1, cores + 1)
    assert spread(few).rdd.getNumPartitions() == cores
    assert sorted(r.id for r in spread(few).collect()) == list(range(100))
    assert spread(many) is many


def test_last_of_equal_keys_counts(spark):
    rows = spark.createDataFrame([("a=1 b=2",), ("a=1 b=2 a=3",), ("",)], "t string").select(compile_engine("kv")(F.col("t")).alias("m")).collect()
    assert [r.m for r in rows] == [{"a": "1", "b": "2"}, {"a": "3", "b": "2"}, {}]


@pytest.mark.parametrize("name", ["stream_session", "stream_dedup"])
def test_streams_give_all_rows_as_files(spark, name):
    events = "/root/testdata/sf0.001/events.parquet"
    if name == "stream_dedup":
        want = f"select distinct event_id from '{events}'"
    else:
        want = f"""with g as (select user_id, ts, coalesce(ts - lag(ts) over w >= interval 10 minutes, true)::int as opens from '{events}' window w as (partition by user_id order by ts)),
            s as (select user_id, ts, sum(opens) over (partition by user_id order by ts) as s from g)
            select epoch_us(min(ts)) // 1000000 as start_s, user_id, count(*) as n from s group by user_id, s"""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    folder = shared_folder(spark).removeprefix("file:")
    assert got.inputFiles() and all(f.removeprefix("file://").startswith(folder) for f in got.inputFiles())
    assert not [x for x in os.listdir(folder) if x.endswith("-state")]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    rows = lambda r: sorted(tuple(r))
    assert rows(map(tuple, got.collect())) == rows(duckdb.sql(want).fetchall())


@pytest.mark.parametrize("name", ["unmapped_keep_all", "unmapped_keep_list"])
def test_used_keys_are_found_once_a_row(spark, name):
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # array_contains stands right behind the start of the filter's function: what it searches must be bound outside
    at = [m.end() for m in re.finditer(r"map_filter\(fields#\d+, lambdafunction\(", plan)]
    assert at and all("flatten(" not in plan[i : i + 200] for i in at)
    con = duckdb.connect()
    con.sql("create view events as select * from '/root/testdata/sf0.001/events.parquet'")
    rows = lambda x: sorted(tuple(r) for r in x)
    want = con.sql(queries.ORACLE[name]).select(*df.columns)
    assert rows(df.collect()) == rows(want.fetchall())


def test_native_memory_is_given_back_after_each_intermediate_table(spark, monkeypatch):
    asked, trim = [], shared.trimmed
    monkeypatch.setattr(shared, "trimmed", lambda s: (asked.append(s), trim(s)))
    assert sorted(r.id for r in shared.cut(spark.range(3)).collect()) == [0, 1, 2]
    assert asked == [spark]


@pytest.mark.parametrize("name", ["unmapped_keep_all", "unmapped_keep_list"])
def test_used_keys_are_known_beforehand_and_headers_matched_once(spark, name):
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "flatten(" not in plan
    # one test, and one more match for the message
    assert 1 <= plan.count(decode._RFC5424) <= 2


@pytest.mark.parametrize("keep", ["keep_all", ["b", "d", "e"], "drop"])
def test_unmapped_leaves_what_no_rule_used(spark, keep):
    fields = {"app_name": {"from": ["a", "b", "c"], "type": "str"}, "firewall_rule.name": {"from": ["c", "d"], "type": "str", "join": " "}, "connection_info.uid": {"from": ["e", "b"], "type": "str"}}
    d = read({"name": "some", "detect": {"contains": "="}, "parse": {"engine": "kv"}, "normalize": {"class_uid": 4001, "category_uid": 4, "activity_id": {"from": "f", "map": {"1": 1}, "default": 0}, "fields": fields, "unmapped": keep}})
    texts = ["a=1 b=2 c=3 d=4 e=5 f=1 g=7", "b=2 c=3", 'a="" b=2 f= g=', "c=3 b= e=5", "d=4 g=7 e=", "none"]

    def want(text):
        if "=" not in text:
            return None
        m = {p.split("=", 1)[0]: p.split("=", 1)[1].strip('"') for p in text.split()}
        won = lambda *keys: [k for k in keys if m.get(k)][:1]
        used = {*won("a", "b", "c"), *won("c"), *won("d"), *won("e", "b"), *won("f")}
        return {k: v for k, v in m.items() if k not in used and (keep == "keep_all" or k in keep)} if keep != "drop" else {}

    rows = spark.createDataFrame([(str(i), bytearray(t.encode()), t) for i, t in enumerate(texts)], "event_uid string, raw binary, raw_hash string")
    assert [r.unmapped for r in normalize.normalized(rows, [d], ref()).orderBy("event_uid").collect()] == [want(t) for t in texts]


def test_envelopes_match_their_patterns(spark):
    texts = ["<14>1 2026-01-01T00:00:00Z pa1 - - - - a,b", '<165>1 - h app 12 ID [a@1 x="]\\""][b y="z w"] the  message', "<14>1 2026-01-01T00:00:00Z pa1 app - - -", "<14>1 2026 pa1 app - - - ", "<14>1 2026-01-01T00:00:00Z  pa1 - - - - x", "<14>1 t h a p q m - x\ny", "<191>Jan  2 03:04:05 host sshd[77]: in from", "<13>Jan 12 03:04:05 host no tag here", "<999>rest", "<5>", "plain", "", None]

    def want(text):
        if text is None:
            return ("none", None, None, None, None, None, None)
        pri = re.match(r"<(\d{1,3})>", text, re.A)
        number, a = pri and int(pri[1]), re.match(decode._RFC5424, text, re.A)
        if a:
            dash = lambda x: None if x == "-" else x
            return ("rfc5424", number, int(a[1]), dash(a[2]), dash(a[5]), dash(a[7]), a[8] or "")
        if b := re.match(decode._RFC3164, text, re.A):
            t = re.match(decode._TAG, b[3], re.A)
            return ("rfc3164", number, None, b[1], (t[2] or None) if t else None, None, t[3] if t else b[3])
        return ("pri_only" if pri else "none", number, None, None, None, None, text[pri.end() :] if pri else text)

    keys = ("format", "pri", "version", "timestamp", "procid", "structured_data", "message")
    assert [tuple(r[k] for k in keys) for r in column(spark, texts, decode.envelope)] == [want(t) for t in texts]
    rows, header = decode.enveloped(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text")
    got = rows.select("i", F.struct(*(header[k].alias(k) for k in header)).alias("p"), "envelope", decode.envelope(F.col("text")).alias("e")).orderBy("i").collect()
    assert all(r.p == r.envelope == r.e for r in got)


def test_positional_values_of_any_number(spark):
    got = column(spark, ["1,2,3", "1,,3", "1,2", "1,2,3,4", '"a ""b""",,'], compile_engine("csv", {"columns": ["x", "y", "z"]}))
    assert got == [{"x": "1", "y": "2", "z": "3"}, {"x": "1", "y": None, "z": "3"}, {"x": "1", "y": "2", "_truncated": "true"}, {"x": "1", "y": "2", "z": "3", "_extra.0": "4"}, {"x": 'a "b"', "y": None, "z": None}]
