"""Registered queries of the log engine.

The driver's tables hold no logs, so the queries first write lines from them by format, and the SQL beside each computes
what must come out of the lines straight from the tables: a fault in a parser shows as a different value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.functions import net, times
from stratalog.functions.shared import dealt
from stratalog.operators import crosswalk, decode, definition, engines, enrich, integrity, normalize, validate
from stratalog.operators.definition import detector, route
from stratalog.operators.engines import compile_engine
from stratalog.plans import builtin, jobs, lake, readonly

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


@cache
def _definitions():
    return {d.name: d for d in builtin.definitions()}


def only(*names: str):
    return [_definitions()[n] for n in names]


def num(expr: str) -> Column:
    return F.expr(f"cast({expr} as bigint)")


def _lines(df: DataFrame, line: Column, uid: str) -> DataFrame:
    """Evidence rows of a text column."""
    return df.select(F.concat(F.lit("e"), F.col(uid).cast("string")).alias("event_uid"), line.cast("binary").alias("raw"), F.lit(0).cast("bigint").alias("ingest_time_ns"), F.col(uid).alias("id")).withColumn("raw_hash", F.sha2("raw", 256))


# ---- lines ------------------------------------------------------------------------------------------------------
#: Shared pieces of the SQL over events.
EV = """
e AS (SELECT event_id, event_id % 4 AS k, ts, event_type, value,
  '10.' || ((user_id // 250) % 250)::VARCHAR || '.' || (user_id % 250)::VARCHAR || '.' || (event_id % 250 + 1)::VARCHAR AS src,
  '203.0.113.' || (event_id % 250 + 1)::VARCHAR AS dst, 1024 + event_id % 5000 AS sport,
  CASE event_type WHEN 'purchase' THEN 443 WHEN 'click' THEN 22 ELSE 8081 END AS dport, floor(value)::BIGINT AS sent, event_id % 100000 AS rcvd FROM events)"""


def _events(spark, d) -> DataFrame:
    return dealt(table(spark, d, "events")).selectExpr(
        "event_id", "event_id % 4 as k", "ts", "event_type", "value",
        "concat('10.', (user_id div 250) % 250, '.', user_id % 250, '.', event_id % 250 + 1) as src", "concat('203.0.113.', event_id % 250 + 1) as dst", "1024 + event_id % 5000 as sport",
        "case event_type when 'purchase' then 443 when 'click' then 22 else 8081 end as dport", "cast(floor(value) as bigint) as sent", "event_id % 100000 as rcvd",
    )


def fortigate_lines(spark, d) -> DataFrame:
    e = _events(spark, d)
    line = F.expr(
        """concat('<189>date=', date_format(ts, 'yyyy-MM-dd'), ' time=', date_format(ts, 'HH:mm:ss'), ' logid="0000000013" type="traffic" level="', elt(cast(k + 1 as int), 'notice', 'warning', 'error', 'alert'),
        '" srcip=', src, ' srcport=', sport, ' srcintf="port1" dstip=', dst, ' dstport=', dport, ' dstintf="wan1" sessionid=', event_id, ' proto=6 action="', elt(cast(k + 1 as int), 'accept', 'close', 'deny', 'server-rst'),
        '" policyid=7 sentbyte=', sent, ' rcvdbyte=', rcvd, ' msg="a=b c=\\\\"', event_type, '\\\\""')"""
    )
    return _lines(e, line, "event_id")


def zeek_lines(spark, d) -> DataFrame:
    e = _events(spark, d)
    line = F.expr("""concat('{"ts":', unix_seconds(ts), '.5,"uid":"C', event_id, '","id.orig_h":"', src, '","id.orig_p":', sport, ',"id.resp_h":"', dst, '","id.resp_p":', dport, ',"proto":"tcp","conn_state":"', elt(cast(k + 1 as int), 'SF', 'S0', 'REJ', 'OTH'), '","orig_bytes":', sent, ',"resp_bytes":', rcvd, ',"local":true,"tags":["', event_type, '","x"],"none":[]}')""")
    return _lines(e, line, "event_id")


def suricata_lines(spark, d) -> DataFrame:
    e = _events(spark, d)
    line = F.expr("""concat('{"timestamp":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '.250000+0000","event_type":"alert","src_ip":"', src, '","src_port":', sport, ',"dest_ip":"', dst, '","dest_port":', dport, ',"proto":"TCP","alert":{"action":"', elt(cast(k + 1 as int), 'allowed', 'blocked', 'dropped', 'x'), '","signature_id":', event_id, ',"signature":"ET SCAN ', event_type, ' sweep","category":"Misc","severity":', k + 1, '}}')""")
    return _lines(e, line, "event_id")


def vpc_lines(spark, d) -> DataFrame:
    e = _events(spark, d)
    line = F.expr("concat('2 123456789012 eni-0a1b ', case when k = 3 then '-' else src end, ' ', case when k = 3 then '-' else dst end, ' ', sport, ' ', dport, ' 6 ', k, ' ', sent, ' ', unix_seconds(ts), ' ', unix_seconds(ts) + 60, ' ', elt(cast(k + 1 as int), 'ACCEPT', 'REJECT', 'ACCEPT', '-'), ' ', case when k = 3 then 'NODATA' else 'OK' end)")
    return _lines(e, line, "event_id")


def asa_lines(spark, d) -> DataFrame:
    e = _events(spark, d)
    line = F.expr("""concat('<166>Mar ', lpad(1 + event_id % 28, 2, ' '), ' 10:20:30 fw1 %ASA-', case when k = 0 then concat('6-302013: Built outbound TCP connection ', event_id, ' for outside:', dst, '/', dport, ' (', dst, '/', dport, ') to inside:', src, '/', sport, ' (', src, '/', sport, ')') when k = 1 then concat('6-302014: Teardown TCP connection ', event_id, ' for outside:', dst, '/', dport, ' to inside:', src, '/', sport, ' duration 0:00:30 bytes ', sent, ' TCP FINs') else concat('4-106023: Deny tcp src inside:', src, '/', sport, ' dst outside:', dst, '/', dport, ' by access-group "acl ', k, '" [0x0, 0x0]') end)""")
    return _lines(e, line, "event_id")


def iptables_lines(spark, d) -> DataFrame:
    e = _events(spark, d)
    line = F.expr("concat('<4>Mar ', lpad(1 + event_id % 28, 2, ' '), ' 01:02:03 gw kernel: act=', elt(cast(k + 1 as int), 'DROP', 'ACCEPT', 'reject', 'odd'), ' IN=eth0 OUT= SRC=', src, ' DST=', dst, ' LEN=', rcvd, ' PROTO=UDP SPT=', sport, ' DPT=', dport)")
    return _lines(e, line, "event_id")


def panos_lines(spark, d, columns: int) -> DataFrame:
    from stratalog.operators.columns import COLUMN_MAPS

    names = COLUMN_MAPS["panos_traffic", "10.1" if columns == 47 else "11.0"]
    have = {"future_use_1": "1", "receive_time": "date_format(ts, 'yyyy/MM/dd HH:mm:ss')", "serial_number": "'0123'", "type": "'TRAFFIC'", "generated_time": "date_format(ts, 'yyyy/MM/dd HH:mm:ss')", "src_ip": "src", "dst_ip": "dst", "nat_src_ip": "'198.51.100.1'", "rule_name": "concat('\"r ', k, '\"')", "app": "event_type", "src_zone": "'in'", "session_id": "event_id", "src_port": "sport", "dst_port": "dport", "protocol": "'tcp'", "action": "elt(cast(k + 1 as int), 'allow', 'deny', 'drop', 'reset-both')", "bytes_sent": "sent", "bytes_received": "rcvd", "packets": "k"}
    line = F.expr("concat('<14>1 2026-01-01T00:00:00Z pa1 - - - - ', concat_ws(',', " + ", ".join(f"cast({have.get(n, chr(39) * 2)} as string)" for n in names) + "))")
    return _lines(_events(spark, d), line, "event_id")


# ---- per source -------------------------------------------------------------------------------------------------
def _source(lines: DataFrame, name: str, extra: dict[str, str] | None = None) -> DataFrame:
    """Core columns and a few more of one source's records."""
    n = normalize.normalized(lines, only(name), F.lit("2026-11-26 00:00:00").cast("timestamp"))
    more = [F.col(f"ocsf.{p}").alias(a) for a, p in (extra or {}).items()]
    return n.select("id", F.col("error.reason").alias("reason"), *normalize.core_columns(), *more).drop("raw_hash", "event_uid")


_CORE_SQL = "sport::BIGINT AS src_port, dport::BIGINT AS dst_port, src AS src_ip, dst AS dst_ip"


@query(f"""WITH {EV} SELECT event_id AS id, NULL::VARCHAR AS reason, (epoch_us(ts) // 1000000) * 1000000000 AS time, 4001::BIGINT AS class_uid, 4::BIGINT AS category_uid,
  [1, 2, 6, 3][k + 1]::BIGINT AS activity_id, 400100 + [1, 2, 6, 3][k + 1]::BIGINT AS type_uid, [1, 3, 4, 5][k + 1]::BIGINT AS severity_id, 'fortigate_traffic' AS source_type, {_CORE_SQL}, 'TCP' AS protocol,
  [1, 1, 2, 1][k + 1]::BIGINT AS action_id, rcvd::BIGINT AS bytes_in, sent AS bytes_out, ['Open', 'Close', 'Traffic', 'Reset'][k + 1] AS activity_name, ['Informational', 'Medium', 'High', 'Critical'][k + 1] AS severity,
  'Network Activity: ' || ['Open', 'Close', 'Traffic', 'Reset'][k + 1] AS type_name, event_id::VARCHAR AS session FROM e""")
def src_fortigate(spark, d):
    return _source(fortigate_lines(spark, d), "fortigate_traffic", {"activity_name": "activity_name", "severity": "severity", "type_name": "type_name", "session": "connection_info.uid"})


@query(f"""WITH {EV} SELECT event_id AS id, NULL::VARCHAR AS reason, (epoch_us(ts) // 1000000) * 1000000000 + 500000000 AS time, 4001::BIGINT AS class_uid, 4::BIGINT AS category_uid, [2, 4, 5, 6][k + 1]::BIGINT AS activity_id,
  400100 + [2, 4, 5, 6][k + 1]::BIGINT AS type_uid, 1::BIGINT AS severity_id, 'zeek_conn' AS source_type, {_CORE_SQL}, 'tcp' AS protocol, 1::BIGINT AS action_id, rcvd::BIGINT AS bytes_in, sent AS bytes_out FROM e""")
def src_zeek_conn(spark, d):
    return _source(zeek_lines(spark, d), "zeek_conn")


@query(f"""WITH {EV} SELECT event_id AS id, NULL::VARCHAR AS reason, (epoch_us(ts) // 1000000) * 1000000000 + 250000000 AS time, 2004::BIGINT AS class_uid, 2::BIGINT AS category_uid, 1::BIGINT AS activity_id, 200401::BIGINT AS type_uid,
  [4, 3, 2, 1][k + 1]::BIGINT AS severity_id, 'suricata_eve_alert' AS source_type, {_CORE_SQL}, NULL::VARCHAR AS protocol, [1, 2, 2, 0][k + 1]::BIGINT AS action_id, NULL::BIGINT AS bytes_in, NULL::BIGINT AS bytes_out,
  'ET SCAN ' || event_type || ' sweep' AS title, event_id::VARCHAR AS uid, ['Allowed', 'Blocked', 'Dropped', NULL][k + 1] AS disposition FROM e""")
def src_suricata_alert(spark, d):
    return _source(suricata_lines(spark, d), "suricata_eve_alert", {"title": "finding_info.title", "uid": "finding_info.uid", "disposition": "disposition"})


@query(f"""WITH {EV} SELECT event_id AS id, CASE WHEN k = 3 THEN 'invalid_ip' END AS reason, (epoch_us(ts) // 1000000) * 1000000000 AS time, 4001::BIGINT AS class_uid, 4::BIGINT AS category_uid, 6::BIGINT AS activity_id, 400106::BIGINT AS type_uid,
  1::BIGINT AS severity_id, 'aws_vpc_flow' AS source_type, sport::BIGINT AS src_port, dport::BIGINT AS dst_port, CASE WHEN k < 3 THEN src END AS src_ip, CASE WHEN k < 3 THEN dst END AS dst_ip, 'tcp' AS protocol,
  [1, 2, 1, 0][k + 1]::BIGINT AS action_id, NULL::BIGINT AS bytes_in, NULL::BIGINT AS bytes_out, sent AS bytes, k::BIGINT AS packets, [1, 1, 1, 0][k + 1]::BIGINT AS status_id FROM e""")
def src_vpc_flow(spark, d):
    return _source(vpc_lines(spark, d), "aws_vpc_flow", {"bytes": "traffic.bytes", "packets": "traffic.packets", "status_id": "status_id"})


@query(f"""WITH {EV} SELECT event_id AS id, NULL::VARCHAR AS reason, epoch(make_timestamp(2026, 3, (1 + event_id % 28)::BIGINT, 10, 20, 30))::BIGINT * 1000000000 AS time, 4001::BIGINT AS class_uid, 4::BIGINT AS category_uid,
  [1, 2, 6, 6][k + 1]::BIGINT AS activity_id, 400100 + [1, 2, 6, 6][k + 1]::BIGINT AS type_uid, [1, 1, 3, 3][k + 1]::BIGINT AS severity_id, 'cisco_asa' AS source_type, {_CORE_SQL}, 'tcp' AS protocol,
  [1, 1, 2, 2][k + 1]::BIGINT AS action_id, NULL::BIGINT AS bytes_in, NULL::BIGINT AS bytes_out, CASE WHEN k = 1 THEN sent END AS bytes, CASE WHEN k > 1 THEN 'acl ' || k::VARCHAR END AS rule,
  CASE WHEN k = 0 THEN 'Outbound' ELSE 'Unknown' END AS direction FROM e""")
def src_cisco_asa(spark, d):
    return _source(asa_lines(spark, d), "cisco_asa", {"bytes": "traffic.bytes", "rule": "firewall_rule.name", "direction": "connection_info.direction"})


@query(f"""WITH {EV} SELECT event_id AS id, NULL::VARCHAR AS reason, epoch(make_timestamp(2026, 3, (1 + event_id % 28)::BIGINT, 1, 2, 3))::BIGINT * 1000000000 AS time, 4001::BIGINT AS class_uid, 4::BIGINT AS category_uid, 6::BIGINT AS activity_id,
  400106::BIGINT AS type_uid, 1::BIGINT AS severity_id, 'iptables' AS source_type, {_CORE_SQL}, 'udp' AS protocol, [2, 1, 2, 0][k + 1]::BIGINT AS action_id, NULL::BIGINT AS bytes_in, NULL::BIGINT AS bytes_out,
  rcvd::BIGINT AS bytes, ['Denied', 'Allowed', 'Denied', NULL][k + 1] AS action, ['Dropped', 'Allowed', 'Dropped', NULL][k + 1] AS disposition FROM e""")
def src_iptables(spark, d):
    return _source(iptables_lines(spark, d), "iptables", {"bytes": "traffic.bytes", "action": "action", "disposition": "disposition"})


def _panos_sql(name):
    return f"""WITH {EV} SELECT event_id AS id, NULL::VARCHAR AS reason, (epoch_us(ts) // 1000000) * 1000000000 AS time, 4001::BIGINT AS class_uid, 4::BIGINT AS category_uid, 6::BIGINT AS activity_id, 400106::BIGINT AS type_uid,
  1::BIGINT AS severity_id, '{name}' AS source_type, {_CORE_SQL}, 'tcp' AS protocol, [1, 2, 2, 2][k + 1]::BIGINT AS action_id, rcvd::BIGINT AS bytes_in, sent AS bytes_out,
  'r ' || k::VARCHAR AS rule, event_type AS app, ['Allowed', 'Blocked', 'Dropped', 'Reset'][k + 1] AS disposition FROM e"""


@query(_panos_sql("panos_traffic_v10"))
def src_panos_v10(spark, d):
    return _source(panos_lines(spark, d, 47), "panos_traffic_v10", {"rule": "firewall_rule.name", "app": "app_name", "disposition": "disposition"})


@query(_panos_sql("panos_traffic_v11"))
def src_panos_v11(spark, d):
    return _source(panos_lines(spark, d, 51), "panos_traffic_v11", {"rule": "firewall_rule.name", "app": "app_name", "disposition": "disposition"})


@query(f"""WITH {EV} SELECT event_id AS id, ['zeek_conn', 'suricata_eve_alert', 'aws_vpc_flow', 'unknown'][k + 1] AS source_type FROM e""")
def route_priority(spark, d):
    lines = {i: f(spark, d).where(F.col("id") % 4 == i) for i, f in enumerate((zeek_lines, suricata_lines, vpc_lines))}
    rest = _lines(_events(spark, d).where("k = 3"), F.lit("nothing to see"), "event_id")
    every = lines[0].union(lines[1]).union(lines[2]).union(rest).withColumn("text", decode.decoded(F.col("raw")))
    every = every.withColumn("payload", F.col("text")).withColumn("kind", decode.sniff(F.col("text")))
    return every.select("id", route(F.col("text"), builtin.definitions()).alias("source_type"))


# ---- evidence, sniffing, envelopes ------------------------------------------------------------------------------
@query("SELECT event_id AS id, sha256(event_id::VARCHAR || ' ' || event_type) AS raw_hash, length(event_id::VARCHAR || ' ' || event_type)::BIGINT AS raw_len, strftime(ts, '%Y-%m-%d') AS date FROM events")
def bronze_hash(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("id"), F.concat_ws(" ", "event_id", "event_type").cast("binary").alias("raw"), (F.unix_micros("ts") * 1000).alias("ingest_time_ns"))
    return lake.bronze(e).select("id", "raw_hash", F.col("raw_len").cast("bigint").alias("raw_len"), "date")


@query("SELECT strftime(ts, '%Y-%m-%d') AS date, count(*)::BIGINT AS n FROM events GROUP BY 1")
def bronze_by_date(spark, d):
    return table(spark, d, "events").groupBy(times.date_of_ns(F.unix_micros("ts") * 1000).alias("date")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id AS id, ['syslog', 'cef', 'leef', 'json', 'tsv', 'kv', 'csv', 'unknown'][event_id % 8 + 1] AS format, ['kv', 'cef', 'leef', 'json', 'tsv', 'kv', 'csv', 'unknown'][event_id % 8 + 1] AS inner_format FROM events")
def sniff_formats(spark, d):
    line = F.expr("elt(cast(event_id % 8 + 1 as int), '<13>a=1 b=2 c=3', 'x CEF:0|a|b|c|d|e|5|', 'LEEF:1.0|a|b|c|d|', '{\"a\": 1}', 'a\tb\tc\td', 'a=1 b=2 c=3', '1,2,3,4,5,6,7,8,9', '{not json')")
    return table(spark, d, "events").select(F.col("event_id").alias("id"), decode.sniff(line).alias("format"), decode.sniff_layered(line)["inner"].alias("inner_format"))


@query("SELECT event_id AS id, event_id % 192 AS pri, (event_id % 192) // 8 AS facility, (event_id % 192) % 8 AS severity, 'body ' || event_type AS message FROM events")
def syslog_pri(spark, d):
    e = decode.envelope(F.expr("concat('<', event_id % 192, '>body ', event_type)"))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), e.alias("e")).select("id", *(F.col(f"e.{c}").cast("bigint").alias(c) for c in ("pri", "facility", "severity")), "e.message")


@query("SELECT s_suppkey AS id, 'rfc5424' AS format, 'host-' || s_suppkey::VARCHAR AS hostname, 'app' AS app_name, NULL::VARCHAR AS procid, 'ID' || s_suppkey::VARCHAR AS msgid, s_name || ' \"x]' AS name, s_nationkey::VARCHAR AS nation, 'said ' || s_name AS message FROM supplier")
def syslog_rfc5424_sd(spark, d):
    line = F.expr(r"""concat('<34>1 2026-01-01T00:00:00Z host-', s_suppkey, ' app - ID', s_suppkey, ' [a@1 name="', s_name, ' \\"x\\]" n="', s_nationkey, '"][b@2 x="y"] said ', s_name)""")
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), decode.envelope(line).alias("e"))
    sd = decode.structured_data(F.col("e.structured_data"))
    return rows.select("id", "e.format", "e.hostname", "e.app_name", "e.procid", "e.msgid", sd["a@1"]["name"].alias("name"), sd["a@1"]["n"].alias("nation"), "e.message")


@query("SELECT s_suppkey AS id, 'rfc3164' AS format, 'gw' AS hostname, 'kernel' AS app_name, s_suppkey::VARCHAR AS procid, 'IN=eth0 ' || s_name AS message FROM supplier")
def syslog_rfc3164(spark, d):
    line = F.expr("concat('<4>Mar  5 01:02:03 gw kernel[', s_suppkey, ']: IN=eth0 ', s_name)")
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), decode.envelope(line).alias("e")).select("id", "e.format", "e.hostname", "e.app_name", "e.procid", "e.message")


@query("SELECT n_nationkey::BIGINT AS id, n_name AS text, n_nationkey % 3 > 0 AS bom FROM nation")
def bom_strip(spark, d):
    raw = F.when(F.col("n_nationkey") % 3 == 1, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("n_name", "UTF-8"))).when(F.col("n_nationkey") % 3 == 2, F.concat(F.unhex(F.lit("FFFE")), F.encode("n_name", "UTF-16LE"))).otherwise(F.encode("n_name", "UTF-8"))
    return table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), raw.alias("raw")).select("id", decode.decoded(F.col("raw")).alias("text"), decode.bom_stripped(F.col("raw")).alias("bom"))


@query("SELECT c_custkey AS id, c_custkey % 2 = 0 AS a, c_custkey % 3 = 0 AS b, 3 + c_custkey % 3 = 4 AS n FROM customer")
def detect_any_all(spark, d):
    text = F.expr("concat(case when c_custkey % 2 = 0 then 'even' else 'odd' end, case when c_custkey % 3 = 0 then ',three' else ',no' end, repeat(',x', cast(1 + c_custkey % 3 as int)))")
    rule = lambda x: detector(x, F.col("t"))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), text.alias("t")).select("id", rule({"all": [{"starts_with": "even"}, {"contains": ","}]}).alias("a"), rule({"any": [{"regex": "thr?ee"}, {"contains": "four"}]}).alias("b"), rule({"field_count": {"delimiter": ",", "equals": 4}}).alias("n"))


# ---- engines ----------------------------------------------------------------------------------------------------
def _get(m: str, **keys: str) -> list[Column]:
    return [F.try_element_at(F.col(m), F.lit(k)).alias(a) for a, k in keys.items()]


@query("SELECT c_custkey AS id, c_custkey::VARCHAR AS key, c_name || ' = x' AS name, 'said \"' || c_mktsegment || '\"' AS seg, '' AS empty, 'last' AS dup FROM customer")
def parse_kv(spark, d):
    line = F.expr(r"""concat('key=', c_custkey, ' bare name="', c_name, ' = x" seg="said \\"', c_mktsegment, '\\"" empty= dup=first dup=last')""")
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), compile_engine("kv")(line).alias("m")).select("id", *_get("m", key="key", name="name", seg="seg", empty="empty", dup="dup"))


@query("SELECT event_id AS id, event_type AS a, floor(value)::BIGINT::VARCHAR || '.5' AS b, 'true' AS c, event_type AS t0, 'x' AS t1, '{}' AS e, event_type || ',x' AS joined FROM events")
def parse_json_flatten(spark, d):
    line = F.expr("""concat('{"a.b":"', event_type, '","n":{"v":', cast(floor(value) as bigint), '.5,"b":true,"e":{}},"t":["', event_type, '","x"]}')""")
    rows = table(spark, d, "events").select(F.col("event_id").alias("id"), line.alias("l")).select("id", compile_engine("json")(F.col("l")).alias("m"), compile_engine("json", {"array_mode": "join"})(F.col("l")).alias("j"))
    return rows.select("id", *_get("m", a="a.b", b="n.v", c="n.b", t0="t.0", t1="t.1", e="n.e"), *_get("j", joined="t"))


@query("SELECT o_orderkey AS id, o_orderkey::VARCHAR AS a, o_orderpriority || ', \"q\"' AS b, NULL::VARCHAR AS c, CASE WHEN o_orderkey % 3 = 0 THEN 'more' END AS extra, CASE WHEN o_orderkey % 3 = 1 THEN 'true' END AS truncated FROM orders")
def parse_csv(spark, d):
    line = F.expr('''concat(o_orderkey, ',"', o_orderpriority, ', ""q"""', case o_orderkey % 3 when 0 then ',,d,more' when 1 then ',' else ',,d' end)''')
    m = compile_engine("csv", {"columns": ["a", "b", "c", "d"]})(line)
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), m.alias("m")).select("id", *_get("m", a="a", b="b", c="c", extra="_extra.0", truncated="_truncated"))


@query("SELECT n_nationkey::BIGINT AS id, n_name AS name, NULL::VARCHAR AS region, '[\"' || n_regionkey::VARCHAR || '\",\"x\"]' AS tags, '[]' AS none FROM nation")
def parse_tsv_zeek(spark, d):
    from stratalog.sources.readers import zeek_tsv

    n = table(spark, d, "nation")
    head = spark.createDataFrame([(-3, "#set_separator ,"), (-2, "#fields\tname\tregion\ttags\tnone"), (-1, "#types\tstring\tcount\tset[string]\tvector[string]")], "id long, line string")
    rows = n.select(F.col("n_nationkey").cast("bigint").alias("id"), F.concat_ws("\t", "n_name", F.lit("-"), F.concat("n_regionkey", F.lit(",x")), F.lit("(empty)")).alias("line"))
    got = zeek_tsv(head.union(rows).withColumn("stream", F.lit("s")), "stream", "id", "line")
    return got.select("id", *(F.try_element_at("fields", F.lit(c)).alias(c) for c in ("name", "region", "tags", "none")))


@query("SELECT c_custkey AS id, '0' AS version, 'v|' || c_name AS vendor, '5' AS severity, c_mktsegment || ' a=b' AS msg, c_custkey::VARCHAR AS label FROM customer")
def parse_cef(spark, d):
    line = F.expr(r"""concat('CEF:0|v\\|', c_name, '|prod|1|100|name|5|src=10.0.0.1 msg=', c_mktsegment, ' a\\=b cs1=', c_custkey, ' cs1Label=customer dst=10.0.0.2')""")
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), compile_engine("cef")(line).alias("m")).select("id", *_get("m", version="CEFVersion", vendor="deviceVendor", severity="severity", msg="msg", label="customer"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN '1.0' ELSE '2.0' END AS version, 'e' || c_custkey::VARCHAR AS event, c_name AS name, c_mktsegment || '=x' AS seg FROM customer")
def parse_leef(spark, d):
    line = F.expr("concat('LEEF:', case when c_custkey % 2 = 0 then '1.0' else '2.0' end, '|v|p|1|e', c_custkey, '|', case when c_custkey % 2 = 0 then '' else 'x5E|' end, 'name=', c_name, case when c_custkey % 2 = 0 then '\t' else '^' end, 'seg=', c_mktsegment, '=x')")
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), compile_engine("leef")(line).alias("m")).select("id", *_get("m", version="leefVersion", event="eventId", name="name", seg="seg"))


@query("SELECT c_custkey AS id, c_custkey::VARCHAR AS k, c_mktsegment || '-' || c_name AS joined, 'rest of ' || c_name AS rest FROM customer")
def parse_dissect(spark, d):
    line = F.expr("concat('[', c_custkey, repeat('] ', cast(1 + c_custkey % 3 as int)), c_mktsegment, repeat(' ', cast(1 + c_custkey % 4 as int)), 'skip (', c_name, ') rest of ', c_name)")
    m = compile_engine("dissect", {"pattern": "[%{k->}] %{joined->} %{} (%{+joined}) %{rest}", "append_separator": "-"})(line)
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), m.alias("m")).select("id", *_get("m", k="k", joined="joined", rest="rest"))


@query("SELECT o_orderkey AS id, '10.1.' || (o_orderkey % 250)::VARCHAR || '.9' AS ip, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey::VARCHAR END AS n, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS word FROM orders")
def parse_grok(spark, d):
    line = F.expr("concat('noise from 10.1.', o_orderkey % 250, '.9 ', case when o_orderkey % 2 = 0 then concat('id=', o_orderkey) else concat('status ', o_orderstatus) end, ' end')")
    m = compile_engine("grok", {"pattern": "from %{IP:ip} (id=%{INT:n}|status %{WORD:word})"})(line)
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), m.alias("m")).select("id", *_get("m", ip="ip", n="n", word="word"))


def _reasoned(name: str, detect: dict, engine: str, options: dict) -> definition.Definition:
    return definition.read({
        "name": name, "detect": detect, "parse": {"engine": engine, "options": options, "envelope": "none"},
        "normalize": {"class_uid": 4001, "category_uid": 4, "activity_id": 6, "fields": {"src_endpoint.ip": {"from": "ip", "type": "ip"}}},
    })


#: Lines that an engine refuses, by the reason that it must give.
_REFUSED = {
    "grok_no_match": "grok_plain:from 10.0.0.x to", "json_invalid": '{"json":', "json_not_one_object": '[{"json":1},2]', "cef_no_marker": "cef:no such thing", "cef_header_incomplete": "cef:CEF:0|a|b",
    "leef_no_marker": "leef:none", "leef_unsupported_version": "leef:LEEF:3.0|a|b|c|d|", "leef_header_incomplete": "leef:LEEF:1.0|a|b", "dissect_delimiter_missing": "dissect:10.0.0.1 at",
    "grok_timeout": "grok_wild:" + "a" * 60 + "!",
}


@query(f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 500 = 7 THEN 9 ELSE event_id % 11 END AS k FROM events)
SELECT {[*_REFUSED]!r}[least(k, 9) + 1] AS reason, 'parse' AS stage, count(*)::BIGINT AS n FROM e WHERE k < 9 OR event_id % 500 = 7 GROUP BY ALL""")
def grok_reasons(spark, d):
    """Why lines have no fields, by each engine's own reasons, and matches that end with their budget; lines that parse are no dead letters."""
    k = F.when(F.col("event_id") % 500 == 7, 9).otherwise(F.when(F.col("event_id") % 11 < 9, F.col("event_id") % 11).otherwise(10)).cast("int")
    lines = _lines(table(spark, d, "events"), F.element_at(F.array(*map(F.lit, (*_REFUSED.values(), "grok_plain:from 10.0.0.7 to"))), k + 1), "event_id")
    starts = lambda *of: {"any": [{"starts_with": x} for x in of]}
    made = [
        _reasoned("grok_plain", starts("grok_plain:"), "grok", {"pattern": "from %{IP:ip} to"}), _reasoned("grok_wild", starts("grok_wild:"), "grok", {"pattern": "^grok_wild:(?:(a|aa)+)+$", "grok_timeout_ms": 20}),
        _reasoned("json", starts('{"json"', '[{"json"'), "json", {}), _reasoned("cef", starts("cef:"), "cef", {}), _reasoned("leef", starts("leef:"), "leef", {}), _reasoned("dissect", starts("dissect:"), "dissect", {"pattern": "dissect:%{ip} end"}),
    ]
    _, dead = validate.routed(normalize.normalized(lines, made, F.lit("2026-11-26").cast("timestamp")), {m.name: "warn" for m in made})
    return dead.groupBy("reason", "stage").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_id AS id, 8::BIGINT AS leaves, repeat('k.', 40) || 'n' AS deepest, event_id::VARCHAR AS n, event_type AS t, 'BIGINT,STRING,BOOLEAN,VOID,OBJECT<>' AS kinds, (event_id % 9)::VARCHAR AS last FROM events""")
def parse_json_deep(spark, d):
    """Objects forty levels deep, flattened whole, with the types that the values had."""
    line = F.expr("""concat(repeat('{"k":', 40), '{"n":', event_id, ',"t":"', event_type, '","b":', event_id % 2 = 0, ',"list":[', event_id % 7, ',{"x":null},{"y":', event_id % 9, '},[]],"o":{}', repeat('}', 41))""")
    rows = dealt(table(spark, d, "events")).select("event_id", line.alias("text"))
    rows = rows.select("event_id", engines.deep_leaves(F.col("text")).alias("leaves")).select("event_id", "leaves", engines.leaf_map(F.col("leaves")).alias("m"))
    path = lambda tail: F.concat(F.repeat(F.lit("k."), 40), F.lit(tail))
    kind = lambda tail: F.schema_of_variant(F.filter("leaves", lambda e: e["k"] == path(tail))[0]["v"])
    longest = F.filter("leaves", lambda e: e["k"].endswith(".n"))[0]["k"]
    kinds = F.concat_ws(",", kind("n"), kind("t"), kind("b"), kind("list.1.x"), kind("o"))
    return rows.select(F.col("event_id").alias("id"), F.size("m").cast("bigint").alias("leaves"), longest.alias("deepest"), F.element_at("m", path("n")).alias("n"), F.element_at("m", path("t")).alias("t"), kinds.alias("kinds"), F.element_at("m", path("list.2.y")).alias("last"))


# ---- scalars ----------------------------------------------------------------------------------------------------
@query("SELECT event_id AS id, (epoch_us(ts) // 1000000) * 1000000000 AS s, (epoch_us(ts) // 1000000) * 1000000000 + 123000000 AS ms, (epoch_us(ts) // 1000000) * 1000000000 + 5 AS frac FROM events")
def ts_epoch_scale(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("id"), F.unix_seconds("ts").alias("u"))
    return e.select("id", times.epoch_ns(F.col("u").cast("string")).alias("s"), times.epoch_ns((F.col("u") * 1000 + 123).cast("string")).alias("ms"), times.epoch_ns(F.concat("u", F.lit(".000000005"))).alias("frac"))


@query("SELECT event_id AS id, (epoch_us(ts) // 1000000) * 1000000000 AS fmt, (epoch_us(ts) // 1000000) * 1000000000 AS iso, ((epoch_us(ts) // 1000000) - 7200) * 1000000000 AS zoned, epoch(make_timestamp(2025, 12, (1 + event_id % 28)::BIGINT, 1, 2, 3))::BIGINT * 1000000000 AS yearless FROM events")
def ts_formats(spark, d):
    ref = F.lit("2026-01-01 00:00:00").cast("timestamp")
    e = table(spark, d, "events")
    return e.select(F.col("event_id").alias("id"), times.format_ns(F.date_format("ts", "dd/MM/yyyy HH-mm-ss"), "%d/%m/%Y %H-%M-%S").alias("fmt"), times.any_ns(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), ref).alias("iso"), times.any_ns(F.date_format("ts", "yyyy-MM-dd HH:mm:ss'+0200'"), ref).alias("zoned"), times.any_ns(F.expr("concat('Dec ', lpad(1 + event_id % 28, 2, ' '), ' 01:02:03')"), ref).alias("yearless"))


@query("SELECT l_orderkey AS id, l_linenumber::BIGINT AS line, l_quantity::BIGINT AS i, l_quantity::BIGINT AS f, NULL::BIGINT AS bad, l_linenumber % 2 = 1 AS b FROM lineitem")
def coerce_int_bool(spark, d):
    c = lambda t, k: normalize.coerce(t, k, F.current_timestamp())
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("bigint").alias("line"), c(F.col("l_quantity").cast("bigint").cast("string"), "int").alias("i"), c(F.concat(F.col("l_quantity").cast("bigint"), F.lit(".0")), "int").alias("f"), c(F.lit("12.5"), "int").alias("bad"), c(F.when(F.col("l_linenumber") % 2 == 1, "Yes").otherwise("off"), "bool").alias("b"))


@query("SELECT c_custkey AS id, '10.0.0.' || (c_custkey % 250)::VARCHAR AS v4, '2001:db8::' || printf('%x', (c_custkey % 60000 + 1)::BIGINT) AS v6, NULL::VARCHAR AS bad, '::ffff:102:304' AS mixed FROM customer")
def coerce_ip(spark, d):
    ip = net.canonical_ip
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), ip(F.expr("concat(' 10.0.0.', c_custkey % 250)")).alias("v4"), ip(F.expr("concat('2001:0DB8:0:0:0000:0:0:', lpad(hex(c_custkey % 60000 + 1), 4, '0'))")).alias("v6"), ip(F.lit("10.0.0.256")).alias("bad"), ip(F.lit("::FFFF:1.2.3.4")).alias("mixed"))


# ---- mapping, validation, routing -------------------------------------------------------------------------------
@query("SELECT event_id AS id, 'a=b c=\"' || event_type || '\"' AS msg, 'traffic' AS type, '0000000013' AS logid, 8::BIGINT AS n FROM events")
def unmapped_keep_all(spark, d):
    n = normalize.normalized(fortigate_lines(spark, d), only("fortigate_traffic"), F.lit("2026-11-26").cast("timestamp"))
    return n.select("id", *(F.try_element_at("unmapped", F.lit(c)).alias(c) for c in ("msg", "type", "logid")), F.size("unmapped").cast("bigint").alias("n"))


@query("SELECT event_id AS id, '198.51.100.1' AS nat, 'in' AS zone, 2::BIGINT AS n FROM events")
def unmapped_keep_list(spark, d):
    n = normalize.normalized(panos_lines(spark, d, 47), only("panos_traffic_v10"), F.lit("2026-11-26").cast("timestamp"))
    full = F.map_filter("unmapped", lambda _, v: v.isNotNull())
    return n.select("id", F.try_element_at("unmapped", F.lit("nat_src_ip")).alias("nat"), F.try_element_at("unmapped", F.lit("src_zone")).alias("zone"), F.size(full).cast("bigint").alias("n"))


@query(f"WITH {EV} SELECT 'invalid_ip' AS reason, 'normalize' AS stage, count(*)::BIGINT AS n FROM e WHERE k = 3 GROUP BY ALL HAVING count(*) > 0")
def dead_letter_reasons(spark, d):
    _, dead = validate.routed(normalize.normalized(vpc_lines(spark, d), only("aws_vpc_flow"), F.lit("2026-11-26").cast("timestamp")))
    return dead.groupBy("reason", "stage").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {EV} SELECT event_id AS id, true AS valid, 0::BIGINT AS errors, CASE WHEN k = 3 THEN 18 / 20 ELSE 1.0 END::DOUBLE AS completeness FROM e")
def completeness_by_class(spark, d):
    """Of the twenty attributes that the class asks for or recommends, the lines of an unknown action fill eighteen."""
    lines = iptables_lines(spark, d).withColumn("raw", F.concat("raw", F.lit(" rule=7").cast("binary")))
    v = validate.validated(normalize.normalized(lines, only("iptables"), F.lit("2026-11-26").cast("timestamp")))
    return v.select("id", "valid", F.size("errors").cast("bigint").alias("errors"), "completeness")


# ---- enrichment -------------------------------------------------------------------------------------------------
_ZONES = "CASE WHEN a = 10 AND b = 10 AND c = 20 THEN 'crown-jewels' WHEN a = 10 AND b = 10 THEN 'corp-servers' WHEN a = 10 THEN 'corp' END"


@query(f"WITH x AS (SELECT event_id AS id, 10 + event_id % 2 AS a, event_id % 20 AS b, event_id % 30 AS c FROM events) SELECT id, {_ZONES} AS zone, {_ZONES} AS joined, a = 10 AS is_private FROM x")
def zone_lpm(spark, d):
    rows = table(spark, d, "events").selectExpr("event_id as id", "concat(10 + event_id % 2, '.', event_id % 20, '.', event_id % 30, '.7') as ip")
    rows = rows.withColumn("c", enrich.network_context(F.col("ip"))).withColumn("key", net.ip_key(F.col("ip")))
    zones = spark.createDataFrame([(c, z) for c, z, _ in enrich.ZONES], "cidr string, joined string")
    return net.lpm_join(rows, "key", zones, "joined").select("id", F.col("c.zone").alias("zone"), "joined", F.col("c.is_private").alias("is_private"))


@query("SELECT event_id AS id, ['outbound', 'inbound', 'internal', 'transit'][event_id % 4 + 1] AS direction FROM events")
def direction(spark, d):
    src, dst = F.expr("elt(cast(event_id % 4 + 1 as int), '10.0.0.1', '8.8.8.8', '192.168.1.1', '203.0.113.9')"), F.expr("elt(cast(event_id % 4 + 1 as int), '1.1.1.1', '172.16.0.9', 'fd00::1', '2001:db8::1')")
    return table(spark, d, "events").select(F.col("event_id").alias("id"), enrich.direction(src, dst).alias("direction"))


@query("SELECT event_id AS id, CASE WHEN event_id % 250 + 1 = 99 THEN '203.0.113.99' WHEN event_id % 3 = 0 THEN 'evil.example' END AS indicator, CASE WHEN event_id % 250 + 1 = 99 THEN 'dst' WHEN event_id % 3 = 0 THEN 'host' END AS matched_on FROM events")
def ioc_first_hit(spark, d):
    rows = table(spark, d, "events").selectExpr("event_id as id", "concat('203.0.113.', event_id % 250 + 1) as dst", "case when event_id % 3 = 0 then 'A.b.EVIL.example.' else 'evil.org' end as host")
    iocs = spark.createDataFrame([*(("ip", i, "list", "high") for i in enrich.INDICATORS), ("domain", "evil.example", "list", "low")], "type string, indicator string, source string, confidence string")
    out = enrich.indicator_hits(rows, [("dst", "ip", F.col("dst")), ("host", "domain", F.col("host"))], iocs)
    return out.select("id", F.col("ioc.indicator").alias("indicator"), F.col("ioc.matched_on").alias("matched_on"))


@query("SELECT event_id AS id, CASE WHEN event_id % 4 = 0 THEN 'finding' WHEN event_id % 4 = 1 THEN 'listed' END AS source, CASE WHEN event_id % 4 = 0 THEN 'process.sha256' WHEN event_id % 4 = 1 THEN 'file.md5' END AS matched_on FROM events")
def ioc_hash(spark, d):
    """Digests of files and processes, in any case; most rows have none, and those don't meet in one task."""
    rows = table(spark, d, "events").selectExpr("event_id", "concat('e', event_id) as event_uid", "if(event_id % 4 = 0, upper(sha2(event_type, 256)), null) as sha", "if(event_id % 4 = 1, md5(event_type), if(event_id % 4 = 2, md5('other'), null)) as md5")
    kinds = table(spark, d, "events").select("event_type").distinct()
    iocs = kinds.select(F.lit("hash").alias("type"), F.sha2("event_type", 256).alias("indicator"), F.lit("finding").alias("source"), F.lit("high").alias("confidence")).union(kinds.select(F.lit("hash"), F.upper(F.md5("event_type")), F.lit("listed"), F.lit("low")))
    out = enrich.indicator_hits(rows, [("process.sha256", "hash", F.col("sha")), ("file.md5", "hash", F.col("md5"))], iocs)
    return out.select(F.col("event_id").alias("id"), F.col("ioc.ioc_source").alias("source"), F.col("ioc.matched_on").alias("matched_on"))


@query("SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN 'dst_endpoint.ip' WHEN event_id % 2 = 0 THEN 'proxy_endpoint.ip' WHEN event_id % 3 = 0 THEN 'device.hostname' WHEN event_id % 7 = 0 THEN 'dst_endpoint.hostname' END AS matched_on FROM events")
def ioc_all_hosts(spark, d):
    """Indicators of any address and any host of a record: addresses come first, source and destination before others."""
    ends = lambda **of: F.struct(*(F.expr(e).alias(k) for k, e in of.items()))
    record = F.struct(
        ends(ip="'10.0.0.1'", hostname="cast(null as string)").alias("src_endpoint"), ends(ip="if(event_id % 5 = 0, '198.51.100.7', '10.0.0.2')", hostname="if(event_id % 7 = 0, 'www.bad.example', null)").alias("dst_endpoint"),
        ends(ip="if(event_id % 2 = 0, '2001:db8::5', '10.9.9.9')").alias("proxy_endpoint"), ends(hostname="if(event_id % 3 = 0, 'Evil.example.', 'good.example')").alias("device"),
    )
    rows = dealt(table(spark, d, "events")).select("event_id", record.alias("ocsf"))
    listed = [("ip", "198.51.100.0/24"), ("ip", "2001:db8::5"), ("domain", "evil.example"), ("domain", "bad.example")]
    iocs = spark.createDataFrame([(t, i, "list", "high") for t, i in listed], "type string, indicator string, source string, confidence string")
    out = enrich.indicator_hits(rows, enrich.indicator_candidates(rows), iocs)
    return out.select(F.col("event_id").alias("id"), F.col("ioc.matched_on").alias("matched_on"))


@query(f"""WITH {EV} SELECT event_id AS id, 'corp-servers' AS proxy_zone, 'high' AS proxy_criticality, CASE WHEN k = 1 THEN 'dmz' END AS nat_zone, k = 1 AS has_nat, false AS has_other, CASE WHEN k = 1 THEN 4 ELSE 3 END::BIGINT AS n FROM e""")
def netctx_all(spark, d):
    """The context of every address of a record, among its unmapped entries too."""
    record = F.struct(F.struct(F.col("src").alias("ip")).alias("src_endpoint"), F.struct(F.col("dst").alias("ip")).alias("dst_endpoint"), F.struct(F.lit("10.10.3.4").alias("ip")).alias("proxy_endpoint"))
    rest = F.create_map(F.lit("nat"), F.when(F.col("k") == 1, "192.168.1.9"), F.lit("other"), F.lit("no address"))
    rows = _events(spark, d).select("event_id", "k", record.alias("ocsf"), rest.alias("unmapped"))
    rows = rows.select("event_id", enrich.keyed_contexts(rows).alias("c"))
    at = lambda key: F.try_element_at("c", F.lit(key))
    return rows.select(F.col("event_id").alias("id"), at("proxy_endpoint.ip")["zone"].alias("proxy_zone"), at("proxy_endpoint.ip")["criticality"].alias("proxy_criticality"), at("unmapped.nat")["zone"].alias("nat_zone"), at("unmapped.nat").isNotNull().alias("has_nat"), at("unmapped.other").isNotNull().alias("has_other"), F.size("c").cast("bigint").alias("n"))


@query(f"WITH {EV} SELECT event_id AS id, CASE WHEN k = 2 AND dport = 22 THEN 'T1110' WHEN k <> 2 AND dport = 8081 THEN 'T1571' END AS technique, CASE WHEN k = 2 AND dport = 22 THEN 'credential-access' WHEN k <> 2 AND dport = 8081 THEN 'command-and-control' END AS tactic FROM e")
def attack_tags(spark, d):
    n = normalize.normalized(fortigate_lines(spark, d), only("fortigate_traffic"), F.lit("2026-11-26").cast("timestamp"))
    t = n.select("id", enrich.techniques(lambda p: F.col(f"ocsf.{p}")).alias("t"))
    return t.select("id", F.array_join("t.technique_ids", ",").alias("technique"), F.array_join("t.tactics", ",").alias("tactic"))


# ---- crosswalks -------------------------------------------------------------------------------------------------
@query(f"WITH {EV} SELECT event_id AS id, src AS source_ip, rcvd::BIGINT + sent AS bytes, src || ',' || dst AS related, 'tcp' AS transport, '7' AS rule_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000000Z' AS at FROM e")
def ecs_projection(spark, d):
    n = normalize.normalized(fortigate_lines(spark, d), only("fortigate_traffic"), F.lit("2026-11-26").cast("timestamp"))
    return n.select("id", crosswalk.ecs().alias("x")).select("id", F.col("x.source.ip").alias("source_ip"), F.col("x.network.bytes").alias("bytes"), F.array_join("x.related.ip", ",").alias("related"), F.col("x.network.transport").alias("transport"), F.col("x.rule.id").alias("rule_id"), F.col("x.`@timestamp`").alias("at"))


@query(f"WITH {EV} SELECT event_id AS id, 'Network_Traffic' AS model, CASE WHEN k = 2 THEN 'blocked' ELSE 'allowed' END AS action, dst AS dest, rcvd::BIGINT + sent AS bytes, 'Fortinet FortiGate' AS product FROM e")
def cim_traffic(spark, d):
    n = normalize.normalized(fortigate_lines(spark, d), only("fortigate_traffic"), F.lit("2026-11-26").cast("timestamp"))
    return n.select("id", crosswalk.cim().alias("x")).select("id", F.col("x.datamodel").alias("model"), F.col("x.action").alias("action"), F.col("x.dest").alias("dest"), F.col("x.bytes").alias("bytes"), F.col("x.vendor_product").alias("product"))


# ---- lake -------------------------------------------------------------------------------------------------------
def _lake(spark, d) -> DataFrame:
    """Events in the lake's form, without lines."""
    return _events(spark, d).select("event_id", F.col("event_type").alias("source_type"), (F.unix_micros("ts") * 1000).alias("time"), F.col("src").alias("src_ip"), F.col("dst").alias("dst_ip"), F.col("sent").alias("bytes_out"), F.when(F.col("k") > 0, F.col("rcvd")).alias("bytes_in"))


@query(f"WITH {EV} SELECT event_type AS source_type, count(*)::BIGINT AS events, min(epoch_us(ts)) * 1000 AS first_time_ns, max(epoch_us(ts)) * 1000 AS last_time_ns, sum(sent + CASE WHEN k > 0 THEN rcvd ELSE 0 END)::BIGINT AS total_bytes, count(DISTINCT src)::BIGINT AS distinct_src_ip FROM e GROUP BY 1")
def stats_by_source(spark, d):
    return lake.stats_by_source(_lake(spark, d))


@query("WITH s AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS b, event_type AS source_type FROM events), m AS (SELECT max(b) AS newest FROM s) SELECT strftime(b, '%Y-%m-%dT%H:%M:%S') AS bucket, source_type, count(*)::BIGINT AS events FROM s, m WHERE b >= newest - INTERVAL 3 DAY GROUP BY b, source_type")
def timeseries(spark, d):
    return lake.timeseries(_lake(spark, d), "6 hours", "3 days")


@query("SELECT event_id, event_type AS source_type, epoch_us(ts) * 1000 AS time FROM events ORDER BY ts DESC, event_id LIMIT 100")
def recent(spark, d):
    return lake.recent(_lake(spark, d), 100, "event_id").select("event_id", "source_type", "time")


@query(f"WITH {EV} SELECT event_id, src AS src_ip, epoch_us(ts) * 1000 AS time FROM e WHERE event_type = 'purchase' AND ts >= (SELECT max(ts) - INTERVAL 2 DAY FROM events) ORDER BY ts DESC, event_id LIMIT 10000")
def search(spark, d):
    rows = _lake(spark, d)
    newest = rows.agg(F.max("time")).first()[0] or 0
    return lake.search(rows, since_ns=newest - 2 * 86_400_000_000_000, limit=10_000, tie="event_id", source_type="purchase").select("event_id", "src_ip", "time")


@query("WITH x AS (SELECT event_id, event_type AS reason, CASE WHEN event_id % 2 = 0 THEN 'parse' ELSE 'normalize' END AS stage, event_id % 5 = 0 AS done FROM events) SELECT reason, stage, count(*)::BIGINT AS total, sum(done::INT)::BIGINT AS resolved FROM x GROUP BY GROUPING SETS ((reason), (stage), ())")
def dlq_stats(spark, d):
    e = table(spark, d, "events").selectExpr("event_id as event_uid", "event_type as reason", "case when event_id % 2 = 0 then 'parse' else 'normalize' end as stage")
    return lake.dead_letter_stats(e, e.where("event_uid % 5 = 0").select("event_uid"))


def _dead(spark, d) -> DataFrame:
    return dealt(table(spark, d, "events")).selectExpr("event_id as event_uid", "event_type as reason", "case when event_id % 2 = 0 then 'parse' else 'normalize' end as stage", "unix_micros(ts) as ts_ns")


@query("SELECT event_id AS event_uid, event_type AS reason FROM events ORDER BY ts DESC, event_id LIMIT 50")
def dlq_recent(spark, d):
    return lake.recent_dead_letters(_dead(spark, d), 50).select("event_uid", "reason")


@query("SELECT event_type AS reason, CASE WHEN event_id % 2 = 0 THEN 'parse' ELSE 'normalize' END AS stage, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def dlq_counts(spark, d):
    return lake.dead_letter_counts(_dead(spark, d))


@query("SELECT event_id AS event_uid, event_type AS reason FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) <= 5")
def dlq_sample(spark, d):
    return lake.dead_letter_sample(_dead(spark, d)).select("event_uid", "reason")


@query("SELECT event_id AS id, CASE WHEN event_id % 250 = 7 OR (event_id % 20 = 3 AND event_id % 128 = 7) THEN '10.9.3.7' WHEN event_id % 20 = 3 THEN '10.9.3.0/25' WHEN event_id % 20 < 5 THEN '10.9.0.0/16' WHEN event_id % 2 = 0 THEN '2001:db8::/33' END AS indicator FROM events")
def ioc_cidr(spark, d):
    ip = F.expr("case when event_id % 250 = 7 then '10.9.3.7' when event_id % 20 < 5 then concat('10.9.', event_id % 20, '.', event_id % 128) when event_id % 2 = 0 then '2001:db8:7000::1' else '2001:db8:8000::1' end")
    rows = table(spark, d, "events").select(F.col("event_id").alias("id"), ip.alias("src"))
    iocs = spark.createDataFrame([("ip", c, "list", "high") for c in ("10.9.3.7", "10.9.3.0/25", "10.9.0.0/16", "2001:db8::/33")], "type string, indicator string, source string, confidence string")
    return enrich.indicator_hits(rows, [("src", "ip", F.col("src"))], iocs).select("id", F.col("ioc.indicator").alias("indicator"))


@query("SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'NL' WHEN 1 THEN 'DE' WHEN 2 THEN 'FR' END AS country, CASE event_id % 4 WHEN 0 THEN 64500 WHEN 1 THEN 64501 WHEN 2 THEN 64502 END::BIGINT AS asn FROM events")
def geo_lookup(spark, d):
    ip = F.expr("elt(cast(event_id % 4 + 1 as int), concat('198.51.100.', event_id % 128), concat('198.51.100.', 128 + event_id % 128), '2001:db8:5::1', '192.0.2.1')")
    networks = spark.createDataFrame([("198.51.100.0/24", "NL", 64500), ("198.51.100.128/25", "DE", 64501), ("2001:db8::/32", "FR", 64502)], "cidr string, country string, asn long")
    out = enrich.located(table(spark, d, "events").select(F.col("event_id").alias("id"), ip.alias("ip")), "ip", networks)
    return out.select("id", "location.country", "location.asn")


# ---- integrity --------------------------------------------------------------------------------------------------
def _batched(spark, d, size: int) -> DataFrame:
    e = table(spark, d, "events").select(F.col("event_id").alias("event_uid"), F.concat_ws("|", "event_id", "event_type").cast("binary").alias("raw")).withColumn("raw_hash", F.sha2("raw", 256))
    return integrity.batches(integrity.numbered(e, ["event_uid"]), "ordinal", size)


def _chain_sql(size: int) -> str:
    """Batches' roots level by level, then the chain over them."""
    return f"""WITH RECURSIVE l AS (SELECT (row_number() OVER (ORDER BY event_id) - 1) AS o, sha256(event_id::VARCHAR || '|' || event_type) AS h FROM events),
t(seq, x, n) AS (SELECT o // {size}, list(h ORDER BY o), count(*) FROM l GROUP BY 1
  UNION ALL SELECT seq, list_transform(range(0, (len(x) + 1) // 2), lambda i: sha256(unhex(x[2 * i + 1] || coalesce(x[2 * i + 2], x[2 * i + 1])))), n FROM t WHERE len(x) > 1),
b AS (SELECT seq, n, x[1] AS root FROM t WHERE len(x) = 1),
c(seq, n, root, prev, chained) AS (SELECT seq, n, root, repeat('00', 32), sha256(unhex(repeat('00', 32) || root)) FROM b WHERE seq = 0
  UNION ALL SELECT b.seq, b.n, b.root, c.chained, sha256(unhex(c.chained || b.root)) FROM c JOIN b ON b.seq = c.seq + 1)
SELECT seq::BIGINT AS seq, n::BIGINT AS leaf_count, """


@query("""WITH l AS (SELECT (row_number() OVER (ORDER BY event_id) - 1) AS o, sha256(event_id::VARCHAR || '|' || event_type) AS h FROM events),
a AS (SELECT o // 4 AS seq, list(h ORDER BY o) AS x FROM l GROUP BY 1),
p AS (SELECT seq, len(x)::BIGINT AS leaf_count, x, CASE WHEN len(x) = 1 THEN x ELSE [sha256(unhex(x[1] || x[2])), CASE WHEN len(x) = 2 THEN NULL ELSE sha256(unhex(x[3] || coalesce(x[4], x[3]))) END] END AS y FROM a)
SELECT seq, leaf_count, CASE WHEN leaf_count = 1 THEN y[1] WHEN leaf_count = 2 THEN y[1] ELSE sha256(unhex(y[1] || y[2])) END AS batch_root FROM p""")
def merkle_root_batches(spark, d):
    return integrity.sealed(_batched(spark, d, 4), size=4)


@query(_chain_sql(100) + "root AS batch_root, prev AS prev_chained_root, chained AS chained_root, NULL::VARCHAR AS reason FROM c")
def chain_fold(spark, d):
    return integrity.verify_chain(integrity.chained(integrity.sealed(_batched(spark, d, 100), size=100))).drop("signature")


@query(_chain_sql(100) + "CASE seq WHEN 3 THEN repeat('00', 32) ELSE root END AS batch_root, CASE seq WHEN 6 THEN repeat('00', 32) ELSE prev END AS prev_chained_root, chained AS chained_root, CASE seq WHEN 3 THEN 'root' WHEN 6 THEN 'link' WHEN 9 THEN 'sequence' END AS reason FROM c WHERE seq <> 8")
def verify_chain_lag(spark, d):
    """A chain with a changed root, a changed link and a lost entry."""
    c = integrity.chained(integrity.sealed(_batched(spark, d, 100), size=100)).drop("signature").where("seq <> 8")
    changed = lambda name, seq: F.when(F.col("seq") == seq, integrity.GENESIS).otherwise(F.col(name))
    return integrity.verify_chain(c.withColumn("batch_root", changed("batch_root", 3)).withColumn("prev_chained_root", changed("prev_chained_root", 6)))


@query("""WITH l AS (SELECT (row_number() OVER (ORDER BY event_id) - 1) AS o, sha256(event_id::VARCHAR || '|' || event_type) AS h FROM events),
a AS (SELECT o // 4 AS seq, list(h ORDER BY o) AS x FROM l GROUP BY 1),
p AS (SELECT seq, len(x) AS c, x, [sha256(unhex(x[1] || coalesce(x[2], x[1]))), sha256(unhex(coalesce(x[3], '') || coalesce(x[4], x[3], '')))] AS y FROM a), i AS (SELECT *, unnest(range(0, c)) AS i FROM p)
SELECT seq, i::BIGINT AS leaf_index, CASE WHEN c = 1 THEN '' ELSE CASE WHEN i % 2 = 0 THEN 'right:' || coalesce(x[i + 2], x[i + 1]) ELSE 'left:' || x[i] END || CASE WHEN c <= 2 THEN '' WHEN i < 2 THEN ',right:' || y[2] ELSE ',left:' || y[1] END END AS proof, true AS proved FROM i""")
def inclusion_proofs(spark, d):
    """The hashes of each event's path to its batch's root, and whether they lead there."""
    p = integrity.proofs(_batched(spark, d, 4), size=4)
    path = F.array_join(F.transform("proof", lambda s: F.concat(s["side"], F.lit(":"), s["sibling"])), ",")
    return p.select("seq", F.col("leaf_index").cast("bigint").alias("leaf_index"), path.alias("proof"), (integrity.proof_root(F.col("leaf"), F.col("proof")) == F.col("root")).alias("proved"))


@query("WITH o AS (SELECT event_id AS event_uid, (row_number() OVER (ORDER BY event_id) - 1) // 100 AS seq, event_id % 333 = 7 AS bad FROM events) SELECT event_uid, CASE WHEN bad THEN 'hash' WHEN bool_or(bad) OVER (PARTITION BY seq) THEN 'proof' END AS reason FROM o")
def tamper_detect(spark, d):
    b = _batched(spark, d, 100)
    ledger, index = integrity.sealed(b, size=100), b.select("event_uid", "seq", "leaf_index")
    now = b.select("event_uid", F.when(F.col("event_uid") % 333 == 7, F.concat("raw", F.lit("!").cast("binary"))).otherwise(F.col("raw")).alias("raw"), "raw_hash")
    return integrity.verify_events(now, index, ledger, 100).select("event_uid", "reason")


# ---- jobs -------------------------------------------------------------------------------------------------------
@query("SELECT event_id AS event_uid, CASE WHEN event_id % 3 = 0 THEN '1.0.0+reprocess-20260202' WHEN event_id % 3 = 1 THEN '1.0.0+reprocess-20260101' ELSE '1.0.0' END AS log_version FROM events")
def reprocess_latest_version(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("event_uid"))
    v = lambda rows, version, n: rows.select("event_uid", F.lit(version).alias("log_version"), F.lit(n).alias("written"))
    rows = v(e, "1.0.0", 1).union(v(e.where("event_uid % 3 <> 2"), "1.0.0+reprocess-20260101", 2)).union(v(e.where("event_uid % 3 = 0"), "1.0.0+reprocess-20260202", 3))
    return jobs.latest(rows).select("event_uid", "log_version")


@query("SELECT sum((event_id % 2 = 0 AND event_id % 10 <> 0)::INT)::BIGINT AS changed, sum((event_id % 2 = 1)::INT)::BIGINT AS unchanged, sum((event_id % 10 = 0)::INT)::BIGINT AS no_previous, 0.5::DOUBLE AS completeness_before, 0.75::DOUBLE AS completeness_after FROM events")
def reprocess_compare(spark, d):
    e = table(spark, d, "events")
    new = e.select(F.col("event_id").alias("event_uid"), "event_type", F.lit(0.75).alias("completeness"))
    old = e.where("event_id % 10 <> 0").select(F.col("event_id").alias("event_uid"), F.when(F.col("event_id") % 2 == 0, "x").otherwise(F.col("event_type")).alias("event_type"), F.lit(0.5).alias("completeness"))
    return jobs.compare(new, old)


@query("SELECT event_id AS event_uid FROM events WHERE event_id % 5 <> 0")
def dlq_unresolved(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("event_uid"))
    return lake.unresolved(e, e.where("event_uid % 5 = 0"))


@query("SELECT n_nationkey::BIGINT AS k, n_nationkey::VARCHAR AS v, NULL::VARCHAR AS more FROM nation UNION ALL SELECT r_regionkey::BIGINT, '\"' || r_name || '\"', r_name FROM region")
def compact_unify(spark, d):
    a = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("k"), F.col("n_nationkey").alias("v"))
    b = table(spark, d, "region").select(F.col("r_regionkey").cast("bigint").alias("k"), F.col("r_name").alias("v"), F.col("r_name").alias("more"))
    return lake.unify([a, b])


@query(f"""WITH {EV} SELECT 100.0::DOUBLE * sum((event_id % 50 <> 3)::INT) / count(*) AS byte_lossless, 100.0::DOUBLE AS reparse_stable, 100.0::DOUBLE AS renormalize_stable,
sum((k = 3 AND event_id % 40 <> 1)::INT)::BIGINT AS dead_letters, sum((event_id % 40 = 1)::INT)::BIGINT AS no_match FROM e""")
def roundtrip_rates(spark, d):
    """Of lines of which some were altered after they were hashed, and some are of no known source."""
    lines = vpc_lines(spark, d)
    text = F.when(F.col("id") % 40 == 1, F.lit("of no source")).otherwise(F.col("raw").cast("string"))
    lines = lines.withColumn("raw", text.cast("binary")).withColumn("raw_hash", F.sha2("raw", 256))
    altered = F.when(F.col("id") % 50 == 3, F.concat(F.col("raw").cast("string"), F.lit(" "))).otherwise(F.col("raw").cast("string"))
    return jobs.roundtrip(lines.withColumn("raw", altered.cast("binary")), only("aws_vpc_flow"), F.lit("2026-11-26").cast("timestamp"))


def _kv_rules(**fields) -> list[definition.Definition]:
    return [definition.read({
        "name": "plain", "detect": {"starts_with": "plain "}, "parse": {"engine": "kv", "envelope": "none"},
        "normalize": {"class_uid": 4001, "category_uid": 4, "activity_id": 6, "constants": {"severity_id": 1}, "fields": {"time": {"from": "at", "type": "timestamp"}} | fields},
    })]


@query("SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN 'invalid_int' ELSE 'required_unresolved' END AS reason, CASE WHEN event_id % 5 = 0 THEN 'dst_endpoint.port' ELSE 'src_endpoint.hostname' END AS target FROM events WHERE event_id % 3 = 0 OR event_id % 5 = 0")
def map_required_errors(spark, d):
    """Required attributes that no source gives, and values that aren't of their kind, by the first rule that fails."""
    line = F.expr("concat('plain at=1764151200 port=', if(event_id % 5 = 0, 'x', cast(event_id % 65536 as string)), if(event_id % 3 = 0, ' host=', ' host=h'), if(event_id % 3 = 0, '', cast(event_id as string)))")
    made = _kv_rules(**{"dst_endpoint.port": {"from": "port", "type": "int"}, "src_endpoint.hostname": {"from": ["host", "name"], "required": True}})
    _, dead = validate.routed(normalize.normalized(_lines(table(spark, d, "events"), line, "event_id"), made, F.lit("2026-11-26").cast("timestamp")))
    return dead.select(F.substring("event_uid", 2, 20).cast("bigint").alias("id"), "reason", F.get_json_object("detail", "$.target").alias("target"))


@query("""
SELECT event_id AS id, event_id % 4 = 0 AND event_id % 3 = 0 AND event_id % 7 > 0 AS valid, ((event_id % 4 > 0)::INT + (event_id % 3 > 0)::INT + (event_id % 7 = 0)::INT)::BIGINT AS errors, event_id % 4 > 0 AS port, event_id % 3 > 0 AS address, event_id % 7 = 0 AS time
FROM events""")
def validate_errors(spark, d):
    """Records with ports, addresses and times that can't be, one message for each."""
    line = F.expr("concat('plain at=', if(event_id % 7 = 0, 0, 1764151200), ' port=', if(event_id % 4 = 0, 443, 65536 + event_id), ' ip=', if(event_id % 3 = 0, '10.0.0.1', '10.0.0.256'), ' proto=tcp out=1')")
    made = _kv_rules(**{"dst_endpoint.port": {"from": "port", "type": "int"}, "src_endpoint.ip": {"from": "ip"}, "dst_endpoint.ip": {"from": "none", "default": "10.0.0.2"}, "connection_info.protocol_name": {"from": "proto"}, "traffic.bytes_out": {"from": "out", "type": "int"}})
    v = validate.validated(normalize.normalized(_lines(table(spark, d, "events"), line, "event_id"), made, F.lit("2026-11-26").cast("timestamp")))
    says = lambda word: F.exists("errors", lambda e: e.contains(word))
    return v.select("id", "valid", F.size("errors").cast("bigint").alias("errors"), says("not a port").alias("port"), says("not an address").alias("address"), says("time is").alias("time"))


@query("SELECT event_id, round(avg((event_id % 7 > 0)::INT) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW), 6) AS rate FROM events")
def rolling_rate(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type", (F.col("event_id") % 7 > 0).cast("int").alias("ok"))
    return jobs.rolling_rate(e, "event_id", "event_type", "ok").select("event_id", F.round("rate", 6).alias("rate"))


# ---- pass-through SQL -------------------------------------------------------------------------------------------
def _sql(name: str, sql: str, tables: str, oracle: str | None = None) -> None:
    def run(spark, d):
        text = sql
        for t in tables.split():
            spark.read.parquet(f"{d}/{t}.parquet").createOrReplaceTempView(f"lake_{t}")
            text = text.replace(f"{{{t}}}", f"lake_{t}")
        return readonly.query(spark, text, tables=[f"lake_{t}" for t in tables.split()])

    run.__name__ = name
    QUERIES[name] = run
    out = oracle or sql
    for t in tables.split():
        out = out.replace(f"{{{t}}}", t)
    ORACLE[name] = out


_sql("sql_inner_join", "SELECT o_orderpriority, count(*) AS n, cast(sum(cast(l_quantity AS bigint)) AS bigint) AS q FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey GROUP BY o_orderpriority", "orders lineitem")
_sql("sql_left_semi", "SELECT c_custkey FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 100000)", "customer orders")
_sql("sql_left_anti", "SELECT c_custkey FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey)", "customer orders")
_sql("sql_range_join", "SELECT r_regionkey, count(*) AS n FROM {region} JOIN {part} ON p_size BETWEEN r_regionkey * 10 AND r_regionkey * 10 + 9 GROUP BY r_regionkey", "region part")
_sql("sql_rank_window", "SELECT * FROM (SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM {orders}) AS t WHERE r <= 2", "orders")
_sql("sql_rolling_window", "SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS n FROM {events}", "events")
_sql("sql_grouping_sets", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())", "lineitem")
_sql("sql_cube", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)", "lineitem")
_sql("sql_rollup", "SELECT n_regionkey, n_nationkey, count(*) AS n FROM {nation} GROUP BY ROLLUP (n_regionkey, n_nationkey)", "nation")
_sql("sql_union", "SELECT n_name AS name FROM {nation} UNION SELECT r_name FROM {region}", "nation region")
_sql("sql_intersect", "SELECT o_custkey AS k FROM {orders} INTERSECT SELECT c_custkey FROM {customer} WHERE c_acctbal > 0", "orders customer")
_sql("sql_except", "SELECT c_custkey AS k FROM {customer} EXCEPT SELECT o_custkey FROM {orders}", "customer orders")


@query("SELECT e.event_id, (SELECT max(p.event_id) FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts) IS NOT NULL AS bought FROM events e WHERE e.event_type = 'click'")
def sql_asof(spark, d):
    e = table(spark, d, "events")
    w = Window.partitionBy("user_id").orderBy("ts").rangeBetween(Window.unboundedPreceding, 0)
    return e.withColumn("last", F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).over(w)).where("event_type = 'click'").select("event_id", F.col("last").isNotNull().alias("bought"))


@query()
def sql_approx_distinct(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id").alias("users"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FortiGate lines to per-source statistics: evidence, sniffing, routing, parsing, mapping, validation, core table."""
    good, _ = validate.routed(normalize.normalized(fortigate_lines(spark, sf_dir), only("fortigate_traffic"), F.lit("2026-11-26").cast("timestamp")))
    return lake.stats_by_source(normalize.core(good))


@query(f"WITH {EV} SELECT 'fortigate_traffic' AS source_type, count(*)::BIGINT AS events, min((epoch_us(ts) // 1000000)) * 1000000000 AS first_time_ns, max((epoch_us(ts) // 1000000)) * 1000000000 AS last_time_ns, sum(sent + rcvd)::BIGINT AS total_bytes, count(DISTINCT src)::BIGINT AS distinct_src_ip FROM e HAVING count(*) > 0")
def lines_to_stats(spark, d):
    return entry(spark, d)


# ---- more sources -----------------------------------------------------------------------------------------------
def _json_lines(spark, d, body: str) -> DataFrame:
    """Lines of Zeek's JSON with the usual ids around a body."""
    head = """concat('{"ts":', unix_seconds(ts), '.5,"uid":"C', event_id, '","id.orig_h":"', src, '","id.orig_p":', sport, ',"id.resp_h":"', dst, '","id.resp_p":', dport, ',', """
    return _lines(_events(spark, d), F.expr(f"{head}{body}, '}}')"), "event_id")


_ZEEK_SQL = "event_id AS id, NULL::VARCHAR AS reason, (epoch_us(ts) // 1000000) * 1000000000 + 500000000 AS time, 4::BIGINT AS category_uid, 1::BIGINT AS severity_id, NULL::BIGINT AS action_id, NULL::BIGINT AS bytes_in, NULL::BIGINT AS bytes_out"


@query(f"WITH {EV} SELECT {_ZEEK_SQL}, {_CORE_SQL}, 4003::BIGINT AS class_uid, 2::BIGINT AS activity_id, 400302::BIGINT AS type_uid, 'zeek_dns' AS source_type, 'udp' AS protocol, event_type || '.example' AS host, ['NoError', 'NXDomain', 'Refused', NULL][k + 1] AS rcode, k::BIGINT AS rcode_id, 'IN' AS cls FROM e")
def src_zeek_dns(spark, d):
    body = """'"proto":"udp","query":"', event_type, '.example","qtype_name":"A","qclass_name":"C_INTERNET","rcode":', k, ',"rcode_name":"', elt(cast(k + 1 as int), 'NOERROR', 'NXDOMAIN', 'REFUSED', 'odd'), '","answers":["a","b"]'"""
    return _source(_json_lines(spark, d, body), "zeek_dns", {"host": "query.hostname", "rcode": "rcode", "rcode_id": "rcode_id", "cls": "query.class"})


@query(f"WITH {EV} SELECT {_ZEEK_SQL}, {_CORE_SQL}, 4002::BIGINT AS class_uid, [3, 6, 7, 99][k + 1]::BIGINT AS activity_id, 400200 + [3, 6, 7, 99][k + 1]::BIGINT AS type_uid, 'zeek_http' AS source_type, NULL::VARCHAR AS protocol, '/' || event_type AS path, 200 + k::BIGINT AS code, ['Get', 'Post', 'Put', 'Other'][k + 1] AS activity_name FROM e")
def src_zeek_http(spark, d):
    body = """'"method":"', elt(cast(k + 1 as int), 'GET', 'POST', 'PUT', 'PATCH'), '","host":"h","uri":"/', event_type, '","status_code":', 200 + k, ',"response_body_len":', rcvd"""
    return _source(_json_lines(spark, d, body), "zeek_http", {"path": "http_request.url.path", "code": "http_response.code", "activity_name": "activity_name"})


@query(f"WITH {EV} SELECT event_id AS id, NULL::VARCHAR AS reason, (epoch_us(ts) // 1000000) * 1000000000 AS time, 4001::BIGINT AS class_uid, 4::BIGINT AS category_uid, [1, 6, 2, 6][k + 1]::BIGINT AS activity_id, 400100 + [1, 6, 2, 6][k + 1]::BIGINT AS type_uid, 1::BIGINT AS severity_id, 'suricata_eve_flow' AS source_type, {_CORE_SQL}, 'udp' AS protocol, 1::BIGINT AS action_id, rcvd::BIGINT AS bytes_in, sent AS bytes_out, '1b' AS flags FROM e")
def src_suricata_flow(spark, d):
    line = F.expr("""concat('{"timestamp":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+0000","event_type":"flow","src_ip":"', src, '","src_port":', sport, ',"dest_ip":"', dst, '","dest_port":', dport, ',"proto":"UDP","flow":{"state":"', elt(cast(k + 1 as int), 'new', 'established', 'closed', 'odd'), '","bytes_toserver":', sent, ',"bytes_toclient":', rcvd, '},"tcp":{"tcp_flags":"1b"}}')""")
    return _source(_lines(_events(spark, d), line, "event_id"), "suricata_eve_flow", {"flags": "connection_info.tcp_flags"})


# ---- more of the lake -------------------------------------------------------------------------------------------
@query("SELECT strftime(ts, '%Y-%m-%d') AS date, 'fortigate_traffic' AS source_type, count(*)::BIGINT AS n FROM events GROUP BY 1")
def silver_partition_counts(spark, d):
    n = normalize.normalized(fortigate_lines(spark, d), only("fortigate_traffic"), F.lit("2026-11-26").cast("timestamp"))
    return lake.silver(n).groupBy("date", "source_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {EV} SELECT event_id AS id, CASE WHEN k = 3 THEN 'invalid_ip' END AS reason, CASE WHEN k = 3 THEN '-' END AS src FROM e WHERE k = 3")
def dlq_rows(spark, d):
    _, dead = validate.routed(normalize.normalized(vpc_lines(spark, d), only("aws_vpc_flow"), F.lit("2026-11-26").cast("timestamp")))
    return dead.select(F.substring("event_uid", 2, 20).cast("bigint").alias("id"), "reason", F.get_json_object("detail", "$.parsed_fields.srcaddr").alias("src"))


@query(f"WITH {EV} SELECT event_id AS id, 'Outbound' AS direction, 2::BIGINT AS direction_id, 'edge-nat-pool' AS dst_zone FROM e")
def enrich_promote(spark, d):
    n = normalize.normalized(fortigate_lines(spark, d), only("fortigate_traffic"), F.lit("2026-11-26").cast("timestamp"))
    out = enrich.enriched(n)
    return out.select("id", F.col("ocsf.connection_info.direction").alias("direction"), F.col("ocsf.connection_info.direction_id").alias("direction_id"), F.col("enrichment.dst.zone").alias("dst_zone"))


@query(f"WITH {EV} SELECT event_id AS id, 'Intrusion_Detection' AS model, ['allowed', 'blocked', 'blocked', 'unknown'][k + 1] AS action, 'ET SCAN ' || event_type || ' sweep' AS signature, 'ids,attack' AS tags FROM e")
def cim_ids(spark, d):
    n = normalize.normalized(suricata_lines(spark, d), only("suricata_eve_alert"), F.lit("2026-11-26").cast("timestamp"))
    return n.select("id", crosswalk.cim().alias("x")).select("id", F.col("x.datamodel").alias("model"), F.col("x.action").alias("action"), F.col("x.signature").alias("signature"), F.array_join("x.tags", ",").alias("tags"))


@query("SELECT event_id AS id, [4, 4, 4, 6][event_id % 4 + 1]::BIGINT AS version, event_id % 4 = 0 AS private, event_id % 4 = 1 AS loopback_or_multicast, event_id % 4 >= 2 AS is_global FROM events")
def ip_flags(spark, d):
    ip = F.expr("elt(cast(event_id % 4 + 1 as int), '192.168.3.4', '127.0.0.1', '198.51.100.7', '2001:db8::9')")
    k = net.flags(net.ip_key(ip))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), k["ip_version"].cast("bigint").alias("version"), (k["is_private"] & ~k["is_loopback"]).alias("private"), (k["is_loopback"] | k["is_multicast"]).alias("loopback_or_multicast"), k["is_global"].alias("is_global"))


@query("SELECT event_id AS id, event_id % 2 = 0 AS hit, event_id % 2 = 1 AS other FROM events")
def detect_field_equals(spark, d):
    text = F.expr("case when event_id % 2 = 0 then concat('{\"event_type\":\"alert\",\"n\":', event_id, '}') else concat('<9>kind=x n=', event_id, ' z=1') end")
    rows = table(spark, d, "events").select(F.col("event_id").alias("id"), text.alias("t"))
    rows = rows.withColumn("payload", decode.envelope(F.col("t"))["message"]).withColumn("kind", decode.sniff_layered(F.col("t"))["inner"])
    rule = lambda n, v: detector({"field_equals": {"name": n, "value": v}}, F.col("t"))
    return rows.select("id", rule("event_type", "alert").alias("hit"), rule("kind", "x").alias("other"))


# ---- replay -----------------------------------------------------------------------------------------------------
@query(f"""WITH {EV} SELECT sum((k <> 3 OR event_id % 8 = 3)::INT)::BIGINT AS events, count(DISTINCT CASE WHEN k <> 3 OR event_id % 8 = 3 THEN event_id END)::BIGINT AS distinct_events,
sum((k = 3)::INT + (event_id % 8 = 7)::INT)::BIGINT AS dead_letters, sum((event_id % 8 = 3)::INT)::BIGINT AS resolved, sum((event_id % 8 = 7)::INT)::BIGINT AS open FROM e""")
def dlq_replay_unresolved(spark, d):
    """A lake whose dead letters are replayed under a definition that takes half of them: those are events and resolved, the others dead letters once more."""
    import uuid

    from stratalog.functions.shared import shared_folder

    root, now = f"{shared_folder(spark)}/replay-{uuid.uuid4().hex}", F.lit("2026-11-26").cast("timestamp")
    line = F.expr("concat('plain at=1764151200 proto=tcp out=1 ip=', if(event_id % 4 = 3, 'none', '10.0.0.1'), if(event_id % 8 = 3, ' alt=10.0.0.9', ''))")
    rest = {"dst_endpoint.ip": {"from": "none", "default": "10.0.0.2"}, "connection_info.protocol_name": {"from": "proto"}, "traffic.bytes_out": {"from": "out", "type": "int"}}
    jobs.ingest(_lines(dealt(table(spark, d, "events")), line, "event_id").drop("id"), _kv_rules(**{"src_endpoint.ip": {"from": "ip", "type": "ip"}}, **rest), root, now)
    jobs.replay(spark, root, _kv_rules(**{"src_endpoint.ip": {"from": ["alt", "ip"], "type": "ip"}}, **rest), 1, reference=now)
    events, dead, done = lake.read_silver(spark, f"{root}/silver"), lake.read_dead_letters(spark, f"{root}/deadletters"), lake.read_resolved(spark, f"{root}/resolved")
    counts = events.agg(F.count(F.lit(1)).alias("events"), F.count_distinct("event_uid").alias("distinct_events"))
    letters = dead.agg(F.count(F.lit(1)).alias("dead_letters"))
    open_ = lake.unresolved(dead, done).agg(F.count_distinct("event_uid").alias("open"))
    # tables of one row each
    return counts.join(letters, F.lit(True)).join(done.agg(F.count(F.lit(1)).alias("resolved")), F.lit(True)).join(open_, F.lit(True))


# ---- streams ----------------------------------------------------------------------------------------------------
def _streamed(spark, d, make, time=None, settings=None) -> DataFrame:
    """What a bounded stream over events gives, once it has read all of them and closed its windows."""
    from stratalog.streaming.ingest import drained

    source = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).format("parquet").option("pathGlobFilter", "*.parquet").load(f"{d}/events.parquet*")
    return drained(source.withColumn("ts", F.col("ts").cast("timestamp")), make, "stream", time, settings)


def _start() -> Column:
    return F.unix_seconds("w.start").alias("start_s")


@query("SELECT DISTINCT event_id FROM events")
def stream_dedup(spark, d):
    from stratalog.streaming.ingest import deduplicated

    return _streamed(spark, d, lambda e: deduplicated(e, "ts", "event_id").select("event_id"))


@query("SELECT epoch_us(ts) // 3600000000 * 3600 AS start_s, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def stream_tumbling(spark, d):
    from stratalog.streaming.ingest import tumbling

    return _streamed(spark, d, lambda e: tumbling(e, "ts", "1 hour", "event_type").select(_start(), "event_type", "n"), "ts")


@query("SELECT epoch_us(ts) // 1800000000 * 1800 - back AS start_s, event_type, count(*)::BIGINT AS n FROM events, (VALUES (0), (1800)) AS b(back) GROUP BY ALL")
def stream_sliding(spark, d):
    from stratalog.streaming.ingest import tumbling

    return _streamed(spark, d, lambda e: tumbling(e, "ts", "1 hour", "event_type", slide="30 minutes").select(_start(), "event_type", "n"), "ts")


@query("""
WITH p AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
s AS (SELECT user_id, ts, sum(CASE WHEN ts - before < INTERVAL 10 MINUTE THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM p)
SELECT epoch_us(min(ts)) // 1000000 AS start_s, user_id, count(*)::BIGINT AS n FROM s GROUP BY user_id, g""")
def stream_session(spark, d):
    from stratalog.streaming.ingest import sessions

    return _streamed(spark, d, lambda e: sessions(e, "ts", "10 minutes", "user_id").select(_start(), "user_id", "n"), "ts")


@query("""
WITH l AS (SELECT event_id % 4 AS lane, row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) - 1 AS o, event_id::VARCHAR AS uid, sha256(event_id::VARCHAR || '|' || event_type) AS h FROM events),
f AS (SELECT *, count(*) OVER (PARTITION BY lane) // 100 * 100 AS whole FROM l), s AS (SELECT lane, o // 100 AS number, h, o, uid FROM f WHERE o < whole),
t AS (WITH RECURSIVE t(lane, number, x, n, a, z) AS (SELECT lane, number, list(h ORDER BY o), count(*), min_by(uid, o), max_by(uid, o) FROM s GROUP BY ALL
  UNION ALL SELECT lane, number, list_transform(range(0, (len(x) + 1) // 2), lambda i: sha256(unhex(x[2 * i + 1] || coalesce(x[2 * i + 2], x[2 * i + 1])))), n, a, z FROM t WHERE len(x) > 1)
  SELECT * FROM t WHERE len(x) = 1)
SELECT lane::INTEGER AS lane, number::BIGINT AS number, 'size' AS reason, n::BIGINT AS leaf_count, x[1] AS batch_root, a AS first_event_uid, z AS last_event_uid FROM t""")
def stream_sealed(spark, d):
    """Batches of a hundred that a stream seals in each of four lanes; what is left waits in its state."""
    from stratalog.streaming import ingest, sealing

    def make(e):
        own = e.select(F.col("event_id").cast("string").alias("event_uid"), F.sha2(F.concat_ws("|", "event_id", "event_type"), 256).alias("raw_hash"), F.col("event_id").alias("ingest_time_ns"))
        return sealing.sealed_batches(own, size=100, wait_ms=3_600_000, lane=F.col("ingest_time_ns") % 4)

    found = sealing.roots(_streamed(spark, d, make, settings=ingest.NO_IDLE), 100)
    return found.select("lane", "number", "reason", "leaf_count", "batch_root", F.element_at("uids", 1).alias("first_event_uid"), F.element_at("uids", -1).alias("last_event_uid"))
