"""Definitions of eleven common perimeter sources. Names, numbers and look-ups are fixed values of those formats."""

from __future__ import annotations

from stratalog.operators.definition import Definition, read


def _f(source, kind="str", **more):
    return {"from": source, "type": kind, **more}


def _m(source, table, default=None):
    return {"from": source, "map": table, "default": default}


def _ends(src, sport, dst, dport):
    """Both endpoints; their addresses are required."""
    return {"src_endpoint.ip": _f(src, "ip", required=True), "src_endpoint.port": _f(sport, "int"), "dst_endpoint.ip": _f(dst, "ip", required=True), "dst_endpoint.port": _f(dport, "int")}


def _each(table, *groups):
    """{value: name for each name of its group}."""
    return {k: v for names, v in zip(groups, table, strict=True) for k in names.split()}


def _source(name, priority, product, detect, engine, class_uid, activity, constants, fields, options=None, envelope="none", unmapped="keep_all"):
    vendor, title = product
    both = {"metadata.product.vendor_name": vendor, "metadata.product.name": title, **constants}
    return {
        "name": name, "version": "1.0.0", "vendor": vendor, "product": title, "priority": priority, "detect": detect, "parse": {"envelope": envelope, "engine": engine, "options": options or {}},
        "normalize": {"class_uid": class_uid, "category_uid": class_uid // 1000, "activity_id": activity, "constants": both, "fields": fields, "unmapped": unmapped},
        "validate": {"on_failure": "dead_letter"},
    }


def _both(*texts):
    return {"all": [{"contains": t} for t in texts]}


_SEEN = {"severity_id": 1, "status_id": 1}
_ZEEK = ("The Zeek Project", "Zeek")
_ZEEK_ENDS = _ends("id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p")
_TIME = {"time": _f("ts", "timestamp", required=True)}

ZEEK_CONN = _source(
    "zeek_conn", 15, _ZEEK, _both('"uid"', '"conn_state"'), "json", 4001,
    {"from": "conn_state", "map": {"S0": 4, "S1": 1, "S2": 1, "S3": 1, "SF": 2, "REJ": 5, "RSTO": 3, "RSTR": 3, "RSTOS0": 3, "RSTRH": 3, "SH": 4, "SHR": 4, "OTH": 6}, "default": 6},
    {**_SEEN, "action_id": 1, "action": "Allowed"},
    {
        **_ZEEK_ENDS, "app_name": _f("service"), "connection_info.uid": _f("uid"), "connection_info.protocol_num": _m("proto", {"tcp": 6, "udp": 17, "icmp": 1}, 0),
        "connection_info.protocol_name": _m("proto", {"tcp": "tcp", "udp": "udp", "icmp": "icmp"}), "traffic.bytes_out": _f("orig_bytes", "int"), "traffic.bytes_in": _f("resp_bytes", "int"),
        "traffic.packets_out": _f("orig_pkts", "int"), "traffic.packets_in": _f("resp_pkts", "int"), **_TIME,
    },
)
ZEEK_DNS = _source(
    "zeek_dns", 15, _ZEEK, _both('"uid"', '"query"'), "json", 4003, 2, _SEEN,
    {
        **_ZEEK_ENDS, "query.hostname": _f("query", required=True), "query.type": _f("qtype_name"), "query.class": _m("qclass_name", {"C_INTERNET": "IN", "C_CHAOS": "CH", "C_HS": "HS", "C_NONE": "NONE", "C_ANY": "ANY"}),
        "rcode_id": _f("rcode", "int"), "rcode": _m("rcode_name", {"NOERROR": "NoError", "FORMERR": "FormError", "SERVFAIL": "ServError", "NXDOMAIN": "NXDomain", "NOTIMP": "NotImp", "REFUSED": "Refused"}),
        "connection_info.uid": _f("uid"), "connection_info.protocol_num": _m("proto", {"tcp": 6, "udp": 17}, 0), "connection_info.protocol_name": _m("proto", {"tcp": "tcp", "udp": "udp"}), **_TIME,
    },
)
ZEEK_HTTP = _source(
    "zeek_http", 15, _ZEEK, _both('"uid"', '"uri"'), "json", 4002,
    {"from": "method", "map": {m: i for i, m in enumerate("CONNECT DELETE GET HEAD OPTIONS POST PUT TRACE".split(), 1)}, "default": 99},
    {**_SEEN, "http_request.url.scheme": "http"},
    {
        **_ZEEK_ENDS, "http_request.http_method": _f("method"), "http_request.version": _f("version"), "http_request.user_agent": _f("user_agent"), "http_request.referrer": _f("referrer"),
        "http_request.url.hostname": _f("host"), "http_request.url.path": _f("uri"), "http_response.code": _f("status_code", "int"), "http_response.length": _f("response_body_len", "int"), "connection_info.uid": _f("uid"), **_TIME,
    },
)


def _suricata(kind):
    return {"all": [{"contains": '"event_type"'}, {"field_equals": {"name": "event_type", "value": kind}}]}


_SURICATA_ENDS = _ends("src_ip", "src_port", "dest_ip", "dest_port")
_STAMP = {"time": _f("timestamp", "timestamp", required=True)}
SURICATA_ALERT = _source(
    "suricata_eve_alert", 15, ("OISF", "Suricata"), _suricata("alert"), "json", 2004, 1,
    {"status_id": 1, "finding_info.analytic.name": "Suricata", "finding_info.analytic.type": "Rule", "finding_info.analytic.type_id": 1},
    {
        "finding_info.uid": _f("alert.signature_id", required=True), "finding_info.title": _f("alert.signature"), "finding_info.types": _f("alert.category"),
        "severity_id": _m("alert.severity", {"1": 4, "2": 3, "3": 2, "4": 1}, 3), "action_id": _m("alert.action", _each((1, 2), "allowed pass", "blocked dropped drop reject"), 0),
        "action": _m("alert.action", _each(("Allowed", "Denied"), "allowed pass", "blocked dropped drop reject"), "Unknown"),
        "disposition": _m("alert.action", _each(("Allowed", "Blocked", "Dropped"), "allowed", "blocked reject", "dropped drop")), **_SURICATA_ENDS, **_STAMP,
    },
)
_NUM, _NAME = {"TCP": 6, "UDP": 17, "ICMP": 1, "6": 6, "17": 17, "1": 1}, {"TCP": "tcp", "UDP": "udp", "ICMP": "icmp", "6": "tcp", "17": "udp", "1": "icmp"}
_LOW = lambda t: {k.lower(): v for k, v in t.items()}
SURICATA_FLOW = _source(
    "suricata_eve_flow", 15, ("OISF", "Suricata"), _suricata("flow"), "json", 4001,
    {"from": "flow.state", "map": {"new": 1, "established": 6, "closed": 2, "bypassed": 6, "local_bypassed": 6}, "default": 6}, {**_SEEN, "action_id": 1, "action": "Allowed"},
    {
        **_SURICATA_ENDS, "app_name": _f("app_proto"), "connection_info.uid": _f("flow_id"), "connection_info.tcp_flags": _f("tcp.tcp_flags"), "connection_info.protocol_num": _m("proto", _NUM, 0),
        "connection_info.protocol_name": _m("proto", _NAME), "traffic.bytes_out": _f("flow.bytes_toserver", "int"), "traffic.bytes_in": _f("flow.bytes_toclient", "int"),
        "traffic.packets_out": _f("flow.pkts_toserver", "int"), "traffic.packets_in": _f("flow.pkts_toclient", "int"), **_STAMP,
    },
)

_ASA = {
    "IFACE": r"[^\s:]+",
    "ASA_PROTO": "(?:[A-Za-z]+|[0-9]{1,3})",
    "ASA_SRC": "%{IFACE:src_iface}:%{IP:src_ip}/%{INT:src_port}",
    "ASA_DST": "%{IFACE:dst_iface}:%{IP:dst_ip}/%{INT:dst_port}",
    "ASA_XSRC": r"\(%{IP:xlate_src_ip}/%{INT:xlate_src_port}\)",
    "ASA_XDST": r"\(%{IP:xlate_dst_ip}/%{INT:xlate_dst_port}\)",
    "ASA_CONN": "%{ASA_PROTO:proto} connection %{INT:conn_id} for",
    "ASA_OUT": r"Built (?=outbound )%{WORD:asa_direction} %{ASA_CONN} %{ASA_DST} %{ASA_XDST} to %{ASA_SRC} %{ASA_XSRC}",
    "ASA_IN": r"Built (?=inbound )%{WORD:asa_direction} %{ASA_CONN} %{ASA_SRC} %{ASA_XSRC} to %{ASA_DST} %{ASA_XDST}",
    "ASA_DOWN": "Teardown %{ASA_CONN} %{ASA_DST} to %{ASA_SRC} duration %{NOTSPACE:duration} bytes %{INT:bytes}(?: %{GREEDYDATA:teardown_reason})?",
    "ASA_DENY": r'Deny %{ASA_PROTO:proto} src %{IFACE:src_iface}:%{IP:src_ip}(?:/%{INT:src_port})? dst %{IFACE:dst_iface}:%{IP:dst_ip}(?:/%{INT:dst_port})? by access-group "%{DATA:acl_name}" \[%{DATA:acl_hash}\]',
}
CISCO_ASA = _source(
    "cisco_asa", 20, ("Cisco", "Cisco ASA"), {"regex": r"%ASA-\d-(?:302013|302014|106023):"}, "grok", 4001, {"from": "event_code", "map": {"302013": 1, "302014": 2, "106023": 6}, "default": 0}, {"status_id": 1},
    {
        "metadata.event_code": _f("event_code"), **_ends("src_ip", "src_port", "dst_ip", "dst_port"), "connection_info.uid": _f("conn_id"),
        "connection_info.protocol_name": _m("proto", {**_NAME, **_LOW(_NAME)}), "connection_info.protocol_num": _m("proto", {**_NUM, **_LOW(_NUM), "GRE": 47, "gre": 47, "ESP": 50, "esp": 50, "47": 47, "50": 50}, 0),
        "connection_info.direction_id": _m("asa_direction", {"outbound": 2, "inbound": 1}, 0), "connection_info.direction": _m("asa_direction", {"outbound": "Outbound", "inbound": "Inbound"}, "Unknown"),
        "severity_id": _m("asa_severity", {"0": 6, "1": 5, "2": 5, "3": 4, "4": 3, "5": 2, "6": 1, "7": 1}, 1), "activity_name": _m("event_code", {"302013": "Open", "302014": "Close", "106023": "Traffic"}, "Unknown"),
        "action_id": _m("event_code", {"106023": 2}, 1), "action": _m("event_code", {"106023": "Denied"}, "Allowed"), "disposition": _m("event_code", {"106023": "Blocked"}, "Allowed"),
        "firewall_rule.name": _f("acl_name"), "traffic.bytes": _f("bytes", "int"), **_TIME,
    },
    {"patterns": _ASA, "pattern": "%{SYSLOGTIMESTAMP:ts} %{HOSTNAME:fw_host} %ASA-%{INT:asa_severity}-%{INT:event_code}: (?:%{ASA_OUT}|%{ASA_IN}|%{ASA_DOWN}|%{ASA_DENY})"},
)

_FG = ("accept start", "close timeout", "deny", "server-rst client-rst")
FORTIGATE = _source(
    "fortigate_traffic", 20, ("Fortinet", "FortiGate"), {"all": [{"contains": "logid="}, {"regex": r'\btype="?traffic"?'}]}, "kv", 4001, {"from": "action", "map": _each((1, 2, 6, 3), *_FG), "default": 0}, {"status_id": 1},
    {
        **_ends("srcip", "srcport", "dstip", "dstport"), "src_endpoint.interface_name": _f("srcintf"), "dst_endpoint.interface_name": _f("dstintf"), "connection_info.uid": _f("sessionid"),
        "connection_info.protocol_num": _f("proto", "int"), "connection_info.protocol_name": _m("proto", {"6": "TCP", "17": "UDP", "1": "ICMP"}), "action_id": _m("action", _each((1, 1, 2, 1), *_FG), 0),
        "action": _m("action", _each(("Allowed", "Allowed", "Denied", "Allowed"), *_FG), "Unknown"), "activity_name": _m("action", _each(("Open", "Close", "Traffic", "Reset"), *_FG), "Unknown"),
        "disposition": _m("action", _each(("Allowed", "Blocked", "Reset"), "accept close", *_FG[2:])), "traffic.bytes_out": _f("sentbyte", "int"), "traffic.bytes_in": _f("rcvdbyte", "int"),
        "traffic.packets_out": _f("sentpkt", "int"), "traffic.packets_in": _f("rcvdpkt", "int"), "firewall_rule.uid": _f("policyid"),
        "severity_id": _m("level", _each((6, 5, 4, 3, 1), "emergency", "alert critical", "error", "warning", "notification notice information informational debug"), 1),
        "time": _f(["date", "time"], "timestamp", join=" ", format="%Y-%m-%d %H:%M:%S", tz="UTC", required=True),
    },
    envelope="syslog",
)

_RESETS = "reset-both reset-client reset-server"


def _panos(name, version, columns):
    return _source(
        name, 20, ("Palo Alto Networks", "PAN-OS"), {"all": [{"contains": ",TRAFFIC,"}, {"regex": r"\d{4}/\d{2}/\d{2}[ T]\d{2}:\d{2}:\d{2},\d+,TRAFFIC,"}, {"field_count": {"delimiter": ",", "equals": columns}}]}, "csv", 4001, 6, _SEEN,
        {
            **_ends("src_ip", "src_port", "dst_ip", "dst_port"), "app_name": _f("app"), "connection_info.uid": _f("session_id"), "connection_info.protocol_name": _m("protocol", _LOW(_NAME)), "connection_info.protocol_num": _m("protocol", _LOW(_NUM), 0),
            "action_id": _m("action", _each((1, 2), "allow", f"deny drop {_RESETS}"), 0), "action": _m("action", _each(("Allowed", "Denied"), "allow", f"deny drop {_RESETS}"), "Unknown"),
            "disposition": _m("action", _each(("Allowed", "Blocked", "Dropped", "Reset"), "allow", "deny", "drop", _RESETS)), "firewall_rule.name": _f("rule_name"), "traffic.bytes_out": _f("bytes_sent", "int"),
            "traffic.bytes_in": _f("bytes_received", "int"), "traffic.packets": _f("packets", "int"), "traffic.packets_out": _f("packets_sent", "int"), "traffic.packets_in": _f("packets_received", "int"),
            "time": _f("generated_time", "timestamp", format="%Y/%m/%d %H:%M:%S", tz="UTC", required=True),
        },
        {"column_map": {"product": "panos_traffic", "version": version}}, "syslog", ["nat_src_ip", "nat_dst_ip", "nat_src_port", "nat_dst_port", "src_zone", "dst_zone"],
    )


_DROP, _PASS = ("drop DROP reject REJECT", "deny DENY block BLOCK"), "accept ACCEPT allow ALLOW pass PASS"
_VERDICT = ["act", "action", "prefix"]
IPTABLES = _source(
    "iptables", 30, ("Linux", "netfilter"), _both("SRC=", "DST=", "PROTO="), "kv", 4001, 6, _SEEN,
    {
        **_ends("SRC", "SPT", "DST", "DPT"), "src_endpoint.interface_name": _f("IN"), "dst_endpoint.interface_name": _f("OUT"), "connection_info.protocol_name": _m("PROTO", {**_NAME, "ICMPV6": "ipv6-icmp"}),
        "connection_info.protocol_num": _m("PROTO", {**_NUM, "ICMPV6": 58, "58": 58}, 0), "action_id": _m(_VERDICT, _each((2, 2, 1), *_DROP, _PASS), 0), "action": _m(_VERDICT, _each(("Denied", "Denied", "Allowed"), *_DROP, _PASS)),
        "disposition": _m(_VERDICT, _each(("Dropped", "Blocked", "Allowed"), *_DROP, _PASS)), "firewall_rule.uid": _f("rule"), "firewall_rule.name": _f("chain"), "traffic.bytes": _f("LEN", "int"),
        "time": _f("envelope.timestamp", "timestamp", required=True),
    },
    envelope="syslog",
)
AWS_VPC_FLOW = _source(
    "aws_vpc_flow", 30, ("Amazon Web Services", "VPC Flow Logs"), {"all": [{"starts_with": "2 "}, {"regex": r"^2 \d{12} eni-[0-9a-f]+ "}]}, "csv", 4001, 6, {"severity_id": 1},
    {
        **_ends("srcaddr", "srcport", "dstaddr", "dstport"), "connection_info.protocol_num": _f("protocol", "int"), "connection_info.protocol_name": _m("protocol", {"6": "tcp", "17": "udp", "1": "icmp", "58": "ipv6-icmp", "47": "gre", "50": "esp"}),
        "action_id": _m("action", {"ACCEPT": 1, "REJECT": 2}, 0), "action": _m("action", {"ACCEPT": "Allowed", "REJECT": "Denied"}), "disposition": _m("action", {"ACCEPT": "Allowed", "REJECT": "Blocked"}),
        "status_id": _m("log_status", {"OK": 1, "NODATA": 0, "SKIPDATA": 2}, 0), "traffic.bytes": _f("bytes", "int"), "traffic.packets": _f("packets", "int"), "time": _f("start", "timestamp", required=True),
    },
    {"delimiter": " ", "columns": "version account_id interface_id srcaddr dstaddr srcport dstport protocol packets bytes start end action log_status".split()},
)

RAW = (SURICATA_ALERT, SURICATA_FLOW, ZEEK_CONN, ZEEK_DNS, ZEEK_HTTP, CISCO_ASA, FORTIGATE, _panos("panos_traffic_v10", "10.1", 47), _panos("panos_traffic_v11", "11.0", 51), AWS_VPC_FLOW, IPTABLES)


def definitions() -> list[Definition]:
    return sorted(map(read, RAW), key=lambda d: (d.priority, d.name))
