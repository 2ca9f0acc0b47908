"""Names, numbers and shapes of the normalized event schema (fixed values)."""

VERSION = "1.5.0"
CATEGORIES = {1: "System Activity", 2: "Findings", 3: "Identity & Access Management", 4: "Network Activity", 5: "Discovery", 6: "Application Activity", 7: "Remediation", 8: "Unmanned Systems"}
SEVERITIES = {0: "Unknown", 1: "Informational", 2: "Low", 3: "Medium", 4: "High", 5: "Critical", 6: "Fatal", 99: "Other"}
CLASSES = {
    1001: "File System Activity", 2004: "Detection Finding", 3002: "Authentication", 4001: "Network Activity", 4002: "HTTP Activity", 4003: "DNS Activity", 4004: "DHCP Activity",
    4005: "RDP Activity", 4006: "SMB Activity", 4007: "SSH Activity", 4008: "FTP Activity", 4009: "Email Activity", 4013: "NTP Activity", 6003: "API Activity",
}
ACTIVITIES = {
    4001: {0: "Unknown", 1: "Open", 2: "Close", 3: "Reset", 4: "Fail", 5: "Refuse", 6: "Traffic", 99: "Other"},
    4002: {0: "Unknown", 1: "Connect", 2: "Delete", 3: "Get", 4: "Head", 5: "Options", 6: "Post", 7: "Put", 8: "Trace", 99: "Other"},
    4003: {0: "Unknown", 1: "Query", 2: "Response", 6: "Traffic", 99: "Other"},
    3002: {0: "Unknown", 1: "Logon", 2: "Logoff", 3: "Authentication Ticket", 99: "Other"},
    2004: {0: "Unknown", 1: "Create", 2: "Update", 3: "Close", 99: "Other"},
}
SCALARS = ("class_uid", "category_uid", "activity_id", "type_uid", "severity_id", "time")
_NAMES = ("status_id", "severity", "activity_name", "type_name", "unmapped")
#: class: (category, required objects, recommended attributes)
SHAPES = {
    4001: (4, ("metadata", "src_endpoint"), ("dst_endpoint", "connection_info", "traffic", "firewall_rule", "action", "action_id", "disposition", *_NAMES)),
    4002: (4, ("metadata", "http_request", "src_endpoint"), ("http_response", "dst_endpoint", *_NAMES)),
    4003: (4, ("metadata", "query", "src_endpoint"), ("dst_endpoint", "answers", "rcode", "rcode_id", "response_time", *_NAMES)),
    2004: (2, ("metadata", "finding_info"), ("src_endpoint", "dst_endpoint", "confidence_id", "confidence", "risk_level_id", "risk_level", "evidences", *_NAMES)),
}
RCODES = tuple(range(26))
ACTIONS = (0, 1, 2, 3, 4, 99)
#: Columns of the lake's event table that are always there, with their types.
CORE = {
    "event_uid": "string", "raw_hash": "string", "time": "bigint", "class_uid": "bigint", "category_uid": "bigint", "activity_id": "bigint", "type_uid": "bigint", "severity_id": "bigint",
    "source_type": "string", "src_ip": "string", "src_port": "bigint", "dst_ip": "string", "dst_port": "bigint", "protocol": "string", "action_id": "bigint", "bytes_in": "bigint", "bytes_out": "bigint",
}
