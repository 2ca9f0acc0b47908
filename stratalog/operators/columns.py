"""Column orders of versioned CSV logs (fixed values)."""

_V10 = (
    "future_use_1 receive_time serial_number type threat_content_type future_use_2 generated_time src_ip dst_ip nat_src_ip nat_dst_ip "
    "rule_name src_user dst_user app vsys src_zone dst_zone ingress_interface egress_interface log_action future_use_3 session_id "
    "repeat_count src_port dst_port nat_src_port nat_dst_port flags protocol action bytes bytes_sent bytes_received packets start_time "
    "elapsed_time category future_use_4 sequence_number action_flags src_location dst_location future_use_5 packets_sent packets_received "
    "session_end_reason"
).split()
_RULE = _V10.index("rule_name") + 1

COLUMN_MAPS = {
    ("panos_traffic", "10.1"): _V10,
    ("panos_traffic", "11.0"): [*_V10[:_RULE], "tunnel_inspection_rule", *_V10[_RULE:], "link_change_count", "policy_id", "link_switches"],
}
