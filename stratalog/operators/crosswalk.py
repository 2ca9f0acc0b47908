"""Normalized records as documents of two other schemas. Names are fixed values of those schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog.functions.times import iso_of_ns

ECS_VERSION = "8.11.0"
#: class: (categories, types, kind)
ECS_CLASSES = {4001: (("network",), ("connection",), "event"), 4002: (("network", "web"), ("connection", "protocol"), "event"), 4003: (("network",), ("connection", "protocol"), "event"), 2004: (("intrusion_detection",), ("info",), "alert")}


def _case(of: Column, table: dict, pick) -> Column:
    out = F
    for k, v in table.items():
        out = out.when(of == k, pick(v))
    return out


def ecs(record: str = "ocsf", unmapped: str = "unmapped") -> Column:
    """Struct of the document; nulls stand for fields that aren't there, so that to_json drops them."""
    o = lambda p: F.col(f"{record}.{p}")
    rest = lambda k: F.nullif(F.try_element_at(F.col(unmapped), F.lit(k)), F.lit(""))
    texts = lambda xs: F.array(*map(F.lit, xs))
    cls, out, into = o("class_uid"), o("traffic.bytes_out"), o("traffic.bytes_in")
    end = lambda side, n: F.struct(o(f"{side}_endpoint.ip").alias("ip"), o(f"{side}_endpoint.port").alias("port"), o(f"{side}_endpoint.hostname").alias("domain"), n.alias("bytes"), F.struct(rest(f"nat_{side}_ip").alias("ip"), rest(f"nat_{side}_port").try_cast("bigint").alias("port")).alias("nat"))
    total = F.when(out.isNotNull() | into.isNotNull(), F.coalesce(out, F.lit(0)) + F.coalesce(into, F.lit(0))).otherwise(o("traffic.bytes"))
    related = F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.nullif(x, F.lit("")) for x in (o("src_endpoint.ip"), o("dst_endpoint.ip"), rest("nat_src_ip"), rest("nat_dst_ip")))))))
    return F.struct(
        iso_of_ns(o("time")).alias("@timestamp"), F.struct(F.lit(ECS_VERSION).alias("version")).alias("ecs"),
        F.struct(
            F.coalesce(_case(cls, ECS_CLASSES, lambda v: F.lit(v[2])), F.lit("event")).alias("kind"), _case(cls, ECS_CLASSES, lambda v: texts(v[0])).alias("category"), _case(cls, ECS_CLASSES, lambda v: texts(v[1])).alias("type"),
            o("action").alias("action"), o("severity_id").alias("severity"), o("metadata.uid").alias("id"),
        ).alias("event"),
        end("src", out).alias("source"), end("dst", into).alias("destination"),
        F.struct(F.lower(o("connection_info.protocol_name")).alias("transport"), o("connection_info.protocol_num").alias("iana_number"), total.alias("bytes")).alias("network"),
        F.struct(F.coalesce(o("firewall_rule.name"), o("finding_info.title")).alias("name"), F.coalesce(o("firewall_rule.uid"), o("finding_info.uid")).alias("id"), o("finding_info.types").alias("category")).alias("rule"),
        F.struct(o("metadata.product.vendor_name").alias("vendor"), o("metadata.product.name").alias("product"), F.struct(rest("src_zone").alias("zone")).alias("ingress"), F.struct(rest("dst_zone").alias("zone")).alias("egress")).alias("observer"),
        F.struct(F.when(F.size(related) > 0, related).alias("ip")).alias("related"),
    )


def cim(record: str = "ocsf") -> Column:
    """Struct of a traffic or intrusion event with its data model and tags."""
    o = lambda p: F.col(f"{record}.{p}")
    cls = o("class_uid")
    action = F.lower(o("action"))
    allowed = F.when(action == "denied", "blocked").otherwise(action)
    total = F.coalesce(o("traffic.bytes_in"), F.lit(0)) + F.coalesce(o("traffic.bytes_out"), F.lit(0))
    return F.struct(
        F.when(cls == 4001, "Network_Traffic").when(cls == 2004, "Intrusion_Detection").alias("datamodel"), allowed.alias("action"), o("src_endpoint.ip").alias("src"), o("src_endpoint.port").alias("src_port"),
        o("dst_endpoint.ip").alias("dest"), o("dst_endpoint.port").alias("dest_port"), F.lower(o("connection_info.protocol_name")).alias("transport"),
        F.when(cls == 4001, o("traffic.bytes_in")).alias("bytes_in"), F.when(cls == 4001, o("traffic.bytes_out")).alias("bytes_out"), F.when(cls == 4001, total).alias("bytes"),
        F.when(cls == 2004, o("finding_info.title")).alias("signature"), F.when(cls == 2004, o("finding_info.types")).alias("category"), F.lower(o("severity")).alias("severity"),
        F.concat_ws(" ", o("metadata.product.vendor_name"), o("metadata.product.name")).alias("vendor_product"),
        F.when(cls == 4001, F.array(F.lit("network"), F.lit("communicate"))).when(cls == 2004, F.array(F.lit("ids"), F.lit("attack"))).otherwise(F.array().cast("array<string>")).alias("tags"),
    )
