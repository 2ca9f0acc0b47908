"""Work that must not grow faster than its input."""

import json
import time

from pyspark.sql import functions as F

from stratalog import queries
from stratalog.functions import net
from stratalog.operators import engines, enrich, normalize


def test_json_leaves_cost_their_own_depth_once(spark):
    """Each value is looked at once, so ten times the depth is not a hundred times the work."""
    depth, rows = 600, 400
    text = '{"k":' * depth + '{"n":1,"e":[],"o":{},"a":[null,{"x":"y"}]}' + "}" * depth
    table = spark.range(rows, numPartitions=8).select(F.concat(F.lit(text), F.repeat(F.lit(" "), F.col("id").cast("int"))).alias("text"))
    leaves = engines.json_leaves(F.try_parse_json("text"), engines.json_size(F.col("text")))
    began = time.monotonic()
    found = table.select(F.transform(leaves, lambda e: F.struct(e["k"], F.to_json(e["v"]))).alias("l")).collect()
    assert time.monotonic() - began < 25
    at = "k." * depth
    assert {tuple(sorted(map(tuple, r.l))) for r in found} == {((f"{at}a.0", "null"), (f"{at}a.1.x", '"y"'), (f"{at}e", "[]"), (f"{at}n", "1"), (f"{at}o", "{}"))}


def test_json_leaves_of_odd_objects(spark):
    """Empty, flat and mixed objects give the leaves that they have, others none."""
    texts = ["{}", '{"a":1}', '{"a":{},"b":[]}', '{"a":[[],[[1]],{"b":[{}]}]}', "[1]", "7", "{", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    leaves = engines.json_leaves(F.try_parse_json("t"), engines.json_size(F.col("t")))
    got = {r.i: r.l for r in rows.select("i", F.transform(leaves, lambda e: F.concat(e["k"], F.lit("="), F.to_json(e["v"]))).alias("l")).collect()}
    assert [got[i] for i in range(len(texts))] == [[], ["a=1"], ["a={}", "b=[]"], ["a.0=[]", "a.1.0.0=1", "a.2.b.0={}"], None, None, None, None]
    assert json.loads(texts[3])["a"][1] == [[1]]


def plan(df) -> list[str]:
    """Lines of the optimized plan, the results first."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        return df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    finally:
        conf.unset("spark.sql.debug.maxToStringFields")


def test_lines_are_dealt_to_several_tasks_a_core(spark):
    lines = queries.fortigate_lines(spark, "/root/testdata/sf0.001")
    assert lines.rdd.getNumPartitions() >= 8 * spark.sparkContext.defaultParallelism


def test_each_field_is_looked_up_once(spark):
    lines = queries.fortigate_lines(spark, "/root/testdata/sf0.001")
    rows = normalize.normalized(lines, queries.only("fortigate_traffic"), F.lit("2026-11-26").cast("timestamp"))
    text = "\n".join(plan(rows.select("ocsf", "error")))
    assert text.count(", srcip, ") == text.count(", dstport, ") == 1


def test_an_address_is_parsed_once_for_all_its_contexts(spark):
    rows = spark.range(3).select(F.struct(*(F.struct(F.concat(F.lit(x), "id").alias("ip"), F.lit(1).alias("port")).alias(f"{n}_endpoint") for n, x in (("src", "10.0.0."), ("dst", "8.8.8."))), F.struct(F.lit(None).cast("string").alias("direction"), F.lit(None).cast("bigint").alias("direction_id")).alias("connection_info"), F.lit(4001).alias("class_uid"), F.lit("").alias("action"), F.struct(F.lit(1).alias("bytes_out")).alias("traffic"), F.struct(F.lit("").alias("title"), F.lit("").alias("types")).alias("finding_info")).alias("ocsf"))
    out = enrich.enriched(rows.cache())
    assert "\n".join(plan(out)).count(net.V4) <= 4
    assert {(r.enrichment.direction, r.ocsf.connection_info.direction, r.enrichment.src.zone) for r in out.collect()} == {("outbound", "Outbound", "corp")}


def test_indicators_meet_distinct_values_only(spark):
    """What is looked up is worked out after values are made distinct, not for each row."""
    rows = spark.range(1000).select("id", F.concat(F.lit("10.0.0."), F.col("id") % 3).alias("src"))
    listed = spark.createDataFrame([("ip", "10.0.0.0/31", "list", "high")], "type string, indicator string, source string, confidence string")
    out = enrich.indicator_hits(rows, [("src", "ip", F.col("src"))], listed)
    lines = plan(out)
    start = next(i for i, x in enumerate(lines) if "Generate explode" in x)
    distinct = next(i for i, x in enumerate(lines) if i > start and "Aggregate" in x)
    below = [x for x in lines[distinct + 1 :] if "Range" in x or "conv(" in x]
    assert "conv(" not in below[0]
    assert out.where("ioc is not null").count() == 667
