"""Deep JSON: the leaves of a walk are those of the variant, at a cost that doesn't grow with the depth's square."""

import time

from pyspark.sql import functions as F

from stratalog import queries
from stratalog.operators import deep, engines

ODD = (
    "{}", '{"a":1}', '{"a":{},"b":[]}', '{"a":[[],[[1]],{"b":[{}]}]}', "[1]", "7", "{", None, "", ' \n{"z":1,"a":{"b":null,"a":true}} ', '{"a":1} x', '{"a":1}}', '{"a":1}{"b":2}', '{"a":1,"a":2}', "{'a':1}", '{"a":NaN}', '{"a":01}',
    '{"a":1.50,"b":1e2,"c":-0,"d":100.0,"e":12345678901234567890123456789012345678901,"f":-1.5E-7,"g":99999999999}', r'{"a😀":"\ud800","\ud800":"q\"\\\/\n\u0000","":{"":""}}', '{"x.y":1,"x":{"y":2}}', "﻿{}", '{"a":"{[,:]}"}',
    '{"k":' * 400 + '["x"]' + "}" * 400, '{"k":' * 1001 + "1" + "}" * 1001, '{"k":' * 5 + "1" + "}" * 4,
)


def shown(leaves):
    return F.transform(leaves, lambda e: F.struct(e["k"].alias("k"), F.to_json(e["v"]).alias("v"), F.schema_of_variant(e["v"]).alias("t")))


def test_walked_leaves_are_those_of_the_variant(spark):
    rows = spark.createDataFrame(list(enumerate(ODD)), "i int, t string").repartition(3)
    t = F.col("t")
    walked = engines.deep_leaves(t)
    both = rows.select("i", shown(walked).alias("a"), shown(engines.json_leaves(F.try_parse_json(t), engines.json_size(t))).alias("b")).collect()
    assert len(both) == len(ODD)
    for r in both:
        assert r.a == r.b, ODD[r.i]
    # what is valid is walked, not left to the variant
    gone = {r.i for r in rows.where(F.try_variant_get(F.try_parse_json("t"), "$", "map<string,variant>").isNotNull()).select("i", deep.walk(t, ".").alias("w")).where("w is null").collect()}
    assert gone == set()


def test_the_deepest_text_that_spark_reads(spark):
    """At 999 levels, opening them one by one overflows the JVM's stack."""
    text = '{"k":' * 999 + '["x"]' + "}" * 999
    (r,) = spark.createDataFrame([(text,)], "t string").select(shown(engines.deep_leaves(F.col("t"))).alias("l"), engines.compile_engine("json", {"deep": True})(F.col("t")).alias("m")).collect()
    assert r.l == [("k." * 999 + "0", '"x"', "STRING")] and r.m == {"k." * 999 + "0": "x"}


def test_a_full_batch_leaves_its_rest_to_the_variant(spark):
    rows = spark.range(0, 50, numPartitions=1).select(F.concat(F.lit('{"abc":'), "id", F.lit("}")).alias("t"))
    got = [r.w for r in rows.select(deep.walk(F.col("t"), ".", 20).alias("w")).collect()]
    assert got[0] == [("abc", "0")] and got[-1] is None and 0 < sum(w is not None for w in got) < 50


def test_engine_of_deep_texts_gives_what_the_other_gives(spark):
    texts = [(x,) for x in (*ODD, '[{"a":{"b":[1,{"c":null}]},"d":{},"e":"{x"}]', '{"a":[1,null,"x"],"b":{"c":[true]}}')]
    rows = spark.createDataFrame(texts, "t string")
    for options in ({}, {"sep": "/"}, {"array_mode": "join"}):
        near, far = (engines.compile_engine("json", options | more)(F.col("t")) for more in ({}, {"deep": True}))
        for r in rows.select("t", near.alias("near"), far.alias("far")).collect():
            assert r.near == r.far, (options, r.t)


def test_depth_costs_no_more_than_length(spark):
    """Of 500 levels, 800 rows opened level by level took 5 s, and 8,000 rows walked 3 s."""
    depth, rows = 900, 8000
    table = spark.range(rows, numPartitions=64).select(F.concat(F.lit('{"k":' * depth), "id", F.lit("}" * depth)).alias("t"))
    began = time.monotonic()
    m = table.select(engines.compile_engine("json", {"deep": True})(F.col("t")).alias("m"))
    assert m.where(F.element_at("m", ".".join(["k"] * depth)).isNotNull()).count() == rows
    assert time.monotonic() - began < 25


def test_query_flattens_a_text_once(spark):
    text = queries.parse_json_deep(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("ArrowEvalPython") == 1 and text.count("aggregate(sequence(") == 1
