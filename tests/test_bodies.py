"""Each body gives events or is refused with a reason."""

from stratalog.sources import readers


def test_bodies_are_accepted_or_refused(spark):
    big = "x" * (readers.MAX_BODY + 1)
    rows = spark.createDataFrame([(1, "a\r\n\nb"), (2, big), (3, None), (4, "")], "id int, body string")
    assert sorted((r.id, r.line) for r in readers.raw_body_lines(rows, "body").collect()) == [(1, "a"), (1, "b")]
    assert [tuple(r) for r in readers.refused_bodies(rows, "body").collect()] == [(2, len(big), "body_too_large")]
    rows = spark.createDataFrame([(1, '[{"b":1,"a":2}, 3]'), (2, '{"a":1}\n{"b":2}\n'), (3, '{"a":1}\nnot'), (4, "[1,"), (5, "[" + big + "]"), (6, None)], "id int, body string")
    assert sorted((r.id, r.line) for r in readers.json_body_events(rows, "body").collect()) == [(1, "3"), (1, '{"a":2,"b":1}'), (2, '{"a":1}'), (2, '{"b":2}')]
    assert sorted((r.id, r.reason) for r in readers.refused_bodies(rows, "body", "json").collect()) == [(3, "body_invalid"), (4, "body_invalid"), (5, "body_too_large")]
    rows = spark.createDataFrame([(1, '{"event":"e","sourcetype":"s"}'), (2, '{"event":"' + big + '"}')], "id int, body string")
    assert [(r.id, r.line) for r in readers.hec_events(rows, "body").collect()] == [(1, "e")]
    assert [(r.id, r.reason) for r in readers.refused_bodies(rows, "body", "hec").collect()] == [(2, "body_too_large")]
