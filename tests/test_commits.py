"""Changes of the lake that apply whole or not at all: compaction, replay and reprocessing under crashes and beside readers."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stratalog.plans import builtin, jobs, lake
from stratalog.plans.commits import Commits, Conflict

LINE = 'date=2026-11-26 time=10:00:00 devname="fw" devid="FG" logid="0000000013" type="traffic" subtype="forward" level="notice" eventtime=1764151200000000000 srcip={} srcport=1000 dstip=8.8.8.8 dstport=443 proto=6 action="accept" policyid=1 sentbyte=10 rcvdbyte=20'
FORTI = [d for d in builtin.definitions() if d.name == "fortigate_traffic"]
#: The same definition with addresses as plain text: lines that the first one refuses pass.
LAX = [replace(d, version="2.0.0", rules=tuple(replace(r, type="str") if r.target == "src_endpoint.ip" else r for r in d.rules)) for d in FORTI]
#: ... and one that still refuses some.
HALF = [replace(d, rules=tuple(replace(r, map={"10.0.0.x": "10.0.0.9"}, required=True) if r.target == "src_endpoint.ip" else r for r in d.rules)) for d in FORTI]


def ref():
    return F.lit("2026-11-26").cast("timestamp")


@pytest.fixture
def root(spark, tmp_path):
    addresses = ["10.0.0.1", "10.0.0.x", "10.0.0.y", "10.0.0.2"]
    rows = spark.createDataFrame([(f"e{i}", bytearray(LINE.format(a).encode()), i) for i, a in enumerate(addresses)], "event_uid string, raw binary, ingest_time_ns long")
    jobs.ingest(rows, FORTI, str(tmp_path), ref())
    return str(tmp_path)


def uids(spark, root):
    return sorted(r.event_uid for r in lake.read_silver(spark, f"{root}/silver").collect())


def dead(spark, root):
    return sorted((r.event_uid, r.reason) for r in lake.read_dead_letters(spark, f"{root}/deadletters").collect())


def resolved(spark, root):
    return sorted((r.event_uid, r.original_reason) for r in lake.read_resolved(spark, f"{root}/resolved").collect())


def test_replay_is_one_commit(spark, root, monkeypatch):
    assert uids(spark, root) == ["e0", "e3"] and dead(spark, root) == [("e1", "invalid_ip"), ("e2", "invalid_ip")] and resolved(spark, root) == []
    # a dry run changes nothing
    assert jobs.replay(spark, root, HALF, 5, dry_run=True, reference=ref()) == {"candidates": 2, "succeeded": 1, "still_failing": 1}
    assert uids(spark, root) == ["e0", "e3"] and len(dead(spark, root)) == 2
    # killed between the writes: nothing of it is seen
    stage = Commits.stage

    def dies(self, df, table, *args, **options):
        if table == "resolved":
            raise KeyboardInterrupt
        return stage(self, df, table, *args, **options)

    monkeypatch.setattr(Commits, "stage", dies)
    with pytest.raises(KeyboardInterrupt):
        jobs.replay(spark, root, LAX, 5, reference=ref())
    monkeypatch.undo()
    assert uids(spark, root) == ["e0", "e3"] and resolved(spark, root) == [] and len(dead(spark, root)) == 2
    # one passes, the other is dead-lettered again and stays open
    assert jobs.replay(spark, root, HALF, 5, reference=ref()) == {"candidates": 2, "succeeded": 1, "still_failing": 1}
    assert uids(spark, root) == ["e0", "e1", "e3"] and resolved(spark, root) == [("e1", "invalid_ip")]
    assert [u for u, _ in dead(spark, root)] == ["e1", "e2", "e2"]
    # an event with two dead letters is replayed once
    assert jobs.replay(spark, root, LAX, 6, reference=ref())["candidates"] == 1
    assert len(uids(spark, root)) + jobs.replay(spark, root, LAX, 7, reference=ref())["candidates"] == 4


def test_replay_by_reason_and_time(spark, root):
    none = {"candidates": 0, "succeeded": 0, "still_failing": 0}
    assert jobs.replay(spark, root, HALF, 5, reason="other", reference=ref()) == none
    assert jobs.replay(spark, root, HALF, 5, since_ns=99, reference=ref()) == none
    assert jobs.replay(spark, root, HALF, 5, reason="invalid_ip", since_ns=2, reference=ref()) == {"candidates": 1, "succeeded": 0, "still_failing": 1}
    letters = lake.read_dead_letters(spark, f"{root}/deadletters")
    assert [r.event_uid for r in lake.dead_letter_examples(letters, "invalid_ip", 1).collect()] == ["e1"]


def test_reprocess_keeps_failures_and_versions(spark, root):
    events, failed = jobs.reprocess(spark, root, LAX[:0] + HALF, "20260101", reference=ref())
    assert sorted(r.event_uid for r in events.collect()) == ["e1"] and failed.count() == 3
    assert {r["metadata.log_version"] for r in lake.read_silver(spark, f"{root}/silver").where("event_uid = 'e1'").collect()} == {f"{HALF[0].version}+reprocess-20260101"}
    assert len(dead(spark, root)) == 5
    before = uids(spark, root)
    assert jobs.reprocess(spark, root, FORTI, "20260102", source="nothing_of_it", dry_run=True, reference=ref())[0].count() == 0
    assert jobs.reprocess(spark, root, FORTI, "20260102", source="fortigate_traffic", dry_run=True, reference=ref())[0].count() == 2
    assert uids(spark, root) == before


def test_readers_see_a_compaction_before_or_after(spark, root, monkeypatch):
    rows = spark.createDataFrame([(f"f{i}", bytearray(LINE.format("10.0.0.1").encode()), i) for i in range(5)], "event_uid string, raw binary, ingest_time_ns long")
    for i in range(2):
        jobs.ingest(rows.where(f"ingest_time_ns % 2 = {i}"), FORTI, root, ref())
    want, seen, commit = uids(spark, root), [], Commits.commit

    def watched(self, *args):
        seen.append(uids(spark, root))
        out = commit(self, *args)
        seen.append(uids(spark, root))
        return out

    reader = lake.read_silver(spark, f"{root}/silver")
    monkeypatch.setattr(Commits, "commit", watched)
    report = lake.compact(spark, f"{root}/silver")
    assert report["merged"] == 1 and report["files_after"] == 1 < report["files_before"] and seen == [want, want]
    assert sorted(r.event_uid for r in reader.collect()) == want  # one that began before still has its files
    assert Commits(spark, root).vacuum(0) >= report["files_before"] and uids(spark, root) == want


def test_a_compaction_that_dies_leaves_all_as_it_was(spark, root, monkeypatch):
    jobs.ingest(spark.createDataFrame([("g", bytearray(LINE.format("10.0.0.1").encode()), 1)], "event_uid string, raw binary, ingest_time_ns long"), FORTI, root, ref())
    want = uids(spark, root)
    monkeypatch.setattr(Commits, "commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lake.compact(spark, f"{root}/silver")
    monkeypatch.undo()
    assert uids(spark, root) == want and lake.compact(spark, f"{root}/silver")["merged"] == 1 and uids(spark, root) == want


def test_of_two_commits_one_is_first(spark, tmp_path):
    a, b = Commits(spark, str(tmp_path)), Commits(spark, str(tmp_path))
    one = a.stage(spark.range(3), "silver", "parquet")
    a.commit({"silver": one})
    two, three = (c.stage(spark.range(3), "silver", "parquet") for c in (a, b))
    a.commit({"silver": two}, {"silver": one})
    with pytest.raises(Conflict):
        b.commit({"silver": three}, {"silver": one})
    for i in range(45):  # over two snapshots
        (a if i % 2 else b).commit({"more": [f"more/{i}"]})
    assert a.version()[0] == 47 and len(b.version()[1]["more"]) == 45 and list(b.version()[1]["silver"]) == two
    assert sum(f.endswith(".snapshot") for f in os.listdir(tmp_path / "_log")) == 2


def test_replay_parses_each_line_once(spark, root, monkeypatch):
    """Events, dead letters and counts come from one evaluation of what is open, of repeated evidence too, dealt to all cores."""
    rows, parts, plain = spark.sparkContext.accumulator(0), [], jobs.normalized

    def counted(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    def watched(lines, *args):
        parts.append(lines.rdd.getNumPartitions())
        return plain(lines.mapInArrow(counted, lines.schema), *args)

    commits = Commits(spark, root)
    commits.commit({"bronze": commits.stage(jobs.lake.read_bronze(spark, f"{root}/bronze").drop("raw", "locator"), "bronze", "json", "date")})
    monkeypatch.setattr(jobs, "normalized", watched)
    assert jobs.replay(spark, root, HALF, 5, reference=ref()) == {"candidates": 2, "succeeded": 1, "still_failing": 1}
    assert rows.value == 2
    assert parts == [8 * spark.sparkContext.defaultParallelism]
