"""Streams that go on where they stopped: growing files, open batches, windows."""

import hashlib
import os
import time

import pytest
from pyspark.sql import functions as F

from stratalog.operators import integrity
from stratalog.operators.definition import Registry
from stratalog.plans import builtin, lake
from stratalog.sources.tail import tail
from stratalog.streaming import ingest, sealing


def tailed(spark, tmp_path, **options):
    """Runs the tail once over what is there and returns the new (file, position, line)s."""
    out = tmp_path / "out"
    before = set(os.listdir(out)) if out.exists() else set()
    q = tail(spark, f"{tmp_path}/in/*.log", **options).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(str(out))
    q.awaitTermination()
    new = [f"{out}/{f}" for f in set(os.listdir(out)) - before if f.endswith(".parquet")]
    return sorted((os.path.basename(r.path), r.position, bytes(r.value)) for r in spark.read.parquet(*new).collect()) if new else []


def test_a_growing_file_gives_each_line_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    log, other = tmp_path / "in" / "a.log", tmp_path / "in" / "b.log"
    assert tailed(spark, tmp_path) == []
    log.write_bytes(b"one\ntwo\r\n\nthr")
    other.write_bytes(b"no end")
    (tmp_path / "in" / "c.txt").write_bytes(b"not mine\n")
    assert tailed(spark, tmp_path) == [("a.log", 0, b"one"), ("a.log", 4, b"two"), ("a.log", 9, b"")]
    with log.open("ab") as f:
        f.write(b"ee\nfour")
    assert tailed(spark, tmp_path) == [("a.log", 10, b"three")]
    assert tailed(spark, tmp_path) == []
    with log.open("ab") as f:
        f.write(b"\n")
    assert tailed(spark, tmp_path) == [("a.log", 16, b"four")]
    # rotated: the old file under another name has a line more, a new one begins
    log.rename(tmp_path / "in" / "a.1.log")
    with (tmp_path / "in" / "a.1.log").open("ab") as f:
        f.write(b"last\n")
    log.write_bytes(b"fresh\n")
    assert tailed(spark, tmp_path) == [("a.1.log", 21, b"last"), ("a.log", 0, b"fresh")]
    # cut off and written anew
    log.write_bytes(b"x\n")
    other.write_bytes(b"no end yet\n")
    assert tailed(spark, tmp_path) == [("a.log", 0, b"x"), ("b.log", 0, b"no end yet")]


def test_a_large_file_is_read_in_parts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [hashlib.sha256(str(i).encode()).hexdigest().encode() * (1 + i % 3) for i in range(3000)] + [b"y" * 3_000_000, b"z"]
    (tmp_path / "in" / "a.log").write_bytes(b"\n".join(lines) + b"\n")
    got = tailed(spark, tmp_path, part_bytes=10_000)
    assert [x for _, _, x in sorted(got, key=lambda r: r[1])] == lines


def test_triggers_are_bounded_and_a_running_tail_sees_what_is_appended(spark, tmp_path):
    (tmp_path / "in").mkdir()
    log, seen = tmp_path / "in" / "a.log", []
    log.write_bytes(b"".join(b"line %03d\n" % i for i in range(100)))
    q = tail(spark, f"{tmp_path}/in/*.log", max_bytes=400).writeStream.foreachBatch(lambda b, n: seen.append([bytes(r.value) for r in b.collect()])).option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="100 milliseconds").start()
    try:
        wait(lambda: sum(map(len, seen)) >= 100)
        with log.open("ab") as f:
            f.write(b"".join(b"line %03d\n" % i for i in range(100, 201)))
        wait(lambda: sum(map(len, seen)) >= 201)
    finally:
        q.stop()
    assert sorted(x for b in seen for x in b) == [b"line %03d" % i for i in range(201)]
    assert len(seen[0]) == 100 and max(map(len, seen[1:])) <= 44


def wait(done, seconds=60):
    until = time.time() + seconds
    while not done():
        assert time.time() < until
        time.sleep(0.1)


def test_tailed_lines_keep_their_place_as_evidence(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_bytes(b"first\nsecond\n")
    registry = Registry([d for d in builtin.definitions() if d.name == "iptables"])
    ingest.start(tail(spark, f"{tmp_path}/in/*.log"), registry, f"{tmp_path}/lake", f"{tmp_path}/cp").awaitTermination()
    places = {r.raw.decode(): r.locator for r in lake.read_bronze(spark, f"{tmp_path}/lake/bronze").collect()}
    assert places == {"first": f"{tmp_path}/in/a.log:0", "second": f"{tmp_path}/in/a.log:6"}


EVENTS = "event_uid string, raw_hash string, ingest_time_ns long"


def evidence(spark, tmp_path, name, numbers):
    rows = [(f"e{i:05}", hashlib.sha256(str(i).encode()).hexdigest(), i) for i in numbers]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
    return rows


@pytest.fixture
def sealed(spark, tmp_path):
    def run(**options):
        stream = spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/events")
        q = sealing.start(stream, f"{tmp_path}/root", f"{tmp_path}/cp", lanes=1, **options)
        q.awaitTermination()
        return sealing.read_ledger(spark, f"{tmp_path}/root").orderBy("seq").collect()

    return run


def test_open_batches_cross_micro_batches_and_restarts(spark, tmp_path, sealed):
    rows = evidence(spark, tmp_path, "events", range(70))
    assert [(r.seq, r.leaf_count, r.reason) for r in sealed(size=50, wait_ms=3_600_000)] == [(0, 50, "size")]
    rows += evidence(spark, tmp_path, "events", range(70, 90))
    assert len(sealed(size=50, wait_ms=3_600_000)) == 1
    rows += evidence(spark, tmp_path, "events", range(90, 215))
    ledger = sealed(size=50, wait_ms=3_600_000)
    assert [(r.seq, r.leaf_count, r.first_event_uid, r.last_event_uid) for r in ledger] == [(k, 50, f"e{50 * k:05}", f"e{50 * k + 49:05}") for k in range(4)]
    # the same ledger as that of all events sealed at once
    whole = spark.createDataFrame(rows[:200], EVENTS).withColumn("ordinal", F.col("ingest_time_ns"))
    want = integrity.chained(integrity.sealed(integrity.batches(whole, "ordinal", 50), size=50)).orderBy("seq").collect()
    assert [(r.batch_root, r.chained_root) for r in ledger] == [(r.batch_root, r.chained_root) for r in want]
    index = {r.event_uid: (r.seq, r.leaf_index) for r in integrity.read_index(spark, f"{tmp_path}/root").collect()}
    assert index == {u: (i // 50, i % 50) for i, (u, _, _) in enumerate(rows[:200])}
    assert integrity.first_fault(integrity.verify_chain(sealing.read_ledger(spark, f"{tmp_path}/root").select(*(x.split()[0] for x in integrity.LEDGER.split(", "))))) is None


def test_a_batch_that_waits_too_long_is_sealed(spark, tmp_path, sealed):
    evidence(spark, tmp_path, "events", range(10))
    assert sealed(size=50, wait_ms=1) == []
    time.sleep(0.2)
    evidence(spark, tmp_path, "events", range(10, 15))
    ledger = sealed(size=50, wait_ms=1)
    assert [(r.reason, r.leaf_count) for r in ledger][:1] in ([("timeout", 10)], [("timeout", 15)])


def test_a_micro_batch_that_comes_again_adds_nothing(spark, tmp_path):
    rows = [(0, k, "size", [f"e{k}"], [hashlib.sha256(str(k).encode()).hexdigest()]) for k in range(3)]
    first = spark.createDataFrame(rows, sealing.SEALED)
    assert sealing.append_sealed(spark, first, str(tmp_path)) == 3 and sealing.append_sealed(spark, first, str(tmp_path)) == 0
    assert sealing.append_sealed(spark, spark.createDataFrame([(1, 0, "size", ["x"], ["00" * 32]), *rows], sealing.SEALED), str(tmp_path)) == 1
    ledger = sealing.read_ledger(spark, str(tmp_path)).drop("lane", "number", "reason")
    assert ledger.count() == 4 and integrity.first_fault(integrity.verify_chain(ledger)) is None
