"""Tamper evidence: batches of event hashes as Merkle trees, and a signed chain over their roots.

Roots are folded inside Catalyst from at most batch_size leaves, and everything per event or per entry stays distributed,
verification included. Only the chain's fold is sequential, as each root is hashed behind the one before; it streams
through one sorted partition and holds one entry at a time. An ingest folds just its own batches behind the ledger's last
root, so that no fold ever runs over the whole ledger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.functions import ed25519
from stratalog.functions.shared import cut

BATCH = 1000
EMPTY = hashlib.sha256(b"").hexdigest()
GENESIS = "00" * 32
LEDGER = "seq long, batch_root string, prev_chained_root string, chained_root string, leaf_count long, first_event_uid string, last_event_uid string, sealed_at_ns long, signature string"


def event_hash(raw: Column) -> Column:
    return F.sha2(raw, 256)


def _parent(left: Column, right: Column) -> Column:
    return F.sha2(F.concat(F.unhex(left), F.unhex(right)), 256)


def next_level(level: Column) -> Column:
    """Hashes of neighbours; the last stands for its missing partner."""
    pair = lambda i: _parent(F.element_at(level, 2 * i + 1), F.element_at(level, F.least(2 * i + 2, F.size(level))))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")), pair)


def merkle_levels(rows: DataFrame, leaves: str, most: int = BATCH) -> tuple[DataFrame, list[str]]:
    """rows with a column for each level above the array column leaves (hex hashes, at most most of them)."""
    names = [leaves]
    for i in range((most - 1).bit_length()):
        rows = rows.withColumn(f"__level{i + 1}", F.when(F.size(names[-1]) > 1, next_level(F.col(names[-1]))).otherwise(F.col(names[-1])))
        names.append(f"__level{i + 1}")
    return rows, names


def merkle_root(rows: DataFrame, leaves: str, out: str = "batch_root", most: int = BATCH) -> DataFrame:
    got, names = merkle_levels(rows, leaves, most)
    return got.withColumn(out, F.when(F.size(leaves) == 0, EMPTY).otherwise(F.element_at(names[-1], 1))).drop(*names[1:])


def batches(events: DataFrame, order: str, size: int = BATCH) -> DataFrame:
    """events with seq (batch) and leaf_index, by a dense, zero-based order column."""
    return events.withColumn("seq", F.floor(F.col(order) / size).cast("bigint")).withColumn("leaf_index", F.pmod(F.col(order), F.lit(size)).cast("int"))


def numbered(events: DataFrame, order: list[str], name: str = "ordinal", parts: int | None = None) -> DataFrame:
    """events with a dense zero-based number in the given order, without gathering them in one task.

    Rows are dealt by range and sorted, and each one's part and place there are written to the shared folder once: bounds
    of ranges come from samples, so a second computation could deal otherwise. Parts are then counted and shifted.
    """
    parts = parts or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(events.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    # the number's upper bits are the part, the lower 33 the place in it
    placed = placed.withColumn("__part", F.shiftright("__at", 33)).withColumn("__own", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    # one row for each part
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(counts), "__part").withColumn(name, (F.col("__own") + F.col("__before")).cast("bigint")).drop("__at", "__part", "__own", "__before")


def sealed(batched: DataFrame, hash_col: str = "raw_hash", size: int = BATCH) -> DataFrame:
    """seq, leaf_count, batch_root of batched events (seq, leaf_index, hash)."""
    leaves = batched.groupBy("seq").agg(F.transform(F.array_sort(F.collect_list(F.struct("leaf_index", hash_col))), lambda x: x[hash_col]).alias("__leaves"))
    return merkle_root(leaves, "__leaves", most=size).select("seq", F.size("__leaves").cast("bigint").alias("leaf_count"), "batch_root")


def chained(ledger: DataFrame, head: str = GENESIS, seed: bytes | None = None) -> DataFrame:
    """ledger (seq, batch_root and more) with prev_chained_root, chained_root and signature: each root is hashed behind the chain so far, which begins with head.

    seed: the private key; without one, signature is null.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = bytes.fromhex(head)
        for batch in batches:
            roots = [last]
            for root in batch.column("batch_root").to_pylist():
                roots.append(hashlib.sha256(roots[-1] + bytes.fromhex(root)).digest())
            last = roots[-1]
            signed = [ed25519.sign(seed, r).hex() if seed else None for r in roots[1:]]
            more = [pa.array([r.hex() for r in roots[:-1]], pa.string()), pa.array([r.hex() for r in roots[1:]], pa.string()), pa.array(signed, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "prev_chained_root", "chained_root", "signature"])

    schema = ledger.schema
    for name in ("prev_chained_root", "chained_root", "signature"):
        schema = schema.add(name, "string")
    return ledger.repartition(1).sortWithinPartitions("seq").mapInArrow(fold, schema)


def verify_chain(ledger: DataFrame, public: bytes | None = None) -> DataFrame:
    """ledger with reason: what is wrong with an entry's number, link, root or signature, null if nothing.

    Each entry is held against the one before it by a join, so no task sees the whole ledger. A number that occurs twice,
    or whose predecessor is missing, is out of sequence. public: the key; without one, signatures aren't looked at.
    """
    before = ledger.groupBy((F.col("seq") + 1).alias("__seq")).agg(F.min("chained_root").alias("__before"))
    times = ledger.groupBy(F.col("seq").alias("__own")).agg(F.count(F.lit(1)).alias("__times"))
    rows = ledger.join(before, F.col("seq") == F.col("__seq"), "left").join(times, F.col("seq") == F.col("__own"))
    first = F.col("seq") == 0
    reason = F.when((F.col("__times") > 1) | (F.col("seq") < 0) | (~first & F.col("__seq").isNull()), "sequence")
    reason = reason.when(F.col("prev_chained_root") != F.when(first, GENESIS).otherwise(F.col("__before")), "link").when(F.col("chained_root") != _parent(F.col("prev_chained_root"), F.col("batch_root")), "root")
    if public is not None:

        @F.pandas_udf("boolean")
        def genuine(root, signature):
            ok = lambda r, s: s is not None and ed25519.verify(public, bytes.fromhex(r), bytes.fromhex(s))
            return root.combine(signature, ok)

        rows = rows.withColumn("__genuine", genuine("chained_root", "signature"))
        reason = reason.when(~F.col("__genuine"), "signature")
    return rows.withColumn("reason", reason).select(*ledger.columns, "reason")


def first_fault(checked: DataFrame) -> tuple[int, str] | None:
    """(seq, reason) of the first bad entry of verify_chain's rows; None if the chain is sound."""
    found = checked.where("reason IS NOT NULL").agg(F.min(F.struct("seq", "reason")).alias("x")).first().x
    return (found.seq, found.reason) if found else None


def seal(spark: SparkSession, events: DataFrame, root: str, seed: bytes | None = None, now_ns: int | None = None, size: int = BATCH, order: tuple[str, ...] = ("ingest_time_ns", "event_uid")) -> int:
    """Seals events (event_uid, raw_hash and the order's columns) behind what the folder root has sealed; returns the number of batches.

    The index (event_uid, ledger_seq, leaf_index) is complete before the ledger gets its entries: a batch exists once the
    ledger has it, and what a crash left in the index is replaced by the next seal of the same events.
    """
    last = read_ledger(spark, root).agg(F.max(F.struct("seq", "chained_root")).alias("x")).first().x
    begin, head = (last.seq + 1, last.chained_root) if last else (0, GENESIS)
    own = batches(numbered(events.select("event_uid", "raw_hash", *(c for c in order if c != "event_uid")), list(order)), "ordinal", size).withColumn("seq", F.col("seq") + begin)
    own = cut(own.select("event_uid", "raw_hash", "seq", "leaf_index"))
    at = F.lit(now_ns).cast("long") if now_ns is not None else F.unix_micros(F.current_timestamp()) * 1000
    ends = own.groupBy("seq").agg(F.min_by("event_uid", "leaf_index").alias("first_event_uid"), F.max_by("event_uid", "leaf_index").alias("last_event_uid"))
    entries = cut(chained(sealed(own, size=size).join(ends, "seq").withColumn("sealed_at_ns", at), head, seed))
    own.select("event_uid", F.col("seq").alias("ledger_seq"), "leaf_index").write.mode("append").parquet(f"{root}/index")
    entries.select(*(x.split()[0] for x in LEDGER.split(", "))).write.mode("append").json(f"{root}/ledger")
    return entries.count()


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, f"{root}/ledger", LEDGER, "json")


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """event_uid, seq, leaf_index; of an event sealed twice the later place."""
    rows = _stored(spark, f"{root}/index", "event_uid string, ledger_seq long, leaf_index int", "parquet")
    return rows.groupBy("event_uid").agg(F.max(F.struct("ledger_seq", "leaf_index")).alias("x")).select("event_uid", F.col("x.ledger_seq").alias("seq"), F.col("x.leaf_index").alias("leaf_index"))


def _stored(spark: SparkSession, path: str, schema: str, kind: str) -> DataFrame:
    """The table at path; an empty one where there is none yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).format(kind).load(path) if there else spark.createDataFrame([], schema)


def verify_event(bronze: DataFrame, index: DataFrame, ledger: DataFrame, event_uid: str, size: int = BATCH) -> DataFrame:
    """verify_events' row of one event, none if there is no evidence of it; only its own batch, at most size events, is hashed."""
    batch = index.join(F.broadcast(index.where(F.col("event_uid") == event_uid).select("seq")), "seq", "left_semi").select("event_uid", "seq", "leaf_index")
    wanted = batch.select("event_uid").union(bronze.sparkSession.createDataFrame([(event_uid,)], "event_uid string")).distinct()
    mine = bronze.join(F.broadcast(wanted), "event_uid", "left_semi")
    return verify_events(mine, batch, ledger, size).where(F.col("event_uid") == event_uid)


def proofs(batched: DataFrame, hash_col: str = "raw_hash", size: int = BATCH) -> DataFrame:
    """seq, leaf_index, leaf, root, proof (array of sibling and side) of each event."""
    leaves = batched.groupBy("seq").agg(F.transform(F.array_sort(F.collect_list(F.struct("leaf_index", hash_col))), lambda x: x[hash_col]).alias("__leaves"))
    got, names = merkle_levels(leaves, "__leaves", size)
    each = got.select("seq", F.element_at(names[-1], 1).alias("root"), *names, F.posexplode("__leaves").alias("leaf_index", "leaf"))
    steps = []
    for k, level in enumerate(names[:-1]):
        at = F.expr(f"leaf_index div {1 << k}").cast("int")
        left = F.pmod(at, F.lit(2)) == 1
        sibling = F.element_at(F.col(level), F.when(left, at).otherwise(F.least(at + 2, F.size(level))))
        steps.append(F.when(F.size(level) > 1, F.struct(sibling.alias("sibling"), F.when(left, "left").otherwise("right").alias("side"))))
    return each.select("seq", "leaf_index", "leaf", "root", F.array_compact(F.array(*steps)).alias("proof"))


def proof_root(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(proof, leaf, lambda acc, s: F.when(s["side"] == "left", _parent(s["sibling"], acc)).otherwise(_parent(acc, s["sibling"])))


def verify_events(bronze: DataFrame, index: DataFrame, ledger: DataFrame, size: int = BATCH) -> DataFrame:
    """bronze (event_uid, raw, raw_hash) with seq, leaf_index and reason: hash, not_indexed, no_ledger_entry or proof; null if the event is as sealed."""
    now = bronze.withColumn("__now", event_hash(F.col("raw"))).join(index.select("event_uid", "seq", "leaf_index"), "event_uid", "left")
    paths = proofs(now.where("seq is not null"), "__now", size).select("seq", "leaf_index", proof_root(F.col("leaf"), F.col("proof")).alias("__root"))
    joined = now.join(paths, ["seq", "leaf_index"], "left").join(ledger.select("seq", "batch_root"), "seq", "left")
    reason = F.when(F.col("__now") != F.col("raw_hash"), "hash").when(F.col("seq").isNull(), "not_indexed").when(F.col("batch_root").isNull(), "no_ledger_entry").when(F.col("__root") != F.col("batch_root"), "proof")
    return joined.select("event_uid", "seq", "leaf_index", reason.alias("reason"))
