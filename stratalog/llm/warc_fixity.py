"""Merkle fixity audit of WARC replicas.

Records are hashed where they lie; nothing but digests moves. Each file's byte offsets are cut into ranges, and the
digests of the records that begin in a range, in offset order, are hashed into a leaf. Each level above hashes FANOUT
neighbouring ranges, up to a root for each file. Two replicas are compared by their roots; only under a node that
differs are its children compared, down to the ranges and then the records that are corrupt, missing or extra. As nodes
are named by byte ranges, a lost record changes only the path above it.

A node gathers at most FANOUT children, and a leaf at most the records that begin in RANGE bytes, whatever the size of a
file: the tree has as many levels as the largest offset of either replica needs. Each level is written once, so that the
audit's plans stay short.

Defined results: null URLs and bodies count as empty, and bodies of any length are hashed whole. Records without a page id
go to files of their own. Repeated pages are records of their own; ties lie in the order of their digests. Two replicas
without a difference, or without records, give an empty result. Columns other than page_id, url and html play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalog.functions.shared import cut

#: Bytes of a leaf's range, children of a node, and page ids of a file.
RANGE, FANOUT, FILE_PAGES = 65_536, 16, 256


def record(url: Column, body: Column) -> Column:
    """A response record of WARC 1.1, as text."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def records(pages: DataFrame, body: Column | str = "html") -> DataFrame:
    """file, offset, length, digest of the WARC records of pages (page_id, url, html), written in the order of page_id."""
    text = record(F.col("url"), F.col(body) if isinstance(body, str) else body)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.octet_length(text).cast("long").alias("length"), F.sha2(text, 256).alias("digest"))
    own = own.withColumn("file", F.coalesce(F.floor(F.col("page_id") / FILE_PAGES), -1 - F.pmod(F.xxhash64("digest"), F.lit(4096))))
    before = Window.partitionBy("file").orderBy("page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return own.select(F.format_string("warc-%06d", "file").alias("file"), "page_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"), "length", "digest")


def _node(of: DataFrame, keys: list[Column], order: str, hashed: str) -> DataFrame:
    return of.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, hashed))), lambda x: F.concat_ws(":", x[order], x[hashed])), ","), 256).alias("hash"))


def tree(of: DataFrame, levels: int) -> list[DataFrame]:
    """From the leaves up: (file, node, hash) of each level, the last being the roots (node 0)."""
    leaf = of.select("file", F.floor(F.col("offset") / RANGE).alias("node"), "offset", F.concat_ws("/", "length", "digest").alias("hash"))
    out = [cut(_node(leaf, [F.col("file"), F.col("node")], "offset", "hash"))]
    for _ in range(levels):
        out.append(cut(_node(out[-1].withColumnRenamed("node", "child").withColumn("node", F.floor(F.col("child") / FANOUT)), [F.col("file"), F.col("node")], "child", "hash")))
    return out


def levels_for(offset: int) -> int:
    """Levels above the leaves until one node covers the offset."""
    nodes, levels = offset // RANGE, 0
    while nodes:
        nodes, levels = nodes // FANOUT, levels + 1
    return levels


def _differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose hashes differ, or that one side lacks."""
    return a.join(b.withColumnRenamed("hash", "other"), ["file", "node"], "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """file, offset, status (corrupt, missing, extra), and both sides' lengths and digests, of the records that differ; left is the reference copy."""
    left, right = (cut(x.select("file", "offset", "length", "digest")) for x in (left, right))
    levels = levels_for(left.select("offset").union(right.select("offset")).agg(F.max("offset")).first()[0] or 0)
    a, b = tree(left, levels), tree(right, levels)
    bad = _differ(a[-1], b[-1])
    for x, y in zip(a[-2::-1], b[-2::-1], strict=True):  # children of nodes that differ
        parent = bad.withColumnRenamed("node", "parent")
        own = lambda t: t.withColumn("parent", F.floor(F.col("node") / FANOUT)).join(parent, ["file", "parent"], "left_semi").select("file", "node", "hash")  # noqa: E731, B023
        bad = cut(_differ(own(x), own(y)))
    inside = lambda x: x.withColumn("node", F.floor(F.col("offset") / RANGE)).join(bad, ["file", "node"], "left_semi").drop("node")
    x, y = inside(left).alias("x"), inside(right).alias("y")
    both = x.join(y, (F.col("x.file") == F.col("y.file")) & (F.col("x.offset") == F.col("y.offset")), "full")
    status = F.when(F.col("y.file").isNull(), "missing").when(F.col("x.file").isNull(), "extra").otherwise("corrupt")
    same = F.col("x.digest").eqNullSafe(F.col("y.digest")) & F.col("x.length").eqNullSafe(F.col("y.length"))
    return both.where(~same).select(F.coalesce("x.file", "y.file").alias("file"), F.coalesce("x.offset", "y.offset").alias("offset"), status.alias("status"), F.col("x.length").alias("length"), F.col("x.digest").alias("digest"), F.col("y.length").alias("other_length"), F.col("y.digest").alias("other_digest"))


def damaged(pages: DataFrame) -> DataFrame:
    """The second replica of the registered query: the same records at the same offsets, some with a byte changed, some lost, by rules that stand in for faults of a disk."""
    kept = records(pages)
    # by page and digest: rows of one page may differ
    rotten = pages.where(F.pmod("page_id", F.lit(97)) == 13).select(F.col("page_id").cast("long").alias("page_id"), F.sha2(record(F.col("url"), F.col("html")), 256).alias("digest"), "url", F.concat(F.lit("?"), F.substring(F.coalesce("html", F.lit("")), 2, 1 << 30)).alias("html"))
    changed = rotten.select("page_id", "digest", F.octet_length(record(F.col("url"), F.col("html"))).cast("long").alias("other_length"), F.sha2(record(F.col("url"), F.col("html")), 256).alias("other")).dropDuplicates(["page_id", "digest"])
    lost = F.pmod("page_id", F.lit(211)) == 5
    return kept.join(changed, ["page_id", "digest"], "left").where(~F.coalesce(lost, F.lit(False))).select("file", "offset", F.coalesce("other_length", "length").alias("length"), F.coalesce("other", "digest").alias("digest"))


ORACLE = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
      || chr(13) || chr(10) || 'Content-Length: ' AS head, coalesce(html, '') AS body, chr(13) || chr(10) || chr(13) || chr(10) AS gap FROM pages),
t AS (
  SELECT page_id, head || strlen(body) || gap || body || gap AS a,
    CASE WHEN page_id % 97 = 13 THEN head || strlen('?' || substr(body, 2)) || gap || '?' || substr(body, 2) || gap END AS b FROM r),
d AS (
  SELECT page_id, strlen(a) AS length, sha256(a) AS digest, coalesce(strlen(b), strlen(a)) AS other_length, coalesce(sha256(b), sha256(a)) AS other_digest FROM t),
o AS (
  SELECT *, printf('warc-%06d', page_id // 256) AS file,
    coalesce(sum(length) OVER (PARTITION BY page_id // 256 ORDER BY page_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM d)
SELECT file, "offset", CASE WHEN page_id % 211 = 5 THEN 'missing' ELSE 'corrupt' END AS status, length::BIGINT AS length, digest,
  CASE WHEN page_id % 211 = 5 THEN NULL ELSE other_length END::BIGINT AS other_length, CASE WHEN page_id % 211 = 5 THEN NULL ELSE other_digest END AS other_digest
FROM o WHERE page_id % 211 = 5 OR digest <> other_digest
"""
