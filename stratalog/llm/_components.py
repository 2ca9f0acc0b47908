"""Connected components of an edge table, without leaving Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalog.functions.shared import cut


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and its neighbours v.

    A window, not a join with the groups' minima: the rows of u meet in one task either way, and one exchange and sort do.
    """
    return edges.withColumn("m", F.least(F.min("v").over(Window.partitionBy("u")), F.col("u")))


def _both(rows: DataFrame, one: tuple[str, str], other: tuple[str, str], names: tuple[str, str]) -> DataFrame:
    """Two pairs of columns of each row as two rows, without a second pass over what gives the rows."""
    pairs = (F.struct(F.col(a).alias(names[0]), F.col(b).alias(names[1])) for a, b in (one, other))
    return rows.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for each end of edges (a, b), component being its least reachable id.

    Alternates large-star and small-star steps until the edges are stars around their least nodes: logarithmically many
    rounds, each linear in the edges and cut off from the lineage of the former.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if not now.n or now == state:
            break
        state = now
        # one row of large for each edge, so its repeats can stay until the end of the round
        large = _with_least(_both(edges, ("a", "b"), ("b", "a"), ("u", "v"))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = _both(_with_least(large), ("v", "m"), ("u", "m"), ("a", "b"))
        edges = cut(stars.where("a <> b").distinct())
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
