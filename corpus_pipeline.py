"""Corpus pipeline: five stages, each over all that its predecessor kept, written as Parquet and read again.

Toxic documents go; of each group of near copies the one with the smallest id stays; passages that smaller ids hold too
are cut out of the texts; documents with a benchmark item go; the rest is packed into token sequences.

Defined results, of each stage: rows without an id, null and empty texts stay until the packing, which counts a null text
as empty; texts of any length are taken whole; equal rows of one id count as copies, of which the join keeps one; an empty
table gives an empty one; columns beyond those of documents, whatever their names, are kept by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalog.functions.shared import cut, removed, written
from stratalog.llm.decontamination import contaminated
from stratalog.llm.ngram_join import jaccard_groups
from stratalog.llm.packing import pack
from stratalog.llm.queries import BYTE_BPE
from stratalog.llm.substring_dedup import without_repeats
from stratalog.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents, that with the smallest id; rows without an id stay.

    Rows of one id are judged by their texts: those that link nothing stay as far as their texts differ.
    """
    # five values a row, read three times below
    found = cut(jaccard_groups(docs.select("doc_id", "text")).where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "tag", "leads", "n_shingles"))
    # texts of one id with the leading set, which differ in case or white space: the one with the least key stands for it
    same = found.where("leads AND n_shingles > 0").groupBy("id", "tag").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most").select("id", "tag", "least")
    beside = found.where("leads AND n_shingles > 0").join(same, ["id", "tag"]).where("key > least")
    gone = found.where("NOT leads").select("id", "key").union(beside.select("id", "key")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    kept = rows.join(gone, ["id", "key"], "left_anti")
    # equal texts of one id are copies
    again = rows.where("id IS NOT NULL").groupBy("id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "key")
    one = Window.partitionBy("id", "key", "row.text").orderBy(F.to_json("row"))
    repeats = kept.join(again, ["id", "key"], "left_semi").withColumn("nth", F.row_number().over(one)).where("nth = 1")
    return kept.join(again, ["id", "key"], "left_anti").select("row").union(repeats.select("row")).select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a similar window; rows without an id stay."""
    found = contaminated(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, *BYTE_BPE)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
#: SQL can't express a trained network; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces; a stage's table goes once the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(STAGES):
        out = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if n:
            removed(docs)
        docs = out
    return docs
