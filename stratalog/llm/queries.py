"""Registered queries of this subpackage, over the tables of a folder."""

from __future__ import annotations

from zlib import crc32

from public_tokenizers import PATTERN
from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from stratalog.llm import decontamination, ngram_join, packing, periodic_runs, sharding, substring_dedup, suffix_dedup, token_alignment, token_counts, toxicity, url_rules, vector_search, warc_fixity


#: The tokenizer of packing: its file, the same vocabulary as ranks, and the expression that cuts texts.
BYTE_BPE = (tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"), PATTERN)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *BYTE_BPE)


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc_fixity.audit(warc_fixity.records(pages), warc_fixity.damaged(pages))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, sf_dir, "pages"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"), *BYTE_BPE[1:], tokenizer_path("piece_bpe_32k.model"))


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by their ids' checksums, end in words that repeat."""
    h = crc32(str(doc_id).encode())
    if h % 10 or doc_id is None:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


def op12_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summary(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), planted_period))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.summary(suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_toxicity, op3_sharding, op4_best_fit_packing, op5_warc_fixity,
        op6_benchmark_decontamination, op7_url_filters, op8_exact_top_k, op9_token_counts, op10_ngram_jaccard_join,
        op11_cross_tokenizer_alignment, op12_periodic_run_detection, op13_suffix_array_dedup,
    )
}
ORACLE_SQL: dict[str, str] = {"op1_substring_dedup": substring_dedup.ORACLE, "op10_ngram_jaccard_join": ngram_join.ORACLE, "op13_suffix_array_dedup": suffix_dedup.ORACLE, "op6_benchmark_decontamination": decontamination.ORACLE, "op3_sharding": sharding.oracle(), "op5_warc_fixity": warc_fixity.ORACLE, "op7_url_filters": url_rules.ORACLE, "op8_exact_top_k": vector_search.ORACLE}
