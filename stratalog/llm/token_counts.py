"""Token counts by a two-tier lookup on the map side.

A bounded sample of documents tells which pre-tokens are frequent; their lengths in tokens are broadcast as a compact
hash table. Pre-tokens that it lacks are encoded once per worker and kept in a bounded cache. No pre-token is shuffled:
the plan is a scan and a map. The sample decides speed only; every text is counted in full.

Defined results: a null or empty text has no bytes and no tokens; a null id stays null; each row gives a row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.llm._pretokens import CACHE_CHARS, Lengths, byte_pieces, encoder, kept, readable, sentence_pieces

#: Documents sampled for the broadcast table and their longest text (20 MB in all at most), and the table's entries of
#: at most 64 characters, under 10 MB.
SAMPLE_ROWS, SAMPLE_BYTES, HOT_ENTRIES = 1_000, 20_000, 32_768
LIMIT = 4096


def _pieces(path: str):
    return sentence_pieces if path.endswith(".model") else byte_pieces


def frequent_lengths(docs: DataFrame, path: str, sample_rows: int = SAMPLE_ROWS, entries: int = HOT_ENTRIES) -> dict[str, int]:
    """The most frequent pre-tokens of sample_rows documents, with their number of tokens."""
    cut, encode, seen = _pieces(path), encoder(path), Counter()
    short = docs.select(F.col("text").cast("binary").alias("body")).where(F.octet_length("body") <= SAMPLE_BYTES)
    for row in short.limit(sample_rows).collect():
        seen.update(x for x in cut(readable(bytes(row.body))) if len(x) <= CACHE_CHARS)
    return {x: len(encode(x)) for x, _ in seen.most_common(entries)}


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of docs (doc_id, text), by the tokenizer file at path."""
    hot = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, sample_rows))
    cut = _pieces(path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(kept(("encoder", path), lambda: encoder(path)), hot.value)
        lengths.cold = kept(("lengths", path), dict)
        get = lengths.__getitem__
        for batch in batches:
            n = [sum(map(get, cut(readable(body)))) for body in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.col("text").cast("binary").alias("body"))
    return text.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
