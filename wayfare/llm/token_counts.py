"""Token counts through a digest cache.

A text is known by the SHA-256 of its content (null counts as the empty text), a
tokenizer by the SHA-256 of its file. Counts are looked up by both; only distinct
texts without a stored count are encoded, and their counts are appended to the
cache, which is a Parquet folder partitioned by tokenizer.

Empty texts have no tokens. Repeated rows are encoded once and each get a row; a
null doc_id is carried along. Only doc_id and text are read. An empty table gives
an empty result and adds nothing to the cache.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import text_of
from wayfare.llm.tokens import worker_encoder

CACHE_SCHEMA = "content_digest binary, n_tokens bigint, tokenizer_digest string"
MAX_TOKENS = 1024


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def read_cache(spark: SparkSession, cache_path: str, tokenizer: str) -> DataFrame:
    """content_digest, n_tokens of one tokenizer; a cache that is not there yet is made, empty."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").partitionBy("tokenizer_digest").parquet(cache_path)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer_digest") == tokenizer)
    # two jobs may have stored the same text at the same time; by both columns, so that a join still deals
    # this side out by digest itself and can split a digest that many documents share
    return stored.select("content_digest", "n_tokens").distinct()


def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops rows whose digest was met before in this partition."""
    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for i, digest in enumerate(batch.column(0).to_pylist()):
            if digest not in seen:
                seen.add(digest)
                keep.append(i)
        if keep:
            yield batch.take(pa.array(keep, pa.int64()))


def counter(path: str):
    """A function for mapInArrow: digest, text to digest, n_tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, True, len)
        for batch in first_of_each(batches):
            counts = [sum(encoder.text(text)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], names=["content_digest", "n_tokens"]
            )

    return count


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``max_tokens``) of every row; new counts stay in the cache."""
    spark, tokenizer = docs.sparkSession, tokenizer_digest(tokenizer_path)
    keyed = docs.select("doc_id", text_of().alias("t")).select(
        "doc_id", "t", F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("content_digest")
    )
    # copies are dropped before the shuffle, so a text that fills a third of the table arrives once per task
    texts = keyed.select("content_digest", "t").mapInArrow(first_of_each, "content_digest binary, t string")
    misses = texts.repartition("content_digest").join(read_cache(spark, cache_path, tokenizer), "content_digest", "left_anti")
    fresh = misses.mapInArrow(counter(tokenizer_path), "content_digest binary, n_tokens bigint")
    (
        fresh.withColumn("tokenizer_digest", F.lit(tokenizer))
        .write.mode("append").partitionBy("tokenizer_digest").parquet(cache_path)
    )
    sized = keyed.select("doc_id", F.octet_length("t").cast("long").alias("n_bytes"), "content_digest")
    return sized.join(read_cache(spark, cache_path, tokenizer), "content_digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit")
    )
