"""Token counts behind a cache of content digests.

The cache is a table of (tokenizer digest, content digest, tokens).  Content is joined to it by digest;
only distinct contents without a stored count are encoded, and their counts are appended.  An append
is one committed write, so a lost executor leaves either the whole of it or nothing.

Content is normalised only as far as counts allow: a null text is an empty one, and texts are compared
as UTF-8.  Defined results: repeated rows get the same count each; a text of any length is counted whole;
an empty table gives an empty result and leaves the cache as it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import tokens
from riskframe.session import fresh_path, materialise

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
_CACHE = "digest binary, n_tokens bigint, tokenizer string"


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for one tokenizer version; empty if there is no cache yet."""
    try:
        stored = spark.read.schema(_CACHE).parquet(cache)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], _CACHE)
    # Two writers may have stored the same digest; their counts are the same.
    return stored.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill(contents: DataFrame, cache: str, tokenizer: str) -> None:
    """Count what the cache lacks of ``contents`` (digest, text) and append it."""
    spark = contents.sparkSession
    version = tokens.version(tokenizer)
    missing = contents.dropDuplicates(["digest"]).join(cached(spark, cache, version), "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = tokens.count(batch.column("text"), tokenizer)
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], names=["digest", "n_tokens"]
            )

    counted = missing.select("digest", "text").mapInArrow(encode, "digest binary, n_tokens bigint")
    counted.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)


def count(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, limit: int = LIMIT, cache: str | None = None
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row; ``cache`` is a folder to keep, else one is made."""
    cache = cache or fresh_path(docs.sparkSession, "token-cache")
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.col(key), content.alias("text"), F.unhex(F.sha2(content, 256)).alias("digest"), F.octet_length(content).cast("long").alias("n_bytes")
    )
    fill(keyed.select("digest", "text"), cache, tokenizer)
    # Written, so that both sides of the join come straight from a shuffle and Spark can split a content that a
    # large share of the rows has.
    counts = materialise(cached(docs.sparkSession, cache, tokens.version(tokenizer)), "token-counts")
    return keyed.drop("text").join(counts, "digest").select(
        key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
