"""Token counts by a digest cache: texts are joined by the digest of their normalised content to
stored counts of one tokenizer version, and only distinct misses are encoded and appended."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_semi, only
from .shingles import as_bytes, small
from .tokenizing import encoder_of, file_digest

CACHE_SCHEMA = "digest binary, n_tokens long"


def _stored(spark, cache_path: str, version: str) -> DataFrame:
    """Counts of one version; an absent folder is an empty cache."""
    path = f"{cache_path}/{version}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def _counter(tokenizer: str):
    def count(batches):
        encoder = encoder_of(tokenizer)
        for batch in small(batches):
            counts = [len(ids) for ids in encoder.encode_all(as_bytes(batch["text"]))]
            yield pa.RecordBatch.from_arrays([batch["digest"], pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return count


def token_counts(docs: DataFrame, tokenizer: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text", normalise=lambda t: F.coalesce(t, F.lit(""))) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens.

    `normalise` must not change a text's count; the default only makes null texts empty. Empty texts
    count 0. Repeated rows and equal texts share one encoding; each row is returned, null ids too.
    Other columns are ignored. Cached counts are keyed by the SHA-256 of the content and of the
    tokenizer file, so another file never reads them. One job at a time may append to a cache.

    Only narrow rows are shuffled for the lookup. Texts of misses move once, combined before the
    shuffle; if few texts are missing (a counted bound), only theirs.
    """
    spark, version = docs.sparkSession, file_digest(tokenizer)
    texts = only(docs, doc_id=id_col, text=text_col).withColumn("text", normalise(F.col("text")))
    texts = texts.withColumn("digest", F.unhex(F.sha2(F.col("text"), 256)))
    with Scratch(spark) as scratch:
        rows = scratch.table(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "rows")
        misses = scratch.table(rows.select("digest").distinct().join(_stored(spark, cache_path, version), "digest", "left_anti"), "misses")
        if misses.limit(1).count():
            one_each = texts.groupBy("digest").agg(F.first("text").alias("text"))
            bounded_semi(one_each, misses, ["digest"]).mapInArrow(_counter(tokenizer), CACHE_SCHEMA).write.mode("append").parquet(f"{cache_path}/{version}")
        return rows.join(_stored(spark, cache_path, version), "digest").select("doc_id", "n_bytes", "n_tokens").checkpoint()
