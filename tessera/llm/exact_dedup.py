"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, bounded_semi, lower_ascii, only


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=lower_ascii, prefix_chars: int = 64, digest_all: bool = False, key: Column | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, digest, and with a `key` key.

    Rows are equal if their normalised texts are (default: A-Z lower-cased, null as empty). Of a
    group the largest id stays; null ids rank below all others, and a group of null ids keeps null.
    Rows that repeat an id and a text are one document, so they are kept or dropped together; with a
    `key` (a column that tells rows apart) the one of them with the largest key stays.
    digest is the SHA-256 of the normalised text, null for rows proved unique without it unless
    `digest_all`. Other columns are ignored; an empty table gives an empty result.

    Lengths that occur once leave after the first step, (length, prefix hash) pairs that occur once
    after the second. The full content is hashed only for the rest, inside the scan: no text is
    shuffled. When the surviving pairs are too many to broadcast (counted), each row is hashed.
    """
    spark = docs.sparkSession
    keyed = [] if key is None else ["key"]
    texts = only(docs, doc_id=id_col, text=text_col, **{k: key for k in keyed}).select("doc_id", *keyed, normalise(F.col("text")).alias("norm"))
    texts = texts.withColumns({"n": F.octet_length("norm"), "head": F.xxhash64(F.substring("norm", 1, prefix_chars))})
    with Scratch(spark) as scratch:
        cheap = scratch.table(texts.select("n", "head"), "cheap")
        lengths = cheap.groupBy("n").count().filter("count > 1").select("n")
        left = bounded_semi(cheap, lengths, ["n"])
        pairs = scratch.table(left.groupBy("n", "head").count().filter("count > 1").select("n", "head"), "pairs")
        few = pairs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        if few:
            texts = texts.join(F.broadcast(pairs.withColumn("survives", F.lit(True))), ["n", "head"], "left")
        else:
            texts = texts.withColumn("survives", F.lit(True))
        full = F.unhex(F.sha2("norm", 256))
        digests = scratch.table(texts.select("doc_id", *keyed, "survives", (full if digest_all else F.when(F.col("survives"), full)).alias("digest")), "digests")
        groups = digests.filter("survives").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), *[F.max(F.struct("doc_id", "key")).alias("keeper") for _ in keyed])
        groups = scratch.table(groups.filter("group_size > 1"), "groups")
        found = digests.join(groups, "digest", "left")
        keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
        if keyed:
            stays = F.col("group_size").isNull() | (F.col("keeper.key") == F.col("key"))
            return found.select("doc_id", "key", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), stays.alias("kept"), "digest").checkpoint()
        return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "digest").checkpoint()
