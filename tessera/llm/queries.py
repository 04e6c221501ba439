"""The contract queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, only
from .exact_dedup import exact_dedup
from .html_extraction import extract_pages
from .jaccard_join import near_duplicates
from .mixing import mix_sources
from .packing import pack_documents
from .quality_classifier import select_quality
from .quality_rules import BOILERPLATE, clean_lines
from .sharding import plan_files, read_shards, rewrite_shards, row_size, write_shards
from .token_counts import token_counts
from .token_output import stored_tokens

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_tokens(_read(spark, sf_dir), _tokenizer("word_bpe_49k.json"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """32 shards by hash of the id are stored; a plan then makes 40 of equal bytes of them in place. All
    columns come from the files as they are in the end."""
    rows = only(_read(spark, sf_dir), doc_id="doc_id", text="text")
    rows = rows.withColumns({"old_shard": F.pmod(F.xxhash64("doc_id"), F.lit(32)).cast("int"), "shard": F.pmod(F.xxhash64("doc_id"), F.lit(32)).cast("int")})
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, old_shard int"
    with Scratch(spark) as scratch:
        path = scratch.path("shards")
        write_shards(rows, path, scratch)
        _, cuts = plan_files(spark, schema, path, 40)
        rewrite_shards(spark, schema, path, cuts)
        found = read_shards(schema, path, scratch)
        crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
        return found.select("doc_id", row_size(F.col("text")).alias("size"), crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard").checkpoint()


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir), _tokenizer("byte_bpe_50k.json"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir), n=3, percent=90, links=True)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(_read(spark, sf_dir)).drop("clean_text")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_read(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "repetitions")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_read(spark, sf_dir, "pages"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(_read(spark, sf_dir), digest_all=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over a cache of its own, empty at first: each run encodes every distinct text."""
    with Scratch(spark) as scratch:
        found = token_counts(_read(spark, sf_dir), _tokenizer("byte_bpe_50k.json"), scratch.path("cache"))
    return found.withColumn("over_limit", F.col("n_tokens") > 1024)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_quality(_read(spark, sf_dir), _read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_quality_rules": op5_quality_rules,
    "op6_mixing": op6_mixing,
    "op7_html_extraction": op7_html_extraction,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_quality_classifier": op10_quality_classifier,
}

_SEPARATORS = "[\\x20\\x09-\\x0D]"
_QUALITY_SQL = rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{_SEPARATORS}+'), lambda x: x <> '') AS w, string_split(text, chr(10)) AS lines FROM t),
    windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS place, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS x FROM w WHERE len(w) > 8),
    twice AS (SELECT doc_id, place FROM (SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, x) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT doc_id, CAST(sum(least(8, coalesce(later - place, 8))) AS BIGINT) AS n FROM (SELECT doc_id, place, lead(place) OVER (PARTITION BY doc_id ORDER BY place) AS later FROM twice) GROUP BY doc_id),
    line AS (SELECT doc_id, unnest(lines) AS x FROM w),
    judged AS (SELECT doc_id, x, regexp_matches(x, '[^\x20\x09-\x0D]') AS has_word, len(list_filter(regexp_split_to_array(x, '{_SEPARATORS}+'), lambda y: y <> '')) AS n,
        len(regexp_extract_all(x, '[#*$%&<>]{{2,}}|!{{2,}}')) AS runs, length(x) - length(regexp_replace(x, '[|»›•]', '', 'g')) AS items FROM line),
    loss AS (SELECT doc_id, sum(length(x)) AS everything, sum(length(x)) FILTER (has_word AND NOT (
        (regexp_matches(right(x, 6), '[.!?…。！？:;]["''”»)\]]*{_SEPARATORS}*$') OR regexp_matches(x, '[.!?…]\x20') OR n < 3)
        AND (runs = 0 OR 4 * runs <= n) AND (items = 0 OR 4 * items <= n) AND NOT regexp_matches(lower(x), '{"|".join(BOILERPLATE)}'))) AS lost FROM judged GROUP BY doc_id),
    base AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
        coalesce(c.n, 0) AS n_repeat_words FROM w LEFT JOIN covered c USING (doc_id))
    SELECT b.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND coalesce(lost, 0) <= 0.5 * everything AS kept
    FROM base b JOIN loss USING (doc_id)"""

SQL: dict[str, str] = {
    "op5_quality_rules": _QUALITY_SQL,
    "op8_exact_dedup": f"""
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM t""",
}
