"""The training-data pipeline over `documents`: select by quality, drop exact copies, keep one
document of each near-duplicate group, mix sources to target weights, pack into sequences.

Each stage takes the rows its predecessor stored and decides on each row by itself: rows that repeat
an id, or have none, are told apart by where they are stored. Null and empty texts, very long ones,
ties, empty tables and further columns have the results that the operators define; all stages but
the last return the columns of their input, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, Scratch, file_row
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.jaccard_join import near_duplicates
from tessera.llm.mixing import mix_sources
from tessera.llm.packing import pack_documents
from tessera.llm.quality_classifier import select_quality


def _with_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a column that tells its rows apart, and its name: where a row is stored. Rows that
    don't come straight from files are stored first."""
    name = "_key"
    while name in docs.columns:
        name += "_"
    key = file_row(docs)
    if key is not None:
        return docs.withColumn(name, key), name
    return docs.withColumn(name, F.struct(F.monotonically_increasing_id().alias("a"), F.lit(0).cast("long").alias("b"))).checkpoint(), name


def _keep(docs: DataFrame, judge, kept: str) -> DataFrame:
    """The rows of `docs` whose verdict by `judge(docs, key)` is `kept`. The smaller side, the keys of
    dropped rows, is joined; it is broadcast if a count proves it small."""
    columns = docs.columns
    docs, name = _with_key(docs)
    with Scratch(docs.sparkSession) as scratch:
        dropped = scratch.table(judge(docs, F.col(name)).filter(f"NOT {kept}").select(F.col("key").alias(name)), "dropped")
        few = dropped.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        dropped = dropped.checkpoint()
    return docs.join(F.broadcast(dropped) if few else dropped, name, "left_anti").select(columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that importance resampling selects, by the labels in the same folder. Null and empty texts
    weigh as much as texts without evidence; rows without an id share one draw."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _keep(docs, lambda df, key: select_quality(df, labels, key=key), "selected")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts equal but for the case of A-Z: the one with the largest id, of
    rows that repeat it any one. Null and empty texts are one group."""
    return _keep(docs, lambda df, key: exact_dedup(df, key=key), "kept")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicates (five words, 0.8): the one with the least id, of
    rows that repeat it any one. Texts without words all stay."""
    return _keep(docs, lambda df, key: near_duplicates(df, n=5, percent=80, key=key), "kept")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix repeats it: 0, 1 or 2 times with the default weights. Rows without
    words are taken as often as the mix repeats them too, as they add nothing to a source's words."""
    columns = docs.columns
    docs, name = _with_key(docs)
    times = mix_sources(docs, key=F.col(name)).filter("repetitions > 0").select(F.col("key").alias(name), F.sequence(F.lit(1), "repetitions").alias("_copies"))
    held = docs.select(F.struct(*[F.col(c) for c in columns]).alias("_row"), name).join(times, name)
    return held.select("_row", F.explode("_copies")).select("_row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows, placed in sequences of at most 2048 tokens; a row that the mix repeats is
    packed as often. A null or empty text is the end id alone."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

#: Scores of a fitted model and seeded draws decide the first stage, so SQL can't give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage makes of `documents`: piece, start, length, ids_crc32, sequence_id, offset."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Scratch(spark) as scratch:
        for k, (_, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if k + 1 < len(STAGES):
                docs = scratch.table(docs, f"stage-{k}")
                if k:
                    scratch.drop(f"stage-{k - 1}")
        return docs
