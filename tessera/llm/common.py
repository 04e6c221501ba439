"""What the training-data operators share: scratch tables, text columns and bounded broadcasts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of narrow keys (at most 48 bytes each) that an operator broadcasts; the count is
#: taken first, and beyond it the same join is done by a shuffle.
BROADCAST_ROWS = 500_000

ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

#: Whether Spark removes the shuffle files of a query when it ends, and not when the driver's garbage is
#: collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Word separators of the contracts: space, tab, line feed, vertical tab, form feed, return.
SEPARATORS = "[\\x20\\x09-\\x0D]+"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the cluster's spark.checkpoint.dir, else the one already
    set on the context, else a new temporary folder, if all tasks run on this machine. A cluster must
    name a shared folder: without one this raises."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tessera-checkpoints-"))
    return named or context.getCheckpointDir()


def bound_batches(spark: SparkSession) -> None:
    """Bounds the bytes of an Arrow batch in this session, unless a smaller bound holds: texts may be long,
    and both sides hold whole batches. It stays, as results may be computed later; it changes nothing
    but memory."""
    if int(re.sub(r"\D", "", spark.conf.get(ARROW_BYTES))) > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


class Scratch:
    """Parquet tables in the shared folder that live as long as the `with` block.

    Tables are written by Spark's own writers, so a lost executor costs a task, not the table.
    Results that outlive the block leave it by `checkpoint`, whose files Spark's cleaner removes.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        bound_batches(spark)
        self.root = f"{checkpoint_dir(spark)}/tessera-scratch-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def drop(self, *names: str) -> None:
        """Removes tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        held = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")  # a stored table needs its shuffles no more
        try:
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(self.path(name))
        finally:
            self.spark.conf.set(CLEANUP, held)
        return self.spark.read.schema(df.schema).parquet(self.path(name))


def only(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Just the named columns under fixed names, whatever else the table holds or calls them."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def file_row(df: DataFrame) -> Column | None:
    """A struct of two longs that tells the rows of stored tables apart: the file (by hash) and the
    place in it. None if rows don't come straight from files."""
    hidden = df._jdf.queryExecution().analyzed().metadataOutput()
    kinds = [hidden.apply(k).dataType().simpleString() for k in range(hidden.size()) if hidden.apply(k).name() == "_metadata"]
    if len(kinds) != 1 or "row_index" not in kinds[0] or "_metadata" in df.columns:
        return None
    return F.struct(F.xxhash64("_metadata.file_path").alias("a"), F.col("_metadata.row_index").alias("b"))


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """`file_row`, or without files 128 bits of hashes of id and text, which rows that repeat both share."""
    found = file_row(df)
    return F.struct(F.xxhash64(df[id_col], df[text_col]).alias("a"), F.xxhash64(F.lit(1), df[text_col], df[id_col]).alias("b")) if found is None else found


def words(text: Column) -> Column:
    """The words of a text: maximal runs of anything but the six separators; none if null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is; null counts as empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def bounded_semi(big: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi", most: int = BROADCAST_ROWS) -> DataFrame:
    """Semi or anti join of rows with texts against narrow distinct keys. The keys are broadcast
    if a count proves at most `most` of them; else Spark shuffles, with equal results."""
    few = keys.limit(most + 1).count() <= most
    return big.join(F.broadcast(keys) if few else keys, on, how)
