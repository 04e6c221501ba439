"""Token-id output: documents in order of their ids, as blocks of range-coded token ids."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, only
from .jvm_coder import decoded, encoded, register
from .range_coder import BLOCK
from .shingles import as_bytes, small
from .tokenizing import encoder_of
from .workers import give_back, lean

_DOC = pa.struct([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64())])
_FILE = [("part", pa.int32()), ("block", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("docs", pa.list_(_DOC)), ("data", pa.binary())]
#: The file format: Parquet rows of one block each. part: the stretch of documents; block: its number
#: there; first: the place of its first id in the part; n: its ids; docs: the documents it holds ids
#: of, with the place of their first id in the part; data: the coded block with its checksum.
FILE_SCHEMA = "part int, block long, first long, n long, docs array<struct<doc_id:long,at:long,n_tokens:long>>, data binary"

#: Bytes of the input, as stored, that a task codes.
PART_BYTES = 64 << 20

#: Blocks of ids that a task gathers before it gives them out.
HELD = 64


def _writer(tokenizer: str, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches):
        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        held, docs, done, total = bytearray(), [], 0, 0  # ids and documents from place `done` on

        def blocks(last: bool):
            nonlocal held, docs, done
            size = len(held) // 4
            many = -(-size // BLOCK) if last else size // BLOCK
            rows, k = [], 0
            for b in range(many):
                block = bytes(held[4 * b * BLOCK : 4 * (b + 1) * BLOCK])
                first, n = done + b * BLOCK, len(block) // 4
                inside, j = [], k
                while j < len(docs) and docs[j]["at"] < first + n:
                    inside.append(docs[j])
                    j += 1
                k = j - 1 if inside and inside[-1]["at"] + inside[-1]["n_tokens"] > first + n else j
                rows.append((part, first // BLOCK, first, n, inside, block))
            docs = docs[k:]
            done += min(size, many * BLOCK)
            held = held[4 * many * BLOCK :]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FILE, strict=True)], [n for n, _ in _FILE])

        for batch in small(batches, size=1 << 20):
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoder.encode_all(as_bytes(batch["text"])), strict=True):
                raw = ids.astype("<u4").tobytes() + end
                docs.append({"doc_id": doc_id, "at": total, "n_tokens": len(raw) // 4})
                total += len(raw) // 4
                held += raw
                if len(held) >= 4 * BLOCK * HELD:
                    yield from blocks(False)
        yield from blocks(True)
        give_back()

    return write


def _parts(docs: DataFrame) -> int:
    least, size = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, size // PART_BYTES + 1) if size < 1 << 60 else least  # beyond it the size isn't known


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> None:
    """Writes the ids of all documents, each with `end_id` after it, in ascending order of doc_id.

    Null texts are empty, null ids come first. Rows that repeat an id follow each other, ordered by
    their texts' hashes. Very long texts go over as many blocks as they need. Texts are dealt by
    ranges of ids into `parts` stretches (by default as many as the session's shuffle partitions, or one
    for each PART_BYTES of the input if that is more), each coded by a task of its own, whose Python worker
    gives the ids in whole blocks, HELD of them at a time, and whose JVM codes one block after another.
    """
    register(docs.sparkSession)
    parts = parts or _parts(docs)
    rows = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    blocks = rows.mapInArrow(_writer(tokenizer, end_id), FILE_SCHEMA).withColumn("data", encoded(F.col("data")))
    blocks.write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def _zeros_crc(crc: int, n: int) -> int:
    while n:
        step = min(n, 1 << 22)
        crc, n = zlib.crc32(bytes(step), crc), n - step
    return crc


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of what (bytes, CRC-32) pairs stand for, one after another: CRCs are linear, so the
    first part's is carried over the second's length by zero bytes."""
    crc = 0
    for n, own in parts:
        crc = _zeros_crc(crc, n) ^ _zeros_crc(0, n) ^ own
    return crc


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decoded blocks, cut at documents: part, at, doc_id, n_tokens, piece_at, n, crc (and ids). A damaged
    block fails the query."""
    register(spark)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # Behind a one-row generator a block is decoded once, whatever is taken from it.
    blocks = files.select("part", "first", "n", "docs", F.explode(F.array(decoded(F.col("data")))).alias("ids"))

    def piece(d):
        a, b = F.greatest(d["at"], "first"), F.least(d["at"] + d["n_tokens"], F.col("first") + F.col("n"))
        raw = F.substring("ids", (4 * (a - F.col("first")) + 1).cast("int"), (4 * (b - a)).cast("int"))
        fields = {"at": d["at"], "doc_id": d["doc_id"], "n_tokens": d["n_tokens"], "piece_at": a, "n": b - a, "crc": F.crc32(raw)} | ({"ids": raw} if with_ids else {})
        return F.struct(*[c.alias(name) for name, c in fields.items()])

    return blocks.select("part", F.inline(F.transform("docs", piece)))


def _part_bases(spark: SparkSession, path: str) -> DataFrame:
    """Ids before each part; there are as many parts as the writer had tasks."""
    totals = spark.read.schema(FILE_SCHEMA).parquet(path).groupBy("part").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def _join_pieces(batches):
    for batch in batches:
        crcs = [joined_crc([(4 * p["n"], p["crc"]) for p in parts]) for parts in batch["parts"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32. Decoding checks every
    block's checksum. Only checksums of pieces are gathered, one for each block a document touches."""
    pieces = read_pieces(spark, path)
    docs = pieces.groupBy("part", "at").agg(F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("piece_at", "n", "crc"))).alias("parts"))
    docs = docs.join(_part_bases(spark, path), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "parts")
    return docs.mapInArrow(lean(_join_pieces), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id and its ids as an array, for readers that want the tokens."""
    pieces = read_pieces(spark, path, with_ids=True).groupBy("part", "at").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("piece_at", "ids"))).alias("parts"))

    def join(batches):
        for batch in batches:
            ids = [np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32) for parts in batch["parts"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return pieces.select("doc_id", "parts").mapInArrow(join, "doc_id long, ids array<int>")


def stored_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the files into a scratch folder and returns what they hold of each document."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        write_tokens(docs, scratch.path("tokens"), tokenizer, end_id)
        return scratch.table(read_documents(spark, scratch.path("tokens")), "documents").checkpoint()
