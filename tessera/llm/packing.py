"""Best-fit decreasing packing of tokenized documents into sequences of bounded length."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, only
from .shingles import as_bytes, small
from .tokenizing import encoder_of


class OpenBins:
    """Open bins by remaining capacity, under a segment tree that finds the tightest capacity that
    holds a length in logarithmic time. Bins with equal remaining capacity are interchangeable, so
    they are held as runs of consecutive numbers (first, count)."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.used = [False] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, remaining: int) -> None:
        node = remaining + self.leaves
        self.used[node] = bool(self.runs[remaining])
        while node > 1:
            node //= 2
            self.used[node] = self.used[2 * node] or self.used[2 * node + 1]

    def add(self, remaining: int, first: int, count: int) -> None:
        if count and remaining:
            self.runs[remaining].append((first, count))
            self._mark(remaining)

    def take(self, remaining: int) -> tuple[int, int]:
        run = self.runs[remaining].pop()
        self._mark(remaining)
        return run

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of an open bin that is at least `length`."""
        node = length + self.leaves
        if length >= len(self.runs):
            return None
        if self.used[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.used[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.used[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over all pieces, given how many there are of each length.

    Returns placements (length, pieces, pieces a bin, first bin, offset) in the order of the pieces
    of a length, and the number of bins. The result is that of placing piece by piece: a piece goes
    to the fullest bin that holds it, and the next one of its length to the same bin while it fits.
    """
    bins, placed, made = OpenBins(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            remaining = bins.tightest(length)
            fresh = remaining is None
            remaining = capacity if fresh else remaining
            each = remaining // length
            if fresh:
                first, many = made, max(1, left // each)
                made += many
            else:
                first, many = bins.take(remaining)
            use = min(many, left // each)
            if use == 0:
                use, each = 1, left
            placed.append((length, use * each, each, first, capacity - remaining))
            left -= use * each
            bins.add(remaining, first + use, many - use)
            bins.add(remaining - each * length, first, use)
    return placed, made


def _cut(tokenizer: str, capacity: int, end_id: int, with_ids: bool):
    """Pieces of whole documents: ids and the end id; longer ones give 2nd and later pieces of full
    length and a first one with what is left over."""

    def pieces(batches):
        encoder, end = encoder_of(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
        for batch in small(batches):
            at, rows = [], []
            for k, ids in enumerate(encoder.encode_all(as_bytes(batch["text"]))):
                raw = ids.astype("<u4").tobytes() + end
                n, start, piece = len(raw) // 4, 0, 0
                while start < n:
                    size = (n - start - 1) % capacity + 1 if not piece else capacity
                    part = raw[4 * start : 4 * (start + size)]
                    at.append(k)
                    rows.append((piece, start, size, zlib.crc32(part), *[part] * with_ids))
                    start, piece = start + size, piece + 1
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)] if rows else [pa.array([], t) for t in kinds[: len(names) - 1]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(at, pa.int64())), *columns], names)

    return pieces


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A null or empty text is the end id alone. Repeated rows are packed as often as they occur, and
    null ids are packed too; pieces that tie in all columns are interchangeable. Other columns are
    ignored. An empty table gives an empty result.

    Best fit depends on lengths only, and there are at most `capacity` of them: the counts go to the
    driver, which places all pieces at once, in runs; the runs, bounded by lengths and not by rows,
    go back to the executors. A piece finds its run by its rank among the pieces of its length,
    counted in two steps (inside hash buckets, then over buckets), so that a length that a third of
    all pieces share is spread over many tasks. No text is shuffled.
    """
    spark = docs.sparkSession
    texts = only(docs, doc_id=id_col, text=text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    with Scratch(spark) as scratch:
        pieces = scratch.table(texts.mapInArrow(_cut(tokenizer, capacity, end_id, with_ids), schema), "pieces")
        buckets = max(64, pieces.count() // 200_000)
        bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")
        pieces = pieces.withColumn("bucket", bucket)
        sums = scratch.table(pieces.groupBy("length", "bucket").agg(F.count("*").alias("n")), "sums")
        counts = {r.length: r.n for r in sums.groupBy("length").agg(F.sum("n").alias("n")).collect()}
        placed, _ = best_fit(counts, capacity)
        before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        bases = sums.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start"))
        ranked = pieces.withColumn("inside", inside).join(bases, ["length", "bucket"])
        ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, (F.col("base") + F.col("inside") - 1).alias("rank"))
        runs = np.array(placed, dtype=np.int64).reshape(-1, 5)
        firsts = np.zeros(len(runs), np.int64)  # ranks at which the runs of a length begin
        for k in range(1, len(runs)):
            firsts[k] = firsts[k - 1] + runs[k - 1, 1] if runs[k, 0] == runs[k - 1, 0] else 0
        order = np.lexsort((firsts, runs[:, 0])) if len(runs) else np.zeros(0, np.int64)
        shared = spark.sparkContext.broadcast((runs[order], firsts[order]))

        def place(batches):
            runs, firsts = shared.value
            keys = (runs[:, 0].astype(np.uint64) << np.uint64(44)) + firsts.astype(np.uint64)
            for batch in batches:
                length, rank = np.asarray(batch["length"]), np.asarray(batch["rank"])
                at = np.searchsorted(keys, (length.astype(np.uint64) << np.uint64(44)) + rank.astype(np.uint64), "right") - 1
                nth = rank - firsts[at]
                sequence, offset = runs[at, 3] + nth // runs[at, 2], runs[at, 4] + nth % runs[at, 2] * length
                kept = [n for n in batch.schema.names if n != "rank"]
                yield pa.RecordBatch.from_arrays([*[batch[n] for n in kept], pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

        return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long").checkpoint()


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences of placements made `with_ids`: sequence_id, n_tokens, ids. A sequence
    gathers at most its capacity of ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
