"""Minimum-cost-flow resharding: block transfers that move the fewest bytes from old shard sizes to
new capacities, and the rewriting of the files that they touch."""

from __future__ import annotations

import uuid
from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch


def row_size(text: Column) -> Column:
    """UTF-8 bytes of a text (none if null) and 16 for the row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")


def min_cost_flow(n: int, edges: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow of each edge (from, to, capacity, cost) of a cheapest maximum flow, by successive
    shortest paths."""
    to, room, cost, out = [], [], [], [[] for _ in range(n)]
    for a, b, capacity, price in edges:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            out[x].append(len(to))
            to.append(y), room.append(c), cost.append(p)
    while True:
        far, via, queue, queued = [None] * n, [-1] * n, deque([source]), {source}
        far[source] = 0
        while queue:
            x = queue.popleft()
            queued.discard(x)
            for e in out[x]:
                y = to[e]
                if room[e] and (far[y] is None or far[x] + cost[e] < far[y]):
                    far[y], via[y] = far[x] + cost[e], e
                    if y not in queued:
                        queue.append(y), queued.add(y)
        if far[sink] is None:
            return [room[2 * k + 1] for k in range(len(edges))]
        path, x = [], sink
        while x != source:
            path.append(via[x])
            x = to[via[x] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount


def transfers(old: list[int], capacities: list[int]) -> list[list[tuple[int, int]]]:
    """For each old shard, (new shard, bytes) in the order of its byte line: what stays comes first.

    Keeping a byte costs nothing and moving it costs 1, whichever the shards; moves run through one
    common node, so the graph has as many edges as shards. Capacities must hold all bytes.
    """
    n, m = len(old), len(capacities)
    source, sink, hub = n + m, n + m + 1, n + m + 2
    edges = [(source, i, old[i], 0) for i in range(n)] + [(n + j, sink, capacities[j], 0) for j in range(m)]
    edges += [(i, n + i, old[i], 0) for i in range(min(n, m))] + [(i, hub, old[i], 1) for i in range(n)]
    edges += [(hub, n + j, capacities[j], 0) for j in range(m)]
    flow = min_cost_flow(n + m + 3, edges, source, sink)
    at = n + m
    stay = flow[at : at + min(n, m)] + [0] * (n - min(n, m))
    leave, enter = flow[at + min(n, m) : at + min(n, m) + n], flow[at + min(n, m) + n :]
    out, j = [[(i, stay[i])] if stay[i] else [] for i in range(n)], 0
    for i in range(n):
        left = leave[i]
        while left:
            while not enter[j]:
                j += 1
            amount = min(left, enter[j])
            out[i].append((j, amount))
            left, enter[j] = left - amount, enter[j] - amount
    return out


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def cut_line(sizes: list[int], parts: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """For each of the files on a shard's byte line its (shard, end) in order: the bytes up to `end` from
    the file's start go to the shard."""
    out, ends, at = [], [], 0
    for j, amount in parts:
        at += amount
        ends.append((j, at))
    start = k = 0
    for size in sizes:
        while k + 1 < len(ends) and ends[k][1] <= start:
            k += 1
        mine, last = [], k
        while last < len(ends):
            mine.append((ends[last][0], ends[last][1] - start))
            if ends[last][1] >= start + size:
                break
            last += 1
        out.append(mine)
        start += size
    return out


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def write_shards(rows: DataFrame, path: str, scratch: Scratch, shard_col: str = "shard", files_a_shard: int = 8, file_bytes: int = 128 << 20) -> None:
    """Writes `rows` (doc_id, text, an int column of the shard and more) as folders shard=0, shard=1, ...
    of several files each, at most about `file_bytes` of text and at least `files_a_shard` if there is
    enough of it.

    A shard's rows lie on a line of bytes, by size class (powers of two), the largest first, then by
    hash of id and text: the end of the line, which is what a later plan moves, is made of short
    documents. A file is a stretch of the line; its number is in the column _file. Each task writes
    one file. Null ids and texts hash like values. Of the sums of sizes, 16 for each shard and size
    class reach the driver.
    """
    spark = rows.sparkSession
    sized = rows.withColumnsRenamed({shard_col: "shard"}).withColumn("_size", row_size(F.col("text")))
    sized = sized.withColumns({"_class": -F.floor(F.log2("_size")).cast("int"), "_block": F.pmod(F.xxhash64("doc_id", "text"), F.lit(16)).cast("int")})
    sums = sorted(tuple(r) for r in sized.groupBy("shard", "_class", "_block").agg(F.sum("_size")).collect())
    files, fs = [], _folder(spark, path)
    fs[0].mkdirs(fs[1])
    if not sums:
        return
    totals: dict[int, int] = {}
    for shard, _, _, size in sums:
        totals[shard] = totals.get(shard, 0) + size
    starts, number, last = dict.fromkeys(totals, 0), -1, None
    for shard, kind, block, size in sums:
        stretch = starts[shard] * max(files_a_shard, -(-totals[shard] // file_bytes)) // totals[shard]
        number += (shard, stretch) != last
        last = (shard, stretch)
        files.append((shard, kind, block, number))
        starts[shard] += size
    where = spark.createDataFrame(files, "shard int, _class int, _block int, _file int")
    placed = sized.join(F.broadcast(where), ["shard", "_class", "_block"]).drop("_class", "_block", "_size")  # 16 rows a size class
    placed.repartitionById(number + 1, "_file").write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(path)


def _stored(spark: SparkSession, docs_schema: str, path: str) -> DataFrame:
    return spark.read.schema(f"{docs_schema}, _file int, shard int").parquet(path)


def plan_files(spark: SparkSession, docs_schema: str, path: str, shards: int) -> tuple[list[list[tuple[int, int]]], list[tuple[str, int, list[tuple[int, int]]]]]:
    """The transfers from the stored shards to `shards` of equal bytes, and for each file (path, shard,
    its cuts). A row for each file reaches the driver."""
    rows = _stored(spark, docs_schema, path)
    found = rows.groupBy(F.col("_metadata.file_path").alias("file"), "shard").agg(F.min("_file").alias("number"), F.sum(row_size(F.col("text"))).alias("size")).collect()
    found = sorted(found, key=lambda r: (r.shard, r.number, r.file))
    n_old = 1 + max((r.shard for r in found), default=-1)
    lines = [[r for r in found if r.shard == i] for i in range(n_old)]
    sizes = [[r.size for r in line] for line in lines]
    plan = transfers([sum(x) for x in sizes], equal_capacities(sum(map(sum, sizes)), shards)) if n_old else []
    cuts = [(r.file, r.shard, c) for line, size, parts in zip(lines, sizes, plan, strict=True) for r, c in zip(line, cut_line(size, parts), strict=True)]
    return plan, cuts


def affected(cuts: list[tuple[str, int, list[tuple[int, int]]]]) -> tuple[list[tuple[str, int]], list[tuple[str, list[tuple[int, int]]]]]:
    """Files that move whole, with their new shard, and files that a cut crosses, with their cuts; all
    others stay as they are."""
    moved = [(f, c[0][0]) for f, i, c in cuts if len(c) == 1 and c[0][0] != i]
    return moved, [(f, c) for f, _, c in cuts if len(c) > 1]


def rewrite_shards(spark: SparkSession, docs_schema: str, path: str, cuts: list[tuple[str, int, list[tuple[int, int]]]]) -> None:
    """Carries a plan out in place: files that move whole are renamed into their new shard's folder, and
    only files that a cut crosses are written again. In those, documents go by falling size, and each
    to where its middle lies; rows that repeat an id and a text tie, and either may go first.

    What is written anew lies beside the shards until it is whole; then the old files go and the new
    ones are renamed, so a lost executor costs a task, and a plan that broke off is made again from
    the files as they are.
    """
    moved, split = affected(cuts)
    if split:
        table = spark.createDataFrame([(f, [e for _, e in c], [j for j, _ in c]) for f, c in split], "_path string, _ends array<long>, _to array<int>")
        # Folders of shards give the column, so they are read from above.
        rows = _stored(spark, docs_schema, path).select("*", F.col("_metadata.file_path").alias("_path")).filter(F.col("_path").isin([f for f, _ in split]) if len(split) <= 1000 else F.lit(True))
        rows = rows.join(F.broadcast(table), "_path").withColumn("_size", row_size(F.col("text")))  # at most two files a shard and cut
        before = Window.partitionBy("_path").orderBy(F.desc("_size"), "doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1)
        middle = F.coalesce(F.sum("_size").over(before), F.lit(0)) + F.col("_size") / 2
        passed = F.size(F.filter("_ends", lambda e: e <= F.col("_middle")))
        rows = rows.withColumn("_middle", middle).withColumn("shard", F.col("_to")[F.least(passed, F.size("_to") - 1)])
        rows.drop("_path", "_ends", "_to", "_size", "_middle").write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(f"{path}/_new")
    fs, _ = _folder(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    uri = lambda f: hadoop.Path(spark._jvm.java.net.URI(f))

    def move(file, folder: str, name: str) -> None:
        fs.mkdirs(hadoop.Path(f"{path}/{folder}"))
        if not fs.rename(file, hadoop.Path(f"{path}/{folder}/{name}")):
            raise OSError(f"{file} can't be moved to {folder}")

    for file, shard in moved:
        move(uri(file), f"shard={shard}", uri(file).getName())
    for file, _ in split:
        fs.delete(uri(file), False)
    if split:
        for folder in fs.listStatus(hadoop.Path(f"{path}/_new")):
            if folder.isDirectory():
                for file in fs.listStatus(folder.getPath()):
                    if file.getPath().getName().startswith("part-"):  # a task names its files of all folders alike
                        move(file.getPath(), folder.getPath().getName(), f"part-{uuid.uuid4().hex}.zstd.parquet")
        fs.delete(hadoop.Path(f"{path}/_new"), True)


def read_shards(docs_schema: str, path: str, scratch: Scratch) -> DataFrame:
    """Rows of all shards with shard and slot: the row's place in its shard, files in name order."""
    rows = _stored(scratch.spark, docs_schema, path).drop("_file")
    rows = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    counts = scratch.table(rows.groupBy("shard", "_path").agg(F.count("*").alias("n")), "files")
    before = Window.partitionBy("shard").orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    few = counts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(bases) if few else bases, "_path").withColumn("slot", F.col("_base") + F.col("_row")).drop("_path", "_row", "_base")
