"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SEPARATORS, Scratch, only

BUCKETS = 1024


def text_size(text: Column) -> Column:
    """Words of a text; 0 if null."""
    text = F.coalesce(text, F.lit(""))
    return F.size(F.filter(F.split(text, SEPARATORS), lambda w: w != "")).cast("long")


def water_fill(sizes: list[int], weights: list[float], total: float, max_epochs: float) -> list[float]:
    """Targets in proportion to the weights; a source above max_epochs times its size is clamped
    there and what it can't take is shared among the others by weight, until none is above. If all
    are clamped, the rest of `total` can't be met and stays out. Sources without words get 0."""
    targets, free, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0 and weights[i] > 0], float(total)
    while free:
        share = left / sum(weights[i] for i in free)
        over = [i for i in free if share * weights[i] > max_epochs * sizes[i]]
        if not over:
            for i in free:
                targets[i] = share * weights[i]
            return targets
        for i in over:
            targets[i] = max_epochs * sizes[i]
            left -= targets[i]
        free = [i for i in free if i not in set(over)]
    return targets


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2.0, seed: int = 7, key: Column | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, repetitions, taken, and
    with a `key` (a column that tells rows apart) key.

    Sources are ordered by code point, null last (a source of its own), and take the weights in
    turn. A document is repeated floor(target / source size) times, and once more if the rest of the
    source's target reaches it in a seeded order. Long documents come first, up to their share of
    the rest; the shorter ones, which hold at least three tenths of the source, fill what is then
    left up to the nearest document, so a source ends close to its target. The order hashes id,
    text and seed, never the partitioning, so reruns agree; rows that repeat an id and a text tie,
    and which of them is taken makes no difference. Documents without words have size 0 and are
    taken 0 words. Null ids are allowed and other columns ignored. An empty table gives an empty
    result.

    Running sizes are found in two steps: over hash buckets (at most 1024 a source and length
    class), then inside the one bucket where a source's rest ends. A row for each source and length
    class (powers of two) reaches the driver.
    """
    spark = docs.sparkSession
    keyed = [] if key is None else ["key"]
    rows = only(docs, doc_id=id_col, text=text_col, source=source_col, **{k: key for k in keyed})
    rows = rows.select("doc_id", *keyed, "source", text_size(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    rows = rows.withColumns({"bucket": F.pmod(F.shiftrightunsigned("h", 40), F.lit(BUCKETS)).cast("int"), "length": F.floor(F.log2(F.col("size") + 1)).cast("int")})
    with Scratch(spark) as scratch:
        rows = scratch.table(rows, "rows")
        sums = scratch.table(rows.groupBy("source", "length", "bucket").agg(F.sum("size").alias("words")), "sums")
        found: dict = {}
        for r in sums.groupBy("source", "length").agg(F.sum("words").alias("words")).collect():
            found.setdefault(r.source, {})[r.length] = r.words
        order = sorted(found, key=lambda x: (x is None, x or ""))
        sizes = [sum(found[s].values()) for s in order]
        targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * sum(sizes), max_epochs)
        plan = []
        for source, size, target in zip(order, sizes, targets, strict=True):
            whole = int(target // size) if size else 0
            rest, short = target - size * whole, 0
            for limit in sorted(found[source]):
                short += found[source][limit]
                if short >= 0.3 * size:
                    break
            plan.append((source, size, target, whole, rest, limit, rest * (size - short) / size if size else 0.0))
        plan = spark.createDataFrame(plan, "src string, source_size long, target double, whole int, rest double, limit int, long_rest double")
        few = len(order) <= 100_000

        def planned(df: DataFrame, plan: DataFrame) -> DataFrame:
            return df.join(F.broadcast(plan) if few else plan, F.col("source").eqNullSafe(F.col("src"))).drop("src")

        sums = planned(sums, plan).withColumn("long", F.col("length") > F.col("limit")).groupBy("source", "long", "bucket", "rest", "long_rest").agg(F.sum("words").alias("words"))
        before = F.sum("words").over(Window.partitionBy("source", "long").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        sums = scratch.table(sums.withColumn("base", F.coalesce(before, F.lit(0))), "cumulated")
        fits = F.col("long") & (F.col("base") + F.col("words") <= F.col("long_rest"))
        taken = sums.groupBy("source").agg(F.coalesce(F.max(F.when(fits, F.col("bucket"))), F.lit(-1)).alias("long_cut"), F.coalesce(F.max(F.when(fits, F.col("base") + F.col("words"))), F.lit(0)).alias("long_words")).withColumnRenamed("source", "src")
        left = F.col("rest") - F.col("long_words")
        short = planned(sums.filter("NOT long"), taken).groupBy("source").agg(
            F.max(F.when((F.col("base") < left) & (left <= F.col("base") + F.col("words")), F.struct("bucket", "base"))).alias("at"),
        )
        plan = plan.join(scratch.table(taken, "taken").withColumnRenamed("src", "of"), F.col("src").eqNullSafe(F.col("of")), "left").drop("of")
        plan = plan.join(scratch.table(short, "short").withColumnRenamed("source", "of"), F.col("src").eqNullSafe(F.col("of")), "left").drop("of")
        cut = F.coalesce(F.col("at.bucket"), F.when(F.coalesce(F.col("rest") - F.col("long_words"), F.lit(0.0)) > 0, F.lit(BUCKETS)).otherwise(-1))
        rows = planned(rows, plan).withColumns({"cut": cut, "long": F.col("length") > F.col("limit")})
        inside = ~F.col("long") & (F.col("bucket") == F.col("cut"))
        running = F.sum("size").over(Window.partitionBy("source").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
        edge = rows.filter(inside).withColumn("extra", (F.col("at.base") + F.coalesce(running, F.lit(0)) + F.col("size") / 2 <= F.col("rest") - F.col("long_words")).cast("int"))
        sure = rows.filter(~inside).withColumn("extra", F.when(F.col("long"), F.col("bucket") <= F.col("long_cut")).otherwise(F.col("bucket") < F.col("cut")).cast("int"))
        times = F.col("whole") + F.col("extra")
        out = sure.unionByName(edge).select("doc_id", *keyed, "source", "size", "source_size", "target", times.alias("repetitions"), (F.col("size") * times).cast("long").alias("taken"))
        return out.checkpoint()
