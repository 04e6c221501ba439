"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters, joined
on prefix n-grams and verified once per pair, over classes of equal shingle sets."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, bounded_semi, only, row_key
from .components import connected_components, thinned
from .shingles import as_bytes, batched, grams, shingle_set, small, word_hashes
from .workers import lean

SKETCH_BITS = 22
CHUNKS = 256
#: Words of 64 bits of a set's parities: bit k tells whether an odd number of shingles hash to range k.
PARITIES = 4
#: Most words of 64 bits of the parities that whole sets are compared by: at least two ranges a shingle
#: for sets of up to 2**14.
LONG_PARITIES = 512
#: N-grams of a class that go with each of its postings, so that a pair is made but once.
HEAD = 12


def _texts(column):
    """Word hashes of each text of an Arrow column."""
    for texts in batched(as_bytes(column)):
        hashes, bounds, _, _ = word_hashes(texts)
        for k in range(len(texts)):
            yield hashes[bounds[k] : bounds[k + 1]]


def _frequencies(rows: DataFrame, n: int) -> np.ndarray:
    """How often shingles of each of 2**22 hash ranges occur in all texts: a table of fixed size."""

    def count(batches):
        sums = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in small(batches):
            for words in _texts(batch["text"]):
                if len(words):
                    np.add.at(sums, (grams(words, min(n, len(words))) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), np.uint32(1))
        yield from chunks(sums)

    def chunks(sums):
        # Few counts go as places and values, many as a whole range; none as nothing.
        for chunk, part in enumerate(sums.reshape(CHUNKS, -1)):
            at = np.flatnonzero(part)
            if len(at):
                kind = "u1" if part.max() < 256 else "<u4"
                at, part = (at[:0], part) if 4 * len(at) > len(part) else (at, part[at])
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([kind]), pa.array([at.astype("<u4").tobytes()], pa.binary()), pa.array([part.astype(kind).tobytes()], pa.binary())], ["chunk", "kind", "at", "sums"])

    def add(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, kind, at, part in zip(batch["chunk"].to_pylist(), batch["kind"].to_pylist(), batch["at"], batch["sums"], strict=True):
                whole = found.setdefault(chunk, np.zeros((1 << SKETCH_BITS) // CHUNKS, np.uint32))
                at, part = np.frombuffer(at.as_buffer(), "<u4"), np.frombuffer(part.as_buffer(), kind)
                whole[at if len(at) else slice(None)] += part
        kept = [np.minimum(x, 65_535).astype("<u2").tobytes() for x in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(kept, pa.binary())], ["chunk", "sums"])

    raw = rows.select("text").mapInArrow(lean(count), "chunk int, kind string, at binary, sums binary")
    merged = raw.repartition(64, "chunk").mapInArrow(lean(add), "chunk int, sums binary").toArrow()
    sums = np.zeros((CHUNKS, (1 << SKETCH_BITS) // CHUNKS), np.uint16)
    for chunk, part in zip(merged["chunk"].to_pylist(), merged["sums"].to_pylist(), strict=True):
        sums[chunk] = np.frombuffer(part, "<u2")
    return sums.reshape(-1)


def _profile(n: int, percent: int, shared):
    """Of each text: class (hash of its shingle set), set size, prefix in the global order, parities."""

    def profile(batches):
        table = shared.value
        for batch in small(batches):
            classes, sizes, bounds, prefixes, bits = [], [], [0], [], []
            for words in _texts(batch["text"]):
                found = shingle_set(words, n)
                size = len(found)
                order = np.lexsort((found, table[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]))
                keep = size + (percent * size) // -100 + 1 if size else 0  # size - ceil(t size) + 1
                prefixes.append(found[order[:keep]].view(np.int64))
                bounds.append(bounds[-1] + keep)
                classes.append(blake2b(found.tobytes(), digest_size=16).digest())
                sizes.append(size)
                odd = np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=64 * PARITIES) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            values = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values(prefixes))
            parities = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1) * PARITIES, pa.int32()), values(bits))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], pa.array(classes, pa.binary()), pa.array(sizes, pa.int64()), lists, parities], ["doc_id", "row", "c", "n", "prefix", "bits"])

    return profile


def _parities(found: np.ndarray, words: int) -> np.ndarray:
    """`words` words of 64 bits: whether an odd number of shingles have each remainder."""
    odd = np.bincount((found & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    flat = pa.array(np.concatenate(values) if values else np.zeros(0, np.int64), pa.int64())
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), flat)


def _sets(n: int):
    def sets(batches):
        for batch in small(batches):
            found = [shingle_set(words, n) for words in _texts(batch["text"])]
            # A power of two of words, so that the parities of two sets can be folded to one length.
            bits = [_parities(x, min(LONG_PARITIES, max(PARITIES, 1 << (max(1, len(x)) // 32).bit_length()))) for x in found]
            kept = [k for k in batch.schema.names if k != "text"]
            yield pa.RecordBatch.from_arrays([*[batch[k] for k in kept], _lists(bits), _lists([x.view(np.int64) for x in found])], [*kept, "parities", "shingles"])

    return sets


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80, links: bool = False, key: Column | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, with `links` n_links, and with a `key`
    (a column that tells rows apart) key and kept.

    Words are runs of anything but the six separators, A-Z lower-cased; a set holds the distinct
    n-word shingles, or a shorter text as one shingle. Two documents link if their sets' Jaccard
    similarity is at least percent / 100; component_id is the least id reachable by links, itself
    included. Texts without words, null ones too, link with nothing. Null ids rank as unknown: a
    component's id is the least that is known, null if none is. Repeated rows are one class. kept is
    true for one row of each component, the least known id's, the least key's among those, and for
    all rows without words. Other columns are ignored. Shingles are compared by 64-bit hashes, whole
    sets by 128-bit digests.

    Equal sets form a class; only classes are joined. A class's prefix holds the n-grams that come
    first by (frequency, hash); frequencies are sums over all texts in 2**22 hash ranges. Classes
    that share a prefix n-gram are linked in stages, each verified on whole sets: three times to one
    class drawn for each n-gram (as many pairs as prefix entries), then every pair of an n-gram that is not
    yet in one component. So a large group of near copies gives a few pairs for each member and not
    the square, and no link that could join two components is left out.

    With `links` there are no stages: every pair of classes that the filters leave is verified once,
    those inside a component too, and n_links counts the other rows that a row links with (rows of
    linked classes and the other rows of its own), 0 without words. A group of near copies then costs
    the square of its differing sets, as each pair of them is part of the result; of their sets only
    the differences from one set of the group go with the pairs.
    """
    spark = docs.sparkSession
    rows = only(docs, doc_id=id_col, text=text_col, row=row_key(docs, id_col, text_col) if key is None else key)
    kind, row = (rows.schema[c].dataType.simpleString() for c in ("doc_id", "row"))
    shared = spark.sparkContext.broadcast(_frequencies(rows, n))
    with Scratch(spark) as scratch:
        schema = f"doc_id {kind}, row {row}, c binary, n long, prefix array<long>, bits array<long>"
        profiles = scratch.table(rows.mapInArrow(lean(_profile(n, percent, shared)), schema), "profiles")
        first_row = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("least")
        heads = profiles.filter("n > 0").groupBy("c").agg(first_row, F.first("n").alias("n"), F.first("bits").alias("bits"), F.count("*").alias("rows"))
        classes = scratch.table(heads.select("c", F.monotonically_increasing_id().alias("i"), "least", F.col("least.row").alias("row"), "n", "bits", "rows"), "classes")
        members = scratch.table(profiles.select("doc_id", "row", "n", "c"), "members")
        first = bounded_semi(profiles.filter("n > 0").select("row", "prefix"), classes.select("row", "i", "n"), ["row"], "inner")
        postings = first.select("i", "n", F.posexplode("prefix").alias("at", "gram"))
        often = scratch.table(postings.groupBy("gram").count().filter("count > 1").select("gram"), "often")
        # Rows that share a key give the same postings; one of each is enough.
        postings = scratch.table(bounded_semi(postings, often, ["gram"], most=2 * BROADCAST_ROWS).distinct(), "postings")
        scratch.drop("profiles", "often")
        facts = classes.select("i", "bits")
        verified = roots = None
        for stage in (3,) if links else range(4):
            if roots is None:
                labelled = postings.withColumn("root", F.col("i"))
            else:
                labelled = postings.join(roots.withColumnRenamed("node", "i"), "i", "left").withColumn("root", F.coalesce("root", "i"))
            span = labelled.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(F.struct(F.xxhash64("i", F.lit(stage)).alias("draw"), "i", "n", "root", "at")).alias("p"))
            span = span.filter("lo <> hi")
            if stage < 3:
                right = span.select(F.col("gram").alias("gram2"), *[F.col(f"p.{k}").alias(f"{k}2") for k in ("i", "n", "root", "at")])
                left = labelled.select([F.col(k).alias(f"{k}1") for k in ("gram", "i", "n", "root", "at")])
                pairs = left.join(right, (F.col("gram1") == F.col("gram2")) & (F.col("root1") != F.col("root2")) & _may_reach(percent))
                pairs = pairs.select(F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b"), (F.col("n1") + F.col("n2")).alias("size")).distinct()
                for end, mine in (("a", "bits1"), ("b", "bits2")):
                    pairs = pairs.join(facts.select(F.col("i").alias(end), F.col("bits").alias(mine)), end)
                pairs = pairs.filter(_may_equal(percent, F.col("size"))).drop("bits1", "bits2")
            else:
                held = _with_head(labelled.join(span.select("gram"), "gram"), facts)
                # Both sides rename all columns: equal plans, so the rows are shuffled once for both.
                left, right = (held.select([F.col(k).alias(f"{k}{side}") for k in held.columns]) for side in (1, 2))
                pairs = left.join(right, (F.col("gram1") == F.col("gram2")) & (F.col("root1") < F.col("root2")) & _may_reach(percent) & _may_equal(percent, F.col("n1") + F.col("n2")) & _at_first())
                pairs = pairs.select(F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b"), (F.col("n1") + F.col("n2")).alias("size")).distinct()
            if verified is not None:
                pairs = pairs.join(verified.select("a", "b"), ["a", "b"], "left_anti")
            pairs = scratch.table(pairs, f"pairs-{stage}")
            found = (_verify_by_differences if links else _verify)(rows, members, classes, pairs, n, percent, scratch, stage)
            scratch.drop(f"sets-{stage}", f"pairs-{stage}", "apart")
            verified = found if verified is None else verified.unionByName(found)
            # Links of earlier stages go in as what they made: one link from each node to its root.
            similar = found.filter("similar").select("a", "b")
            similar = similar if roots is None else similar.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
            roots = scratch.table(connected_components(similar, scratch, f"components-{stage}"), f"roots-{stage}")
        named = classes.select("c", "i", "least", "rows").join(roots.withColumnRenamed("node", "i"), "i", "left").withColumn("root", F.coalesce("root", "i"))
        named = scratch.table(named, "named")
        keepers = scratch.table(named.groupBy("root").agg(F.min("least").alias("keeper")), "keepers")
        columns = ["c", "keeper"]
        named = named.join(keepers, "root")
        if links:
            named = named.join(_linked(verified), "i", "left").withColumn("n_links", F.col("rows") - 1 + F.coalesce("linked", F.lit(0)))
            columns.append("n_links")
        named = scratch.table(named.select(*columns), "components")
        out = members.select("doc_id", "row", "n", F.when(F.col("n") > 0, F.col("c")).alias("c")).join(named, "c", "left")
        columns = ["doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("keeper.doc_id")).otherwise(F.col("doc_id")).alias("component_id")]
        if links:
            columns.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
        if key is not None:
            columns += [F.col("row").alias("key"), ((F.col("n") == 0) | (F.col("row") == F.col("keeper.row"))).alias("kept")]
        return out.select(*columns).checkpoint()


def _linked(verified: DataFrame) -> DataFrame:
    """i, linked: of each class the rows of the classes that it links with."""
    pairs = verified.filter("similar")
    ends = pairs.select(F.col("a").alias("i"), F.col("rows_b").alias("rows")).union(pairs.select("b", "rows_a"))
    return ends.groupBy("i").agg(F.sum("rows").alias("linked"))


def _with_head(held: DataFrame, facts: DataFrame) -> DataFrame:
    """Postings with their class's parities, the first HEAD of its n-grams among them, and the place of
    the posting's own there (from 1)."""
    lists = held.groupBy("i").agg(F.first("n").alias("n"), F.first("root").alias("root"), F.array_sort(F.collect_list(F.struct("at", "gram"))).alias("items"))
    head = F.transform(F.slice("items", 1, HEAD), lambda x: x["gram"])
    each = lists.join(facts, "i").select("i", "n", "root", "bits", head.alias("head"), F.posexplode("items").alias("k", "item"))
    return each.select("item.gram", "i", "n", "root", "item.at", "bits", "head", (F.col("k") + 1).alias("place"))


def _at_first():
    """Whether a pair is to be made at an n-gram: at the first that both heads hold, or, should they hold
    none, at each common one."""
    both = (F.col("place1") <= HEAD) & (F.col("place2") <= HEAD)
    before = lambda side: F.slice(f"head{side}", F.lit(1), F.least(F.col(f"place{side}") - 1, F.lit(HEAD)))
    return F.when(both, ~F.arrays_overlap(before(1), before(2))).otherwise(~F.arrays_overlap("head1", "head2"))


def _overlap(percent: int, total):
    """Least common shingles of two sets of `total` together at the similarity."""
    return F.ceil(total * percent / F.lit(100.0 + percent) - 1e-9)


def _may_reach(percent: int):
    """Length and positional filters of a pair that shares an n-gram: the smaller set is large enough,
    and, nothing before the first common n-gram being common, what follows in both may do."""
    c = F.col
    length = F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent
    return length & (F.least(c("n1") - c("at1"), c("n2") - c("at2")) >= _overlap(percent, c("n1") + c("n2")))


def _may_equal(percent: int, size):
    """Suffix filter: each shingle of only one set turns the parity of one of 256 hash ranges, so no
    more parities may differ than shingles."""
    apart = sum(F.bit_count(F.get("bits1", F.lit(k)).bitwiseXOR(F.get("bits2", F.lit(k)))) for k in range(PARITIES))
    return apart <= size - 2 * _overlap(percent, size)


def _whole_sets(rows: DataFrame, members: DataFrame, named: DataFrame, n: int, scratch: Scratch, stage: int) -> DataFrame:
    """The classes `named` (row, i and more) with their sets of shingles and parities of these, from the
    text of one row of each."""
    named = scratch.table(named, f"needed-{stage}")
    texts = bounded_semi(rows.select("row", "text"), named, ["row"], "inner").drop("row")
    # Only rows that share a key can give a set twice; without any, nothing need be moved.
    if members.join(named, "row", "left_semi").count() > named.count():
        texts = texts.dropDuplicates(["i"])
    schema = ", ".join(f"{c} {kind}" for c, kind in texts.drop("text").dtypes)
    return scratch.table(texts.mapInArrow(lean(_sets(n)), f"{schema}, parities array<long>, shingles array<long>"), f"sets-{stage}")


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("i")).union(pairs.select("b")).distinct()


def _still_possible(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, stage: int) -> DataFrame:
    """The pairs that the suffix filter leaves with parities as long as the sets ask for: those in the join
    are too few for pairs of large sets, which may differ in more than an eighth of their ranges. Of two
    lengths the longer parities are folded."""
    allowed = F.col("size") - 2 * _overlap(percent, F.col("size"))
    few, pairs = pairs.filter(allowed <= 8 * PARITIES), pairs.filter(allowed > 8 * PARITIES)
    for end in "ab":
        pairs = pairs.join(sets.select(F.col("i").alias(end), F.col("parities").alias(f"parities_{end}")), end)
    fold = lambda mine, other: F.when(F.size(mine) > F.size(other), F.zip_with(F.slice(mine, F.lit(1), F.size(other)), F.slice(mine, F.size(other) + 1, F.size(other)), lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(mine))
    apart = F.aggregate(F.zip_with(fold("parities_a", "parities_b"), fold("parities_b", "parities_a"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    twofold = F.greatest(F.size("parities_a"), F.size("parities_b")) <= 2 * F.least(F.size("parities_a"), F.size("parities_b"))
    bound = F.when(twofold, apart <= allowed).otherwise(F.lit(True))
    return scratch.table(few.unionByName(pairs.filter(bound).select(few.columns)), f"possible-{stage}")


def _verify(rows: DataFrame, members: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int, scratch: Scratch, stage: int) -> DataFrame:
    """(a, b, similar) of the pairs that may be similar, from whole sets."""
    sets = _whole_sets(rows, members, classes.join(_named(pairs), "i", "left_semi").select("row", "i"), n, scratch, stage)
    pairs = _still_possible(pairs, sets, percent, scratch, stage)
    both = pairs.join(sets.select(F.col("i").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("i").alias("b"), F.col("shingles").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    similar = common * (100 + percent) >= F.col("size") * percent
    return scratch.table(both.select("a", "b", similar.alias("similar")), f"verified-{stage}")


def _verify_by_differences(rows: DataFrame, members: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int, scratch: Scratch, stage: int) -> DataFrame:
    """(a, b, similar) of the pairs that may be similar, as `_verify` gives them, and the rows of both
    classes.

    Classes are compared with one that pairs connect them with, whole set with whole set. What only
    one of two sets holds is what only one of their differences from a third holds, so differences,
    which are small for near copies, are all that goes with a pair. The few pairs whose classes were
    compared with different ones are verified on whole sets."""
    sets = _whole_sets(rows, members, classes.join(_named(pairs), "i", "left_semi").select("row", "i", "rows"), n, scratch, stage)
    pairs = _still_possible(pairs, sets, percent, scratch, stage)
    roots = connected_components(thinned(pairs, scratch, "candidates"), scratch, "candidates").withColumnRenamed("node", "i")
    named = scratch.table(_named(pairs).join(roots, "i", "left").select("i", F.coalesce("root", "i").alias("root")), f"rooted-{stage}")
    left = bounded_semi(sets.select("i", "rows", "shingles"), named, ["i"], "inner")
    third = left.filter("i = root").select("root", F.col("shingles").alias("other"))
    apart = F.concat(F.array_except("shingles", "other"), F.array_except("other", "shingles"))
    apart = scratch.table(left.join(third, "root").select("i", "root", "rows", apart.alias("apart")), "apart")
    for end in "ab":
        pairs = pairs.join(apart.select(F.col("i").alias(end), *[F.col(k).alias(f"{k}_{end}") for k in ("root", "rows", "apart")]), end)
    common = F.size(F.array_intersect("apart_a", "apart_b"))
    twice = F.col("size") - (F.size("apart_a") + F.size("apart_b") - 2 * common)  # twice the common shingles
    similar = F.when(F.col("root_a") == F.col("root_b"), twice * (100 + percent) >= 2 * F.col("size") * percent)
    judged = scratch.table(pairs.select("a", "b", "size", "rows_a", "rows_b", similar.alias("similar")), f"judged-{stage}")
    rest = judged.filter("similar IS NULL")
    if not rest.limit(1).count():
        return judged.drop("size")
    for end, side in (("a", "x"), ("b", "y")):
        rest = rest.join(sets.select(F.col("i").alias(end), F.col("shingles").alias(side)), end)
    whole = F.size(F.array_intersect("x", "y")) * (100 + percent) >= F.col("size") * percent
    rest = scratch.table(rest.select("a", "b", "rows_a", "rows_b", whole.alias("similar")), f"rest-{stage}")
    return judged.filter("similar IS NOT NULL").select(rest.columns).unionByName(rest)
