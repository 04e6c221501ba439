"""Quality selection by importance resampling: hashed n-gram models of target and raw text give each
document an importance weight, and Gumbel top-k draws documents by these weights."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, only
from .shingles import as_bytes, batched, grams, small, word_hashes
from .workers import lean

BUCKETS = 4096
#: Three families of features: words, pairs of words, and byte triples.
FEATURES = 3 * BUCKETS


def _features(texts: list[bytes]):
    """(buckets, bounds of each text) for each family, over a batch of texts."""
    hashes, bounds, data, at = word_hashes(texts, lower=False)
    shift = np.uint64(52)
    yield (hashes >> shift).astype(np.int64), bounds
    pairs = (grams(hashes, 2) >> shift).astype(np.int64) + BUCKETS
    inside = np.ones(len(pairs), bool)
    cuts = bounds[1:-1]
    inside[cuts[(cuts > 0) & (cuts <= len(pairs))] - 1] = False  # a pair doesn't span two texts
    kept = np.concatenate([[0], np.cumsum(inside)])
    yield pairs[inside], kept[np.minimum(bounds, len(pairs))]
    wide = data.astype(np.uint64)
    triples = wide[:-2] * np.uint64(65536) + wide[1:-1] * np.uint64(256) + wide[2:] if len(data) > 2 else wide[:0]
    triples = ((triples * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64) + 2 * BUCKETS
    inside = np.ones(len(triples), bool)
    for back in (1, 2):  # nor does a triple
        cuts = at[1:-1] - back
        inside[cuts[(cuts >= 0) & (cuts < len(triples))]] = False
    kept = np.concatenate([[0], np.cumsum(inside)])
    yield triples[inside], kept[np.minimum(at, len(triples))]


def _count(batches):
    """Partition sums of the features of all documents and of the target's."""
    raw, target = np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)
    for batch in small(batches):
        flags, done = np.array(batch["is_target"].to_pylist(), dtype=bool), 0
        for texts in batched(as_bytes(batch["text"])):
            mine = flags[done : done + len(texts)]
            done += len(texts)
            for buckets, bounds in _features(texts):
                raw += np.bincount(buckets, minlength=FEATURES)
                if mine.any():
                    chosen = np.repeat(mine, np.diff(bounds))
                    target += np.bincount(buckets[bounds[0] : bounds[-1]][chosen], minlength=FEATURES)
    found = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(raw[found]), pa.array(target[found])], ["bucket", "raw", "target"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_labels: int = 20_000, prior: float = 65536.0, seed: int = 11) -> tuple[np.ndarray, float]:
    """Log ratios of target to raw probability for each feature, and the labelled share of good rows.

    The raw model counts all documents; the target model counts those labelled 1 in a sample of at
    most `most_labels` labelled rows (smallest seeded hashes; the bound is this parameter). A label
    of a repeated id counts once, the lowest. Ratios shrink to 1 by `prior` raw draws a family. With
    no labels or no documents all ratios are 1. Only the fixed 12,288 sums reach the driver.
    """
    sample = only(labels, id=id_col, label=label_col).dropna().orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(most_labels)
    known = sample.groupBy("id").agg(F.min("label").alias("label"))
    rows = only(docs, id=id_col, text=text_col).join(F.broadcast(known), "id", "left")
    rows = rows.select("text", F.coalesce(F.col("label") == 1, F.lit(False)).alias("is_target"))
    sums = rows.mapInArrow(lean(_count), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(FEATURES), np.zeros(FEATURES)
    for r in sums.collect():
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    ratios = np.zeros(FEATURES)
    for k in range(3):
        part = slice(k * BUCKETS, (k + 1) * BUCKETS)
        share = (raw[part] + 1) / (raw[part] + 1).sum()
        ratios[part] = np.log((target[part] + prior * share) / ((target[part].sum() + prior) * share))
    good = known.agg(F.avg((F.col("label") == 1).cast("double"))).first()[0]
    return ratios, 1.0 if good is None else float(good)


def log_weights(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """doc_id, log_weight (sum of the log ratios of the text's features; 0 for an empty or null
    text) and n_features, one row per row of `docs`, with the key if one is given."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # a fixed 96 kB

    def score(batches):
        table = shared.value
        for batch in small(batches):
            weights, counts = [], []
            for texts in batched(as_bytes(batch["text"])):
                total, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
                for buckets, bounds in _features(texts):
                    sums = np.concatenate([[0.0], np.cumsum(table[buckets])])
                    total += sums[bounds[1:]] - sums[bounds[:-1]]
                    n += np.diff(bounds)
                size = np.array([len(t) for t in texts])
                weights.append(np.where(size > 0, total, 0.0))
                counts.append(np.where(size > 0, n, 0))
            flat = lambda x, kind: pa.array(np.concatenate(x) if x else np.zeros(0), kind)
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in held], flat(weights, pa.float64()), flat(counts, pa.int64())], [*held, "log_weight", "n_features"])

    rows = only(docs, doc_id=id_col, text=text_col, **({} if key is None else {"key": key}))
    held = [c for c in rows.columns if c != "text"]
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in held]
    return rows.mapInArrow(lean(score), ", ".join([*kinds, "log_weight double", "n_features long"]))


def top_k(df: DataFrame, key: Column, k: int, tie: str, scratch: Scratch) -> DataFrame:
    """Adds selected: the k rows with the largest keys, ties by the larger `tie`; rows that tie in
    both are taken together. The k-th key is found by counting ever finer ranges of its bits (at
    most 65,536 counts at a time), so no row travels for it; `df` should be a stored table."""
    spark = df.sparkSession
    if k <= 0:
        return df.withColumn("selected", F.lit(False))
    step = 1e-6  # keys are compared at this grain
    df = df.withColumn("_key", F.floor(F.greatest(F.least(key, F.lit(1e12)), F.lit(-1e12)) / step).cast("long"))
    bias, low, width, above = 2**62, 0, 63, 0
    shifted = F.col("_key") + F.lit(bias)
    while width > 0:
        bits = min(16, width)
        width -= bits
        inside = df.filter((shifted >= F.lit(low)) & (shifted < F.lit(low + 2 ** (width + bits)))) if width + bits < 63 else df
        counts = inside.groupBy(F.shiftright(shifted - F.lit(low), width).alias("b")).count().collect()
        for b, n in sorted(counts, reverse=True):
            if above + n >= k:
                low += b << width
                break
            above += n
        else:
            return df.withColumn("selected", F.lit(True)).drop("_key")
    cut = low - bias
    left = k - above
    equal = df.filter(F.col("_key") == cut).groupBy(tie).count().orderBy(F.desc_nulls_last(tie)).limit(left)
    ties = scratch.table(equal.select(F.col(tie).alias("_tie"), F.lit(cut).alias("_at")), "ties")
    # The k-th key is shared by few rows but for copies, whose keys differ by their ids' draws.
    df = df.join(ties, (F.col(tie).eqNullSafe(F.col("_tie"))) & (F.col("_key") == F.col("_at")), "left")
    return df.withColumn("selected", (F.col("_key") > cut) | F.col("_at").isNotNull()).drop("_key", "_tie", "_at")


def select_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", slack: float = 0.02, effective: float = 50.0, shrink: float = 50.0, seed: int = 11, key: Column | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, log_weight, n_features, sampling_key, selected, and with a `key`
    (a column that tells rows apart) key.

    log_weight is the mean of log p_target / p_raw over hashed words, pairs of words and byte
    triples (shrunk to 0 by `shrink` features without evidence), times `effective`: the log importance
    weight of a text that holds `effective` independent features, so that length alone never decides
    and the weights of ordinary texts lie within a few units of each other, as standard Gumbel draws
    do. The sampling key adds such a draw (seeded by id), so the top k are a sample without
    replacement in proportion to the weights: near the cut the draws decide, and another seed gives
    another sample; a text unlike the target needs a draw that it hardly ever gets. k is the labelled
    share of good rows plus `slack`, of all rows. Null and empty texts have log weight 0 like any
    text without evidence. Null ids share one draw; rows that repeat an id and a text are selected
    together. An empty table gives an empty result; without labels every row is selected.
    """
    with Scratch(docs.sparkSession) as scratch:
        ratios, good = fit(docs, labels, id_col, text_col, seed=seed)
        scored = scratch.table(log_weights(docs, ratios, id_col, text_col, key), "scored")
        scored = scored.withColumn("log_weight", F.col("log_weight") * effective / (F.col("n_features") + shrink))
        n = scored.count()
        draw = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 11).cast("double") + 0.5) / F.lit(2.0**53)
        keyed = scored.withColumn("sampling_key", F.col("log_weight") - F.log(-F.log(draw)))
        return top_k(keyed, F.col("sampling_key"), min(n, int(np.ceil(n * min(1.0, good + slack)))), "doc_id", scratch).checkpoint()
