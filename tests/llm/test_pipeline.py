"""The pipeline's stages, one after another, each against a brute-force version on awkward rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm.mixing import mix_sources
from tessera.llm.quality_classifier import select_quality
from tests.llm.test_operators import BYTE, DOCS, LOWER, awkward, brute_best_fit, tokens

LABELS = [(k, 1) for k in range(40)] + [(k, 0) for k in (90, 91, 112)]


def rows():
    """Also rows that repeat an id with the same text, up to case or not, or with another one, or have
    no id."""
    more = awkward()
    more += [(7, more[7][1], "de", "s9", 4), (7, "other words under an id that is taken, as it may be", "en", "s1", 2), (8, more[8][1].upper(), "en", "s1", 2)]
    more += [(None, "no id", "en", "s0", 5), (None, "NO ID", "xx", "s7", 5), (None, more[60][1], "en", "s1", 0), (61, more[60][1], None, None, None), (111, "", "en", None, 0)]
    return more


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    df = spark.createDataFrame(rows(), DOCS).withColumns({"_key": F.lit("k"), "kept": F.lit(False), "key": F.lit(1), "_metadata": F.lit(2.5)})
    df.repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(LABELS, "doc_id long, quality int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def words(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def test_quality_keeps_the_selected_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.quality(spark, docs, folder)
    chosen = Counter((r.doc_id, r.n_features) for r in select_quality(docs, spark.createDataFrame(LABELS, "doc_id long, quality int")).filter("selected").collect())
    assert out.columns == docs.columns and sum(chosen.values()) == out.count() < docs.count()
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: sum(n for (i, _), n in chosen.items() if i == k) for k, _ in chosen})
    assert not counted(out) - counted(docs)


def test_exact_keeps_one_row_of_each_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.exact(spark, docs, folder)
    groups = {}
    for r in docs.collect():
        groups.setdefault((r.text or "").translate(LOWER), []).append(r)
    got = out.collect()
    assert out.columns == docs.columns and Counter((r.text or "").translate(LOWER) for r in got) == Counter(dict.fromkeys(groups, 1))
    for r in got:
        mine = groups[(r.text or "").translate(LOWER)]
        assert tuple(r) in {tuple(x) for x in mine} and r.doc_id == max((x.doc_id for x in mine if x.doc_id is not None), default=None)


def test_near_keeps_one_row_of_each_component(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.near(spark, docs, folder)
    held = docs.collect()
    sets, root = [words(r.text) for r in held], list(range(len(held)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(held)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least, size = {}, Counter()
    for k, r in enumerate(held):
        size[find(k)] += 1
        if r.doc_id is not None:
            least[find(k)] = min(r.doc_id, least.get(find(k), r.doc_id))
    want = Counter(least.get(c) if size[c] > 1 else held[c].doc_id for c in size)
    assert out.columns == docs.columns and Counter(r.doc_id for r in out.collect()) == want and not counted(out) - counted(docs)


def test_mix_repeats_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.mix(spark, docs, folder)
    times = mix_sources(docs).groupBy("doc_id", "source", "size").agg(F.sum("repetitions").alias("n")).filter("n > 0")
    size = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")
    assert out.columns == docs.columns and counted(out.groupBy("doc_id", "source", size.alias("size")).count()) == counted(times)
    before = counted(docs)
    assert all(r in before and n <= 2 * before[r] for r, n in counted(out).items())


def test_pack_places_every_row(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found, ids, want = corpus_pipeline.pack(spark, docs, folder).collect(), tokens(BYTE), Counter()
    for r in docs.collect():
        x = [*ids(r.text), 0]
        first = (len(x) - 1) % 2048 + 1
        for k, start in enumerate([0, *range(first, len(x), 2048)]):
            part = x[start : first if not k else start + 2048]
            want[r.doc_id, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    assert len({r.sequence_id for r in found}) == len(brute_best_fit([r.length for r in found], 2048))


def test_stages_follow_each_other(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    packed = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in docs.collect())
    whole = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, folder).collect())
    assert whole == packed and packed


def test_stages_on_rows_without_files_and_on_nothing(spark, folder):
    docs = spark.createDataFrame(rows(), DOCS)
    stored = spark.read.parquet(f"{folder}/documents.parquet").select(docs.columns)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        mine, theirs = stage(spark, docs, folder), stage(spark, stored, folder)
        assert Counter((r.doc_id, r.text) for r in mine.collect()) == Counter((r.doc_id, r.text) for r in theirs.collect())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0
