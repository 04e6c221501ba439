"""Each operator against a brute-force version on a small table of awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import common, queries, token_output, workers
from tessera.llm.components import connected_components
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.html_extraction import extract_pages, read_page, site_templates
from tessera.llm.jaccard_join import near_duplicates
from tessera.llm.jvm_coder import decoded, encoded, register
from tessera.llm.mixing import mix_sources, water_fill
from tessera.llm.packing import best_fit, pack_documents, sequences
from tessera.llm.quality_classifier import BUCKETS, _features, select_quality
from tessera.llm.quality_rules import clean_lines
from tessera.llm.range_coder import BLOCK, decode_blocks, encode_blocks
from tessera.llm.sharding import affected, cut_line, equal_capacities, min_cost_flow, plan_files, read_shards, rewrite_shards, transfers, write_shards
from tessera.llm.shingles import word_hashes
from tessera.llm.token_counts import token_counts
from tessera.llm.token_output import joined_crc, read_ids, read_pieces, stored_tokens, write_tokens
from tessera.llm.tokenizing import PieceEncoder, encoder_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BYTE, WORD = (queries._tokenizer(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
LOWER = str.maketrans(queries.UPPER, queries.LOWER)


def awkward():
    """Nulls, empty and very long texts, ties, copies up to case, repeated rows, odd white space."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(300)] + ["the", "of", "and"] * 20
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(k, prose(rng.randint(1, 120)) + ".", "en", f"s{k % 4}", 1) for k in range(60)]
    base = prose(150)
    for k in range(60, 90):  # near copies
        words = base.split()
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        rows.append((k, " ".join(words), None, "s1", None))
    rows += [(k, "Same TEXT here, copied." if k % 2 else "same text HERE, copied.", "en", "s2", 0) for k in range(90, 110)]
    rows += [(110, None, None, None, None), (111, "", "en", None, 0), (112, " \n\t ", "en", "Ünï", 4), (113, prose(30000), "en", "s0", 9), (114, "a b", "en", "", 3), (115, "Ａ ｂ c  d e\x0b\x0cf", "xx", "s3", 1), (116, "İ ß <|endoftext|> 中文 é", "xx", "s3", 1)]
    return rows + [rows[5], rows[5], (None, "no id", "en", "s0", 5), (None, None, None, "s0", None)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(awkward(), DOCS)
    # other columns whose names operators might use themselves
    return df.withColumns({"bucket": F.lit(1), "row": F.lit("r"), "n": F.lit(2.5), "c": F.lit(0), "digest": F.lit("d"), "root": F.lit(3), "shard": F.lit(4), "kept": F.lit(False)})


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def counted(rows):
    return Counter(tuple(r) for r in rows)


def test_exact_dedup(docs, nothing):
    for everything in (False, True):
        groups = {}
        for i, t, *_ in awkward():
            groups.setdefault((t or "").translate(LOWER), []).append(i)
        want = Counter()
        for t, ids in groups.items():
            keep = max((i for i in ids if i is not None), default=None)
            for i in ids:
                want[i, keep, len(ids), i == keep] += 1
        found = exact_dedup(docs, digest_all=everything).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found) == want
        texts = {i: (t or "").translate(LOWER) for i, t, *_ in awkward() if i is not None}
        given = {r.doc_id: bytes(r.digest) for r in found if r.digest and r.doc_id is not None}
        assert all(d == hashlib.sha256(texts[i].encode()).digest() for i, d in given.items())
        assert set(given) == set(texts) if everything else {r.doc_id for r in found if r.group_size > 1} - {None} <= set(given) < set(texts)
    assert exact_dedup(nothing).count() == 0


def test_exact_dedup_without_broadcasts(docs, monkeypatch):
    want = counted(exact_dedup(docs, digest_all=True).select("doc_id", "keep_id", "group_size").collect())
    monkeypatch.setattr("tessera.llm.exact_dedup.BROADCAST_ROWS", 0)
    monkeypatch.setattr(common.bounded_semi, "__defaults__", ("left_semi", 0))
    assert counted(exact_dedup(docs, digest_all=True).select("doc_id", "keep_id", "group_size").collect()) == want


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_near_duplicates(docs, nothing, n, percent):
    sets = []
    for i, t, *_ in awkward():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets.append((i, frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    want = Counter((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(sets))
    assert counted(near_duplicates(docs, n=n, percent=percent).collect()) == want
    assert near_duplicates(nothing).count() == 0


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (2, 60)])
def test_links_inside_a_component_are_counted(spark, n, percent):
    rng = random.Random(n)
    texts = []
    for group in range(3):  # near copies of one text, each with some words of its own
        base = [f"g{group}w{k}" for k in range(120)]
        for _ in range(12):
            words = list(base)
            for k in rng.sample(range(120), rng.randint(0, 4)):
                words[k] = f"x{rng.random()}"
            texts.append(" ".join(words))
    texts += [texts[0], texts[0], "a b", "a b", None, "", "A  B"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if (w := (t or "").lower().split()) else frozenset() for t in texts]
    want = {a: sum(a != b and bool(x) and 100 * len(x & y) >= percent * len(x | y) for b, y in enumerate(sets)) for a, x in enumerate(sets)}
    found = near_duplicates(df, n=n, percent=percent, links=True)
    assert {r.doc_id: r.n_links for r in found.collect()} == want and max(want.values()) > 5
    plain = counted(near_duplicates(df, n=n, percent=percent).collect())
    assert plain == counted(found.drop("n_links").collect())


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_links_of_long_texts(spark, n, percent):
    """Sets too large for the parities that go with postings, of lengths about a power of two, and pairs
    on both sides of the similarity."""
    rng = random.Random(percent)
    texts = []
    for length in (300, 1000, 1030, 2200):
        base = [f"l{length}w{k}" for k in range(length)]
        for k in range(9):
            words = list(base)
            for at in rng.sample(range(length), length * rng.choice([1, 2, 3, 4, 6]) * k // 800):
                words[at] = f"x{rng.random()}"
            texts.append(" ".join(words[: length - rng.randint(0, length // 20)]))
    texts += [texts[3], " ".join(f"f{k}" for k in range(1500))]
    sets = [frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) for w in (t.split() for t in texts)]
    linked = {a: {b for b, y in enumerate(sets) if a != b and 100 * len(x & y) >= percent * len(x | y)} for a, x in enumerate(sets)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = near_duplicates(df, n=n, percent=percent, links=True)
    assert {r.doc_id: r.n_links for r in found.collect()} == {a: len(x) for a, x in linked.items()}
    assert 0 < sum(not x for x in linked.values()) and max(map(len, linked.values())) >= 3
    assert counted(near_duplicates(df, n=n, percent=percent).collect()) == counted(found.drop("n_links").collect())


def test_quality_rules(spark, docs, nothing):
    for r in clean_lines(docs).filter("doc_id IS NOT NULL").collect():
        text = next(t for i, t, *_ in awkward() if i == r.doc_id) or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.base_failed and r.kept)
    assert clean_lines(nothing).count() == 0
    good = "This is a plain sentence with quite a few ordinary words in it, as prose has."
    texts = ["\n".join([good] * 2 + ["Other words stand here, so that nothing repeats too often in this text."]), f"Home | About | News | Contact\n{good} {good[:40]}", f"{good}\nClick here to read our privacy policy and all the terms of use today.", "A### b%%% c$$$ d*** e### f%%% g$$$ h*** i### j%%% k$$$ l*** m### n%%% o$$$ p*** q### r%%% s$$$ t***.", "Menu | a | b | c | d | e | f | g | h | i | j | k | l | m | n | o | p | q | r | s | t | u"]
    found = clean_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.clean_text.split("\n") == [good] * 2 + [texts[0].split("\n")[2]] for r in found[:1]] == [True]
    assert "Home" not in found[1].clean_text and "privacy" not in found[2].clean_text
    assert [r.kept for r in found[3:]] == [False, False]


def test_mixing(spark, docs, nothing):
    rows = mix_sources(docs).collect()
    assert len(rows) == len(awkward())
    sizes = Counter()
    for _, t, _, s, _ in awkward():
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, water_fill([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 1.5 * sum(sizes.values()), 2), strict=True))
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken == r.size * r.repetitions <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= max(r.size for r in rows if r.source == s)
    again = counted(mix_sources(docs.repartition(3)).collect())
    assert again == counted(rows)
    assert mix_sources(nothing).count() == 0
    assert water_fill([10, 10, 0], [5, 1, 1], 24, 2) == [20, 4, 0] and water_fill([1, 1], [1, 1], 10, 2) == [2, 2]
    # a hot source and exact fractions
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("one two three four five").alias("text"), F.when(F.col("id") < 3000, "a").otherwise("b").alias("source"))
    total = {r.source: (r.t, r.w) for r in mix_sources(many, weights=(1, 5), share=1.0).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("w")).collect()}
    assert all(abs(t - w) <= 3 for t, w in total.values())


def brute_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, used in enumerate(bins) if capacity - used >= n]
        if fits:
            bins[max(fits, key=lambda k: bins[k])] += n
        else:
            bins.append(n)
    return bins


def test_best_fit_equals_piece_by_piece():
    rng = random.Random(2)
    for _ in range(60):
        capacity = rng.randint(5, 60)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 200))]
        placed, made = best_fit(Counter(lengths), capacity)
        used = Counter()
        for length, pieces, each, first, offset in placed:
            for k in range(pieces):
                assert offset + k % each * length + length <= capacity
                used[first + k // each] += length
        assert sum(p[1] for p in placed) == len(lengths)
        assert Counter(used.values()) == Counter(brute_best_fit(lengths, capacity)) and made == len(used)


def tokens(path):
    library = Tokenizer.from_file(path)
    return lambda t: library.encode(t or "", add_special_tokens=False).ids


def test_packing(docs, nothing):
    ids, capacity = tokens(BYTE), 128
    packed = pack_documents(docs, BYTE, capacity=capacity, with_ids=True)
    rows = packed.collect()
    whole = Counter((i, tuple([*ids(t), 0])) for i, t, *_ in awkward())
    pieces = Counter()
    for (_, x), n in whole.items():
        first = (len(x) - 1) % capacity + 1
        for k, start in enumerate([0, *range(first, len(x), capacity)]):
            part = x[start : first if not k else start + capacity]
            pieces[k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += n
    assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == pieces
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) == len(brute_best_fit([r.length for r in rows], capacity))
    assert sequences(packed).filter(F.octet_length("ids") != 4 * F.col("n_tokens")).count() == 0
    assert pack_documents(nothing, BYTE).count() == 0


def test_token_counts_and_cache(spark, docs, nothing, tmp_path):
    ids, cache = tokens(BYTE), str(tmp_path / "cache")
    want = Counter((i, len((t or "").encode()), len(ids(t))) for i, t, *_ in awkward())
    assert counted(token_counts(docs, BYTE, cache).collect()) == want
    stored = spark.read.parquet(f"{cache}/*")
    before = stored.count()
    assert before == len({t or "" for _, t, *_ in awkward()})
    assert counted(token_counts(docs, BYTE, cache).collect()) == want
    assert spark.read.parquet(f"{cache}/*").count() == before  # nothing was encoded again
    assert counted(token_counts(docs.union(docs.limit(1).withColumn("text", F.lit("new text"))), BYTE, cache).filter("n_bytes = 8").select("n_tokens").collect())[(2,)] >= 1
    assert spark.read.parquet(f"{cache}/*").count() == before + 1
    assert counted(token_counts(docs, WORD, cache).select("doc_id", "n_tokens").collect()) == Counter((i, len(tokens(WORD)(t))) for i, t, *_ in awkward())
    assert token_counts(nothing, BYTE, str(tmp_path / "other")).count() == 0


def test_encoder_on_odd_texts():
    parts = ["a", "B", " ", " ", "\n", "\t", "'s", "'ll", "é", "İ", "́", "1", "中", "\xa0", "foo", "<|endoftext|>", ".", "!!", "\x1c", "Σ", "I'm", "😀", "a.", "b,", "×", "\x00", "\r"]
    rng = random.Random(9)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for path in (BYTE, WORD):
        ids = tokens(path)
        small = PieceEncoder(path, limit=500)  # the table starts anew again and again
        for text, found in zip(texts, small.encode_all([t.encode() for t in texts]), strict=True):
            assert found.tolist() == ids(text), repr(text)


class Counted:
    """A tokenizer that counts the characters it is given, with and without offsets."""

    def __init__(self, library):
        self.library, self.slow, self.all = library, 0, 0

    def encode(self, text, **how):
        self.slow, self.all = self.slow + len(text), self.all + len(text)
        return self.library.encode(text, **how)

    def encode_batch_fast(self, texts, **how):
        self.all += sum(map(len, texts))
        return self.library.encode_batch_fast(texts, **how)


def test_encoder_spares_the_library():
    """Pieces met again outlive a full table, and plain pieces are told apart without offsets."""
    again = [f"{a}{b}{c}é$$" for a in "abcdefghij" for b in "abcdefghij" for c in "vwxyz"]
    texts = [" ".join([*again, *(f"Only{k}x{j}" for j in range(400))]) for k in range(12)]
    for path in (BYTE, WORD):
        encoder = PieceEncoder(path, limit=2000)
        encoder.library = Counted(encoder.library)
        for text in texts:
            assert [x.tolist() for x in encoder.encode_all([text.encode()])] == [tokens(path)(text)]
        assert encoder.library.slow == 0
        once = sum(len(f" Only{k}x{j}") for k in range(12) for j in range(400)) + sum(len(w) + 1 for w in again)
        assert encoder.library.all <= once


def unlike_words(bits):
    """Two words of 2 ** bits letters that agree under polynomial hashes modulo powers of two."""
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_structured_words_are_told_apart(spark):
    for bits in (10, 11, 12):
        one, two = unlike_words(bits)
        hashes, *_ = word_hashes([one.encode(), two.encode(), one.encode()])
        assert hashes[0] != hashes[1] and hashes[0] == hashes[2]
        for path in (BYTE, WORD):
            texts = [f"x {w} y" for w in (one, two, one)]
            assert [x.tolist() for x in PieceEncoder(path).encode_all([t.encode() for t in texts])] == [tokens(path)(t) for t in texts]
    rows = [(k, " ".join([*(f"w{j}" for j in range(30)), w])) for k, w in enumerate((one, two, one))]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n=3, percent=99, links=True)
    assert {r.doc_id: (r.component_id, r.n_links) for r in found.collect()} == {0: (0, 1), 1: (1, 0), 2: (0, 1)}


def test_pieces_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr("tessera.llm.tokenizing.hashed", lambda one, two, n: one & np.uint64(3))
    texts = ["one two three four", "two five one six seven", "Eight nine. ten, one"] * 3
    assert [x.tolist() for x in PieceEncoder(BYTE).encode_all([t.encode() for t in texts])] == [tokens(BYTE)(t) for t in texts]


def test_token_output(spark, docs, nothing, tmp_path):
    ids = tokens(WORD)
    found = stored_tokens(docs, WORD).collect()
    want, at = [], 0
    rows = sorted(awkward(), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t, *_ in rows:
        x = [*ids(t), 2]
        want.append((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    found.sort(key=lambda r: r.start)
    for r in found:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in found] == [w[0] for w in want]
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter(want)
    assert stored_tokens(nothing, WORD).count() == 0
    write_tokens(docs.filter("doc_id < 3 OR doc_id = 113"), str(tmp_path / "t"), WORD)
    texts = {i: t for i, t, *_ in awkward()}
    assert {r.doc_id: r.ids for r in read_ids(spark, str(tmp_path / "t")).collect()} == {i: [*ids(texts[i]), 2] for i in (0, 1, 2, 113)}


def test_range_coder():
    rng = np.random.default_rng(1)
    blocks = [np.zeros(0, int), np.array([5]), np.zeros(BLOCK, int), np.full(BLOCK - 1, 49407), rng.integers(0, 49408, BLOCK), np.tile([1, 2, 3], 600), np.arange(1500) * 32]
    coded = encode_blocks(blocks)
    for block, back in zip(blocks, decode_blocks(coded), strict=True):
        assert block.tolist() == back.tolist()
    assert len(coded[2]) < 300 and len(coded[5]) < 600  # what repeats is predicted
    assert decode_blocks([coded[4]])[0].tolist() == blocks[4].tolist()  # blocks don't need each other
    for at in (0, 5, 9, 40):
        damaged = bytearray(coded[4])
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            decode_blocks([bytes(damaged)])
    parts = [b"", b"abc", b"d" * 100_000, b"ef"]
    assert joined_crc([(len(p), zlib.crc32(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_blocks_are_coded_by_the_jvm(spark, docs, tmp_path):
    register(spark)
    rng = np.random.default_rng(3)
    blocks = [np.zeros(0, int), np.array([5]), np.zeros(BLOCK, int), np.full(BLOCK, 65534), rng.integers(0, 49408, BLOCK), np.tile([1, 2, 3], 600)]
    blocks += [np.minimum(rng.zipf(1.2 + k / 50, rng.integers(1, BLOCK + 1)), 65534) for k in range(60)]
    rows = spark.createDataFrame([(k, bytearray(b.astype("<u4").tobytes())) for k, b in enumerate(blocks)], "k int, ids binary")
    coded = {r.k: bytes(r.c) for r in rows.select("k", encoded(F.col("ids")).alias("c")).collect()}
    assert [coded[k] for k in range(len(blocks))] == encode_blocks(blocks)  # one format, whoever writes it
    back = spark.createDataFrame([(k, bytearray(c)) for k, c in coded.items()], "k int, c binary").select("k", decoded(F.col("c")).alias("ids"))
    assert all(np.frombuffer(r.ids, "<u4").tolist() == blocks[r.k].tolist() for r in back.collect())
    for at in (0, 5, 9, 40):
        damaged = bytearray(coded[4])
        damaged[at] ^= 1
        with pytest.raises(Exception, match="block"):
            spark.createDataFrame([(damaged,)], "c binary").select(decoded(F.col("c"))).collect()
    # No block is decoded in a Python worker.
    write_tokens(docs, str(tmp_path / "t"), WORD)
    assert "MapInArrow" not in read_pieces(spark, str(tmp_path / "t"))._jdf.queryExecution().toString()


def test_flow_and_transfers():
    # two units, a cheap path of one and a dear one
    assert min_cost_flow(4, [(0, 1, 2, 0), (1, 3, 1, 0), (1, 2, 2, 1), (2, 3, 2, 1)], 0, 3) == [2, 1, 1, 1]
    rng = random.Random(4)
    for _ in range(40):
        old = [rng.randint(0, 50) for _ in range(rng.randint(1, 9))]
        new = equal_capacities(sum(old), rng.randint(1, 9))
        plan = transfers(old, new)
        assert [sum(n for _, n in p) for p in plan] == old
        got = Counter()
        for p in plan:
            for j, n in p:
                got[j] += n
        assert all(got[j] == c for j, c in enumerate(new))
        moved = sum(n for i, p in enumerate(plan) for j, n in p if i != j)
        assert moved == sum(old) - sum(min(a, b) for a, b in zip(old, new, strict=False))  # the fewest possible
    assert cut_line([5, 5, 5], [(0, 7), (2, 8)]) == [[(0, 7)], [(0, 2), (2, 10)], [(2, 5)]] and cut_line([4], [(1, 4)]) == [[(1, 4)]] and cut_line([], []) == []
    assert affected([("a", 0, [(0, 7)]), ("b", 0, [(0, 2), (2, 10)]), ("c", 0, [(2, 5)])]) == ([("c", 2)], [("b", [(0, 2), (2, 10)])])


def files_of(path):
    return {f.name: (f.parent.name, f.stat().st_mtime_ns, f.stat().st_ino) for f in path.glob("shard=*/part-*")}


def test_sharding(spark, docs, tmp_path):
    rows = docs.select("doc_id", "text").crossJoin(spark.range(20)).select((F.col("doc_id") * 20 + F.col("id")).alias("doc_id"), "text", F.pmod(F.xxhash64("doc_id", "id"), F.lit(4)).cast("int").alias("shard"))
    rows = rows.withColumn("old_shard", F.col("shard")).filter("text IS NULL OR length(text) < 5000")
    want = Counter((r.doc_id, r.text, r.old_shard) for r in rows.collect())
    schema, path, size = "doc_id long, text string, old_shard int", tmp_path / "s", lambda t: len((t or "").encode()) + 16
    with common.Scratch(spark) as scratch:
        write_shards(rows, str(path), scratch, files_a_shard=6)
        stored = files_of(path)
        assert len(stored) >= 20 and {f[0] for f in stored.values()} == {f"shard={k}" for k in range(4)}
        for shards in (6, 3, 9):  # each time from what the folder then holds
            plan, cuts = plan_files(spark, schema, str(path), shards)
            moved, split = affected(cuts)
            before = {(r.doc_id, r.text, r.old_shard): r.shard for r in read_shards(schema, str(path), scratch).collect()}
            rewrite_shards(spark, schema, str(path), cuts)
            found = read_shards(schema, str(path), scratch).collect()
            assert Counter((r.doc_id, r.text, r.old_shard) for r in found) == want
            now, name = files_of(path), lambda f: f.rsplit("/", 1)[1]
            for f, (folder, when, inode) in stored.items():
                if f in {name(x) for x, _ in split}:
                    assert f not in now
                elif f in {name(x) for x, _ in moved}:
                    assert now[f] == (f"shard={next(j for x, j in moved if name(x) == f)}", when, inode)
                else:
                    assert now[f] == (folder, when, inode)  # untouched
            stored, slots, sizes = now, {}, Counter()
            for r in found:
                sizes[r.shard] += size(r.text)
                slots.setdefault(r.shard, []).append(r.slot)
            assert all(sorted(x) == list(range(len(x))) for x in slots.values())
            largest = max(size(r.text) for r in found)
            assert sorted(sizes) == list(range(shards)) and max(sizes.values()) - min(sizes.values()) < 2 * largest
            planned = sum(n for i, p in enumerate(plan) for j, n in p if i != j)
            assert abs(sum(size(r.text) for r in found if r.shard != before[r.doc_id, r.text, r.old_shard]) - planned) < largest * shards


def test_sharding_of_nothing(spark, nothing, tmp_path):
    schema = "doc_id long, text string"
    with common.Scratch(spark) as scratch:
        write_shards(nothing.select("doc_id", "text", F.lit(0).alias("shard")), str(tmp_path / "s"), scratch)
        plan, cuts = plan_files(spark, schema, str(tmp_path / "s"), 6)
        rewrite_shards(spark, schema, str(tmp_path / "s"), cuts)
        assert plan == cuts == [] and read_shards(schema, str(tmp_path / "s"), scratch).count() == 0


def test_html():
    page = '<head><title>t</title></head><nav>menu</nav><article><h1>A &amp; b</h1><p>one <b>two</b>&nbsp;three<p title="x>y">four<br>five<ul><li>i<li>j</ul><div class="ad">buy</div><section class="comments"><p>me too</section></article><footer>f</footer>'
    assert read_page(page)[0] == "A & b\none two three\nfour five\ni\nj"
    assert read_page("")[0] == "" and read_page("plain <b>text")[0] == "plain text"
    assert read_page('<script>var t="</p>";</script><main>x<!-- y --> z</main>w')[0] == "x z"
    assert read_page("<p>a</div></b><p>b</body><table><tr><td>c<td>d</table>")[0] == "a\nb\nc\nd"


def test_site_templates(spark):
    html = [(k, "http://A.example/x", f"<div>Same banner</div><p>text {k}</p>") for k in range(8)] + [(9, "http://b.example/", "<div>Same banner</div>"), (10, None, None), (11, "", "<p>x")]
    df = spark.createDataFrame(html, "page_id long, url string, html string").withColumns({"host": F.lit("h"), "templates": F.lit(1)})
    assert [(r.host, r.n_pages) for r in site_templates(df).collect()] == [("a.example", 8)]
    found = {r.page_id: (r.text, r.n_chars) for r in extract_pages(df).collect()}
    assert found == {**{k: (f"text {k}", 6) for k in range(8)}, 9: ("Same banner", 11), 10: ("", 0), 11: ("x", 1)}
    assert extract_pages(df.limit(0)).count() == 0


def test_site_templates_without_broadcast(spark, monkeypatch):
    html = [(k, "http://a.example/x", f"<div>Same banner</div><p>text {k}</p>") for k in range(8)] + [(10, None, None)]
    df = spark.createDataFrame(html, "page_id long, url string, html string")
    monkeypatch.setattr("tessera.llm.html_extraction.BROADCAST_ROWS", 0)
    # the rows are read after the templates are stored, so the joined form must stand alone
    found = {r.page_id: r.text for r in extract_pages(df).collect()}
    assert found == {**{k: f"text {k}" for k in range(8)}, 10: ""}


def test_recurring_inline_elements_of_an_article_stay(spark):
    inside = '<p>by <a href="/x">The Author</a> and <b>Bold</b> <em>stress</em> <x-tag>odd</x-tag> {0}<p><b>One unclosed<br><p>{0}<div>Same box</div>'
    df = spark.createDataFrame([(k, "http://a.example/x", f"<b>Same</b><article>{inside.format(k)}</article>") for k in range(8)], "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extract_pages(df).collect()}
    assert found == {k: f"by The Author and Bold stress\nodd\n{k}\nOne unclosed\n{k}\nSame box" for k in range(8)}


def test_templates_of_many_pages(spark):
    """Menus and notices without a name go as they recur on a host; one-off blocks, sentences with
    recurring parts and whole articles stay."""
    menus = ["<div><div>Home</div><div>News <span>today</span></div></div>", "<ul><li><a href=/a>Start</a><li>Help</ul>"]
    pages, want = [], {}
    for host in range(3):
        for k in range(50):
            own = f"Text {k} of host {host} says <b>hello</b> and <a href=/x>link</a> end"
            plain = f"Text {k} of host {host} says hello and link end"
            notice = "<section>We changed our terms</section>" if k % 2 else f"<section>Only here {k}</section>"
            if host < 2:
                page = f'<body class="no-sidebar">{menus[host]}<article class="comments-open"><h1>Same head</h1><p>{own}<p><b>{own}<br><p>Same words</article>{notice}'
                text = f"Same head\n{plain}\n{plain}\nSame words"
            else:  # no article
                page = f"<body>{menus[0]}<div><p>{own}</p></div>{notice}<p>Go on <em>always</em> {k}</p>"
                text = f"{plain}\n" + ("" if k % 2 else f"Only here {k}\n") + f"Go on always {k}"
            pages.append((100 * host + k, f"https://h{host}.example/{k}", page))
            want[100 * host + k] = text
    pages.append((900, "https://h0.example/x", "<article>top" + "".join(f"<article>r{k}</article>" for k in range(500)) + "</article>"))
    want[900] = "\n".join(["top", *[f"r{k}" for k in range(500)]])
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in extract_pages(df).collect()} == want
    without = {k: read_page(h)[0] for k, _, h in pages}
    assert sum(without[k] != want[k] for k in want) == 50  # names alone don't find what recurs


def test_long_and_deep_pages():
    deep = "<div>" * 3000 + "middle" + "</div>" * 3000
    assert read_page(deep)[0] == "middle"
    long = "<article>" + "".join(f"<p>line {k}" for k in range(40000)) + "</article>"
    assert read_page(long)[0] == "\n".join(f"line {k}" for k in range(40000))


def test_nested_articles_give_their_text_once():
    for n in (3, 150, 400):
        page = "<article>top" + "".join(f"<article>reply {k}</article>" for k in range(n)) + "</article><article>last</article>"
        assert read_page(page)[0] == "\n".join(["top", *[f"reply {k}" for k in range(n)], "last"])
    deep = "".join(f"<article>level {k}" for k in range(300)) + "</article>" * 300
    assert read_page(deep)[0] == "\n".join(f"level {k}" for k in range(300))


def test_class_words_never_delete_a_root():
    assert read_page('<html class="overlay"><body class="has-sidebar" id="search"><article class="post comments-open"><p>text</article>')[0] == "text"
    assert read_page('<body class="sidebar"><main class="widget">text<div class="site sidebar">not</div></main>')[0] == "text"
    assert read_page('<div class="banner">no<article>text</article></div>')[0] == "text"
    assert read_page('<main>a<div class="social"><article>text</article></div></main>')[0] == "a\ntext"
    assert read_page('<article>text<div class="comments"><article>me too</article></div></article><ol class="comments"><article>so do I</article></ol>')[0] == "text"
    assert read_page('<div hidden><article>no</article></div><div class="has-sidebar">text</div>')[0] == "text"


def test_quality_classifier_on_held_out_rows(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(600):
        good = rng.random() < 0.8
        words = [rng.choice(["the", "river", "house", "walks", "slowly", "green", "stone"]) + rng.choice(["", "s"]) for _ in range(rng.randint(5, 80))]
        text = " ".join(words) + "." if good else " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in words)
        rows.append((k, text, good))
        if k < 300:
            labels.append((k, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    lab = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, quality int")
    found = {r.doc_id: r for r in select_quality(df.drop("good"), lab).collect()}
    kept = Counter((good, found[k].selected) for k, _, good in rows if k >= 300)
    assert kept[True, True] >= 0.97 * (kept[True, True] + kept[True, False]) and kept[False, False] >= 0.75 * (kept[False, True] + kept[False, False])
    assert counted(select_quality(df.repartition(3), lab).select("doc_id", "selected").collect()) == Counter((k, r.selected) for k, r in found.items())


def labelled_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        good = rng.random() < 0.8
        words = [rng.choice(["the", "river", "house", "walks", "slowly", "green", "stone"]) + rng.choice(["", "s"]) for _ in range(rng.randint(5, 80))]
        rows.append((k, " ".join(words) + "." if good else " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in words), good))
    return rows


def test_weights_and_selection_by_brute_force(spark):
    rows = [*((k, t) for k, t, _ in labelled_rows(150, 4)), (150, None), (151, ""), (3, "again the river"), (None, "stone")]
    labels = [(k, int(good)) for k, _, good in labelled_rows(150, 4)[:60]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    prior, shrink, effective = 65536.0, 50.0, 50.0
    raw, target, mine = Counter(), Counter(), []
    known = dict(labels)
    for k, t in rows:
        families = [list(f[b[0] : b[-1]]) for f, b in _features([(t or "").encode()])] if t else [[], [], []]
        mine.append(families)
        for n, f in enumerate(families):
            for x in f:
                raw[n, x] += 1
                target[n, x] += known.get(k) == 1
    share = {n: sum(raw[m, x] + 1 for m, x in raw if m == n) + BUCKETS - sum(m == n for m, _ in raw) for n in range(3)}
    hits = {n: sum(v for (m, _), v in target.items() if m == n) for n in range(3)}

    def ratio(n, x):
        p = (raw[n, x] + 1) / share[n]
        return np.log((target[n, x] + prior * p) / ((hits[n] + prior) * p))

    want = [sum(ratio(n, x) for n, f in enumerate(fs) for x in f) * effective / (sum(map(len, fs)) + shrink) for fs in mine]
    found = select_quality(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    order = lambda pairs: sorted((k is None, k or 0, float(w)) for k, w in pairs)
    got, right = order((r.doc_id, r.log_weight) for r in found), order((k, w) for (k, _), w in zip(rows, want, strict=True))
    assert [x[:2] for x in got] == [x[:2] for x in right] and [x[2] for x in got] == pytest.approx([x[2] for x in right], abs=1e-8)
    n = int(np.ceil(len(rows) * (sum(v for _, v in labels) / len(labels) + 0.02)))
    ranked = sorted(found, key=lambda r: -r.sampling_key)
    assert {(r.doc_id, r.log_weight) for r in found if r.selected} == {(r.doc_id, r.log_weight) for r in ranked[:n]}
    assert all(r.sampling_key != r.log_weight for r in found)


def test_draws_decide_near_the_cut(spark):
    """Texts of two kinds, both unlike the target by little: seeds differ, and over seeds a kind is drawn
    as its weights say."""
    rows = [(k, f"alpha beta w{k % 7} gamma" if k % 2 else f"delta w{k % 5} eps zeta") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").cache()
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(200)], "doc_id long, quality int")
    chosen = []
    for seed in (11, 12, 13):
        found = select_quality(df, labels, seed=seed, slack=-0.25).collect()
        chosen.append({r.doc_id for r in found if r.selected})
        weights = {r.doc_id: r.log_weight for r in found}
    assert len(chosen[0] ^ chosen[1]) > 40 and len(chosen[1] ^ chosen[2]) > 40
    # Gumbel top k is sampling without replacement: compare with such draws by weight.
    rng, drawn = np.random.default_rng(1), 0
    w = np.exp([weights[k] for k in range(400)])
    for _ in range(50):
        drawn += sum(k % 2 for k in rng.choice(400, len(chosen[0]), replace=False, p=w / w.sum()))
    share = sum(k % 2 for c in chosen for k in c) / sum(map(len, chosen))
    assert abs(share - drawn / 50 / len(chosen[0])) < 0.08


def test_features_of_a_text_alone():
    rng = random.Random(2)
    texts = [bytes(rng.choices(b"ab \n\xc3\xa9", k=rng.choice([0, 1, 2, 3, 4, 30]))) for _ in range(300)]
    for family, (buckets, bounds) in enumerate(_features(texts)):
        for k, text in enumerate(texts):
            alone, whole = list(_features([text]))[family]
            assert buckets[bounds[k] : bounds[k + 1]].tolist() == alone[whole[0] : whole[-1]].tolist(), (family, text)


def test_quality_classifier_edges(spark, docs, nothing):
    labels = spark.createDataFrame([(k, 1) for k in range(10)], "doc_id long, quality int")
    assert select_quality(docs, labels).count() == len(awkward())
    assert select_quality(nothing, labels).count() == 0
    assert select_quality(docs, labels.limit(0)).filter("NOT selected").count() == 0


def test_components(spark, monkeypatch):
    rng = random.Random(3)
    graphs = [[], [(1, 1)], [(k, k + 1) for k in range(200)], [(k, 0) for k in range(1, 100)], [(a, b) for a in range(30) for b in range(a)], [(rng.randrange(300), rng.randrange(300)) for _ in range(200)], [(a, a ^ 1) for a in range(40)] + [(39, 5), (5, 39), (100, 0)]]
    for links in graphs:
        root = {x: x for e in links for x in e}

        def find(x):
            while root[x] != x:  # noqa: B023
                x = root[x]  # noqa: B023
            return x

        for a, b in links:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        with common.Scratch(spark) as scratch:
            found = connected_components(spark.createDataFrame(links, "a long, b long"), scratch, "g").collect()
            assert counted(found) == Counter((x, find(x)) for x in root if find(x) != x)
    monkeypatch.setattr("tessera.llm.components.ROUNDS", 2)
    with common.Scratch(spark) as scratch, pytest.raises(RuntimeError):
        connected_components(spark.createDataFrame(graphs[2], "a long, b long"), scratch, "g")


def test_workers_give_back_what_other_tasks_need(spark):
    """A worker that tokenized keeps its table for the next such task, and frees it for one of another kind."""

    def rss():
        with open("/proc/self/status") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("VmRSS"))

    def held(batches):
        yield from batches
        workers.HELD["table"] = np.ones(1 << 24)

    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(workers.HELD)] * batch.num_rows, pa.int64())], ["id"])

    assert list(workers.lean(seen)(iter(()))) == []
    list(held(iter(())))
    before = rss()
    assert [b["id"].to_pylist() for b in workers.lean(seen)(iter([pa.RecordBatch.from_arrays([pa.array([1])], ["id"])]))] == [[0]]
    assert rss() < before - 100_000
    encoder = encoder_of(BYTE)
    assert encoder_of(BYTE) is encoder  # held for the next task
    list(workers.lean(seen)(iter(())))
    assert encoder_of(BYTE) is not encoder


def test_token_writer_gives_memory_back(monkeypatch):
    """A worker that has written its stretch holds its table and not what its batches took."""
    calls = []
    monkeypatch.setattr(token_output, "give_back", lambda: calls.append(1))
    monkeypatch.setattr(token_output, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("One", (), {"partitionId": lambda self: 3})())}))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array(["a b", None])], ["doc_id", "text"])
    (found,) = token_output._writer(queries._tokenizer("word_bpe_49k.json"), 2)([batch])
    assert [d["doc_id"] for d in found["docs"].to_pylist()[0]] == [1, 2] and found["part"].to_pylist() == [3] and calls == [1]
