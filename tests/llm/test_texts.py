"""Token counts, shards, mixes and packing against plain versions."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import mixing, packing, sharding, token_cache
from tallyloom.llm.queries import QUERIES
from tallyloom.llm.vocabularies import piece_counter, word_ids
from tallyloom.workspace import scratch_path

PIECES, WORDS = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "word_bpe_49k.json"))


def test_counters_equal_the_libraries(spark, folder):
    texts = [r[0] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()][:60]
    texts += ["a  b", " a", "a ", "▁a b", "\ta\n b", "", "<s> </s> <unk>x", "é́ 　  b", "<|endoftext|>A<|EndOfText|> b",
              "İ Σας ΑΣ K \x1c THAT'S 'S", "don't!! x--y (z) 12.5% naïve? 東京,"]
    counter = piece_counter(PIECES)
    assert counter.counts(texts) == [len(counter.model.encode(t)) for t in texts]
    found = word_ids(WORDS)
    assert [i.tolist() for i in found.ids(pa.array(texts))] == [found._whole(t) for t in texts]


def test_token_counts_and_cache(spark, odd, empty):
    cache = scratch_path(spark, "cache")
    counter = piece_counter(PIECES)
    for _ in range(2):
        rows = token_cache.document_tokens(odd, PIECES, 4096, cache).collect()
        expected = sorted((r.doc_id or -1, len((r.text or "").encode()), len(counter.model.encode(r.text or ""))) for r in odd.collect())
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == expected
        assert all(r.over_limit == (r.n_tokens > 4096) for r in rows)
    # the second run has encoded nothing, and each distinct text is stored once
    assert token_cache.stored(spark, cache).count() == len({r.text or "" for r in odd.collect()})
    # stored counts are used: a changed one shows
    stored = token_cache.stored(spark, cache).withColumn("n_tokens", F.col("n_tokens") + 1_000_000).toPandas()
    other = scratch_path(spark, "cache")
    spark.createDataFrame(stored).write.parquet(other)
    assert all(r.n_tokens >= 1_000_000 for r in token_cache.document_tokens(odd, PIECES, 4096, other).collect())
    assert token_cache.document_tokens(empty, PIECES).collect() == []


def _law(rows, shards, largest):
    total = sum(r.size for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for shard, own in by.items():
        assert 0 <= shard < shards
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= 2 * largest + 0.01 * total / shards


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards(spark, folder, shards):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sharding.shard_documents(docs, shards).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (
            len(texts[r.doc_id].encode()) + 16, zlib.crc32(texts[r.doc_id].encode()), "bytes", None)
    _law(rows, shards, max(r.size for r in rows))


def test_shards_of_one_hot_text_and_many_slices(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the same text"))
                                    .otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    rows = sharding.shard_documents(docs, 8).collect()
    _law(rows, 8, 40)
    fine = sharding.histogram_shards(docs, F.lit(10).cast("long"), F.crc32(F.col("text").cast("binary")), 8, slice_rows=100)
    rows = [type("R", (), {"size": 10, "shard": r.shard, "slot": r.slot}) for r in fine.collect()]
    assert len(rows) == 6000
    _law(rows, 8, 10)
    # a text that fits into a shard stays together
    small = docs.where("doc_id % 3 <> 0 or doc_id < 300")
    assert sharding.shard_documents(small, 8).where(f"text_crc32 = {zlib.crc32(b'the same text')}").select("shard").distinct().count() <= 2


def test_odd_shards(odd, empty):
    rows = sharding.shard_documents(odd, 4).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.collect())
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (4, 5)} == {(16, 0)}
    kept = sharding.histogram_shards(odd, F.lit(1).cast("long"), F.lit(3), 2)
    assert set(kept.columns) == set(odd.columns) | {"shard", "slot"} and kept.count() == odd.count()
    assert sharding.shard_documents(empty, 4).collect() == []


def _mix_plain(sizes):
    """Targets by pouring, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return {**{s: 3 * sizes[s] for s in full}, **share}
        full |= over


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_mix(spark, folder, odd, which):
    docs = odd if which == "odd" else spark.read.parquet(f"{folder}/documents.parquet")
    rows = mixing.mix_report(docs.select("doc_id", "text", "source")).collect()
    source = [r.source for r in docs.orderBy("doc_id").collect()]
    sizes, largest = defaultdict(int), defaultdict(int)
    for r in docs.collect():
        n = len((r.text or "").encode().split())
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    goal = _mix_plain(dict(sizes))
    assert len(source) == len(rows)
    assert sorted((r.doc_id or -1, r.size) for r in rows) == sorted(
        (r.doc_id or -1, len((r.text or "").encode().split())) for r in docs.collect())
    for s in goal:
        own = [r for r in rows if r.source_size == sizes[s] and abs(r.target - goal[s]) < 1e-6 * (1 + goal[s])]
        assert own
        if sum(1 for x in sizes.values() if x == sizes[s]) == 1:
            assert abs(sum(r.taken for r in own) - goal[s]) <= 2 * largest[s] + 1
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    again = mixing.mix_report(docs.select("doc_id", "text", "source").repartition(7)).collect()
    assert sorted((r.doc_id or -1, r.taken) for r in again) == sorted((r.doc_id or -1, r.taken) for r in rows)


def test_mix_emits_copies(spark, odd, empty):
    taken = Counter()
    for r in mixing.mix_report(odd).collect():
        taken[r.doc_id] += r.taken
    mixed = mixing.mix_sources(odd)
    assert mixed.columns == odd.columns
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len((r.text or "").encode().split())
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in taken.items() if v}
    assert mixing.mix_report(empty).collect() == [] and mixing.mix_sources(empty).collect() == []


def _check_packing(rows, texts, capacity):
    words = word_ids(WORDS)
    expected = Counter()
    for i, t in texts:
        ids = np.array([*words._whole(t or ""), 0], "<u4")
        for p, begin in enumerate(range(0, len(ids), capacity)):
            cut = ids[begin: begin + capacity]
            expected[i, p, begin, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark, folder, odd, empty):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = QUERIES["op9_packing"](spark, folder).collect()
    used = _check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert used <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 1
    _check_packing(packing.pack_documents(odd, WORDS).collect(), [(r.doc_id, r.text) for r in odd.collect()], 2048)
    kept = packing.pack(odd, WORDS, 64, with_ids=True)
    assert "_n" in kept.columns
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in kept.collect())
    assert packing.pack_documents(empty, WORDS).collect() == []


def test_plans_hold_the_histogram_and_come_near_the_bound():
    random = np.random.default_rng(3)
    for histogram in ({5: 3}, {64: 10}, {33: 50}, {int(n): int(random.integers(1, 400)) for n in random.integers(1, 65, 40)},
                      {int(n): 100 for n in range(1, 65)}):
        plan = packing.plan_sequences(histogram, 64)
        used = Counter()
        for lengths, times in plan:
            assert sum(lengths) <= 64 and times > 0
            for n in lengths:
                used[n] += times
        assert used == Counter(histogram)
    sequences = sum(t for _, t in packing.plan_sequences({n: 100 for n in range(1, 65)}, 64))
    assert sequences <= 1.01 * 100 * sum(range(1, 65)) / 64 + 1
    uses = packing.fractional(np.arange(1, 65), np.full(64, 100.0), 64)
    assert sum(uses.values()) > 0.5 * 100 * sum(range(1, 65)) / 64  # the program does most of the work


def test_knapsack():
    lengths, values = np.array([3, 5, 7]), np.array([4.0, 7.0, 9.0])
    best, last = packing.knapsack(values, lengths, 20)
    for space in range(21):
        plain = max((4 * a + 7 * b + 9 * c) for a in range(7) for b in range(5) for c in range(3) if 3 * a + 5 * b + 7 * c <= space)
        assert best[space] == plain
