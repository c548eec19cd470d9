import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanewright.llm import mixing, packing, queries, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes, weights, cap):
    """Iterative water-filling over (name, size)."""
    w = {n: weights[k % len(weights)] for k, n in enumerate(sizes)}
    budget, open_, out = sum(sizes.values()), set(sizes), {}
    while open_:
        share = (budget - sum(out.values())) / sum(w[n] for n in open_)
        over = {n for n in open_ if w[n] * share > cap * sizes[n]}
        if not over:
            return out | {n: w[n] * share for n in open_}
        out |= {n: cap * sizes[n] for n in over}
        open_ -= over
    return out


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1000}, {"a": 1, "b": 1, "c": 5000, "d": 3, "e": 90}, {"a": 0, "b": 7}, {"a": 5}])
def test_water_filling(spark, sizes):
    src = spark.createDataFrame([(n, s) for n, s in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(src, (5, 2, 1), 3.0).collect()}
    want = plain_targets(dict(sorted(sizes.items())), (5, 2, 1), 3.0)
    assert got == pytest.approx(want)


def test_mix_of_documents(docs, corpus):
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    for r in sized.collect():
        assert r["size"] == len(WORD.findall(corpus[r.doc_id][1] or ""))
    out = mixing.mix(sized).collect()
    assert len(out) == docs.count()
    by = {}
    for r in out:
        assert 0 <= r.repeats <= 3
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        total = sum(r["size"] * r.repeats for r in rows)
        assert abs(total - rows[0].target) <= max(r["size"] for r in rows)
    again = sorted((r.doc_id, r.repeats) for r in mixing.mix(sized.repartition(3)).collect())
    assert again == sorted((r.doc_id, r.repeats) for r in out)


def test_mixed_corpus_repeats_whole_rows(docs, odd_docs, no_docs):
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    want = sum(r.repeats for r in mixing.mix(sized).collect())
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns and out.count() == want
    assert mixing.mix_documents(odd_docs).columns == odd_docs.columns
    assert mixing.mix_documents(no_docs).isEmpty()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def check_pieces(rows, docs, tokenizer, seq=2048):
    ids = {r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4") for r in docs.collect()}
    n = {}
    for r in docs.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    covered = {d: np.zeros(len(x), int) for d, x in ids.items()}
    for p in rows:
        x = ids[p.doc_id]
        assert p.doc_tokens == len(x) and p.length > 0
        assert zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        covered[p.doc_id][p.start : p.start + p.length] += 1
    assert all((c == n[d]).all() for d, c in covered.items())
    seqs = {}
    for p in rows:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for s in seqs.values():
        at = 0
        for o, length in sorted(s):
            assert o == at
            at += length
        assert at <= seq
    return {k: sum(x for _, x in s) for k, s in seqs.items()}


def test_packing_round_trip(docs, tokenizer):
    out = packing.pack_documents(docs, queries.tokenizer_path()).withColumn("ids_crc32", F.crc32("ids")).collect()
    fill = check_pieces(out, docs, tokenizer)
    assert sum(v < 2048 for v in fill.values()) <= 1


def test_packing_in_groups(docs, tokenizer):
    tokens = packing.tokenize(docs, queries.tokenizer_path())
    out = packing.pack(tokens, docs.count(), 256, group_docs=10).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(out, docs, tokenizer, 256)
    assert len({p.sequence_id >> 40 for p in out}) > 3


def test_packing_odd_rows(odd_docs, no_docs):
    out = packing.pack_documents(odd_docs, queries.tokenizer_path()).collect()
    assert sorted(str(p.doc_id) for p in out) == ["5", "5", "6", "None"]
    assert packing.pack_documents(no_docs, queries.tokenizer_path()).isEmpty()


def test_word_encoder_equals_the_tokenizer(corpus, tokenizer):
    e = packing.WordEncoder(queries.tokenizer_path())
    more = ["<|endoftext|> a b<|startoftext|>", "A\x1cB\x85c d ́x é İ ΑΣ Σ", "it's we'll\r\n'S  1234 x1 ٣", "Straße. ÀÉ,, xÿ a%%% b&&&- ![x](y) naïve…", "漢字 かな 👍🏽"]
    for t in [*more, *[t for _, t, *_ in corpus if t and len(t) < 5000]]:
        assert e(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_sum_of_squares_choice():
    lv = packing.Levels(10)
    rng = np.random.default_rng(2)
    for w in range(200):
        size = int(rng.integers(1, 10))
        n = lv.count.copy()

        def cost(level):
            m = n.copy()
            if level:
                m[level] -= 1
            if level + size < 10:
                m[level + size] += 1
            return int((m[1:10] ** 2).sum())

        options = [0, *[h for h in range(1, 11 - size) if n[h]]]
        level = lv.choose(size)
        assert cost(level) == min(map(cost, options))
        if level:
            lv.take(level)
        lv.put(level + size, w)


def test_shards(docs, odd_docs, no_docs, corpus):
    out = sharding.assign_shards(docs, 5).collect()
    assert len(out) == docs.count()
    text = {i: t for i, t, *_ in corpus}
    for r in out:
        b = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(b) + 16, zlib.crc32(b))
    shards = {}
    for r in out:
        shards.setdefault(r.shard, []).append(r)
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in shards.values())
    biggest = max(r["size"] for r in out)
    even = sum(r["size"] for r in out) / 5
    assert all(abs(sum(r["size"] for r in s) - even) <= biggest for s in shards.values())
    again = sharding.assign_shards(docs.repartition(7), 5).collect()
    key = lambda rows: sorted((r.doc_id, r.shard) for r in rows)
    assert key(again) == key(out)
    assert sharding.assign_shards(odd_docs, 3).count() == 4
    assert sharding.assign_shards(no_docs, 3).isEmpty()


def test_a_hot_key_is_spread(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.col("id").cast("string")).alias("text"))
    per = [r["count"] for r in sharding.assign_shards(d, 10, cell_rows=100).groupBy("shard").count().collect()]
    assert len(per) == 10
