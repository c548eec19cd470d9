import hashlib
import re
from collections import Counter

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewright.llm import components, simhash, suffix_dedup


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_components(ids, linked):
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {i: top(i) for i in ids}


def test_simhash_against_all_pairs(docs, corpus):
    fp = {i: plain_fingerprint(t) for i, t, *_ in corpus}
    ids = sorted(fp)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fp[a] ^ fp[b]).bit_count() <= 4]
    want = plain_components(ids, pairs)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert {r.doc_id: r.fp % (1 << 64) for r in got} == fp
    assert {r.doc_id: r.component_id for r in got} == want


def test_links_within_large_buckets(spark, monkeypatch):
    """Blocks of two rows: every pair of fingerprints must still meet."""
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 1 << 63, 6)]
    fps = {b ^ sum(1 << int(i) for i in rng.choice(63, rng.integers(0, 5), replace=False)) for b in base for _ in range(15)}
    fps = sorted(fps)
    real = simhash.dealt_buckets
    monkeypatch.setattr(simhash, "dealt_buckets", lambda rows, keys, id_col: real(rows, keys, id_col, block_rows=2))
    classes = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, rep long")
    links = simhash.linked(classes)
    found, rounds = ({r.node: r.component for r in components.connected_components(links, finish=f).collect()} for f in (200_000, 0))
    assert found == rounds
    want = plain_components(range(len(fps)), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    assert {i: found.get(i, i) for i in want} == want


def test_every_close_pair_shares_a_key():
    rng = np.random.default_rng(1)
    masks = simhash.key_masks()
    assert len(masks) == 30
    for _ in range(3000):
        a = int(rng.integers(0, 1 << 63))
        b = a ^ sum(1 << int(i) for i in rng.choice(64, rng.integers(0, 5), replace=False))
        assert any((a ^ b) & m == 0 for _, m in masks)


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
@settings(max_examples=60, deadline=None)
def test_local_roots(edges):
    u, v = (np.array([e[k] for e in edges], dtype=int) for k in (0, 1))
    want = plain_components(range(31), edges)
    assert components.local_roots(31, u, v).tolist() == [want[i] for i in range(31)]


def test_distributed_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, 200), (200, 5), (3, 3)]
    got, late, one = ({r.node: r.component for r in components.connected_components(spark.createDataFrame(chain, "a long, b long"), finish=f).collect()} for f in (0, len(chain) - 1, 200_000))
    assert got == late == one
    assert got == {**{i: 100 for i in range(100, 141)}, 5: 5, 7: 5, 200: 5}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_one_of_each_group_stays(docs, odd_docs, no_docs):
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    kept = [r.doc_id for r in simhash.drop_near_duplicates(docs).collect()]
    assert sorted(kept) == sorted(set(groups.values()))
    assert simhash.drop_near_duplicates(odd_docs).columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in simhash.drop_near_duplicates(odd_docs).collect()) == ["5", "6"]  # the row without an id is a copy of 6
    assert simhash.near_duplicates(odd_docs).count() == 4


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    one, other = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    df = spark.createDataFrame([(1, one), (2, one), (2, other), (None, other), (None, "c d e f g h")], "doc_id long, text string")
    assert sorted(((r.doc_id or 0, r.text) for r in simhash.drop_near_duplicates(df).collect())) == [(0, "c d e f g h"), (1, one), (2, other)]


def test_near_duplicates_of_an_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).isEmpty()


def plain_removal(texts, length):
    n = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_removal_against_counting(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 20_000)
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    for length in (400, 307, 200, 57):
        want = sorted((i, *x) for (i, _), x in zip(rows, plain_removal([b for _, b in rows], length), strict=True))
        got = sorted(tuple(r) for r in suffix_dedup.repeated_bytes(docs, length).collect())
        assert got == want
    assert sum(x[2] for x in got) > 0


def test_suffix_removal_by_shuffled_answers(docs, monkeypatch):
    want = sorted(map(tuple, suffix_dedup.repeated_bytes(docs).collect()))
    monkeypatch.setattr(suffix_dedup, "ANSWER_BYTES", -1)
    assert sorted(map(tuple, suffix_dedup.repeated_bytes(docs).collect())) == want


def test_unlike_strings_of_one_key_do_not_repeat(spark, monkeypatch):
    def weak_keys(a, at, length):
        """Few keys: unlike strings share them all the time."""
        return np.array([sum(a[i : i + 3].tolist()) % 7 for i in at], np.uint64) << np.uint64(61)

    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(suffix_dedup, "window_keys", weak_keys)
    rng = np.random.default_rng(2)
    line = lambda n: "".join(rng.choice(list("abcdefg h"), n))
    shared = [line(130), line(90)]
    texts = [line(300) for _ in range(4)] + [line(50) + s + line(40) for s in shared for _ in range(3)] + [line(45) * 3, shared[0][:59], line(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length in (60, 100):
        want = sorted((i, *x) for i, x in enumerate(plain_removal([t.encode() for t in texts], length)))
        assert sorted(map(tuple, suffix_dedup.repeated_bytes(docs, length).collect())) == want
        assert any(x[2] for x in want)


def test_rare_and_hot_copies(docs, monkeypatch):
    want = sorted(map(tuple, suffix_dedup.repeated_bytes(docs).collect()))
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    assert sorted(map(tuple, suffix_dedup.repeated_bytes(docs).collect())) == want
    assert sorted(r.text or "" for r in suffix_dedup.drop_repeats(docs).collect()).count("") > 5


def test_difference_cover():
    for length in (400, 200, 57, 38):
        q = suffix_dedup.field_for(length)
        d, v = suffix_dedup.difference_cover(q), q * q + q + 1
        assert len(d) == q + 1 and len({(a - b) % v for a in d for b in d}) == v and length - v + 1 >= 32


def test_cut_texts(docs, odd_docs, no_docs):
    removed = {r.doc_id: r.n_bytes - r.n_removed for r in suffix_dedup.repeated_bytes(docs, suffix_dedup.PASSAGE).collect()}
    out = suffix_dedup.drop_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.collect():
        assert len((r.text or "").encode()) <= removed[r.doc_id]
        assert r.n_chars == len(r.text or "")
    assert suffix_dedup.drop_repeats(odd_docs).count() == 4
    assert suffix_dedup.repeated_bytes(no_docs).isEmpty() and suffix_dedup.drop_repeats(no_docs).isEmpty()
