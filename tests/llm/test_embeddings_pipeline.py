import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lanewright.llm import embedding_dedup, similar_texts, suffix_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(120, 16))
    rows, n = [], 0
    for k, b in enumerate(base):
        for c in range(1 + (k % 4 == 0) * 4):
            v = b if c == 0 else b + rng.normal(size=16) * 0.03
            rows.append((n, [float(x) for x in v], k % 3))
            n += 1
    rows += [(n + i, rows[0][1], 0) for i in range(40)]  # copies
    n += 40
    rows.append((n, [2 * x for x in rows[0][1]], 0))  # same direction
    odd = [None, [0.0] * 16, [float("nan")] * 16, [None, 1.0] + [0.0] * 14, [float("inf")] + [0.0] * 15]
    rows += [(n + 1 + i, v, 0) for i, v in enumerate(odd)] + [(n + 6, rows[0][1], None), (n + 7, rows[0][1][:8], 0)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, size int")


def plain_links(rows):
    ok = [(i, np.array(v, float), lab) for i, v, lab in rows if v is not None and lab is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {i: set() for i, *_ in rows}
    for a in range(len(ok)):
        for b in range(a):
            (i, u, p), (j, v, q) = ok[a], ok[b]
            if p == q and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= 0.98:
                out[i].add(j)
                out[j].add(i)
    return out


def test_embedding_links(vectors):
    rows, df = vectors
    want = plain_links(rows)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    assert set(got) == set(want)
    found, there = sum(r.n_links for r in got.values()), sum(map(len, want.values()))
    assert 0.9 * there <= found <= there
    assert all(r.n_links <= len(want[i]) for i, r in got.items())
    assert all(r.kept == (i == r.component_id) for i, r in got.items())
    assert got[0].n_links >= 41 and {got[i].component_id for i in want[0]} == {0}


def test_links_are_counted_once_in_small_blocks(vectors, monkeypatch):
    rows, df = vectors
    want = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicate_vectors(df).collect()}
    real = embedding_dedup.dealt_buckets
    monkeypatch.setattr(embedding_dedup, "dealt_buckets", lambda r, k, i: real(r, k, i, block_rows=2))
    assert {r.vec_id: r.n_links for r in embedding_dedup.near_duplicate_vectors(df).collect()} == want


def test_no_vectors(vectors):
    assert embedding_dedup.near_duplicate_vectors(vectors[1].limit(0)).isEmpty()


@pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash", "suffix_array", "mixing", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    clean = stage["toxicity"](spark, docs, SF)
    assert clean.columns == docs.columns and 0.8 * docs.count() < clean.count() <= docs.count()
    one = stage["simhash"](spark, clean, SF)
    groups = similar_texts.similar_groups(clean).groupBy("component").agg(F.min("doc_id").alias("first"))
    assert {r.doc_id for r in one.collect()} == {r.first for r in groups.collect()}
    cut = stage["suffix_array"](spark, one, SF)
    assert cut.count() == one.count()
    kept = {r.doc_id: r for r in suffix_dedup.repeated_bytes(one, suffix_dedup.PASSAGE).collect()}
    assert all(r.text is None or len(r.text.encode()) <= kept[r.doc_id].n_bytes - kept[r.doc_id].n_removed for r in cut.collect())
    mixed = stage["mixing"](spark, cut, SF)
    assert mixed.columns == docs.columns
    ends = stage["packing"](spark, mixed, SF)
    whole = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r.doc_id, r.start, r.length, bytes(r.ids)) for r in df.collect())
    assert key(whole) == key(ends)
