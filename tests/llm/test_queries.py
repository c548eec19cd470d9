"""The registered queries themselves, over whole small tables, against plain versions."""

import hashlib
import os
import zlib

import numpy as np
import pytest
from test_embeddings_pipeline import plain_links
from test_formats_licenses_toxicity import shingles
from test_mix_pack_shard import WORD, check_pieces, plain_targets
from test_text_dedup import plain_components, plain_fingerprint, plain_removal
from tokenizers import Tokenizer

from lanewright.llm import license_scan, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def test_all_are_registered():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]


def test_op1(spark, texts):
    out = run(spark, "op1_toxicity")
    assert sorted(r.doc_id for r in out) == sorted(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) for r in out)


def test_op2(spark, texts):
    out = run(spark, "op2_mixing")
    size = {i: len(WORD.findall(r.text or "")) for i, r in texts.items()}
    per = {}
    for i, r in texts.items():
        per[r.source] = per.get(r.source, 0) + size[i]
    want = plain_targets({k: per[k] for k in sorted(per)}, (5, 2, 1), 3.0)
    taken = {}
    for r in out:
        s = texts[r.doc_id].source
        assert (r["size"], r.source_size) == (size[r.doc_id], per[s]) and r.target == pytest.approx(want[s])
        assert r.taken <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - want[s]) <= max(size[i] for i, r in texts.items() if r.source == s) for s in per)


def test_op3(spark, texts):
    fp = {i: plain_fingerprint(r.text) for i, r in texts.items()}
    ids = sorted(fp)
    comp = plain_components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fp[a] ^ fp[b]).bit_count() <= 4])
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, "op3_simhash")} == {i: (f"{fp[i]:016x}", comp[i]) for i in ids}


def test_op4(spark, texts):
    ids = sorted(texts)
    want = plain_removal([(texts[i].text or "").encode() for i in ids], 400)
    assert sorted(map(tuple, run(spark, "op4_suffix_dedup"))) == [(i, *w) for i, w in zip(ids, want, strict=True)]


def test_op5(spark, texts):
    want = {}
    for i, r in texts.items():
        s = shingles(r.text)
        for name, t in license_scan.TEMPLATES.items():
            ts = set(shingles(t))
            best = max((len(ts & set(s[w : w + 2 * len(ts)])) / len(ts), -w) for w in range(0, max(1, len(s)), len(ts)))
            if best[0] >= 0.8:
                want[i, name] = (best[0], -best[1])
    assert {(r.doc_id, r.license): (r.containment, r.start_word) for r in run(spark, "op5_license_scan")} == want


def test_op6(spark):
    fill = check_pieces(run(spark, "op6_packing"), spark.read.parquet(f"{SF}/documents.parquet"), Tokenizer.from_file(queries.tokenizer_path()))
    assert sum(v < 2048 for v in fill.values()) <= 1


def test_op7(spark):
    turns = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in run(spark, "op7_chat_format")}
    loss = {k: "".join(t for r, t in v if r == "assistant") for k, v in turns.items()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {k: (len(v), sha("".join(f"{r}\n{t}\n" for r, t in v)), len(loss[k]), sha(loss[k])) for k, v in turns.items()}


def test_op8(spark, texts):
    for r in run(spark, "op8_tiff_media"):
        b = (texts[r.doc_id].text or "").encode()
        p = b.ljust(max(64, -(-len(b) // 64) * 64), b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))


def test_op9(spark, tmp_path):
    """The supplied vectors hold hardly a pair at 0.98: near copies of every fifth are planted beside them."""
    rng = np.random.default_rng(9)
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    near = [(10_000_000 + 2 * i + c, [float(np.float32(x + rng.normal() * 0.12 * np.linalg.norm(v) / len(v) ** 0.5)) for x in v], lab) for i, v, lab in rows[::5] for c in range(2)]
    spark.createDataFrame(rows + near, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = plain_links(rows + near)
    got = {r.vec_id: r.n_links for r in queries.op9_embedding_dedup(spark, str(tmp_path)).collect()}
    there = sum(map(len, want.values()))
    assert set(got) == set(want) and all(got[i] <= len(want[i]) for i in want)
    assert there > 50 and sum(got.values()) >= 0.95 * there


def test_op10(spark, texts):
    out = run(spark, "op10_sharding")
    slots, size = {}, np.zeros(40)
    for r in out:
        b = (texts[r.doc_id].text or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(b) + 16, zlib.crc32(b), "bytes", None)
        slots.setdefault(r.shard, []).append(r.slot)
        size[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert np.abs(size - size.mean()).max() <= max(r["size"] for r in out)
