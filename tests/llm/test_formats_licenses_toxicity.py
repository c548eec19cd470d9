import hashlib
import os
import zlib

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lanewright.llm import chat_format, license_scan, queries, tiff_media, toxicity

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")
pieces = st.lists(st.sampled_from([*chat_format.CONTROL, "\\", "[", "<", "/", "INST]", "s>", "x", "\n", "é"]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), pieces), pieces), max_size=5))
@settings(max_examples=300, deadline=None)
def test_chat_round_trip(turns):
    out = "".join(chat_format.render(r, t) for r, t in turns)
    assert [x[:2] for x in chat_format.parse(out)] == turns


def test_texts_without_conflict_are_not_touched():
    assert chat_format.render("user", "a \\ b [x]") == "[INST]a \\ b [x][/INST]"
    assert chat_format.parse(chat_format.render("user", queries.ADVERSARY))[0][1] == queries.ADVERSARY
    with pytest.raises(ValueError):
        chat_format.parse("[INST] a")


def test_conversation_digests(spark):
    rows = [(1, 2, "assistant", "two"), (1, 1, "user", None), (1, 1, "user", None), (None, 1, None, "x"), (2, None, "assistant", "</s>"), (1, 3, "tool", "t")]
    d = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, rendered string")
    out = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.format_turns(d)).collect()}
    want = {1: [("user", ""), ("user", ""), ("assistant", "two"), ("tool", "t")], None: [("", "x")], 2: [("assistant", "</s>")]}
    assert set(out) == set(want)
    for k, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert out[k].n_turns == len(turns)
        assert out[k].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (out[k].loss_chars, out[k].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.conversation_digests(chat_format.format_turns(d.limit(0))).isEmpty()


@given(st.binary(max_size=4000), st.sampled_from([tiff_media.PLAIN, tiff_media.LZW, tiff_media.DEFLATE, tiff_media.PACKBITS]), st.sampled_from([1, 2]), st.sampled_from([None, (16, 16), (8, 32)]), st.integers(1, 40))
@settings(max_examples=80, deadline=None)
def test_tiff_round_trip(data, compression, predictor, tile, width):
    h = max(1, len(data) // width)
    img = np.frombuffer(data.ljust(h * width, b"\0")[: h * width], np.uint8).reshape(h, width)
    body = tiff_media.encode_tiff([img, img[:1]], compression, predictor, rows_per_strip=7, tile=tile)
    pages = list(tiff_media.read_pages(body))
    assert [(p["width"], p["height"]) for p in pages] == [(width, h), (width, 1)]
    assert pages[0]["samples"] == img.tobytes()


def test_lzw_over_a_full_table():
    data = np.random.default_rng(1).integers(0, 256, 60_000, dtype=np.uint8).tobytes()
    assert tiff_media.lzw_decode(tiff_media.lzw_encode(data), len(data)) == data
    # the worked example of the format: 7 7 7 8 8 7 7 6 6
    assert tiff_media.lzw_decode(bytes([0x80, 0x01, 0xE0, 0x40, 0x80, 0x44, 0x08, 0x0C, 0x06, 0x80, 0x80]), 9) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


def test_big_endian_sixteen_bits(spark):
    """Two samples of 16 bits, written by hand."""
    import struct

    head = b"MM\0*" + struct.pack(">I", 12) + struct.pack(">HH", 258, 1)
    fields = [(256, 3, 2), (257, 3, 1), (258, 3, 16), (259, 3, 1), (262, 3, 1), (273, 4, 8), (277, 3, 1), (278, 3, 1), (279, 4, 4)]
    ifd = struct.pack(">H", len(fields)) + b"".join(struct.pack(">HHI", t, k, 1) + (struct.pack(">HH", v, 0) if k == 3 else struct.pack(">I", v)) for t, k, v in fields) + bytes(4)
    (p,) = tiff_media.read_pages(head + ifd)
    assert np.frombuffer(p["samples"], np.uint16).tolist() == [258, 1]


def test_tiff_pages_report_broken_files(spark):
    good = tiff_media.encode_tiff([np.zeros((2, 64), np.uint8)], tiff_media.LZW)
    d = spark.createDataFrame([(1, bytearray(good), "c"), (2, bytearray(b"junk"), "c"), (3, None, "c"), (4, bytearray(good[:40]), "c"), (1, bytearray(good), "c")], "doc_id long, media binary, page string")
    out = tiff_media.tiff_pages(d).collect()
    assert sorted((r.doc_id, r.error is None) for r in out) == [(1, True), (1, True), (2, False), (3, False), (4, False)]
    assert tiff_media.tiff_pages(d.limit(0)).isEmpty()


def test_text_media(docs, odd_docs, corpus):
    text = {i: t for i, t, *_ in corpus}
    pages = tiff_media.tiff_pages(tiff_media.text_media(docs), keep=("doc_id", "n_bytes")).collect()
    assert len(pages) == docs.count()
    for r in pages:
        b = (text[r.doc_id] or "").encode()
        assert r.error is None and r.n_bytes == len(b)
        assert bytes(r.samples) == b.ljust(max(64, -(-len(b) // 64) * 64), b"\0")
    assert tiff_media.tiff_pages(tiff_media.text_media(odd_docs)).count() == 4


def shingles(text):
    w = [x for x in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if x]
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def test_license_scan_against_every_window(spark, corpus, odd_docs, no_docs):
    t = license_scan.TEMPLATES
    cut = " ".join(t["mit-permission"].split(" ")[:-6])
    texts = [x[1] for x in corpus] + [f"some words here {v} and more" for v in t.values()] + [cut, "released under the mit license", t["isc"].replace("software", "program", 1), *[f"{k} {t['gpl-3-line']} {t['mit-line']}" for k in range(3)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {}
    for d, text in enumerate(texts):
        s = shingles(text)
        for name, template in t.items():
            ts = set(shingles(template))
            for w in range(0, len(s), len(ts)):
                c = len(ts & set(s[w : w + 2 * len(ts)])) / len(ts)
                if c >= 0.8 and c > want.get((d, name), (0, 0))[0]:
                    want[d, name] = (c, w)
    got = {(r.doc_id, r.license): (r.containment, r.start_word) for r in license_scan.scan(docs).collect()}
    assert got == want and len({k[1] for k in got}) == len(t)
    assert license_scan.scan(odd_docs).isEmpty() and license_scan.scan(no_docs).isEmpty()


def test_license_scan_stays_native(docs):
    plan = license_scan.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


@pytest.fixture(scope="module")
def rude(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        w = [f"v{int(x)}" for x in rng.zipf(1.5, 80) % 300]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                w[int(rng.integers(0, 80))] = str(rng.choice(["blorf", "grumt", "skarn"]))
        rows.append((i, " ".join(w), int(toxic)))
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return d.drop("toxic"), d.select("doc_id", "toxic")


def test_toxicity_on_held_out_rows(rude):
    docs, labels = rude
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    out = toxicity.score_documents(docs, labels).collect()
    assert len(out) == 600
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_labels_of_held_out_rows_change_nothing(rude):
    docs, labels = rude
    other = labels.withColumn("toxic", F.when(toxicity.in_training(), F.col("toxic")).otherwise(1 - F.col("toxic")))
    key = lambda df: sorted((r.doc_id, round(r.score, 12)) for r in df.collect())
    assert key(toxicity.score_documents(docs, labels)) == key(toxicity.score_documents(docs, other))


def test_joined_model_equals_broadcast_model(rude):
    docs, labels = rude
    fitted = toxicity.train(docs.join(labels, "doc_id"))
    a = {r.doc_id: r["diff"] for r in toxicity.with_differences(docs, fitted).collect()}
    b = {r.doc_id: r["diff"] for r in toxicity.with_differences(docs, fitted, model_rows=0).collect()}
    assert a == pytest.approx(b) and any(a.values())


def test_toxicity_odd_rows(odd_docs, no_docs, rude, docs):
    out = toxicity.score_documents(odd_docs, rude[1]).collect()
    assert len(out) == 4 and all(0 <= r.score < 0.5 for r in out)
    assert toxicity.score_documents(no_docs, rude[1]).isEmpty()
    assert {r.predicted for r in toxicity.score_documents(docs, rude[1].limit(0)).collect()} == {0}
    assert toxicity.drop_toxic(odd_docs, rude[1]).columns == odd_docs.columns


@needs_data
def test_held_out_accuracy_on_the_supplied_tables(spark):
    out = queries.op1_toxicity(spark, SF).filter("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    assert out.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0] > 0.9
