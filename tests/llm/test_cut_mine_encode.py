"""Fill-in-middle, collocations and byte-level BPE against plain versions."""

import base64
import hashlib
import os
import random
import re
import struct
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lanewright.llm import byte_bpe, collocations, fill_middle, queries

SF = "/root/testdata/sf0.001"
sha = lambda x: hashlib.sha256(x).hexdigest()


def plain_middle(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by the definition."""
    text = text or ""
    u = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[k : k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(u), "plain", None, None, text
    lo, hi = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:lo]), "".join(u[lo:hi]), "".join(u[hi:])
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return len(u), "spm" if h[3] % 100 < 20 else "psm", len(p), len(m), out


def middle(docs):
    out = fill_middle.fill_in_middle(docs)
    return out.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()


def test_fill_in_middle(spark, docs, corpus):
    text = {r[0]: r[1] for r in corpus}
    got = middle(docs)
    assert len(got) == docs.count()
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle(r.doc_id, text[r.doc_id])
        assert r.back == (text[r.doc_id] or "")


def test_marks_and_seams(spark):
    texts = ["<P>", "a<S>b", "x <M", "<S" * 50, "<" * 200, ">P<" * 40, "P>S>M>" * 30, "<P" * 90 + "é", "\n<\n" * 70, "<\U0001f600>" * 60]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 8)], "doc_id long, text string")
    for r in middle(docs):
        t = texts[r.doc_id % len(texts)]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle(r.doc_id, t) and r.back == t


def test_middle_of_odd_and_no_documents(odd_docs, no_docs):
    got = middle(odd_docs)
    assert sorted((str(r.doc_id), r.back) for r in got) == [("5", ""), ("5", ""), ("6", "alpha beta gamma delta"), ("None", "alpha beta gamma delta")]
    assert middle(no_docs) == []


def test_chunks_do_not_depend_on_what_stands_before():
    rng = random.Random(3)
    shared = bytes(rng.choice(b"abcdefgh \n.") for _ in range(20_000))
    parts = []
    for lead in (b"", b"some words before ", b"x" * 777):
        data = lead + shared
        cuts = fill_middle.chunk_starts(data)
        assert cuts[0] == 0 and cuts[-1] == len(data) and max(b - a for a, b in zip(cuts, cuts[1:], strict=False)) <= fill_middle.LONGEST
        parts.append({data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)})
    assert len(parts[0] & parts[1] & parts[2]) >= len(parts[0]) - 2 > 10
    assert b"".join(data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)) == data


@pytest.mark.parametrize("room", [0, 300, 1 << 20])
def test_units_are_counted_across_chunks(room, monkeypatch):
    """Long letter runs cross many chunks; a memory without room gives the same."""
    monkeypatch.setattr(fill_middle, "LONGEST", 64)
    rng = random.Random(room)
    known = fill_middle.Summaries(room)
    for _ in range(60):
        t = "".join(rng.choice(["a" * rng.randrange(200), " ", "é", "Z", "\U0001f600", "1", "\n"]) for _ in range(rng.randrange(60)))
        units = [m.start() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", t)]
        c = fill_middle.Cutter(t.encode(), known)
        assert c.n == len(units)
        assert [c.begin(k) for k in range(c.n + 1)] == [len(t[:at].encode()) for at in [*units, len(t)]]


def plain_collocations(rows, least=100, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        c = f.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                c.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = {}
    for lang, c in f.items():
        own = {p: a for p, a in c.items() if a >= least and len(p) > 1}
        gone = {q for p, b in own.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if (q := p[i : i + m]) in own and b >= own[q]}
        found = []
        for p, a in own.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out[lang, i] = (p.decode(), -a, left, right, n[lang], -score)
    return out


def mined(docs, **how):
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.mine(docs, **how).collect()}


@pytest.fixture(scope="module")
def phrases():
    """Two languages and none: common and rare words, fixed phrases, repeats of a word, marks, tabs and odd spaces."""
    rng, rows = random.Random(8), []
    word = lambda v: f"w{int(rng.paretovariate(0.7)) % v}"
    fixed = ["Alpha beta gamma", "one two three four five six", "so so so so", "of the Word", "café Été noir", "x y z"]
    for k in range(900):
        t = " ".join(rng.choice(fixed) if rng.random() < 0.2 else word(60) for _ in range(rng.randrange(120)))
        t = re.sub(" (?=w1)", lambda m: rng.choice([" ", "\t", "  ", ". ", ",", "\n", "!? ", "\x0b"]), t)
        rows.append((k, t, ["en", "de", None][k % 3]))
    return [*rows, (7, None, "en"), (8, "", None), (9, " .,\t", "xx"), (10, "a b", "und"), (rows[0])]


def test_collocations(spark, phrases):
    docs = spark.createDataFrame(phrases, "doc_id long, text string, lang string")
    want = plain_collocations([(r[2], r[1]) for r in phrases])
    assert len(want) > 60 and {k[0] for k in want} == {"en", "de", "und"}
    assert mined(docs) == want
    # words joined instead of broadcast, a few phrases in a slice
    assert mined(docs, dictionary=0, size=60, first_share=1.0) == want


def test_first_2000_and_their_ties(spark, phrases, monkeypatch):
    """With fewer places, waves end before the common words are grown; ties at the last place go by the phrase."""
    monkeypatch.setattr(collocations, "TOP", 4)
    docs = spark.createDataFrame(phrases, "doc_id long, text string, lang string")
    grown = []
    plain_grow = collocations.grow
    monkeypatch.setattr(collocations, "grow", lambda e, first, size: grown.append(first.count()) or plain_grow(e, first, size))
    assert mined(docs, first_share=1e-9) == plain_collocations([(r[2], r[1]) for r in phrases], top=4)
    words = Counter((r[2] or "und", w) for r in phrases for w in re.findall("[^\x20\x09]+", re.sub("[.,;:!?\x0a-\x0d]", " ", (r[1] or "").lower())))
    assert len(grown) > 1 and sum(grown) < sum(v >= 100 for v in words.values())


def test_no_collocations(spark, odd_docs, no_docs):
    assert mined(odd_docs) == {} == mined(no_docs)
    with_own = spark.createDataFrame([(1, "a b " * 200, "en", 3, b"x", 1)], "doc_id long, text string, lang string, n int, p binary, id int")
    assert mined(with_own) == plain_collocations([("en", "a b " * 200)])


@pytest.fixture(scope="module")
def bpe():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, bpe, corpus):
    path, plain = bpe
    rng = random.Random(4)
    chars = [*map(chr, range(0x250)), *" 　​﻿́\U0001f600\U0001f1e9漢字かなعربيहिन्दी한글", "<|endoftext|>", "don't", "I'LL", "\r\n", "   ", "zzzz" * 30]
    texts = [t for _, t, *_ in corpus] + ["".join(rng.choices(chars, k=rng.randrange(300))) for _ in range(300)] + ["a" * 5000, " " * 5000, "ab" * 3000 + "é" * 999]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN), path).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = plain.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, bytes(r.ids)) == (len(ids), struct.pack(f"<{len(ids)}I", *ids))
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()


def test_stretches_and_a_full_memory(bpe, monkeypatch):
    path, plain = bpe
    monkeypatch.setattr(byte_bpe, "STRETCH", 7)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    text = "the quick brown fox, l'été  jumps\n\n over 12345 lazy dogs! " * 9
    e = byte_bpe.Encoder(byte_bpe.read_ranks(path), public_tokenizers.PATTERN)
    assert e(text) == struct.pack(f"<{len(plain.encode_ordinary(text))}I", *plain.encode_ordinary(text)) and len(e.known) <= 5 < len(e.old) < 12


def test_bpe_of_odd_and_no_documents(odd_docs, no_docs, bpe):
    out = byte_bpe.decode(byte_bpe.encode(odd_docs, bpe[0], public_tokenizers.PATTERN), bpe[0]).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in out) == [("5", b""), ("5", b""), ("6", b"alpha beta gamma delta"), ("None", b"alpha beta gamma delta")]
    assert byte_bpe.decode(byte_bpe.encode(no_docs, bpe[0], public_tokenizers.PATTERN), bpe[0]).collect() == []


def test_vocabularies_that_cannot_be_serialised():
    full = {bytes((b,)): b for b in range(256)}
    assert byte_bpe.piece_bytes(byte_bpe.serialise(full)) == list(full)
    with pytest.raises(ValueError, match="lacks a byte"):
        byte_bpe.serialise({bytes((b,)): b for b in range(255)})
    with pytest.raises(ValueError, match="0 .. n - 1"):
        byte_bpe.serialise(full | {b"ab": 300})


@pytest.mark.skipif(not os.path.isdir(SF), reason="the supplied tables are not here")
def test_the_registered_queries(spark, bpe):
    text = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op11_fill_in_middle(spark, SF).collect()}
    assert set(got) == set(text)
    for i, r in got.items():
        *want, out = plain_middle(i, text[i].text)
        assert [r.n, r.form, r.prefix_chars, r.middle_chars] == want and (r.output_sha256, r.restored_sha256) == (sha(out.encode()), sha((text[i].text or "").encode()))
    got = {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in queries.op12_collocations(spark, SF).collect()}
    assert got == plain_collocations([(r.lang, r.text) for r in text.values()])
    got = {r.doc_id: r for r in queries.op13_byte_bpe(spark, SF).collect()}
    assert set(got) == set(text)
    for i, r in got.items():
        ids = bpe[1].encode_ordinary(text[i].text or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha((text[i].text or "").encode()))
