import random

from test_text_dedup import plain_components

import corpus_pipeline
from lanewright.llm import similar_texts


def plain_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def changed(rng, text, n):
    w = text.split(" ")
    for i in rng.sample(range(len(w)), n):
        w[i] = f"c{rng.randrange(10**9)}"
    return " ".join(w)


def near_copies():
    """Texts with copies of four or five similarities about 0.8, and a hub whose members are alike to it only."""
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(50_000)}" for _ in range(n))
    out = []
    for size, changes in ((200, (2, 3, 4, 5, 6)), (600, (4, 8, 12, 14, 20))):
        for _ in range(25):
            base = text(size)
            out += [base, *(changed(rng, base, n) for n in changes)]
    hub = text(300)
    out += [hub, *(changed(rng, hub, 4) for _ in range(40)), None, "", " \n", "One two", "one  TWO", "one two three"]
    return out


def groups_by_all_pairs(texts):
    s = [plain_set(t) for t in texts]
    pairs = [(i, j) for i in range(len(s)) for j in range(i + 1, len(s)) if (not s[i] and not s[j]) or (s[i] and 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j]))]
    return plain_components(range(len(s)), pairs), len(pairs)


def test_stage_against_all_pairs(spark):
    texts = near_copies()
    want, n = groups_by_all_pairs(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = dict(corpus_pipeline.STAGES)["simhash"](spark, docs, "")
    assert n > 200 and sorted(r.doc_id for r in out.collect()) == sorted(set(want.values()))


def test_blocks_and_hubs_lose_no_pair(spark, monkeypatch):
    texts = near_copies()
    real = similar_texts.dealt_buckets
    monkeypatch.setattr(similar_texts, "dealt_buckets", lambda rows, keys, id_col: real(rows, keys, id_col, block_rows=2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in similar_texts.similar_groups(docs).collect():
        got.setdefault(r.component, set()).add(r.doc_id)
    want = {}
    for i, c in groups_by_all_pairs(texts)[0].items():
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_each_row_is_judged_by_its_own_text(spark):
    a, b = "alpha beta gamma delta epsilon zeta", "one two three four five six"
    rows = [(1, a), (5, a), (5, b), (5, b), (None, b), (None, "other words"), (None, None), (7, "")]
    out = similar_texts.drop_similar(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [(1, a), (5, b), (None, "other words"), (7, "")]))
    assert similar_texts.drop_similar(out.limit(0)).isEmpty()


def test_first_candidates_are_those_of_simhash(spark):
    """Near fingerprints, equal fingerprints of unlike sets (one repeated passage, unlike ends) and a text of its own."""
    passage = " ".join(f"p{i}" for i in range(21))
    texts = [" ".join([passage] * 60 + [f"{end}{i}" for i in range(k)]) for end, k in (("x", 2), ("y", 2), ("x", 30))] + ["another text of its own words entirely", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    described = similar_texts._described(docs)
    fp, cls = [{r.doc_id: r[c] for r in described.collect()} for c in ("fp", "cls")]
    apart = lambda i, j: ((fp[i] ^ fp[j]) & (1 << 64) - 1).bit_count()
    assert all(apart(i, j) <= 4 for i, j in ((0, 1), (0, 2))) and apart(0, 3) > 4
    linked = [(r.a, r.b) for r in similar_texts.fingerprint_pairs(described).collect()]
    found = plain_components([cls[i] for i in range(4)], linked)
    assert len({found[cls[i]] for i in (0, 1, 2)}) == 1 and found[cls[3]] != found[cls[0]]
    want, _ = groups_by_all_pairs(texts)
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash"](spark, docs, "").collect()) == sorted(set(want.values()))
