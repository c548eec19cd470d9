import random
from collections import Counter
from math import exp, lgamma, log

import pytest

from lanewright.llm import toxicity


class Plain:
    """The docstring's model by dictionaries, probability by probability."""

    def __init__(self, rows, d=1.0, rho=1e-3, k=100.0):
        self.d = d
        self.pair, self.t, self.o = Counter(), Counter(), Counter()
        for text, toxic in rows:
            w = text.split()
            self.pair.update(set(zip(["", *w], [*w, ""], strict=True)))
            (self.t if toxic else self.o).update(set(w))
        self.follow, self.types, self.cont = Counter(), Counter(), Counter()
        for (v, w), n in self.pair.items():
            self.follow[v] += n
            self.types[v] += 1
            self.cont[w] += 1
        self.pi = sum(self.t.values()) / (sum(self.t.values()) + sum(self.o.values()))
        self.rho, self.k = rho, k
        self.vocabulary = [*self.cont, None]  # None: any unseen word

    def q(self, w):
        t, o, pi = self.t[w], self.o[w], self.pi
        n = t + o
        if w == "" or not n:
            return pi
        beta = lambda a, b: lgamma(a) + lgamma(b) - lgamma(a + b)
        a, b = self.k * pi, self.k * (1 - pi)
        same, apart = exp(beta(t + a, o + b) - beta(a, b)), exp(beta(t + 1, o + 1) - beta(1, 1))
        r = self.rho * apart / (self.rho * apart + (1 - self.rho) * same)
        return pi + (n - self.d) / n * r * ((t + 1) / (n + 2) - pi)

    def shared(self, w, v):
        pc = (self.cont[w] or 1) / (len(self.pair) + 1)
        n = self.follow[v]
        return max(self.pair[v, w] - self.d, 0) / n + self.d * self.types[v] / n * pc if n else pc

    def tilted(self, w, v, c):
        return self.shared(w, v) * (self.q(w) / self.pi if c else (1 - self.q(w)) / (1 - self.pi))

    def p(self, w, v, c):
        return self.tilted(w, v, c) / sum(self.tilted(x, v, c) for x in self.vocabulary)

    def diff(self, text):
        w = [x if x in self.cont else None for x in text.split()]
        return sum(log(self.p(x, v, 1) / self.p(x, v, 0)) for v, x in zip(["", *w], [*w, ""], strict=True)) / (len(w) + 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 90}"
    return [(" ".join("vile" if i % 4 == 0 and rng.random() < 0.1 else word() for _ in range(30)), int(i % 4 == 0)) for i in range(80)]


def test_plain_model_adds_up(rows):
    m = Plain(rows)
    for v in ("", "w1", "w9", "never"):
        for c in (0, 1):
            assert sum(m.p(w, v, c) for w in m.vocabulary) == pytest.approx(1)
        assert sum(m.shared(w, v) for w in m.vocabulary) == pytest.approx(1)


@pytest.mark.parametrize("held", [toxicity.HELD, 50])
def test_differences_against_a_plain_model(spark, rows, held, monkeypatch):
    monkeypatch.setattr(toxicity, "HELD", held)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, toxic int")
    fitted = toxicity.train(docs)
    m = Plain(rows)
    texts = [t for t, _ in rows] + ["", "w1", "never seen words vile w3", "w7 w7 w7 W7"]
    want = {i: m.diff(t.lower()) for i, t in enumerate(texts)}
    assert max(map(abs, want.values())) > 0.01
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for most in (toxicity.MODEL_ROWS, 0):
        got = {r.doc_id: r["diff"] for r in toxicity.with_differences(asked, fitted, model_rows=most).collect()}
        assert got == pytest.approx(want, abs=1e-6)


def test_pieces_do_not_change_the_words(monkeypatch):
    text = "Ab cd  efg-hij kl " * 40
    want = [w for p in toxicity.pieces(text) for w in p]
    monkeypatch.setattr(toxicity, "PIECE", 7)
    assert [w for p in toxicity.pieces(text) for w in p] == want


def test_rows_are_judged_by_their_own_text(spark):
    bad, good = "vile scum vile scum loser " * 8, "a calm note on rivers and their fish in spring " * 4
    train = [(i, f"{bad if i % 3 == 0 else good} n{i}", int(i % 3 == 0)) for i in range(200)]
    labels = spark.createDataFrame([(i, y) for i, _, y in train], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in train] + [(1000, bad, 2.0), (1000, good, 2.0), (None, bad, 2.0), (None, good, 2.0)], "doc_id long, text string, diff double")
    left = [(r.doc_id, r.text) for r in toxicity.drop_toxic(docs, labels).filter("diff = 2").collect()]
    assert sorted(left, key=str) == sorted([(1000, good), (None, good)], key=str)


@pytest.mark.parametrize("marks", [[], [(1, 0)], [(4, 1)], [(1, 0), (4, 1)], [(6, 1), (7, 1)], [(1, None)]])
def test_nothing_goes_without_evidence(spark, odd_docs, marks):
    """No labels, one class, or labels of texts that say nothing: clean, empty and unlabelled documents stay."""
    more = spark.createDataFrame([(1, "calm and clear words", "en", "a", 1, 1, "a", 1.0), (4, "", "en", "a", 1, 1, "a", 1.0), (7, None, "en", "a", 1, 1, "a", 1.0), (9, "unlike any other text here " * 300, "en", "a", 1, 1, "a", 1.0)], odd_docs.schema)
    docs = odd_docs.unionByName(more)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    assert toxicity.drop_toxic(docs, labels).count() == docs.count()


def test_the_toxic_ones_still_go(spark):
    rows = [(i, "fine calm words " * 3 if i % 3 else "vile nasty words " * 3) for i in range(300)]
    docs = spark.createDataFrame([*rows, (900, "never seen before"), (901, ""), (902, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    left = {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()}
    assert left == {i for i in range(300) if i % 3} | {900, 901, 902}
