import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): exact and near copies, shared passages, odd texts."""
    rng = random.Random(5)
    passage = words(rng, 120, 9000)
    texts = [words(rng, rng.randrange(5, 400), 5000) for _ in range(60)]
    texts += [texts[0]] * 5 + [texts[1]] * 2
    for k in (2, 3, 4):
        w = texts[k].split(" ")
        w[len(w) // 2] = "changed"
        texts.append(" ".join(w))
    texts += [f"{words(rng, 50, 5000)} {passage} {words(rng, 40, 5000)}" for _ in range(4)]
    texts += ["same line again and again\n" * 60, None, "", " \t\n", "One Two", "x" * 3000, "é" * 900 + " ß " + "é" * 900, "a\x1cb\x85c   d", words(rng, 30_000)]
    return [(i, t, "en", None if i % 11 == 0 else f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame([*corpus, corpus[7], corpus[7]], DOC)


@pytest.fixture(scope="session")
def odd_docs(spark, corpus):
    """Null ids, a repeated row, and columns whose names clash with the operators' own."""
    return spark.createDataFrame([(None, "alpha beta gamma delta", "en", "a", 1, 9, "z", 1.0), (5, None, None, None, None, 9, "z", 1.0), (5, None, None, None, None, 9, "z", 1.0), (6, "alpha beta gamma delta", "en", "a", 1, 9, "z", 1.0)], DOC + ", size int, fp string, diff double")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC)
