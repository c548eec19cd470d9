"""Toxicity by class-conditional Kneser-Ney models.

One Kneser-Ney bigram model of all training documents is shared by both classes (n(v, w): documents in which w follows v;
N(v), T(v): sum and number of these over w; cont(w): distinct words before w; S: distinct pairs):

    P(w | v) = (n(v, w) - D) / N(v) + D * T(v) / N(v) * Pc(w),   Pc(w) = cont(w) / (S + 1), 1 / (S + 1) for an unseen word

Each class c has its own counts of an expression only as far as the evidence goes, and rests on the shared counts for the
rest. With t toxic and o other documents that hold the word, n = t + o, and pi the toxic share of all such counts:

    r(w) = posterior of "the classes differ in w" (share uniform) against "they don't" (share Beta(K pi, K (1 - pi)))
    q_t(w) = pi + (n - D) / n * r(w) * ((t + 1) / (n + 2) - pi),   q_o(w) = 1 - q_t(w)

so the discount D of an expression's counts, and all of them while r is small, are backoff counts at the common rate. Then

    P_c(w | v) = P(w | v) * q_c(w) / pi_c / Z_c(v)

where Z_c(v), the same sum over all w, makes each class's distribution after v add up to one. With D = 1 an expression of a
single document is backoff alone, so words of one document, and contexts of which no follower came twice, are like unseen
ones and need no entry in the model. No other expression is left out.

A document's difference is the mean over its words and its end of log P_t - log P_o; its score is a logistic function of
that. An expression counts once in a document, so one that repeats itself does not make its words look toxic. All counts
cover all training documents. Only the two numbers of the logistic function are fitted on a bounded sample (FIT_DOCS in
expectation, by hash). The model is broadcast only when it has at most MODEL_ROWS rows; otherwise it is joined.

Words and contexts are known by 48 bits of their hash.

Cases: null and empty texts consist of their end; a null label does not train; repeated label rows count as often as they
come; ids may repeat or be null: each row is scored, and by ``drop_toxic`` judged, by its own text (null ids don't train);
without training rows of either class every score is the base rate; texts of any length are read in pieces; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lanewright.llm.workers import give_back, tidy
from lanewright.scratch import join_checked, materialise

DISCOUNT = 1.0
#: Prior share of words that tell the classes apart, and how steady the toxic share of all others is (K above).
TELLING, STEADY = 1e-3, 100.0
FIT_DOCS = 20_000
MODEL_ROWS = 2_000_000
#: Entries a task adds up before it passes them on; sums do not depend on it.
HELD = 1 << 20
PIECE = 1 << 20
_word = re.compile(r"\w+")
_gap = re.compile(r"\W")


def word_key(word: str) -> int:
    return xxhash.xxh64_intdigest(word) >> 16


#: Stands before the first and after the last word; no word is empty.
EDGE = word_key("")


def pieces(text: str | None) -> Iterator[list[str]]:
    """The words of a text, in lists of bounded size."""
    low, lo = (text or "").lower(), 0
    while lo < len(low):
        cut = _gap.search(low, lo + PIECE) if lo + PIECE < len(low) else None
        hi = cut.start() if cut else len(low)
        yield _word.findall(low, lo, hi)
        lo = hi


class Numbers(dict):
    """Words to numbers in order of appearance; the edge is 0."""

    def __init__(self):
        super().__init__()
        self.keys_of = [EDGE]

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self.keys_of)
        self.keys_of.append(word_key(word))
        return n

    def of(self, text: str | None) -> np.ndarray:
        parts = [np.fromiter(map(self.__getitem__, w), np.int64, len(w)) for w in pieces(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def in_training(doc_id: str = "doc_id"):
    """Rows that labels may be learned from: crc32 of the id as text, mod 5, is not 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def expression_counts(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (text, toxic) to pairs (w, v, n) and words (w, t, o, follow); follow is N of the word as a context.

    Text by text, each task adds up what fits in bounded memory before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, pairs, words, held = Numbers(), [], [], 0

        def out() -> pa.RecordBatch:
            key = np.array(numbers.keys_of, np.uint64)
            code, n = np.unique(np.concatenate(pairs), return_counts=True)
            v, w = key[code >> 32], key[code & 0xFFFFFFFF]
            per = np.concatenate(words, axis=1)
            own, at = np.unique(per[0], return_inverse=True)
            sums = np.zeros((3, len(own)), np.int64)
            for k in range(3):
                np.add.at(sums[k], at, per[k + 1])
            k = np.concatenate((w << np.uint64(16) | v >> np.uint64(32), key[own] << np.uint64(16)))
            x = np.concatenate(((v & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32), np.zeros(len(own), np.int32)))
            return pa.RecordBatch.from_arrays([
                pa.array(k.view(np.int64)), pa.array(x, mask=np.arange(len(x)) >= len(code)),
                pa.array(np.concatenate((n, sums[0] << 32 | sums[1]))), pa.array(np.concatenate((np.zeros(len(n), np.int64), sums[2]))),
            ], names=["k", "x", "n", "follow"])

        for b in batches:
            for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist(), strict=True):
                at = numbers.of(text.as_py())
                pair = np.unique(np.concatenate(([0], at)) << 32 | np.concatenate((at, [0])))
                left, follow = np.unique(pair >> 32, return_counts=True)  # every word, and the edge, has a follower
                pairs.append(pair)
                words.append(np.stack((left, np.full(len(left), int(toxic)), np.full(len(left), 1 - int(toxic)), follow)))
                held += len(pair) + len(left)
                if held > HELD:
                    yield out()
                    numbers, pairs, words, held = Numbers(), [], [], 0
        if pairs:
            yield out()

    rows = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(tidy(run), "k long, x int, n long, follow long")
    sums = materialise(rows.groupBy("k", "x").agg(F.sum("n").alias("n"), F.sum("follow").alias("follow")), "toxicity-counts")
    w = F.shiftrightunsigned("k", 16).alias("w")
    v = F.shiftleft(F.col("k").bitwiseAND(0xFFFF), 32).bitwiseOR(F.col("x").cast("long").bitwiseAND(0xFFFFFFFF)).alias("v")
    pairs = sums.filter("x IS NOT NULL").select(w, v, "n")
    words = sums.filter("x IS NULL").select(w, F.shiftrightunsigned("n", 32).alias("t"), F.col("n").bitwiseAND(0xFFFFFFFF).alias("o"), "follow")
    return pairs, words


def toxic_shares(t: np.ndarray, o: np.ndarray, pi: float) -> np.ndarray:
    """q_t of words with t toxic and o other documents."""
    lgamma = np.vectorize(math.lgamma, otypes=[float])

    def fit(a: float, b: float) -> np.ndarray:
        return lgamma(t + a) + lgamma(o + b) - lgamma(t + o + a + b) - (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b))

    apart = np.clip(fit(STEADY * pi, STEADY * (1 - pi)) - fit(1.0, 1.0), -700, 700)
    r = 1 / (1 + np.exp(apart) * (1 - TELLING) / TELLING)
    n = t + o
    return pi + np.maximum(n - DISCOUNT, 0) / n * r * ((t + 1) / (n + 2) - pi)


def train(labelled: DataFrame) -> tuple[DataFrame, float, float]:
    """Rows (w, weight), and two numbers: a document's log-likelihood ratio is the sum of its words' weights, plus the first
    number, plus the second for each word."""
    spark = labelled.sparkSession
    pairs, words = expression_counts(labelled)
    s = words.filter(F.col("w") != EDGE).agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    if not s.t or not s.o:
        return spark.createDataFrame([], "w long, weight float"), 0.0, 0.0
    pi = s.t / (s.t + s.o)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t, o = (b.column(c).to_numpy().astype(float) for c in ("t", "o"))
            q = toxic_shares(t, o, pi)
            yield pa.RecordBatch.from_arrays([b.column("w"), pa.array(q / pi - 1), pa.array((1 - q) / (1 - pi) - 1)], names=["w", "dt", "do"])

    # tilts less one, of the words that have any
    tilts = words.filter((F.col("w") != EDGE) & (F.col("t") + F.col("o") > DISCOUNT)).select("w", "t", "o").mapInArrow(tidy(run), "w long, dt double, do double")
    tilts = materialise(tilts, "toxicity-tilts")
    cont = pairs.groupBy("w").agg(F.count("*").alias("cont"))
    z = join_checked(cont, tilts, "w", "left").agg(F.sum(F.col("cont") * F.col("dt")), F.sum(F.col("cont") * F.col("do")), F.sum("cont")).first()
    seen = z[2] + 1
    zt, zo = 1 + (z[0] or 0.0) / seen, 1 + (z[1] or 0.0) / seen  # Z_c of a context without repeated followers

    again = pairs.filter(F.col("n") > DISCOUNT).withColumn("m", F.col("n") - F.lit(DISCOUNT))
    per = join_checked(again, tilts, "w", "left").groupBy("v").agg(
        F.sum("m").alias("m"), F.sum(F.col("m") * F.coalesce("dt", F.lit(0.0))).alias("st"), F.sum(F.col("m") * F.coalesce("do", F.lit(0.0))).alias("so")
    )
    per = per.join(words.select(F.col("w").alias("v"), "follow"), "v")
    back = 1 - F.col("m") / F.col("follow")  # D * T(v) / N(v)

    def log_z(own: str, z0: float):
        return F.log(1 + F.col(own) / F.col("follow") + back * F.lit(z0 - 1))

    contexts = per.select(F.col("v").alias("w"), (log_z("st", zt) - log_z("so", zo)).alias("z"))
    contexts = materialise(contexts, "toxicity-contexts")
    z0 = math.log(zt) - math.log(zo)
    first = contexts.filter(F.col("w") == EDGE).first()
    own = tilts.select("w", (F.log1p("dt") - F.log1p("do")).alias("l"))
    both = own.join(contexts.filter(F.col("w") != EDGE), "w", "full_outer")
    model = both.select("w", (F.coalesce("l", F.lit(0.0)) - F.coalesce(F.col("z") - z0, F.lit(0.0))).cast("float").alias("weight"))
    return materialise(model, "toxicity-model"), -(first.z if first else z0), -z0


def with_differences(docs: DataFrame, fitted: tuple[DataFrame, float, float], name: str = "diff", model_rows: int = MODEL_ROWS) -> DataFrame:
    """All rows and columns of docs (text among them), and the length-normalised difference of the log-likelihoods."""
    model, first, each = fitted
    if model.limit(model_rows + 1).count() > model_rows:
        return _differences_joined(docs, fitted, name)
    table = model.toArrow()
    order = np.argsort(table.column("w").to_numpy())
    sent = docs.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy()[order] for c in ("w", "weight")))
    del table
    give_back()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights = sent.value
        keys = keys.view(np.uint64)
        numbers, weight = Numbers(), np.zeros(1)
        for b in batches:
            diff = np.empty(b.num_rows)
            for i, text in enumerate(b.column("text")):
                at = numbers.of(text.as_py())
                if len(numbers.keys_of) > len(weight):
                    new = np.array(numbers.keys_of[len(weight) :], np.uint64)
                    spot = np.minimum(np.searchsorted(keys, new), max(len(keys) - 1, 0))
                    found = np.where(keys[spot] == new, weights[spot], 0.0) if len(keys) else np.zeros(len(new))
                    weight = np.concatenate((weight, found))
                diff[i] = (weight[at].sum() + first + each * len(at)) / (len(at) + 1)
                if len(weight) > HELD // 4:
                    numbers, weight = Numbers(), np.zeros(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(diff)], names=[*b.schema.names, name])

    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def _differences_joined(docs: DataFrame, fitted: tuple[DataFrame, float, float], name: str) -> DataFrame:
    """The same for a model of any size: word counts per document meet the model in a shuffled join."""
    model, first, each = fitted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uid, text in zip(b.column("_uid"), b.column("text"), strict=True):
                n = Counter()
                for part in pieces(text.as_py()):
                    n.update(part)
                total = sum(n.values())
                yield pa.RecordBatch.from_arrays([
                    pa.array([uid.as_py()] * (len(n) + 1), pa.int64()), pa.array([EDGE, *map(word_key, n)], pa.int64()),
                    pa.array([(first + each * total) / (total + 1), *(x / (total + 1) for x in n.values())], pa.float64()),
                ], names=["_uid", "w", "part"])

    docs = materialise(docs.withColumn("_uid", F.monotonically_increasing_id()), "toxicity-docs")
    parts = docs.select("_uid", "text").mapInArrow(tidy(run), "_uid long, w long, part double")
    hit = parts.join(model, "w", "left")
    value = F.when(F.col("w") == EDGE, F.col("part")).otherwise(F.col("part") * F.coalesce("weight", F.lit(0.0)))
    sums = hit.groupBy("_uid").agg(F.sum(value).alias("_sum"))
    return docs.join(sums, "_uid").withColumn(name, F.col("_sum")).drop("_uid", "_sum")


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> tuple[float, float, float]:
    """(a, b, scale) of 1 / (1 + exp(-(a * x / scale + b))); Newton steps on a slightly smoothed target."""
    if not len(x) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.25
        return 0.0, math.log(rate / (1 - rate)), 1.0
    scale = float(np.abs(x).max()) or 1.0
    z = np.column_stack((x / scale, np.ones(len(x))))
    beta = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (y - p) - ridge * beta
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(2), grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1]), scale


def fit(docs: DataFrame, labels: DataFrame) -> tuple[tuple[DataFrame, float, float], float, float]:
    """The model of docs and labels, with slope and offset of the logistic function; the slope is 0 where a class has no rows."""
    marks = labels.filter(F.col("toxic").isNotNull() & in_training()).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = materialise(marks, "toxicity-labels")
    train_on = join_checked(docs.select("doc_id", "text").filter(in_training()), marks, F.col("doc_id") == F.col("_id"), rows=2_000_000)
    train_on = train_on.select("doc_id", "text", "toxic")
    fitted = train(train_on)
    some = train_on.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(max(marks.count(), 1))) < FIT_DOCS)
    sample = with_differences(some, fitted).select("diff", "toxic").toPandas()
    a, b, scale = fit_logistic(sample["diff"].to_numpy(float), sample["toxic"].to_numpy(float))
    return fitted, a / scale, b


def score_of(diff: Column, slope: float, offset: float) -> Column:
    return 1 / (1 + F.exp(-(F.lit(slope) * diff + F.lit(offset))))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for every row of docs."""
    fitted, slope, offset = fit(docs, labels)
    out = with_differences(docs.select("doc_id", "text"), fitted, "score").withColumn("score", score_of(F.col("score"), slope, offset))
    out = out.select("doc_id", F.coalesce(~in_training(), F.lit(False)).alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents predicted toxic go, each by its own text; all columns stay.

    A text goes only on evidence of its own: its difference must be above that of a text of any length whose words the model
    doesn't know. Where a class has no training rows, or differences don't rise with toxicity, all documents stay.
    """
    fitted, slope, offset = fit(docs, labels)
    if slope <= 0:
        return docs
    unknown = max(fitted[1], fitted[2])  # such a text's difference lies between these two
    found = with_differences(docs, fitted, "_toxicity")
    toxic = (score_of(F.col("_toxicity"), slope, offset) >= 0.5) & (F.col("_toxicity") > unknown + 1e-12)
    return found.filter(~toxic).select(*docs.columns)
