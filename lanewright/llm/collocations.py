"""Phrase collocations by best-first branch-and-bound growth.

A phrase of 2 to 5 words scores floor(1000 a n / (l r)) at its lowest-scoring cut, where a is its own count, l and r those of
the two parts and n all words of the language. Since r >= a, the cut after the first word bounds every phrase that begins with
a word of count f by floor(1000 n / f), however it goes on: phrases are grown from their first words, the rarest first.

A wave takes the next words of each open language (classes of counts, rarest first, twice the mass of the wave before), and
grows them word by word; a phrase that falls below the least count is not grown, for no longer one can reach it. Scores use
exact counts of all parts. A language is closed when the bound of its next words is below the score of its 2000th phrase, ties
included, and the rest of its words, the common ones that make up most of the text, are never grown.

A phrase goes if a longer candidate around it is as frequent. Such a one exists just when all its occurrences have the same
neighbour on one side, so the least and greatest neighbours on each side are counted along with the phrase; words below the
least count and the ends of pieces are neighbour 0, which is never the same word.

Texts become arrays of word numbers once. A wave's phrases travel to the workers in slices of at most ``SLICE`` phrases of up
to four numbers; a phrase is found by a hash of its numbers and then compared number by number. Counts are combined inside a
task before they are shuffled, so neither common words nor shared passages make large groups. The dictionary is broadcast up
to ``DICTIONARY`` words and joined beyond.

Cases: a null text is empty, a null language is ``und``; repeated rows count as often as they occur; words and pieces of any
length are whole; ties are resolved by count, then by the bytes of the phrase; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lanewright.llm.workers import tidy
from lanewright.scratch import join_checked, materialise

LEAST, LONGEST, TOP = 100, 5, 2000
DICTIONARY, SLICE = 600_000, 1_000_000
#: The first wave's share of a language's words; each further wave doubles it.
FIRST_SHARE = 1 / 16
#: Entries that a task gathers before it combines them, or gives them on.
GATHERED = 1_500_000
#: Bytes of text that are split into words at a time.
STRETCH = 4 << 20

_marks = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
COUNTED = "p binary, n long, lmin int, lmax int, rmin int, rmax int"
RANKED = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def tokens(data: bytes) -> Iterator[list[bytes]]:
    """Words of a text, stretch by stretch; the end of a piece is a line feed, and what is empty is no word."""
    lo = 0
    while lo < len(data):
        hi = lo + STRETCH
        if hi < len(data):
            blank = data.find(b" ", hi)
            hi = len(data) if blank < 0 else blank
        yield data[lo:hi].lower().translate(_marks).replace(b"\n", b" \n ").split(b" ")
        lo = hi


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n) for words and, under a null word, for all of a language's words; counts are still partial."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, c in held.items():
                c.pop(b"", None)
                c.pop(b"\n", None)
                words = [*c, None]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()), pa.array([*c.values(), c.total()], pa.int64())], names=["lang", "word", "n"])
            held.clear()

        for b in batches:
            for lang, text in zip(*b.columns, strict=True):
                c = held.setdefault(lang.as_py(), Counter())
                for words in tokens(text.as_py()):
                    c.update(words)
                if len(c) > GATHERED // 4:
                    yield from out()
        yield from out()

    return texts.mapInArrow(tidy(run), "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame) -> DataFrame:
    """Adds ``id``, 1 .. rows: a row's place in its partition after the partitions before."""
    at = F.monotonically_increasing_id()
    w = materialise(words.withColumns({"part": F.shiftright(at, 33).cast("int"), "at": at.bitwiseAND(F.lit((1 << 33) - 1))}), "words")
    sizes, start, starts = w.groupBy("part").count().orderBy("part").collect(), 1, []
    for s in sizes:  # one row a partition
        starts.append((s.part, start))
        start += s["count"]
    starts = w.sparkSession.createDataFrame(starts, "part int, start long")
    return w.join(F.broadcast(starts), "part").withColumn("id", (F.col("start") + F.col("at")).cast("int")).drop("part", "at", "start")


def encode(texts: DataFrame, words: DataFrame, dictionary: int = DICTIONARY) -> DataFrame:
    """(ids binary) of each text, big-endian: numbers of frequent words, 0 for any other word and for the end of a piece."""
    if words.limit(dictionary + 1).count() <= dictionary:
        t, known = words.select("lang", "word", "id").toArrow(), {}
        for lang, word, i in zip(*(t.column(c).to_pylist() for c in ("lang", "word", "id")), strict=True):
            known.setdefault(lang, {b"": -1})[word] = i
        sent = texts.sparkSession.sparkContext.broadcast(known)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in range(0, b.num_rows, 500):
                    rows = []
                    for lang, text in zip(*b.slice(lo, 500).columns, strict=True):
                        get = sent.value.get(lang.as_py(), {b"": -1}).get
                        ids = [np.fromiter((get(w, 0) for w in ws), np.int32, len(ws)) for ws in tokens(text.as_py())]
                        rows.append(b"".join(x[x >= 0].astype(">i4").tobytes() for x in ids))
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

        return texts.mapInArrow(tidy(run), "ids binary")
    rows = materialise(texts.withColumn("row", F.monotonically_increasing_id()), "collocation-texts")
    plain = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t", "abcdefghijklmnopqrstuvwxyz ")
    parts = F.split(F.regexp_replace(plain, r"[.,;:!?\x0A-\x0D]", " \n "), " ")
    each = rows.select("row", "lang", F.posexplode(parts).alias("pos", "token")).filter("token != ''").withColumn("word", F.col("token").cast("binary"))
    each = each.join(words.select("lang", "word", "id"), ["lang", "word"], "left")
    placed = each.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("id", F.lit(0)).alias("id")))).alias("x"))
    return placed.select(F.unhex(F.array_join(F.transform("x.id", lambda i: F.lpad(F.hex(i), 8, "0")), "")).alias("ids"))


class Phrases:
    """Phrases of one length, to be found in arrays of word numbers."""

    def __init__(self, words: np.ndarray):
        self.m = words.shape[1]
        for self.seed in range(1, 1000, 2):
            h = self.mix([words[:, j] for j in range(self.m)])
            order = np.argsort(h)
            h = h[order]
            if not (h[1:] == h[:-1]).any():  # no two phrases share a hash
                break
        self.h, self.words = h, np.ascontiguousarray(words[order])
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[h >> np.uint64(42)] = True

    def mix(self, columns: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(columns[0]), self.seed, np.uint64)
        for c in columns:
            h ^= c.astype(np.uint64)
            h *= np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        return h * np.uint64(0xD6E8FEB86659FD93)

    def find(self, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions below ``n`` where a phrase stands, and which one."""
        h = self.mix([ids[j : j + n] for j in range(self.m)])
        at = np.flatnonzero(self.maybe[h >> np.uint64(42)])
        k = np.minimum(np.searchsorted(self.h, h[at]), len(self.h) - 1)
        same = np.ones(len(at), bool)
        for j in range(self.m):
            same &= self.words[k, j] == ids[at + j]
        return at[same], k[same]


def combine(rows: list[np.ndarray]) -> np.ndarray:
    """Columns key, n, lmin, lmax, rmin, rmax with equal keys combined."""
    x = np.concatenate(rows, axis=1)
    if not x.shape[1]:
        return x
    x = x[:, np.argsort(x[0], kind="stable")]
    starts = np.flatnonzero(np.append(True, x[0, 1:] != x[0, :-1]))
    fold = [np.add, np.minimum, np.maximum, np.minimum, np.maximum]
    return np.stack([x[0, starts], *(f.reduceat(x[k], starts) for k, f in enumerate(fold, 1))])


def count(encoded: DataFrame, phrases: list[np.ndarray], grow: bool) -> DataFrame:
    """Counts of the phrases, or of those one word longer, with their least and greatest neighbours.

    A phrase is the big-endian bytes of its word numbers.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Phrases(w) for w in sent.value]
        held: list[list[np.ndarray]] = [[] for _ in tables]

        def out(k: int) -> Iterator[pa.RecordBatch]:
            x, t = combine(held[k]), tables[k]
            held[k] = []
            for lo in range(0, x.shape[1], 200_000):
                y = x[:, lo : lo + 200_000]
                p = t.words[y[0] >> 32]
                if grow:
                    p = np.concatenate((p, (y[0] & 0xFFFFFFFF).astype(np.int32)[:, None]), axis=1)
                p = pa.Array.from_buffers(pa.binary(4 * p.shape[1]), len(p), [None, pa.py_buffer(p.astype(">i4").tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([p, pa.array(y[1]), *(pa.array(c.astype(np.int32)) for c in y[2:])], names=["p", "n", "lmin", "lmax", "rmin", "rmax"])

        for b in batches:
            gap = np.zeros(LONGEST + 1, np.int32)
            ids = bytes(4).join(x for x in b.column("ids").to_pylist() if len(x) > 4)  # one word makes no phrase
            ids = np.concatenate((gap[:1], np.frombuffer(ids, ">i4"), gap)).astype(np.int32)
            for lo in range(1, len(ids) - len(gap), 1 << 20):
                n = min(1 << 20, len(ids) - len(gap) - lo)
                seg = ids[lo - 1 : lo + n + len(gap)]
                for k, t in enumerate(tables):
                    at, node = t.find(seg[1:], n)
                    end = at + 1 + t.m
                    if grow:
                        on = seg[end] > 0
                        at, node, end = at[on], node[on], end[on] + 1
                        word = seg[end - 1].astype(np.int64)
                    else:
                        word = 0
                    left, right = seg[at], seg[end]
                    held[k].append(combine([np.stack([node.astype(np.int64) << 32 | word, np.ones(len(at), np.int64), left, left, right, right])]))
                    if sum(x.shape[1] for x in held[k]) > GATHERED:
                        held[k] = [combine(held[k])]
                        if held[k][0].shape[1] > GATHERED // 2:
                            yield from out(k)
        for k in range(len(tables)):
            if held[k]:
                yield from out(k)

    parts = encoded.mapInArrow(tidy(run), COUNTED)
    return parts.groupBy("p").agg(F.sum("n").alias("n"), F.min("lmin").alias("lmin"), F.max("lmax").alias("lmax"), F.min("rmin").alias("rmin"), F.max("rmax").alias("rmax"))


def in_slices(phrases: DataFrame, size: int = SLICE) -> Iterator[list[np.ndarray]]:
    """Phrases (p) as matrices, one a length, ``size`` phrases at a time."""
    parts = -(-phrases.count() // size)
    for k in range(parts):
        part = phrases if parts == 1 else phrases.filter(F.pmod(F.xxhash64("p"), F.lit(parts)) == k)
        by: dict[int, list[bytes]] = {}
        for p in part.select("p").toArrow().column("p").to_pylist():
            by.setdefault(len(p), []).append(p)
        if by:
            yield [np.frombuffer(b"".join(ps), ">i4").astype(np.int32).reshape(-1, m // 4) for m, ps in sorted(by.items())]


def part_of(p: str, word: int | Column, words: int | Column | None = None) -> Column:
    """Words of a phrase from the given one (0 is the first) on, ``words`` of them or all."""
    start = (F.lit(word) if isinstance(word, int) else word) * 4 + 1
    return F.substring(p, start, F.lit(4 * LONGEST) if words is None else (F.lit(words) if isinstance(words, int) else words) * 4)


def id_of(p: Column) -> Column:
    return F.conv(F.hex(p), 16, 10).cast("int")


def grow(encoded: DataFrame, first: DataFrame, size: int = SLICE) -> list[DataFrame]:
    """The phrases of the least count and more that begin with a phrase of ``first``, a table for each number of words."""
    levels, now = [], first
    for m in range(2, LONGEST + 1):
        found = [count(encoded, s, grow=True).filter(F.col("n") >= LEAST) for s in in_slices(now, size)]
        if not found:
            break
        now = found[0]
        for f in found[1:]:  # slices grow different phrases
            now = now.unionByName(f)
        now = materialise(now, f"phrases-{m}")
        levels.append(now)
    return levels


def scored(encoded: DataFrame, words: DataFrame, totals: DataFrame, levels: list[DataFrame], floor: DataFrame, size: int = SLICE) -> DataFrame:
    """(lang, p, a, l, r, n, score) of grown phrases that no candidate around them equals, if their bound reaches ``floor``."""
    every = levels[0]
    for x in levels[1:]:
        every = every.unionByName(x)
    m = F.length("p") / 4
    shut = ((F.col("lmin") == F.col("lmax")) & (F.col("lmin") > 0)) | ((F.col("rmin") == F.col("rmax")) & (F.col("rmin") > 0))
    own = every.filter((m == LONGEST) | ~shut).select("p", F.col("n").alias("a"), m.cast("int").alias("m"))
    own = own.withColumns({"first": id_of(part_of("p", 0, 1)), "last": id_of(part_of("p", F.col("m") - 1))})
    own = join_checked(own, words.select("lang", F.col("id").alias("first"), F.col("n").alias("f")), "first")
    own = join_checked(own, words.select(F.col("id").alias("last"), F.col("n").alias("g")), "last")
    own = join_checked(join_checked(own, totals, "lang"), floor, "lang", "left")
    # either end alone bounds the score, since the other part is as frequent as the whole at least
    reach = F.expr("CAST(1000 AS DECIMAL(4, 0)) * CAST(n AS DECIMAL(19, 0)) div CAST(greatest(f, g) AS DECIMAL(19, 0))")
    own = materialise(own.filter(F.col("least").isNull() | (reach >= F.col("least"))).select("lang", "p", "a", "m", "n"), "phrases-open")
    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.withColumns({"head": part_of("p", 0, F.col("k")), "tail": part_of("p", F.col("k"))})
    tails = cuts.filter(F.length("tail") > 4).select(F.col("tail").alias("p")).distinct()
    single = words.select(F.unhex(F.lpad(F.hex("id"), 8, "0")).alias("p"), "n")
    heads = single
    for x in levels:
        heads = heads.unionByName(x.select("p", "n"))
    rests = single
    tails = materialise(tails, "phrase-tails")
    for s in in_slices(tails, size):
        rests = rests.unionByName(count(encoded, s, grow=False).select("p", "n"))
    cuts = cuts.join(heads.select(F.col("p").alias("head"), F.col("n").alias("l")), "head")
    cuts = cuts.join(rests.select(F.col("p").alias("tail"), F.col("n").alias("r")), "tail")
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    cuts = cuts.withColumn("score", F.expr(f"CAST(1000 * {wide('a')} AS DECIMAL(19, 0)) * {wide('n')} div ({wide('l')} * {wide('r')})"))
    return cuts.groupBy("lang", "p").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("x")).select("lang", "p", "x.a", "x.l", "x.r", "x.n", "x.score")


def _counts_of_classes(words: DataFrame) -> dict[str, list[tuple[int, int, int]]]:
    """Of each language its classes (class, least count, mass), rarest first: a word's class is the binary logarithm of its count."""
    out: dict[str, list[tuple[int, int, int]]] = {}
    for r in words.groupBy("lang", _class("n").alias("c")).agg(F.min("n").alias("least"), F.sum("n").alias("mass")).orderBy("lang", "c").collect():
        out.setdefault(r.lang, []).append((r.c, r.least, r.mass))
    return out


def _class(n: str) -> Column:
    return F.length(F.bin(n))


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", first_share: float = FIRST_SHARE, dictionary: int = DICTIONARY, size: int = SLICE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first 2000 phrases."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    counted = materialise(word_counts(texts).filter((F.col("n") >= LEAST) | F.col("word").isNull()), "word-counts")
    totals = counted.filter("word IS NULL").select("lang", "n")
    words = materialise(numbered(counted.filter("word IS NOT NULL")), "words-numbered")
    open_to = _counts_of_classes(words)
    if not open_to:
        return spark.createDataFrame([], RANKED)
    encoded = materialise(encode(texts, words, dictionary), "encoded")
    total = {r.lang: r.n for r in totals.collect()}  # one row a language
    best, floors, share = None, {}, first_share
    while open_to:
        taken = []
        for lang, classes in open_to.items():
            mass = 0
            while classes and (not mass or mass + classes[0][2] <= share * total[lang]):
                c, _, more = classes.pop(0)
                taken.append((lang, c))
                mass += more
        share *= 2
        taken = spark.createDataFrame(taken, "lang string, c int")
        start = words.withColumn("c", _class("n")).join(F.broadcast(taken), ["lang", "c"]).select(F.unhex(F.lpad(F.hex("id"), 8, "0")).alias("p"))
        levels = grow(encoded, start, size)
        if levels:
            floor = spark.createDataFrame(list(floors.items()), "lang string, least long")
            found = scored(encoded, words, totals, levels, floor, size)
            found = found if best is None else best.unionByName(found)
            order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
            best = materialise(found.withColumn("at", F.rank().over(order)).filter(F.col("at") <= TOP).drop("at"), "collocations")
            floors = {r.lang: r.least for r in best.groupBy("lang").agg(F.count("*").alias("k"), F.min("score").alias("least")).filter(F.col("k") >= TOP).collect()}
        open_to = {g: cs for g, cs in open_to.items() if cs and not (g in floors and 1000 * total[g] // cs[0][1] < floors[g])}
    if best is None:
        return spark.createDataFrame([], RANKED)
    each = best.select("lang", "p", F.posexplode(F.transform(F.sequence(F.lit(0), (F.length("p") / 4).cast("int") - 1), lambda k: id_of(part_of("p", k, 1)))).alias("pos", "id"))
    each = join_checked(each, words.select("id", F.col("word").cast("string").alias("word")), "id")
    names = each.groupBy("p").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("x")).select("p", F.array_join("x.word", " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = best.join(names, "p").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= TOP)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
