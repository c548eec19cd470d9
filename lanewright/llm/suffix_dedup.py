"""Removal of byte strings that repeat anywhere in a corpus, by blockwise suffix sorting with a difference cover.

Two suffixes matter to each other only if they agree in their first ``length`` bytes. Suffixes are sorted to that depth,
one suffix bucket at a time, and only those that can tie at all are sorted:

1. *Cover sample.* Positions of a document that fall on a difference cover modulo a period are sampled. For any two suffixes
   some offset below the period puts both on the cover, so two suffixes that agree in ``length`` bytes have two sampled
   suffixes that agree in ``length - period + 1`` bytes. The sampled suffixes are sorted to that depth, bucket by bucket;
   those that stand alone have a rank of their own, the others share one.
2. *Long ties.* A suffix none of whose cover positions shares its rank is settled: it ties with nothing. The rest are the
   candidates; they are sorted to full depth, again one bucket at a time, and neighbours that agree are repeats.
3. *Bytes.* Suffixes are ordered by a 64-bit key of their bytes to the given depth, so a bucket is a bounded, even share of
   the keys, and a tie of keys is no proof. Ties come in runs of neighbouring positions; the first and the last string of a
   run and one every ``length`` bytes between cover all that the run would remove. Each of them is sent to the block of its
   neighbour in the sorted order and compared there byte by byte. Keys that stand for unlike bytes are contested: all their
   strings are grouped by their bytes, the false ties are undone, and the runs are compared again.
4. Every byte under a repeat goes.

A block of documents sends each key once, however often it occurs there, so a line that fills a document or stands in every
document is one entry per block, and a block is asked about a key by its two neighbours at most. Texts travel once, in
compressed blocks; a bucket's answer is one bit per key, and the neighbour's block for those that tie.

Equal texts (by SHA-256) are one text here: with two copies or more and ``length`` bytes every byte of each is a repeat.

Cases: a null text is empty; a text shorter than ``length`` keeps everything; repeated rows are documents of their own and
so repeat each other; null ids are kept; ties do not arise; an empty table gives an empty result; columns other than
the named ones are not read by ``repeated_bytes``.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cache, reduce
from itertools import product

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.workers import tidy
from lanewright.scratch import join_checked, materialise, scratch_path

LENGTH = 400
#: Bytes that 50 words take at least, at three letters and a blank each.
PASSAGE = 200
#: Covers: q + 1 positions of q * q + q + 1, one for every difference.
FIELDS = (17, 13, 11, 7, 5, 3, 2)
BLOCK_BYTES = 2 << 20
#: Text per file of blocks, and per suffix bucket.
FILE_BYTES = 16 << 20
BUCKET_BYTES = 16 << 20
#: Answers up to this size are broadcast; larger ones are joined by shuffle.
ANSWER_BYTES = 8 << 20
STRETCH = 1 << 19
#: Strings that a block sends for comparison at a time.
ASKED = 1 << 14
#: Contested keys that are broadcast at a time.
CONTESTED = 1 << 20
#: A text with more than one in so many rows is hot, so there are fewer hot texts than that.
HOT = 10_000
EMPTY = hashlib.sha256(b"").hexdigest()


def field_for(length: int) -> int:
    """The widest cover that leaves sampled strings a fifth of the length, and 32 bytes at least."""
    for q in FIELDS:
        if length - q * q - q >= max(32, length // 5):
            return q
    raise ValueError("strings must have at least 38 bytes")


@cache
def difference_cover(q: int) -> tuple[int, ...]:
    """A set of q + 1 residues modulo q*q+q+1 whose differences are all residues (q prime).

    In the field of q**3 elements, the powers of a generator that lie in a plane over the small field form such a set.
    """
    v = q * q + q + 1
    for a, b, c in product(range(1, q), range(q), range(q)):  # x^3 = a + b x + c x^2
        x, found = (1, 0, 0), []
        for i in range(v):
            if x[2] == 0:
                found.append(i)
            x = (a * x[2] % q, (x[0] + b * x[2]) % q, (x[1] + c * x[2]) % q)
        if len(found) == q + 1 and len({(i - j) % v for i in found for j in found}) == v:
            return tuple(found)
    raise ValueError("no cover found")


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    values = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    up, down = (np.cumprod(np.full(n, x, np.uint64)) for x in (base, pow(base, -1, 1 << 64)))
    return values, up, down


def window_keys(a: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit keys of the strings of ``length`` bytes that start at the (ascending) positions ``at``."""
    values, up, down = _powers(STRETCH + length)
    out = np.empty(len(at), np.uint64)
    cuts = np.searchsorted(at, np.arange(0, len(a) + STRETCH, STRETCH))
    for k in range(len(cuts) - 1):
        if cuts[k] == cuts[k + 1]:
            continue
        lo = k * STRETCH
        part = values[a[lo : lo + STRETCH + length]]
        part *= up[: len(part)]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=total[1:])
        i = at[cuts[k] : cuts[k + 1]] - lo
        h = (total[i + length] - total[i]) * down[i]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out[cuts[k] : cuts[k + 1]] = h ^ (h >> np.uint64(32))
    return out


class Block:
    """Some documents' bytes, end to end; strings never cross from one to the next."""

    def __init__(self, body: bytes, sizes: np.ndarray, length: int):
        self.a, self.length = np.frombuffer(body, np.uint8), length
        self.stop = np.cumsum(sizes)
        self.start = self.stop - sizes
        self.sizes = sizes

    def sample(self, period: int, cover: tuple[int, ...]) -> np.ndarray:
        """Cover positions whose string of length - period + 1 bytes lies in the document."""
        depth = self.length - period + 1
        reach = np.maximum(self.sizes - depth + 1, 0) * (self.sizes >= self.length)
        on = np.zeros(period, bool)
        on[list(cover)] = True
        longest = int(reach.max(initial=0))
        pattern = np.flatnonzero(np.resize(on, longest))
        counts = np.searchsorted(pattern, reach)
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return pattern[nth] + np.repeat(self.start, counts)

    def candidates(self, ranked: np.ndarray, period: int) -> np.ndarray:
        """Starts of full-length strings with a position of ``ranked`` less than ``period`` on."""
        doc = np.searchsorted(self.stop, ranked, side="right")
        change = np.zeros(len(self.a) + 1, np.int32)
        np.add.at(change, np.maximum(ranked - period + 1, self.start[doc]), 1)
        np.add.at(change, ranked + 1, -1)
        maybe = np.cumsum(change[:-1], dtype=np.int32) > 0
        for lo, hi in zip(np.maximum(self.stop - self.length + 1, self.start).tolist(), self.stop.tolist(), strict=True):
            maybe[lo:hi] = False
        return np.flatnonzero(maybe)

    def covered(self, repeats: np.ndarray) -> np.ndarray:
        change = np.zeros(len(self.a) + 1, np.int32)
        change[repeats] += 1
        change[repeats + self.length] -= 1
        return np.cumsum(change[:-1], dtype=np.int32) > 0


def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Ends of the buckets' stretches in ascending keys."""
    return np.searchsorted((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets), side="right")


def narrowed(keys: np.ndarray, width: int) -> np.ndarray:
    """Keys of which only the first ``width`` bytes count."""
    low = np.uint64(8 * (8 - width))
    return keys >> low << low


def _sent(block: int, keys: np.ndarray, buckets: int, width: int = 8) -> pa.RecordBatch:
    keys = np.unique(keys)
    ends = _buckets(keys, buckets)
    begin = np.concatenate(([0], ends[:-1]))
    full = np.flatnonzero(ends > begin)
    return pa.RecordBatch.from_arrays([
        pa.array(full.astype(np.int32)), pa.array(np.full(len(full), block, np.int64)),
        pa.array([keys[begin[b] : ends[b]].astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes() for b in full], pa.binary()),
    ], names=["bucket", "block", "keys"])


class Ties:
    """A block's keys, each once and in order, which of them occur again, and a block where they do (-1: only this one)."""

    def __init__(self, keys: np.ndarray, buckets: int, answers: list[dict] | None):
        self.own, self.where, count = np.unique(keys, return_inverse=True, return_counts=True)
        self.tied, self.partner = count > 1, np.full(len(self.own), -1, np.int64)
        ends = _buckets(self.own, buckets)
        for x in answers or ():
            lo, hi = (ends[x["bucket"] - 1] if x["bucket"] else 0), ends[x["bucket"]]
            again = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=hi - lo).astype(bool)
            self.tied[lo:hi] |= again
            if x["partners"]:
                self.partner[lo:hi][again] = _opened_ids(x["partners"])


def _packed_ids(ids: np.ndarray) -> bytes:
    few, at = np.unique(ids, return_inverse=True)
    at = at.astype(np.uint16 if len(few) < 1 << 16 else np.uint32)
    return zstandard.ZstdCompressor(level=1).compress(np.int64(len(few)).tobytes() + few.tobytes() + at.tobytes())


def _opened_ids(packed: bytes) -> np.ndarray:
    body = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    few = np.frombuffer(body, np.int64, n, 8)
    return few[np.frombuffer(body, np.uint16 if n < 1 << 16 else np.uint32, offset=8 + 8 * n)]


def sort_buckets(sent: DataFrame, width: int = 8, partners: bool = False) -> DataFrame:
    """Rows (bucket, block, keys) to (block, answers): which keys of a block occur in another one, and where if asked.

    A task goes through its buckets one at a time: a bucket's keys are gathered, sorted and compared with their
    neighbours; then its memory is given back.
    """

    def answer(bucket: int, blocks: list[int], keys: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        same = ranked[1:] == ranked[:-1]
        tied = np.zeros(len(every), bool)
        tied[order[1:][same]] = True
        tied[order[:-1][same]] = True
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        parts = np.split(tied, cuts)
        some = [i for i, p in enumerate(parts) if p.any()]
        where = [b""] * len(some)
        if partners:
            home = np.repeat(np.array(blocks, np.int64), [len(k) for k in keys])
            other = np.full(len(every), -1, np.int64)
            other[order[:-1][same]] = home[order[1:][same]]
            other[order[1:][same]] = home[order[:-1][same]]
            others = np.split(other, cuts)
            where = [_packed_ids(others[i][parts[i]]) for i in some]
        return pa.RecordBatch.from_arrays([
            pa.array([blocks[i] for i in some], pa.int64()), pa.array(np.full(len(some), bucket, np.int32)),
            pa.array([np.packbits(parts[i]).tobytes() for i in some], pa.binary()), pa.array(where, pa.binary()),
        ], names=["block", "bucket", "bits", "partners"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks, keys = None, [], []
        for b in batches:
            for bucket, block, k in zip(b.column("bucket").to_pylist(), b.column("block").to_pylist(), b.column("keys"), strict=True):
                if bucket != now and blocks:
                    yield answer(now, blocks, keys)
                    blocks, keys = [], []
                now = bucket
                blocks.append(block)
                few = np.frombuffer(k.as_py(), np.uint8).reshape(-1, width)
                keys.append(np.concatenate((few, np.zeros((len(few), 8 - width), np.uint8)), axis=1).view(">u8").ravel().astype(np.uint64))
        if blocks:
            yield answer(now, blocks, keys)

    bits = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(run), "block long, bucket int, bits binary, partners binary")
    return bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits", "partners")).alias("answers"))


def bucketed(df: DataFrame, key: str, files: int, label: str) -> DataFrame:
    """``df`` as a table in the shared folder that is dealt by ``key`` once; joins on the key then move the other side only."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    name = path.rpartition("/")[2].replace("-", "_")
    df.repartition(files, key).write.option("path", path).option("compression", "none").bucketBy(files, key).saveAsTable(name)
    return spark.table(name)


def _with_answers(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    answers = answers.withColumnRenamed("answers", name)
    size = answers.agg(F.sum(F.aggregate(name, F.lit(0).cast("long"), lambda n, x: n + F.length(x["bits"]) + F.length(x["partners"]) + 16))).first()[0] or 0
    return blocks.join(F.broadcast(answers) if size <= ANSWER_BYTES else answers, "block", "left")


def repeated_texts(texts: DataFrame, total_bytes: int, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """Rows (h, body), h a hash of the text, to (h, n_removed, n_spans, kept_sha256, kept) for texts that lose bytes.

    ``kept``, the text that is left, is null unless asked for.
    """
    q = field_for(length)
    period, cover = q * q + q + 1, difference_cover(q)
    depth = length - period + 1
    buckets = int(max(8, total_bytes // BUCKET_BYTES))
    # a false tie of sampled strings only makes candidates, so their keys are as wide as one in 4,096 of them needs
    width = min(8, -(-(total_bytes.bit_length() + 8) // 8))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, hashes, bodies, held = TaskContext.get().partitionId(), 0, [], [], 0
        pack = zstandard.ZstdCompressor(level=1)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([task << 32 | n], pa.int64()), pa.array([hashes], pa.list_(pa.string())),
                pa.array([[len(x) for x in bodies]], pa.list_(pa.int64())), pa.array([pack.compress(b"".join(bodies))], pa.binary()),
            ], names=["block", "hashes", "sizes", "body"])

        for b in batches:
            for h, body in zip(b.column("h").to_pylist(), b.column("body"), strict=True):
                hashes.append(h)
                bodies.append(body.as_py())
                held += len(bodies[-1])
                if held >= BLOCK_BYTES:
                    yield out()
                    n, hashes, bodies, held = n + 1, [], [], 0
        if hashes:
            yield out()

    def opened(b: pa.RecordBatch, i: int) -> Block:
        body = zstandard.ZstdDecompressor().decompress(b.column("body")[i].as_py())
        return Block(body, np.array(b.column("sizes")[i].as_py(), np.int64), length)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, block in enumerate(b.column("block").to_pylist()):
                x = opened(b, i)
                yield _sent(block, narrowed(window_keys(x.a, x.sample(period, cover), depth), width), buckets, width)

    def tying(x: Block, answers) -> np.ndarray:
        at = x.sample(period, cover)
        ties = Ties(narrowed(window_keys(x.a, at, depth), width), buckets, answers)
        return x.candidates(at[ties.tied[ties.where]], period)

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, block in enumerate(b.column("block").to_pylist()):
                x = opened(b, i)
                yield _sent(block, window_keys(x.a, tying(x, b.column("ranks")[i].as_py()), length), buckets)

    def repeats(b: pa.RecordBatch, i: int) -> tuple[Block, np.ndarray, np.ndarray, Ties]:
        """A block, its candidates and which of them repeat, less what is known to be a false tie."""
        x = opened(b, i)
        at = tying(x, b.column("ranks")[i].as_py())
        ties = Ties(window_keys(x.a, at, length), buckets, b.column("repeats")[i].as_py())
        again = ties.tied[ties.where]
        if "untied" in b.schema.names:
            for u in b.column("untied")[i].as_py() or ():
                for k in np.flatnonzero(ties.where == np.searchsorted(ties.own, np.int64(u["key"]).view(np.uint64))):
                    again[k] &= x.a[at[k] : at[k] + length].tobytes() != u["body"]
        return x, at, again, ties

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, block in enumerate(b.column("block").to_pylist()):
                x, at, again, ties = repeats(b, i)
                t = at[again]
                if not len(t):
                    continue
                first = np.flatnonzero(np.concatenate(([True], np.diff(t) > 1)))
                last = np.append(first[1:], len(t)) - 1
                some = np.unique(np.concatenate([last, *(np.arange(f, k + 1, length) for f, k in zip(first, last, strict=True))]))
                for lo in range(0, len(some), ASKED):
                    part = some[lo : lo + ASKED]
                    body = x.a[t[part][:, None] + np.arange(length)]
                    _, one = np.unique(body.view(f"V{length}").ravel(), return_index=True)
                    part, body = ties.where[again][part][one], body[one]
                    to = np.where(ties.partner[part] < 0, block, ties.partner[part])
                    order = np.argsort(to, kind="stable")
                    for k in np.split(order, np.flatnonzero(np.diff(to[order])) + 1):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([int(to[k[0]])], pa.int64()), pa.array([int(to[k[0]]) == block]), pa.array([ties.own[part[k]].tobytes()], pa.binary()),
                            pa.array([zstandard.ZstdCompressor(level=1).compress(body[k].tobytes())], pa.binary()),
                        ], names=["block", "own", "keys", "bodies"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                asks = b.column("asks")[i].as_py()
                if not asks:
                    continue
                x, at, _, ties = repeats(b, i)
                order = np.argsort(ties.where, kind="stable")
                begin = np.searchsorted(ties.where[order], np.arange(len(ties.own) + 1))
                no = []
                for ask in asks:
                    keys = np.frombuffer(ask["keys"], np.uint64)
                    bodies = np.frombuffer(zstandard.ZstdDecompressor().decompress(ask["bodies"]), np.uint8).reshape(-1, length)
                    k = np.searchsorted(ties.own, keys)
                    # a string of this block itself must be here twice
                    for nth in range(1 + ask["own"]):
                        there = at[order[np.minimum(begin[k] + nth, len(order) - 1)]]
                        same = (begin[k] + nth < begin[k + 1]) & (x.a[there[:, None] + np.arange(length)] == bodies).all(axis=1)
                        no.append(keys[~same])
                no = np.unique(np.concatenate(no))
                if len(no):
                    yield pa.RecordBatch.from_arrays([pa.array(no.view(np.int64))], names=["key"])

    def strings_of(keys: np.ndarray):
        """All strings of contested keys: (block, key, body, n), a string once for each block."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, block in enumerate(b.column("block").to_pylist()):
                    x, at, _, ties = repeats(b, i)
                    found = Counter((int(ties.own[ties.where[k]].view(np.int64)), x.a[at[k] : at[k] + length].tobytes()) for k in np.flatnonzero(np.isin(ties.own, keys)[ties.where]))
                    for (key, body), n in found.items():
                        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([key], pa.int64()), pa.array([body], pa.binary()), pa.array([n], pa.int64())], names=["block", "key", "body", "n"])

        return tidy(run)

    def settled(tied: DataFrame) -> DataFrame:
        """``tied`` with the false ties of each block in ``untied``; the same frame where no keys are contested."""
        done = false = None
        while True:
            asks = tied.mapInArrow(tidy(asked), "block long, own boolean, keys binary, bodies binary")
            asks = materialise(asks.groupBy("block").agg(F.collect_list(F.struct("own", "keys", "bodies")).alias("asks")), "suffix-asks")
            contested = tied.join(asks, "block").mapInArrow(tidy(compared), "key long").distinct()
            if done is not None:
                contested = contested.join(done, "key", "left_anti")
            contested = materialise(contested, "suffix-contested")
            slices = -(-contested.count() // CONTESTED)
            if not slices:
                return tied
            parts = []
            for k in range(slices):
                keys = contested.filter(F.pmod(F.xxhash64("key"), F.lit(slices)) == k).toPandas()["key"].to_numpy(np.int64).view(np.uint64)
                parts.append(tied.mapInArrow(strings_of(keys), "block long, key long, body binary, n long"))
            strings = materialise(reduce(DataFrame.unionByName, parts), "suffix-strings")
            real = strings.groupBy("key", "body").agg(F.sum("n").alias("all")).filter("all > 1")
            new = strings.join(real, ["key", "body"], "left_anti").select("block", "key", "body")
            done, false = (contested, new) if done is None else (done.unionByName(contested), false.unionByName(new))
            untied = materialise(false.groupBy("block").agg(F.collect_list(F.struct("key", "body")).alias("untied")), "suffix-untied")
            tied = tied.drop("untied").join(untied, "block", "left")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x, at, again, _ = repeats(b, i)
                gone = x.covered(at[again])
                upto = np.concatenate(([0], np.cumsum(gone)))
                n_gone = upto[x.stop] - upto[x.start]
                hashes, rows = b.column("hashes")[i].as_py(), []
                for k in np.flatnonzero(n_gone):
                    g = gone[x.start[k] : x.stop[k]]
                    kept = x.a[x.start[k] : x.stop[k]][~g].tobytes()
                    spans = int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1]))
                    rows.append((hashes[k], int(n_gone[k]), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if keep_text else None))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["h", "n_removed", "n_spans", "kept_sha256", "kept"])

    blocks = texts.select("h", "body").mapInArrow(tidy(gather), "block long, hashes array<string>, sizes array<long>, body binary")
    blocks = bucketed(blocks, "block", int(min(max(total_bytes // FILE_BYTES, 8), 50_000)), "suffix-blocks")
    ranks = materialise(sort_buckets(blocks.mapInArrow(tidy(sampled), "bucket int, block long, keys binary"), width), "suffix-ranks")
    ranked = _with_answers(blocks, ranks, "ranks")
    again = materialise(sort_buckets(ranked.mapInArrow(tidy(suffixes), "bucket int, block long, keys binary"), partners=True), "suffix-repeats")
    tied = settled(_with_answers(ranked, again, "repeats"))
    return tied.mapInArrow(tidy(removed), "h string, n_removed long, n_spans long, kept_sha256 string, kept string")


def _prepared(docs: DataFrame, id_col: str, text_col: str, length: int):
    """(light rows (doc_id, n_bytes, h, hot), hashes of repeated texts, distinct long texts with bodies, their bytes)."""
    body = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    full = docs.select(F.col(id_col).alias("doc_id"), F.length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("h"), body.alias("body"))
    light = materialise(full.select("doc_id", "n_bytes", "h"), "suffix-texts")
    rows, total = light.agg(F.count("*"), F.sum("n_bytes")).first()
    long = light.filter(F.col("n_bytes") >= length)
    each = materialise(long.groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")), "suffix-copies")
    copies = each.filter("n > 1").select("h", "n")
    # of equal texts the row of the least id stands for all; no key of this join is shared by the copies of a text
    spare = long.join(each.select(F.col("h").alias("_h"), F.col("first").alias("_id")), (F.col("doc_id") == F.col("_id")) & (F.col("h") == F.col("_h")), "left_anti")
    spare = spare.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    texts = full.filter(F.col("n_bytes") >= length)
    texts = join_checked(texts, materialise(spare, "suffix-spare"), (F.col("doc_id") == F.col("_id")) & (F.col("h") == F.col("_h")), "left_anti", rows=200_000)
    # fewer than HOT texts can be that frequent
    hot = copies.filter(F.col("n") > F.lit(rows / HOT)).select("h", F.lit(True).alias("hot"))
    return light.join(F.broadcast(hot), "h", "left"), copies.select("h"), texts, total or 0


def repeated_bytes(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one per document."""
    light, copies, texts, total = _prepared(docs, id_col, text_col, length)
    part = repeated_texts(texts, total, length).drop("kept").dropDuplicates(["h"])
    side = materialise(part.join(copies.select("h", F.lit(True).alias("copied")), "h", "full_outer"), "suffix-removed")
    # rows of hot texts are known to go as a whole; all others meet their text's row
    out = join_checked(light.filter("hot IS NULL"), side, "h", "left", rows=200_000)
    out = out.unionByName(light.filter("hot").withColumn("copied", F.col("hot")), allowMissingColumns=True)
    copied = F.coalesce("copied", F.lit(False))
    return out.select(
        "doc_id", "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, EMPTY).otherwise(F.coalesce("kept_sha256", "h")).alias("kept_sha256"),
    )


def drop_repeats(docs: DataFrame, length: int = PASSAGE) -> DataFrame:
    """Documents with repeated strings cut out of their texts; n_chars follows. A character cut in part goes wholly."""
    light, copies, texts, total = _prepared(docs, "doc_id", "text", length)
    part = repeated_texts(texts, total, length, keep_text=True).select(F.col("h").alias("_h"), F.col("kept").alias("_kept"))
    part = materialise(part, "suffix-kept").dropDuplicates(["_h"]).join(copies.select(F.col("h").alias("_h"), F.lit(True).alias("_copied")), "_h", "full_outer")
    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    hot = F.broadcast(light.filter("hot").select(F.col("h").alias("_hot")).distinct())
    keyed = docs.withColumn("_t", F.sha2(body, 256)).join(hot, F.col("_t") == F.col("_hot"), "left")
    out = keyed.filter("_hot IS NULL").join(part, F.col("_t") == F.col("_h"), "left")
    out = out.unionByName(keyed.filter("_hot IS NOT NULL").withColumns({"_h": F.col("_hot"), "_copied": F.lit(True)}), allowMissingColumns=True)
    out = out.withColumn("text", F.when(F.col("_copied"), "").when(F.col("_h").isNotNull(), F.col("_kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_h").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
