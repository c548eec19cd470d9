"""Packing tokens into sequences by the sum-of-squares rule.

A document's ids are cut into full windows, which need no packing, and one remainder. Remainders go, in a seeded order
within bounded groups, each to the fill level that minimises the sum of squared counts of partially filled windows; the
counts are kept in a level array. When a group's stream ends, the windows that are still open are closed by cutting the
pieces of the emptiest into the gaps of the fullest, so a group pads one window at most.

A sequence is padded to ``seq_len`` unless its fill is a power of two.

Cases: a null text is empty and consists of the end id alone; repeated rows and repeated ids are packed as documents of
their own; texts of any length are encoded in stretches between ASCII blanks, which no token crosses; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.workers import tidy

SEQ_LEN = 2048
END_ID = 1
#: Expected documents and bytes of text in a packing group, at most: a group is one unit of sequential placement.
GROUP_DOCS, GROUP_BYTES = 6000, 64 << 20
SEED = 31
CACHE_WORDS = 120_000


_plain = re.compile("([A-Za-zÀ-ÖØ-öß-ÿ]+)([!#$%&()*+,./:;=?@^_`~-]*)")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class WordEncoder:
    """Ids of a text from the ids of its blank-separated stretches.

    The tokenizer drops white space and never joins across it, so stretches between spaces or line feeds are encoded on
    their own and the common ones are remembered. Memory is bounded: a full cache starts anew.

    A stretch of Latin letters is one piece of the tokenizer; its merges are applied by a byte-pair merger that is given
    the same merges in the same order, with byte 255 (never part of UTF-8) as the end-of-word mark. All other stretches
    go through the tokenizer itself. The tests hold both ways against each other.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        end, byte_of = model["end_of_word_suffix"], _byte_of()

        def key(token: str) -> bytes:
            closed = token.endswith(end)
            return bytes(byte_of[c] for c in (token[: -len(end)] if closed else token)) + b"\xff" * closed

        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        order = [bytes((b,)) for b in range(256)] + [bytes((b, 255)) for b in range(255)] + [key(a + b) for a, b in pairs]
        ranks = {k: i for i, k in enumerate(dict.fromkeys(order))}
        id_of = [bytes(4)] * len(ranks)
        for token, i in model["vocab"].items():
            if (k := key(token) if all(c in byte_of for c in token.removesuffix(end)) else None) in ranks:
                id_of[ranks[k]] = i.to_bytes(4, "little")
        self.id_of = id_of.__getitem__
        #: ids of vocabularies up to 65536 travel as 16 bits
        self.kind = "<u2" if max(model["vocab"].values()) < 1 << 16 else "<u4"
        self.merge = tiktoken.Encoding("merges", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.cache: dict[str, bytes] = {"": b""}

    def encode(self, word: str) -> bytes:
        m = _plain.fullmatch(word)
        if not m:
            return np.array(self.slow.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        word, tail = m.groups()
        ids = b"".join(map(self.id_of, self.merge(word.lower().encode() + b"\xff")))
        if tail:
            if tail not in self.cache:
                self.cache[tail] = np.array(self.slow.encode(tail, add_special_tokens=False).ids, "<u4").tobytes()
            ids += self.cache[tail]
        return ids

    def __call__(self, text: str) -> np.ndarray:
        if text.isascii():
            text = text.lower()  # as the tokenizer does; more stretches become alike
        words = text.replace("\n", " ").split(" ")
        if len(self.cache) > CACHE_WORDS:
            self.cache = {"": b""}
        cache, out = self.cache, []
        for w in words:
            ids = cache.get(w)
            if ids is None:
                ids = self.encode(w)
                if len(w) <= 24:  # long stretches are rarely met again
                    cache[w] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), "<u4")


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, ids, id_bytes): little-endian ids of that many bytes each, with the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        kind, end = encoder.kind, np.array([end_id], encoder.kind)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                ids = [np.concatenate((encoder(t.as_py() or "").astype(kind), end)).tobytes() for t in part.column("text")]
                size = pa.array(np.full(len(ids), np.dtype(kind).itemsize, np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), size], names=["doc_id", "ids", "id_bytes"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(tidy(run), f"doc_id {src.dtypes[0][1]}, ids binary, id_bytes int")


class Levels:
    """Open windows by fill level, with the sum-of-squares choice."""

    def __init__(self, seq_len: int):
        self.seq_len = seq_len
        self.count = np.zeros(seq_len + 1, np.int64)
        self.open: dict[int, list[int]] = {}

    def choose(self, size: int) -> int:
        """The level to put a piece on; 0 opens a window.

        Moving a window from level h to h + size changes the sum of squares by 2 (N[h + size] - N[h]) + 2; a new window
        changes it by 2 N[size] + 1; reaching seq_len only takes a window away.
        """
        last = self.seq_len - size
        change = 2 * (self.count[size:] - self.count[: last + 1]) + 2
        change[last] = 1 - 2 * self.count[last]
        change[0] = 2 * self.count[size] + 1 if size < self.seq_len else 0
        change[1:][self.count[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return int(change.argmin())

    def take(self, level: int) -> int:
        self.count[level] -= 1
        return self.open[level].pop()

    def put(self, level: int, window: int) -> None:
        if level < self.seq_len:
            self.count[level] += 1
            self.open.setdefault(level, []).append(window)


def pack_group(sizes: list[int], seq_len: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, window, offset) covering each size, and the number of windows."""
    levels, windows, pieces = Levels(seq_len), 0, []
    content: dict[int, list[list[int]]] = {}
    for d, size in enumerate(sizes):
        whole = size // seq_len
        for k in range(whole):
            pieces.append((d, k * seq_len, seq_len, windows, 0))
            windows += 1
        rest = size - whole * seq_len
        if not rest:
            continue
        level = levels.choose(rest)
        if level:
            w = levels.take(level)
        else:
            w, windows = windows, windows + 1
            content[w] = []
        content[w].append([d, whole * seq_len, rest])
        levels.put(level + rest, w)
    # the stream has ended: the emptiest open windows fill the gaps of the fullest
    order = sorted(((h, w) for h, ws in levels.open.items() for w in ws), reverse=True)
    lo, hi, fill = 0, len(order) - 1, dict((w, h) for h, w in order)
    while lo < hi:
        a, b = order[lo][1], order[hi][1]
        gap = seq_len - fill[a]
        if not gap:
            lo += 1
            continue
        d, start, n = content[b][-1]
        m = min(gap, n)
        content[a].append([d, start + n - m, m])
        fill[a] += m
        fill[b] -= m
        content[b][-1][2] -= m
        if m == n:
            content[b].pop()
        if not fill[b]:
            hi -= 1
    kept = {w: k for k, w in enumerate(sorted({p[3] for p in pieces} | {w for w, c in content.items() if c}))}
    pieces = [(d, s, n, kept[w], o) for d, s, n, w, o in pieces]
    for w, c in content.items():
        at = 0
        for d, start, n in c:
            pieces.append((d, start, n, kept[w], at))
            at += n
    return pieces, len(kept)


def pack(tokens: DataFrame, rows: int, seq_len: int = SEQ_LEN, group_docs: int = GROUP_DOCS, text_bytes: int = 0) -> DataFrame:
    """Rows (doc_id, ids, id_bytes) to pieces: doc_id, start, length, ids (32-bit), doc_tokens, sequence_id, offset.

    ``rows`` and ``text_bytes`` are the number of documents and their bytes; they set the number of groups. Documents are dealt to groups by hash, so neither
    a source nor a set of copies gathers in one. A group's order is by hash, so reruns and retried tasks agree.
    """
    groups = max(1, round(rows / group_docs), -(-text_bytes // GROUP_BYTES))
    kind = dict(tokens.dtypes)["doc_id"]
    dealt = tokens.withColumn("h", F.xxhash64("doc_id", F.lit(SEED), "ids")).withColumn("grp", F.pmod("h", F.lit(groups)))
    dealt = dealt.repartition("grp").sortWithinPartitions("grp", "h", "doc_id").select("grp", "doc_id", "ids", "id_bytes")

    def place(group: int, doc_ids: list, ids: list[np.ndarray], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        pieces, _ = pack_group([len(x) for x in ids], seq_len)
        for lo in range(0, len(pieces), 2000):
            part = pieces[lo : lo + 2000]
            d, start, n, w, at = zip(*part, strict=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([doc_ids[i] for i in d], id_type), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                pa.array([ids[i][s : s + m].astype("<u4").tobytes() for i, s, m in zip(d, start, n, strict=True)], pa.binary()),
                pa.array([len(ids[i]) for i in d], pa.int64()), pa.array([group << 40 | x for x in w], pa.int64()), pa.array(at, pa.int64()),
            ], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, doc_ids, ids = None, [], []
        for b in batches:
            id_type = b.schema.field("doc_id").type
            for g, d, x, size in zip(*(b.column(c).to_pylist() for c in ("grp", "doc_id", "ids", "id_bytes")), strict=True):
                if g != now and ids:
                    yield from place(now, doc_ids, ids, id_type)
                    doc_ids, ids = [], []
                now = g
                doc_ids.append(d)
                ids.append(np.frombuffer(x, f"<u{size}"))
        if ids:
            yield from place(now, doc_ids, ids, id_type)

    return dealt.mapInArrow(tidy(run), f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, seq_len: int = SEQ_LEN) -> DataFrame:
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    return pack(tokenize(docs, tokenizer_path), rows, seq_len, text_bytes=size)
