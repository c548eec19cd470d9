"""Byte-level BPE through a sentencepiece model that is serialised straight from the vocabulary.

A rank file names byte strings in the order of their merges. Each becomes a piece whose characters stand for its bytes, with
the negative rank as its score and its id as its place, under a normaliser that changes nothing; sentencepiece's BPE, which
merges the best-scored neighbours first and the leftmost of equal ones, then does the vocabulary's merges. Pre-tokens (the
matches of the pattern) are encoded one by one, and one that is a piece itself is that piece, merges or not.

Decoding takes each id to its piece and the piece's characters back to their bytes.

Cases: a null text is empty and has no ids; repeated rows and ids are encoded row by row; bytes that are no UTF-8 become the
replacement character; texts of any length are matched a stretch of ``STRETCH`` pre-tokens at a time; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.packing import _byte_of
from lanewright.llm.workers import in_batches, tidy

STRETCH = 200_000
#: Pre-tokens of a generation that a worker remembers, and the longest of them; a full one becomes the old one.
REMEMBERED, LONGEST = 300_000, 48
#: Field numbers of the model's message and of its parts, and the kinds of pieces and models.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE, UNK_ID, BPE = 3, 4, 40, 2
NAME, DUMMY_PREFIX, DROP_SPACES, ESCAPE_SPACES = 1, 3, 4, 5


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 byte strings and ranks, one pair a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes((*out, n))


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _text(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The model of a vocabulary whose ranks are 0 .. n - 1 and that has every byte; the unknown piece, never used, is n."""
    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))):
        raise ValueError("ranks must be 0 .. n - 1")
    if any(bytes((b,)) not in ranks for b in range(256)):
        raise ValueError("the vocabulary lacks a byte")
    char_of = {b: c for c, b in _byte_of().items()}
    out = [_text(PIECES, _text(PIECE, "".join(map(char_of.__getitem__, t)).encode()) + _varint(SCORE << 3 | 5) + struct.pack("<f", -r) + _number(KIND, NORMAL)) for r, t in enumerate(by_rank)]
    out.append(_text(PIECES, _text(PIECE, b"<unk>") + _varint(SCORE << 3 | 5) + struct.pack("<f", 0) + _number(KIND, UNKNOWN)))
    out.append(_text(TRAINER, _number(MODEL_TYPE, BPE) + _number(VOCAB_SIZE, len(by_rank) + 1) + _number(UNK_ID, len(by_rank))))
    out.append(_text(NORMALIZER, _text(NAME, b"identity") + _number(DUMMY_PREFIX, 0) + _number(DROP_SPACES, 0) + _number(ESCAPE_SPACES, 0)))
    return b"".join(out)


class Encoder:
    """Ids of pre-tokens, as packed 32-bit numbers; a call encodes a text."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        from sentencepiece import SentencePieceProcessor

        self.ranks = ranks
        self.model = SentencePieceProcessor(model_proto=serialise(ranks))
        self.find = regex.compile(pattern)
        self.mapped = str.maketrans({chr(b): c for c, b in _byte_of().items()})
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, units: list[str]) -> None:
        """Pre-tokens that are pieces themselves, and the merges of all others in one call."""
        rest, mapped = [], []
        for u in units:
            data = u.encode("utf-8", "replace")
            whole = self.ranks.get(data)
            if whole is None:
                rest.append(u)
                mapped.append(data.decode("latin-1").translate(self.mapped))
            else:
                self.known[u] = struct.pack("<I", whole)
        for u, ids in zip(rest, self.model.encode(mapped, out_type=int, num_threads=1) if mapped else [], strict=True):
            self.known[u] = struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        found, out = (m.group() for m in self.find.finditer(text)) if len(text) > STRETCH else None, []
        while units := self.find.findall(text) if found is None else list(islice(found, STRETCH)):
            new = set(units).difference(self.known)
            self.known |= {u: self.old[u] for u in new if u in self.old}
            self.learn([u for u in new if u not in self.known])
            out.append(b"".join(map(self.known.__getitem__, units)))
            for u in new:
                if len(u) > LONGEST:
                    del self.known[u]
            if len(self.known) > REMEMBERED:
                self.known, self.old = {}, self.known
            if found is None:
                break
        return b"".join(out)


def piece_bytes(model_proto: bytes) -> list[bytes]:
    """The bytes that each id of a serialised model stands for."""
    from sentencepiece import SentencePieceProcessor

    byte_of, model = _byte_of(), SentencePieceProcessor(model_proto=model_proto)
    return [bytes(map(byte_of.__getitem__, model.id_to_piece(i))) for i in range(model.get_piece_size() - 1)]


@lru_cache(1)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


@lru_cache(1)
def _decoder(path: str) -> list[bytes]:
    return piece_bytes(serialise(read_ranks(path)))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens, ids): ids as little-endian unsigned 32-bit numbers. ``pattern`` must match every character."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)

        def rows(b: pa.RecordBatch) -> Iterator[tuple]:
            for i, t in zip(*b.columns, strict=True):
                ids = encoder(t.as_py().decode("utf-8", "replace"))
                yield i.as_py(), len(ids) // 4, ids

        for b in batches:
            yield from in_batches(rows(b), pa.schema([b.schema.field("doc_id"), ("n_tokens", pa.int64()), ("ids", pa.binary())]))

    return src.mapInArrow(tidy(run), f"doc_id {src.dtypes[0][1]}, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds ``decoded``, the bytes that the ids stand for; an id beyond the vocabulary is an error."""
    names = [f.name for f in encoded.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _decoder(ranks_path).__getitem__
        for b in batches:
            ids = b.column("ids")
            rows = ((*(b.column(c)[k].as_py() for c in names), b"".join(map(pieces, np.frombuffer(ids[k].as_py(), "<u4").tolist()))) for k in range(b.num_rows))
            yield from in_batches(rows, b.schema.append(pa.field("decoded", pa.binary())))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(tidy(run), f"{ddl}, decoded binary")
