"""Fill-in-middle transformation over content-defined chunks.

Units of a text are its letter runs and its other characters, ``[A-Za-z]+|[^A-Za-z]``. A rolling hash over the UTF-8 bytes
cuts each text into chunks where the last ``WINDOW`` bytes say so, so a passage that several texts share falls into the same
chunks wherever it stands. A chunk's boundary summary (its units, whether it begins and ends inside a letter run) is
remembered under the chunk's own bytes: equal bytes, never just an equal hash, share a summary. Summaries are combined from
left to right (a run that goes on across a boundary is one unit), which gives the text's units and, for each cut, the one
chunk that has to be looked into.

``restored`` rebuilds the text from output and form alone: a text with a mark in it stays plain, and no mark can arise across
the seam of a piece and a mark since no mark ends as it begins.

Cases: a null text is empty, and an empty one stays plain with no units; repeated rows and ids are transformed row by row; a
null id draws as an empty one; texts of any length are handled in chunks of at most ``LONGEST`` bytes; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewright.llm.workers import in_batches, tidy

#: Bytes that a boundary depends on, its share of positions (one in 512), and the longest chunk.
WINDOW, MASK, LONGEST = 32, np.uint32((1 << 9) - 1 << 20), 1 << 16
#: Bytes of chunks whose summaries a worker remembers; a full memory starts anew.
REMEMBERED = 16 << 20
SEED = 1
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20

#: One number per byte value, mixed from the value.
_GEAR = ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
#: Over UTF-8: a letter run, or the first byte of any other character.
_unit = re.compile(rb"[A-Za-z]+|[^A-Za-z\x80-\xbf]")
_letters = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def chunk_starts(data: bytes) -> list[int]:
    """Where the chunks of a text begin, and its length; never inside a character."""
    b = np.frombuffer(data, np.uint8)
    h, width = _GEAR[b], 1
    while width < WINDOW:  # sums over windows of twice the width, each byte weighted by its age
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    cuts = np.flatnonzero((h & MASK) == 0) + 1
    ends = [int(c) for c in cuts if c < len(data)] + [len(data)]
    out = [0]
    for end in ends:
        while end - out[-1] > LONGEST:
            out.append(_whole(data, out[-1] + LONGEST))
        end = _whole(data, end)
        if end > out[-1]:
            out.append(end)
    return out


def _whole(data: bytes, at: int) -> int:
    """The first position from ``at`` where a character begins."""
    while at < len(data) and 0x80 <= data[at] < 0xC0:
        at += 1
    return at


class Summaries:
    """Boundary summaries by chunk content."""

    def __init__(self, remembered: int = REMEMBERED):
        self.known: dict[bytes, tuple[int, bool, bool]] = {}
        self.left = self.room = remembered

    def __call__(self, chunk: bytes) -> tuple[int, bool, bool]:
        found = self.known.get(chunk)
        if found is None:
            found = len(_unit.findall(chunk)), chunk[0] in _letters, chunk[-1] in _letters
            if self.left < len(chunk):
                self.known, self.left = {}, self.room
            self.known[chunk] = found
            self.left -= len(chunk) + 100
        return found


class Cutter:
    """The units of one text and the byte where each begins."""

    def __init__(self, data: bytes, summaries: Summaries):
        self.data = data
        self.starts = chunk_starts(data) if data else [0]
        self.before, self.goes_on, n, inside = [], [], 0, False
        for lo, hi in zip(self.starts, self.starts[1:], strict=False):
            units, first, last = summaries(data[lo:hi])
            self.goes_on.append(inside and first)
            self.before.append(n)
            n += units - self.goes_on[-1]
            inside = last
        self.n = n

    def begin(self, unit: int) -> int:
        """The byte where a unit begins; the end of the text for the one past the last."""
        if unit >= self.n:
            return len(self.data)
        c = int(np.searchsorted(self.before, unit, "right")) - 1
        lo, hi = self.starts[c], self.starts[c + 1]
        return lo + next(islice(_unit.finditer(self.data[lo:hi]), unit - self.before[c] + self.goes_on[c], None)).start()


def transform(data: bytes, draw: str, summaries: Summaries) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of a text; ``draw`` is the hex digest that decides."""
    h1, h2, h3, h4 = (int(draw[k : k + 8], 16) for k in range(0, 32, 8))
    cutter = Cutter(data, summaries)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    if not data or p in data or s in data or m in data or h3 % 100 >= 100 - PLAIN_PERCENT:
        return cutter.n, "plain", None, None, data
    lo, hi = sorted((h1 % (cutter.n + 1), h2 % (cutter.n + 1)))
    a, b = cutter.begin(lo), cutter.begin(hi)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    chars = len(prefix.decode("utf-8", "replace")), len(middle.decode("utf-8", "replace"))
    if h4 % 100 < SPM_PERCENT:
        return cutter.n, "spm", *chars, s + suffix + p + prefix + m + middle
    return cutter.n, "psm", *chars, p + prefix + s + suffix + m + middle


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Rows (doc_id, n, form, prefix_chars, middle_chars, output), one per document."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"), draw.alias("draw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries = Summaries()
        for b in batches:
            rows = ((i.as_py(), *transform(t.as_py(), d.as_py(), summaries)) for i, t, d in zip(*b.columns, strict=True))
            schema = pa.schema([b.schema.field("doc_id"), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])
            yield from in_batches(rows, schema)

    out = src.mapInArrow(tidy(run), f"doc_id {src.dtypes[0][1]}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text, from output and form alone."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        a = F.split(F.substring(output, len(first) + 1, 2**31 - 1), second, 2)
        b = F.split(F.get(a, F.lit(1)), MIDDLE, 2)
        return F.get(a, F.lit(0)), F.get(b, F.lit(0)), F.get(b, F.lit(1))

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    suffix2, prefix2, middle2 = parts(SUFFIX, PREFIX)
    return F.when(form == "plain", output).when(form == "psm", F.concat(prefix, middle, suffix)).otherwise(F.concat(prefix2, middle2, suffix2))
