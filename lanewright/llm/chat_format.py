"""Chat formatting with a grammar round trip.

Template (``TEMPLATE`` below): each turn is an opening mark, the text, a closing mark. A control string inside a text is
escaped by one backslash after its first character; a text that already holds an escaped control string gets one more,
so unescaping is exact. Each turn is first rendered as it is and reparsed; only if the recovered turn differs from the
source, or the grammar rejects it, is its conflicting content escaped, until both are identical.

Cases: a null text or role counts as empty; turns sort by (turn, role, text), nulls first; repeated rows are turns of
their own; a null conversation id is one conversation; an empty table gives an empty result; other columns are not read.
A conversation is streamed in turn order through its task and never held whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: role -> opening and closing mark; any other role is written between OTHER's marks with its name.
TEMPLATE = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[ROLE]", "[/ROLE]")
NAME_END = "[:]"

CONTROL = sorted({m for pair in [*TEMPLATE.values(), OTHER] for m in pair} | {NAME_END}, key=len, reverse=True)
_control = re.compile("|".join(map(re.escape, CONTROL)))
_conflict = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL))
_escaped = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROL))
_role_of = {opening: role for role, (opening, _) in TEMPLATE.items()}


def escape(text: str) -> str:
    return _conflict.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _escaped.sub(lambda m: m[0][0] + m[0][2:], text)


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Turns (role, text, start, end of the text as written); ValueError where the grammar doesn't hold."""
    turns, at = [], 0
    marks = iter(_control.finditer(rendered))
    for opening in marks:
        if opening.start() != at:
            raise ValueError("text between turns")
        role, start, mark = _role_of.get(opening[0]), opening.end(), next(marks, None)
        if role is None:
            if opening[0] != OTHER[0] or mark is None or mark[0] != NAME_END:
                raise ValueError("no turn begins here")
            role, start, mark = unescape(rendered[start : mark.start()]), mark.end(), next(marks, None)
            closing = OTHER[1]
        else:
            closing = TEMPLATE[role][1]
        if mark is None or mark[0] != closing:
            raise ValueError("turn not closed")
        turns.append((role, unescape(rendered[start : mark.start()]), start, mark.start()))
        at = mark.end()
    if at != len(rendered):
        raise ValueError("text after the last turn")
    return turns


def render(role: str, text: str) -> str:
    """One turn whose reparse gives exactly (role, text)."""

    def write(r: str, t: str) -> str:
        opening, closing = TEMPLATE.get(role, OTHER)
        return opening + ("" if role in TEMPLATE else r + NAME_END) + t + closing

    r, t = role, text
    for _ in range(3):
        out = write(r, t)
        try:
            if [x[:2] for x in parse(out)] == [(role, text)]:
                return out
        except ValueError:
            pass
        r, t = escape(role), escape(text)
    raise AssertionError("escaping is not reversible")


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, role, rendered. Concatenated in order the turns are the conversation."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(rendered=[render(r, t) for r, t in zip(f.role, f.text, strict=True)])[["conv_id", "turn", "role", "rendered"]]

    kind = dict(turns.dtypes)
    src = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    # nullable integers go through strings: pandas would turn them into floats
    src = src.withColumns({"conv_id": F.col("conv_id").cast("string"), "turn": F.col("turn").cast("string")})
    out = src.mapInPandas(run, "conv_id string, turn string, role string, rendered string")
    return out.withColumns({"conv_id": F.col("conv_id").cast(kind[conv_col]), "turn": F.col("turn").cast(kind[turn_col])})


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what a reader recovers from the rendered turns; state is carried along the sorted stream."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for f in frames:
            done = []
            for conv, rendered in zip(f.conv_id, f.rendered, strict=True):
                conv = None if pd.isna(conv) else conv
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, *close(state)))
                    now, state = conv, {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                for role, text, _, _ in parse(rendered):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                    if role == "assistant":
                        state["loss"].update(text.encode())
                        state["loss_chars"] += len(text)
                state["chars"] += len(rendered)
            yield pd.DataFrame(done, columns=cols)
        if state is not None:
            yield pd.DataFrame([(now, *close(state))], columns=cols)

    def close(s: dict) -> tuple:
        return s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"]

    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = dict(formatted.dtypes)["conv_id"]
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "rendered").select(F.col("conv_id").cast("string"), "rendered")
    out = ordered.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))
