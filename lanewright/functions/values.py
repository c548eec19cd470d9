"""Scalar expressions over text, numbers, keys and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEET_PER_MILE = 5280.0


def clean_street(name: Column) -> Column:
    """Upper case, single blanks, no outer blanks; blank becomes null."""
    return F.nullif(F.upper(F.trim(F.regexp_replace(name, r"\s+", " "))), F.lit(""))


def number(value: Column, kind: str = "double") -> Column:
    """Null where the text is not a number."""
    return F.trim(value).try_cast(kind)


def half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def flag(condition: Column) -> Column:
    """A condition that is unknown is not a flag."""
    return F.coalesce(condition, F.lit(False))


def travel_seconds(feet: Column, mph: Column) -> Column:
    """Null at speed 0."""
    return F.try_divide(feet / FEET_PER_MILE, mph) * 3600


def composite_key(*parts: Column, mark: str = "#") -> Column:
    return F.concat_ws(mark, *[p.cast("string") for p in parts])


def key_part(key: Column, nth: int, mark: str = "#") -> Column:
    return F.split_part(key, F.lit(mark), F.lit(nth))


def label_of(code: Column, labels: dict, default: str | None = None) -> Column:
    """Label of a code by a small fixed map; ``default`` for other codes."""
    out = F.lit(default)
    for k, v in labels.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def formula_version(label: str, *parameters) -> Column:
    """``label+`` and six hex digits that change when a parameter does."""
    return F.concat(F.lit(f"{label}+"), F.substring(F.sha2(F.lit("|".join(map(str, parameters))).cast("binary"), 256), 1, 6))


def clock_text(slot: Column) -> Column:
    """A slot with its leading zeros back: 30 to "0030"."""
    return F.lpad(slot.cast("string"), 4, "0")


def iso_text(value: Column, kind: str) -> Column:
    """Dates and timestamps as ISO text; decimals as double; others as they are."""
    if kind == "date":
        return F.date_format(value, "yyyy-MM-dd")
    if kind.startswith("timestamp"):
        return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    return value.cast("double") if kind.startswith("decimal") else value


def varied(base: Column, *seed: Column, low: float = 0.3, high: float = 1.3, least: float = 1.0) -> Column:
    """``base`` times a factor from low to high that depends on the seed columns' text alone, so a retried task gives the same."""
    text = F.concat_ws("|", *[x.cast("string") for x in seed])
    u = F.conv(F.substring(F.md5(text.cast("binary")), 1, 5), 16, 10).cast("double") / float(1 << 20)
    return F.greatest(F.lit(least), base * (low + (high - low) * u))


def json_map(text: Column, value: str = "double") -> Column:
    """Map from JSON text; bad JSON gives an empty map."""
    return F.coalesce(F.from_json(text, f"map<string,{value}>"), F.create_map().cast(f"map<string,{value}>"))
