"""Text expressions: stripping, tokens, stems, sequence ids and number guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as an integer and as a float token; checked before any cast, so that engines agree.
INTEGER = r"^[+-]?\d+$"
FLOAT = r"^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)$"


def strip(x: Column) -> Column:
    """White space of any kind removed at both ends."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def stripped_lines(x: Column) -> Column:
    """Lines of the stripped text; no lines for an empty text. Interior blank lines stay."""
    s = strip(F.coalesce(x, F.lit("")))
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, r"\R"))


def tokens(line: Column) -> Column:
    """White-space separated tokens; none for a blank line."""
    s = strip(line)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, r"\s+"))


def is_integer(x: Column) -> Column:
    return F.coalesce(x.rlike(INTEGER), F.lit(False))


def is_float(x: Column) -> Column:
    return F.coalesce(F.lower(x).rlike(FLOAT), F.lit(False))


def to_float(x: Column) -> Column:
    """Double of a guarded token; infinities and NaN in the usual spellings."""
    low = F.lower(x)
    sign = F.when(low.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(low.rlike(r"inf"), sign * F.lit(float("inf"))).when(low.rlike("nan"), F.lit(float("nan"))).otherwise(low.try_cast("double"))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def extension(name: Column) -> Column:
    """With its dot, as written; empty if there is none."""
    return F.regexp_extract(name, r"[^/.]+(\.[^./]*)$", 1)


def stem(name: Column) -> Column:
    return F.regexp_replace(file_name(name), r"(?<=.)\.[^.]*$", "")


def is_image(name: Column) -> Column:
    return F.lower(extension(name)).isin(".jpg", ".jpeg", ".png")


def sequence_of(stem_col: Column) -> Column:
    """The text before the last underscore; the whole stem if there is none."""
    return F.regexp_replace(stem_col, r"_[^_]*$", "")


def seeded_key(seed: int | str, key: Column) -> Column:
    """A pseudo-random order of keys that any engine with md5 reproduces."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key))
