"""Column expressions on names, values and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as blank at the ends of a value, and file names.
STRIP = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"
SOLID = r"[^\s\x1c-\x1f\x85\p{Z}]"
CHUNK_FILE = r"(?:^|_)chunk_(\d+)\.csv$"
RESULT_FILE = r"_results_(\d+)\.csv$"
RANGE_FILE = r"^result_(\d+)_(\d+)\.csv$"


def strip(value: Column) -> Column:
    """Without blanks of any script at both ends; null counts as ''."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), STRIP, "")


def blank(value: Column) -> Column:
    """Whether :func:`strip` leaves nothing: told by the first character that is no blank, not by a pass over the whole value."""
    return ~F.coalesce(value, F.lit("")).rlike(SOLID)


def label(number: Column) -> Column:
    """A chunk number with at least three digits."""
    return F.format_string("%03d", number)


def number_in(name: Column, pattern: str = CHUNK_FILE) -> Column:
    """The number in a file name, null where it has none."""
    found = F.regexp_extract(name, pattern, 1)
    return F.when(found != "", found.cast("int"))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, 0 where the whole is 0."""
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def message(code: Column, text: Column, most: int = 300) -> Column:
    """The report form of a failure: one line, of bounded length."""
    line = F.replace(text, F.lit("\n"), F.lit(" | "))
    return F.concat(F.lit("EXIT "), code.cast("string"), F.lit(": "), F.substring(line, 1, most))


def shorten(value: Column, most: int = 60) -> Column:
    """The value as a report shows it: its first characters."""
    return F.substring(value, 1, most)


def relative(path: Column, root: str) -> Column:
    """A path below ``root``; others stay as they are."""
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(prefix)), F.substring(path, len(prefix) + 1, 1 << 20)).otherwise(path)


def all_empty(columns: list[Column], stripped: bool = True, vacuous: bool = False) -> Column:
    """Every column is empty; with no column, ``vacuous``."""
    if not columns:
        return F.lit(vacuous)
    held = F.lit(True)
    for c in columns:
        held = held & ((strip(c) if stripped else F.coalesce(c, F.lit(""))) == "")
    return held
