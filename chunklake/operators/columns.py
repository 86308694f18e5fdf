"""Column resolution and projection to the canonical relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunklake.functions.text import strip

# Names of columns that are input, and of the structure column.
INPUT_COLUMNS = ("key", "input", "smiles", "canonical_smiles")
STRUCTURE_COLUMNS = ("smiles", "canonical_smiles", "input")


def resolve(columns: list[str], wanted: str) -> str | None:
    """The column named ``wanted``: exactly, or else the first that matches in lower case.

    Names are compared without blanks at their ends and without a byte-order mark.
    """
    clean = {c: c.lstrip("﻿").strip() for c in columns}
    exact = [c for c, n in clean.items() if n == wanted]
    loose = [c for c, n in clean.items() if n.lower() == wanted.lower()]
    return (exact or loose or [None])[0]


def detect(columns: list[str], names: tuple[str, ...] = STRUCTURE_COLUMNS) -> str | None:
    return next((c for c in columns if c.strip().lower() in names), None)


def result_columns(columns: list[str], inputs: tuple[str, ...] = INPUT_COLUMNS) -> list[str]:
    return [c for c in columns if c.strip().lower() not in inputs]


def extract(df: DataFrame, structure: str, identifier: str | None, *keep: str | Column) -> DataFrame:
    """(smiles, collection_id): both stripped, rows without a structure dropped.

    Columns and expressions ``keep`` follow.  A missing identifier column gives ''; a missing structure
    column no row, with the same columns.
    """
    s = resolve(df.columns, structure)
    i = resolve(df.columns, identifier) if identifier else None
    if s is None:
        return df.where(F.lit(False)).select(F.lit("").alias("smiles"), F.lit("").alias("collection_id"), *keep)
    value = strip(F.col(f"`{s}`").cast("string"))
    other = strip(F.col(f"`{i}`").cast("string")) if i else F.lit("")
    return df.where(value != "").select(value.alias("smiles"), other.alias("collection_id"), *keep)
