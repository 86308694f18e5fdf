"""Which file is which library, in which layout; aliases."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunklake.sources.archive import Layout, read_archive


@dataclass
class Catalogue:
    """files: file name to (library, format); formats: format to layout;
    overrides: file name to (structure, identifier) columns of that file alone."""

    files: dict[str, tuple[str, str]]
    formats: dict[str, Layout]
    overrides: dict[str, tuple[str, str]] = field(default_factory=dict)
    aliases: dict[str, str] = field(default_factory=dict)

    def layout(self, file: str) -> Layout:
        layout = self.formats[self.files[file][1]]
        if file in self.overrides:
            structure, identifier = self.overrides[file]
            layout = replace(layout, structure=structure, identifier=identifier)
        return layout

    def library(self, name: str) -> str:
        """The library an alias stands for, in any case; other names are themselves."""
        return {k.lower(): v for k, v in self.aliases.items()}.get(name.lower(), name)

    def library_of(self, name: Column) -> Column:
        """:meth:`library` of a column; the few aliases are in the expression."""
        known = {k.lower(): v for k, v in self.aliases.items()}
        names = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
        return F.coalesce(F.try_element_at(names, F.lower(name)), name) if known else name

    def select(self, names: list[str] | None = None) -> list[str]:
        """The known files among ``names`` (all by default); each unknown one is warned of."""
        for name in names or ():
            if name not in self.files:
                warnings.warn(f"{name} is not in the catalogue and is skipped", stacklevel=2)
        return [n for n in (names or self.files) if n in self.files]

    def read(self, spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
        """The rows of the chosen files: library, smiles, collection_id, member, row."""
        out = None
        for file in self.select(names):
            rows = read_archive(spark, f"{folder}/{file}", self.layout(file)).withColumn("library", F.lit(self.files[file][0]))
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            out = spark.createDataFrame([], "smiles string, collection_id string, member int, row long, library string")
        return out
