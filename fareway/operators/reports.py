"""Record bundles for dashboards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Section:
    """A table of a bundle: its order and, for long tables, how many rows to show."""

    table: DataFrame
    order: Sequence[str | Column] = field(default_factory=tuple)
    limit: int | None = None


def dashboard_bundle(sections: Mapping[str, Section]) -> DataFrame:
    """(section, rank, record): the first rows of each section as JSON records.

    Sections without a limit must be small by nature (hours, days, labels); they are
    ranked the same way.
    """
    parts = []
    for name, section in sections.items():
        df = section.table
        shown = df if section.limit is None else df.orderBy(*section.order).limit(section.limit)
        rank = F.row_number().over(Window.orderBy(*section.order))
        record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        parts.append(shown.select(F.lit(name).alias("section"), rank.alias("rank"), record.alias("record")))
    return reduce(DataFrame.unionByName, parts)


def filled_sections(bundle: DataFrame) -> DataFrame:
    """Sections that have records, with their number."""
    return bundle.groupBy("section").agg(F.count("*").alias("records"))


def stack_tables(tables: Mapping[str, DataFrame], name: str = "table") -> DataFrame:
    """Rows of several tables over each other, with the table name; missing columns are null."""
    named = [df.select(F.lit(key).alias(name), "*") for key, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
