"""Reading datasets of linked tables: one parquet folder per table below a root, with a part column."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, root: str, tables: list[str], columns: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """The named tables, each with only the columns asked for; a missing table is an error when read."""
    out = {t: spark.read.parquet(f"{root.rstrip('/')}/{t}") for t in tables}
    return {t: df.select(*columns[t]) if columns and t in columns else df for t, df in out.items()}


def versioned(names: list[str], prefix: str) -> str | None:
    """Of the names ``P`` and ``P_<digits>`` that stand for one table the lowest."""
    found = [n for n in names if re.fullmatch(rf"{re.escape(prefix)}(?:_\d+)?", n)]
    return min(found, default=None)
