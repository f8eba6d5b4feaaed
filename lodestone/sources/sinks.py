"""Sinks; each has the rows it writes as a function of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def line_protocol(table: str, tags: list[str], fields: list[str]) -> Column:
    """``table,tag=v field=v``; NULL fields are left out."""
    tag = F.concat_ws(",", F.lit(table), *[F.concat(F.lit(f"{t}="), F.regexp_replace(F.col(t).cast("string"), "([ ,=])", r"\\$1")) for t in tags])
    return F.concat_ws(" ", tag, F.concat_ws(",", *[F.concat(F.lit(f"{f}="), F.col(f).cast("string")) for f in fields]))


def write_line_protocol(df: DataFrame, path: str, table: str, tags: list[str], fields: list[str]) -> None:
    df.select(line_protocol(table, tags, fields).alias("value")).where("value is not null").write.text(path)


def manifest(df: DataFrame, keys: list[str], file: str) -> DataFrame:
    """One row per window with its files in order."""
    return df.groupBy(*keys).agg(F.concat_ws(" ", F.array_sort(F.collect_list(file))).alias("files"))


def write_manifest(df: DataFrame, path: str, keys: list[str], file: str) -> None:
    manifest(df, keys, file).orderBy(*keys).write.csv(path, sep="\t")


def write_results(results: DataFrame, path: str, annotations: dict[str, str] | None = None) -> None:
    """Result objects as JSON lines, each with the annotations."""
    for k, v in (annotations or {}).items():
        results = results.withColumn(k, F.lit(v))
    results.write.json(path, ignoreNullFields=False)


def read_results(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_frame(path: str, *frames: DataFrame) -> None:
    """Frames below each other as JSON lines."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    out.write.json(path)
