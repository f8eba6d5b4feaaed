"""Parquet footers as rows: what is stored per file, row group and column, read in the executors without reading any data."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "file string, row_group int, column string, path string, kind string, codec string, rows long, values long, nulls long, raw_bytes long, stored_bytes long"
_ARROW = pa.schema([(n, {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[t]) for n, t in (f.split(" ") for f in SCHEMA.split(", "))])
#: Schemes whose files tasks can open for themselves; of others Spark reads the whole file.
OPENED = ("file", "hdfs", "s3", "gs", "abfs", "abfss")


def _chunks(file: str, source) -> Iterator[tuple]:
    with pq.ParquetFile(source) as f:
        meta = f.metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for c in range(group.num_columns):
                chunk = group.column(c)
                nulls = chunk.statistics.null_count if chunk.is_stats_set and chunk.statistics.has_null_count else None
                path = chunk.path_in_schema
                yield file, g, path.split(".")[0], path, chunk.physical_type, chunk.compression, group.num_rows, chunk.num_values, nulls, chunk.total_uncompressed_size, chunk.total_compressed_size
        if not meta.num_row_groups:
            yield (file, *([None] * 5), 0, *([None] * 4))


def _opened(file: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(file if "://" in file else file.replace("file:", "file://", 1))
    return system.open_input_file(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = batch.column("content").to_pylist() if "content" in batch.schema.names else None
        for n, file in enumerate(batch.column("path").to_pylist()):
            rows = list(_chunks(file, io.BytesIO(whole[n]) if whole else _opened(file)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)


def footers(spark: SparkSession, path: str | list[str], whole: bool | None = None) -> DataFrame:
    """One row per file, row group and column chunk of all parquet files under ``path``: see SCHEMA.

    ``column`` is the top-level column, ``path`` the leaf.  A file without row groups is one row of 0 rows without a column; where a
    file has no statistics, ``nulls`` is NULL.  Files are listed by Spark; tasks open them and read the footers only.  With
    ``whole`` (default: where the scheme is none of OPENED) Spark reads the files for them, whole.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    if whole is None:
        paths = [path] if isinstance(path, str) else path
        whole = any("://" in p and p.split("://")[0] not in OPENED for p in paths)
    if whole:
        return files.select("path", "content").mapInArrow(_read, SCHEMA)
    return files.select("path").repartition("path").mapInArrow(_read, SCHEMA)  # the listing is a few tasks, the opening many


def table_name(file: str = "file"):
    """The table a file belongs to: the first folder or file of its path that ends in ``.parquet``."""
    return F.regexp_extract(file, r"/([^/]+)\.parquet(?:/|$)", 1)


def stored_profile(chunks: DataFrame, groups: dict[str, list[str]] | None = None) -> DataFrame:
    """(table, group, raw_bytes, stored_bytes, ratio): each table (group NULL), its column groups, and the total (table NULL).

    ``groups`` name columns; without it every column is a group of its own.  The ratio is NULL where nothing is stored.
    """
    rows = chunks.where("column is not null").select(table_name().alias("table"), "column", "raw_bytes", "stored_bytes")
    sums = [F.sum("raw_bytes").alias("raw_bytes"), F.sum("stored_bytes").alias("stored_bytes")]
    if groups is None:
        named = rows.withColumn("group", F.col("column"))
    else:
        named = rows.withColumn("group", F.explode(F.array_compact(F.array(*[F.when(F.col("column").isin(c), g) for g, c in groups.items()]))))
    by_group = named.groupBy("table", "group").agg(*sums)
    whole = rows.rollup("table").agg(*sums).select("table", F.lit(None).cast("string").alias("group"), "raw_bytes", "stored_bytes")
    return by_group.unionByName(whole).withColumn("ratio", F.try_divide("raw_bytes", "stored_bytes"))


def file_counts(chunks: DataFrame) -> DataFrame:
    """(file, table, rows): rows per table and file, per table (file NULL) and in all (table and file NULL)."""
    groups = chunks.select("file", table_name().alias("table"), "row_group", "rows").distinct()
    name = F.regexp_extract("file", r"([^/]+(?:\.parquet/[^/]+)?)$", 1)
    return groups.withColumn("file", name).rollup("table", "file").agg(F.sum("rows").alias("rows")).select("file", "table", "rows")
