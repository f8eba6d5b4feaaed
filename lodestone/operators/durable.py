"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The application's folder in ``spark.checkpoint.dir``; on one machine, where that is unset, a temporary one."""
    base, sc = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if sc.applicationId not in _own:
            _own[sc.applicationId] = tempfile.mkdtemp(prefix="spark-")
            atexit.register(shutil.rmtree, _own[sc.applicationId], True)
        base = "file://" + _own[sc.applicationId]
    return f"{base.rstrip('/')}/{sc.applicationId}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back: cuts the lineage and fixes what depends on the partitions of a row.

    The write's shuffle files are of no further use and are removed when it ends.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, **what: Column) -> tuple[DataFrame, dict]:
    """As ``table``, with aggregates of the rows observed while they are written."""
    seen = Observation()
    out = table(df.observe(seen, *[c.alias(n) for n, c in what.items()]), name)
    return out, seen.get
