"""Shared helpers: durable intermediate tables, word rules and connected components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

_own: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` of the session; on one machine, where that is unset, our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="spark-")
            atexit.register(shutil.rmtree, _own[app], True)
        base = "file://" + _own[app]
    return f"{base.rstrip('/')}/{app}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and fixes any generated row numbers.

    The write's shuffle files are of no further use and are removed when it ends.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text):
    """Lower-case A-Z only.  Texts that are all ASCII take Spark's quick ``lower``, the others a translation."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``, the root being the component's smallest node.

    Each round hooks every node on its smallest neighbour and contracts the graph, which at least halves the nodes of every
    component; the round's tables are written out, so a lost executor costs one round at most.  Hot nodes only meet partial
    aggregation and skew-splittable joins.  Only the count of the edges left comes to the driver.
    """
    edges = table(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = table(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")), "labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("from"), F.least("a", "m").alias("to"))
        hook = table(hook, "hook")
        labels = table(
            labels.join(hook, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root")), "labels"
        )
        left = edges.join(hook, F.col("a") == F.col("from")).select(F.col("to").alias("a"), "b")
        both = left.join(hook, F.col("b") == F.col("from")).select("a", F.col("to").alias("b"))
        edges = table(both.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return labels


def prefix_sums(df: DataFrame, order: list[str], size: str, group: str, name: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``size`` over the rows of the same ``group`` that stand earlier in ``order``.

    ``order`` starts with ``group``.  Rows are dealt by range, so a hot group spreads over many tasks; each task sums its own
    rows and only one total per task and group meets in a window.
    """
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    local = table(dealt.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), name)
    run = Window.partitionBy("part", group).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = local.withColumn("own", F.coalesce(F.sum(size).over(run), F.lit(0)))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = df_totals(local, group, size).withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
    totals = totals.select(F.col("part").alias("p"), F.col(group).alias("g"), "base")
    out = local.join(totals, (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g")))
    return out.withColumn("before", F.col("own") + F.col("base")).drop("part", "at", "own", "p", "g", "base")


def df_totals(local: DataFrame, group: str, size: str) -> DataFrame:
    return local.groupBy("part", group).agg(F.sum(size).alias("total"))
