"""Text sources.  Each ``parse_*`` takes lines (a DataFrame with ``value``, and where order matters ``file`` and ``line_no``) and returns
typed rows; each ``read_*`` reads the files and parses them.  Lines that don't fit are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.durable import table

METRIC_SCHEMA = "iter double, name string, timeframe int, cpu double, uss double, pss double, nice double, time double, disc double, cpu_limit double, mem_limit double, ns int, j int"


def numbered_lines(spark: SparkSession, path: str, block_bytes: int | None = None) -> DataFrame:
    """(file, line_no, value): line numbers from 0 per file, exact however large the files.

    Files are read in blocks (of ``block_bytes``, default Spark's own), each by one task that meets its lines in order.  The lines are
    written out once; counts per block, summed up over the blocks before, turn positions in a block into positions in a file.  Lines
    end with a line feed only; the last line may lack it.
    """
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), "value"
    )
    try:
        if block_bytes:
            spark.conf.set(size, str(block_bytes))
        lines = table(lines, "lines")
    finally:
        spark.conf.set(size, before)
    blocks = lines.groupBy("file", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    w = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    blocks = blocks.select("file", "_block", (F.coalesce(F.sum("_n").over(w), F.lit(0)) - F.col("_first")).alias("_move"))
    return lines.join(blocks, ["file", "_block"]).select("file", (F.col("_id") + F.col("_move")).alias("line_no"), "value")


def group(pattern: str, k: int = 1, column: str = "value") -> Column:
    """A group of the first match, NULL without a match."""
    return F.when(F.col(column).rlike(pattern), F.regexp_extract(column, pattern, k))


def parse_metric_log(lines: DataFrame, schema: str = METRIC_SCHEMA) -> DataFrame:
    """``date time,ms LEVEL {dict}``: the dict's fields, ``logged_at`` and ``is_meta`` (a row without an iteration)."""
    prefix = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}),(\d+)\s+\w+\s+(\{.*\})\s*$"
    text = group(prefix, 3)
    for pattern, to in ((r"\bNone\b", "null"), (r"\bTrue\b", "true"), (r"\bFalse\b", "false"), (r"\bnan\b", "null"), ("'", '"')):
        text = F.regexp_replace(text, pattern, to)
    at = F.try_to_timestamp(F.concat_ws(".", group(prefix, 1), group(prefix, 2)), F.lit("yyyy-MM-dd HH:mm:ss.SSS"))
    keep = [c for c in lines.columns if c != "value"]
    rows = lines.select(*keep, at.alias("logged_at"), F.from_json(text, f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    rows = rows.where("logged_at is not null and r is not null and r._bad is null")
    return rows.select(*keep, "logged_at", "r.*").drop("_bad").withColumn("is_meta", F.col("iter").isNull())


def read_metric_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_metric_log(numbered_lines(spark, path))


def parse_time_log(lines: DataFrame, file: str = "file") -> DataFrame:
    """Per file: walltime (usertime if it is 0), cores and MB; files without a wall time are left out."""
    key = lambda k: F.max(F.regexp_extract("value", rf"^\s*#?\s*{k}\s+([0-9.]+)", 1).try_cast("double"))
    g = lines.groupBy(file).agg(key("walltime").alias("w"), key("usertime").alias("u"), key("CPU").alias("c"), key("maxmem").alias("m")).where("w is not null")
    wall = F.when(F.col("w") == 0, F.coalesce("u", F.lit(0.0))).otherwise(F.col("w"))
    return g.select(file, wall.alias("walltime"), (F.col("c") / 100).alias("cpu"), (F.col("m") / 1024).alias("maxmem_mb"))


def read_time_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_time_log(numbered_lines(spark, path))


_OPEN = r"(?:openat2|openat|open|creat)"
_WRITES = "O_WRONLY|O_RDWR|O_CREAT|O_TRUNC|O_APPEND"


def parse_trace(lines: DataFrame) -> DataFrame:
    """Distinct (file, path, kind) of successful opens and renames in call traces (file, line_no, value).

    A call split around another process's entry has its flags on the first half: both halves are paired per file, process and call.
    Directories are left out; a rename writes its destination.
    """
    v = F.col("value")
    cut = lines.select("file", "line_no", "value", group(r"^(\d+)\s+(\w+)\(.*<unfinished", 1).alias("p1"), group(r"^(\d+)\s+(\w+)\(.*<unfinished", 2).alias("c1"),
                       group(r"^(\d+)\s+<\.\.\.\s+(\w+)\s+resumed>", 1).alias("p2"), group(r"^(\d+)\s+<\.\.\.\s+(\w+)\s+resumed>", 2).alias("c2"))
    halves = cut.where("p1 is not null or p2 is not null").withColumns({"pid": F.coalesce("p1", "p2"), "call": F.coalesce("c1", "c2")})
    w = Window.partitionBy("file", "pid", "call").orderBy("line_no")
    before = F.lag(F.when(F.col("p1").isNotNull(), group(r"^\d+\s+\w+\((.*?)<unfinished", 1))).over(w)
    done = halves.withColumn("args", before).where(F.col("p2").isNotNull() & F.col("call").rlike(f"^{_OPEN}$"))
    done = done.select("file", group(r"=\s*\d+<([^>]*)>", 1).alias("path"), F.concat(F.coalesce("args", F.lit("")), F.split(group(r"resumed>(.*)$", 1), "=")[0]).alias("args"))
    whole = lines.where(~v.contains("<unfinished") & ~v.contains("resumed>"))
    pat = rf"(?:^|\s){_OPEN}\((.*?)\)\s*=\s*\d+<([^>]*)>"
    opened = whole.select("file", group(pat, 2).alias("path"), group(pat, 1).alias("args"))
    both = opened.unionByName(done).where("path is not null and path <> '' and not contains(args, 'O_DIRECTORY')")
    both = both.select("file", "path", F.when(F.col("args").rlike(_WRITES), "write").otherwise("read").alias("kind"))
    moved = whole.where(~v.rlike(pat)).select("file", group(r"(?:^|\s)rename(?:at2?)?\(.*\"((?:[^\"\\]|\\.)*)\"[^\"]*\)\s*=\s*0").alias("path"), F.lit("write").alias("kind"))
    return both.unionByName(moved.where("path is not null")).distinct()


def read_trace(spark: SparkSession, path: str) -> DataFrame:
    return parse_trace(numbered_lines(spark, path))


def parse_access_log(lines: DataFrame) -> DataFrame:
    """``file,mode,pid;pid;…`` with the file perhaps in quotes: (file, mode, pids)."""
    p = r'^"?([^"]+?)"?,(read|write),(.*)$'
    return lines.select(group(p, 1).alias("file"), group(p, 2).alias("mode"), group(p, 3).alias("pids")).where("file is not null")


def parse_action_log(lines: DataFrame) -> DataFrame:
    """(pid, task) of successful finishes in either of two formats."""
    a, b = r"INFO Task (\d+)[^:]*:(\w+) finished with status 0", r"INFO Task pid=(\d+) tid=\d+ (\S+) finished rc=0"
    return lines.select(F.coalesce(group(a, 1), group(b, 1)).alias("pid"), F.coalesce(group(a, 2), group(b, 2)).alias("task")).where("pid is not null").distinct()


def parse_intervals(lines: DataFrame) -> DataFrame:
    """Run, from, to and comment, separated by commas, white space or semicolons; comment lines and bad lines go."""
    parts = F.split(F.trim("value"), r"[,\s;]+", 4)
    x = lines.where(~F.col("value").rlike(r"^\s*(#|$)")).select(*[F.get(parts, F.lit(k)).try_cast("bigint").alias(c) for k, c in enumerate(("run", "lo", "hi"))], F.get(parts, F.lit(3)).alias("message"))
    return x.where("run is not null and lo is not null and hi is not null")


def parse_workflow_path(df: DataFrame, path: str, tag: str) -> DataFrame:
    """Cycle (a single digit, optional), run and split that follow the production tag in a path; others are left out."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    at = F.array_position(parts, tag).cast("int")
    after = F.when(at > 0, F.slice(parts, at + 1, F.size(parts)))
    x = df.withColumn("_a", after).where("size(_a) >= 2")
    cycle = F.col("_a")[0].rlike(r"^\d$")
    x = x.where(~cycle | (F.size("_a") >= 3))
    pick = lambda k: F.when(cycle, F.get("_a", F.lit(k + 1))).otherwise(F.get("_a", F.lit(k)))
    return x.withColumns({"cycle": F.when(cycle, F.col("_a")[0].cast("int")), "run": pick(0).try_cast("int"), "split": pick(1)}).drop("_a").where("run is not null")


def parse_result_path(df: DataFrame, path: str, name: str) -> DataFrame:
    """Period, pass and run: the three folders before a file of this name, whatever its case; the run must be a number."""
    p = rf"(?i)(?:^|/)([^/]+)/([^/]+)/(\d+)/{name}(?:/|$)"
    return df.withColumns({"period": group(p, 1, path), "pass": group(p, 2, path), "run": group(p, 3, path).cast("int")}).where("run is not null")


def parse_labels(df: DataFrame, path: str) -> DataFrame:
    """First and last 13-digit timestamp in a file's name."""
    p = r"(?:^|[^0-9])(\d{13})[^0-9]+(\d{13})(?:[^0-9]|$)"
    return df.withColumns({"lo": group(p, 1, path).cast("bigint"), "hi": group(p, 2, path).cast("bigint")}).where("lo is not null")


def read_stages(spark: SparkSession, path: str) -> DataFrame:
    """The stages of workflow files."""
    schema = "stages array<struct<name: string, cmd: string, needs: array<string>, cwd: string, timeframe: int, labels: array<string>, resources: struct<cpu: double, mem: double, relative_cpu: double>>>"
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode("stages").alias("s")).select("s.*")


def need_edges(stages: DataFrame) -> DataFrame:
    return stages.select("name", F.explode("needs").alias("need"))


def parse_commands(lines: DataFrame) -> DataFrame:
    """(line_no, executable, group, key, value): options of each command, and the entries of its ``--configKeyValues``.

    Plain options have group NULL; an option without a value has ``true``.
    """
    exe = F.regexp_extract("value", r"^\s*(\S+)", 1)
    pairs = F.regexp_extract_all("value", F.lit(r"\s(--[A-Za-z][\w-]*|-[A-Za-z])(?=\s|$)(?:\s+(?!-)(\"[^\"]*\"|'[^']*'|\S+))?"), F.lit(1))
    values = F.regexp_extract_all("value", F.lit(r"\s(--[A-Za-z][\w-]*|-[A-Za-z])(?=\s|$)(?:\s+(?!-)(\"[^\"]*\"|'[^']*'|\S+))?"), F.lit(2))
    z = lines.select("line_no", exe.alias("executable"), F.explode(F.arrays_zip(pairs.alias("k"), values.alias("v"))).alias("o"))
    z = z.select("line_no", "executable", F.col("o.k").alias("key"), F.regexp_replace("o.v", "^[\"']|[\"']$", "").alias("value"))
    plain = z.where("key <> '--configKeyValues'").select("line_no", "executable", F.lit(None).cast("string").alias("group"), "key", F.when(F.col("value") == "", "true").otherwise(F.col("value")).alias("value"))
    inner = z.where("key = '--configKeyValues'").select("line_no", "executable", F.explode(F.str_to_map("value", F.lit(";"), F.lit("="))).alias("k", "value"))
    inner = inner.where("contains(k, '.')").select("line_no", "executable", F.trim(F.split("k", r"\.", 2)[0]).alias("group"), F.trim(F.split("k", r"\.", 2)[1]).alias("key"), "value")
    return plain.unionByName(inner)


def last_written(settings: DataFrame, blocked: list[str] = ()) -> DataFrame:
    """Per executable, group and key the value of the last line; blocked groups and keys are left out."""
    s = settings.where(~F.coalesce(F.col("group"), F.lit("")).isin(list(blocked)) & ~F.col("key").isin(list(blocked))) if blocked else settings
    return s.groupBy("executable", "group", "key").agg(F.max_by("value", "line_no").alias("value"))


def parse_metadata_blocks(df: DataFrame, text: str, ident: str) -> DataFrame:
    """(id, block, key, value, kind): ``k = v`` lines after each ``Metadata:`` line up to a blank line; ``None`` is NULL."""
    blocks = df.select(ident, F.posexplode(F.split(text, "Metadata:\n")).alias("block", "body")).where("block > 0")
    lines = blocks.select(ident, "block", F.explode(F.split(F.split("body", r"\n\s*\n", 2)[0], "\n")).alias("value"))
    p = r"^\s*(\w+)\s*=\s*(.+)"
    x = lines.select(ident, "block", group(p, 1).alias("key"), F.trim(group(p, 2)).alias("value")).where("key is not null")
    kind = F.when(F.col("value") == "None", "none").when(F.col("value").rlike(r"^-?\d+$"), "int").when(F.col("value").try_cast("double").isNotNull(), "float").otherwise("string")
    return x.withColumn("kind", kind).withColumn("value", F.when(F.col("kind") != "none", F.col("value")))


def parse_batch_list(lines: DataFrame) -> DataFrame:
    """(run, period) pairs; blank lines and comments are dropped."""
    x = F.trim(F.regexp_replace("value", "#.*$", ""))
    parts = F.split(x, r"\s+")
    return lines.where(x != "").select(F.get(parts, F.lit(0)).try_cast("int").alias("run"), F.get(parts, F.lit(1)).alias("period")).where("run is not null")


def parse_job_description(df: DataFrame, text: str, ident: str) -> DataFrame:
    """(id, key, value) of ``Key = value;`` statements, which may span lines."""
    flat = F.regexp_replace(F.regexp_replace(F.col(text), r"(?m)^.*LPMMetaData.*$", ""), "\n", "")
    x = df.select(ident, F.explode(F.split(flat, ";")).alias("s")).where("contains(s, ' = ')")
    return x.select(ident, F.trim(F.split("s", " = ", 2)[0]).alias("key"), F.trim(F.split("s", " = ", 2)[1]).alias("value"))
