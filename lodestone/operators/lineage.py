"""File and task lineage, workflow graphs, and their comparison."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import counted, table


def attribute(access: DataFrame, actions: DataFrame) -> DataFrame:
    """(file, kind, task): any process in an access's chain that belongs to a task."""
    chain = access.select("file", "mode", F.explode(F.split("pids", ";")).alias("pid")).where("pid <> ''")
    return chain.join(actions.select("pid", "task"), "pid").select("file", F.col("mode").alias("kind"), "task").distinct()


def report(edges: DataFrame) -> DataFrame:
    """Writers and readers of each file."""
    names = lambda k: F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("task"))))
    return edges.groupBy("file").agg(names("write").alias("written_by"), names("read").alias("read_by"))


def task_report(edges: DataFrame) -> DataFrame:
    names = lambda k: F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("file"))))
    return edges.groupBy("task").agg(names("write").alias("writes"), names("read").alias("reads"))


def template_of(name, kind: str):
    """File ``./tf3/x`` is ``./tfX/x``; task ``t_3`` is ``t_X``."""
    return F.regexp_replace(name, r"(^|/)tf[0-9]+/", "$1tfX/") if kind == "file" else F.regexp_replace(name, r"_[0-9]+$", "_X")


def templates(edges: DataFrame) -> DataFrame:
    """Edges of templates with the timeframes they come from."""
    tf = F.regexp_extract("file", r"(?:^|/)tf([0-9]+)/", 1)
    t = edges.select(template_of(F.col("file"), "file").alias("file"), "kind", template_of(F.col("task"), "task").alias("task"), F.when(tf != "", tf.cast("int")).alias("tf"))
    return t.groupBy("file", "kind", "task").agg(F.array_sort(F.collect_set("tf")).alias("timeframes"))


def expand(templated: DataFrame, frames: int, keep: list[str] = ()) -> DataFrame:
    """Template edges for each timeframe 1..frames, edges without a timeframe once; ``keep`` marks files that must not be removed."""
    has = F.col("file").contains("tfX/") | F.col("task").endswith("_X")
    t = templated.withColumn("tf", F.explode(F.when(has, F.sequence(F.lit(1), F.lit(frames))).otherwise(F.array(F.lit(None).cast("int")))))
    put = lambda c, pat, pre: F.when(F.col("tf").isNull(), F.col(c)).otherwise(F.regexp_replace(F.col(c), F.lit(pat), F.concat(F.lit(pre), F.col("tf").cast("string"))))
    kept = F.col("file").rlike("|".join(keep)) if keep else F.lit(False)
    return t.select(put("file", "tfX", "tf").alias("file"), "kind", put("task", "_X$", "_").alias("task"), "tf", kept.alias("keep"))


def keep_files(df: DataFrame, base: str, drop: list[str] = ()) -> DataFrame:
    """Files below the base folder under their relative names, without logs and files that a pattern finds."""
    x = df.where(F.col("file").startswith(base)).withColumn("file", F.concat(F.lit("."), F.substring("file", len(base) + 1, 1 << 30)))
    x = x.where(~F.col("file").rlike(r"\.log(\.[^/]*)?$"))
    return x.where(~F.col("file").rlike("|".join(f"(?:{p})" for p in drop))) if drop else x


def verdict(ref: DataFrame, cand: DataFrame) -> DataFrame:
    """Per file: edges of both, missing and extra ones, recall, and EXACT, SAFE (nothing missing) or UNSAFE."""
    key = ["file", "kind", "task"]
    r, c = ref.select(*key).distinct().withColumn("r", F.lit(1)), cand.select(*key).distinct().withColumn("c", F.lit(1))
    j = r.join(c, key, "full")
    n = lambda x: F.count_if(x)
    g = j.groupBy("file").agg(
        n(F.col("r").isNotNull() & F.col("c").isNotNull()).alias("common"), n(F.col("c").isNull()).alias("missing"), n(F.col("r").isNull()).alias("extra")
    )
    recall = F.when(F.col("common") + F.col("missing") > 0, F.col("common") / (F.col("common") + F.col("missing"))).otherwise(1.0)
    v = F.when(F.col("missing") > 0, "UNSAFE").when(F.col("extra") > 0, "SAFE").otherwise("EXACT")
    return g.withColumn("recall", recall).withColumn("verdict", v)


def worst(verdicts: DataFrame) -> DataFrame:
    rank = F.when(F.col("verdict") == "UNSAFE", 2).when(F.col("verdict") == "SAFE", 1).otherwise(0)
    return verdicts.agg(F.element_at(F.array(*map(F.lit, ("EXACT", "SAFE", "UNSAFE"))), F.max(rank) + 1).alias("verdict"), F.count("*").alias("files"))


def check_stages(names: DataFrame, needs: DataFrame) -> DataFrame:
    """(name, problem): needed but undefined tasks, and names defined more than once."""
    undefined = needs.select(F.col("need").alias("name")).distinct().join(names, "name", "left_anti").withColumn("problem", F.lit("undefined"))
    twice = names.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name", F.lit("duplicate").alias("problem"))
    return undefined.unionByName(twice)


def _climb(up: DataFrame) -> tuple[DataFrame, dict]:
    """``up(node, up, far)``, one row per node, with ``up`` replaced by the first node above that has no row (or NULL) and ``far`` summed.

    Each round doubles the steps taken, so a chain of n nodes takes log2(n) rounds.  Nodes in a ring, and those whose way up ends in one,
    are left out.  Also returns how many nodes there were (n) and how many of them don't end at NULL (open).
    """
    for turn in count():
        above = up.select(F.col("node").alias("_n"), F.col("up").alias("_u"), F.col("far").alias("_f"))
        moved = F.col("_n").isNotNull()
        step = up.join(above, F.col("up") == F.col("_n"), "left").select(
            "node", F.when(moved, F.col("_u")).otherwise(F.col("up")).alias("up"), (F.col("far") + F.coalesce("_f", F.lit(0))).alias("far"), moved.alias("moved")
        )
        up, seen = counted(step, "up", n=F.count(F.lit(1)), moved=F.count_if("moved"), open=F.count("up"))
        if not seen["moved"] or 1 << turn > seen["n"]:
            return up.where("not moved").drop("moved"), seen


def closure(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """All nodes reached from ``seeds(node)`` along ``edges(src, dst)``, the seeds included.

    A node with one edge into it is reached with its predecessor, so chains and trees are first drawn together to the node above
    them (``_climb``); rounds then follow what is left, one join of the newest nodes each, until a round adds none.  Nothing stays
    cached.
    """
    edges = table(edges.select("src", "dst").where("src is not null and dst is not null").distinct(), "edges")
    seeds = table(seeds.select("node").where("node is not null").distinct(), "seeds")
    single = edges.groupBy("dst").agg(F.count("*").alias("n"), F.min("src").alias("up")).where("n = 1")
    drawn, _ = _climb(single.select(F.col("dst").alias("node"), "up", F.lit(1).alias("far")).join(seeds, "node", "left_anti"))
    drawn = drawn.where("up is not null").select("node", "up")
    rest = edges.join(single.select("dst").join(seeds.withColumnRenamed("node", "dst"), "dst", "left_anti"), "dst", "left_anti")
    to = drawn.select(F.col("node").alias("src"), "up")
    rest = table(rest.join(to, "src", "left").select(F.coalesce("up", "src").alias("src"), "dst").where("src <> dst").distinct(), "rest")
    front = seen = seeds
    while True:
        front = rest.join(front, rest["src"] == front["node"]).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti")
        front, found = counted(front, "front", n=F.count(F.lit(1)))
        if not found["n"]:
            return seen.unionByName(drawn.join(seen.withColumnRenamed("node", "up"), "up", "left_semi").select("node"))
        seen = seen.unionByName(front)


def satisfiable(names: DataFrame, needs: DataFrame) -> DataFrame:
    """Tasks all of whose needs exist, directly and over others.  ``needs`` holds (name, need)."""
    bad = needs.join(names.select(F.col("name").alias("need")), "need", "left_anti").select(F.col("name").alias("node"))
    reverse = needs.select(F.col("need").alias("src"), F.col("name").alias("dst"))
    return names.select("name").distinct().join(closure(reverse, bad).withColumnRenamed("node", "name"), "name", "left_anti")


def _lengths(edges: DataFrame) -> DataFrame:
    """(node, length): the longest sum of ``weight`` over ``edges(src, dst, weight)`` from the root, the NULL ``src``, to each node.

    A node with one edge into it is as far as the node above it and that edge, so all such nodes are drawn to the first node above
    that has several, edges that then join the same two nodes become their longest one, and so on.  Nodes all whose predecessors are
    drawn to the root have one edge left, so every round settles at least what a round by levels would, and chains, trees and
    parallel ways of any depth in one.  Nodes in or behind a cycle, or behind a node that the root doesn't reach, are left out.
    """
    edges = table(edges.groupBy("src", "dst").agg(F.max("weight").alias("weight")), "edges")
    open_, done = None, []
    while True:
        single = edges.groupBy("dst").agg(F.count("*").alias("n"), F.min("src").alias("up"), F.max("weight").alias("far")).where("n = 1")
        single = single.select(F.col("dst").alias("node"), "up", "far")
        drawn, seen = _climb(single)
        if not seen["n"]:
            break
        above = drawn.select(F.col("node").alias("_n"), F.col("up").alias("_u"), F.col("far").alias("_f"))
        if open_ is not None:  # drawn before, to a node that is drawn now
            moved = open_.join(above, F.col("up") == F.col("_n"), "left")
            moved = moved.select("node", F.when(F.col("_n").isNotNull(), F.col("_u")).otherwise(F.col("up")).alias("up"), (F.col("far") + F.coalesce("_f", F.lit(0))).alias("far"))
            drawn, seen = counted(drawn.unionByName(moved), "drawn", open=F.count("up"))
        done.append(drawn.where("up is null").select("node", F.col("far").alias("length")))
        open_ = drawn.where("up is not null") if seen["open"] else None
        rest = edges.join(single.select(F.col("node").alias("dst")), "dst", "left_anti").join(above, F.col("src") == F.col("_n"), "left")
        rest = rest.select(F.when(F.col("_n").isNotNull(), F.col("_u")).otherwise(F.col("src")).alias("src"), "dst", (F.col("weight") + F.coalesce("_f", F.lit(0))).alias("weight"))
        edges = table(rest.groupBy("src", "dst").agg(F.max("weight").alias("weight")), "edges")
    out = edges.select(F.col("dst").alias("node"), F.col("weight").alias("length")).where("false")
    return reduce(DataFrame.unionByName, done, out)


def levels(names: DataFrame, needs: DataFrame) -> DataFrame:
    """Topological level of each task, 0 without needs; NULL for tasks in or behind a cycle or an undefined need."""
    names = names.select("name").distinct()
    edges = needs.select(F.col("need").alias("src"), F.col("name").alias("dst"), F.lit(1).alias("weight")).where("src is not null").join(names.withColumnRenamed("name", "dst"), "dst", "left_semi").select("src", "dst", "weight")
    first = names.withColumnRenamed("name", "dst").join(edges, "dst", "left_anti")
    found = _lengths(edges.unionByName(first.select(F.lit(None).cast(edges.schema["src"].dataType).alias("src"), "dst", F.lit(0).alias("weight"))))
    return names.join(found.select(F.col("node").alias("name"), F.col("length").alias("level")), "name", "left")


def longest_path(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, length): a node's weight (0 or more) and the longest sum of weights below it, for an acyclic graph.

    Edges to or from other names than those of ``nodes`` don't count.  A cycle raises an error.
    """
    nodes = table(nodes.select("name", F.col("weight").cast("long").alias("weight")).groupBy("name").agg(F.max("weight").alias("weight")), "nodes")
    known = nodes.select("name")
    below = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")).distinct()
    below = below.join(known.withColumnRenamed("name", "src"), "src", "left_semi").join(nodes.withColumnRenamed("name", "dst"), "dst").select("src", "dst", "weight")
    below = table(below, "below")
    leaves = nodes.withColumnRenamed("name", "dst").join(below, "dst", "left_anti").select(F.lit(None).cast(below.schema["src"].dataType).alias("src"), "dst", "weight")
    found = table(nodes.select("name").join(_lengths(below.unionByName(leaves)).withColumnRenamed("node", "name"), "name", "left"), "lengths")
    if not found.where("length is null").isEmpty():
        raise ValueError("the graph has a cycle")
    return found


def replicate(stages: DataFrame, frames: int) -> DataFrame:
    """Template stages (name ending in _1, timeframe 1) copied to each timeframe; needs follow, global needs of frames are expanded.

    Stages with timeframe below 1 stay alone; their needs on template stages become needs on all copies.
    """
    framed = stages.where("timeframe >= 1").withColumn("tf", F.explode(F.sequence(F.lit(1), F.lit(frames))))
    number = lambda c: F.regexp_replace(c, F.lit("_1$"), F.concat(F.lit("_"), F.col("tf").cast("string")))
    copies = framed.select(number(F.col("name")).alias("name"), F.col("tf").alias("timeframe"), F.transform("needs", number).alias("needs"))
    spread = lambda x: F.when(x.rlike("_1$"), F.transform(F.sequence(F.lit(1), F.lit(frames)), lambda k: F.regexp_replace(x, F.lit("1$"), k.cast("string")))).otherwise(F.array(x))
    alone = stages.where("timeframe < 1").select("name", "timeframe", F.flatten(F.transform("needs", spread)).alias("needs"))
    return copies.unionByName(alone)


def releasable(listed: DataFrame, finished: DataFrame) -> DataFrame:
    """Files all of whose listed tasks have finished."""
    j = listed.join(finished.select("task").distinct().withColumn("f", F.lit(True)), "task", "left")
    return j.groupBy("file").agg(F.bool_and(F.coalesce("f", F.lit(False))).alias("releasable"))
