"""Linked columnar tables: row numbers as keys, maps from old to new rows, and remapping of every link.

A table holds ``part`` (the unit of data, default ``df_id``) and ``row_id``; links are row numbers of another table of the same part, -1
for none.  A map is a table (df_id, old, new), new NULL for a dropped row.  All maps are planned before any link is rewritten.  Rows
are numbered by ranges of (part, order) and joins are on (part, row), so that a large part spreads over the cluster as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .durable import table as kept
from .ranges import fits, numbered, with_previous

PART = "df_id"


def attach_row_id(df: DataFrame, order: list[str], part: str = PART, fit: bool | None = None) -> DataFrame:
    """``df`` with ``row_id``; ``order`` should tell rows apart (see ``numbered``).  ``fit``, here and below: True where it is known that
    a part of these tables is no more than a task can sort (``ranges.small``), which saves counting."""
    return numbered(df, [part], order, "row_id", fit)


def identity_map(df: DataFrame, part: str = PART) -> DataFrame:
    return df.select(part, F.col("row_id").alias("old"), F.col("row_id").alias("new"))


def dedup_map(df: DataFrame, key: str, part: str = PART, fit: bool | None = None) -> DataFrame:
    """Rows sorted by key, equal keys collapsed on the first: every old row leads to the survivor's new row.

    Where parts fit, one sort of (part, key, row) gives it all; else the distinct keys are numbered by ranges and joined.
    """
    rows = df.select(part, key, "row_id")
    if fits(rows, [part]) if fit is None else fit:
        w = Window.partitionBy(part).orderBy(key, "row_id")
        first = (F.row_number().over(w) == 1) | ~F.col(key).eqNullSafe(F.lag(key).over(w))
        j = rows.withColumn("survives", first).withColumn("new", F.sum(F.col("survives").cast("long")).over(w) - 1)
        return j.select(part, F.col("row_id").alias("old"), "new", "survives")
    keys = numbered(df.groupBy(part, key).agg(F.min("row_id").alias("_first")), [part], [key], "new", False).withColumnsRenamed({part: "_part", key: "_key"})
    j = rows.join(keys, (F.col(part) == F.col("_part")) & F.col(key).eqNullSafe(F.col("_key")))
    return j.select(part, F.col("row_id").alias("old"), "new", (F.col("row_id") == F.col("_first")).alias("survives"))


def linked(df: DataFrame, link: str, target_map: DataFrame, part: str = PART) -> DataFrame:
    """(part, row_id, link's new value): -1 for no link, a dangling one, or a dropped target."""
    m = target_map.select(part, F.col("old").alias(link), F.col("new").alias("_to"))
    return df.join(m, [part, link], "left").withColumn("_to", F.coalesce("_to", F.lit(-1)).cast("long"))


def reorder_map(df: DataFrame, link: str, target_map: DataFrame, part: str = PART, fit: bool | None = None) -> DataFrame:
    """Stable order by the remapped link, rows without a link last."""
    j = linked(df, link, target_map, part).select(part, "row_id", (F.col("_to") < 0).alias("_none"), "_to")
    return numbered(j, [part], ["_none", "_to", "row_id"], "new", fit, ["row_id"]).select(part, F.col("row_id").alias("old"), "new")


def keyed_dedup_map(df: DataFrame, link: str, target_map: DataFrame, keys: list[str], part: str = PART, fit: bool | None = None) -> DataFrame:
    """As ``reorder_map``; of rows with equal new link and keys the first survives and the others lead to it.  Rows without a link stay."""
    j = linked(df, link, target_map, part)
    alone = F.when(F.col("_to") < 0, F.col("row_id"))
    first = F.min("row_id").over(Window.partitionBy(part, "_to", alone, *keys))
    kept = j.withColumn("_first", first).select(part, "row_id", (F.col("_to") < 0).alias("_none"), "_to", "_first")
    survivors = numbered(kept.where("row_id = _first").drop("row_id"), [part], ["_none", "_to", "_first"], "new", fit).select(part, "_first", "new")
    return kept.join(survivors, [part, "_first"]).select(part, F.col("row_id").alias("old"), "new", (F.col("row_id") == F.col("_first")).alias("survives"))


def drop_orphans(df: DataFrame, link: str, target_map: DataFrame, part: str = PART, fit: bool | None = None) -> DataFrame:
    """Rows whose parent row itself was dropped or collapsed go with it; the rest are ordered by the remapped link."""
    alive = target_map if "survives" in target_map.columns else target_map.withColumn("survives", F.col("new").isNotNull())
    m = alive.select(part, F.col("old").alias(link), F.when(F.col("survives"), F.col("new")).alias("_to"))
    j = df.join(m, [part, link], "left").withColumn("_gone", (F.col(link) >= 0) & F.col("_to").isNull()).withColumn("_to", F.coalesce("_to", F.lit(-1)).cast("long"))
    j = j.select(part, "row_id", F.coalesce("_gone", F.lit(False)).alias("_gone"), (F.col("_to") < 0).alias("_none"), "_to")
    n = numbered(j, [part, "_gone"], ["_none", "_to", "row_id"], "new", fit, ["row_id"])
    return n.select(part, F.col("row_id").alias("old"), F.when(~F.col("_gone"), F.col("new")).alias("new"))


def follow_parent(df: DataFrame, parent_map: DataFrame, part: str = PART) -> DataFrame:
    """The map of a table whose row N belongs to row N of its parent.  Parts with other row counts keep their own order."""
    same = df.groupBy(part).agg(F.count("*").alias("_n")).join(parent_map.groupBy(part).agg(F.count("*").alias("_m")), part)
    same = same.where("_n = _m").select(part).withColumn("_ok", F.lit(True))
    m = parent_map.select(part, F.col("old").alias("row_id"), F.when(_alive(parent_map), F.col("new")).alias("_new"))
    j = df.select(part, "row_id").join(m, [part, "row_id"], "left").join(same, part, "left")
    return j.select(part, F.col("row_id").alias("old"), F.when(F.col("_ok"), F.col("_new")).otherwise(F.col("row_id")).alias("new"))


def _pasted(df: DataFrame, parent_map: DataFrame, part: str = PART) -> bool:
    """Has ``df`` in each part as many rows as the table of ``parent_map``?  One boolean."""
    own, of = df.groupBy(part).agg(F.count("*").alias("_n")), parent_map.groupBy(part).agg(F.count("*").alias("_m"))
    return own.join(of, part, "full").where(~F.col("_n").eqNullSafe(F.col("_m"))).isEmpty()


def _alive(m: DataFrame):
    return F.col("survives") if "survives" in m.columns else F.col("new").isNotNull()


def remap(df: DataFrame, link: str, target_map: DataFrame, kind: str = "scalar", part: str = PART) -> DataFrame:
    """``df`` with ``link`` rewritten.  Arrays keep length and order; a slice (first, last) is rewritten at both ends."""
    as_map = target_map.select(part, F.col("old").alias("_old"), F.col("new").alias("_new"))
    if kind == "scalar":
        j = df.join(as_map.withColumnRenamed("_old", link), [part, link], "left")
        return j.withColumn(link, F.coalesce("_new", F.lit(-1)).cast(df.schema[link].dataType)).drop("_new").select(*df.columns)
    if kind == "array":
        items = df.select(part, "row_id", F.posexplode(link).alias("_pos", "_old")).join(as_map, [part, "_old"], "left")
        items = items.groupBy(part, "row_id").agg(F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("_new", F.lit(-1)).alias("_v")))).alias("_items"))
        j = df.join(items, [part, "row_id"], "left")
        empty = F.when(F.col(link).isNotNull(), F.array().cast(df.schema[link].dataType))
        return j.withColumn(link, F.coalesce(F.transform("_items", lambda x: x["_v"]).cast(df.schema[link].dataType), empty)).drop("_items").select(*df.columns)
    for end in ("first", "last"):
        m = as_map.select(part, F.col("_old").alias(f"_{end}"), F.col("_new").alias(f"_to_{end}"))
        df = df.withColumn(f"_{end}", F.col(link)[end].cast("long")).join(m, [part, f"_{end}"], "left")
    lo, hi = (F.coalesce(f"_to_{end}", F.lit(-1)).cast("int") for end in ("first", "last"))
    return df.withColumn(link, F.struct(F.least(lo, hi).alias("first"), F.greatest(lo, hi).alias("last"))).drop("_first", "_last", "_to_first", "_to_last")


def renumber(df: DataFrame, own_map: DataFrame, part: str = PART) -> DataFrame:
    """Rows under their new numbers; dropped and collapsed rows go."""
    m = own_map.where(_alive(own_map)).select(part, F.col("old").alias("row_id"), F.col("new").alias("_new"))
    return df.join(m, [part, "row_id"]).withColumn("row_id", F.col("_new").cast("long")).drop("_new").select(*df.columns)


def grouped_by(df: DataFrame, link: str, part: str = PART, fit: bool | None = None) -> bool:
    """Is the table, in every part, sorted by this link with missing links last?  One aggregation, one boolean."""
    bad = (F.col(link) >= 0) & ((F.col("_prev") < 0) | (F.col("_prev") > F.col(link)))
    return with_previous(df.select(part, "row_id", link), [part], "row_id", link, fit=fit).where(bad).isEmpty()


def plan_maps(tables: dict[str, DataFrame], registry: dict[str, dict], part: str = PART, max_passes: int = 8, fit: bool | None = None) -> dict[str, DataFrame]:
    """A map per table of the registry.

    Entries: ``key`` (a key table), ``paste`` (row N belongs to row N of that table), ``sort`` (link to order by), ``dedup`` (columns
    that with the sorted link identify a row), ``follow_drops`` (rows go with their parent), ``links`` {column: (target, kind)}.  Other
    tables that are grouped by a link on input are ordered by it again, in passes up to a fixed point or ``max_passes``.  Each map is
    written out once, as several links go by it: three or four columns a row.  Unless ``fit``, a pasted table with the rows of its
    parent goes by the parent's map.
    """
    maps: dict[str, DataFrame] = {}
    same: dict[str, bool] = {}

    def ordered(make, name: str, link: str) -> DataFrame:
        """The map by ``link``; numbers by ranges are in a table as they are."""
        df, to = tables[name], maps[registry[name]["links"][link][0]]
        whole = fits(df, [part]) if fit is None else fit
        m = make(df, link, to, part, whole)
        return kept(m, "map") if whole else m

    def pasted(name: str) -> DataFrame:
        df, parent = tables[name], maps[registry[name]["paste"]]
        if name not in same:
            same[name] = not fit and _pasted(df, parent, part)
        return parent.select(part, "old", F.when(_alive(parent), F.col("new")).alias("new")) if same[name] else follow_parent(df, parent, part)

    waiting = [t for t in registry if t in tables]
    while waiting:
        for name in list(waiting):
            r, df = registry[name], tables[name]
            sort = r.get("sort")
            needs = r.get("paste") or (r["links"][sort][0] if sort else None)
            if needs in waiting and needs != name:
                continue
            if "key" in r:
                maps[name] = kept(dedup_map(df, r["key"], part, fit), "map")
            elif "paste" in r:
                maps[name] = pasted(name)
            elif sort and r.get("follow_drops"):
                maps[name] = ordered(drop_orphans, name, sort)
            elif sort and r.get("dedup"):
                maps[name] = kept(keyed_dedup_map(df, sort, maps[needs], r["dedup"], part, fit), "map")
            elif sort:
                maps[name] = ordered(reorder_map, name, sort)
            else:
                maps[name] = identity_map(df, part)
            waiting.remove(name)
            break
        else:
            raise ValueError(f"tables wait for each other: {waiting}")
    free = {}
    for name, r in registry.items():
        if name in tables and not {"key", "paste", "sort"} & r.keys():
            scalar = [c for c, (t, k) in r.get("links", {}).items() if k == "scalar" and t != name and t in tables]
            if found := next((c for c in scalar if grouped_by(tables[name], c, part, fit)), None):
                free[name] = found
    done: dict[str, int] = {}
    for turn in range(max_passes):
        # a table is ordered again when its target's map was made anew in the turn before
        now = [n for n, c in free.items() if n not in done or done.get(registry[n]["links"][c][0], -1) == turn - 1 and done[n] < turn]
        if not now:
            break
        for name in now:
            link = free[name]
            maps[name] = ordered(reorder_map, name, link)
            done[name] = turn
    for name, r in registry.items():
        if name in tables and "paste" in r:
            maps[name] = pasted(name)
    return maps


def rewrite(tables: dict[str, DataFrame], registry: dict[str, dict], part: str = PART, maps: dict[str, DataFrame] | None = None, fit: bool | None = None) -> dict[str, DataFrame]:
    """All tables sorted, deduplicated and with every link remapped; tables outside the registry pass unchanged.

    Unless ``fit``, each new table is written out, so that no more than the shuffles of one stay on disk at a time.
    """
    maps = maps or plan_maps(tables, registry, part, fit=fit)
    out = {}
    for name, df in tables.items():
        if name in registry:
            for link, (target, kind) in registry[name].get("links", {}).items():
                if target in maps:
                    df = remap(df, link, maps[target], kind, part)
            df = renumber(df, maps[name], part)
            df = df if fit else kept(df, "rewritten")
        out[name] = df
    return out


def deref(df: DataFrame, link: str, target: DataFrame, part: str = PART) -> DataFrame:
    """Rows with the columns of the row they point to."""
    t = target.withColumnRenamed("row_id", link)
    return df.join(t, [part, link])


def truncate_to_parent(child: DataFrame, parent: DataFrame, part: str = PART) -> DataFrame:
    n = parent.groupBy(part).agg(F.count("*").alias("_n"))
    return child.join(n, part).where("row_id < _n").drop("_n")


def merge_folders(dfs: list[DataFrame], links: dict[str, list[DataFrame]], part: str = PART) -> DataFrame:
    """Blocks of one table put one after the other: row numbers and links move by the rows of earlier blocks.

    ``links`` names for each link column the blocks of its target, in the same order.
    """
    def starts(blocks: list[DataFrame]) -> DataFrame:
        sizes = None
        for k, b in enumerate(blocks):
            s = b.groupBy(part).agg(F.count("*").alias("n")).withColumn("block", F.lit(k))
            sizes = s if sizes is None else sizes.unionByName(s)
        w = Window.partitionBy(part).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        return sizes.select(part, "block", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("start"))

    own, targets, out = starts(dfs), {c: starts(b) for c, b in links.items()}, None
    for k, df in enumerate(dfs):
        move = own.where(F.col("block") == k).select(part, "start")
        cols = df.columns
        df = df.join(move, part).withColumn("row_id", F.col("row_id") + F.col("start")).drop("start")
        for c, s in targets.items():
            df = df.join(s.where(F.col("block") == k).select(part, "start"), part, "left")
            df = df.withColumn(c, F.when(F.col(c) >= 0, F.col(c) + F.coalesce("start", F.lit(0))).otherwise(F.col(c)).cast("long")).drop("start")
        df = df.select(*cols)
        out = df if out is None else out.unionByName(df)
    return out


def zip_columns(a: DataFrame, b: DataFrame, part: str = PART) -> DataFrame:
    """The columns of ``b`` that ``a`` lacks, row by row."""
    new = [c for c in b.columns if c not in a.columns]
    return a.join(b.select(part, "row_id", *new), [part, "row_id"])
