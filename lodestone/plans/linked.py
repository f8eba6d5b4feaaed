"""Linked-table queries: orders as the key table, lineitem as the table that points to it, in eight parts."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import checks, durable, links, ranges
from ..sources import tables as sources
from .tables import read

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@lru_cache(16)
def _small(spark, d):
    return ranges.small(read(spark, d, "orders"), read(spark, d, "lineitem"))


def fit(spark, d):
    """Are the tables, by their files' row counts, so small that no part needs counting?"""
    return _small(spark, d)


def orders(spark, d, columns=None):
    """Orders with all their ``columns`` or those named."""
    o = read(spark, d, "orders").withColumn("df_id", (F.col("o_custkey") % 8).cast("int"))
    return links.attach_row_id(o.select("df_id", *columns) if columns else o, ["o_orderkey"], fit=fit(spark, d))


def _starts(o, ln):
    """``o`` with the number of the first of each order's lines; None if an order has more lines than a task may sort."""
    n, seen = durable.counted(ln.groupBy("l_orderkey").agg(F.count("*").alias("_n")), "counts", most=F.max("_n"))
    if (seen["most"] or 0) > ranges.TASK_ROWS:
        return None
    n = o.join(n, "l_orderkey", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    return ranges.running(n, ["df_id"], ["_row"], {"_end": F.col("_n")}).withColumn("_start", F.col("_end") - F.col("_n")).drop("_n", "_end")


def lines(spark, d, o=None):
    """Lines with ``order_row``, -1 for every seventh part key; the row number follows all columns.

    In large tables lines are numbered within their order, from the number of its first line on: they are shuffled once.  ``o``: the
    numbered orders, where they are at hand.
    """
    o, ln = (o or orders(spark, d, ["o_orderkey"])).select("df_id", F.col("row_id").alias("_row"), F.col("o_orderkey").alias("l_orderkey")), read(spark, d, "lineitem")
    starts = None if fit(spark, d) else _starts(o, ln)
    j = ln.join(o if starts is None else starts, "l_orderkey")
    j = j.withColumn("order_row", F.when(F.col("l_partkey") % 7 == 0, -1).otherwise(F.col("_row")).cast("long"))
    if starts is None:
        return links.attach_row_id(j.drop("_row"), LINE_ORDER, fit=fit(spark, d))
    w = Window.partitionBy("df_id", "l_orderkey")
    at = F.min("_start").over(w) + F.row_number().over(w.orderBy(*LINE_ORDER[1:], "_row")) - 1
    return j.withColumn("row_id", at.cast("long")).drop("_row", "_start")


BASE = """
o as (
  select o_custkey % 8 as df_id, *, row_number() over (partition by o_custkey % 8 order by o_orderkey) - 1 as row_id from orders
), l as (
  select df_id, l.*, case when l_partkey % 7 = 0 then -1 else row_id end as order_row,
         row_number() over (partition by df_id order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 as row_id
  from lineitem l join (select df_id, row_id, o_orderkey from o) on l_orderkey = o_orderkey
), om as (
  select df_id, row_id as old, dense_rank() over (partition by df_id order by o_orderdate) - 1 as new, row_id = min(row_id) over (partition by df_id, o_orderdate) as survives from o
)"""


def key_dedup_map(spark, d):
    return links.dedup_map(orders(spark, d), "o_orderdate", fit=fit(spark, d))


def remap_links(spark, d):
    m = links.dedup_map(orders(spark, d), "o_orderdate", fit=fit(spark, d))
    return links.remap(lines(spark, d).select("df_id", "row_id", "order_row"), "order_row", m)


def table_scan(spark, d):
    """Two tables of a folder, of each the columns that are asked for."""
    t = sources.scan(spark, d, ["customer.parquet", "supplier.parquet"], {"customer.parquet": ["c_custkey", "c_nationkey"], "supplier.parquet": ["s_suppkey", "s_nationkey"]})
    both = t["customer.parquet"].toDF("k", "n").withColumn("table", F.lit("customer")).unionByName(t["supplier.parquet"].toDF("k", "n").withColumn("table", F.lit("supplier")))
    return both.groupBy("table", F.col("n").alias("nation")).agg(F.count("*").alias("rows"), F.sum("k").alias("keys"))


def self_link(spark, d):
    """Orders that point to earlier rows of their own table, remapped by the table's own map."""
    o = orders(spark, d)
    back = F.col("row_id") - F.col("o_custkey") % 3 - 1
    o = o.select("df_id", "row_id", "o_orderdate", F.when(back >= 0, back).otherwise(-1).alias("before"))
    return links.remap(o, "before", links.dedup_map(o, "o_orderdate", fit=fit(spark, d))).select("df_id", "row_id", "before")


def remap_arrays(spark, d):
    """Per part key the rows of its orders, as an array and as a slice."""
    m = links.dedup_map(orders(spark, d), "o_orderdate", fit=fit(spark, d))
    g = lines(spark, d).groupBy("df_id", F.col("l_partkey").alias("row_id")).agg(
        F.array_sort(F.collect_list("order_row")).alias("rows"), F.struct(F.min("order_row").alias("first"), F.max("order_row").alias("last")).alias("span")
    )
    out = links.remap(links.remap(g, "rows", m, "array"), "span", m, "slice")
    return out.select("df_id", "row_id", F.array_join(F.col("rows").cast("array<string>"), ",").alias("rows"), F.concat_ws("-", F.col("span.first").cast("string"), F.col("span.last").cast("string")).alias("span"))


def event_dedup(spark, d):
    """Orders point to their date's rank as a first table; equal (date, priority) rows collapse."""
    o = orders(spark, d).withColumn("key_row", F.when(F.col("o_custkey") % 11 == 0, -1).otherwise(F.col("row_id")))
    return links.keyed_dedup_map(o, "key_row", links.dedup_map(o, "o_orderdate", fit=fit(spark, d)), ["o_orderpriority"], fit=fit(spark, d))


def dependent_drop(spark, d):
    m = links.dedup_map(orders(spark, d), "o_orderdate", fit=fit(spark, d))
    return links.drop_orphans(lines(spark, d), "order_row", m, fit=fit(spark, d))


def regroup_nulls_last(spark, d):
    m = links.dedup_map(orders(spark, d), "o_orderdate", fit=fit(spark, d))
    return links.reorder_map(lines(spark, d), "order_row", m, fit=fit(spark, d))


def follow_parent(spark, d):
    m = links.dedup_map(orders(spark, d), "o_orderdate", fit=fit(spark, d))
    child = orders(spark, d).select("df_id", "row_id", "o_totalprice").where("df_id <> 3 or row_id > 0")
    return links.follow_parent(child, m)


def deref_link(spark, d):
    o = orders(spark, d).select("df_id", "row_id", "o_orderkey", "o_orderstatus")
    return links.deref(lines(spark, d).select("df_id", "order_row", "l_linenumber", "l_partkey"), "order_row", o).groupBy("df_id", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("parts"))


REGISTRY = {
    "orders": {"key": "o_orderdate"},
    "lines": {"sort": "order_row", "links": {"order_row": ("orders", "scalar")}},
    "extra": {"paste": "lines"},
    "tags": {"links": {"line_row": ("lines", "scalar")}},
}


def _tables(spark, d):
    o = durable.table(orders(spark, d, ["o_orderkey", "o_orderdate"]), "orders")
    ln = durable.table(lines(spark, d, o).select("df_id", "row_id", "order_row", "l_quantity", "l_tax", "l_discount"), "lines")  # three tables are made of it
    return {
        "orders": o.select("df_id", "row_id", "o_orderdate"),
        "lines": ln.select("df_id", "row_id", "order_row", "l_quantity"),
        "extra": ln.select("df_id", "row_id", "l_tax"),
        "tags": ln.where("row_id % 3 = 0").select("df_id", (F.col("row_id") / 3).cast("long").alias("row_id"), F.col("row_id").alias("line_row"), F.col("l_discount").alias("tag")),
    }


def rewrite_tables(spark, d):
    """The whole rewrite: row counts, sums and links of the tables after it."""
    out = links.rewrite(_tables(spark, d), REGISTRY, fit=fit(spark, d))
    t = out["tags"].select("df_id", F.col("line_row").alias("row_id"), "tag", F.col("row_id").alias("tag_row"))
    a = out["lines"].join(out["extra"], ["df_id", "row_id"]).join(t, ["df_id", "row_id"], "left")
    o = out["orders"].select("df_id", F.col("row_id").alias("order_row"), "o_orderdate")
    return a.join(o, ["df_id", "order_row"], "left").select("df_id", "row_id", "order_row", "l_quantity", "l_tax", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "tag", "tag_row")


def resort_fixpoint(spark, d):
    m = links.plan_maps(_tables(spark, d), REGISTRY, fit=fit(spark, d))["tags"]
    return m.select("df_id", "old", "new")


def link_preservation(spark, d):
    before = _tables(spark, d)
    return checks.link_preservation(before, links.rewrite(before, REGISTRY, fit=fit(spark, d)), REGISTRY)


def merge_folders(spark, d):
    o, ln = orders(spark, d).select("df_id", "row_id", "o_orderkey"), lines(spark, d).select("df_id", "row_id", "order_row", "l_partkey")
    return links.merge_folders([ln, ln.where("df_id < 4")], {"order_row": [o, o]}).groupBy("df_id").agg(
        F.count("*").alias("n"), F.max("row_id").alias("last"), F.sum("order_row").alias("links"), F.count_if(F.col("order_row") < 0).alias("none")
    )


def zip_columns(spark, d):
    o = orders(spark, d)
    return links.zip_columns(o.select("df_id", "row_id", "o_orderkey"), o.select("df_id", "row_id", "o_orderkey", "o_orderpriority")).select("o_orderkey", "o_orderpriority")


def truncate_child(spark, d):
    return links.truncate_to_parent(lines(spark, d).select("df_id", "row_id"), orders(spark, d)).groupBy("df_id").agg(F.count("*").alias("n"), F.max("row_id").alias("last"))


def _days(df):
    return df.withColumn("day", F.datediff("o_orderdate", F.lit("1970-01-01")).cast("long"))


def monotonic_adjacent(spark, d):
    return checks.monotonic(_days(read(spark, d, "orders")), "o_orderkey", "day", ["o_orderpriority"], fit=fit(spark, d))


def monotonic_runmax(spark, d):
    o = _days(read(spark, d, "orders")).withColumn("day", F.when(F.col("o_custkey") % 13 == 0, -1).otherwise(F.col("day")))
    return checks.monotonic_running(o, "o_orderkey", "day", ["o_orderpriority"], fit=fit(spark, d))


def violation_samples(spark, d):
    return checks.violation_samples(_days(read(spark, d, "orders")), "o_orderkey", "day", ["o_orderpriority"], fit=fit(spark, d))


def contiguity(spark, d):
    return checks.contiguity(read(spark, d, "events"), "event_id", "user_id", ["event_type"])


def link_range(spark, d):
    ln = lines(spark, d).withColumn("order_row", F.when(F.col("l_partkey") % 10 == 3, F.col("order_row") + 100000).otherwise(F.col("order_row")))
    return checks.links_in_range(ln, "order_row", orders(spark, d))


def paste_parity(spark, d):
    o = orders(spark, d)
    return checks.paste_parity(o.where("df_id <> 5 or row_id > 2"), o)


def unregistered_links(spark, d):
    """Which columns of the tables look like links, of those that aren't registered."""
    o = read(spark, d, "orders").withColumnsRenamed({"o_custkey": "fIndexCustomers", "o_orderstatus": "sliceStatus"})
    found = checks.unregistered_links(o, ["fIndexCustomers"])
    return o.groupBy().agg(*[F.count(c).alias(c) for c in found])


def mother_daughter(spark, d):
    ln = lines(spark, d).select("df_id", "row_id", "l_orderkey", "l_partkey")
    p = ln.withColumns({
        "mother": F.when(F.col("l_partkey") % 5 == 0, -1).otherwise(F.col("row_id") - F.col("l_partkey") % 3),
        "first_daughter": F.when(F.col("l_partkey") % 4 == 0, -1).otherwise(F.col("row_id") + 1),
        "last_daughter": F.when(F.col("l_partkey") % 6 == 0, -1).otherwise(F.col("row_id") + F.col("l_partkey") % 3),
    })
    return checks.mother_daughter(p, "l_orderkey")


def multiset_excess(spark, d):
    ln = read(spark, d, "lineitem")
    return checks.multiset_excess(ln.where("l_linestatus = 'F'"), ln.where("l_linestatus = 'O'"), ["l_returnflag", "l_linenumber", "l_discount"])


def corruption(spark, d):
    e = read(spark, d, "events").select("event_type", "user_id", F.when(F.col("value") > 0, F.col("value")).alias("value"), F.sequence(F.lit(1), (F.col("event_id") % 4 + 1).cast("int")).alias("items"))
    e = e.withColumn("n_items", F.when(F.col("user_id") % 5 == 0, 99).otherwise(F.size("items"))).withColumn("file", F.concat_ws("/", "event_type", (F.col("user_id") % 6).cast("string")))
    return checks.corruption(e, "file", {"items": "n_items"}, ["user_id"])


def step_consistency(spark, d):
    a = read(spark, d, "lineitem").withColumns({"inspected": F.lit(1), "failed": (F.col("l_discount") > 0.05).cast("int")})
    return checks.step_consistency(a, a.where("l_linenumber <> 7 or l_returnflag <> 'R'"), ["l_returnflag"], ["inspected", "failed"])


def expected_outputs(spark, d):
    s = read(spark, d, "lineitem")
    expected = s.select(F.col("l_suppkey").alias("task"), F.col("l_partkey").alias("file")).distinct()
    present = s.where("l_linestatus = 'F'").select(F.col("l_suppkey").alias("task"), F.col("l_partkey").alias("file"))
    runs = read(spark, d, "supplier").where("s_suppkey % 9 <> 0").select(F.col("s_suppkey").alias("task"), (F.col("s_nationkey") % 4).alias("exit_code"), (F.col("s_suppkey") % 2 == 0).alias("done"))
    return checks.expected_outputs(expected, present, runs)


def metadata_consistency(spark, d):
    o = read(spark, d, "orders").withColumn("price", F.floor("o_totalprice"))
    return checks.metadata_consistency(o, ["o_custkey"], "o_orderkey", ["o_orderstatus", "price"])


SQL = {
    "key_dedup_map": f"with {BASE} select df_id::int as df_id, old, new, survives from om",
    "remap_links": f"with {BASE} select l.df_id::int as df_id, l.row_id, coalesce(new, -1) as order_row from l left join om on om.df_id = l.df_id and old = order_row",
    "table_scan": """select 'customer' as "table", c_nationkey as nation, count(*) as rows, sum(c_custkey)::bigint as keys from customer group by all
        union all select 'supplier', s_nationkey, count(*), sum(s_suppkey)::bigint from supplier group by all""",
    "self_link": f"""with {BASE}, b as (select df_id, row_id, case when row_id - o_custkey % 3 - 1 >= 0 then row_id - o_custkey % 3 - 1 else -1 end as before from o)
        select b.df_id::int as df_id, row_id, coalesce(new, -1) as before from b left join om on om.df_id = b.df_id and old = before""",
    "remap_arrays": f"""with {BASE}, g as (
        select l.df_id, l_partkey as row_id, list(coalesce(new, -1) order by order_row) as rows, min(order_row) as a, max(order_row) as b
        from l left join om on om.df_id = l.df_id and old = order_row group by all)
        select g.df_id::int as df_id, row_id, array_to_string(rows, ',') as rows, least(coalesce(x.new, -1), coalesce(y.new, -1)) || '-' || greatest(coalesce(x.new, -1), coalesce(y.new, -1)) as span
        from g left join om x on x.df_id = g.df_id and x.old = a left join om y on y.df_id = g.df_id and y.old = b""",
    "event_dedup": f"""with {BASE}, k as (
        select o.df_id, o.row_id, o_orderpriority as p, case when o_custkey % 11 = 0 then -1 else new end as t from o left join om on om.df_id = o.df_id and old = row_id
        ), f as (select *, min(row_id) over (partition by df_id, t, case when t < 0 then row_id end, p) as first from k
        ), s as (select df_id, row_id as first, row_number() over (partition by df_id order by t < 0, t, row_id) - 1 as new from f where row_id = first)
        select df_id::int as df_id, row_id as old, new, row_id = first as survives from f join s using (df_id, first)""",
    "dependent_drop": f"""with {BASE}, j as (select l.df_id, l.row_id, order_row, case when survives then new end as t from l left join om on om.df_id = l.df_id and old = order_row),
        g as (select *, order_row >= 0 and t is null as gone from j)
        select df_id::int as df_id, row_id as old, case when not gone then row_number() over (partition by df_id, gone order by coalesce(t, -1) < 0, coalesce(t, -1), row_id) - 1 end as new from g""",
    "regroup_nulls_last": f"""with {BASE}, j as (select l.df_id, l.row_id, coalesce(new, -1) as t from l left join om on om.df_id = l.df_id and old = order_row)
        select df_id::int as df_id, row_id as old, row_number() over (partition by df_id order by t < 0, t, row_id) - 1 as new from j""",
    "follow_parent": f"""with {BASE} select o.df_id::int as df_id, o.row_id as old, case when o.df_id = 3 then o.row_id when survives then new end as new
        from o join om on om.df_id = o.df_id and old = o.row_id where o.df_id <> 3 or o.row_id > 0""",
    "deref_link": f"""with {BASE} select l.df_id::int as df_id, o_orderstatus, count(*) as n, sum(l_partkey)::bigint as parts from l join o on o.df_id = l.df_id and o.row_id = order_row group by all""",
    "rewrite_tables": f"""with {BASE}, lm as (select l.df_id, l.row_id as old, coalesce(new, -1) as order_row, l_quantity, l_tax, l_discount,
          row_number() over (partition by l.df_id order by coalesce(new, -1) < 0, new, l.row_id) - 1 as row_id from l left join om on om.df_id = l.df_id and old = order_row),
        tg as (select df_id, row_id, l_discount as tag, row_number() over (partition by df_id order by row_id) - 1 as tag_row from lm where old % 3 = 0)
        select lm.df_id::int as df_id, lm.row_id, lm.order_row, l_quantity, l_tax, strftime(o_orderdate, '%Y-%m-%d') as day, tag, tag_row
        from lm left join (select om.df_id, new as order_row, any_value(o_orderdate) as o_orderdate from om join o on o.df_id = om.df_id and o.row_id = old group by all) k using (df_id, order_row)
        left join tg using (df_id, row_id)""",
    "resort_fixpoint": f"""with {BASE}, lm as (select l.df_id, l.row_id as old, row_number() over (partition by l.df_id order by coalesce(new, -1) < 0, new, l.row_id) - 1 as new from l left join om on om.df_id = l.df_id and old = order_row)
        select df_id::int as df_id, old // 3 as old, row_number() over (partition by df_id order by new) - 1 as new from lm where old % 3 = 0""",
    "link_preservation": "select unnest(['lines', 'tags']) as \"table\", unnest(['order_row', 'line_row']) as link, 0::bigint as unexplained",
    "merge_folders": f"""with {BASE}, n as (select df_id, count(*) as nl from l group by df_id), k as (select df_id, count(*) as no from o group by df_id),
        u as (select df_id, row_id, order_row from l union all select df_id, row_id + nl, case when order_row >= 0 then order_row + no else -1 end from l join n using (df_id) join k using (df_id) where df_id < 4)
        select df_id::int as df_id, count(*) as n, max(row_id) as last, sum(order_row)::bigint as links, count(*) filter (order_row < 0) as none from u group by df_id""",
    "zip_columns": "select o_orderkey, o_orderpriority from orders",
    "truncate_child": f"with {BASE}, k as (select df_id, count(*) as n from o group by df_id) select df_id::int as df_id, count(*) as n, max(row_id) as last from l join k using (df_id) where row_id < k.n group by df_id",
    "monotonic_adjacent": """with x as (select *, datediff('day', date '1970-01-01', o_orderdate::date) as day from orders), v as (select *, lag(day) over (partition by o_orderpriority order by o_orderkey) as prev from x)
        select o_orderpriority, count(*) as rows, count(*) filter (day <= prev) as violations, min(o_orderkey) filter (day <= prev) as first, max(prev - day) filter (day <= prev) as max_jump from v group by 1""",
    "monotonic_runmax": """with x as (select *, case when o_custkey % 13 = 0 then -1 else datediff('day', date '1970-01-01', o_orderdate::date) end as day from orders),
        v as (select *, max(day) filter (day >= 0) over (partition by o_orderpriority order by o_orderkey rows between unbounded preceding and 1 preceding) as top from x)
        select o_orderpriority, count(*) as rows, count(*) filter (day < 0) as invalid, count(*) filter (day >= 0 and day < top) as violations, max(top - day) filter (day >= 0 and day < top) as max_back from v group by 1""",
    "violation_samples": """with x as (select *, datediff('day', date '1970-01-01', o_orderdate::date) as day from orders), v as (select *, lag(day) over (partition by o_orderpriority order by o_orderkey) as previous from x)
        select o_orderpriority, o_orderkey, day, previous from v where day < previous qualify row_number() over (partition by o_orderpriority order by o_orderkey) <= 5""",
    "contiguity": """with v as (select *, lag(user_id) over (partition by event_type order by event_id) as prev from events)
        select event_type, count(*) filter (prev is null or prev <> user_id) as runs, count(distinct user_id) as groups, count(*) filter (prev is null or prev <> user_id) - count(distinct user_id) as reopened from v where user_id >= 0 group by 1""",
    "link_range": f"""with {BASE}, k as (select df_id, count(*) as n from o group by df_id), x as (select df_id, case when l_partkey % 10 = 3 then order_row + 100000 else order_row end as r from l)
        select df_id::int as df_id, count(r) as links, count(*) filter (r < -1 or r >= n) as out_of_range from x join k using (df_id) group by df_id""",
    "paste_parity": f"""with {BASE}, g as (select df_id, count(*) filter (df_id <> 5 or row_id > 2) as child, count(*) as parent from o group by df_id)
        select df_id::int as df_id, child, parent, child = parent as equal from g""",
    "unregistered_links": "select count(o_orderstatus) as \"sliceStatus\" from orders",
    "mother_daughter": f"""with {BASE}, n as (select df_id, count(*) as n from l group by df_id), p as (select df_id, row_id, l_orderkey as ev, case when l_partkey % 5 = 0 then -1 else row_id - l_partkey % 3 end as m,
          case when l_partkey % 4 = 0 then -1 else row_id + 1 end as a, case when l_partkey % 6 = 0 then -1 else row_id + l_partkey % 3 end as b from l)
        select p.df_id::int as df_id, count(*) filter ((a < 0) <> (b < 0) or (a >= 0 and (a > b or b >= n))) as bad_slice, count(*) filter (m >= 0 and q.row_id is null) as bad_mother, count(*) filter (q.ev <> p.ev) as cross_event
        from p join n using (df_id) left join (select df_id, row_id, ev from p) q on q.df_id = p.df_id and q.row_id = p.m group by p.df_id""",
    "multiset_excess": """with a as (select l_returnflag, l_linenumber, l_discount, count(*) filter (l_linestatus = 'F') as a, count(*) filter (l_linestatus = 'O') as b from lineitem group by all)
        select l_returnflag, l_linenumber, l_discount, a - b as excess from a where a > b""",
    "corruption": """with e as (select event_type || '/' || user_id % 6 as file, case when user_id is null then 2 when user_id % 5 = 0 then 1 else 0 end as level from events)
        select file, ['ok', 'corrupted', 'broken'][max(level) + 1] as status, count(*) filter (level > 0) as bad_rows from e group by file""",
    "step_consistency": """with g as (select l_returnflag, count(*) as inspected_1, count(*) filter (l_discount > 0.05) as failed_1, count(*) filter (l_linenumber <> 7 or l_returnflag <> 'R') as inspected_2,
          count(*) filter (l_discount > 0.05 and (l_linenumber <> 7 or l_returnflag <> 'R')) as failed_2 from lineitem group by 1)
        select *, inspected_1 = inspected_2 and failed_1 = failed_2 as consistent from g""",
    "expected_outputs": """with f as (select l_suppkey as task, l_partkey as file, bool_or(l_linestatus = 'F') as there from lineitem group by all),
        g as (select task, count(*) as expected, count(*) filter (not there) as missing from f group by task)
        select task, expected, missing, case when s_suppkey is null or s_suppkey % 9 = 0 then 'not_run' when s_nationkey % 4 <> 0 then 'failed' when s_suppkey % 2 <> 0 then 'unfinished' when missing > 0 then 'incomplete' else 'ok' end as status
        from g left join supplier on s_suppkey = task""",
    "metadata_consistency": """with g as (select o_custkey, arg_min(o_orderstatus, o_orderkey) as "first_o_orderstatus", arg_min(floor(o_totalprice)::bigint, o_orderkey) as first_price,
          arg_max(o_orderstatus, o_orderkey) as "last_o_orderstatus", arg_max(floor(o_totalprice)::bigint, o_orderkey) as last_price from orders group by 1)
        select *, "first_o_orderstatus" = "last_o_orderstatus" and first_price = last_price as agree from g""",
}
QUERIES = {name: globals()[name] for name in SQL}
