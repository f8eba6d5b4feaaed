"""Catalog, content and log queries over orders, part, documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as K
from ..operators import hist
from ..operators import predicates as P
from ..sources import footers
from .regression import VALS, _axes, _values
from .tables import read


def thinned(spark, d):
    return K.thinned(read(spark, d, "orders").select("o_orderpriority", "o_orderkey"), "o_orderpriority")


def first_parts(spark, d):
    return K.first_parts(read(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_partkey"), "l_suppkey", 7)


def selective_copy(spark, d):
    """Two columns of two tables, nothing else read."""
    o, ln = read(spark, d, "orders").select("o_orderkey", "o_custkey"), read(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    return o.select(F.lit("orders").alias("table"), F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v")).unionByName(ln.select(F.lit("lineitem").alias("table"), F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("v")))


def vertical_merge(spark, d):
    o = read(spark, d, "orders")
    return o.where("o_orderstatus = 'F'").unionByName(o.where("o_orderstatus = 'O'"), allowMissingColumns=False).select("o_orderkey", "o_totalprice")


def folder_semi(spark, d):
    a = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    return K.with_workflow_only(a, read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


def unprocessed(spark, d):
    x = read(spark, d, "documents").select("doc_id", F.md5("text").alias("hash"))
    return K.unprocessed(x, x.where("doc_id % 4 = 0"), "hash")


def best_pass(spark, d):
    o = read(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    return K.best_pass(o, "o_custkey", "o_orderpriority", ["1-URGENT", "3-MEDIUM", "2-HIGH"], "o_orderkey")


def edge_splits(spark, d):
    o = read(spark, d, "orders").withColumn("split", F.when(F.col("o_orderkey") % 6 == 0, F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string")))
    o = o.select("o_custkey", "split", "o_orderstatus")
    lo = K.edge_splits(o, "o_custkey", "split", F.col("o_orderstatus") != "F").withColumn("end", F.lit("first"))
    return lo.unionByName(K.edge_splits(o, "o_custkey", "split", F.col("o_orderstatus") != "F", False).withColumn("end", F.lit("last")))


def sample_per_group(spark, d):
    return K.sample_per_group(read(spark, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", 3, "s1")


def run_info(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal").where("o_custkey % 5 > 0")
    return K.run_info_join(read(spark, d, "orders").select("o_orderkey", "o_custkey"), c, "o_custkey")


def insert_if_absent(spark, d):
    g = read(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    return K.insert_if_absent(g.where("o_custkey % 3 > 0"), g.withColumn("n", F.lit(-1).cast("long")), ["o_custkey", "o_orderstatus"])


def frame_structure(spark, d):
    o = read(spark, d, "orders").withColumn("frame", F.floor(F.col("o_orderkey") / 64))
    x = K.frame_structure(o, "frame", ["o_custkey", "o_orderkey"])
    return x.select("frame", F.array_join(F.transform("collisions", lambda c: F.concat_ws(":", c["o_custkey"].cast("string"), c["o_orderkey"].cast("string"))), ",").alias("collisions"))


def table_counts(spark, d):
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    return K.table_counts({n: read(spark, d, n) for n in names}, "[a-z]*[nrm]|orders|events")


FOOTED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def file_counts(spark, d):
    """Rows per file, table and in all, from the files' footers."""
    return footers.file_counts(footers.footers(spark, [f"{d}/{n}.parquet" for n in FOOTED]))


def stored_profile(spark, d):
    """Raw and stored bytes and their ratio for groups of columns, tables and all of them."""
    groups = {"keys": ["l_orderkey", "l_partkey", "l_suppkey", "o_orderkey", "o_custkey"], "prices": ["l_extendedprice", "l_discount", "l_tax", "o_totalprice"], "flags": ["l_returnflag", "l_linestatus", "o_orderstatus"]}
    return footers.stored_profile(footers.footers(spark, [f"{d}/{n}.parquet" for n in FOOTED]), groups)


def profile_columns(spark, d):
    return K.size_profile(read(spark, d, "orders"))


def profile_compare(spark, d):
    p = read(spark, d, "part")
    return K.column_compare(K.size_profile(p), K.size_profile(p.where("p_size > 1 or p_partkey % 2 = 0")))


def content_hash(spark, d):
    return read(spark, d, "documents").select("doc_id", K.row_fingerprint(["text", "lang"]).alias("hash"))


def hist_hash(spark, d):
    return K.hist_hash(hist.fill(_values(spark, d), _axes(spark, d), ["l_returnflag"]), ["l_returnflag", "object"])


def record_hash(spark, d):
    return K.record_hash(read(spark, d, "nation"), ["n_nationkey", "n_regionkey", "n_name"]).select("n_nationkey", "hash")


def job_status(spark, d):
    o = read(spark, d, "orders").withColumn("status", F.when(F.col("o_orderstatus") == "F", "DONE").when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("ERROR"))
    return K.job_status(o, ["o_orderpriority"], "status")


def request_report(spark, d):
    o = read(spark, d, "orders").select(
        F.col("o_orderkey").alias("request"), F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("merged_at"), (F.col("o_custkey") % 2 == 0).alias("closed"),
        F.array(F.concat(F.lit("L"), (F.col("o_custkey") % 7).cast("string")), F.concat(F.lit("L"), (F.col("o_orderkey") % 5).cast("string"), F.lit("-ok"))).alias("labels"),
    )
    return K.request_report(o, ["L1", "L2", "L3"], "-ok")


def contradictions(spark, d):
    p = read(spark, d, "part").select(F.col("p_brand").alias("group"), (F.col("p_partkey") % 40).cast("string").alias("key"), F.col("p_size").cast("string").alias("value"))
    return K.contradictions(p).select("group", "key", F.array_join("values", ",").alias("values"))


def _lines(spark, d):
    x = read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return x.withColumn("line", F.when(F.col("line").contains("Licensed"), F.concat(F.lit("[12:00:00][FATAL] "), F.col("line"))).otherwise(F.col("line")))


def failure_context(spark, d):
    return K.failure_context(_lines(spark, d), "doc_id").select("doc_id", "line_no", "line", "first")


def failed_tasks(spark, d):
    x = read(spark, d, "events").select(F.concat_ws(" ", F.lit("task"), F.concat_ws("_", "event_type", (F.col("user_id") % 30).cast("string")), F.when(F.col("event_id") % 5 > 0, "failed, will retry").otherwise("done")).alias("line"))
    return K.failed_tasks(x)


def compact_plan(spark, d):
    o = read(spark, d, "orders").select("o_custkey", "o_orderkey", F.floor("o_totalprice").alias("size"))
    return K.compact_plan(o, "o_custkey", "o_orderkey", "size", 400000)


def path_prune(spark, d):
    p = read(spark, d, "part").withColumn("path", F.concat(F.lit("//"), F.col("p_type"), F.lit("/"), F.col("p_brand"), F.lit("/")))
    p = p.withColumn("path", F.when(F.col("p_partkey") % 11 == 0, "/PROMO").otherwise(F.col("path")))
    return P.by_path(p.select("p_partkey", "path"), "path", ["/PROMO/Brand#1", "Brand#12"])


def triggered(spark, d):
    o = read(spark, d, "orders").withColumn("mask", F.col("o_custkey").bitwiseAND(F.lit(12)))
    return P.triggered(o.select("o_orderkey", "mask"), "mask")


def numeric_columns(spark, d):
    """The columns a histogram is filled from, with their values."""
    p = read(spark, d, "part").withColumnRenamed("p_retailprice", "p_price_")
    return hist.long_form(p).groupBy("object").agg(F.count("*").alias("n"), F.max("x").alias("top"))


SQL = {
    "path_prune": """with p as (select p_partkey, case when p_partkey % 11 = 0 then '/PROMO' else '//' || p_type || '/' || p_brand || '/' end as path from part),
        n as (select *, trim(regexp_replace(path, '/+', '/', 'g'), '/') as q from p)
        select p_partkey, path from n where contains(q, 'PROMO/Brand#1') or contains('PROMO/Brand#1', q) or contains(q, 'Brand#12') or contains('Brand#12', q)""",
    "triggered": "select o_orderkey, o_custkey & 12 as mask from orders where o_custkey & 12 <> 0",
    "numeric_columns": "select unnest(['p_partkey', 'p_size']) as object, count(*) as n, unnest([max(p_partkey), max(p_size)])::double as top from part",
    "thinned": "select o_orderpriority, o_orderkey from orders where o_orderpriority = (select min(o_orderpriority) from orders)",
    "first_parts": "select l_suppkey, l_orderkey, l_partkey from lineitem where l_suppkey in (select distinct l_suppkey from lineitem order by 1 limit 7)",
    "selective_copy": "select 'orders' as \"table\", o_orderkey as k, o_custkey as v from orders union all select 'lineitem', l_orderkey, l_partkey from lineitem",
    "vertical_merge": "select o_orderkey, o_totalprice from orders where o_orderstatus in ('F', 'O')",
    "folder_semi": "select l_orderkey, l_partkey, l_linenumber from lineitem where l_orderkey in (select o_orderkey from orders where o_orderstatus = 'P')",
    "unprocessed": "select doc_id, md5(text) as hash from documents where md5(text) not in (select md5(text) from documents where doc_id % 4 = 0)",
    "best_pass": "select o_custkey, o_orderpriority, o_orderkey from orders qualify row_number() over (partition by o_custkey order by case o_orderpriority when '1-URGENT' then 0 when '3-MEDIUM' then 1 when '2-HIGH' then 2 else 3 end, o_orderkey) = 1",
    "edge_splits": """with o as (select o_custkey, case when o_orderkey % 6 = 0 then 'x' || o_orderkey else o_orderkey::varchar end as split, o_orderstatus from orders where o_orderstatus <> 'F')
        (select *, 'first' as "end" from o qualify row_number() over (partition by o_custkey order by try_cast(split as int) is null, try_cast(split as int), split) = 1)
        union all (select *, 'last' from o qualify row_number() over (partition by o_custkey order by try_cast(split as int) is null, try_cast(split as int) desc, split desc) = 1)""",
    "sample_per_group": "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by md5(o_orderkey || '/s1')) <= 3",
    "run_info": "select o_orderkey, o_custkey, case when o_custkey % 5 > 0 then c_acctbal end as c_acctbal from orders left join customer on c_custkey = o_custkey",
    "insert_if_absent": "select o_custkey, o_orderstatus, case when any_value(o_custkey % 3) > 0 then count(*) else -1 end as n from orders group by o_custkey, o_orderstatus",
    "frame_structure": "select o_orderkey // 64 as frame, string_agg(o_custkey || ':' || o_orderkey, ',' order by o_custkey, o_orderkey) as collisions from orders group by 1",
    "table_counts": " union all ".join(f"select '{t}' as \"table\", count(*) as rows from {t}" for t in ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")),
    "file_counts": "with t as (" + " union all ".join(f"select '{t}' as t, count(*) as n from {t}" for t in FOOTED) + ") select t || '.parquet' as file, t as \"table\", n as rows from t union all select null, t, n from t union all select null, null, sum(n)::bigint from t",
    "profile_columns": """select unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) as column,
        unnest([count(o_orderkey) * 8, count(o_custkey) * 8, sum(strlen(o_orderstatus)), count(o_totalprice) * 8, count(o_orderdate) * 8, sum(strlen(o_orderpriority))])::bigint as bytes,
        unnest([count(o_orderkey), count(o_custkey), count(o_orderstatus), count(o_totalprice), count(o_orderdate), count(o_orderpriority)]) as values from orders""",
    "profile_compare": """with x as (select *, p_size > 1 or p_partkey % 2 = 0 as k from part), w as (select k, unnest(['p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size', 'p_retailprice']) as c, unnest([8, strlen(p_name), strlen(p_brand), strlen(p_type), 4, 8]) as b from x),
        a as (select 'first' as only, c as "column", sum(b)::bigint as bytes, count(*) as "values" from w group by c union all select 'second', c, sum(b)::bigint, count(*) from w where k group by c)
        select * from a qualify count(*) over (partition by "column", bytes, "values") = 1""",
    "content_hash": "select doc_id, md5(coalesce(text, '\\N') || '|' || coalesce(lang, '\\N')) as hash from documents",
    "hist_hash": f"""with {VALS}, h as (select l_returnflag, object, bin, count(*) as c from binned group by all)
  select l_returnflag, object, sha256(l_returnflag || '/' || object || ',' || string_agg(bin || ':' || c, ',' order by bin)) as hash from h group by 1, 2""",
    "record_hash": "select n_nationkey, sha256('{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || '}') as hash from nation",
    "job_status": "select o_orderpriority, count(*) as total, count(*) filter (o_orderstatus = 'F') as done, count(*) filter (o_orderstatus = 'O') as running, count(*) filter (o_orderstatus not in ('F', 'O')) as error from orders group by 1",
    "request_report": """select 'L' || o_custkey % 7 as label, case when o_orderstatus = 'F' then 'merged' when o_custkey % 2 = 0 then 'closed' else 'open' end as state, o_orderkey as request,
        case when o_orderstatus = 'F' then strftime(o_orderdate, '%Y-%m-%d') end as merged_at from orders where o_custkey % 7 in (1, 2, 3) and o_custkey % 7 <> o_orderkey % 5""",
    "contradictions": "select p_brand as \"group\", (p_partkey % 40)::varchar as key, string_agg(distinct p_size::varchar, ',' order by p_size::varchar) as values from part group by all having count(distinct p_size) > 1",
    "failure_context": """with l0 as (select doc_id, unnest(range(len(a)))::int as line_no, unnest(a) as line from (select doc_id, string_split(text, chr(10)) as a from documents)),
        l as (select doc_id, line_no, case when contains(line, 'Licensed') then '[12:00:00][FATAL] ' || line else line end as line from l0),
        h as (select doc_id, min(line_no) as n from l where regexp_matches(line, '"""
    + "|".join(K.FAILURES)
    + """') group by 1)
        select doc_id, line_no, line, line_no = n as first from l join h using (doc_id) where line_no between n - 2 and n + 10""",
    "failed_tasks": "select distinct event_type as task, (user_id % 30)::int as timeframe from events where event_id % 5 > 0",
    "compact_plan": """with x as (select o_custkey, o_orderkey, floor(o_totalprice)::bigint as size, row_number() over (partition by o_custkey order by o_orderkey) as n, count(*) over (partition by o_custkey) as t from orders)
        select o_custkey, o_orderkey, size, n - case when n = t and t >= 2 and size * 100 < 400000 * 20 then 1 else 0 end as "group" from x""",
}
QUERIES = {name: globals()[name] for name in SQL} | {"stored_profile": stored_profile}  # stored bytes are no matter of SQL: tested against DuckDB's own view of the footers
