"""Event-selection queries: orders are events, their lines particles; row numbers follow all columns."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import events as E
from .linked import LINE_ORDER
from .tables import read, rounded

CODES = [4, -5, 22, 11, -11, 13, 443, 421, -511, 21, 3122, 100443, 211, -211]


def particles(spark, d):
    row = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)) - 1
    n = F.count("*").over(Window.partitionBy("l_orderkey"))
    x = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("event"), row.alias("row"), n.alias("n"), "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    code = F.get(F.array(*map(F.lit, CODES)), (F.col("l_partkey") % len(CODES)).cast("int"))
    first = F.when((F.col("l_suppkey") % 3 > 0) & (F.col("row") + 1 < F.col("n")), F.col("row") + 1).otherwise(-1)
    return x.select(
        "event", "row", code.alias("pdg"), F.when(F.col("row") > 0, F.floor((F.col("row") - 1) / 2)).otherwise(-1).cast("int").alias("mother"), first.alias("first_daughter"),
        F.when(first >= 0, F.least(F.col("row") + 2, F.col("n") - 1)).otherwise(-1).alias("last_daughter"), (F.col("l_discount") * 40 - 2).alias("y"), (F.col("l_tax") * 30 - 1.2).alias("eta"),
        (F.col("l_quantity") / 8).alias("phi"), F.col("l_quantity").alias("pt"), (F.col("l_returnflag") == "R").alias("to_be_done"), F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("status"),
        (F.col("event") % 3).cast("int").alias("sub_generator"), F.col("l_discount").alias("weight"),
    )


def predicate_any(spark, d):
    p = particles(spark, d)
    h = E.heavy_quark(p, -1.5, 1.5).withColumnRenamed("selected", "heavy")
    return h.join(E.species(p, 421, -1.0, 1.0).withColumnRenamed("selected", "species"), "event")


def predicate_all(spark, d):
    return E.dilepton(particles(spark, d), -1.0, 1.0)


def predicate_daughter(spark, d):
    p = particles(spark, d)
    some = E.daughter_of_flavour(p, 11, (4, 5), -1.8, 1.8).withColumnRenamed("selected", "one")
    return some.join(E.daughter_of_flavour(p, 211, (3, 4, 5), -1.8, 1.8, 2, True).withColumnRenamed("selected", "every"), "event")


def predicate_prompt(spark, d):
    p = particles(spark, d)
    a = E.prompt_photon(p, C.acceptance("full", F.col("phi"), F.col("eta"))).withColumnRenamed("selected", "any_parton")
    return a.join(E.prompt_photon(p, C.acceptance("full", F.col("phi"), F.col("eta")), 4).withColumnRenamed("selected", "quark"), "event")


def predicate_decay(spark, d):
    return E.decay_photon(particles(spark, d), C.acceptance("full", F.col("phi"), F.col("eta")), 10.0)


def acceptance_regions(spark, d):
    p = particles(spark, d)
    names = [*C.REGIONS, "forward"]
    return p.groupBy("pdg").agg(*[F.count_if(C.acceptance(n, F.col("phi"), F.col("eta") * (5 if n == "forward" else 1))).alias(n) for n in names])


def flavour_digit(spark, d):
    p = read(spark, d, "part").withColumn("code", F.when(F.col("p_partkey") % 2 == 0, 1).otherwise(-1) * (F.col("p_partkey") * 37 % 7000 + F.when(F.col("p_partkey") % 5 == 0, 100000).otherwise(0)))
    return p.select("p_partkey", C.flavour(F.col("code")).alias("flavour"))


def mother_self_join(spark, d):
    return E.with_mother(particles(spark, d), ["pdg"]).groupBy("pdg", "mother_pdg").agg(F.count("*").alias("n"))


def daughter_join(spark, d):
    return E.with_daughters(particles(spark, d), ["pdg"]).groupBy("pdg", "daughter_pdg").agg(F.count("*").alias("n"))


CHANNELS = [(421, [-11, 22]), (421, [22, 443]), (-511, [-5, 421]), (3122, [100443, 211]), (4, [-11, 13])]


def decay_match(spark, d):
    ch = spark.createDataFrame([(p, sorted(x)) for p, x in CHANNELS], "pdg int, daughters array<int>")
    return E.decay_match(particles(spark, d), ch, [22, 443, 100443]).groupBy("pdg").agg(F.count("*").alias("decays"), F.count_if("matched").alias("matched"))


def fraction_check(spark, d):
    p = particles(spark, d)
    f = E.fraction_check(p, "sub_generator", F.abs("pdg").isin(4, 5), {0: 1 / 3, 1: 1 / 3, 2: 0.4})
    return rounded(f, share=6, fraction=6, error=6)


def pair_count(spark, d):
    return E.pair_count(particles(spark, d), 443, 11)


def injection_census(spark, d):
    return rounded(E.injection_census(particles(spark, d), [443, 421, 3122]), event_share=6)


def event_sanity(spark, d):
    return E.sanity(particles(spark, d))


def event_census(spark, d):
    return E.census(particles(spark, d), 4, [4, 5, 22, 11, 13, 443, 421, 511, 21, 3122, 211])


def background_check(spark, d):
    return rounded(E.background_check(particles(spark, d), F.col("pdg") == 22, "weight"), expected=4)


P = f"""p0 as (
  select *, l_orderkey as event, row_number() over (partition by l_orderkey order by {", ".join(LINE_ORDER)}) - 1 as row, count(*) over (partition by l_orderkey) as n from lineitem
), p1 as (select *, case when l_suppkey % 3 > 0 and row + 1 < n then row + 1 else -1 end as fd from p0
), p as (
  select event, row, {CODES!r}[l_partkey % {len(CODES)} + 1] as pdg, case when row > 0 then (row - 1) // 2 else -1 end as mother, fd, case when fd >= 0 then least(row + 2, n - 1) else -1 end as ld,
         l_discount * 40 - 2 as y, l_tax * 30 - 1.2 as eta, l_quantity / 8 as phi, l_quantity as pt, l_returnflag = 'R' as tbd, case when l_linestatus = 'F' then 1 else 0 end as status, event % 3 as sub, l_discount as weight
  from p1
), pm as (select p.*, m.pdg as mpdg from p left join p m on m.event = p.event and m.row = p.mother
), pd as (select p.*, c.pdg as dpdg, c.tbd as dtbd from p join p c on c.event = p.event and c.row between p.fd and p.ld where p.fd >= 0)"""


def _fl(c: str) -> str:
    low = f"(abs({c}) % 10000)"
    h = f"(case when {low} > 10 then {low} // 100 else {low} end)"
    return f"(case when {h} > 10 then {h} // 10 else {h} end)"


def _acc(name: str, eta: str = "eta") -> str:
    if name == "forward":
        return f"({eta} > 3.4 and {eta} < 5.8)"
    parts = []
    for a, b, i, o in C.REGIONS[name]:
        c = f"abs({eta}) < {o}" + (f" and abs({eta}) > {i}" if i is not None else "") + (f" and phi > {a} * pi() / 180 and phi < {b} * pi() / 180" if a is not None else "")
        parts.append(f"({c})")
    return "(" + " or ".join(parts) + ")"


def _prompt(extra: str) -> str:
    return f"coalesce(case when p4 = 22 then a4 and {extra.replace('OTHER', 'p5')} when p5 = 22 then a5 and {extra.replace('OTHER', 'p4')} end, false)"


SQL = {
    "predicate_any": f"with {P} select event, bool_or(abs(pdg) in (4, 5) and y > -1.5 and y < 1.5) as heavy, bool_or(abs(pdg) = 421 and y > -1 and y < 1) as species from p group by 1",
    "predicate_all": f"with {P} select event, coalesce(bool_and(eta between -1 and 1) filter (abs(pdg) in (11, 13)), false) as selected from p group by 1",
    "predicate_daughter": f"""with {P}, q as (select event, abs(pdg) = 11 and {_fl('mpdg')} in (4, 5) as a, abs(pdg) = 211 and {_fl('mpdg')} in (3, 4, 5) as b, y > -1.8 and y < 1.8 as i from pm)
        select event, count(*) filter (a and i) >= 1 as one, count(*) filter (b and i) >= 2 and count(*) filter (b and i) = count(*) filter (b) as every from q group by 1""",
    "predicate_prompt": f"""with {P}, g as (select event, max(pdg) filter (row = 4) as p4, max(pdg) filter (row = 5) as p5, bool_or({_acc('full')}) filter (row = 4) as a4, bool_or({_acc('full')}) filter (row = 5) as a5 from p group by 1)
        select event, {_prompt('true')} as any_parton, {_prompt('abs(OTHER) = 4')} as quark from g""",
    "predicate_decay": f"with {P} select event, coalesce(bool_or(pdg = 22 and pt > 10 and mother > 5 and abs(mpdg) > 100 and {_acc('full')}), false) as selected from pm group by 1",
    "acceptance_regions": f"with {P} select pdg, {', '.join(f'count(*) filter ({_acc(n)}) as {n}' for n in C.REGIONS)}, count(*) filter ({_acc('forward', '(eta * 5)')}) as forward from p group by 1",
    "flavour_digit": f"with q as (select p_partkey, p_partkey * 37 % 7000 + case when p_partkey % 5 = 0 then 100000 else 0 end as c from part) select p_partkey, {_fl('c')}::int as flavour from q",
    "mother_self_join": f"with {P} select pdg, mpdg as mother_pdg, count(*) as n from pm group by all",
    "daughter_join": f"with {P} select pdg, dpdg as daughter_pdg, count(*) as n from pd group by all",
    "decay_match": f"""with {P}, g as (select event, row, pdg, list_sort(list(dpdg)) as ds from pd group by all),
        c as (select unnest({[p for p, _ in CHANNELS]!r}) as pdg, unnest({[sorted(x) for _, x in CHANNELS]!r}) as ds),
        a as (select pdg, ds from c union select -pdg, list_sort([case when x in (22, 443, 100443) then x else -x end for x in ds]) from c)
        select g.pdg, count(*) as decays, count(a.pdg) as matched from g left join a on a.pdg = g.pdg and a.ds = g.ds group by 1""",
    "fraction_check": f"""with {P}, g as (select sub, count(*) as n, count(*) filter (abs(pdg) in (4, 5)) as s from p group by 1), t as (select *, n / sum(n) over () as share, case when sub = 2 then 0.4::double else 1.0::double / 3 end as want, s / n as f from g)
        select sub::int as sub_generator, n, round(share, 6) as share, abs(share - want) <= 0.05::double * want as within, round(f, 6) as fraction, round(sqrt(f * (1 - f) / n), 6) as error from t""",
    "pair_count": f"""with {P}, g as (select event, row, bool_or(dpdg > 0) and bool_or(dpdg < 0) as b, bool_and(dtbd) as t from pd where abs(pdg) = 443 and abs(dpdg) = 11 group by all)
        select event, count(*) filter (b) as pairs, bool_and(t) as all_transported from g group by 1""",
    "injection_census": f"""with {P} select pdg, count(*) as particles, sum(case when fd >= 0 then ld - fd + 1 else 0 end)::bigint as daughters, count(*) filter (fd < 0) as undecayed,
        round(count(distinct event) / (select count(distinct event) from p), 6) as event_share from p where pdg in (443, 421, 3122) group by 1""",
    "event_sanity": f"with {P} select event, bool_and(status > 0) as encoded, bool_or(tbd) as any_marked from p group by 1",
    "event_census": f"with {P} select event, count(*) = 4 as exact, bool_and(abs(pdg) in (4, 5, 22, 11, 13, 443, 421, 511, 21, 3122, 211)) as allowed, count(*) filter (pdg = 11) >= count(*) filter (pdg = -11) as electrons from p group by 1",
    "background_check": f"""with {P}, e as (select event, bool_or(pdg = 22) as b, max(weight) as w from p group by 1)
        select count(*) filter (b) as background, round(sum(w), 4) as expected, abs(count(*) filter (b) - sum(w)) <= 0.05 * sum(w) as within from e""",
}
QUERIES = {name: globals()[name] for name in SQL}
