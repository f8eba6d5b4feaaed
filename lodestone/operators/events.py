"""Event selection over particle rows: (event, row, pdg, mother, first_daughter, last_daughter, y, eta, phi, pt …).

Predicates are decided per event by one partial aggregation; only mother and daughter lookups need a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flavour

EVENT = "event"


def any_particle(df: DataFrame, cond: Column, out: str = "selected") -> DataFrame:
    return df.groupBy(EVENT).agg(F.coalesce(F.bool_or(cond), F.lit(False)).alias(out))


def all_particles(df: DataFrame, where: Column, cond: Column, out: str = "selected") -> DataFrame:
    """Does every particle that ``where`` selects meet ``cond``?  Events without such particles don't pass."""
    return df.groupBy(EVENT).agg(F.coalesce(F.bool_and(F.when(where, F.coalesce(cond, F.lit(False)))), F.lit(False)).alias(out))


def heavy_quark(df: DataFrame, y_min: float, y_max: float, codes: tuple[int, ...] = (4, 5)) -> DataFrame:
    return any_particle(df, F.abs("pdg").isin(*codes) & (F.col("y") > y_min) & (F.col("y") < y_max))


def species(df: DataFrame, pdg: int, y_min: float, y_max: float) -> DataFrame:
    return any_particle(df, (F.abs("pdg") == pdg) & (F.col("y") > y_min) & (F.col("y") < y_max))


def dilepton(df: DataFrame, eta_min: float, eta_max: float) -> DataFrame:
    """All electrons and muons of the event inside closed bounds."""
    return all_particles(df, F.abs("pdg").isin(11, 13), F.col("eta").between(eta_min, eta_max))


def with_mother(df: DataFrame, cols: list[str]) -> DataFrame:
    """Particles with columns of their mother, NULL if there is none."""
    m = df.select(EVENT, F.col("row").alias("mother"), *[F.col(c).alias(f"mother_{c}") for c in cols])
    return df.join(m, [EVENT, "mother"], "left")


def with_daughters(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per particle and daughter, the daughters being the rows from the first to the last."""
    p = df.where("first_daughter >= 0 and last_daughter >= first_daughter")
    p = p.withColumn("_d", F.explode(F.sequence("first_daughter", "last_daughter")))
    d = df.select(EVENT, F.col("row").alias("_d"), *[F.col(c).alias(f"daughter_{c}") for c in cols])
    return p.join(d, [EVENT, "_d"]).drop("_d")


def daughter_of_flavour(df: DataFrame, pdg: int, flavours: tuple[int, ...], y_min: float, y_max: float, at_least: int = 1, every: bool = False) -> DataFrame:
    """Events with particles of a species that come from a hadron of these flavours, in the rapidity range.

    ``at_least`` of them must be inside, or with ``every`` all of them, and as many.
    """
    j = with_mother(df, ["pdg"])
    own = (F.abs("pdg") == pdg) & flavour(F.col("mother_pdg")).isin(*flavours)
    inside = own & (F.col("y") > y_min) & (F.col("y") < y_max)
    n, k = F.count_if(own), F.count_if(inside)
    return j.groupBy(EVENT).agg(((k >= at_least) & ((k == n) if every else F.lit(True))).alias("selected"))


def prompt_photon(df: DataFrame, accept: Column, parton: int = 0) -> DataFrame:
    """Row 4, else row 5, is a photon inside the acceptance and the other row the wanted parton (0: any)."""
    at = lambda r, c: F.max(F.when(F.col("row") == r, c))
    g = df.groupBy(EVENT).agg(*[at(r, c).alias(f"{n}{r}") for r in (4, 5) for n, c in (("p", F.col("pdg")), ("a", accept))])
    first = F.col("p4") == 22
    photon, inside, other = F.when(first, F.col("p4")).otherwise(F.col("p5")), F.when(first, F.col("a4")).otherwise(F.col("a5")), F.when(first, F.col("p5")).otherwise(F.col("p4"))
    kind = F.lit(True) if parton == 0 else (other == 21) if parton == 21 else (F.abs(other) == parton)
    return g.select(EVENT, F.coalesce((photon == 22) & inside & kind, F.lit(False)).alias("selected"))


def decay_photon(df: DataFrame, accept: Column, pt_min: float) -> DataFrame:
    """A photon above the momentum cut inside the acceptance whose mother is a hadron beyond row 5."""
    j = with_mother(df, ["pdg"])
    return any_particle(j, (F.col("pdg") == 22) & (F.col("pt") > pt_min) & (F.col("mother") > 5) & (F.abs("mother_pdg") > 100) & accept)


def decay_match(df: DataFrame, channels: DataFrame, self_conjugate: list[int]) -> DataFrame:
    """Particles with ``matched``: the sorted daughter codes equal an allowed list, or its antiparticle list.

    ``channels`` (pdg, daughters sorted array) is a small table of fixed channels.  Codes that are their own antiparticle keep
    their sign.
    """
    d = with_daughters(df, ["pdg"]).groupBy(EVENT, "row", "pdg").agg(F.array_sort(F.collect_list("daughter_pdg")).alias("daughters"))
    anti = lambda x: F.when(x.isin(*self_conjugate), x).otherwise(-x)
    other = channels.select((-F.col("pdg")).alias("pdg"), F.array_sort(F.transform("daughters", anti)).alias("daughters"))
    allowed = channels.select("pdg", "daughters").unionByName(other).distinct().withColumn("matched", F.lit(True))
    return d.join(allowed, ["pdg", "daughters"], "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def fraction_check(df: DataFrame, group: str, signal: Column, expected: dict[int, float], tolerance: float = 0.05) -> DataFrame:
    """Per sub-generator: events, share of all, whether it is within the tolerance, signal fraction and its binomial error."""
    g = df.groupBy(group).agg(F.count("*").alias("n"), F.count_if(signal).alias("signal"))
    total = df.agg(F.count("*").alias("total"))
    j = g.join(F.broadcast(total))  # a single row
    want = None
    for k, v in expected.items():
        want = F.when(F.col(group) == k, v) if want is None else want.when(F.col(group) == k, v)
    share, frac = F.col("n") / F.col("total"), F.col("signal") / F.col("n")
    ok = F.abs(share - want) <= tolerance * want
    return j.select(group, "n", share.alias("share"), ok.alias("within"), frac.alias("fraction"), F.sqrt(frac * (1 - frac) / F.col("n")).alias("error"))


def pair_count(df: DataFrame, parent: int, daughter: int) -> DataFrame:
    """Per event: parents with daughters of both signs, and whether every such daughter is marked for transport."""
    d = with_daughters(df.where(F.col("pdg").isNotNull()), ["pdg", "to_be_done"]).where((F.abs("pdg") == parent) & (F.abs("daughter_pdg") == daughter))
    g = d.groupBy(EVENT, "row").agg(F.bool_or(F.col("daughter_pdg") > 0).alias("p"), F.bool_or(F.col("daughter_pdg") < 0).alias("m"), F.bool_and("daughter_to_be_done").alias("t"))
    return g.groupBy(EVENT).agg(F.count_if(F.col("p") & F.col("m")).alias("pairs"), F.bool_and("t").alias("all_transported"))


def injection_census(df: DataFrame, parents: list[int]) -> DataFrame:
    """Per injected species: particles, daughters, undecayed particles, and the share of events with any."""
    events = df.select(EVENT).distinct().agg(F.count("*").alias("events"))
    own = df.where(F.col("pdg").isin(*parents))
    n = F.when(F.col("first_daughter") >= 0, F.col("last_daughter") - F.col("first_daughter") + 1).otherwise(0)
    g = own.groupBy("pdg").agg(F.count("*").alias("particles"), F.sum(n).alias("daughters"), F.count_if(F.col("first_daughter") < 0).alias("undecayed"), F.countDistinct(EVENT).alias("with_any"))
    return g.join(F.broadcast(events)).select("pdg", "particles", "daughters", "undecayed", (F.col("with_any") / F.col("events")).alias("event_share"))


def sanity(df: DataFrame) -> DataFrame:
    """Per event: is every status encoded, is some particle marked for transport?"""
    return df.groupBy(EVENT).agg(F.bool_and(F.col("status") > 0).alias("encoded"), F.bool_or("to_be_done").alias("any_marked"))


def census(df: DataFrame, exact: int, allowed: list[int]) -> DataFrame:
    """Per event: particles as expected, only allowed species, no more positrons than electrons."""
    return df.groupBy(EVENT).agg(
        (F.count("*") == exact).alias("exact"), F.bool_and(F.abs("pdg").isin(*allowed)).alias("allowed"), (F.count_if(F.col("pdg") == 11) >= F.count_if(F.col("pdg") == -11)).alias("electrons")
    )


def background_check(df: DataFrame, background: Column, weight: str, tolerance: float = 0.05) -> DataFrame:
    """Is the number of background events within the tolerance of the summed event weights?"""
    e = df.groupBy(EVENT).agg(F.bool_or(background).alias("b"), F.max(weight).alias("w"))
    g = e.agg(F.count_if("b").alias("background"), F.sum("w").alias("expected"))
    return g.withColumn("within", F.abs(F.col("background") - F.col("expected")) <= tolerance * F.col("expected"))

