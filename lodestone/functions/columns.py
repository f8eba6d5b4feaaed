"""Column builders: naming, cleaning, times, rates, particle acceptance and flavour."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the accelerator clock: radio frequency in Hz (ten periods a crossing), crossings in an orbit.
RADIO_HZ, CROSSINGS = 400.789598e6, 3564
CROSSING_US = 10 * 1e6 / RADIO_HZ
ORBIT_US = CROSSINGS * CROSSING_US
#: Trigger efficiencies by collision system; pp by the energy below which each holds.  Fixed values.
EFFICIENCY = {"pO": 0.8222, "Op": 0.8222, "OO": 0.8677, "NeNe": 0.9147, "PbPb": 28.0}
EFFICIENCY_PP = [(1000.0, 0.68), (6000.0, 0.737)]
EFFICIENCY_ELSE = 0.759


def category(name: Column, rules: dict[str, str | None]) -> Column:
    """The only category found in the name, whatever the case, and whose exclusion is not; NULL for none or several."""
    hits = []
    for label, unless in rules.items():
        hit = name.rlike(f"(?i){label}")
        hits.append(F.when(hit & ~name.contains(unless) if unless else hit, label))
    found = F.array_compact(F.array(*hits))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0)))


def base_name(name: Column) -> Column:
    """``a_b_3`` is ``a_b``; a name without a number at its end stays."""
    return F.regexp_replace(name, "_[0-9]+$", "")


def timeframe(name: Column) -> Column:
    n = F.regexp_extract(name, "_([0-9]+)$", 1)
    return F.when(n == "", 0).otherwise(n.cast("int"))


def clean_cpu(cpu: Column) -> Column:
    """Percent to cores; negative readings are zero, NULL stays."""
    return F.when(cpu.isNotNull(), F.greatest(F.lit(0.0), cpu) / 100)


def coerce_numeric(text: Column) -> Column:
    return text.try_cast("double")


def micros(bc: Column, reset: Column) -> Column:
    """Timestamp in microseconds of a crossing counted from the orbit reset, truncated."""
    return reset + (bc * CROSSING_US).cast("long")


def orbit(bc: Column) -> Column:
    return F.floor(bc / CROSSINGS).cast("long")


def crossing_in_orbit(bc: Column) -> Column:
    return F.pmod(bc, F.lit(CROSSINGS)).cast("long")


def frame(bc: Column, first_orbit: Column, orbits_per_frame: Column) -> Column:
    return ((bc - first_orbit * CROSSINGS) / (orbits_per_frame * CROSSINGS)).cast("long")


def efficiency(system: Column, energy: Column) -> Column:
    """Trigger efficiency of a collision system at an energy."""
    pp = None
    for below, value in EFFICIENCY_PP:
        pp = F.when(energy < below, value) if pp is None else pp.when(energy < below, value)
    out = F.when(system == "pp", pp.otherwise(EFFICIENCY_ELSE))
    for name, value in EFFICIENCY.items():
        out = out.when(system == name, value)
    return out.otherwise(EFFICIENCY_ELSE)


def true_rate(counted: Column, eff: Column, bunches: Column, frequency: float = 11245.0) -> Column:
    """Interaction rate from a counted rate: pile-up and efficiency corrected; NULL where there is no rate or the counter is full."""
    share = counted / frequency / bunches
    return F.when((counted >= 0) & (share < 1), bunches * (-F.log(1 - share) / eff) * frequency)


def workers(command: Column) -> Column:
    """The number of workers named in a command, by the first of three notations."""
    patterns = (r"\$\{[A-Z_]*NWORKER[A-Z_]*:-(\d+)\}", r"(?<![A-Za-z_])-j\s+(\d+)", r"--tpc-lanes\s+(\d+)")
    found = [F.regexp_extract(command, p, 1) for p in patterns]
    return F.coalesce(*[F.when(f != "", f.cast("int")) for f in found])


def amdahl(wall: Column, cpu_mean: Column, n: Column) -> tuple[Column, Column]:
    """Serial and parallel seconds of a task from one measurement with n workers; NULL if busy cores are outside [1, n].

    wall = serial + parallel / n, and the CPU time serial + parallel = wall * cpu_mean.
    """
    ok = (n > 1) & (wall > 0) & (cpu_mean >= 1) & (cpu_mean <= n)
    return F.when(ok, wall * (n - cpu_mean) / (n - 1)), F.when(ok, wall * n * (cpu_mean - 1) / (n - 1))


def production_slot(start: Column, end: Column, job: Column, jobs: Column, cycle: Column, frames: Column, orbits_per_frame: int = 256) -> tuple[Column, Column, Column]:
    """(timestamp in ms, slot, in range) of a production job: each job owns an equal stretch of the run, filled one slot a cycle."""
    frame_us = orbits_per_frame * ORBIT_US
    per_job = (end - start) * 1000 / frame_us / jobs
    slot = (job * (per_job / frames)).cast("long") + cycle
    at = start + slot * frames * frame_us / 1000
    return at.cast("long"), slot, (frames <= per_job) & (at >= start) & (at <= end)


def flavour(pdg: Column) -> Column:
    """The quark flavour of a hadron code: the thousands' digit of baryons, the hundreds' digit of mesons; small codes are their own."""
    low = F.pmod(F.abs(pdg), F.lit(10000))
    hundreds = F.when(low > 10, F.floor(low / 100)).otherwise(low)
    return F.when(hundreds > 10, F.floor(hundreds / 10)).otherwise(hundreds).cast("int")


#: Regions as lists of (phi from, phi to in degrees, |eta| above, |eta| below); an open bound is None.  Fixed values.
_EM = [(80.0, 187.0, None, 0.7)]
_DI = [(260.0, 320.0, 0.22, 0.7), (320.0, 327.0, None, 0.7)]
_PH = [(250.0, 320.0, None, 0.13)]
REGIONS = {"full": [(None, None, None, 1.5)], "em": _EM, "di": _DI, "ph": _PH, "em_di": _EM + _DI, "di_ph": _DI + _PH, "barrel": _EM + _DI + _PH}
FORWARD = (3.4, 5.8)


def acceptance(region: str, phi: Column, eta: Column) -> Column:
    """Is a direction (radians) inside the region?"""
    if region == "forward":
        return (eta > FORWARD[0]) & (eta < FORWARD[1])
    found = F.lit(False)
    for a, b, inner, outer in REGIONS[region]:
        c = F.abs(eta) < outer
        c = c if inner is None else c & (F.abs(eta) > inner)
        c = c if a is None else c & (phi > a * math.pi / 180) & (phi < b * math.pi / 180)
        found = found | c
    return found
