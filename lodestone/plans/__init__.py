"""Queries over the driver tables that apply the operators, with the SQL of each."""

from __future__ import annotations

from importlib import import_module

MODULES = ("regression", "linked", "ordered", "usage", "particles", "graphs", "catalogs", "texts", "streamed", "monitored")


def _gather(what: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(import_module(f"{__name__}.{m}"), what)
    return out


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("SQL")
