"""Queries of the core and their SQL."""

from __future__ import annotations

from lavra.plans import harvest, packed_fields

MODULES = (harvest, packed_fields)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.oracle_sql().items()}
