"""The queries of this subpackage and their SQL, by problem."""

from __future__ import annotations

from lavra.llm import canonical, encoding, language, mixing, names, quality, scans, subjects, truncation

MODULES = (scans, canonical, names, language, truncation, subjects, encoding, mixing, quality)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.oracle_sql().items()}
