"""Every query of the reference's operators, and the SQL that restates it."""

from __future__ import annotations

from importlib import import_module

MODULES = ("coverage", "ordered", "classify", "geometry", "repair", "textual", "tables", "folding", "audit", "prose", "findings", "compose")


def queries() -> dict:
    found: dict = {}
    for name in MODULES:
        found |= import_module(f"folioforge.operators.{name}").QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in MODULES:
        found |= import_module(f"folioforge.operators.{name}").ORACLE
    return found
