"""DuckDB statements that restate every exactly comparable query."""

from __future__ import annotations

from importlib import import_module

MODULES = ("reports", "loading", "measures", "statistics", "insights", "feeds", "forecasts", "streams")


def all_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in MODULES:
        out.update(import_module(f"oracle.{module}").SQL)
    return out
