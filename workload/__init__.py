"""Queries over the given tables, each with the SQL it is checked against."""

from __future__ import annotations

import importlib

_MODULES = ("models", "expressions", "joins", "changes", "summaries", "loads", "extraction",
            "review", "quality", "history", "refresh")


def load():
    """Import every query module and return the filled registry."""
    for name in _MODULES:
        importlib.import_module(f"workload.{name}")
    return importlib.import_module("workload.registry")
