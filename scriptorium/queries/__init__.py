"""Registered queries: operators applied to the bound test tables, with SQL checks."""

from __future__ import annotations

from importlib import import_module

from .registry import REGISTRY, Query

MODULES: list[str] = [
    "assessment",
    "functions",
    "reviews",
    "contract",
    "markup",
    "evaluation",
    "inventory",
    "workflow",
    "streams",
    "sinks",
]

for _module in MODULES:
    import_module(f"{__name__}.{_module}")

__all__ = ["REGISTRY", "Query"]
