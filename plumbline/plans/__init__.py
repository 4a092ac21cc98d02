"""Queries by subject. Every module here with QUERIES and ORACLE is part of the catalogue."""

from __future__ import annotations

import importlib
import pkgutil


def _collect(what: str) -> dict:
    out: dict = {}
    for m in sorted(x.name for x in pkgutil.iter_modules(__path__)):
        out |= getattr(importlib.import_module(f"{__name__}.{m}"), what, {})
    return out


def all_queries() -> dict:
    return _collect("QUERIES")


def all_oracle_sql() -> dict:
    return _collect("ORACLE")
