"""Collects the registered queries and their oracle SQL from the plan modules."""

from __future__ import annotations

import importlib

_MODULES = (
    "tessera.plans.text_queries",
    "tessera.plans.profile_queries",
    "tessera.plans.eval_queries",
    "tessera.plans.model_queries",
    "tessera.plans.grid_queries",
    "tessera.plans.sink_queries",
)


def _loaded():
    for name in _MODULES:
        yield importlib.import_module(name)


def all_queries() -> dict:
    out: dict = {}
    for mod in _loaded():
        out.update(mod.QUERIES)
    return out


def all_oracle_sql() -> dict:
    out: dict = {}
    for mod in _loaded():
        out.update(getattr(mod, "ORACLE", {}))
    return out
