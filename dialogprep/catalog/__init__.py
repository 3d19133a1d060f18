"""All registered queries."""

from __future__ import annotations


def _load():
    import importlib

    from dialogprep.catalog.registry import ORACLES, QUERIES

    for name in ("files", "conversations", "mixing", "text", "store", "runs"):
        importlib.import_module(f"dialogprep.catalog.{name}")
    return QUERIES, ORACLES


def all_queries():
    return dict(_load()[0])


def all_oracles():
    return dict(_load()[1])
