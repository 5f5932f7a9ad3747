"""Registered queries with their reference SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("ingest", "primitives", "incremental", "quality", "metrics", "domain")


def load_queries():
    for module in MODULES:
        import_module(f"ledgermill.catalog.{module}")
    from ledgermill.catalog.registry import QUERIES

    return QUERIES
