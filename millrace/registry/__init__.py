"""Catalogue of runnable queries with their SQL checks."""

from __future__ import annotations

import importlib

MODULES = ["retail", "logistics", "workorders", "events", "streams", "storage"]


def load():
    for name in MODULES:
        importlib.import_module(f"millrace.registry.{name}")
    from millrace.registry.base import QUERIES

    return QUERIES
