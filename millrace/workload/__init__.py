"""The registered queries."""

from __future__ import annotations

import importlib

MODULES = ("relational", "storage", "scalars", "statistics", "jobs", "streams")


def load_all():
    for module in MODULES:
        importlib.import_module(f"millrace.workload.{module}")
    from millrace.workload.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
