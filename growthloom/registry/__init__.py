"""All registered queries."""
from __future__ import annotations

import importlib

from growthloom.registry.core import ORACLE, QUERIES

GROUPS = ["scans", "filters", "quality", "expressions", "joins", "aggregates", "windows", "sets", "mutations", "composites", "streams"]

for _group in GROUPS:
    importlib.import_module(f"growthloom.registry.{_group}")

__all__ = ["ORACLE", "QUERIES"]
