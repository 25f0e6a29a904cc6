"""Imports every report module so that the registry is complete."""

import importlib
import pkgutil

import opskit.plans as _plans
from opskit.plans.registry import QUERIES, SQL

for _m in sorted(m.name for m in pkgutil.iter_modules(_plans.__path__)):
    if _m.startswith("reports_"):
        importlib.import_module(f"opskit.plans.{_m}")

__all__ = ["QUERIES", "SQL"]
