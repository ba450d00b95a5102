"""All registered queries: importing the modules fills the registry."""

from __future__ import annotations

import importlib

from tidemill.plans.registry import QUERIES, SQL

MODULES = ("q_warehouse", "q_roundtrip", "q_relational", "q_analytics", "q_text", "q_models", "q_judged")
for _name in MODULES:
    importlib.import_module(f"tidemill.plans.{_name}")

__all__ = ["QUERIES", "SQL"]
