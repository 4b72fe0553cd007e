"""Registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from importlib import import_module

MODULES = ("losses_queries", "source_queries", "audit_queries", "clean_queries", "feature_queries", "model_table", "woe_queries", "evaluate_queries", "scenario_queries", "decision_queries", "monitor_queries", "scoring_queries", "model_queries")


def load_all() -> dict:
    """Import every query module and return the registry."""
    for name in MODULES:
        import_module(f"lendmill.plans.{name}")
    from lendmill.plans.registry import QUERIES

    return QUERIES
