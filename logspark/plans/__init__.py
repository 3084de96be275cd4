"""Registered queries: logs rendered from the given tables, run through the operators."""

import importlib

MODULES = ("q_parse", "q_sources", "q_inventory", "q_enrich", "q_views", "q_time", "q_outputs", "q_streams")


def load_all() -> None:
    """Import the query modules, which register themselves."""
    for name in MODULES:
        importlib.import_module(f"logspark.plans.{name}")
