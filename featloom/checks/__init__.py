"""Queries over the driver tables, each with the SQL that states its result."""

from importlib import import_module

FAMILIES = ["tables_clean", "groups", "targets_order", "texts", "vectors", "stacking", "learners"]


def load() -> None:
    for name in FAMILIES:
        import_module(f"featloom.checks.{name}")
