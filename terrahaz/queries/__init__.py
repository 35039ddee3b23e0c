"""Queries over the driver tables, one per operator, with SQL oracles."""

from importlib import import_module

_MODULES = [
    "bronze", "silver", "spatial", "gold", "rollups", "ordered", "scalar", "enrichment", "streams", "learning",
]


def load():
    """Import every query module once and return the filled registry."""
    for name in _MODULES:
        import_module(f"terrahaz.queries.{name}")
    return import_module("terrahaz.queries.registry")
