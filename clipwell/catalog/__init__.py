"""Bound queries. ``load()`` imports every module once and returns the registry."""

from importlib import import_module

MODULES = (
    "filters", "texts", "joins", "aggregates", "picks", "scores", "pool", "features",
    "extraction", "upserts", "files",
)


def load():
    for name in MODULES:
        import_module(f"clipwell.catalog.{name}")
    return import_module("clipwell.catalog.registry")
