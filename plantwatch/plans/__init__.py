"""Named queries over the driver's tables, each with its oracle SQL where SQL can state it."""

from importlib import import_module

_MODULES = ["dashboards", "preparation", "detection", "pipeline", "evaluation", "training", "streams"]


def _loaded():
    for module in _MODULES:
        import_module(f"plantwatch.plans.{module}")
    return import_module("plantwatch.plans.registry")


def all_queries() -> dict:
    return dict(_loaded().QUERIES)


def all_oracles() -> dict:
    return dict(_loaded().ORACLES)
