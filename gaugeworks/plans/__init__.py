"""Registered queries over the given tables, each with its SQL counterpart."""

from importlib import import_module

MODULES = ("state", "catalog", "findings", "definitions", "report", "tickets", "investigate", "evidence")


def load_all():
    """All queries and their SQL, after importing every module that registers some."""
    from . import registry

    for name in MODULES:
        import_module(f"{__name__}.q_{name}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
