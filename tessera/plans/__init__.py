"""Query plans: fixtures over the test tables and the registered queries."""

from __future__ import annotations


def all_queries():
    """Import every query module (registration is a side effect) and return the registry."""
    from tessera.plans import queries_data, queries_eval, queries_ml  # noqa: F401
    from tessera.plans.registry import REGISTRY
    return dict(REGISTRY)
