"""Named queries over the given tables, each with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("star_queries", "layer_queries", "schema_queries", "privacy_queries", "governed_queries", "analysis_queries")


def _load() -> None:
    for name in _MODULES:
        import_module(f"tallyhouse.plans.{name}")


def all_queries() -> dict:
    from tallyhouse.plans.catalog import QUERIES

    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    from tallyhouse.plans.catalog import ORACLES

    _load()
    return dict(ORACLES)
