"""Runnable queries over the star schema, each next to its SQL equivalent."""

from __future__ import annotations

import importlib

MODULES = ("sources", "cleaning", "joins", "reports", "segments", "series", "arma", "distributions")


def load():
    """All registered queries and SQL texts, by name."""
    from tillroll.plans import registry

    for module in MODULES:
        importlib.import_module(f"tillroll.plans.{module}")
    return registry.QUERIES, registry.ORACLES
