"""All registered queries. Importing a query module registers its queries."""

from __future__ import annotations

import importlib

from verdant.plans.registry import ORACLES, QUERIES

_MODULES = (
    "verdant.plans.text_queries",
    "verdant.plans.feature_queries",
    "verdant.plans.metric_queries",
    "verdant.plans.model_queries",
    "verdant.plans.stream_queries",
    "verdant.plans.operation_queries",
)


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return dict(ORACLES)
