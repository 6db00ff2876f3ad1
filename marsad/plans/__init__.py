"""The catalogue of queries over the project's tables."""

from __future__ import annotations

from importlib import import_module

MODULES = ("similar", "planning", "explorer", "scoring", "screening", "records", "streams", "items", "checks", "training", "reviews")


def _load():
    for m in MODULES:
        import_module("marsad.plans." + m)
    from marsad.plans import catalog

    return catalog


def queries():
    return dict(_load().QUERIES)


def oracle_sql():
    return dict(_load().SQL)
