"""Registered queries over the given tables, their inputs and the SQL they are checked against."""

from importlib import import_module

_MODULES = ("address", "tables", "scanning", "tags", "flows")


def _load():
    for name in _MODULES:
        import_module(f"suite.{name}")
    return import_module("suite.registry")


def all_queries():
    return dict(_load().QUERIES)


def all_checks():
    return dict(_load().CHECKS)
