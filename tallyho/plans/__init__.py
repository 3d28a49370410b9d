"""Registered query plans with their SQL oracles, one module per capability."""

from __future__ import annotations

from importlib import import_module

_FAMILIES = ("text", "linreg", "logreg", "sparse_linreg", "mf", "files")


def all_queries() -> dict:
    out: dict = {}
    for fam in _FAMILIES:
        out.update(import_module(f"{__name__}.{fam}").QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for fam in _FAMILIES:
        out.update(import_module(f"{__name__}.{fam}").ORACLE)
    return out
