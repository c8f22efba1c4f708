"""Registered panel queries, one module per operator family."""

from __future__ import annotations

from .registry import QUERIES, SQL


def queries():
    _load()
    return dict(QUERIES)


def oracle_sql():
    _load()
    return dict(SQL)


def _load() -> None:
    from . import simulation, charts, etl, families, features, joins, labels, quality, streams, windowed  # noqa: F401
    from . import analytics  # noqa: F401
