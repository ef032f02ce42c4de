"""Loads every query module once and exposes the registry."""

from __future__ import annotations

from . import model_queries, panel_queries, prepare_queries, profile_queries  # noqa: F401
from .catalog import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
