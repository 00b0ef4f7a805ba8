"""Registered queries: one Spark callable and, where SQL can say it, one oracle text per operator."""
from __future__ import annotations

import functools
from typing import Callable

from sitewright.plans.views import Tables, oracle
from sitewright.session import configure

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with an optional oracle."""

    def wrap(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            return fn(Tables(configure(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def fragment(name: str, sql: str) -> None:
    FRAGMENTS[name] = sql


def oracle_texts() -> dict[str, str]:
    return {n: oracle(s, FRAGMENTS) for n, s in ORACLES.items()}
