"""A named set of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def register(fn):
            if name in self.queries:
                raise ValueError(f"two queries are named {name}")
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register
