"""Registration of catalogue queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from quarrylens.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    key: str
    question: str
    fn: Callable[..., DataFrame]

    def __call__(self, tables: Tables, **params) -> DataFrame:
        return self.fn(tables, **params)


CATALOGUE: dict[str, Query] = {}


def query(key: str, question: str):
    """Add a function ``(tables, **params) -> DataFrame`` to the catalogue."""

    def register(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        if key in CATALOGUE:
            raise ValueError(f"duplicate query key {key}")
        CATALOGUE[key] = Query(key, question, fn)
        return fn

    return register
