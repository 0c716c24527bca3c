"""SQL twins of the registered queries, written for DuckDB on the same parquet tables."""

from oracles.catalogue import ORACLES

__all__ = ["ORACLES"]
