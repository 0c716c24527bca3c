"""Named, parameterised analytical queries: ``CATALOGUE[key](tables, as_of=..., **params)``."""

from quarrylens.plans.catalogue.base import CATALOGUE, Query
from quarrylens.plans.catalogue import cross, equipment, procurement, projects, safety, workforce  # noqa: F401

__all__ = ["CATALOGUE", "Query"]
