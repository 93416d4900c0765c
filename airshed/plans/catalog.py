"""All registered queries (importing the catalog modules fills the registry)."""

from __future__ import annotations

from airshed.plans import catalog_star  # noqa: F401  (first: the others import it)
from airshed.plans import catalog_analytics, catalog_operators, catalog_staging  # noqa: F401
from airshed.plans.queries import ORACLES, QUERIES


def flagship(spark, sf_dir):
    return QUERIES["sum_by_country"](spark, sf_dir)


__all__ = ["QUERIES", "ORACLES", "flagship"]
