"""The registered queries."""

from loamframe.plans import climate, ingest, places, survey
from loamframe.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "climate", "ingest", "places", "survey"]
