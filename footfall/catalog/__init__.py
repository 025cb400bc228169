"""Named queries over the given tables, each beside the SQL that must give the same rows."""

from footfall.catalog import checks, entities, evaluation, relational, scalars, training
from footfall.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "checks", "entities", "evaluation", "relational", "scalars", "training"]
