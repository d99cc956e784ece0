"""Queries over the engine's operators on the test corpus, each with its SQL where SQL can express it."""

from lexloom.queries.catalogue import QUERIES, SQL
from lexloom.queries import corpus, measures, quality, relational, structure, vectors  # noqa: F401  (they register their queries)

__all__ = ["QUERIES", "SQL"]
