"""All registered queries."""

# Importing a module registers its queries.
from feedmill.plans import feeds, quality, reconciliation, relational  # noqa: F401
from feedmill.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
