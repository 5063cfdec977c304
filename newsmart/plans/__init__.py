"""Plans: the registered queries (one per operator family) and the medallion runner."""

from newsmart.plans.registry import QUERIES, Query, register  # noqa: F401


def load_queries() -> dict:
    """Import every query module so that its ``@register`` calls run."""
    from newsmart.plans import daily_queries, queries, search_queries  # noqa: F401

    return QUERIES
