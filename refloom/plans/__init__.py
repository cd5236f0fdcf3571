"""Bindings to the driver tables, the query registry and the oracle SQL."""


def load_all():
    """Import every query module so the registry is complete."""
    from refloom.plans import code_queries, file_queries, ingest_queries, link_queries, text_queries  # noqa: F401

    from refloom.plans.registry import REGISTRY

    return REGISTRY
