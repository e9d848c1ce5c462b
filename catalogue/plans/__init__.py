"""Queries over the driver's tables, one module per operator family."""

from importlib import import_module

FAMILIES = ("sources_plans", "projection_plans", "validation_plans", "unify_plans", "classify_plans", "join_plans",
            "search_plans", "facet_plans", "diff_plans", "review_plans", "ledger_plans", "document_plans")


def load() -> None:
    """Register every query; modules are imported once."""
    for name in FAMILIES:
        import_module(f"{__name__}.{name}")
